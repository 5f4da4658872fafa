"""Mixing sources to target weights by capped water-filling.

Sources share the whole size of the corpus by weight, but none may be repeated
more than ``max_epochs`` times: a source whose share exceeds that is clamped
and the excess goes to the others by weight, until none is above.  The level
where that ends is found directly: sources ordered by ``cap / weight`` are
clamped in that order, so one running sum decides.

Within a source every document is taken a whole number of times, and the
remainder is filled from documents in a seeded random order (md5 of the id);
the last one of these is taken in part, so a source's words hit its target.
The order is never sorted as a whole: two rounds of 4,096 hash buckets narrow
the cut to one cell, sums per place in the order to one id, and buckets of the row
number to a few rows of that id; only these are ordered by row.

Defined cases: null text or blank text has size 0 and is never taken; null
source is a source of its own, the last; rows that repeat or share an id follow
each other in the order and are told apart by their row number, each taken for
itself; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import quoted, words, written

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
#: Buckets of the rows that share an id.
TIES = 4096


def _order(doc_id: Column) -> Column:
    return F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size``, the seeded order and the row number of every document."""
    return docs.select(F.monotonically_increasing_id().alias("pos"),
                       F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("source").cast("string").alias("source"),
                       F.size(words(F.col("text"))).cast("long").alias("size"),
                       _order(F.col("doc_id")).alias("ord"))


def targets(sized: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source, source_size, target``: the water-filled words per source."""
    everything = Window.partitionBy(F.lit(0))
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                          ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    s = (sized.groupBy("source").agg(F.sum("size").alias("source_size"))
         .withColumn("w", weight.cast("long"))
         .withColumn("cap", F.col("source_size") * max_epochs)
         .withColumn("total", F.sum("source_size").over(everything))
         .withColumn("all_w", F.sum("w").over(everything)))
    # sources in the order in which they are clamped; ties clamp together
    tight = (F.col("cap") / F.col("w")).cast("double")
    clamp = Window.partitionBy(F.lit(0)).orderBy("tight").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    s = (s.withColumn("tight", tight)
         .withColumn("cap_upto", F.sum("cap").over(clamp))
         .withColumn("w_upto", F.sum("w").over(clamp)))
    # the level if this source and all tighter ones are clamped; a source is
    # clamped when the level that leaves it free is above its own cap
    left_w = F.col("all_w") - (F.col("w_upto") - F.sum("w").over(Window.partitionBy("tight")))
    left = F.col("total") - (F.col("cap_upto") - F.sum("cap").over(Window.partitionBy("tight")))
    s = (s.withColumn("free_level", left / left_w)
         .withColumn("clamped", F.col("free_level") >= F.col("tight")))
    kept_w = F.col("all_w") - F.coalesce(F.sum(F.when(F.col("clamped"), F.col("w"))).over(everything), F.lit(0))
    kept = F.col("total") - F.coalesce(F.sum(F.when(F.col("clamped"), F.col("cap"))).over(everything), F.lit(0))
    s = s.withColumn("level", F.when(kept_w > 0, kept / kept_w).otherwise(F.lit(0.0)))
    return s.select("source", "source_size",
                    F.when(F.col("clamped"), F.col("cap").cast("double"))
                    .otherwise(F.col("w") * F.col("level")).alias("target"))


def _bucket(level: int) -> Column:
    return F.conv(F.substring("ord", 1 + 3 * level, 3), 16, 10).cast("int")


def _spread(pos: Column) -> Column:
    """Bucket of a row among those of one id, which share their seeded order."""
    return F.pmod(F.xxhash64(pos), F.lit(TIES)).cast("int")


def _cut(rows: DataFrame, bucket: str, want: str) -> DataFrame:
    """Per source the bucket in which the running size passes ``want`` and
    what is still wanted from it; sources that need nothing have no row."""
    run = Window.partitionBy("sid").orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = rows.groupBy("sid", want, bucket).agg(F.sum("size").alias("s")).withColumn("run", F.sum("s").over(run))
    hit = sums.where((F.col("run") >= F.col(want)) & (F.col("run") - F.col("s") < F.col(want)))
    return hit.select("sid", F.col(bucket).alias("cut_" + bucket),
                      (F.col(want) - (F.col("run") - F.col("s"))).alias("rest_" + bucket))


def _sid(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def cuts(sized: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: its target, the whole repetitions, and the cell of
    the random order in which its fractional repetition ends."""
    plan = written(
        targets(sized, weights, max_epochs)
        .withColumn("words", F.round("target").cast("long"))
        .withColumn("whole", F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(F.lit(0)))
        .withColumn("want", F.col("words") - F.col("whole") * F.col("source_size"))
        .withColumn("sid", _sid(F.col("source"))), "mix-plan")
    rows = (sized.withColumn("sid", _sid(F.col("source")))
            .join(plan.where("want > 0").select("sid", "want"), "sid")
            .withColumn("b1", _bucket(0)).withColumn("b2", _bucket(1)))
    cut1 = written(_cut(rows, "b1", "want"), "mix-cut1")
    near = rows.join(cut1, "sid").where(F.col("b1") == F.col("cut_b1"))
    cut2 = written(_cut(near, "b2", "rest_b1"), "mix-cut2")
    # inside that cell: the place in the order, then the rows of that one id
    cell = rows.join(cut1, "sid").join(cut2, "sid").where((F.col("b1") == F.col("cut_b1")) & (F.col("b2") == F.col("cut_b2")))
    cell = written(cell.select("sid", "ord", "size", "pos", "rest_b2"), "mix-cell")
    cut3 = written(_cut(cell, "ord", "rest_b2"), "mix-cut3")
    ties = cell.join(cut3, "sid").where(F.col("ord") == F.col("cut_ord")).withColumn("b3", _spread(F.col("pos")))
    out = plan.select("sid", "source_size", "target", "whole")
    for cut in (cut1, cut2, cut3, _cut(ties, "b3", "rest_ord")):
        out = out.join(cut, "sid", "left")
    return written(out, "mix-cuts")


def _placed(rows: DataFrame, cut: DataFrame, sid: Column, ord_name: str) -> DataFrame:
    """``rows`` joined with their source's cut, with ``mix_side``: -1 taken
    once more, 0 in the cell of the cut, 1 not taken once more."""
    b1 = F.conv(F.substring(ord_name, 1, 3), 16, 10).cast("int")
    b2 = F.conv(F.substring(ord_name, 4, 3), 16, 10).cast("int")
    side = F.when(F.col("mix_cut_b3").isNull(), 1)
    for mine, cut_at in ((b1, "mix_cut_b1"), (b2, "mix_cut_b2"), (F.col(ord_name), "mix_cut_ord"), (_spread(F.col("pos")), "mix_cut_b3")):
        side = side.when(mine != F.col(cut_at), F.when(mine < F.col(cut_at), -1).otherwise(1))
    side = side.otherwise(0)
    cut = cut.select(*[F.col(c).alias("mix_" + c) for c in cut.columns])
    return rows.join(cut, sid == F.col("mix_sid")).withColumn("mix_side", side)


def _inside(placed: DataFrame) -> DataFrame:
    """Words taken of each document in a cut's cell, in the seeded order."""
    cell = Window.partitionBy("mix_sid").orderBy("size", "pos").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(cell), F.lit(0))
    return (placed.where("mix_side = 0").withColumn("before", before)
            .withColumn("part_words", F.greatest(F.lit(0), F.least(F.col("size"), F.col("mix_rest_b3") - F.col("before")))))


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``doc_id, source, size, source_size, target, whole, part_words, taken``:
    ``whole`` full repetitions of the document and then its first
    ``part_words`` words."""
    sized = written(sizes(docs), "mix-sizes")
    placed = _placed(sized, cuts(sized, weights, max_epochs), _sid(F.col("source")), "ord")
    outside = placed.where("mix_side <> 0").withColumn(
        "part_words", F.when(F.col("mix_side") < 0, F.col("size")).otherwise(F.lit(0)))
    cols = ["doc_id", "source", "size", F.col("mix_source_size").alias("source_size"),
            F.col("mix_target").alias("target"), F.col("mix_whole").cast("int").alias("whole"),
            F.col("part_words").cast("long").alias("part_words"),
            (F.col("mix_whole") * F.col("size") + F.col("part_words")).cast("long").alias("taken")]
    return outside.select(*cols).unionByName(_inside(placed).select(*cols))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix itself, with the columns of ``docs``: one row per repetition; a
    document taken in part keeps its first words, joined by one space.  The
    texts stay where they are: only per-source rows and the documents of the
    cut's cells meet them.

    Rows are told apart by their place in the input, which is read twice: it must
    come in the same order again, as files do."""
    sized = written(sizes(docs), "mix-sizes")
    cut = cuts(sized, weights, max_epochs)
    cell = written(_inside(_placed(sized, cut, _sid(F.col("source")), "ord"))
                   .select(F.col("pos").alias("cell_pos"), "part_words"), "mix-last")
    packed = docs.select(F.monotonically_increasing_id().alias("pos"), F.struct(*[quoted(c) for c in docs.columns]).alias("row"),
                         F.col("text").alias("mix_text"),
                         _order(F.col("doc_id")).alias("ord"), _sid(F.col("source").cast("string")).alias("own_sid"))
    placed = _placed(packed, cut, F.col("own_sid"), "ord").withColumn("mix_words", words(F.col("mix_text")))
    n = F.size("mix_words")
    outside = placed.where("mix_side <> 0").withColumn("part_words", F.when(F.col("mix_side") < 0, n.cast("long")).otherwise(F.lit(0)))
    inside = placed.where("mix_side = 0").join(
        cell, F.col("pos") == F.col("cell_pos"), "left")
    keep = ["row", "mix_words", F.coalesce("part_words", F.lit(0)).alias("part_words"), "mix_whole"]
    # at most max_epochs repetitions: -1 stands for the whole text
    reps = F.concat(F.expr("array_repeat(bigint(-1), int(mix_whole))"),
                    F.when((F.col("part_words") > 0) & (n > 0),
                           F.array(F.when(F.col("part_words") >= n, F.lit(-1)).otherwise(F.col("part_words")).cast("long")))
                    .otherwise(F.array().cast("array<bigint>")))
    taken = (outside.select(*keep).unionByName(inside.select(*keep)).where(n > 0)
             .select("row", "mix_words", F.explode(reps).alias("k")))
    part = F.array_join(F.slice("mix_words", F.lit(1), F.greatest(F.col("k"), F.lit(0)).cast("int")), " ")
    out = []
    for f in docs.schema.fields:
        c = F.col("row").getField(f.name)
        if f.name == "text":
            c = F.when(F.col("k") < 0, c).otherwise(part)
        elif f.name == "n_chars":
            c = F.when(F.col("k") < 0, c).otherwise(F.length(part).cast(f.dataType))
        out.append(c.alias(f.name))
    return taken.select(*out)

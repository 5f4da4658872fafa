"""Registered queries against their SQL, and the pipeline stage by stage."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import queries as llm
from strata.llm import quality, simhash
from tests.conftest import SF001
from tests.llm.test_operators import brute_fp, brute_hits, empty_docs, odd_docs, plain_ids


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = llm.queries()[name](spark, SF001)
    res = con.execute(llm.oracle_sql()[name])
    cols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(df.columns)
    pick = lambda names, r: repr([r[names.index(c)] for c in sorted(names)])
    assert sorted(pick(df.columns, tuple(r)) for r in df.collect()) == sorted(pick(cols, r) for r in res.fetchall())


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in llm.queries()] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    f = dict(corpus_pipeline.STAGES)
    good = f["quality rules"](spark, docs, SF001).cache()
    judged = {r.doc_id for r in quality.judge(docs).collect() if r.kept}
    assert {r.doc_id for r in good.collect()} == judged and good.columns == docs.columns
    apart = f["SimHash near-dedup"](spark, good, SF001).cache()
    roots = {r.component_id for r in simhash.cluster(good).collect()}
    assert sorted(r.doc_id for r in apart.collect()) == sorted(roots)
    fps = [brute_fp(r.text) for r in apart.collect()]
    assert all((a ^ b).bit_count() > 3 for i, a in enumerate(fps) for b in fps[:i])
    clean = f["benchmark decontamination"](spark, apart, SF001).cache()
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    rows = apart.collect()
    want = {r.doc_id for r, (_, hit, _) in zip(rows, brute_hits([r.text for r in rows], items)) if not hit}
    assert {r.doc_id for r in clean.collect()} == want
    mixed = f["mixing sources"](spark, clean, SF001).cache()
    assert mixed.columns == docs.columns
    out = f["token-ID output"](spark, mixed, SF001).collect()
    texts = [r.text for r in mixed.collect()]
    assert sum(r.n_tokens for r in out) == sum(map(len, plain_ids(texts))) and len(out) == len(texts)


@pytest.mark.parametrize("some", [True, False])
def test_pipeline_runs_on_odd_and_empty_documents(spark, tmp_dir, some):
    docs = odd_docs(spark) if some else empty_docs(spark)
    if some:  # and some that the quality rules keep, two of them near-duplicates, one of no id
        good = spark.read.parquet(f"{SF001}/documents.parquet")
        more = docs.columns[len(good.columns):]
        good = good.select("*", *[F.lit("x").alias(c) for c in more])
        docs = docs.unionByName(good).unionByName(good.limit(3).withColumn("doc_id", F.lit(None).cast("long")))
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    spark.read.parquet(f"{SF001}/benchmark.parquet").write.parquet(f"{tmp_dir}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_dir)).collect()
    if not some:
        assert out == []
        return
    stage = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    for name, f in corpus_pipeline.STAGES[:-1]:
        stage = f(spark, stage, str(tmp_dir)).cache()  # stages read their input more than once
        assert stage.columns == docs.columns, name
    texts = [r.text for r in stage.collect()]
    assert len(out) == len(texts) > 0 and sum(r.n_tokens for r in out) == sum(map(len, plain_ids(texts)))

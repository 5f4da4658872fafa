"""User aggregates with a state of several typed fields and a finishing step.

A user aggregate says, per column, what a state holds and how it is read::

    weighted_mean = UserAggregate(
        state={"w": Field("sum", lambda c: F.when(c.isNotNull(), F.col("qty"))),
               "wx": Field("sum", lambda c: c * F.col("qty"))},
        finish=lambda s: s["wx"] / s["w"])

    latest = UserAggregate(                         # the row with the largest (ts, id)
        state={"best": Field("max", lambda c: F.struct(F.col("ts"), F.col("id"), c.alias("value")))},
        finish=lambda s: s["best"]["value"])

``Field(merge, update, init)``: ``update`` turns a row into a value, ``init`` is the
state that has seen no value, ``merge`` combines values and states.  The merges
are Spark's own associative and commutative aggregates (``MERGES``), so a set of
user aggregates compiles to one ``groupBy(...).agg(...)`` with partial aggregation
on the map side and no Python per row.  Values keep their own types: big
integers, decimals, text, dates and structs come out as they went in.

``user_profile`` makes the *store*: one row per key, one struct column
``<column>:<name>`` per column and aggregate.  The merge of every field is written
into the columns' metadata, which Parquet keeps, so ``merge_user`` folds stores of
many runs without the definitions; ``rollup_user`` folds periods into coarser ones.
``finish_user`` reads the results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.metrics import cols, quote
from strata.functions.names import free_name, free_prefix
from strata.functions.periods import FREQ_KEY, as_wall_clock, parse_frequency, period_label
from strata.operators.profile import PERIOD_COLUMN, with_period

#: How a field's values (first) and its states (second) combine.
MERGES: dict[str, tuple[Callable[[Column], Column], Callable[[Column], Column]]] = {
    "sum": (F.sum, F.sum),
    "count": (F.count, F.sum),
    "min": (F.min, F.min),
    "max": (F.max, F.max),
    "every": (F.bool_and, F.bool_and),
    "any": (F.bool_or, F.bool_or),
    "bit_and": (F.bit_and, F.bit_and),
    "bit_or": (F.bit_or, F.bit_or),
    "bit_xor": (F.bit_xor, F.bit_xor),
    "distinct": (F.hll_sketch_agg, F.hll_union_agg),
}
MERGE_KEY = "strata.merge"


@dataclass(frozen=True)
class Field:
    """One field of a state: a merge of ``MERGES``, the row expression whose values
    it takes (nulls are no values), and the state before any value."""

    merge: str
    update: Callable[[Column], Column]
    init: object = None

    def __post_init__(self):
        if self.merge not in MERGES:
            raise ValueError(f"merge must be one of {sorted(MERGES)}, got {self.merge!r}")


@dataclass(frozen=True)
class UserAggregate:
    """``finish`` gets the state's fields by name; without it the result is the
    only field (or the whole struct)."""

    state: Mapping[str, Field]
    finish: Callable[[Mapping[str, Column]], Column] | None = None
    where: Callable[[Column], Column] | None = field(default=None)

    def __post_init__(self):
        if not self.state:
            raise ValueError("a user aggregate needs at least one field")


def state_name(column: str, aggregate: str) -> str:
    return f"{column}:{aggregate}"


def _started(state: Column, init: object) -> Column:
    return state if init is None else F.coalesce(state, F.lit(init))


def _combined(name: str, merges: Mapping[str, str], inits: Mapping[str, object]) -> tuple[Column, dict]:
    """The state column ``name`` over already stored states."""
    src = F.col(quote(name))
    parts = [_started(MERGES[m][1](src[f]), inits.get(f)).alias(f) for f, m in merges.items()]
    return F.struct(*parts).alias(name), {MERGE_KEY: {"fields": list(merges), "merges": list(merges.values())}}


def user_profile(df: DataFrame, aggregates: Mapping[str, UserAggregate], date_column: str | None = None,
                 freq: str = "D", *, by: str | Sequence[str] | None = None, columns: Iterable[str] | None = None,
                 unit: str | None = None, null_dates: str = "drop") -> DataFrame:
    """Store of user states per period and/or value of the ``by`` columns (or one
    row for all), one struct column per column and aggregate."""
    by_cols = [by] if isinstance(by, str) else list(by or [])
    names = list(columns) if columns is not None else [c for c in df.columns if c not in by_cols]
    missing = [c for c in [*names, *by_cols] if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns: {missing}")
    if PERIOD_COLUMN in by_cols:
        raise ValueError(f"rename the key column {PERIOD_COLUMN!r}")
    states = [state_name(c, a) for c in names for a in aggregates]
    if set(states) & {PERIOD_COLUMN, *by_cols}:
        raise ValueError("a key column has the name of a state")
    src, keys = df, list(by_cols)
    label = free_name(df.columns, "__period")
    if date_column is not None:
        src = with_period(src, date_column, freq, unit=unit, null_dates=null_dates, out=label)
        keys.insert(0, label)
    own = free_prefix(keys, "__")
    aggs, structs = [], []
    for i, c in enumerate(names):
        for j, (name, agg) in enumerate(aggregates.items()):
            value = F.col(quote(c))
            parts = []
            for k, (f, spec) in enumerate(agg.state.items()):
                x = spec.update(value)
                x = x if agg.where is None else F.when(agg.where(value), x)
                at = f"{own}{i}_{j}_{k}"
                aggs.append(_started(MERGES[spec.merge][0](x), spec.init).alias(at))
                parts.append(F.col(at).alias(f))
            merges = {f: s.merge for f, s in agg.state.items()}
            structs.append((state_name(c, name), F.struct(*parts),
                            {MERGE_KEY: {"fields": list(merges), "merges": list(merges.values())}}))
    wide = src.groupBy(*cols(keys)).agg(*aggs)
    named = [F.col(quote(k)).alias(PERIOD_COLUMN) if k == label else F.col(quote(k)) for k in keys]
    return wide.select(*named, *[s.alias(n, metadata=m) for n, s, m in structs])


def state_columns(store: DataFrame) -> dict[str, dict[str, str]]:
    """State columns of a store and the merge of each of their fields."""
    out = {}
    for f in store.schema.fields:
        if MERGE_KEY in (f.metadata or {}) and isinstance(f.dataType, T.StructType):
            meta = f.metadata[MERGE_KEY]
            out[f.name] = dict(zip(meta["fields"], meta["merges"]))
    return out


def merge_user(store: DataFrame, keys: Sequence[str] | None = None,
               aggregates: Mapping[str, UserAggregate] | None = None) -> DataFrame:
    """Fold the rows of a store that share ``keys`` (default: all columns that are
    no states).  ``aggregates`` is only needed to give fields without a value their
    ``init`` when there are no rows at all."""
    states = state_columns(store)
    if not states:
        raise ValueError("not a store of user states: no column tells how it merges")
    keys = list(keys) if keys is not None else [c for c in store.columns if c not in states]
    inits = {state_name(c, a): {f: s.init for f, s in agg.state.items()}
             for a, agg in (aggregates or {}).items() for c in {n.rpartition(":")[0] for n in states}}
    made = [_combined(n, merges, inits.get(n, {})) for n, merges in states.items()]
    out = store.groupBy(*cols(keys)).agg(*[c for c, _ in made])
    for n, (_, meta) in zip(states, made):
        out = out.withMetadata(n, meta)
    return out


def rollup_user(store: DataFrame, freq: str, *, anchor: str | None = None) -> DataFrame:
    """Fold the periods of a store into coarser ones, e.g. days into months."""
    at = store.schema[PERIOD_COLUMN]
    source = (at.metadata or {}).get(FREQ_KEY)
    if source is not None and not parse_frequency(source).nests_in(parse_frequency(freq)):
        raise ValueError(f"periods of {source!r} do not nest in periods of {freq!r}: profile the rows again")
    label = period_label(as_wall_clock(F.col(PERIOD_COLUMN), at.dataType), freq, anchor).cast("timestamp_ntz")
    states = state_columns(store)
    keys = [c for c in store.columns if c not in states]
    moved = store.withColumn(PERIOD_COLUMN, label).withMetadata(PERIOD_COLUMN, {} if anchor else {FREQ_KEY: freq})
    return merge_user(moved, keys=keys)


def finish_user(store: DataFrame, aggregates: Mapping[str, UserAggregate]) -> DataFrame:
    """The keys and one result column ``<column>:<name>`` per state, typed as its
    ``finish`` makes it."""
    states = state_columns(store)
    out = []
    for name, merges in states.items():
        agg = aggregates[name.rpartition(":")[2]]
        src = F.col(quote(name))
        fields = {f: F.hll_sketch_estimate(src[f]) if m == "distinct" else src[f] for f, m in merges.items()}
        if agg.finish is not None:
            value = agg.finish(fields)
        else:
            value = next(iter(fields.values())) if len(fields) == 1 else F.struct(*[v.alias(f) for f, v in fields.items()])
        out.append(value.alias(name))
    return store.select(*cols([c for c in store.columns if c not in states]), *out)


def finish_user_long(store: DataFrame, aggregates: Mapping[str, UserAggregate]) -> DataFrame:
    """Results as rows ``(keys..., column, metric, type, value)``; ``value`` is the
    result's text, so results of any types stand in one column."""
    done = finish_user(store, aggregates)
    states = list(state_columns(store))
    rows = []
    for name in states:
        c, _, metric = name.rpartition(":")
        kind = done.schema[name].dataType
        text = F.to_json(F.col(quote(name))) if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) \
            else F.col(quote(name)).cast("string")
        rows.append(F.struct(F.lit(c).alias("column"), F.lit(metric).alias("metric"),
                             F.lit(kind.simpleString()).alias("type"), text.alias("value")))
    return done.select(*cols([c for c in store.columns if c not in states]), F.inline(F.array(*rows)))

"""What the values of text columns are: mergeable counts per kind of value.

A column typed as text often holds numbers, dates or flags.  ``sniff`` counts, per
key and column, how many values read as a whole number, a fraction, a boolean, a
date (or timestamp) in ISO form, or other text; blank text is counted apart.  The
counts are user aggregates (``strata.operators.user_aggregates``), so stores merge
and roll up like profiles.  ``sniffed`` shows them with the kind that all values of
a column fit.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.metrics import cols, quote
from strata.operators.user_aggregates import Field, UserAggregate, state_columns, user_profile

# Patterns of a whole value, tried in this order.
PATTERNS = {
    "integral": r"^[+-]?[0-9]+$",
    "fractional": r"^[+-]?([0-9]+\.[0-9]*|\.[0-9]+|[0-9]+)([eE][+-]?[0-9]+)?$",
    "boolean": r"^([Tt]rue|TRUE|[Ff]alse|FALSE)$",
    "date": r"^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])"
            r"([ T]([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9](\.[0-9]{1,9})?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?$",
}
KINDS = ["blank", *PATTERNS, "text"]
NAME = "kinds"


def kind_of(value: Column) -> Column:
    """The kind of a text value (null for null); white space around it is ignored."""
    body = F.btrim(value, F.lit(" \t\n\x0b\f\r"))
    kind = F.when(value.isNull(), F.lit(None).cast("string")).when(body == "", F.lit("blank"))
    for name, pattern in PATTERNS.items():
        kind = kind.when(body.rlike(pattern), F.lit(name))
    return kind.otherwise(F.lit("text"))


COUNTS = UserAggregate({k: Field("sum", lambda c, k=k: (kind_of(c) == k).cast("bigint"), 0) for k in KINDS})


def sniff(df: DataFrame, date_column: str | None = None, freq: str = "D", *, by: str | Sequence[str] | None = None,
          columns: Iterable[str] | None = None, unit: str | None = None, null_dates: str = "drop") -> DataFrame:
    """Store of the counts of ``columns`` (default: all text columns)."""
    keys = [by] if isinstance(by, str) else list(by or [])
    names = list(columns) if columns is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in keys]
    return user_profile(df, {NAME: COUNTS}, date_column, freq, by=by, columns=names, unit=unit, null_dates=null_dates)


def sniffed(store: DataFrame) -> DataFrame:
    """``(keys..., column, blank, integral, fractional, boolean, date, text, fits)``: ``fits`` is
    the kind of all values that are not blank (whole numbers are fractions, too), ``text`` for
    mixtures, null without values."""
    states = state_columns(store)
    rows = [F.struct(F.lit(n.rpartition(":")[0]).alias("column"), *[F.col(quote(n))[k].alias(k) for k in KINDS]) for n in states]
    out = store.select(*cols([c for c in store.columns if c not in states]), F.inline(F.array(*rows)))
    count = {k: F.col(f"`{k}`") for k in KINDS}
    some = sum((count[k] for k in KINDS[2:]), count["integral"])
    fits = F.when(some == 0, F.lit(None).cast("string"))
    for k in ("integral", "boolean", "date"):
        fits = fits.when(count[k] == some, F.lit(k))
    fits = fits.when(count["integral"] + count["fractional"] == some, F.lit("fractional")).otherwise(F.lit("text"))
    return out.withColumn("fits", fits)

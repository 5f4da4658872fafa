"""Moments that merge by plain sums.

A partial row holds ``(n, mean, m2)``.  Its merge with others needs the sum of
``n * mean`` and of ``n * mean^2`` with far more than 53 bits, because the spread of
the means is what is left when almost everything cancels.  Both sums are kept
exactly, as whole numbers:

* means are dealt into *buckets* of ``SPAN`` binary orders of magnitude.  Inside a
  bucket every mean is a whole multiple ``a * 2**LIMB + b`` of one unit;
* ``limb_sums`` are five DECIMAL(38, 0) sums per bucket (``n a``, ``n b``, ``n a a``,
  ``n a b``, ``n b b``): they combine on the map side in any order, without rounding
  and at a fixed size, however many partial rows there are;
* ``with_bucket_moments`` turns a bucket's sums into ``(n, mean, m2)``: the squares are
  taken around the bucket's own mean in whole numbers, so nothing cancels;
* a group has at most ``MOST_BUCKETS`` buckets (usually one), folded by
  ``with_folded_moments`` around the merged mean (Chan, Golub, LeVeque 1979).

Means of zero and means that are not finite have buckets of their own.  The sums
hold for up to 10**16 values in a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = 16
LIMB = 35
MANTISSA = 53
# Buckets beyond every exponent of a double.
ZERO_BUCKET, ODD_BUCKET = -100, 100
MOST_BUCKETS = 2 * (1100 // SPAN) + 2

LIMB_SUMS = ["sum_a", "sum_b", "sum_aa", "sum_ab", "sum_bb", "sum_m2", "sum_odd"]

_PLAIN = f"({{own}}bucket > {ZERO_BUCKET} AND {{own}}bucket < {ODD_BUCKET})"
_SHIFT = f"({MANTISSA} - {SPAN} * {{own}}bucket)"


def _times_power(x: str, k: str) -> str:
    """``x * 2**k`` in two exact steps (``2**k`` alone may leave the range)."""
    return f"({x} * pow(2D, shiftright({k}, 1)) * pow(2D, {k} - shiftright({k}, 1)))"


def _whole(x: str) -> str:
    return f"cast({x} AS decimal(38,0))"


def _steps(df: DataFrame, own: str, steps: dict[str, str]) -> DataFrame:
    """``df`` and the named SQL expressions, each of which may use those before it
    (one projection each for the optimizer, one call for the driver)."""
    return df.selectExpr("*", *[f"{sql} AS {name}".replace("{own}", own) for name, sql in steps.items()])


def with_limbs(df: DataFrame, own: str) -> DataFrame:
    """``df`` (with ``mom_n``, ``mom_mean``, ``mom_m2``) and, under names that begin
    with ``own``, the bucket of each partial row and its mean's two limbs.  The
    bucket is null where a row has no values."""
    return _steps(df, own, {
        "{own}bucket": f"CASE WHEN mom_n > 0 THEN CASE WHEN isnan(mom_mean) OR abs(mom_mean) = double('inf') THEN {ODD_BUCKET} "
                       f"WHEN mom_mean = 0 THEN {ZERO_BUCKET} ELSE cast(floor(log2(abs(mom_mean)) / {SPAN}) AS int) END END",
        "{own}scaled": f"CASE WHEN {_PLAIN} THEN {_times_power('mom_mean', _SHIFT)} ELSE 0D END",
        "{own}high": f"floor({{own}}scaled / {2 ** LIMB}D)",
        "{own}a": "cast({own}high AS decimal(12,0))",
        "{own}b": f"cast(cast({{own}}scaled - {{own}}high * {2 ** LIMB}D AS bigint) AS decimal(12,0))"})


def limb_sums(own: str) -> list[Column]:
    """Aggregates over the partial rows of one bucket."""
    a, b, w = f"{own}a", f"{own}b", "cast(mom_n AS decimal(18,0))"
    sums = [_whole(f"{w} * {a}"), _whole(f"{w} * {b}"), *[_whole(f"{_whole(xy)} * {w}") for xy in (f"{a} * {a}", f"{a} * {b}", f"{b} * {b}")],
            "CASE WHEN isnan(mom_m2) THEN double('inf') ELSE mom_m2 END",
            f"CASE WHEN {own}bucket = {ODD_BUCKET} THEN mom_mean END"]
    return [F.expr(f"sum({x}) AS {own}{name}") for name, x in zip(LIMB_SUMS, sums)]


def with_bucket_moments(df: DataFrame, own: str) -> DataFrame:
    """``df`` (buckets with their ``limb_sums`` and ``mom_n`` values) and the struct
    ``{own}part`` of ``(mom_n, mom_mean, mom_m2)``."""
    w, limb = "cast(nullif(mom_n, 0) AS decimal(18,0))", f"cast({2 ** LIMB} AS decimal(12,0))"

    def around(square: str, p: str, sq: str, q: str, sp: str) -> str:
        square, p, sq, q, sp = ("{own}" + x for x in (square, p, sq, q, sp))
        one, two, three = _whole(f"{p} * {sq}"), _whole(f"{q} * {sp}"), _whole(f"{_whole(f'{p} * {q}')} * {w}")
        return _whole(f"{_whole(f'{_whole(f'{square} - {one}')} - {two}')} + {three}")

    exact = (f"try_add(try_add(try_multiply({{own}}aa, cast({2 ** (2 * LIMB)} AS decimal(38,0))), "
             f"try_multiply({{own}}ab, cast({2 ** (LIMB + 1)} AS decimal(38,0)))), {{own}}bb)")
    rough = (f"cast({{own}}aa AS double) * {2 ** (2 * LIMB)}D + cast({{own}}ab AS double) * {2 ** (LIMB + 1)}D "
             "+ cast({own}bb AS double)")
    back = f"(-{_SHIFT})"
    return _steps(df, own, {
        "{own}total": _whole(f"{_whole('{own}sum_a * ' + limb)} + {{own}}sum_b"),
        "{own}middle": _whole(f"floor({{own}}total / {w})"),  # near the mean; any whole number would do
        "{own}pa": f"cast(floor({{own}}middle / {limb}) AS decimal(12,0))",
        "{own}pb": f"cast({{own}}middle - {_whole('{own}pa * ' + limb)} AS decimal(12,0))",
        "{own}left": f"cast({{own}}total - {_whole('{own}middle * ' + w)} AS double)",
        "{own}aa": around("sum_aa", "pa", "sum_a", "pa", "sum_a"),
        "{own}ab": around("sum_ab", "pa", "sum_b", "pb", "sum_a"),
        "{own}bb": around("sum_bb", "pb", "sum_b", "pb", "sum_b"),
        "{own}between": f"greatest(coalesce(cast({exact} AS double), {rough}) - {{own}}left * {{own}}left / nullif(mom_n, 0), 0D)",
        "{own}part":
            f"CASE WHEN {{own}}bucket IS NOT NULL THEN struct(mom_n AS mom_n, CASE WHEN {_PLAIN} THEN "
            f"{_times_power('(cast({own}middle AS double) + {own}left / nullif(mom_n, 0))', back)} "
            f"WHEN {{own}}bucket = {ODD_BUCKET} THEN {{own}}sum_odd ELSE 0D END AS mom_mean, "
            f"CASE WHEN {_PLAIN} THEN {{own}}sum_m2 + {_times_power(_times_power('{own}between', back), back)} "
            "ELSE {own}sum_m2 END AS mom_m2) END"})


def with_folded_moments(df: DataFrame, own: str) -> DataFrame:
    """``df`` with ``{own}mean`` and ``{own}m2`` from the array ``{own}parts``, in the
    array's order."""
    # a sum of squares: NaN can only come from overflowed means (inf - inf), i.e.
    # the variance overflowed, which a direct pass reports as +inf
    return _steps(df, own, {
        "{own}mean": "CASE WHEN size({own}parts) = 1 THEN {own}parts[0].mom_mean WHEN mom_n > 0 THEN "
                     "aggregate({own}parts, 0D, (t, p) -> t + p.mom_n * p.mom_mean) / mom_n END",
        "{own}spread": "CASE WHEN size({own}parts) = 1 THEN {own}parts[0].mom_m2 WHEN size({own}parts) > 0 THEN "
                       "aggregate({own}parts, 0D, (t, p) -> t + p.mom_m2 + p.mom_n * pow(p.mom_mean - {own}mean, 2)) END",
        "{own}m2": "CASE WHEN isnan({own}spread) THEN double('inf') ELSE {own}spread END"})

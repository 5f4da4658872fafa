"""Compaction of a history: many stores folded into one per period.

A history is a folder of *units*, the stores that runs (``run=<id>``, see
``write_run``) or stream panes (``pane=<id>``) have added.  A unit counts once it is
whole, that is when Spark has put its ``_SUCCESS`` file there (its default).  Reading it merges all of
them, so its cost grows with the number of units.  ``compact`` folds units into
*base* stores, one row per key, period and column, and keeps that fast:

* only the months that the new units touch are folded again (their base and the
  new rows); the other months' bases stay as they are;
* new bases are written beside the old ones, and a *manifest* then names, month
  by month, the base to read and, one by one, the units that are in them.  The
  manifest is a small file ``_history/<version>.json`` that is renamed into place
  and never changed.  Until then readers use the version before, so a compaction
  that dies leaves the history as it was; of two compactions at once one wins and
  the other raises ``Conflict``;
* ``read_history`` takes the newest manifest, its bases and all units it does not
  name; ``start`` and ``end`` leave out whole months before any file is opened;
* ``vacuum`` deletes what no kept version reads: bases of older versions and of
  compactions that died, and units that are folded.

Profiles cannot be subtracted from a base.  A run that is folded can therefore not
be replaced (``write_run`` refuses); ``revert`` goes back to an older version,
whose units are still there until ``vacuum``.  The newest unit of a stream may be
written once more after a restart, so ``keep_newest`` units stay unfolded.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.merge import merge_profiles
from strata.operators.profile import PERIOD_COLUMN
from strata import files
from strata.sinks import manifest
from strata.sinks.manifest import Conflict, Manifest
from strata.sinks.writers import RUN_COLUMN, between, directory_columns

__all__ = ["Conflict", "History", "Manifest", "compact", "read_history"]

BASES = "_base"
_MONTH = "month"
#: Month of rows without a period: before all others.
NO_MONTH = "0000-00"


def _month() -> Column:
    return F.coalesce(F.date_format(PERIOD_COLUMN, "yyyy-MM"), F.lit(NO_MONTH))


class History:
    """The history in ``path`` whose units are directories ``<unit>=<id>``.  Key
    columns ``drop`` are left out before anything is merged."""

    def __init__(self, spark: SparkSession, path: str, unit: str = RUN_COLUMN, drop: Sequence[str] = ()):
        self.spark, self.path, self.unit, self.drop = spark, path.rstrip("/"), unit, tuple(drop)

    # -------------------------------------------------------------- versions

    def versions(self) -> list[int]:
        return manifest.versions(self.spark, self.path)

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest version, or the given one; version 0 has no bases."""
        return manifest.load(self.spark, self.path, version)

    def _commit(self, m: Manifest) -> Manifest:
        return manifest.commit(self.spark, self.path, m)

    # ----------------------------------------------------------------- units

    def units(self) -> list[str]:
        """Whole units, in order of their ids (numbers as numbers)."""
        names = [n for n in files.children(self.spark, self.path) if n.startswith(f"{self.unit}=")]
        whole = [n for n in names if files.exists(self.spark, f"{self.path}/{n}/_SUCCESS")]
        key = lambda n: n.partition("=")[2]
        return sorted(whole, key=lambda n: (0, int(key(n)), "") if key(n).isdigit() else (1, 0, key(n)))

    def _unit_rows(self, names: list[str], start: str | None = None, end: str | None = None) -> list[DataFrame]:
        names = [n for n in names if any(c[0] not in "_." for c in files.children(self.spark, f"{self.path}/{n}"))]
        if not names:  # no unit, or only units without rows
            return []
        df = self.spark.read.option("basePath", self.path).parquet(*[f"{self.path}/{n}" for n in names])
        return [between(df, start, end).drop(*directory_columns(df), *self.drop)]

    def _base_rows(self, m: Manifest, months: list[str]) -> list[DataFrame]:
        if not months:
            return []
        return [self.spark.read.parquet(*[f"{self.path}/{BASES}/{m.bases[k]}/{_MONTH}={k}" for k in months])]

    # --------------------------------------------------------------- reading

    def read(self, start: str | None = None, end: str | None = None, version: int | None = None) -> DataFrame:
        """The history merged: one row per key, period and column.  ``start`` and
        ``end`` are months (``yyyy-MM``)."""
        return merge_profiles(self.rows(start, end, version))

    def rows(self, start: str | None = None, end: str | None = None, version: int | None = None) -> DataFrame:
        """The rows that ``read`` merges: of the bases and of the units since."""
        if not all(b is None or re.fullmatch(r"\d{4}-\d{2}", b) for b in (start, end)):
            raise ValueError("start and end are months like '2024-05'")
        m = self.manifest(version)
        months = [k for k in m.bases if (start is None or k >= start) and (end is None or k <= end)]
        rest = [n for n in self.units() if n not in m.folded]
        parts = self._base_rows(m, months) + self._unit_rows(rest, start, end)
        if not parts and m.bases:  # no month within the bounds: an empty store
            parts = [self._base_rows(m, list(m.bases)[:1])[0].where(F.lit(False))]
        if not parts:
            raise ValueError(f"nothing to read in {self.path}")
        rows = reduce(lambda a, b: a.unionByName(b), parts)
        if start is not None or end is not None:  # units without month directories
            rows = rows.where((_month() >= F.lit(start or "")) & (_month() <= F.lit(end or "9999-99")))
        return rows

    # ------------------------------------------------------------ compaction

    def compact(self, keep_newest: int = 0, before_commit: Callable[[], None] | None = None) -> Manifest:
        """Fold all but the ``keep_newest`` last units; returns the new version
        (the same one if there is nothing to fold).  ``before_commit`` runs between
        the writing of the bases and the manifest."""
        m = self.manifest()
        new = [n for n in self.units() if n not in m.folded]
        new = new[:len(new) - keep_newest] if keep_newest else new
        if not new:
            return m
        found = self._unit_rows(new)
        if not found:
            return self._commit(Manifest(m.version + 1, m.bases, m.folded | set(new)))
        rows = found[0]
        # one short text per calendar month: bounded by the history's length
        touched = sorted(r.m for r in rows.select(_month().alias("m")).distinct().collect())
        parts = [rows, *self._base_rows(m, [k for k in touched if k in m.bases])]
        folded = merge_profiles(reduce(lambda a, b: a.unionByName(b), parts))
        folder = uuid.uuid4().hex
        (folded.withColumn(_MONTH, _month()).hint("rebalance", _MONTH).sortWithinPartitions(_MONTH, PERIOD_COLUMN, "column")
         .write.partitionBy(_MONTH).parquet(f"{self.path}/{BASES}/{folder}"))
        if before_commit is not None:
            before_commit()
        return self._commit(Manifest(m.version + 1, {**m.bases, **dict.fromkeys(touched, folder)}, m.folded | set(new)))

    def revert(self, version: int) -> Manifest:
        """A new version that reads what ``version`` read."""
        old = self.manifest(version)
        lost = [n for n in self.manifest().folded - old.folded if n not in self.units()]
        gone = {f for f in old.bases.values() if not files.exists(self.spark, f"{self.path}/{BASES}/{f}")}
        if lost or gone:
            raise ValueError(f"version {version} cannot come back: vacuum has deleted {sorted(lost) or sorted(gone)}")
        return self._commit(Manifest(self.manifest().version + 1, old.bases, old.folded))

    def vacuum(self, keep_versions: int = 1) -> list[str]:
        """Delete what the ``keep_versions`` newest versions do not read; returns the
        deleted folders.  Run it when no reader is at work on an older version and no
        compaction is running."""
        if keep_versions < 1:
            raise ValueError("keep_versions must be >= 1")
        kept = [self.manifest(v) for v in self.versions()[-keep_versions:]] or [Manifest()]
        used = {f for m in kept for f in m.bases.values()}
        folded = frozenset.intersection(*[m.folded for m in kept])
        gone = [f"{BASES}/{f}" for f in files.children(self.spark, f"{self.path}/{BASES}") if f not in used]
        gone += [n for n in self.units() if n in folded]
        for name in gone:
            files.delete(self.spark, f"{self.path}/{name}")
        return gone


def read_history(spark: SparkSession, path: str, start: str | None = None, end: str | None = None, *,
                 unit: str = RUN_COLUMN) -> DataFrame:
    return History(spark, path, unit).read(start, end)


def compact(spark: SparkSession, path: str, *, unit: str = RUN_COLUMN, keep_newest: int = 0) -> Manifest:
    return History(spark, path, unit).compact(keep_newest)

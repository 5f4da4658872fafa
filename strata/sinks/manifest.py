"""The manifest of a history: which folders a version reads.

A manifest is a small file ``_history/<version>.json`` that is renamed into place and
never changed, so a reader sees a whole version or the one before.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from strata import files

MANIFESTS = "_history"


class Conflict(RuntimeError):
    """Another compaction has written the version that this one wanted to."""


@dataclass(frozen=True)
class Manifest:
    """What a version of a history reads: the base folder of every month (folders
    hold ``month=yyyy-MM`` directories) and the units folded into them."""

    version: int = 0
    bases: dict[str, str] = field(default_factory=dict)
    folded: frozenset[str] = frozenset()

    def text(self) -> str:
        return json.dumps({"version": self.version, "bases": self.bases, "folded": sorted(self.folded)}, indent=1)

    @staticmethod
    def parse(text: str) -> Manifest:
        d = json.loads(text)
        return Manifest(d["version"], d["bases"], frozenset(d["folded"]))


def versions(spark: SparkSession, path: str) -> list[int]:
    names = files.children(spark, f"{path}/{MANIFESTS}")
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def load(spark: SparkSession, path: str, version: int | None = None) -> Manifest:
    """The newest version, or the given one; version 0 has no bases."""
    have = versions(spark, path)
    version = (have[-1] if have else 0) if version is None else version
    if version == 0:
        return Manifest()
    if version not in have:
        raise ValueError(f"no version {version} of {path}")
    return Manifest.parse(files.read_text(spark, f"{path}/{MANIFESTS}/{version}.json"))


def commit(spark: SparkSession, path: str, m: Manifest) -> Manifest:
    at = f"{path}/{MANIFESTS}/{m.version}.json"
    if not files.write_new(spark, at, m.text(), f"{path}/{MANIFESTS}/_{uuid.uuid4().hex}.tmp"):
        raise Conflict(f"version {m.version} of {path} was written meanwhile")
    return m

"""Helpers shared by the operators: tables, written intermediates, word
expressions and NumPy views of Arrow text columns."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import strata
from strata.session import checkpoint_root

# The ASCII white space that separates words.
SPACE_CHARS = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]+"

# Bytes of text that a Python task looks at in one NumPy pass.
SLICE_BYTES = 2 << 20


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers (once per application), so that
    they can import it wherever the driver found it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(strata.__file__).parent
    out = Path(tempfile.mkdtemp(prefix="strata-package-")) / "strata_package.zip"
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    sc.addPyFile(str(out))
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{tag}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, read often, and
    still there when an executor is lost."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def words(text: Column) -> Column:
    """Words between ASCII white space, in order; null or blank text: none."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, SPACE_CLASS))


def byte_slices(col: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices ``(first row, end row, bytes, offsets)`` of a text column, each of
    about ``most`` bytes (a longer single text is a slice of its own).  Null
    texts have no bytes."""
    n = len(col)
    if n == 0:
        return
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], np.int64)[col.offset:col.offset + n + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + most, "right")) - 1)
        yield a, b, data[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand:
    a polynomial hash of any range then takes two look-ups in prefix sums."""

    def __init__(self, base: int):
        self.base = base % 2**64
        self.inverse = pow(self.base, -1, 2**64)
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n + 1:
            size = max(n + 1, 2 * len(self.up), 1 << 16)
            with np.errstate(over="ignore"):
                for name, base in (("up", self.base), ("down", self.inverse)):
                    arr = np.full(size, np.uint64(base), np.uint64)
                    arr[0] = 1
                    setattr(self, name, np.cumprod(arr))
        return self.up, self.down


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the whole word."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(32))
        h = h * np.uint64(0xD6E8FEB86659FD93)
        h = h ^ (h >> np.uint64(32))
        h = h * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


_BYTES = Powers(0x9E3779B97F4A7C15)
_SYMBOL = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, words before each text)`` of the maximal runs of word
    bytes; a run never crosses from one text into the next."""
    inside = is_word[data]
    n = len(data)
    begin = np.zeros(n + 1, bool)
    begin[:n] = inside
    begin[1:n] &= ~inside[:-1]
    end = np.zeros(n + 1, bool)
    end[1:] = inside
    end[1:n] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    cut = edges[inside[edges] & inside[edges - 1]]
    begin[cut] = True
    end[cut] = True
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end)
    return starts, ends, np.searchsorted(starts, offsets, "left")


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    up, down = _BYTES.upto(len(data) + 1)
    with np.errstate(over="ignore"):
        pre = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_SYMBOL[data] * up[:len(data)], out=pre[1:])
        return mix64((pre[ends] - pre[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The concatenated ranges ``starts[i], starts[i]+1, ...`` of ``counts[i]``."""
    total = int(counts.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    first = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(starts - first, counts)


def arrow_schema(df: DataFrame, extra: dict[str, str]):
    """Spark schema of ``df`` plus the columns ``extra`` (name -> DDL type)."""
    from pyspark.sql import types as T

    out = T.StructType(list(df.schema.fields))
    for name, ddl in extra.items():
        out = out.add(name, T._parse_datatype_string(ddl), True)
    return out

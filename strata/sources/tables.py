"""Inputs: tables, SQL queries, files and in-memory records.

``read_input`` replaces the reference's table-or-query switch with explicit
arguments; a single string is only taken as a table when the *whole* string is
a dotted identifier (optionally ``project:dataset.table``), so SQL text such as
``select 'a:b' from ds.t`` is never mistaken for a table.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import files
from strata.functions.metrics import quote
from strata.functions.names import free_name

_IDENT = r"[A-Za-z_][A-Za-z0-9_]*"
# [catalog.][database.]table, or project:dataset.table; no spaces, quotes or operators.
_TABLE_RE = re.compile(rf"(?:{_IDENT}\.){{0,2}}{_IDENT}|[A-Za-z0-9_-]+:{_IDENT}\.{_IDENT}")


def is_table_reference(text: str) -> bool:
    return _TABLE_RE.fullmatch(text.strip()) is not None


def _table_name(ref: str) -> str:
    ref = ref.strip()
    if ":" in ref:
        project, rest = ref.split(":", 1)
        return ".".join(f"`{p}`" for p in [project, *rest.split(".")])
    return ref


def read_input(spark: SparkSession, spec: str | None = None, *, table: str | None = None,
               query: str | None = None, path: str | None = None, format: str = "parquet",
               options: dict[str, str] | None = None,
               schema: T.StructType | str | None = None) -> DataFrame:
    """Resolve one input.

    * ``table=`` -- a catalog table or temp view (``spark.table``);
    * ``query=`` -- SQL over registered views (``spark.sql``);
    * ``path=``  -- files of any Spark ``format`` (``parquet``, ``csv``, ``json``,
      ``orc``, or a connector's format name with its ``options``);
    * ``spec``   -- a single string: a table if it is a full identifier, else SQL.
    """
    given = [x is not None for x in (spec, table, query, path)]
    if sum(given) != 1:
        raise ValueError("give exactly one of spec, table=, query=, path=")
    if spec is not None:
        if is_table_reference(spec):
            table = spec
        else:
            query = spec
    if table is not None:
        return spark.table(_table_name(table))
    if query is not None:
        return spark.sql(query)
    reader = spark.read.format(format).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def table_path(directory: str, name: str) -> str:
    return os.path.join(directory, f"{name}.parquet")


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(directory, name))


def register_tables(spark: SparkSession, directory: str,
                    names: Iterable[str] | None = None) -> list[str]:
    """Register each ``<name>.parquet`` under ``directory`` as a temp view.

    The directory may lie in any store that Spark reads.  Only footers are read
    here (schema); the data is scanned by the queries.
    """
    wanted = set(names) if names is not None else None
    done = []
    for entry in files.children(spark, directory):
        name = entry.removesuffix(".parquet")
        if name != entry and (wanted is None or name in wanted):
            spark.read.parquet(table_path(directory, name)).createOrReplaceTempView(name)
            done.append(name)
    return done


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True, **options: str) -> DataFrame:
    """CSV with a header.  Pass ``schema``: inference reads the data twice and
    turns all-empty columns into strings."""
    reader = spark.read.option("header", header).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def from_records(spark: SparkSession, rows: Sequence[dict], schema: T.StructType | str) -> DataFrame:
    """Small in-memory records (tests, fixtures) -> DataFrame with a fixed schema."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def enforce_schema(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Reorder, up-cast and check columns against ``schema`` (``DataFrame.to``);
    fails at analysis time when a column is missing or cannot be cast safely."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the input: {missing}")
    return df.to(schema)


def checked_rows(df: DataFrame, schema: T.StructType | str) -> tuple[DataFrame, str]:
    """``df`` with an array of reasons for which a row does not fit ``schema`` (empty:
    it fits), and that column's name.

    Reasons are ``null:<column>`` (no value in a field that must have one),
    ``cast:<column>`` (the value is not one of the type: text that does not parse, a
    number out of range) and ``inexact:<column>`` (a number that the type would round).
    """
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    kinds = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in kinds]
    if missing:
        raise ValueError(f"columns missing from the input: {missing}")
    why = []
    for f in schema.fields:
        c = F.col(quote(f.name))
        cast = c.try_cast(f.dataType)
        if kinds[f.name] != f.dataType:
            why.append(F.when(c.isNotNull() & cast.isNull(), F.lit(f"cast:{f.name}")))
            if isinstance(kinds[f.name], T.NumericType) and isinstance(f.dataType, T.NumericType):
                back = cast.try_cast(kinds[f.name])
                why.append(F.when(cast.isNotNull() & ~back.eqNullSafe(c), F.lit(f"inexact:{f.name}")))
        if not f.nullable:
            why.append(F.when(c.isNull(), F.lit(f"null:{f.name}")))
    name = free_name(df.columns, "reasons")
    found = F.array_compact(F.array(*why)) if why else F.array().cast("array<string>")
    return df.withColumn(name, found), name


def split_rows(df: DataFrame, schema: T.StructType | str, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows that fit ``schema``, typed by it, and the rejected ones as they came with
    their ``reasons``.  With ``folder`` the input is read once: the checked rows are
    written there, the two kinds in directories of their own, and both results read
    them."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    rows, why = checked_rows(df, schema)
    fits = free_name(rows.columns, "fits")
    rows = rows.withColumn(fits, F.size(why) == 0)
    if folder is not None:
        rows.write.partitionBy(fits).parquet(folder)
        rows = df.sparkSession.read.schema(rows.schema).parquet(folder)
    good = rows.where(F.col(fits)).select(*[F.col(quote(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])
    return good, rows.where(~F.col(fits)).drop(fits)

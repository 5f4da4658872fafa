import duckdb
import pytest

from strata.functions.metrics import type_class
from strata.plans.catalog import oracle_sql, queries
from strata.plans.oracle import TABLE_COLUMNS
from tests.conftest import SF001

ROWS_ONLY = {"profile_size"}


def test_table_columns_match_parquet(spark):
    for table, cols in TABLE_COLUMNS.items():
        df = spark.read.parquet(f"{SF001}/{table}.parquet")
        assert [(f.name, type_class(f.dataType)) for f in df.schema.fields] == cols, table


def test_every_query_has_sql_unless_rows_only():
    assert set(queries()) - set(oracle_sql()) == ROWS_ONLY
    assert set(oracle_sql()) <= set(queries())


def _duck():
    con = duckdb.connect()
    for t in TABLE_COLUMNS:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def _norm(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, name):
    df = queries()[name](spark, SF001)
    got = [tuple(r) for r in df.collect()]
    if name in ROWS_ONLY:
        assert len(got) > 0
        return
    res = _duck().execute(oracle_sql()[name])
    want = res.fetchall()
    cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _norm(df.columns, got) == _norm(cols, want)

"""Exact SQL (DuckDB dialect) for the deterministic part of each query.

These strings are the independent check of the Spark plans: the same tables,
the same labels, the same exact metrics, computed by a different engine.
"""

from __future__ import annotations

from strata.functions.periods import _UNIT_MICROS, parse_frequency

# Type class of every column of the test tables (checked against
# the parquet schemas in tests/test_catalog.py).
TABLE_COLUMNS: dict[str, list[tuple[str, str]]] = {
    "lineitem": [("l_orderkey", "integral"), ("l_partkey", "integral"), ("l_suppkey", "integral"),
                 ("l_linenumber", "integral"), ("l_quantity", "fractional"),
                 ("l_extendedprice", "fractional"), ("l_discount", "fractional"),
                 ("l_tax", "fractional"), ("l_returnflag", "string"), ("l_linestatus", "string"),
                 ("l_shipdate", "datetime")],
    "orders": [("o_orderkey", "integral"), ("o_custkey", "integral"), ("o_orderstatus", "string"),
               ("o_totalprice", "fractional"), ("o_orderdate", "datetime"),
               ("o_orderpriority", "string")],
    "events": [("event_id", "integral"), ("ts", "datetime"), ("user_id", "integral"),
               ("event_type", "string"), ("value", "fractional"), ("props", "string")],
    "customer": [("c_custkey", "integral"), ("c_name", "string"), ("c_nationkey", "integral"),
                 ("c_acctbal", "fractional"), ("c_mktsegment", "string")],
    "part": [("p_partkey", "integral"), ("p_name", "string"), ("p_brand", "string"),
             ("p_type", "string"), ("p_size", "integral"), ("p_retailprice", "fractional")],
    "supplier": [("s_suppkey", "integral"), ("s_name", "string"), ("s_nationkey", "integral"),
                 ("s_acctbal", "fractional")],
    "documents": [("doc_id", "integral"), ("text", "string"), ("lang", "string"),
                  ("source", "string"), ("n_chars", "integral")],
    "embeddings": [("vec_id", "integral"), ("embedding", "object"), ("label", "integral")],
    "labels": [("doc_id", "integral"), ("quality", "integral"), ("toxic", "integral")],
    "pages": [("page_id", "integral"), ("url", "string"), ("html", "string")],
    "conversations": [("conv_id", "integral"), ("turn", "integral"), ("role", "string"),
                      ("text", "string")],
    "benchmark": [("item_id", "integral"), ("text", "string")],
    "nation": [("n_nationkey", "integral"), ("n_name", "string"), ("n_regionkey", "integral")],
    "region": [("r_regionkey", "integral"), ("r_name", "string")],
}


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def label_sql(freq: str, col: str) -> str:
    """DuckDB text label of ``col`` (a TIMESTAMP) at ``freq``."""
    f = parse_frequency(freq)
    c = q(col)
    d = f"CAST({c} AS DATE)"
    u, n = f.unit, f.n
    month_start = f"CAST(date_trunc('month', {c}) AS DATE)"
    if u in _UNIT_MICROS:
        if u == "D" and n == 1:
            expr = d
        else:
            w = n * _UNIT_MICROS[u]
            expr = f"make_timestamp(CAST(floor(epoch_us({c}) / {w}) AS BIGINT) * {w})"
            if u == "D":
                expr = f"CAST({expr} AS DATE)"
    elif u == "W":
        t = f.weekday
        end = f"({d} + CAST(((({t} - (isodow({c}) - 1)) % 7) + 7) % 7 AS INTEGER))"
        if n == 1:
            expr = end
        else:
            first_end = f"(DATE '1970-01-01' + CAST(((({t} - 3) % 7) + 7) % 7 AS INTEGER))"
            k = f"(({end} - {first_end}) / 7)"
            expr = f"({first_end} + CAST(-{7 * n} * floor(-{k} / {n}) AS INTEGER))"
    elif f.months:
        # the list of all labels of the unit from 1969 on, and the first (or
        # last) of them on the label's side of the day
        step, base = f.months, f.months // n
        k0 = f.month % base - step * (-(-12 // step))
        first = f"CAST(DATE '1970-01-01' + to_months(CAST({k0} + {step} * i AS INTEGER)) AS DATE)"
        if u.endswith("S"):
            shift = f" + CAST(CASE isodow({first}) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END AS INTEGER)" if u[0] == "B" else ""
            expr = f"list_max(list_filter([{first}{shift} for i in range({1200 // step})], lambda x: x <= {d}))"
        else:
            last = f"last_day({first})"
            shift = f" - CAST(greatest(isodow({last}) - 5, 0) AS INTEGER)" if u[0] == "B" else ""
            expr = f"list_min(list_filter([{last}{shift} for i in range({1200 // step})], lambda x: x >= {d}))"
    elif u == "B":
        expr = f"({d} - CAST(CASE isodow({c}) WHEN 6 THEN 1 WHEN 7 THEN 2 ELSE 0 END AS INTEGER))"
    elif u == "SM":
        expr = (f"(CASE WHEN {d} = last_day({c}) THEN last_day({c}) "
                f"WHEN day({c}) >= 15 THEN {month_start} + 14 ELSE {month_start} - 1 END)")
    elif u == "SMS":
        expr = f"(CASE WHEN day({c}) >= 15 THEN {month_start} + 14 ELSE {month_start} END)"
    else:  # pragma: no cover - parse_frequency rejects the rest
        raise ValueError(freq)
    fmt = "%Y-%m-%d %H:%M:%S" + {"L": ".%g", "U": ".%f"}.get(u, "") if f.sub_day else "%Y-%m-%d"
    return f"strftime({expr}, '{fmt}')"


def _column_select(name: str, tc: str, key_sql: list[tuple[str, str]], source: str,
                   where: str | None, digits: int) -> str:
    c = q(name)
    null_b, null_d, null_s = "CAST(NULL AS BIGINT)", "CAST(NULL AS DOUBLE)", "CAST(NULL AS VARCHAR)"
    nan = inf = "CAST(0 AS BIGINT)"
    min_i = max_i = null_b
    min_d = max_d = null_d
    min_s = max_s = null_s
    x = None
    if tc == "integral":
        min_i, max_i = f"CAST(min({c}) AS BIGINT)", f"CAST(max({c}) AS BIGINT)"
        x = f"CAST({c} AS DOUBLE)"
    elif tc == "fractional":
        nan = f"count(*) FILTER (WHERE isnan({c}))"
        inf = f"count(*) FILTER (WHERE isinf({c}))"
        min_d = f"min({c}) FILTER (WHERE NOT isnan({c}))"
        max_d = f"max({c}) FILTER (WHERE NOT isnan({c}))"
        x = f"CASE WHEN isfinite({c}) THEN CAST({c} AS DOUBLE) END"
    elif tc == "string":
        min_s, max_s = f"min({c})", f"max({c})"
        x = f"CAST(length({c}) AS DOUBLE)"
    elif tc == "datetime":
        min_i, max_i = f"min(epoch_us({c}))", f"max(epoch_us({c}))"
    total = f"round(sum({x}), 2)" if x else null_d
    std = f"round(stddev_pop({x}), {digits})" if x else null_d
    keys = [f"{expr} AS {q(alias)}" for alias, expr in key_sql]
    cols = keys + [
        f"'{name}' AS \"column\"", f"'{tc}' AS type_class", "count(*) AS n",
        f"count({c}) AS nonnull", f"count(*) - count({c}) AS \"null\"", f"{nan} AS nan",
        f"{inf} AS inf", f"{min_i} AS min_i", f"{max_i} AS max_i", f"{min_d} AS min_d",
        f"{max_d} AS max_d", f"{min_s} AS min_s", f"{max_s} AS max_s", f"{total} AS total",
        f"{std} AS stddev",
    ]
    sql = f"SELECT {', '.join(cols)} FROM {source}"
    if where:
        sql += f" WHERE {where}"
    if key_sql:
        sql += " GROUP BY " + ", ".join(str(i + 1) for i in range(len(key_sql)))
    return sql


def profile_sql(table: str, key_sql: list[tuple[str, str]] | None = None, *,
                source: str | None = None, columns: list[tuple[str, str]] | None = None,
                where: str | None = None, digits: int = 4) -> str:
    """Exact metrics of every column of ``table`` per key, as one UNION ALL."""
    cols = columns if columns is not None else TABLE_COLUMNS[table]
    src = source or table
    return "\nUNION ALL\n".join(_column_select(n, tc, key_sql or [], src, where, digits)
                                for n, tc in cols)


def count_sql(table: str, freq: str, col: str, where: str | None = None) -> str:
    lab = label_sql(freq, col)
    w = f" WHERE {where}" if where else f" WHERE {q(col)} IS NOT NULL"
    return f"SELECT {lab} AS dataset_ts, count(*) AS n FROM {table}{w} GROUP BY 1"

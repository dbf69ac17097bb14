"""Order-insensitive comparison of a Spark result with its DuckDB oracle.

Used by the tests and ``check_oracles.py``: same column names, same row count,
and the same multiset of rows after columns are sorted by name and doubles are
rounded.
"""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits: int):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        r = round(v, digits)
        return 0.0 if r == 0 else r
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item(), digits)
        except (ValueError, AttributeError):
            pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    return v


def rows_of(columns: list[str], rows, digits: int = 6) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    bag = Counter(tuple(_norm(r[i], digits) for i in order) for r in rows)
    return cols, bag


_SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT",
                "tinyint": "TINYINT", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def type_mismatches(spark_df, con, sql: str) -> dict:
    """Columns whose Spark type and DuckDB result type differ."""
    rel = con.sql(sql)
    duck = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    out = {}
    for f in spark_df.schema.fields:
        s = _SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
        if f.name in duck and duck[f.name] != s:
            out[f.name] = (s, duck[f.name])
    return out


def compare(spark_df, con, sql: str, digits: int = 6) -> dict:
    s_rows = [tuple(r) for r in spark_df.collect()]
    s_cols, s_bag = rows_of(spark_df.columns, s_rows, digits)
    rel = con.execute(sql)
    d_cols_raw = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    d_cols, d_bag = rows_of(d_cols_raw, d_rows, digits)
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": s_cols == d_cols, "values_match": s_bag == d_bag}
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
    elif not out["values_match"]:
        only_s = list((s_bag - d_bag).elements())[:3]
        only_d = list((d_bag - s_bag).elements())[:3]
        out["only_spark"], out["only_oracle"] = only_s, only_d
    types = type_mismatches(spark_df, con, sql)
    if types:
        out["type_mismatches"] = types
    out["ok"] = out["columns_match"] and out["values_match"] and len(s_rows) == len(d_rows)
    return out

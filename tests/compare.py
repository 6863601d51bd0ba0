"""Run a query and its SQL oracle over the same tables and compare the rows."""

import math
from datetime import datetime
from pathlib import Path

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(sf_dir) / name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime):
        return value.isoformat()
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def spark_rows(df):
    return _sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def duckdb_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return _sorted_rows(columns, cursor.fetchall())


def differences(spark, sf_dir, con, query, sql, limit=5):
    names, got = spark_rows(query(spark, sf_dir))
    wanted_names, wanted = duckdb_rows(con, sql)
    if names != wanted_names:
        return [f"columns {names} != {wanted_names}"]
    found = [] if len(got) == len(wanted) else [f"rows {len(got)} != {len(wanted)}"]
    found += [f"{g} != {w}" for g, w in zip(got, wanted, strict=False) if g != w][:limit]
    return found

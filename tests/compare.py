"""Order-insensitive comparison of a Spark result with the check SQL's result."""

from __future__ import annotations

import math
import os
from datetime import date, datetime
from decimal import Decimal

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in sorted(os.listdir(sf_dir)):
        if name.endswith(".parquet"):
            con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, Decimal)):
        return None if isinstance(value, float) and math.isnan(value) else float(value)
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(plain(r[i]) for i in order)) for r in rows)


def differences(spark_df, con, sql) -> list[str]:
    """Empty when columns, row counts and values agree."""
    relation = con.execute(sql)
    expected_columns = [d[0] for d in relation.description]
    expected = relation.fetchall()
    columns = spark_df.columns
    if sorted(columns) != sorted(expected_columns):
        return [f"columns {sorted(set(columns) ^ set(expected_columns))}"]
    got = rows_of(columns, spark_df.collect())
    want = rows_of(expected_columns, expected)
    if got == want:
        return []
    names = sorted(columns)
    only_got, only_want = sorted(set(got) - set(want))[:2], sorted(set(want) - set(got))[:2]
    return [f"{len(got)} rows, expected {len(want)}; {names}", *[f"got  {r}" for r in only_got], *[f"want {r}" for r in only_want]]

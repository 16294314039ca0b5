"""Compare a query with its SQL twin."""

from __future__ import annotations

import datetime
import math
import os

import duckdb

BASE = os.environ.get("LAKEMART_TESTDATA", "/root/testdata")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in os.listdir(folder):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{file}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def differences(df, con, sql: str) -> tuple[list, list, int]:
    """Rows only in the frame, rows only in the SQL result, number of rows."""
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=repr)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in places) for r in result.fetchall()), key=repr)
    if got == want:
        return [], [], len(got)
    from collections import Counter

    a, b = Counter(got), Counter(want)
    return list((a - b).elements())[:5], list((b - a).elements())[:5], len(got)

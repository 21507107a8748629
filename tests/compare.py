"""Compares a Spark result with a DuckDB result, column by column and row by row."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> None:
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    want = rows_of(names, result.fetchall())
    have = rows_of(df.columns, df.collect())
    missing, extra = want - have, have - want
    assert not missing and not extra, (
        f"{sorted(names)}\n{sum(missing.values())} missing, e.g. {list(missing)[:3]}\n"
        f"{sum(extra.values())} extra, e.g. {list(extra)[:3]}"
    )

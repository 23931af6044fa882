"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import SparkSession

from checks.standins import TABLES


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return None if v is None else str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(
        (tuple(_norm(r[i]) for i in order) for r in rows), key=lambda r: tuple("" if x is None else x for x in r)
    )


def compare(spark: SparkSession, sf: str, query, sql: str) -> list[str]:
    """Differences found; empty when both sides agree."""
    df = query(spark, sf)
    got = rows_of(df.columns, df.collect())
    rel = connect(sf).execute(sql)
    want = rows_of([d[0] for d in rel.description], rel.fetchall())
    problems = []
    if got[0] != want[0]:
        problems.append(f"columns {got[0]} != {want[0]}")
    if len(got[1]) != len(want[1]):
        problems.append(f"rows {len(got[1])} != {len(want[1])}")
    if not problems and got[1] != want[1]:
        diff = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
        problems.append(f"{len(diff)} rows differ, first {got[0]}\n  got  {diff[0][0]}\n  want {diff[0][1]}")
    if not got[1]:
        problems.append("no rows")
    return problems

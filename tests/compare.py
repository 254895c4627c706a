"""Rows of a Spark result and of its oracle, in a form that compares."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for path in Path(sf_dir).glob("*.parquet"):
        source = f"{path}/*.parquet" if path.is_dir() else path
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{source}'")
    return db


def plain(value: object) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value + 0.0:.6g}" if abs(value) > 1e6 else f"{round(value, 6) + 0.0:.6f}"
    return str(value)


def difference(spark_df, db: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when columns and rows agree."""
    result = db.execute(sql)
    names = [c[0] for c in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} and {sorted(names)}"
    want = sorted(tuple(map(plain, r)) for r in result.fetchall())
    got = sorted(tuple(map(plain, r)) for r in spark_df.select(*names).collect())
    if want == got:
        return ""
    a, b = set(got) - set(want), set(want) - set(got)
    return f"{len(got)} rows and {len(want)}; only Spark: {sorted(a)[:3]}; only SQL: {sorted(b)[:3]}"

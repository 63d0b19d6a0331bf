"""Row comparison of a Spark result with a SQL result."""

import math
from datetime import datetime
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _value(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, datetime):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return sorted(repr([_value(row[n]) for n in order]) for row in rows)


def differences(df, sql: str, db) -> list[str]:
    """What differs: columns, or rows of one side only."""
    result = db.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} instead of {sorted(columns)}"]
    expected, actual = rows_of(columns, result.fetchall()), rows_of(df.columns, df.collect())
    if expected == actual:
        return []
    only_sql = sorted(set(expected) - set(actual))[:3]
    only_spark = sorted(set(actual) - set(expected))[:3]
    return [f"{len(actual)} rows instead of {len(expected)}", *only_spark, "vs", *only_sql]

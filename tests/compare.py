"""Compare named queries with their SQL on the same files."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return db


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return repr(value)


def rows(columns: list[str], values) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in values)


def difference(spark_df, db, sql: str) -> tuple[int, str | None]:
    """Number of Spark rows and a description of the first differences, or None if equal."""
    result = db.execute(sql)
    expected_columns = [column[0] for column in result.description]
    expected = rows(expected_columns, result.fetchall())
    actual = rows(spark_df.columns, spark_df.collect())
    if sorted(expected_columns) != sorted(spark_df.columns):
        return actual.total(), f"columns {sorted(spark_df.columns)} instead of {sorted(expected_columns)}"
    if expected != actual:
        only_spark, only_sql = list((actual - expected).elements()), list((expected - actual).elements())
        return actual.total(), (
            f"{actual.total()} rows instead of {expected.total()}; only Spark ({len(only_spark)}): {only_spark[:3]}; "
            f"only SQL ({len(only_sql)}): {only_sql[:3]}"
        )
    return actual.total(), None

"""Data-quality checks on the result tables.

Each table is read once: all its counts come from one global aggregate, whose partial step sends one row per task.
The single result row is then spread into check rows.
"""

from __future__ import annotations

import re

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight import schemas, settings
from wardlight.functions.text import age_hours, as_of_time, fixed_decimals

CHECK_COLUMNS = schemas.RESULT_SCHEMAS["data_quality_checks"].fieldNames()

# table: (check name, condition of a bad row, text after the number of bad rows)
DOMAIN_RULES = {
    "bed_availability": (
        "bed_availability_nonnegative",
        "min_available_beds < 0 OR avg_available_beds < 0",
        "rows have negative bed counts",
    ),
    "severity_trend": (
        "severity_range",
        "avg_severity < 0 OR avg_severity > 4",
        "rows have avg_severity outside 0..4",
    ),
    "vaccination_trend": (
        "vaccination_values",
        "dose_number < 1 OR vaccination_count < 0",
        "rows have invalid dose_number or vaccination_count",
    ),
}


def _check(name: str, table: str, status: str, message: str, measured: bool = True) -> str:
    """A check row as SQL text; ``status`` and ``message`` are SQL, ``measured`` adds row count and newest time."""
    row_count, latest = ("row_count", "latest_timestamp") if measured else ("NULL", "NULL")
    return (
        f"named_struct('check_name', '{name}', 'table_name', '{table}', 'status', {status}, "
        f"'row_count', CAST({row_count} AS BIGINT), 'latest_timestamp', CAST({latest} AS TIMESTAMP), "
        f"'message', {message})"
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _rows(source: DataFrame, checks: list[str], as_of) -> DataFrame:
    spread = F.expr(f"inline(array_compact(array({', '.join(checks)})))")
    return source.select(as_of_time(as_of).alias("checked_at"), spread).select(*CHECK_COLUMNS)


def null_keys(columns: list[str]) -> Column:
    return F.expr(" OR ".join(f"`{name}` IS NULL" for name in columns))


def _has_rule(df: DataFrame, table: str) -> bool:
    """Whether the table has a domain rule, and the columns of that rule."""
    if table not in DOMAIN_RULES:
        return False
    named = set(schemas.RESULT_SCHEMAS[table].fieldNames()) & set(re.findall(r"\w+", DOMAIN_RULES[table][1]))
    return named <= set(df.columns)


def table_stats(df: DataFrame, table: str, key_columns: list[str] | None = None) -> DataFrame:
    """One row: row_count, latest_timestamp, null_rows and bad_rows."""
    key_columns = key_columns or df.columns
    complete = set(key_columns) <= set(df.columns)
    condition = DOMAIN_RULES[table][1] if _has_rule(df, table) else "false"
    return df.agg(
        F.count("*").alias("row_count"),
        F.max(schemas.TIME_COLUMN[table]).alias("latest_timestamp"),
        F.count_if(null_keys(key_columns) if complete else F.lit(False)).alias("null_rows"),
        F.count_if(F.expr(condition)).alias("bad_rows"),
    )


def _state_rows(
    df: DataFrame, table: str, key_columns: list[str], as_of, stale_hours: int, domain: bool = False
) -> DataFrame:
    age = age_hours(as_of_time(as_of), F.col("latest_timestamp"))
    stats = table_stats(df, table, key_columns).withColumn("age", age).withColumn("hours", fixed_decimals(F.col("age"), 1))
    missing_columns = [name for name in key_columns if name not in df.columns]
    threshold = f"h old; threshold is {stale_hours}h"
    checks = [
        _check("table_exists", table, "'PASS'", "'Table exists'"),
        _check(
            "row_count_nonzero",
            table,
            "if(row_count = 0, 'FAIL', 'PASS')",
            "if(row_count = 0, 'Table has no rows', 'Table has data')",
        ),
    ]
    with_rows = [
        _check(
            "freshness",
            table,
            f"if(age <= {stale_hours}, 'PASS', 'FAIL')",
            f"concat('Latest data is ', coalesce(hours, '?'), if(age <= {stale_hours}, 'h old', '{threshold}'))",
        )
    ]
    if missing_columns:
        message = _quoted(f"Missing columns: {', '.join(missing_columns)}")
        with_rows.append(_check("required_columns", table, "'FAIL'", message))
    else:
        with_rows.append(_check("required_columns", table, "'PASS'", "'Required columns present'"))
        nulls_found = "concat(null_rows, ' rows have null values in key columns')"
        with_rows.append(
            _check(
                "null_key_values",
                table,
                "if(null_rows > 0, 'WARN', 'PASS')",
                f"if(null_rows > 0, {nulls_found}, 'No null key values')",
            )
        )
    checks += [f"CASE WHEN row_count > 0 THEN {check} END" for check in with_rows]
    if domain and _has_rule(df, table):
        checks.append(_domain_check(table))
    return _rows(stats, checks, as_of)


def _domain_check(table: str) -> str:
    name, _, text = DOMAIN_RULES[table]
    return (
        f"named_struct('check_name', '{name}', 'table_name', '{table}', "
        f"'status', if(bad_rows > 0, 'FAIL', 'PASS'), 'row_count', bad_rows, "
        f"'latest_timestamp', CAST(NULL AS TIMESTAMP), 'message', concat(bad_rows, ' {text}'))"
    )


def _absent_table(spark: SparkSession, table: str, as_of) -> DataFrame:
    message = f"Expected table {table} does not exist"
    return _rows(spark.range(1), [_check("table_exists", table, "'FAIL'", _quoted(message), measured=False)], as_of)


def _prediction_check(spark: SparkSession, exists: bool, as_of) -> DataFrame:
    table = "outbreak_predictions"
    status, message = ("PASS", "Outbreak table exists") if exists else ("WARN", f"ML has not created {table} yet")
    check = _check("outbreak_prediction_table", table, _quoted(status), _quoted(message), measured=False)
    return _rows(spark.range(1), [check], as_of)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table_state_checks(
    spark: SparkSession,
    table: str,
    df: DataFrame | None,
    key_columns: list[str],
    as_of=None,
    stale_hours: int = settings.STALE_HOURS,
) -> DataFrame:
    """Exists, has rows, is fresh, has its columns, has no NULL in them; later checks need the earlier ones."""
    if df is None:
        return _absent_table(spark, table, as_of)
    return _state_rows(df, table, key_columns, as_of, stale_hours)


def domain_checks(spark: SparkSession, tables: dict[str, DataFrame | None], as_of=None) -> DataFrame:
    """Value ranges per table; ``row_count`` holds the number of bad rows. Absent tables are skipped."""
    frames = [
        _rows(table_stats(tables[name], name), [_domain_check(name)], as_of)
        for name in DOMAIN_RULES
        if tables.get(name) is not None and _has_rule(tables[name], name)
    ]
    exists = tables.get("outbreak_predictions") is not None
    return _union([*frames, _prediction_check(spark, exists, as_of)])


def dq_report(
    spark: SparkSession,
    tables: dict[str, DataFrame | None],
    as_of=None,
    stale_hours: int = settings.STALE_HOURS,
    watched: dict[str, list[str]] = settings.WATCHED_TABLES,
) -> DataFrame:
    """State and domain checks of every watched table from one read of each."""
    frames = []
    for table, key_columns in watched.items():
        df = tables.get(table)
        if df is None:
            frames.append(_absent_table(spark, table, as_of))
            continue
        frames.append(_state_rows(df, table, key_columns, as_of, stale_hours, domain=True))
    exists = tables.get("outbreak_predictions") is not None
    return _union([*frames, _prediction_check(spark, exists, as_of)])


def freshness(table: str, df: DataFrame, as_of=None) -> DataFrame:
    stats = table_stats(df, table).withColumn(
        "age_hours", age_hours(as_of_time(as_of), F.col("latest_timestamp").cast("timestamp"))
    )
    return stats.select(F.lit(table).alias("table_name"), "row_count", "latest_timestamp", "age_hours")


def dq_summary(checks: DataFrame) -> DataFrame:
    status = F.col("status")
    return checks.agg(
        F.count("*").alias("total_checks"),
        F.count_if(status == "PASS").alias("passed"),
        F.count_if(status == "WARN").alias("warned"),
        F.count_if(status == "FAIL").alias("failed"),
    )

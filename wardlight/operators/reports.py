"""Latest-per-region warnings, pipeline health, row counts and other report tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight import schemas, settings
from wardlight.functions.scoring import severity_label
from wardlight.functions.text import age_hours, as_of_time, fixed_decimals

BED_DEFAULTS = settings.BedWarningThresholds()


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _latest_per_region(table: DataFrame, measures: list[str]) -> DataFrame:
    """The newest row of each region.

    Hour and measures are of fixed width, so this stays a hash aggregation with a partial step; taking the whole row
    as one struct would make Spark sort its input. All measures follow the same hour comparison and therefore come
    from the same row, also if a region repeats an hour.
    """
    newest = [F.max_by(name, "hour").alias(name) for name in measures]
    return table.groupBy("region").agg(F.max("hour").alias("hour"), *newest)


def latest_beds(beds: DataFrame) -> DataFrame:
    measures = ["avg_available_beds", "min_available_beds", "sample_count"]
    return _latest_per_region(beds, measures).select("hour", "region", *measures)


def latest_admission_rate(rate: DataFrame) -> DataFrame:
    admissions = rate.where(F.col("event_type") == schemas.HOSPITAL)
    return _latest_per_region(admissions, ["event_count"]).select(
        "hour", F.lit(schemas.HOSPITAL).alias("event_type"), "region", "event_count"
    )


def _labelled(
    latest: DataFrame, metric: str, observed: str, warning: int, critical: int, low_is_bad: bool, detail
) -> DataFrame:
    severity = severity_label(F.col(observed), warning, critical, low_is_bad)
    threshold = F.when(severity == "CRITICAL", critical).when(severity == "WARNING", warning)
    return latest.select(
        "region",
        severity.alias("severity"),
        F.lit(metric).alias("metric"),
        F.col(observed).cast("bigint").alias("observed"),
        threshold.cast("bigint").alias("threshold"),
        "hour",
        detail.alias("detail"),
    )


def labelled_regions(
    beds: DataFrame, rate: DataFrame, limits: settings.BedWarningThresholds = BED_DEFAULTS
) -> DataFrame:
    """Every region's latest bed and admission figures with OK, WARNING or CRITICAL."""
    bed_detail = F.concat(
        F.lit("avg="),
        fixed_decimals(F.col("avg_available_beds"), 1),
        F.format_string(", min=%d, samples=%d", "min_available_beds", "sample_count"),
    )
    rate_detail = F.format_string("event_type=hospital_admission, count=%d", "event_count")
    return _labelled(
        latest_beds(beds),
        "min_available_beds",
        "min_available_beds",
        limits.beds_warning,
        limits.beds_critical,
        True,
        bed_detail,
    ).unionByName(
        _labelled(
            latest_admission_rate(rate),
            "hospital_admission_count",
            "event_count",
            limits.admissions_warning,
            limits.admissions_critical,
            False,
            rate_detail,
        )
    )


def bed_warning_report(labelled: DataFrame) -> DataFrame:
    """Warnings only: CRITICAL before WARNING, bed warnings before admission warnings."""
    severity, metric = F.col("severity"), F.col("metric")
    return labelled.where(severity != "OK").orderBy(
        F.when(severity == "CRITICAL", 0).otherwise(1),
        F.when(metric == "min_available_beds", 0).otherwise(1),
        "region",
    )


def bed_warning_summary(labelled: DataFrame) -> DataFrame:
    is_beds = F.col("metric") == "min_available_beds"
    return labelled.agg(
        F.count_if(is_beds).alias("regions_checked_beds"),
        F.count_if(~is_beds).alias("regions_checked_admissions"),
        F.count_if(F.col("severity") != "OK").alias("warnings_raised"),
        F.count_if(F.col("severity") == "CRITICAL").alias("criticals_raised"),
    )


def table_state(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count and newest time of each table; the time is NULL for an empty one."""
    return _union(
        [
            df.agg(
                F.lit(name).alias("table_name"),
                F.count("*").alias("row_count"),
                F.max(schemas.TIME_COLUMN[name]).cast("timestamp").alias("latest_time"),
            )
            for name, df in tables.items()
        ]
    )


def pipeline_health(states: DataFrame, as_of=None, stale_hours: int = settings.STALE_HOURS) -> DataFrame:
    """EMPTY, STALE or HEALTHY per table."""
    empty = (F.col("row_count") == 0) | F.col("latest_time").isNull()
    age = age_hours(as_of_time(as_of), F.col("latest_time"))
    hours = F.concat(F.lit("Latest row is "), fixed_decimals(age, 1), F.lit("h old "))
    stale = age > stale_hours
    return states.select(
        "table_name",
        F.when(empty, "EMPTY").when(stale, "STALE").otherwise("HEALTHY").alias("status"),
        F.when(~empty, age).alias("age_hours"),
        "row_count",
        F.when(empty, "Table has no rows — Spark job may never have run or table was truncated")
        .when(
            stale,
            F.concat(hours, F.lit(f"(threshold: {stale_hours}h) — Spark CronJob may have failed")),
        )
        .otherwise(F.concat(hours, F.lit("— within threshold")))
        .alias("message"),
    )


def pipeline_health_summary(health: DataFrame) -> DataFrame:
    healthy = F.col("status") == "HEALTHY"
    return health.agg(
        F.count_if(healthy).alias("tables_healthy"),
        F.count_if(~healthy).alias("tables_unhealthy"),
        F.count("*").alias("tables_checked"),
        F.when(F.bool_and(healthy), "HEALTHY").otherwise("UNHEALTHY").alias("overall"),
    )


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _union(
        [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count")) for name, df in tables.items()]
    )


def recent_rows(df: DataFrame, table: str, n: int) -> DataFrame:
    """The newest ``n`` rows of a result table; remaining key columns settle ties."""
    time = schemas.TIME_COLUMN[table]
    ties = [name for name in schemas.PRESENTATION_ORDER[table] if name != time]
    return df.orderBy(F.desc(time), *ties).limit(n)


def retained(df: DataFrame, time: str, as_of=None, days: int = 7) -> DataFrame:
    """Rows that a clean-up of everything older than ``days`` keeps."""
    cutoff = as_of_time(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    return df.where((F.col(time) >= cutoff) | F.col(time).isNull())

"""Threshold alerts on the newest result rows.

Every check looks at its newest rows only (a top-k that each task cuts down before one small merge) and classifies
them afterwards, so that older rows never raise an alert.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlight import settings
from wardlight.functions.scoring import level_at_least, level_at_most
from wardlight.functions.text import age_hours, as_of_time, fixed_decimals, utc_text

DEFAULTS = settings.AlertThresholds()
ALERT_COLUMNS = ["check_order", "event_time", "sort_value", "level", "metric", "region", "message"]


def _text(*parts: Column | str) -> Column:
    return F.concat(*[part.cast("string") if isinstance(part, Column) else F.lit(part) for part in parts])


def _alerts(rows: DataFrame, order: int, metric, time, value, region, message: Column) -> DataFrame:
    return rows.where(F.col("level").isNotNull()).select(
        F.lit(order).alias("check_order"),
        time.cast("timestamp").alias("event_time"),
        value.cast("double").alias("sort_value"),
        "level",
        (metric if isinstance(metric, Column) else F.lit(metric)).alias("metric"),
        region.alias("region"),
        message.alias("message"),
    )


def _first(rows: DataFrame, n: int | None, *order) -> DataFrame:
    """The first ``n`` rows in an order; all rows, unsorted, if there is no limit."""
    return rows if n is None else rows.orderBy(*order).limit(n)


def top_event_rate(rate: DataFrame, n: int | None = DEFAULTS.scan_rows) -> DataFrame:
    return _first(rate, n, F.desc("hour"), F.desc("event_count"), "region", "event_type")


def top_severity(severity: DataFrame, n: int | None = DEFAULTS.scan_rows) -> DataFrame:
    return _first(severity, n, F.desc("window_start"), F.desc("avg_severity"), "region", "event_type")


def top_bed_pressure(beds: DataFrame, n: int | None = DEFAULTS.scan_rows) -> DataFrame:
    return _first(beds, n, F.desc("hour"), "min_available_beds", "region")


def vaccination_latest_hour(vaccination: DataFrame) -> DataFrame:
    """Doses per region and vaccine in the table's newest hour, from one read of the table.

    A pair of region and vaccine has doses in the newest hour only if that is its own newest hour, so the hours are
    reduced to one row per pair first. The window without keys sees those rows alone: regions x vaccines.
    """
    hourly = vaccination.groupBy("hour", "region", "vaccine_type").agg(F.sum("vaccination_count").alias("doses"))
    newest = hourly.groupBy("region", "vaccine_type").agg(
        F.max("hour").alias("hour"), F.max_by("doses", "hour").alias("doses")
    )
    latest = newest.withColumn("latest", F.max("hour").over(Window.partitionBy(F.lit(0))))
    return latest.where(F.col("hour") == F.col("latest")).select("hour", "region", "vaccine_type", "doses")


def event_rate_alerts(rate: DataFrame, limits: settings.AlertThresholds = DEFAULTS) -> DataFrame:
    count = F.col("event_count")
    rows = top_event_rate(rate, limits.scan_rows).withColumn(
        "level", level_at_least(count, limits.event_warning, limits.event_critical)
    )
    message = _text(F.col("event_type"), " had ", count, " events at ", utc_text(F.col("hour")))
    return _alerts(rows, 1, "event_rate", F.col("hour"), -count, F.col("region"), message)


def severity_alerts(severity: DataFrame, limits: settings.AlertThresholds = DEFAULTS) -> DataFrame:
    mean = F.col("avg_severity")
    rows = top_severity(severity, limits.scan_rows).withColumn(
        "level", level_at_least(mean, limits.severity_warning, limits.severity_critical)
    )
    message = _text(
        F.col("event_type"),
        " avg_severity=",
        fixed_decimals(mean, 2),
        " from ",
        F.col("sample_count"),
        " samples at ",
        utc_text(F.col("window_start")),
    )
    return _alerts(rows, 2, "severity", F.col("window_start"), -mean, F.col("region"), message)


def bed_alerts(beds: DataFrame, limits: settings.AlertThresholds = DEFAULTS) -> DataFrame:
    least = F.col("min_available_beds")
    rows = top_bed_pressure(beds, limits.scan_rows).withColumn(
        "level", level_at_most(least, limits.beds_warning, limits.beds_critical)
    )
    message = _text(
        "min_available_beds=",
        least,
        ", avg_available_beds=",
        fixed_decimals(F.col("avg_available_beds"), 2),
        " at ",
        utc_text(F.col("hour")),
    )
    return _alerts(rows, 3, "bed_availability", F.col("hour"), least, F.col("region"), message)


def vaccination_alerts(vaccination: DataFrame, limits: settings.AlertThresholds = DEFAULTS) -> DataFrame:
    doses = F.col("doses")
    low, surge = doses <= limits.vaccination_low, doses >= limits.vaccination_surge
    rows = _first(
        vaccination_latest_hour(vaccination), limits.scan_rows, "doses", "region", "vaccine_type"
    ).withColumn("level", F.when(low, "warning").when(surge, "info"))
    metric = F.when(low, "vaccination_low").otherwise("vaccination_surge")
    message = _text(
        F.when(low, "Only ").otherwise(""),
        doses,
        " ",
        F.col("vaccine_type"),
        " vaccination records at ",
        utc_text(F.col("hour")),
    )
    return _alerts(rows, 4, metric, F.col("hour"), doses, F.col("region"), message)


def data_quality_alerts(
    checks: DataFrame, as_of=None, limits: settings.AlertThresholds = DEFAULTS
) -> DataFrame:
    recent = F.col("checked_at") >= as_of_time(as_of) - F.expr("INTERVAL 12 HOURS")
    bad = checks.where(recent & F.col("status").isin("WARN", "FAIL"))
    rows = _first(bad, limits.scan_rows, F.desc("checked_at"), "check_name", "table_name").withColumn(
        "level", F.when(F.col("status") == "FAIL", "critical").otherwise("warning")
    )
    region = F.coalesce(F.nullif("table_name", F.lit("")), F.lit("pipeline"))
    message = _text(
        F.col("check_name"), "=", F.col("status"), " at ", utc_text(F.col("checked_at")), ": ",
        F.coalesce("message", F.lit("None")),
    )
    return _alerts(rows, 5, "data_quality", F.col("checked_at"), F.lit(0), region, message)


def freshness_alerts(rate: DataFrame, as_of=None, limits: settings.AlertThresholds = DEFAULTS) -> DataFrame:
    latest = F.col("latest")
    age = age_hours(as_of_time(as_of), latest)
    rows = rate.agg(F.max("hour").cast("timestamp").alias("latest")).withColumn(
        "level", F.when(latest.isNull() | (age > limits.stale_hours), "critical")
    )
    old = _text(
        "hourly_event_rate latest row is ",
        fixed_decimals(age, 1),
        f"h old; threshold is {limits.stale_hours}h",
    )
    message = F.when(latest.isNull(), "hourly_event_rate has no rows").otherwise(old)
    return _alerts(rows, 6, "pipeline_freshness", latest, F.lit(0), F.lit("all"), message)


def alert_feed(
    tables: dict[str, DataFrame], as_of=None, limits: settings.AlertThresholds = DEFAULTS
) -> DataFrame:
    """All alerts of one poll with ``position``, the order within their check."""
    union = reduce(
        DataFrame.unionByName,
        [
            event_rate_alerts(tables["hourly_event_rate"], limits),
            severity_alerts(tables["severity_trend"], limits),
            bed_alerts(tables["bed_availability"], limits),
            vaccination_alerts(tables["vaccination_trend"], limits),
            data_quality_alerts(tables["data_quality_checks"], as_of, limits),
            freshness_alerts(tables["hourly_event_rate"], as_of, limits),
        ],
    )
    # a check has at most ``scan_rows`` alerts, so these windows stay small; without that limit their size is the
    # number of alerts of one check
    within_check = Window.partitionBy("check_order").orderBy(F.desc("event_time"), "sort_value", "region", "message")
    return union.withColumn("position", F.row_number().over(within_check))

"""Chart-ready tables: pivots, totals and top-n lists.

Pivots take their column values as an argument. That fixes the schema and spares the extra job with which Spark would
look for the values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight import schemas

STATUSES = ["PASS", "WARN", "FAIL"]


def event_rate_chart(rate: DataFrame, event_types: Sequence[str] = tuple(schemas.EVENT_TYPES)) -> DataFrame:
    """Events per hour, one column per type; 0 where a type has none."""
    return rate.groupBy("hour").pivot("event_type", list(event_types)).agg(F.sum("event_count")).na.fill(0)


def region_totals(rate: DataFrame, n: int = 12) -> DataFrame:
    """The first ``n`` totals in key order."""
    totals = rate.groupBy("region", "event_type").agg(F.sum("event_count").alias("event_count"))
    return totals.orderBy("region", "event_type").limit(n)


def _listed(regions: Sequence[str] | None) -> list[str] | None:
    """Regions of a chart; None takes all that the table holds, at the cost of a pass that looks for them."""
    return None if regions is None else list(regions)


def severity_chart(severity: DataFrame, regions: Sequence[str] | None = None) -> DataFrame:
    """Mean severity per window, one column per region; 0 where a region has none."""
    return severity.groupBy("window_start").pivot("region", _listed(regions)).agg(F.avg("avg_severity")).na.fill(0.0)


def beds_chart(beds: DataFrame, regions: Sequence[str] | None = None) -> DataFrame:
    """Fewest beds per hour, one column per region; gaps stay NULL."""
    return beds.groupBy("hour").pivot("region", _listed(regions)).agg(F.min("min_available_beds"))


def risk_chart(risk: DataFrame, regions: Sequence[str] | None = None) -> DataFrame:
    """Mean risk per hour, one column per region; gaps stay NULL."""
    return risk.groupBy("hour").pivot("region", _listed(regions)).agg(F.avg("outbreak_risk_score"))


def vaccination_totals(vaccination: DataFrame) -> DataFrame:
    totals = vaccination.groupBy("region", "vaccine_type", "dose_number").agg(
        F.sum("vaccination_count").alias("vaccination_count")
    )
    label = F.format_string("%s / %s dose %d", "region", "vaccine_type", "dose_number")
    return totals.withColumn("label", label)


def vaccination_chart(vaccination: DataFrame) -> DataFrame:
    return vaccination_totals(vaccination).orderBy("vaccination_count", "region", "vaccine_type", "dose_number")


def status_chart(checks: DataFrame) -> DataFrame:
    """Number of checks with PASS, WARN and FAIL, in that order and also where it is 0; other statuses are left out."""
    counts = checks.agg(
        *[F.count(F.when(F.col("status") == status, F.col("check_name"))).alias(status) for status in STATUSES]
    )
    pairs = [F.struct(F.lit(status).alias("status"), F.col(status).alias("checks")) for status in STATUSES]
    return counts.select(F.inline(F.array(*pairs)))


def top_severity(severity: DataFrame, n: int = 10) -> DataFrame:
    return severity.orderBy(F.desc("avg_severity"), "window_start", "region", "event_type").limit(n)


def top_beds(beds: DataFrame, n: int = 10) -> DataFrame:
    return beds.orderBy("min_available_beds", "hour", "region").limit(n)


def top_risk(risk: DataFrame, n: int = 10) -> DataFrame:
    return risk.orderBy(F.desc("outbreak_risk_score"), "hour", "region").limit(n)


def top_vaccination(vaccination: DataFrame, n: int = 10) -> DataFrame:
    ordered = vaccination_totals(vaccination).orderBy(
        F.desc("vaccination_count"), "region", "vaccine_type", "dose_number"
    )
    return ordered.limit(n)


def recent_checks(checks: DataFrame, n: int = 12) -> DataFrame:
    return checks.orderBy(F.desc("checked_at"), "table_name", "check_name").limit(n)

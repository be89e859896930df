"""Hourly aggregates over cleaned events.

Each aggregate has fixed-width buffers, so Spark runs it as a partial and a final hash aggregation: a task sends one
row per group however many rows the group holds, and a region or type with a third of all events does not skew the
shuffle. None of the functions sorts; ``in_order`` does that where rows are shown.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight import schemas
from wardlight.functions.scoring import severity_score
from wardlight.sources.events import union_streams


def event_hour() -> Column:
    return F.date_trunc("hour", F.col("timestamp")).alias("hour")


def in_order(result: DataFrame, table: str) -> DataFrame:
    return result.orderBy(*schemas.PRESENTATION_ORDER[table])


def hourly_event_rate(*streams: DataFrame | None) -> DataFrame:
    """Events per hour, type and region over all given streams; absent streams may be None."""
    return (
        union_streams(*streams)
        .groupBy(event_hour(), "event_type", "region")
        .agg(F.count("*").alias("event_count"))
    )


def scored_severity(*streams: DataFrame) -> DataFrame:
    """Events whose severity label is on the scale, with their score."""
    scored = None
    for stream in streams:
        part = stream.select("timestamp", "region", "event_type", severity_score(F.col("severity")).alias("score"))
        part = part.where(F.col("score").isNotNull())
        scored = part if scored is None else scored.unionByName(part)
    return scored


def severity_trend(*streams: DataFrame) -> DataFrame:
    """Mean severity score per tumbling one-hour window, region and event type."""
    return (
        scored_severity(*streams)
        .groupBy(F.window("timestamp", "1 hour").alias("w"), "region", "event_type")
        .agg(F.avg("score").alias("avg_severity"), F.count("*").alias("sample_count"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "region",
            "event_type",
            "avg_severity",
            "sample_count",
        )
    )


def bed_availability(hospital: DataFrame) -> DataFrame:
    return (
        hospital.where(F.col("available_beds").isNotNull())
        .groupBy(event_hour(), "region")
        .agg(
            F.avg("available_beds").alias("avg_available_beds"),
            F.min("available_beds").alias("min_available_beds"),
            F.count("*").alias("sample_count"),
        )
    )


def counted_vaccination() -> Column:
    return F.col("vaccine_type").isNotNull() & (F.col("dose_number") >= 1)


def vaccination_trend(vaccination: DataFrame) -> DataFrame:
    return (
        vaccination.where(counted_vaccination())
        .groupBy(event_hour(), "region", "vaccine_type", "dose_number")
        .agg(F.count("*").alias("vaccination_count"))
    )


def topic_counts(events: DataFrame) -> DataFrame:
    """Rows per event type in one pass."""
    return events.groupBy("event_type").agg(F.count("*").alias("row_count"))


# --- one pass over the events for all four results ---------------------------------------------------------------


def event_rollup(events: DataFrame) -> DataFrame:
    """Hourly partial sums from which all four results follow, so that the events are read and shuffled once.

    Its size depends on hours x regions x types x vaccine doses, not on the number of events. ``vaccine_type`` and
    ``dose_number`` are set only for vaccinations that count, so every other type has one row per hour and region.
    """
    event_type = F.col("event_type")
    counted = (event_type == schemas.VACCINATION) & counted_vaccination()
    score = F.when(event_type.isin(schemas.SYMPTOM, schemas.HOSPITAL), severity_score(F.col("severity")))
    beds = F.when(event_type == schemas.HOSPITAL, F.col("available_beds"))
    return (
        events.where(event_type.isin(schemas.EVENT_TYPES))
        .select(
            event_hour(),
            "event_type",
            "region",
            F.when(counted, F.col("vaccine_type")).alias("vaccine_type"),
            F.when(counted, F.col("dose_number")).alias("dose_number"),
            score.alias("score"),
            beds.alias("beds"),
        )
        .groupBy("hour", "event_type", "region", "vaccine_type", "dose_number")
        .agg(
            F.count("*").alias("event_count"),
            F.sum("score").alias("severity_sum"),
            F.count("score").alias("severity_count"),
            F.sum("beds").alias("beds_sum"),
            F.min("beds").alias("beds_min"),
            F.count("beds").alias("beds_count"),
        )
    )


def merged_rollup(partials: DataFrame) -> DataFrame:
    """One rollup from the rollups of several batches of events."""
    return partials.groupBy("hour", "event_type", "region", "vaccine_type", "dose_number").agg(
        F.sum("event_count").alias("event_count"),
        F.sum("severity_sum").alias("severity_sum"),
        F.sum("severity_count").alias("severity_count"),
        F.sum("beds_sum").alias("beds_sum"),
        F.min("beds_min").alias("beds_min"),
        F.sum("beds_count").alias("beds_count"),
    )


def results_from_rollup(rollup: DataFrame) -> dict[str, DataFrame]:
    with_severity = rollup.where(F.col("severity_count") > 0)
    with_beds = rollup.where(F.col("beds_count") > 0)
    return {
        "hourly_event_rate": rollup.groupBy("hour", "event_type", "region").agg(
            F.sum("event_count").alias("event_count")
        ),
        "severity_trend": with_severity.select(
            F.col("hour").alias("window_start"),
            (F.col("hour") + F.expr("INTERVAL 1 HOUR")).alias("window_end"),
            "region",
            "event_type",
            (F.col("severity_sum") / F.col("severity_count")).alias("avg_severity"),
            F.col("severity_count").alias("sample_count"),
        ),
        "bed_availability": with_beds.select(
            "hour",
            "region",
            (F.col("beds_sum") / F.col("beds_count")).alias("avg_available_beds"),
            F.col("beds_min").alias("min_available_beds"),
            F.col("beds_count").alias("sample_count"),
        ),
        "vaccination_trend": rollup.where(F.col("vaccine_type").isNotNull()).select(
            "hour", "region", "vaccine_type", "dose_number", F.col("event_count").alias("vaccination_count")
        ),
    }

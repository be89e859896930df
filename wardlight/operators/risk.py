"""Outbreak risk per hour and region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.functions import scoring
from wardlight.functions.text import as_of_time, round_decimal

KEYS = ["hour", "region"]

# Fixed values standing in for a feature without rows in that hour and region.
NO_SEVERITY, NO_BEDS, NO_VACCINATIONS = 0.0, 999, 0


def event_features(rate: DataFrame) -> DataFrame:
    return rate.groupBy(*KEYS).agg(F.sum("event_count").alias("total_events"))


def severity_features(severity: DataFrame) -> DataFrame:
    """The unweighted mean of the per-type means."""
    return severity.groupBy(F.col("window_start").alias("hour"), "region").agg(
        F.avg("avg_severity").alias("avg_severity")
    )


def bed_features(beds: DataFrame) -> DataFrame:
    return beds.groupBy(*KEYS).agg(F.min("min_available_beds").alias("min_available_beds"))


def vaccination_features(vaccination: DataFrame) -> DataFrame:
    return vaccination.groupBy(*KEYS).agg(F.sum("vaccination_count").alias("vaccination_count"))


def _filled() -> list:
    return [
        *KEYS,
        "total_events",
        F.coalesce("avg_severity", F.lit(NO_SEVERITY)).alias("avg_severity"),
        F.coalesce("min_available_beds", F.lit(NO_BEDS)).alias("min_available_beds"),
        F.coalesce("vaccination_count", F.lit(NO_VACCINATIONS).cast("bigint")).alias("vaccination_count"),
    ]


def joined_features(
    rate: DataFrame, severity: DataFrame, beds: DataFrame, vaccination: DataFrame
) -> DataFrame:
    """All features of the hours and regions that have events.

    Every side is grouped by the join keys, so it arrives partitioned by them and has one row per key: the joins add
    no shuffle and cannot skew. Which side to broadcast, if any, is left to AQE and the measured sizes.
    """
    joined = event_features(rate)
    for side in (severity_features(severity), bed_features(beds), vaccination_features(vaccination)):
        joined = joined.join(side, KEYS, "left")
    return joined.select(*_filled())


def features_from_rollup(rollup: DataFrame) -> DataFrame:
    """The same features from one grouping of the hourly rollup, without joins.

    All of them come from the counted events, so an hour and region without events has no feature either, which is
    what the left joins say.
    """
    mean_severity = F.col("severity_sum") / F.nullif(F.col("severity_count"), F.lit(0))
    return (
        rollup.groupBy(*KEYS)
        .agg(
            F.sum("event_count").alias("total_events"),
            F.avg(mean_severity).alias("avg_severity"),
            F.min("beds_min").alias("min_available_beds"),
            F.sum(F.when(F.col("vaccine_type").isNotNull(), F.col("event_count"))).alias("vaccination_count"),
        )
        .select(*_filled())
    )


def component_scores(features: DataFrame) -> DataFrame:
    return features.withColumns(
        {
            "event_score": scoring.event_score(F.col("total_events")),
            "severity_score": scoring.severity_component(F.col("avg_severity")),
            "bed_pressure_score": scoring.bed_pressure_score(F.col("min_available_beds")),
            "vaccination_score": scoring.vaccination_score(F.col("vaccination_count")),
        }
    )


def outbreak_risk(features: DataFrame) -> DataFrame:
    scored = component_scores(features).withColumn(
        "outbreak_risk_score",
        scoring.risk_score(
            total_events=F.col("total_events"),
            avg_severity=F.col("avg_severity"),
            min_beds=F.col("min_available_beds"),
            doses=F.col("vaccination_count"),
        ),
    )
    return scored.withColumn("outbreak_risk_level", scoring.risk_level(F.col("outbreak_risk_score")))


def predictions(features: DataFrame, as_of=None) -> DataFrame:
    """Rows of the ``outbreak_predictions`` table."""
    risk = outbreak_risk(features)
    return risk.select(as_of_time(as_of).alias("predicted_at"), *risk.columns)


def top_risk(risk: DataFrame, n: int = 10) -> DataFrame:
    return (
        risk.orderBy(F.desc_nulls_first("outbreak_risk_score"), "hour", "region")
        .limit(n)
        .select(
            *KEYS,
            "total_events",
            round_decimal(F.col("avg_severity"), 2).alias("avg_severity"),
            "min_available_beds",
            "vaccination_count",
            round_decimal(F.col("outbreak_risk_score"), 2).alias("outbreak_risk_score"),
            "outbreak_risk_level",
        )
    )

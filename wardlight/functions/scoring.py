"""Severity scale, threshold levels and risk components as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severity labels on a 1..4 scale. Labels are case-sensitive; any other label has no score.
SEVERITY_SCALE = {"low": 1.0, "moderate": 2.0, "high": 3.0, "severe": 3.0, "critical": 4.0}

# Risk weights and saturation points.
WEIGHTS = {"event": 0.35, "severity": 0.35, "bed_pressure": 0.20, "vaccination": 0.10}
EVENTS_AT_FULL_SCORE = 10
DOSES_AT_ZERO_SCORE = 20
BED_STEPS = [(50, 1.0), (100, 0.7), (200, 0.4)]
BED_SCORE_ABOVE = 0.1
RISK_LEVELS = [(0.75, "critical"), (0.50, "high"), (0.30, "medium")]
RISK_LEVEL_BELOW = "low"


def first_match(cases: list[tuple[Column, object]], default: object = None) -> Column:
    chain = F
    for condition, outcome in cases:
        chain = chain.when(condition, F.lit(outcome) if not isinstance(outcome, Column) else outcome)
    return chain.otherwise(F.lit(default))


def severity_score(label: Column) -> Column:
    return first_match([(label == name, score) for name, score in SEVERITY_SCALE.items()]).cast("double")


def level_at_least(value: Column, warning: float, critical: float) -> Column:
    """critical / warning / NULL where high values are bad; both limits are inclusive."""
    return first_match([(value >= F.lit(critical), "critical"), (value >= F.lit(warning), "warning")]).cast("string")


def level_at_most(value: Column, warning: float, critical: float) -> Column:
    """critical / warning / NULL where low values are bad; both limits are inclusive."""
    return first_match([(value <= F.lit(critical), "critical"), (value <= F.lit(warning), "warning")]).cast("string")


def severity_label(value: Column, warning: float, critical: float, low_is_bad: bool = True) -> Column:
    """CRITICAL / WARNING / OK."""
    level = (level_at_most if low_is_bad else level_at_least)(value, warning, critical)
    return F.coalesce(F.upper(level), F.lit("OK"))


# The event, bed and vaccination components are ratios of integers times a decimal weight. Each is computed as one
# division of exact integers, which gives the double nearest to the exact decimal value; multiplying rounded doubles
# instead can miss a level limit such as 0.30 by one ulp.


def event_score(total_events: Column) -> Column:
    return F.least(total_events, F.lit(EVENTS_AT_FULL_SCORE)) / F.lit(float(EVENTS_AT_FULL_SCORE))


def severity_component(avg_severity: Column) -> Column:
    return F.least(avg_severity / F.lit(4.0), F.lit(1.0))


def bed_pressure_score(min_beds: Column) -> Column:
    return first_match([(min_beds <= limit, score) for limit, score in BED_STEPS], BED_SCORE_ABOVE)


def vaccination_score(doses: Column) -> Column:
    remaining = F.lit(DOSES_AT_ZERO_SCORE) - F.least(doses, F.lit(DOSES_AT_ZERO_SCORE))
    return remaining / F.lit(float(DOSES_AT_ZERO_SCORE))


def risk_score(total_events: Column, avg_severity: Column, min_beds: Column, doses: Column) -> Column:
    percent = {name: round(weight * 100) for name, weight in WEIGHTS.items()}
    events = F.least(total_events, F.lit(EVENTS_AT_FULL_SCORE)) * percent["event"]
    remaining = F.lit(DOSES_AT_ZERO_SCORE) - F.least(doses, F.lit(DOSES_AT_ZERO_SCORE))
    beds = first_match(
        [(min_beds <= limit, round(WEIGHTS["bed_pressure"] * score, 2)) for limit, score in BED_STEPS],
        round(WEIGHTS["bed_pressure"] * BED_SCORE_ABOVE, 2),
    )
    return (
        events / F.lit(100.0 * EVENTS_AT_FULL_SCORE)
        + F.lit(WEIGHTS["severity"]) * severity_component(avg_severity)
        + beds
        + (remaining * percent["vaccination"]) / F.lit(100.0 * DOSES_AT_ZERO_SCORE)
    )


def risk_level(score: Column) -> Column:
    return first_match([(score >= F.lit(limit), level) for limit, level in RISK_LEVELS], RISK_LEVEL_BELOW)

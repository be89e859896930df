"""Declared event schemas and result-table schemas."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

SYMPTOM = "symptom_report"
CLINIC = "clinic_visit"
HOSPITAL = "hospital_admission"
VACCINATION = "vaccination_record"
EVENT_TYPES = [SYMPTOM, CLINIC, HOSPITAL, VACCINATION]


def _struct(*fields: tuple) -> StructType:
    schema = StructType()
    for name, data_type, *nullable in fields:
        schema = schema.add(name, data_type, nullable[0] if nullable else True)
    return schema


S, I, L, D, TS = StringType(), IntegerType(), LongType(), DoubleType(), TimestampType()
REQUIRED = False

_BASE = [
    ("event_id", S),
    ("event_type", S),
    ("schema_version", I),
    ("patient_id", S),
    ("timestamp", S),
    ("region", S),
    ("team_id", S),
    ("processing_timestamp", S),
    ("event_source", S),
]

EVENT_SCHEMAS = {
    SYMPTOM: _struct(*_BASE, ("severity", S), ("available_beds", I), ("age", I), ("duration_days", I)),
    CLINIC: _struct(*_BASE, ("available_beds", I), ("visit_type", S), ("diagnosis_code", S)),
    HOSPITAL: _struct(
        *_BASE, ("severity", S), ("available_beds", I), ("oxygen_level", D), ("expected_los_days", I)
    ),
    VACCINATION: _struct(
        *_BASE, ("record_id", S), ("vaccine_type", S), ("dose_number", I), ("administered_at", S)
    ),
}


def merged_event_schema() -> StructType:
    """One schema holding the fields of all four event types, for a single pass over a mixed stream."""
    merged, seen = StructType(), set()
    for schema in EVENT_SCHEMAS.values():
        for field in schema.fields:
            if field.name not in seen:
                seen.add(field.name)
                merged = merged.add(field)
    return merged


def _typed_events() -> StructType:
    """Cleaned events: the merged schema with a typed timestamp."""
    typed = StructType()
    for field in merged_event_schema().fields:
        typed = typed.add(field.name, TS if field.name == "timestamp" else field.dataType)
    return typed


# Counts are BIGINT throughout: an hour of one type in one region can pass 2^31 events at cluster scale.
RESULT_SCHEMAS = {
    "hourly_event_rate": _struct(
        ("hour", TS, REQUIRED), ("event_type", S, REQUIRED), ("region", S, REQUIRED), ("event_count", L, REQUIRED)
    ),
    "severity_trend": _struct(
        ("window_start", TS, REQUIRED),
        ("window_end", TS, REQUIRED),
        ("region", S, REQUIRED),
        ("event_type", S, REQUIRED),
        ("avg_severity", D, REQUIRED),
        ("sample_count", L, REQUIRED),
    ),
    "bed_availability": _struct(
        ("hour", TS, REQUIRED),
        ("region", S, REQUIRED),
        ("avg_available_beds", D, REQUIRED),
        ("min_available_beds", I, REQUIRED),
        ("sample_count", L, REQUIRED),
    ),
    "vaccination_trend": _struct(
        ("hour", TS, REQUIRED),
        ("region", S, REQUIRED),
        ("vaccine_type", S, REQUIRED),
        ("dose_number", I, REQUIRED),
        ("vaccination_count", L, REQUIRED),
    ),
    "outbreak_predictions": _struct(
        ("predicted_at", TS),
        ("hour", TS, REQUIRED),
        ("region", S, REQUIRED),
        ("total_events", L),
        ("avg_severity", D),
        ("min_available_beds", I),
        ("vaccination_count", L),
        ("event_score", D),
        ("severity_score", D),
        ("bed_pressure_score", D),
        ("vaccination_score", D),
        ("outbreak_risk_score", D),
        ("outbreak_risk_level", S),
    ),
    "data_quality_checks": _struct(
        ("checked_at", TS),
        ("check_name", S, REQUIRED),
        ("table_name", S),
        ("status", S, REQUIRED),
        ("row_count", L),
        ("latest_timestamp", TS),
        ("message", S),
    ),
    "alert_log": _struct(
        ("check_order", I, REQUIRED),
        ("event_time", TS),
        ("sort_value", D),
        ("level", S, REQUIRED),
        ("metric", S, REQUIRED),
        ("region", S),
        ("message", S),
        ("position", I, REQUIRED),
        ("polled_at", TS, REQUIRED),
        ("status", S, REQUIRED),
    ),
    # partial results: sums, counts and minima of the events of one batch
    "event_rollup": _struct(
        ("hour", TS, REQUIRED),
        ("event_type", S, REQUIRED),
        ("region", S, REQUIRED),
        ("vaccine_type", S),
        ("dose_number", I),
        ("event_count", L, REQUIRED),
        ("severity_sum", D),
        ("severity_count", L, REQUIRED),
        ("beds_sum", L),
        ("beds_min", I),
        ("beds_count", L, REQUIRED),
    ),
    "late_events": _struct(
        ("timestamp", TS, REQUIRED), ("event_type", S, REQUIRED), ("region", S, REQUIRED), ("watermark", TS, REQUIRED)
    ),
    "stream_progress": _struct(
        ("batch_number", L, REQUIRED),
        ("newest_time", TS, REQUIRED),
        ("row_count", L, REQUIRED),
        ("late_count", L, REQUIRED),
        ("watermark", TS),
    ),
    "stored_events": _typed_events(),
}

TIME_COLUMN = {
    "hourly_event_rate": "hour",
    "severity_trend": "window_start",
    "bed_availability": "hour",
    "vaccination_trend": "hour",
    "outbreak_predictions": "predicted_at",
    "data_quality_checks": "checked_at",
    "alert_log": "polled_at",
    "event_rollup": "hour",
    "late_events": "timestamp",
    "stream_progress": "newest_time",
    "stored_events": "timestamp",
}

# Row order in which each table is shown.
PRESENTATION_ORDER = {
    "hourly_event_rate": ["hour", "region", "event_type"],
    "severity_trend": ["window_start", "region", "event_type"],
    "bed_availability": ["hour", "region"],
    "vaccination_trend": ["hour", "region", "vaccine_type", "dose_number"],
    "outbreak_predictions": ["hour", "region"],
    "data_quality_checks": ["checked_at", "table_name", "check_name"],
    "alert_log": ["polled_at", "check_order", "position"],
}

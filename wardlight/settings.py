"""Thresholds and other parameters, with their default values."""

from __future__ import annotations

from dataclasses import dataclass

from wardlight import schemas

# Fixed values.
STALE_HOURS = 8
COOLDOWN_SECONDS = 300
RETENTION_DAYS = 7
EVENT_SOURCE = "event-generator"


@dataclass(frozen=True)
class AlertThresholds:
    event_warning: float = 5
    event_critical: float = 10
    severity_warning: float = 2.5
    severity_critical: float = 3.5
    beds_warning: float = 100
    beds_critical: float = 50
    vaccination_low: int = 1
    vaccination_surge: int = 30
    stale_hours: int = STALE_HOURS
    scan_rows: int | None = 20  # newest rows a check looks at; None for all rows


@dataclass(frozen=True)
class BedWarningThresholds:
    beds_warning: int = 10
    beds_critical: int = 5
    admissions_warning: int = 20
    admissions_critical: int = 40


# Tables the quality monitor watches, with the columns that must exist and hold no NULL.
WATCHED_TABLES = {
    name: schemas.RESULT_SCHEMAS[name].fieldNames()
    for name in ("hourly_event_rate", "severity_trend", "bed_availability", "vaccination_trend")
}

# Tables whose freshness decides whether the pipeline counts as healthy.
HEALTH_TABLES = ["hourly_event_rate", "severity_trend", "bed_availability"]

# Target stream per event type; any other type is unroutable.
ROUTES = {
    schemas.SYMPTOM: "symptom_reports",
    schemas.CLINIC: "clinic_visits",
    schemas.HOSPITAL: "hospital_admissions",
    schemas.VACCINATION: "vaccination_records",
}

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from wardlight import schemas, settings
from wardlight.operators import alerts, charts, quality, reports

NOW = datetime(2026, 4, 28, 22, 0)


def table(spark, name, rows):
    schema = schemas.RESULT_SCHEMAS[name]
    nullable = type(schema)([type(f)(f.name, f.dataType, True) for f in schema.fields])
    return spark.createDataFrame(rows, nullable)


def rate(spark, *rows):
    return table(spark, "hourly_event_rate", list(rows))


def as_dicts(df, *keys):
    return {tuple(row[k] for k in keys): row for row in df.collect()}


# --- quality -----------------------------------------------------------------------------------------------------


def checks_of(spark, df, as_of=NOW, columns=settings.WATCHED_TABLES["hourly_event_rate"]):
    found = quality.table_state_checks(spark, "hourly_event_rate", df, columns, as_of)
    return [(row.check_name, row.status, row.row_count, row.message) for row in found.collect()]


def test_good_table(spark):
    assert checks_of(spark, rate(spark, (NOW - timedelta(hours=8), "clinic_visit", "Boston", 3))) == [
        ("table_exists", "PASS", 1, "Table exists"),
        ("row_count_nonzero", "PASS", 1, "Table has data"),
        ("freshness", "PASS", 1, "Latest data is 8.0h old"),
        ("required_columns", "PASS", 1, "Required columns present"),
        ("null_key_values", "PASS", 1, "No null key values"),
    ]


def test_stale_table_with_nulls(spark):
    df = rate(spark, (NOW - timedelta(hours=8, minutes=15), "clinic_visit", None, 3), (None, None, None, None))
    assert checks_of(spark, df)[2:] == [
        ("freshness", "FAIL", 2, "Latest data is 8.2h old; threshold is 8h"),
        ("required_columns", "PASS", 2, "Required columns present"),
        ("null_key_values", "WARN", 2, "2 rows have null values in key columns"),
    ]


def test_table_without_any_time_is_not_fresh(spark):
    assert checks_of(spark, rate(spark, (None, "t", "r", 1)))[2][:2] == ("freshness", "FAIL")


def test_empty_table_ends_after_the_row_count(spark):
    assert checks_of(spark, rate(spark)) == [
        ("table_exists", "PASS", 0, "Table exists"),
        ("row_count_nonzero", "FAIL", 0, "Table has no rows"),
    ]


def test_absent_table(spark):
    assert checks_of(spark, None) == [
        ("table_exists", "FAIL", None, "Expected table hourly_event_rate does not exist")
    ]


def test_missing_columns_end_the_checks(spark):
    df = rate(spark, (NOW, "clinic_visit", "Boston", 3)).drop("region", "event_count")
    assert [c[0] for c in checks_of(spark, df)] == [
        "table_exists", "row_count_nonzero", "freshness", "required_columns"
    ]
    assert checks_of(spark, df)[-1][3] == "Missing columns: region, event_count"


def test_domain_checks(spark):
    tables = {
        "bed_availability": table(
            spark, "bed_availability", [(NOW, "a", -0.5, 0, 1), (NOW, "b", 1.0, -1, 1), (NOW, "c", 0.0, 0, 1)]
        ),
        "severity_trend": table(
            spark, "severity_trend",
            [(NOW, NOW, "a", "t", 4.0, 1), (NOW, NOW, "a", "t", 4.1, 1), (NOW, NOW, "a", "t", 0.0, 1)],
        ),
        "vaccination_trend": table(spark, "vaccination_trend", [(NOW, "a", "v", 1, 0), (NOW, "a", "v", 2, 5)]),
        "outbreak_predictions": None,
    }
    rows = as_dicts(quality.domain_checks(spark, tables, NOW), "check_name")
    assert (rows["bed_availability_nonnegative",].status, rows["bed_availability_nonnegative",].row_count) == ("FAIL", 2)
    assert (rows["severity_range",].status, rows["severity_range",].row_count) == ("FAIL", 1)
    assert (rows["vaccination_values",].status, rows["vaccination_values",].row_count) == ("PASS", 0)
    assert rows["severity_range",].message == "1 rows have avg_severity outside 0..4"
    assert rows["outbreak_prediction_table",].status == "WARN"
    assert rows["outbreak_prediction_table",].row_count is None
    report = quality.dq_report(spark, tables, NOW)
    rules = ["bed_availability_nonnegative", "severity_range", "vaccination_values"]
    assert report.where(report.check_name.isin(rules)).count() == 3
    assert report.where("table_name = 'hourly_event_rate'").count() == 1


def test_absent_tables_have_no_domain_checks(spark):
    assert quality.domain_checks(spark, {}, NOW).count() == 1


def test_summary_and_chart_of_statuses(spark):
    statuses = ["PASS", "PASS", "FAIL", "ODD"]
    checks = table(
        spark, "data_quality_checks", [(NOW, f"c{i}", "t", s, None, None, "m") for i, s in enumerate(statuses)]
    )
    assert tuple(quality.dq_summary(checks).first()) == (4, 2, 0, 1)
    assert [tuple(row) for row in charts.status_chart(checks).collect()] == [("PASS", 2), ("WARN", 0), ("FAIL", 1)]


# --- alerts ------------------------------------------------------------------------------------------------------


def test_event_rate_alerts(spark):
    df = rate(spark, (NOW, "hospital_admission", "Boston", 14), (NOW, "clinic_visit", "Salem", 5),
              (NOW, "clinic_visit", "Lynn", 4))
    rows = as_dicts(alerts.event_rate_alerts(df), "region")
    assert rows["Boston",].level == "critical"
    assert rows["Boston",].message == "hospital_admission had 14 events at 2026-04-28 22:00:00+00:00"
    assert rows["Salem",].level == "warning"
    assert set(rows) == {("Boston",), ("Salem",)}


def test_only_the_newest_rows_raise_alerts(spark):
    new = [(NOW, "clinic_visit", f"r{i:02d}", 1) for i in range(20)]
    df = rate(spark, *new, (NOW - timedelta(hours=1), "clinic_visit", "Boston", 99))
    assert alerts.event_rate_alerts(df).count() == 0


def test_severity_and_bed_alerts(spark):
    severity = table(
        spark, "severity_trend",
        [(NOW, NOW, "a", "symptom_report", 2.5, 2), (NOW, NOW, "b", "symptom_report", 3.5, 4),
         (NOW, NOW, "c", "symptom_report", 2.625, 8), (NOW, NOW, "d", "symptom_report", 2.4, 5)],
    )
    rows = as_dicts(alerts.severity_alerts(severity), "region")
    assert {k[0]: v.level for k, v in rows.items()} == {"a": "warning", "b": "critical", "c": "warning"}
    assert rows["c",].message == "symptom_report avg_severity=2.62 from 8 samples at 2026-04-28 22:00:00+00:00"
    beds = table(spark, "bed_availability", [(NOW, "a", 63.2, 42, 5), (NOW, "b", 120.0, 100, 1), (NOW, "c", 1e3, 101, 1)])
    rows = as_dicts(alerts.bed_alerts(beds), "region")
    assert {k[0]: v.level for k, v in rows.items()} == {"a": "critical", "b": "warning"}
    assert rows["a",].message == (
        "min_available_beds=42, avg_available_beds=63.20 at 2026-04-28 22:00:00+00:00"
    )


def test_vaccination_alerts_of_the_latest_hour(spark):
    before = NOW - timedelta(hours=1)
    df = table(
        spark, "vaccination_trend",
        [(before, "a", "influenza", 1, 1), (NOW, "a", "influenza", 1, 1), (NOW, "b", "influenza", 1, 1),
         (NOW, "b", "influenza", 2, 1), (NOW, "c", "measles", 1, 30)],
    )
    rows = [(r.level, r.metric, r.region, r.message) for r in alerts.vaccination_alerts(df).orderBy("region").collect()]
    assert rows == [
        ("warning", "vaccination_low", "a", "Only 1 influenza vaccination records at 2026-04-28 22:00:00+00:00"),
        ("info", "vaccination_surge", "c", "30 measles vaccination records at 2026-04-28 22:00:00+00:00"),
    ]


def test_data_quality_alerts(spark):
    checks = table(
        spark, "data_quality_checks",
        [(NOW - timedelta(hours=12), "freshness", "severity_trend", "FAIL", 1, None, "old"),
         (NOW - timedelta(hours=12, seconds=1), "freshness", "bed_availability", "FAIL", 1, None, "old"),
         (NOW, "null_key_values", "", "WARN", 1, None, "nulls"), (NOW, "x", None, "WARN", 1, None, "n"),
         (NOW, "table_exists", "severity_trend", "PASS", 1, None, "ok")],
    )
    rows = {(r.level, r.region, r.message) for r in alerts.data_quality_alerts(checks, NOW).collect()}
    assert rows == {
        ("critical", "severity_trend", "freshness=FAIL at 2026-04-28 10:00:00+00:00: old"),
        ("warning", "pipeline", "null_key_values=WARN at 2026-04-28 22:00:00+00:00: nulls"),
        ("warning", "pipeline", "x=WARN at 2026-04-28 22:00:00+00:00: n"),
    }


def test_freshness_alert(spark):
    exactly = rate(spark, (NOW - timedelta(hours=8), "t", "r", 1))
    assert alerts.freshness_alerts(exactly, NOW).count() == 0
    old = rate(spark, (NOW - timedelta(hours=13), "t", "r", 1))
    assert alerts.freshness_alerts(old, NOW).first().message == (
        "hourly_event_rate latest row is 13.0h old; threshold is 8h"
    )
    assert alerts.freshness_alerts(rate(spark), NOW).first().message == "hourly_event_rate has no rows"


def test_feed_of_empty_tables_reports_the_missing_data(spark):
    empty = {name: table(spark, name, []) for name in schemas.RESULT_SCHEMAS}
    assert [(r.check_order, r.metric, r.position) for r in alerts.alert_feed(empty, NOW).collect()] == [
        (6, "pipeline_freshness", 1)
    ]


# --- reports -----------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def labelled(spark):
    beds = table(
        spark, "bed_availability",
        [(NOW, "Boston", 8.3, 3, 12), (NOW, "Cambridge", 22.1, 18, 9), (NOW, "Springfield", 4.0, 2, 7),
         (NOW, "Worcester", 15.5, 11, 5), (NOW - timedelta(hours=1), "Worcester", 1.0, 1, 1)],
    )
    admissions = rate(
        spark, *[(NOW, "hospital_admission", r, n) for r, n in
                 [("Boston", 45), ("Cambridge", 12), ("Springfield", 38), ("Worcester", 18)]],
        (NOW + timedelta(hours=1), "clinic_visit", "Cambridge", 99),
        (NOW - timedelta(hours=1), "hospital_admission", "Cambridge", 99),
    )
    return reports.labelled_regions(beds, admissions)


def test_bed_warning_report(labelled):
    rows = [(r.severity, r.metric, r.region, r.observed, r.threshold, r.detail)
            for r in reports.bed_warning_report(labelled).collect()]
    assert rows == [
        ("CRITICAL", "min_available_beds", "Boston", 3, 5, "avg=8.3, min=3, samples=12"),
        ("CRITICAL", "min_available_beds", "Springfield", 2, 5, "avg=4.0, min=2, samples=7"),
        ("CRITICAL", "hospital_admission_count", "Boston", 45, 40, "event_type=hospital_admission, count=45"),
        ("WARNING", "hospital_admission_count", "Springfield", 38, 20, "event_type=hospital_admission, count=38"),
    ]
    assert tuple(reports.bed_warning_summary(labelled).first()) == (4, 4, 4, 3)


def test_pipeline_health(spark):
    states = spark.createDataFrame(
        [("hourly_event_rate", 3840, NOW - timedelta(hours=4)), ("severity_trend", 2210, NOW - timedelta(hours=13)),
         ("bed_availability", 0, None), ("edge", 1, NOW - timedelta(hours=8))],
        "table_name string, row_count bigint, latest_time timestamp",
    )
    health = reports.pipeline_health(states, NOW)
    rows = as_dicts(health, "table_name")
    assert {k[0]: v.status for k, v in rows.items()} == {
        "hourly_event_rate": "HEALTHY", "severity_trend": "STALE", "bed_availability": "EMPTY", "edge": "HEALTHY",
    }
    assert rows["bed_availability",].age_hours is None
    assert rows["severity_trend",].message.startswith("Latest row is 13.0h old (threshold: 8h)")
    assert tuple(reports.pipeline_health_summary(health).first()) == (2, 2, 4, "UNHEALTHY")


def test_retention_keeps_the_limit_itself(spark):
    df = rate(spark, (NOW - timedelta(days=7), "t", "keep", 1), (NOW - timedelta(days=7, seconds=1), "t", "drop", 1))
    assert [row.region for row in reports.retained(df, "hour", NOW).collect()] == ["keep"]


def test_pivots_fill_or_keep_gaps(spark):
    later = NOW + timedelta(hours=1)
    severity = table(spark, "severity_trend", [(NOW, NOW, "a", "t", 2.0, 1), (NOW, NOW, "a", "u", 3.0, 1),
                                               (later, later, "b", "t", 1.0, 1)])
    assert {tuple(r) for r in charts.severity_chart(severity, ["a", "b"]).collect()} == {
        (NOW, 2.5, 0.0), (later, 0.0, 1.0)
    }
    beds = table(spark, "bed_availability", [(NOW, "a", 2.0, 1, 1), (later, "b", 1.0, 4, 1)])
    assert {tuple(r) for r in charts.beds_chart(beds, ["a", "b"]).collect()} == {(NOW, 1, None), (later, None, 4)}


def test_domain_check_needs_only_its_own_columns(spark):
    from wardlight.operators import quality

    rows = spark.createDataFrame([("a", 9.0)], "region string, avg_severity double")
    rows = rows.selectExpr("TIMESTAMP '2026-01-01 00:00:00' AS window_start", "*")
    report = quality.dq_report(spark, {"severity_trend": rows}, as_of="2026-01-01 01:00:00").collect()
    found = {(r["check_name"], r["table_name"]): r["status"] for r in report}
    assert found["required_columns", "severity_trend"] == "FAIL"
    assert ("severity_range", "severity_trend") in found

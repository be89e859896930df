from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wardlight import schemas
from wardlight.operators import aggregates, risk
from wardlight.sources import derived, events

DDL = (
    "event_type string, timestamp timestamp, region string, severity string, available_beds int, vaccine_type string, "
    "dose_number int"
)


def at(hour, minute=0):
    return datetime(2026, 4, 28, hour, minute)


def as_set(df, *columns):
    return {tuple(row) for row in df.select(*(columns or df.columns)).collect()}


@pytest.fixture(scope="module")
def derived_events(spark, sf_dir):
    return events.clean(derived.derived_events(spark, sf_dir, schemas.EVENT_TYPES))


def typed(df):
    return [df.where(F.col("event_type") == t) for t in schemas.EVENT_TYPES]


def direct(df):
    symptom, clinic, hospital, vaccination = typed(df)
    return {
        "hourly_event_rate": aggregates.hourly_event_rate(symptom, clinic, hospital, vaccination),
        "severity_trend": aggregates.severity_trend(symptom, hospital),
        "bed_availability": aggregates.bed_availability(hospital),
        "vaccination_trend": aggregates.vaccination_trend(vaccination),
    }


@pytest.fixture(scope="module")
def sample(spark):
    rows = [
        ("symptom_report", at(1, 5), "Boston", "low", 7, None, None),
        ("symptom_report", at(1, 59), "Boston", "critical", None, None, None),
        ("symptom_report", at(2), "Boston", "Severe", None, None, None),
        ("symptom_report", at(2), "Boston", None, None, None, None),
        ("hospital_admission", at(1), "Boston", "severe", 10, None, None),
        ("hospital_admission", at(1, 30), "Boston", "unknown", 3, None, None),
        ("hospital_admission", at(1, 31), "Boston", None, None, None, None),
        ("clinic_visit", at(1), "Salem", "critical", 1, None, None),
        ("vaccination_record", at(1), "Salem", "critical", 1, "influenza", 1),
        ("vaccination_record", at(1), "Salem", None, None, "influenza", 1),
        ("vaccination_record", at(1), "Salem", None, None, "influenza", 2),
        ("vaccination_record", at(1), "Salem", None, None, "influenza", 0),
        ("vaccination_record", at(1), "Salem", None, None, None, 1),
        ("vaccination_record", at(1), "Salem", None, None, "measles", None),
    ]
    return spark.createDataFrame(rows, DDL)


@pytest.mark.parametrize("way", ["direct", "rollup"])
def test_results_on_hand_written_events(sample, way):
    results = direct(sample) if way == "direct" else aggregates.results_from_rollup(aggregates.event_rollup(sample))
    assert as_set(results["hourly_event_rate"], "hour", "event_type", "region", "event_count") == {
        (at(1), "symptom_report", "Boston", 2),
        (at(2), "symptom_report", "Boston", 2),
        (at(1), "hospital_admission", "Boston", 3),
        (at(1), "clinic_visit", "Salem", 1),
        (at(1), "vaccination_record", "Salem", 6),
    }
    assert as_set(results["severity_trend"]) == {
        (at(1), at(2), "Boston", "symptom_report", 2.5, 2),
        (at(1), at(2), "Boston", "hospital_admission", 3.0, 1),
    }
    assert as_set(results["bed_availability"]) == {(at(1), "Boston", 6.5, 3, 2)}
    assert as_set(results["vaccination_trend"]) == {
        (at(1), "Salem", "influenza", 1, 2),
        (at(1), "Salem", "influenza", 2, 1),
    }


def test_rollup_equals_direct_aggregates(derived_events):
    expected = direct(derived_events)
    for table, result in aggregates.results_from_rollup(aggregates.event_rollup(derived_events)).items():
        assert as_set(result, *expected[table].columns) == as_set(expected[table]), table


def test_risk_from_rollup_equals_risk_from_joins(sample, derived_events):
    for frame in (sample, derived_events):
        joined = risk.outbreak_risk(risk.joined_features(*direct(frame).values()))
        rolled = risk.outbreak_risk(risk.features_from_rollup(aggregates.event_rollup(frame)))
        assert as_set(rolled, *joined.columns) == as_set(joined)


def test_missing_features_get_their_defaults(sample):
    features = risk.joined_features(*direct(sample).values())
    assert as_set(features) == {
        (at(1), "Boston", 5, 2.75, 3, 0),
        (at(2), "Boston", 2, 0.0, 999, 0),
        (at(1), "Salem", 7, 0.0, 999, 3),
    }


def test_mean_severity_is_a_mean_of_means(spark):
    severity = spark.createDataFrame(
        [(at(1), "Boston", 4.0, 1), (at(1), "Boston", 1.0, 99)],
        "window_start timestamp, region string, avg_severity double, sample_count bigint",
    )
    assert as_set(risk.severity_features(severity)) == {(at(1), "Boston", 2.5)}


def test_absent_stream_is_left_out(sample):
    symptom, clinic, hospital, _ = typed(sample)
    rate = aggregates.hourly_event_rate(symptom, clinic, hospital, None)
    assert "vaccination_record" not in {row.event_type for row in rate.collect()}


def test_counts_add_up(derived_events):
    rate = direct(derived_events)["hourly_event_rate"]
    assert rate.agg(F.sum("event_count")).first()[0] == derived_events.count()


def test_risk_stays_between_0_and_1(derived_events):
    scores = risk.outbreak_risk(risk.features_from_rollup(aggregates.event_rollup(derived_events)))
    low, high = scores.agg(F.min("outbreak_risk_score"), F.max("outbreak_risk_score")).first()
    assert 0 <= low <= high <= 1


def test_results_do_not_depend_on_partitioning(spark, derived_events):
    seen = []
    for parts in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        frame = derived_events.repartition(int(parts))
        seen.append({table: as_set(result) for table, result in direct(frame).items()})
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert seen[0] == seen[1]


def test_empty_input(spark):
    empty = spark.createDataFrame([], DDL)
    for result in [*direct(empty).values(), *aggregates.results_from_rollup(aggregates.event_rollup(empty)).values()]:
        assert result.count() == 0
    assert risk.joined_features(*direct(empty).values()).count() == 0

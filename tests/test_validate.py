"""Validation and routing of hand-written messages."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from wardlight import schemas
from wardlight.operators import route, validate
from wardlight.sources import derived, events

BASE = {"event_type": "symptom_report", "timestamp": "2026-04-27T14:32:00Z", "region": "Boston"}
VACCINATION = {
    "event_type": "vaccination_record",
    "schema_version": 2,
    "timestamp": "2026-04-27T14:32:00Z",
    "record_id": "r1",
    "patient_id": "p1",
    "region": "Boston",
    "vaccine_type": "influenza",
    "dose_number": 1,
    "administered_at": "2026-04-27T14:00:00Z",
}


def base(**fields):
    return json.dumps({**BASE, **fields})


def vaccination(**fields):
    return json.dumps({**VACCINATION, **fields})


def without(record, *names):
    return json.dumps({k: v for k, v in record.items() if k not in names})


CASES = [
    (base(), "valid", []),
    # JSON
    (None, "bad_json", []),
    ("", "bad_json", []),
    ("null", "bad_json", []),
    ("[1]", "bad_json", []),
    ('"s"', "bad_json", []),
    ("5", "bad_json", []),
    (base()[:-5], "bad_json", []),
    (base() + " x", "bad_json", []),
    (base() + base(), "bad_json", []),
    (base() + "," + base(), "bad_json", []),
    (base() + "],[" + base(), "bad_json", []),
    (base().replace('"', "'"), "bad_json", []),
    ("  " + base() + "\n", "valid", []),
    ('{"region": "x", "region": "", "event_type": "a", "timestamp": "2026-01-01"}', "missing_fields", ["region"]),
    # required fields
    ("{}", "missing_fields", ["event_type", "timestamp", "region"]),
    (without(BASE, "region"), "missing_fields", ["region"]),
    (base(region=None), "missing_fields", ["region"]),
    (base(region=""), "missing_fields", ["region"]),
    (base(region=" "), "valid", []),
    (base(region=0), "valid", []),
    (base(region=False), "valid", []),
    (base(region={"name": "Boston"}), "valid", []),
    (base(region=[]), "valid", []),
    (base(event_type="general_health_report"), "valid", []),
    (without(VACCINATION, "record_id", "vaccine_type"), "missing_fields", ["record_id", "vaccine_type"]),
    (vaccination(dose_number=None, schema_version=""), "missing_fields", ["schema_version", "dose_number"]),
    # timestamps
    (base(timestamp="not-a-time"), "bad_timestamp", []),
    (base(timestamp="2026-W17-1"), "valid", []),
    (base(timestamp=20260427), "valid", []),
    (base(timestamp=20260427.0), "bad_timestamp", []),
    (base(timestamp=True), "bad_timestamp", []),
    (base(timestamp="2026-04"), "bad_timestamp", []),
    # vaccination records
    (vaccination(), "valid", []),
    (vaccination(schema_version="2"), "valid", []),
    (vaccination(schema_version=2.0), "bad_schema_version", []),
    (vaccination(schema_version=1), "bad_schema_version", []),
    (vaccination(schema_version=" 2"), "bad_schema_version", []),
    (vaccination(schema_version=True), "bad_schema_version", []),
    (base(schema_version=1), "valid", []),
    (vaccination(dose_number="1"), "valid", []),
    (vaccination(dose_number=" 2 "), "valid", []),
    (vaccination(dose_number="+0_1"), "valid", []),
    (vaccination(dose_number=1.9), "valid", []),
    (vaccination(dose_number=True), "valid", []),
    (vaccination(dose_number=10**30), "valid", []),
    (vaccination(dose_number="9" * 40), "valid", []),
    (vaccination(dose_number=0), "bad_dose_number", []),
    (vaccination(dose_number=0.9), "bad_dose_number", []),
    (vaccination(dose_number=-1), "bad_dose_number", []),
    (vaccination(dose_number=False), "bad_dose_number", []),
    (vaccination(dose_number="1.9"), "bad_dose_number", []),
    (vaccination(dose_number="0"), "bad_dose_number", []),
    (vaccination(dose_number="1__0"), "bad_dose_number", []),
    (vaccination(dose_number="one"), "bad_dose_number", []),
    (vaccination(dose_number=[1]), "bad_dose_number", []),
    (vaccination(administered_at="yesterday"), "bad_administered_at", []),
    # the first failure counts
    (vaccination(timestamp="x", dose_number=0, schema_version=1), "bad_timestamp", []),
    (vaccination(dose_number=0, schema_version=1), "bad_schema_version", []),
    (vaccination(dose_number=0, administered_at="x"), "bad_dose_number", []),
]


@pytest.fixture(scope="module")
def messages(spark):
    rows = [(i, case[0]) for i, case in enumerate(CASES)]
    return spark.createDataFrame(rows, "offset int, value string").repartition(3)


def test_verdicts(messages):
    rows = validate.validate_events(messages).collect()
    got = {row.offset: (row.reason, row.missing_fields) for row in rows}
    expected = {i: (reason, missing) for i, (_, reason, missing) in enumerate(CASES)}
    assert {CASES[i][0]: got[i] for i in got if got[i] != expected[i]} == {}
    assert len(got) == len(CASES)


def test_summary_adds_up(messages):
    row = validate.validation_summary(validate.validate_events(messages)).first()
    valid = sum(reason == "valid" for _, reason, _ in CASES)
    assert tuple(row) == (len(CASES), valid, len(CASES) - valid)


def test_valid_messages_keep_their_text(messages):
    rows = validate.valid_messages(messages).collect()
    assert {row.value for row in rows} == {text for text, reason, _ in CASES if reason == "valid"}
    assert rows[0].asDict().keys() == {"offset", "value"}


def test_bytes_that_are_not_text_are_bad_json(spark):
    raw = spark.createDataFrame([(bytearray(b'{"a": "\xff"}'),), (bytearray(base().encode()),)], "value binary")
    judged = validate.validate_events(raw.withColumn("value", events.text_payload(raw)))
    assert sorted(row.reason for row in judged.collect()) == ["bad_json", "valid"]


@pytest.mark.parametrize("sf,expected", [
    ("0.001", {"bad_json": 13, "missing_fields": 37, "bad_timestamp": 11, "bad_schema_version": 16,
               "bad_dose_number": 24, "valid": 899}),
    ("0.01", {"bad_json": 121, "missing_fields": 401, "bad_timestamp": 105, "bad_schema_version": 173,
              "bad_dose_number": 389, "valid": 8811}),
])
def test_verdict_counts_of_the_test_tables(spark, sf, expected):
    judged = validate.validate_events(derived.raw_messages(spark, f"/root/testdata/sf{sf}"))
    assert {row.reason: row["count"] for row in judged.groupBy("reason").count().collect()} == expected


def enriched(spark, *texts):
    frame = spark.createDataFrame([(text,) for text in texts], "value string")
    return route.enrich_events(frame, "team-a", "2026-04-28 10:00:00", "unit-test").collect()


def test_enrichment_keeps_other_fields_as_they_are(spark):
    (row,) = enriched(spark, base(available_beds=5.0, extra={"a": [1, None]}))
    expected = {
        **BASE,
        "available_beds": 5.0,
        "extra": {"a": [1, None]},
        "team_id": "team-a",
        "processing_timestamp": "2026-04-28T10:00:00.000000Z",
        "event_source": "unit-test",
    }
    assert json.loads(row.value) == expected
    assert '"available_beds": 5.0' in row.value
    assert (row.team_id, row.event_source) == ("team-a", "unit-test")


def test_enrichment_replaces_fields_of_the_same_name(spark):
    (row,) = enriched(spark, base(team_id="other", event_source=None, age=7))
    pairs = json.loads(row.value, object_pairs_hook=list)
    assert len(pairs) == len(dict(pairs))
    assert dict(pairs) == {
        **BASE, "age": 7, "team_id": "team-a", "event_source": "unit-test",
        "processing_timestamp": "2026-04-28T10:00:00.000000Z",
    }


def test_enrichment_of_an_empty_object_and_of_bad_json(spark):
    empty, bad = enriched(spark, " {} ", "{cut")
    assert json.loads(empty.value)["team_id"] == "team-a"
    assert bad.value == "{cut"


def test_routing(spark):
    types = [*schemas.EVENT_TYPES, "vaccination", "general_health_report", "emergency_incident", None, 5]
    texts = [base(event_type=t) for t in types] + ["{cut"]
    frame = spark.createDataFrame([(text,) for text in texts], "value string")
    targeted = route.with_target(frame, "team-a")
    routed = {row.event_type: row.topic for row in route.route_events(targeted).collect()}
    assert routed == {
        "symptom_report": "symptom_reports",
        "clinic_visit": "clinic_visits",
        "hospital_admission": "hospital_admissions",
        "vaccination_record": "vaccination_records",
    }
    assert route.unroutable_events(targeted).count() == 6
    assert tuple(route.routing_summary(targeted).first()) == (10, 4, 6)


def test_decoding_is_stricter_than_validation(spark):
    """Text or fractional doses pass validation but do not fit the declared integer."""
    doses = [1, "1", 1.9, True]
    frame = spark.createDataFrame([(vaccination(dose_number=dose),) for dose in doses], "value string")
    assert {row.reason for row in validate.validate_events(frame).collect()} == {"valid"}
    decoded = events.scan_events(frame, schemas.EVENT_SCHEMAS[schemas.VACCINATION]).collect()
    assert [row.dose_number for row in decoded] == [1, None, None, None]


def test_cleaning_drops_what_cannot_be_typed(spark):
    texts = [
        base(),
        base(timestamp="20260427T143200"),
        base(timestamp="x"),
        base(region=None),
        base(region=""),
        without(BASE, "event_type"),
        "{cut",
    ]
    frame = spark.createDataFrame([(text,) for text in texts], "value string")
    cleaned = events.scan_events(frame, schemas.EVENT_SCHEMAS[schemas.SYMPTOM])
    assert sorted(row.region for row in cleaned.collect()) == ["", "Boston"]
    assert cleaned.schema["timestamp"].dataType.simpleString() == "timestamp"
    assert cleaned.agg(F.max("timestamp").cast("string")).first()[0] == "2026-04-27 14:32:00"


def test_numbers_that_json_lacks(spark):
    from wardlight.operators import validate

    rows = [('{"event_type": "a", "x": +INF}', True), ('{"event_type": "a", "x": -INF}', True)]
    rows += [('{"event_type": "a", "x": -Infinity}', False), ('{"event_type": "a", "x": "y, +INF \\" -INF"}', False)]
    messages = spark.createDataFrame([r[:1] for r in rows], "value string")
    bad = validate.parse(messages).select("value", validate.is_bad_json().alias("bad")).collect()
    assert {r["value"]: r["bad"] for r in bad} == dict(rows)

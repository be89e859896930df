"""Physical plans: what is read, shuffled and joined."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

import pytest

from wardlight import schemas
from wardlight.operators import aggregates, reports, risk
from wardlight.plans import refresh, registry
from wardlight.session import build_session, work_dir

WRITES = {"sink_full_refresh", "pipeline_from_raw", "alert_cycle", "retention_clean_up", "optional_source_present",
          "stored_hourly_event_rate", "stored_severity_trend", "stored_bed_availability", "stored_vaccination_trend",
          "stored_outbreak_predictions", "stored_data_quality_checks", "pipeline_refresh", "pipeline_refresh_state",
          "predictions_refresh", "dq_history_append", "dq_table_state", *(f"incremental_{t}" for t in refresh.ANALYTICS),
          "ingest_stream", "publish_valid", "publish_routed", "alert_cooldown_stream", "alert_cooldown_stream_status",
          "ingest_stream_summary", "route_stream_summary"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(plan: str, table: str) -> list[str]:
    return [line for line in plan.splitlines() if "FileScan" in line and f"/{table}.parquet" in line]


@pytest.mark.parametrize(
    "name", [n for n in registry.QUERIES if n not in WRITES and not n.startswith("stream_")]
)
def test_no_query_multiplies_rows(spark, sf_dir, name):
    plan = plan_of(registry.QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_typed_stream_reads_its_rows_and_columns_only(spark, sf_dir):
    plan = plan_of(registry.QUERIES["bed_availability"](spark, sf_dir))
    (scan,) = scans(plan, "events")
    assert "EqualTo(event_type,purchase)" in scan
    assert "value" not in scan.split("ReadSchema")[1] and "event_id" not in scan.split("ReadSchema")[1]


def test_rate_is_pre_aggregated_before_its_only_shuffle(spark, sf_dir):
    plan = plan_of(aggregates.hourly_event_rate(registry._typed(spark, sf_dir)))
    assert plan.count("Exchange hashpartitioning") == 1
    below = plan.split("Exchange hashpartitioning")[1]
    assert "partial_count(1)" in below.splitlines()[1]


def test_risk_reads_the_events_once(spark, sf_dir):
    plan = plan_of(registry.QUERIES["outbreak_risk"](spark, sf_dir))
    assert len(scans(plan, "events")) == 1
    assert plan.count("Exchange hashpartitioning") == 2
    assert "SortMergeJoin" not in plan


def stored(spark, table, rows):
    """A table that Spark knows nothing about but its files, as in production."""
    path = work_dir(spark, f"plan-{table}")
    spark.createDataFrame(rows, schemas.RESULT_SCHEMAS[table]).write.parquet(path)
    return spark.read.parquet(path)


def test_joins_of_features_add_no_shuffle(spark):
    now = datetime(2026, 4, 28, 22)
    tables = [
        stored(spark, "hourly_event_rate", [(now, "t", "r", 1)]),
        stored(spark, "severity_trend", [(now, now + timedelta(hours=1), "r", "t", 1.0, 1)]),
        stored(spark, "bed_availability", [(now, "r", 1.0, 1, 1)]),
        stored(spark, "vaccination_trend", [(now, "r", "v", 1, 1)]),
    ]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(risk.joined_features(*tables))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("SortMergeJoin") == 3
    # one per aggregated table, none of them for a join
    assert plan.count("Exchange hashpartitioning") == 4


def test_latest_row_is_a_hash_aggregation(spark):
    plan = plan_of(reports.latest_beds(stored(spark, "bed_availability", [(datetime(2026, 4, 28), "r", 1.0, 1, 1)])))
    assert re.search(r"HashAggregate.*partial_max_by", plan)
    assert "SortAggregate" not in plan


@pytest.mark.parametrize("name", ["top_event_rate", "top_risk", "chart_top_beds", "recent_rows"])
def test_top_rows_are_cut_down_in_every_task(spark, sf_dir, name):
    assert "TakeOrderedAndProject" in plan_of(registry.QUERIES[name](spark, sf_dir))


def test_message_text_is_parsed_once(spark, sf_dir):
    for name in ("route_events", "validate_events", "scan_events"):
        plan = plan_of(registry.QUERIES[name](spark, sf_dir))
        assert plan.count("from_json(") == (2 if name == "route_events" else 1), name


def test_hot_key_gives_the_same_result(spark):
    """One region with most of the rows."""
    rows = spark.range(30_000).selectExpr(
        "'hospital_admission' AS event_type",
        "timestamp'2026-04-28 00:00:00' + make_interval(0, 0, 0, 0, 0, id % 120) AS timestamp",
        "if(id % 10 < 7, 'hot', concat('r', id % 50)) AS region",
        "CAST(id % 300 AS INT) AS available_beds",
    )
    beds = aggregates.bed_availability(rows)
    totals = {row.region: row.total for row in beds.groupBy("region").agg({"sample_count": "sum"}).withColumnRenamed(
        "sum(sample_count)", "total").collect()}
    assert totals["hot"] == 21_000 and sum(totals.values()) == 30_000


def test_session_settings():
    session = build_session()
    assert session.conf.get("spark.sql.session.timeZone") == "UTC"


def test_newest_hour_reads_its_input_once(spark, sf_dir):
    plan = plan_of(registry.QUERIES["vaccination_latest_hour"](spark, sf_dir))
    assert len(scans(plan, "events")) == 1


@pytest.mark.parametrize("name", ["alert_feed", "table_row_counts", "scan_result_tables"])
def test_queries_over_all_tables_read_stored_ones(spark, sf_dir, name):
    plan = plan_of(registry.QUERIES[name](spark, sf_dir))
    assert not scans(plan, "events") and "rangepartitioning" not in plan


def test_poll_reads_the_newest_dates_only(spark, sf_dir):
    database = registry._refreshed(spark, sf_dir, "poll-plan")
    plan = plan_of(refresh.poll_alerts(spark, database, "2024-01-31 12:00:00"))
    read = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(read) == 5 and all("PartitionFilters: [isnotnull(event_date" in line for line in read)

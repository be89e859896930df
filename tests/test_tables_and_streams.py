"""Stored tables, refresh jobs and streaming ingestion."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wardlight import schemas
from wardlight.operators import aggregates, validate
from wardlight.plans import refresh
from wardlight.sinks import tables as store
from wardlight.sources import derived, events
from wardlight.streaming import ingest, rates

NOW = datetime(2026, 4, 28, 22, 0)


def rate(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.RESULT_SCHEMAS["hourly_event_rate"])


def regions(df):
    return sorted(row.region for row in df.collect())


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    yield store.create_database(spark, name, str(tmp_path / "tables"))
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_refresh_replaces_and_reader_prunes_dates(spark, database):
    assert store.read_table(spark, database, "hourly_event_rate") is None
    store.refresh_table(spark, database, "hourly_event_rate", rate(spark, (NOW - timedelta(days=3), "t", "old", 1)))
    new = rate(spark, (NOW, "t", "a", 1), (NOW - timedelta(days=1), "t", "b", 2), (NOW - timedelta(days=9), "t", "c", 3))
    store.refresh_tables(spark, database, {"hourly_event_rate": new})
    assert regions(store.read_table(spark, database, "hourly_event_rate")) == ["a", "b", "c"]
    recent = store.read_table(
        spark, database, "hourly_event_rate", since="2026-04-27 22:00:00", until="2026-04-28 22:00:00"
    )
    assert regions(recent) == ["b"]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert recent.columns == schemas.RESULT_SCHEMAS["hourly_event_rate"].fieldNames()


def test_tables_are_found_by_name(spark, database):
    store.refresh_table(spark, database, "hourly_event_rate", rate(spark, (NOW, "t", "a", 1)))
    assert spark.catalog.tableExists(f"{database}.hourly_event_rate")
    assert not store.exists(spark, database, "severity_trend")
    assert store.existing(spark, database, "hourly_event_rate", "severity_trend") == ["hourly_event_rate"]
    (row,) = spark.sql(f"SELECT * FROM {database}.hourly_event_rate WHERE event_date = DATE'2026-04-28'").collect()
    assert row.region == "a"
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE {database}.hourly_event_rate").collect()}
    assert described["event_count"] == "bigint" and "# Partition Information" in described


def test_only_the_dates_of_the_new_rows_are_replaced(spark, database):
    days = [NOW - timedelta(days=n) for n in range(3)]
    store.refresh_table(spark, database, "hourly_event_rate", rate(spark, *[(d, "t", f"old{d.day}", 1) for d in days]))
    store.refresh_dates(spark, database, "hourly_event_rate", rate(spark, (days[1], "t", "new", 1)))
    assert regions(store.read_table(spark, database, "hourly_event_rate")) == ["new", "old26", "old28"]


def test_failed_refresh_leaves_other_dates_and_tables(spark, database):
    store.refresh_table(spark, database, "hourly_event_rate", rate(spark, (NOW, "t", "old", 1)))
    broken = rate(spark, (NOW, "t", "new", 1)).withColumn("event_count", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        store.refresh_dates(spark, database, "hourly_event_rate", broken)
    assert regions(store.read_table(spark, database, "hourly_event_rate")) == ["old"]


def test_missing_values_of_required_columns_are_refused(spark, database):
    rows = spark.createDataFrame([(NOW, "t", None, 1)], "hour timestamp, event_type string, region string, event_count long")
    for write in (store.refresh_table, store.refresh_dates):
        with pytest.raises(Exception, match="hourly_event_rate.region must not be NULL"):
            write(spark, database, "hourly_event_rate", rows)
    assert store.read_table(spark, database, "hourly_event_rate").isEmpty()


def check(spark, name, day=NOW):
    row = (day, name, "t", "PASS", 1, day, "m")
    return spark.createDataFrame([row], schemas.RESULT_SCHEMAS["data_quality_checks"])


def names(df):
    return sorted(row.check_name for row in df.collect())


def test_append_keeps_earlier_rows(spark, database):
    assert [store.append_rows(spark, database, "data_quality_checks", check(spark, name)) for name in ("a", "b")] == [1, 1]
    stored = store.read_table(spark, database, "data_quality_checks")
    assert names(stored) == ["a", "b"] and stored.columns == schemas.RESULT_SCHEMAS["data_quality_checks"].fieldNames()
    with pytest.raises(ValueError, match="no partition for an append"):
        store.append_rows(spark, database, "hourly_event_rate", rate(spark, (NOW, "t", "a", 1)))


def test_parallel_appends_lose_nothing(spark, database):
    from concurrent.futures import ThreadPoolExecutor

    store.create_table(spark, database, "data_quality_checks")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: store.append_rows(spark, database, "data_quality_checks", check(spark, f"r{i}")), range(4)))
    assert names(store.read_table(spark, database, "data_quality_checks")) == ["r0", "r1", "r2", "r3"]


def test_writes_count_their_rows(spark, database):
    rows = rate(spark, *[(NOW - timedelta(days=n % 3), "t", f"r{n}", 1) for n in range(10)])
    assert store.refresh_table(spark, database, "hourly_event_rate", rows) == 10
    assert store.refresh_dates(spark, database, "hourly_event_rate", rows.where("region = 'r1'")) == 1
    assert store.refresh_dates(spark, database, "hourly_event_rate", rows.limit(0)) == 0


def test_pipeline_on_stored_tables(spark, sf_dir, database):
    cleaned = events.clean(derived.derived_events(spark, sf_dir))
    refresh.refresh_analytics(spark, cleaned, database)
    refresh.refresh_analytics(spark, cleaned, database)
    refresh.refresh_predictions(spark, database, "2024-01-31 06:00:00")
    history = refresh.record_checks(spark, database, "2024-01-31 06:00:00")
    stored = refresh.read_analytics(spark, database)
    routable = cleaned.where(F.col("event_type").isin(schemas.EVENT_TYPES)).count()
    assert stored["hourly_event_rate"].agg(F.sum("event_count")).first()[0] == routable
    predictions = store.read_table(spark, database, "outbreak_predictions")
    assert predictions.count() == stored["hourly_event_rate"].select("hour", "region").distinct().count()
    assert history.count() == 24
    feed = refresh.poll_alerts(spark, database, "2024-02-03 06:00:00").collect()
    assert [row.metric for row in feed if row.check_order == 6] == ["pipeline_freshness"]
    assert refresh.read_rollup(spark, database).agg(F.sum("event_count")).first()[0] == routable


def test_events_are_stored_by_date_and_type(spark, sf_dir, database):
    derived_rows = events.clean(derived.derived_events(spark, sf_dir, schemas.EVENT_TYPES))
    missing = [f for f in schemas.RESULT_SCHEMAS["stored_events"].fields if f.name not in derived_rows.columns]
    cleaned = derived_rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])
    store.refresh_table(spark, database, "stored_events", cleaned)
    stored = store.with_partitions(spark, database, "stored_events")
    assert stored.count() == cleaned.count()
    hospital = stored.where("event_type = 'hospital_admission' AND event_date = DATE'2024-01-02'")
    filters = hospital._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1].split("]")[0]
    assert "event_type" in filters and "event_date" in filters
    assert hospital.count() == cleaned.where(
        "event_type = 'hospital_admission' AND to_date(timestamp) = DATE'2024-01-02'"
    ).count()


# --- incremental refresh ------------------------------------------------------------------------------------------


def contents(tables):
    return {name: sorted(map(tuple, df.collect())) for name, df in tables.items()}


def full_results(cleaned):
    results = aggregates.results_from_rollup(aggregates.event_rollup(cleaned))
    return contents({name: store.conform(df, name) for name, df in results.items()})


@pytest.mark.parametrize("parts", [1, 3])
def test_merged_batches_equal_a_full_refresh(spark, sf_dir, database, parts):
    cleaned = events.clean(derived.derived_events(spark, sf_dir, schemas.EVENT_TYPES))
    for k in range(parts):
        refresh.merge_events(spark, cleaned.where(F.col("offset") % parts == k), database, f"b{k}")
    # a batch that is repeated counts once
    refresh.merge_events(spark, cleaned.where(F.col("offset") % parts == 0), database, "b0")
    assert contents(refresh.read_analytics(spark, database)) == full_results(cleaned)
    refresh.refresh_analytics(spark, cleaned, database)
    assert contents(refresh.read_analytics(spark, database)) == full_results(cleaned)
    batches = store.with_partitions(spark, database, "event_rollup").select("batch").distinct().collect()
    assert [row.batch for row in batches] == ["full"]


def test_merge_touches_only_its_dates(spark, sf_dir, database, tmp_path):
    cleaned = events.clean(derived.derived_events(spark, sf_dir, schemas.EVENT_TYPES))
    refresh.merge_events(spark, cleaned, database, "all")

    def files(table):
        return {str(p): p.stat().st_mtime_ns for p in (tmp_path / "tables" / table).rglob("*.parquet")}

    tables = [*refresh.ANALYTICS, "event_rollup"]
    before = {table: files(table) for table in tables}
    day = F.to_date("timestamp") == F.lit("2024-01-05")
    refresh.merge_events(spark, cleaned.where(day), database, "again")
    for table in tables:
        after = files(table)
        changed = {path for path in before[table].keys() | after.keys() if before[table].get(path) != after.get(path)}
        assert changed and all("event_date=2024-01-05" in path for path in changed), table
    rate_table = store.read_table(spark, database, "hourly_event_rate")
    total = rate_table.where("to_date(hour) = '2024-01-05'").agg(F.sum("event_count")).first()[0]
    assert total == 2 * cleaned.where(day).count()


def test_untouched_dates_are_pruned_when_the_query_runs(spark, sf_dir, database):
    cleaned = events.clean(derived.derived_events(spark, sf_dir, schemas.EVENT_TYPES))
    refresh.merge_events(spark, cleaned, database, "all")
    refresh.merge_events(spark, cleaned.where(F.to_date("timestamp") == F.lit("2024-01-05")), database, "day")
    partials = refresh.partials_of_touched_dates(spark, database, "day")
    plan = partials._jdf.queryExecution().executedPlan()
    assert "dynamicpruningexpression(event_date" in plan.toString()
    assert {row[0].isoformat() for row in partials.select("event_date").distinct().collect()} == {"2024-01-05"}


def test_an_empty_batch_changes_nothing(spark, sf_dir, database):
    cleaned = events.clean(derived.derived_events(spark, sf_dir, schemas.EVENT_TYPES))
    refresh.merge_events(spark, cleaned.limit(0), database, "none")
    assert all(df.isEmpty() for df in refresh.read_analytics(spark, database).values())
    refresh.merge_events(spark, cleaned, database, "all")
    before = contents(refresh.read_analytics(spark, database))
    refresh.merge_events(spark, cleaned.limit(0), database, "none again")
    assert contents(refresh.read_analytics(spark, database)) == before


# --- streams ------------------------------------------------------------------------------------------------------


def test_stream_keeps_the_tables_complete_and_names_late_events(spark, sf_dir, database, tmp_path):
    """Days arrive in order but for one that comes last; a batch that is repeated changes nothing."""
    cleaned = events.clean(derived.derived_events(spark, sf_dir, schemas.EVENT_TYPES))
    source, checkpoint = str(tmp_path / "events"), str(tmp_path / "cp")
    day = F.dayofmonth("timestamp")
    late = (day == 7) & (F.col("offset") % 2 == 0)
    batches = [day.between(1, 10) & ~late, day.between(11, 20), day.between(21, 31), late]
    for chosen in batches:
        cleaned.where(chosen).write.mode("append").parquet(source)
        stream = spark.readStream.schema(cleaned.schema).parquet(source)
        rates.refresh_stream(stream, database, checkpoint).awaitTermination()
    assert contents(refresh.read_analytics(spark, database)) == full_results(cleaned)
    stored = store.read_table(spark, database, "late_events")
    assert stored.count() == cleaned.where(late).count() > 0
    counts = {r.batch_number: (r.row_count, r.late_count) for r in store.read_table(spark, database, "stream_progress").collect()}
    assert counts == {
        k: (cleaned.where(chosen).count(), stored.count() if k == 3 else 0) for k, chosen in enumerate(batches)
    }
    totals = rates.late_counts(spark, database).agg(F.sum("late_events")).first()[0]
    assert totals == stored.count()

    rates.merge_batch(spark, cleaned.where(late), database, "stream", 3)
    assert contents(refresh.read_analytics(spark, database)) == full_results(cleaned)
    assert store.read_table(spark, database, "late_events").count() == totals


def test_open_hours_follow_the_newest_event(spark, database):
    def event(hour, minute=0):
        return (datetime(2026, 4, 28, hour, minute), "clinic_visit", "r", None, None, None, None)

    ddl = "timestamp timestamp, event_type string, region string, severity string, available_beds int, vaccine_type string, dose_number int"
    rows = spark.createDataFrame([event(1), event(2, 59), event(4), event(5, 0)], ddl)
    rates.merge_batch(spark, rows, database, "s", 0)
    hours = {r.hour.hour: r.is_open for r in rates.with_open_hours(spark, database, "hourly_event_rate").collect()}
    # the watermark is 3:00, the end of the hour from 2:00
    assert hours == {1: False, 2: False, 4: True, 5: True}
    # an event of an open hour is not late; one of a closed hour is
    rates.merge_batch(spark, spark.createDataFrame([event(4, 1), event(2, 1)], ddl), database, "s", 1)
    assert [r.timestamp.hour for r in store.read_table(spark, database, "late_events").collect()] == [2]
    hours = {r.hour.hour: r.event_count for r in store.read_table(spark, database, "hourly_event_rate").collect()}
    assert hours == {1: 1, 2: 2, 4: 2, 5: 1}


def test_optional_source(spark, tmp_path):
    schema = schemas.EVENT_SCHEMAS[schemas.VACCINATION]
    path = str(tmp_path / "vaccinations")
    read = lambda: events.read_messages(spark, "parquet", path)
    missing = events.read_optional_events(spark, schemas.VACCINATION, read)
    assert missing.count() == 0
    assert missing.columns == schema.fieldNames()
    record = {"event_type": "vaccination_record", "timestamp": "2026-04-27T10:00:00Z", "region": "Boston"}
    spark.createDataFrame([(json.dumps(record),)], "value string").write.parquet(path)
    present = events.read_optional_events(spark, schemas.VACCINATION, read)
    assert present.count() == 1
    assert present.schema == missing.schema


def test_unreadable_optional_source_is_not_an_empty_one(spark, tmp_path):
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        events.read_optional_events(
            spark, schemas.VACCINATION, lambda: events.read_messages(spark, "parquet", str(tmp_path / "broken"))
        )


def test_ingestion_continues_where_it_stopped(spark, sf_dir, tmp_path):
    raw = derived.raw_messages(spark, sf_dir)
    source, out, checkpoint = (str(tmp_path / name) for name in ("raw", "events", "checkpoint"))
    stored, counts = [], []
    for part in range(2):
        raw.where(F.col("offset") % 2 == part).coalesce(3).write.mode("append").parquet(source)
        stream = events.stream_messages(spark, "parquet", source, "offset bigint, value string", batch_cap=2)
        run = ingest.ingest(stream, out, checkpoint)
        run.awaitTermination()
        stored.append(spark.read.parquet(out).count())
        # counted by the write itself, batch by batch
        counts.append(ingest.run_summary(run, "validation"))
    assert stored == [raw.where("offset % 2 = 0").count(), raw.count()]
    for part in range(2):
        judged = validate.validate_events(raw.where(F.col("offset") % 2 == part))
        assert counts[part] == validate.validation_summary(judged).first().asDict()
    batch = validate.validate_events(raw).groupBy("reason").count().collect()
    streamed = spark.read.parquet(out).groupBy("reason").count().collect()
    assert {tuple(row) for row in streamed} == {tuple(row) for row in batch}
    valid = spark.read.parquet(out).where("verdict = 'valid'")
    assert "PartitionFilters: [isnotnull(verdict" in valid._jdf.queryExecution().executedPlan().toString()


def test_routed_messages_reach_one_directory_per_type(spark, tmp_path):
    source, out = str(tmp_path / "raw"), str(tmp_path / "out")
    messages = [
        json.dumps({"event_type": t, "timestamp": "2026-04-27T10:00:00Z", "region": "Boston", "extra": 1.50})
        for t in ("symptom_report", "clinic_visit", "vaccination")
    ]
    spark.createDataFrame([(m,) for m in messages], "value string").write.parquet(source)
    stream = events.stream_messages(spark, "parquet", source, "value string")
    query = ingest.publish_routed(stream, str(tmp_path / "cp"), "parquet", out, team_id="t1", as_of="2026-04-27 11:00:00")
    query.awaitTermination()
    rows = {row.topic: json.loads(row.value) for row in spark.read.parquet(out).collect()}
    assert set(rows) == {"symptom_reports", "clinic_visits"}
    assert rows["clinic_visits"]["team_id"] == "t1"
    assert rows["clinic_visits"]["extra"] == 1.5


def test_missing_topic_reported_by_the_jvm():
    from wardlight.sources import events

    class Failure(Exception):
        def __str__(self):
            return "java.util.concurrent.ExecutionException: UnknownTopicOrPartitionException: no such topic"

    assert events._source_is_missing(Failure())


def test_clean_up_drops_whole_dates_of_all_tables(spark, database, tmp_path):
    old, limit = NOW - timedelta(days=9), NOW - timedelta(days=7)
    rows = rate(spark, (old, "t", "a", 1), (limit - timedelta(hours=2), "t", "b", 2), (NOW, "t", "c", 3))
    store.refresh_table(spark, database, "hourly_event_rate", rows)
    rollup = rows.selectExpr(
        "*", "NULL AS vaccine_type", "NULL AS dose_number", "NULL AS severity_sum", "0 AS severity_count",
        "NULL AS beds_sum", "NULL AS beds_min", "0 AS beds_count",
    )
    for batch in ("x", "y"):
        store.refresh_dates(spark, database, "event_rollup", rollup, batch)
    assert set(store.clean_up(spark, database, NOW)) == {"hourly_event_rate", "event_rollup"}
    for table in ("hourly_event_rate", "event_rollup"):
        files = (tmp_path / "tables" / table).rglob("*.parquet")
        assert {part for path in files for part in path.parts if part.startswith("event_date=")} == {
            "event_date=2026-04-21", "event_date=2026-04-28"
        }
    assert regions(store.read_table(spark, database, "hourly_event_rate")) == ["b", "c"]
    assert store.with_partitions(spark, database, "event_rollup").count() == 4
    assert store.clean_up(spark, database, NOW) == []


def test_clean_up_of_nothing(spark, database):
    assert store.clean_up(spark, database, NOW) == []


def test_raw_messages_without_a_valid_one(spark, database):
    messages = spark.createDataFrame([("{}",), (None,)], "value string")
    refresh.results_from_raw(spark, messages, database, "t", NOW)
    assert store.read_table(spark, database, "outbreak_predictions").count() == 0


def test_raw_results_replace_those_of_the_last_run(spark, sf_dir, database):
    messages = derived.raw_messages(spark, sf_dir)
    for _ in range(2):
        refresh.results_from_raw(spark, messages, database, "t", NOW)
    stored = store.with_partitions(spark, database, "stored_events").count()
    assert store.read_table(spark, database, "hourly_event_rate").agg(F.sum("event_count")).first()[0] == stored

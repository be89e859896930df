from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from wardlight.operators.cooldown import at_polls, suppress_logged, suppress_repeats
from wardlight.streaming.cooldown import emitted_alerts

DDL = "level string, metric string, region string, polled_at timestamp_ntz, position bigint"
START = datetime(2024, 1, 1)


def expected(rows, cooldown):
    """The rule itself, alert by alert."""
    last, status = {}, {}
    for level, metric, region, time, position in sorted(rows, key=lambda row: (row[3], row[4])):
        key = (level, metric, region)
        if key not in last or time - last[key] >= timedelta(seconds=cooldown):
            last[key], status[position] = time, "EMITTED"
        else:
            status[position] = "SUPPRESSED"
    return status


def found(spark, rows, cooldown):
    result = suppress_repeats(spark.createDataFrame(rows, DDL), cooldown).collect()
    assert len(result) == len(rows)
    return {row.position: row.status for row in result}


def test_minutes_0_4_5_9_10(spark):
    rows = [("warning", "m", region, START + timedelta(minutes=m), 10 * i + j)
            for j, region in enumerate("ab") for i, m in enumerate([0, 4, 5, 9, 10])]
    status = found(spark, rows, 300)
    for j in range(2):
        assert [status[10 * i + j] for i in range(5)] == [
            "EMITTED", "SUPPRESSED", "EMITTED", "SUPPRESSED", "EMITTED"
        ]


def test_first_of_one_poll_is_emitted(spark):
    rows = [("warning", "m", "a", START, position) for position in (3, 1, 2)]
    assert found(spark, rows, 300) == {1: "EMITTED", 2: "SUPPRESSED", 3: "SUPPRESSED"}


@pytest.mark.parametrize("cooldown,count,seconds", [(300, 1500, 40_000), (300, 800, 2_000), (7200, 1200, 900_000),
                                                    (60, 1000, 3_000_000)])
@pytest.mark.parametrize("batch", ["10000", "9"])
def test_against_the_rule(spark, cooldown, count, seconds, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    generator = random.Random(cooldown + count)
    rows = []
    for position in range(count):
        step = generator.choice([1, 60, 300, 1e-6])
        time = START + timedelta(seconds=round(generator.random() * seconds / step) * step)
        # one key gets most of the alerts
        rows.append((generator.choice(["warning"] * 5 + ["critical"]), "m", generator.choice(["a", None]), time, position))
    assert found(spark, rows, cooldown) == expected(rows, cooldown)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")


def test_no_alerts(spark):
    assert found(spark, [], 300) == {}


def test_stream_keeps_its_state_between_batches(spark, tmp_path):
    source = tmp_path / "alerts"
    source.mkdir()
    query = (
        emitted_alerts(spark.readStream.schema(DDL).parquet(str(source)), 300)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
    )
    emitted = []
    for batch in ([0, 4], [5, 9], [10, 40]):
        rows = [("warning", "m", "a", START + timedelta(minutes=m), m) for m in batch]
        spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(str(source))
        query.start(str(tmp_path / "out")).awaitTermination()
        emitted = sorted(row.emitted_at for row in spark.read.parquet(str(tmp_path / "out")).collect())
    assert emitted == [START + timedelta(minutes=m) for m in (0, 5, 10, 40)]


@pytest.mark.parametrize("cooldown", [300, 21_600])
def test_density_does_not_grow_the_moments_of_a_key(spark, cooldown):
    """A hundred times the alerts of one key on the same polls: as many distinct times, and the same emissions."""
    counts, emitted = [], []
    for per_minute in (1, 100):
        alerts = spark.range(720 * per_minute).selectExpr(
            "'warning' AS level", "'m' AS metric", "'a' AS region",
            f"timestamp_micros(1704067200000000 + id * 60000000 div {per_minute} + 1) AS polled_at", "id AS position",
        )
        polled = at_polls(alerts, 60)
        counts.append(polled.select("polled_at").distinct().count())
        rows = suppress_repeats(polled, cooldown).where("status = 'EMITTED'").collect()
        emitted.append(sorted(row.polled_at for row in rows))
    assert counts[0] == counts[1] == 720
    assert emitted[0] == emitted[1] and len(emitted[0]) == 720 * 60 // cooldown


def test_polls_are_at_or_after_the_alert(spark):
    times = [START, START + timedelta(seconds=1), START + timedelta(seconds=60), None]
    rows = [("warning", "m", "a", time, i) for i, time in enumerate(times)]
    found = {r.position: r.polled_at for r in at_polls(spark.createDataFrame(rows, DDL), 60).collect()}
    assert found == {0: START, 1: START + timedelta(minutes=1), 2: START + timedelta(minutes=1), 3: None}


def test_a_poll_remembers_the_log(spark):
    log = spark.createDataFrame(
        [("warning", "m", "a", START, "EMITTED"), ("warning", "m", "a", START + timedelta(minutes=4), "SUPPRESSED"),
         ("warning", "m", "b", START + timedelta(minutes=1), "EMITTED")],
        "level string, metric string, region string, polled_at timestamp, status string",
    )
    poll = [("warning", "m", region, START + timedelta(minutes=5), 1, position)
            for region, position in (("a", 1), ("a", 2), ("b", 3), ("c", 4), (None, 5), (None, 6))]
    ddl = "level string, metric string, region string, polled_at timestamp, check_order int, position int"
    marked = suppress_logged(spark.createDataFrame(poll, ddl), log, 300).collect()
    assert {r.position for r in marked if r.status == "EMITTED"} == {1, 4, 5} and len(marked) == 6

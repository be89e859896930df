"""The streaming cooldown over several batches, against the rule itself."""

import random
from datetime import datetime, timedelta

from wardlight.streaming.cooldown import suppress_repeats

DDL = "level string, metric string, region string, polled_at timestamp_ntz, position bigint"
START = datetime(2024, 1, 1)


def _run(spark, tmp_path, batches, cooldown):
    source = str(tmp_path / "source")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for rows in batches:
        spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(source)
        query = (
            suppress_repeats(spark.readStream.schema(DDL).parquet(source), cooldown)
            .writeStream.format("parquet")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(out)
        )
        query.awaitTermination()
    rows = spark.read.parquet(out).select("region", "polled_at", "position", "status").collect()
    return {(r["region"], r["position"]): r["status"] for r in rows}, len(rows)


def _rule(batches, cooldown):
    last, out = {}, {}
    for rows in batches:
        for *key, at, position in sorted(rows, key=lambda r: (r[3] or START, r[4])):
            key = tuple(key)
            free = at is not None and (key not in last or at - last[key] >= timedelta(seconds=cooldown))
            out[key[2], position] = "EMITTED" if free else "SUPPRESSED"
            if free:
                last[key] = at
    return out


def test_all_alerts_leave_the_stream_whatever_other_keys_have_seen(spark, tmp_path):
    def row(region, hour, position):
        return ("warning", "beds", region, None if hour is None else START + timedelta(hours=hour), position)

    # b is four hours behind a and was never seen before; its first alert must not be lost
    batches = [[row("a", 5, 1)], [row("b", 1, 2), row("a", 5, 3), row("b", None, 4)], [row("b", 1.05, 5), row("b", 2, 6)]]
    got, n = _run(spark, tmp_path, batches, 300)
    assert n == 6
    assert got == _rule(batches, 300)
    assert got["b", 2] == "EMITTED" and got["b", 4] == "SUPPRESSED"


def test_several_batches_equal_the_rule(spark, tmp_path):
    pick = random.Random(7)
    batches, position = [], 0
    for batch in range(3):
        rows = []
        for _ in range(60):
            position += 1
            at = START + timedelta(seconds=batch * 3600 + pick.randrange(3600))
            rows.append((pick.choice(["warning", "critical"]), "beds", pick.choice("abc"), at, position))
        batches.append(rows)
    got, n = _run(spark, tmp_path, batches, 500)
    assert n == 180
    assert got == _rule(batches, 500)


def test_batches_that_go_back_in_time(spark, tmp_path):
    pick = random.Random(11)
    rows = [
        (pick.choice(["warning", "critical"]), "beds", pick.choice("ab"), START + timedelta(seconds=pick.randrange(7200)), n)
        for n in range(120)
    ]
    batches = [rows[k::3] for k in range(3)]
    got, n = _run(spark, tmp_path, batches, 700)
    assert n == 120 and set(got.values()) == {"EMITTED", "SUPPRESSED"}
    assert got == _rule(batches, 700)

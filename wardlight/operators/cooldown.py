"""Cooldown of repeated alerts.

An alert is emitted if its key has not been emitted before or not within the last ``cooldown_seconds``; the rest are
suppressed. The rule looks back to the last *emitted* alert, so along one key it is a chain from alert to alert, and a
window function cannot express it. Walking the chain of a key in one task would put a hot key on that task, so the
time line of each key is cut into spans no shorter than the cooldown:

1. Within a span, every possible way of entering it is reduced to a small table: "if nothing may be emitted before
   ``x``, the span's last emission is ``y``". A chain enters the next span with at most its last emission, so nothing
   else crosses the border.
2. Per key, these tables are chained in time order, which gives the time from which each span may emit.
3. Every span marks its emissions from that starting point.

Steps 1 and 3 distribute (key, span) pairs and hold one entry per distinct time; a task handles all its spans in one
vectorised pass per batch. Step 2 brings the tables of one key together. A span's table has at most one row per distinct
time within a cooldown of the span's start. Alerts are found by polls, so a key has at most one time per poll, and step 2
at most one row per poll of a key: 1,440 a day at one poll a minute, however many alerts there are. ``at_polls`` puts
alerts that carry other times on the polls that find them; without it, step 2 grows with the distinct times of a key.

``suppress_logged`` is the same rule for one poll that remembers earlier polls in a stored log.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlight import settings

ALERT_KEY = ("level", "metric", "region")
SPAN_SECONDS = 3600


def _span_functions(cooldown: int, span_length: int):
    """The three steps as functions of pandas frames; times and lengths are in microseconds.

    Everything is nested here, so that Spark sends it to the executors by value.
    """
    # spans are laid out one after the other, further apart than an emission can reach
    distance = 2 * span_length + 1
    any_time = -(2**62)

    def whole_spans(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
        """Frames of complete (key, span) pairs from sorted batches, with the number of each row's pair."""
        held: list[pd.DataFrame] = []  # batches of a pair that may go on; joined once, when it has ended
        for batch in batches:
            if not len(batch):
                continue
            starts = pair_starts(batch)
            if held:
                before, first = held[-1].iloc[-1], batch.iloc[0]
                starts[0] = before["key"] != first["key"] or before["span"] != first["span"]
            borders = np.flatnonzero(starts)
            if not len(borders):
                held.append(batch)
                continue
            ended = held + ([batch.iloc[: borders[-1]]] if borders[-1] else [])
            held = [batch.iloc[borders[-1] :]]
            if ended:
                frame = pd.concat(ended, ignore_index=True)
                yield frame, np.cumsum(pair_starts(frame)) - 1
        if held:
            frame = pd.concat(held, ignore_index=True)
            yield frame, np.zeros(len(frame), dtype="int64")

    def pair_starts(frame: pd.DataFrame) -> np.ndarray:
        keys, spans = pd.factorize(frame["key"])[0], frame["span"].to_numpy()
        changed = (keys[1:] != keys[:-1]) | (spans[1:] != spans[:-1])
        return np.append(True, changed) if len(frame) else changed

    def following(places: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """Row of the next emission after an emission at each row; the row itself if there is none in its span."""
        rows = np.arange(len(places))
        after = np.searchsorted(places, places + cooldown, side="left")
        inside = after < len(places)
        inside[inside] = pair[after[inside]] == pair[inside]
        return np.where(inside, after, rows)

    def transitions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, pair in whole_spans(batches):
            at, offset = frame["at"].to_numpy(), frame["at"].to_numpy() - frame["span"].to_numpy() * span_length
            last = following(pair * distance + offset, pair)
            while not np.array_equal(last[last], last):
                last = last[last]
            # an earlier emission cannot block anything later than a cooldown after the span's start, so a chain
            # enters at a row up to there or at the first row behind
            early = offset < cooldown
            previous_early = np.append(True, early[:-1]) | np.append(True, pair[1:] != pair[:-1])
            entered = early | previous_early
            # of neighbouring entry rows with the same end, the last one stands for all
            next_same = np.append((pair[1:] == pair[:-1]) & entered[1:] & (last[1:] == last[:-1]), False)
            chosen = entered & ~next_same
            yield pd.DataFrame(
                {
                    "key": frame["key"].to_numpy()[chosen],
                    "span": frame["span"].to_numpy()[chosen],
                    "not_before": at[chosen],
                    "last_emitted": at[last[chosen]],
                }
            )

    def chain(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["span", "not_before"])
        spans, first_row = np.unique(group["span"].to_numpy(), return_index=True)
        bounds = np.append(first_row, len(group))
        not_before, last_emitted = group["not_before"].to_numpy(), group["last_emitted"].to_numpy()
        allowed_from = np.empty(len(spans), dtype="int64")
        allowed = any_time
        for i in range(len(spans)):
            allowed_from[i] = allowed
            row = bounds[i] + np.searchsorted(not_before[bounds[i] : bounds[i + 1]], allowed, side="left")
            if row < bounds[i + 1]:
                allowed = last_emitted[row] + cooldown
        return pd.DataFrame({"key": group["key"].iloc[0], "span": spans, "allowed_from": allowed_from})

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each pair starts with the row that carries its ``allowed_from``; alerts follow in time order."""
        for frame, pair in whole_spans(batches):
            is_entry = frame["is_entry"].to_numpy()
            span_start = frame["span"].to_numpy() * span_length
            reach = np.clip(frame["allowed_from"].to_numpy()[is_entry] - span_start[is_entry], 0, distance - 1)
            alerts, pair = frame[~is_entry], pair[~is_entry]
            places = pair * distance + alerts["at"].to_numpy() - span_start[~is_entry]
            next_row = following(places, pair)
            rows = np.searchsorted(places, np.arange(len(reach)) * distance + reach, side="left")
            rows = rows[(rows < len(places)) & (pair[np.minimum(rows, len(places) - 1)] == np.arange(len(reach)))]
            emitted = np.zeros(len(places), dtype=bool)
            while len(rows):
                emitted[rows] = True
                after = next_row[rows]
                rows = after[after != rows]
            yield alerts[emitted][["key", "at", "first"]]

    return transitions, chain, mark


def suppress_repeats(
    alerts: DataFrame,
    cooldown_seconds: int = settings.COOLDOWN_SECONDS,
    key: Sequence[str] = ALERT_KEY,
    time: str = "polled_at",
    sequence: str = "position",
) -> DataFrame:
    """Add ``status``: EMITTED or SUPPRESSED.

    ``sequence`` (an integer) orders alerts of one key at one time and must differ between them; the first may be
    emitted.
    """
    cooldown = cooldown_seconds * 1_000_000
    span_length = max(SPAN_SECONDS, cooldown_seconds) * 1_000_000
    transitions, chain, mark = _span_functions(cooldown, span_length)

    one_key = F.to_json(F.struct(*key))
    at = F.unix_micros(F.col(time).cast("timestamp"))
    moments = (
        alerts.select(one_key.alias("key"), at.alias("at"), F.col(sequence).cast("bigint").alias("first"))
        .groupBy("key", "at")
        .agg(F.min("first").alias("first"))
        .withColumn("span", F.expr(f"(at - pmod(at, {span_length}L)) div {span_length}L"))
    )
    tables = (
        moments.repartition("key", "span")
        .sortWithinPartitions("key", "span", "at")
        .mapInPandas(transitions, "key string, span bigint, not_before bigint, last_emitted bigint")
    )
    entries = tables.groupBy("key").applyInPandas(chain, "key string, span bigint, allowed_from bigint")
    emitted = (
        moments.selectExpr("*", "0L AS allowed_from", "false AS is_entry")
        .unionByName(entries.selectExpr("*", "0L AS at", "0L AS first", "true AS is_entry"))
        .repartition("key", "span")
        .sortWithinPartitions("key", "span", F.desc("is_entry"), "at")
        .mapInPandas(mark, "key string, at bigint, first bigint")
        .withColumnsRenamed({"key": "_key", "at": "_at", "first": "_first"})
    )
    # the join keys identify one alert, so they are unique and spread a hot key over all tasks
    same_alert = (one_key == F.col("_key")) & (at == F.col("_at")) & (F.col(sequence) == F.col("_first"))
    status = F.when(F.col("_key").isNotNull(), "EMITTED").otherwise("SUPPRESSED")
    return alerts.join(emitted, same_alert, "left").select(*alerts.columns, status.alias("status"))


def at_polls(alerts: DataFrame, poll_seconds: int, time: str = "polled_at") -> DataFrame:
    """Alerts with the time of the poll that finds them: the first poll at or after their own time.

    Polls run every ``poll_seconds`` from the epoch on. A missing time stays missing.
    """
    at, step = F.unix_micros(F.col(time).cast("timestamp")), F.lit(poll_seconds * 1_000_000)
    return alerts.withColumn(time, F.timestamp_micros(at + F.pmod(-at, step)).cast(alerts.schema[time].dataType))


def suppress_logged(
    alerts: DataFrame,
    log: DataFrame,
    cooldown_seconds: int = settings.COOLDOWN_SECONDS,
    key: Sequence[str] = ALERT_KEY,
    time: str = "polled_at",
    sequence: Sequence[str] = ("check_order", "position"),
) -> DataFrame:
    """Add ``status`` to the alerts of one poll, given the log of earlier polls.

    Of the alerts of one key, the first by ``sequence`` is emitted if the log holds no emission of that key within the
    cooldown. The log is reduced to one row per key before the join; the window is over the alerts of one poll.
    """
    emitted = log.where(F.col("status") == "EMITTED")
    last = emitted.groupBy(*[F.col(name).alias(f"_{name}") for name in key]).agg(F.max(time).alias("_last"))
    ordered = alerts.withColumn("_place", F.row_number().over(Window.partitionBy(*key).orderBy(*sequence)))
    same_key = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in key]
    passed = F.unix_micros(F.col(time)) - F.unix_micros("_last")
    free = F.col("_last").isNull() | (passed >= cooldown_seconds * 1_000_000)
    status = F.when((F.col("_place") == 1) & free, "EMITTED").otherwise("SUPPRESSED")
    return ordered.join(last, same_key, "left").select(*alerts.columns, status.alias("status"))

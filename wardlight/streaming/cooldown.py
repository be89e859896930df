"""Cooldown of repeated alerts as a stateful stream.

The state of an alert key is the time of its last emitted alert. Keys are combinations of level, metric and region, so
the state is bounded by them and never expires; without a watermark, no alert is lost because another key is ahead.
Every alert leaves the stream, as EMITTED or SUPPRESSED. A key's alerts are expected in poll order across batches: one
that arrives after a later alert of its key was emitted is suppressed, as it lies before the end of that cooldown.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from wardlight import settings
from wardlight.operators.cooldown import ALERT_KEY

#: stands for a missing time while a batch is sorted; such alerts are suppressed
NO_TIME = -(2**62)


def suppress_repeats(
    alerts: DataFrame,
    cooldown_seconds: int = settings.COOLDOWN_SECONDS,
    key: Sequence[str] = ALERT_KEY,
    time: str = "polled_at",
    sequence: str = "position",
) -> DataFrame:
    """Key, time, sequence and ``status`` of every alert: EMITTED or SUPPRESSED.

    Of alerts of one key at one time, the first by ``sequence`` may be emitted. A task holds the times of one key in one
    micro-batch, so the source's batch cap bounds it.
    """
    key = list(key)
    cooldown = max(cooldown_seconds * 1_000_000, 1)
    key_ddl = ", ".join(f"`{name}` {alerts.schema[name].dataType.simpleString()}" for name in key)
    at = F.coalesce(F.unix_micros(F.col(time).cast("timestamp")), F.lit(NO_TIME))
    moments = alerts.select(*key, at.alias("_at"), F.col(sequence).cast("bigint").alias("_sequence"))

    def classify(values: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        frame = pd.concat([batch[["_at", "_sequence"]] for batch in batches], ignore_index=True)
        frame = frame.sort_values(["_at", "_sequence"], ignore_index=True)
        times = frame["_at"].to_numpy()
        emitted = np.zeros(len(times), dtype=bool)
        row = np.searchsorted(times, NO_TIME + 1 if last is None else last + cooldown)
        while row < len(times):
            emitted[row] = True
            last = int(times[row])
            row = np.searchsorted(times, last + cooldown)
        if last is not None:
            state.update((last,))
        rows = pd.DataFrame({name: [value] * len(times) for name, value in zip(key, values)})
        rows["_at"] = pd.to_datetime(frame["_at"].where(frame["_at"] != NO_TIME), unit="us")
        rows["_sequence"] = frame["_sequence"]
        rows["status"] = np.where(emitted, "EMITTED", "SUPPRESSED")
        yield rows

    classified = moments.groupBy(*key).applyInPandasWithState(
        classify,
        f"{key_ddl}, _at timestamp_ntz, _sequence bigint, status string",
        "last_emitted bigint",
        "append",
        GroupStateTimeout.NoTimeout,
    )
    return classified.withColumnsRenamed({"_at": time, "_sequence": sequence})


def emitted_alerts(
    alerts: DataFrame,
    cooldown_seconds: int = settings.COOLDOWN_SECONDS,
    key: Sequence[str] = ALERT_KEY,
    time: str = "polled_at",
    sequence: str = "position",
) -> DataFrame:
    """Key and time of every emitted alert."""
    classified = suppress_repeats(alerts, cooldown_seconds, key, time, sequence)
    return classified.where("status = 'EMITTED'").select(*key, F.col(time).alias("emitted_at"))

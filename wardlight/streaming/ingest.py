"""Ingestion as Structured Streaming: validate, publish, enrich and route.

All queries run with ``availableNow``: they consume what has arrived since the last run, keep their position in the
checkpoint and stop. The source caps the size of one batch (``batch_cap`` of ``sources.events.stream_messages``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardlight import settings
from wardlight.operators import route, validate


def ingest(messages: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Store every message once under ``verdict=valid`` or ``verdict=invalid`` with the reason.

    One query and one pass write both sides; a reader of either side prunes to its directory. The same pass counts the
    messages: ``run_summary(query, "validation")``.
    """
    judged = validate.validate_events(messages).observe("validation", *validate.summary_columns())
    verdict = F.when(F.col("reason") == validate.VALID, "valid").otherwise("invalid")
    return _start(judged.withColumn("verdict", verdict), checkpoint, "parquet", path, partition_by="verdict")


def publish_valid(messages: DataFrame, checkpoint: str, fmt: str, path: str | None = None, **options: str):
    """Publish the unchanged text of valid messages to a stream (kafka: pass the ``topic`` option)."""
    return _start(validate.valid_messages(messages).select("value"), checkpoint, fmt, path, **options)


def publish_routed(
    messages: DataFrame,
    checkpoint: str,
    fmt: str,
    path: str | None = None,
    team_id: str = "",
    as_of=None,
    routes: Mapping[str, str] = settings.ROUTES,
    **options: str,
) -> StreamingQuery:
    """Enrich valid messages and send each to the stream of its type.

    One write serves all targets: kafka takes the topic from the ``topic`` column, files get one directory per topic.
    The same pass counts the messages: ``run_summary(query, "routing")``.
    """
    targeted = route.with_target(messages, team_id, as_of, routes).observe("routing", *route.summary_columns())
    routed = route.route_events(targeted).select("topic", "value")
    partition_by = None if fmt == "kafka" else "topic"
    return _start(routed, checkpoint, fmt, path, partition_by, **options)


def run_summary(query: StreamingQuery, name: str) -> dict[str, int]:
    """The counts of one run of a query, summed over its micro-batches, as the tasks that wrote the rows counted them.

    A run without new messages has no batch and gives an empty summary. Spark keeps the progress of a bounded number of
    batches (``spark.sql.streaming.numRecentProgressUpdates``); a run with more is refused, as its first are lost.
    """
    progress = query.recentProgress
    kept = int(query._jsq.sparkSession().conf().get("spark.sql.streaming.numRecentProgressUpdates"))
    if len(progress) >= kept:
        raise ValueError(f"the progress of only {kept} batches is kept; raise numRecentProgressUpdates")
    total: dict[str, int] = {}
    for batch in progress:
        row = batch.observedMetrics.get(name)
        for key, value in (row.asDict() if row is not None else {}).items():
            total[key] = total.get(key, 0) + value
    return total


def _start(
    df: DataFrame, checkpoint: str, fmt: str, path: str | None, partition_by: str | None = None, **options: str
) -> StreamingQuery:
    writer = df.writeStream.format(fmt).options(**options).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return writer.trigger(availableNow=True).start(path)


def append_to_files(result: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the rows of a stream to Parquet until the input is used up."""
    return _start(result, checkpoint, "parquet", path)

"""The four aggregates kept up to date by a stream, with late events and open hours accounted for.

Every micro-batch is merged into the stored tables by ``refresh.merge_events``, whose definitions of the aggregates are
those of the batch jobs, so the tables equal a full refresh at any time. An hour is closed once the newest event time
seen so far is ``lateness`` past its end. Events of hours that were closed before their batch are counted all the same,
and kept in a table of their own with the watermark that they missed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardlight import schemas
from wardlight.plans import refresh
from wardlight.sinks import tables as store

LATENESS = "2 hours"
LATE, PROGRESS = "late_events", "stream_progress"


def _closed(hour: Column, watermark: Column) -> Column:
    return F.coalesce(hour + F.expr("INTERVAL 1 HOUR") <= watermark, F.lit(False))


def newest_time(spark: SparkSession, database: str, before: int | None = None) -> DataFrame:
    """One row: the newest event time of the batches numbered below ``before``, or of all; NULL if there is none."""
    progress = store.with_partitions(spark, database, PROGRESS)
    if before is not None:
        progress = progress.where(F.col("batch_number") < before)
    return progress.agg(F.max("newest_time").alias("newest_time"))


def merge_batch(
    spark: SparkSession,
    events: DataFrame,
    database: str,
    stream: str,
    number: int,
    lateness: str = LATENESS,
    tables: Sequence[str] = refresh.ANALYTICS,
) -> None:
    """Merge one micro-batch of cleaned events; a batch that is repeated counts once.

    Late events and progress come from one look at the batch. The watermark is that of the batches before this one, so
    it is the same when a batch is repeated. Progress is one row for each batch.
    """
    store.create_table(spark, database, PROGRESS)
    counted = events.where(F.col("event_type").isin(schemas.EVENT_TYPES))
    watermark = newest_time(spark, database, number).first()[0]
    limit = F.lit(watermark).cast("timestamp") - F.expr(f"INTERVAL {lateness}")
    late = _closed(F.date_trunc("hour", F.col("timestamp")), limit)
    refresh.merge_events(spark, counted, database, f"{stream}-{number}", tables)
    late_rows = counted.where(late).select("timestamp", "event_type", "region", limit.alias("watermark"))
    store.refresh_dates(spark, database, LATE, late_rows, f"{stream}-{number}")
    seen = counted.agg(
        F.lit(number).alias("batch_number"),
        F.max("timestamp").alias("newest_time"),
        F.count("*").alias("row_count"),
        F.count_if(late).alias("late_count"),
        limit.alias("watermark"),
    ).where(F.col("row_count") > 0)
    store.refresh_dates(spark, database, PROGRESS, seen, f"{stream}-{number}")


def refresh_stream(
    events: DataFrame,
    database: str,
    checkpoint: str,
    stream: str = "stream",
    lateness: str = LATENESS,
    tables: Sequence[str] = refresh.ANALYTICS,
) -> StreamingQuery:
    """Merge what has arrived since the last run into the stored tables, and stop.

    ``stream`` names the partial results of this stream: a new checkpoint, whose batches are numbered anew, needs
    another name and progress of its own database. One stream writes to a database at a time.
    """

    def merge(batch: DataFrame, number: int) -> None:
        kept = batch.persist()  # rows, late rows and progress are three looks at one batch
        try:
            merge_batch(batch.sparkSession, kept, database, stream, number, lateness, tables)
        finally:
            kept.unpersist()

    return (
        events.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def with_open_hours(spark: SparkSession, database: str, table: str, lateness: str = LATENESS) -> DataFrame:
    """A stored aggregate with ``is_open``: whether its hour still takes events that are not late."""
    rows = store.read_table(spark, database, table)
    newest = newest_time(spark, database).select((F.col("newest_time") - F.expr(f"INTERVAL {lateness}")).alias("limit"))
    hour = F.col(schemas.TIME_COLUMN[table])
    return rows.join(F.broadcast(newest), F.lit(True)).withColumn("is_open", ~_closed(hour, F.col("limit"))).drop("limit")


def late_counts(spark: SparkSession, database: str) -> DataFrame:
    """Late events by hour, type and region, with the least watermark that they missed."""
    late = store.read_table(spark, database, LATE)
    return late.groupBy(F.date_trunc("hour", "timestamp").alias("hour"), "event_type", "region").agg(
        F.count("*").alias("late_events"), F.min("watermark").alias("first_watermark")
    )

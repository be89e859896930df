"""Event sources: bounded scans, JSON decoding and cleaning."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardlight import schemas

log = logging.getLogger(__name__)

BASE_COLUMNS = ["timestamp", "event_type", "region"]


def read_messages(spark: SparkSession, fmt: str, path: str | None = None, **options: str) -> DataFrame:
    """One snapshot of a message source, earliest to latest; ``value`` is text.

    For the ``kafka`` format pass ``subscribe`` and ``kafka.bootstrap.servers``; files need a ``value`` column.
    """
    if fmt == "kafka":
        options = {"startingOffsets": "earliest", "endingOffsets": "latest", **options}
    reader = spark.read.format(fmt).options(**options)
    frame = reader.load(path) if path else reader.load()
    return frame.withColumn("value", text_payload(frame))


def stream_messages(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    schema: StructType | str | None = None,
    batch_cap: int | None = None,
    **options: str,
) -> DataFrame:
    """The same source as an unbounded stream; the checkpoint keeps the position between runs.

    ``batch_cap`` limits one micro-batch: messages for kafka, files for file sources. Set it where a backlog can be
    large, so that a batch and its state updates stay small.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        reader = reader.option("startingOffsets", options.get("startingOffsets", "earliest"))
    if batch_cap is not None:
        reader = reader.option("maxOffsetsPerTrigger" if fmt == "kafka" else "maxFilesPerTrigger", str(batch_cap))
    if schema is not None:
        reader = reader.schema(schema)
    frame = reader.load(path) if path else reader.load()
    return frame.withColumn("value", text_payload(frame))


def text_payload(frame: DataFrame):
    """Bytes that are not UTF-8 become NULL, which validation reports as bad JSON."""
    return F.try_validate_utf8(F.col("value").cast("string"))


def decode(messages: DataFrame, schema: StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Parse ``value`` by the declared schema; fields that are missing or of another type become NULL.

    ``explode`` of the one-element array keeps the parsed event a column of its own, so that a filter on its fields
    does not parse the text again. The parser reads the fields of ``schema`` only; pass just those that are needed.
    """
    event = F.explode(F.array(F.from_json("value", schema)))
    return messages.select(*keep, event.alias("event")).select(*keep, "event.*")


def clean(events: DataFrame) -> DataFrame:
    """Type the timestamp and drop rows without timestamp, region or event type."""
    typed = events.withColumn("timestamp", F.col("timestamp").try_cast("timestamp"))
    return typed.where(
        F.col("timestamp").isNotNull() & F.col("region").isNotNull() & F.col("event_type").isNotNull()
    )


def scan_events(messages: DataFrame, schema: StructType, keep: Sequence[str] = ()) -> DataFrame:
    return clean(decode(messages, schema, keep))


def empty_events(spark: SparkSession, schema: StructType) -> DataFrame:
    return clean(spark.createDataFrame([], schema))


def read_optional_events(
    spark: SparkSession, event_type: str, read: Callable[[], DataFrame]
) -> DataFrame:
    """Events from a source that an older deployment may lack.

    Only a missing source gives the empty frame. Any other failure is raised: an unreadable source must not look like
    one without events. ``read`` is probed for one row, because some sources are only resolved when they run.
    """
    schema = schemas.EVENT_SCHEMAS[event_type]
    try:
        messages = read()
        messages.isEmpty()
        return scan_events(messages, schema)
    except (PySparkException, Py4JJavaError) as error:
        if not _source_is_missing(error):
            raise
        log.warning("optional source for %s is missing; continuing without it", event_type)
        return empty_events(spark, schema)


def _source_is_missing(error: PySparkException | Py4JJavaError) -> bool:
    if isinstance(error, AnalysisException):
        return error.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")
    return "UnknownTopicOrPartition" in str(error)


def union_streams(*streams: DataFrame | None) -> DataFrame:
    """UNION ALL of the base columns of every stream that is present."""
    present = [stream.select(*BASE_COLUMNS) for stream in streams if stream is not None]
    union = present[0]
    for stream in present[1:]:
        union = union.unionByName(stream)
    return union


def sample_events(messages: DataFrame, event_type: str, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` messages whose text mentions an event type, in stream order; unparseable ones included."""
    matching = messages.where(F.col("value").contains(event_type))
    return matching.orderBy(*order).limit(n)

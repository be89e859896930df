"""Jobs over stored tables: raw messages to results, full and incremental refresh, predictions, checks, alert polls."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight import schemas, settings
from wardlight.functions.text import as_of_time
from wardlight.operators import aggregates, alerts, cooldown, quality, risk, route, validate
from wardlight.sinks import tables as store
from wardlight.sources import events as source

ROLLUP = "event_rollup"
EVENTS = "stored_events"
ANALYTICS = ["hourly_event_rate", "severity_trend", "bed_availability", "vaccination_trend"]
#: the batch of partial results that a full refresh writes
FULL = "full"


def refresh_analytics(spark: SparkSession, events: DataFrame, database: str) -> None:
    """Recompute the four aggregates from all cleaned events.

    The events are read once: the job stores the hourly rollup and derives everything else from that table. Being a
    table, the rollup also survives lost executors without a second read of the events. It replaces the partial results
    of all earlier batches.
    """
    store.refresh_table(spark, database, ROLLUP, aggregates.event_rollup(events), FULL)
    store.refresh_tables(spark, database, aggregates.results_from_rollup(read_rollup(spark, database)))


def merge_events(
    spark: SparkSession, events: DataFrame, database: str, batch: str, tables: Sequence[str] = ANALYTICS
) -> None:
    """Add new cleaned events to the aggregates named in ``tables`` without reading the events of earlier batches.

    The batch is reduced to partial sums, counts and minima, which are stored under its name. The dates that it touches
    are then put together anew from the partial results of all batches and replace those dates of the four tables. Other
    dates are neither read nor written. Every batch of one database should keep the same tables. A batch that is repeated replaces its own partial results, so it counts once;
    names must therefore differ between batches. A full refresh puts one batch in place of all.
    """
    store.refresh_dates(spark, database, ROLLUP, aggregates.event_rollup(events), batch)
    for table in tables:
        store.create_table(spark, database, table)
    touched = aggregates.merged_rollup(partials_of_touched_dates(spark, database, batch))
    results = aggregates.results_from_rollup(touched)
    wanted = {table: results[table] for table in tables}
    store.side_by_side(lambda table, df: store.refresh_dates(spark, database, table, df), wanted)


def partials_of_touched_dates(spark: SparkSession, database: str, batch: str) -> DataFrame:
    """The partial results of all batches on the dates of one; the other dates are pruned when the query runs."""
    rollup = store.with_partitions(spark, database, ROLLUP)
    # one row for each date of the batch
    dates = rollup.where(F.col(store.BATCH) == batch).select(store.PARTITION).distinct()
    return rollup.join(F.broadcast(dates), store.PARTITION, "left_semi")


def read_rollup(spark: SparkSession, database: str) -> DataFrame:
    """The partial results of all batches, put together."""
    return aggregates.merged_rollup(store.with_partitions(spark, database, ROLLUP))


def results_from_raw(
    spark: SparkSession,
    messages: DataFrame,
    database: str,
    team_id: str,
    as_of=None,
    stale_hours: int = settings.STALE_HOURS,
) -> None:
    """One snapshot of raw messages to all result tables.

    Valid messages are enriched, those with a target stream are decoded and stored by date and type, and the result
    tables are computed from that storage: the messages are read and parsed once, whatever is derived from them.
    """
    targeted = route.with_target(validate.valid_messages(messages.select("value")), team_id, as_of)
    typed = source.scan_events(route.route_events(targeted).select("value"), schemas.merged_event_schema())
    store.refresh_table(spark, database, EVENTS, typed)
    refresh_analytics(spark, store.with_partitions(spark, database, EVENTS), database)
    refresh_predictions(spark, database, as_of)
    record_checks(spark, database, as_of, stale_hours)


def read_analytics(
    spark: SparkSession, database: str, since=None, until=None, also: tuple[str, ...] = ()
) -> dict[str, DataFrame | None]:
    """The analytics tables, and those named in ``also``; None for one that the catalog does not have."""
    return {table: store.read_table(spark, database, table, since, until) for table in [*ANALYTICS, *also]}


def refresh_predictions(spark: SparkSession, database: str, as_of=None) -> None:
    """Score the current analytics tables and replace the predictions.

    Where the rollup is stored, it gives the features from one read and without joins.
    """
    if store.exists(spark, database, ROLLUP):
        features = risk.features_from_rollup(read_rollup(spark, database))
    else:
        features = risk.joined_features(*[store.read_table(spark, database, table) for table in ANALYTICS])
    predictions = risk.predictions(features, as_of)
    store.refresh_table(spark, database, "outbreak_predictions", predictions)


def record_checks(
    spark: SparkSession, database: str, as_of=None, stale_hours: int = settings.STALE_HOURS
) -> DataFrame:
    """Run the quality report on the current tables and append its rows to the history."""
    current = read_analytics(spark, database, also=("outbreak_predictions",))
    store.append_rows(spark, database, "data_quality_checks", quality.dq_report(spark, current, as_of, stale_hours))
    return store.read_table(spark, database, "data_quality_checks")


def poll_alerts(
    spark: SparkSession, database: str, as_of=None, limits: settings.AlertThresholds = alerts.DEFAULTS
) -> DataFrame:
    """One poll of all alert checks on the stored tables.

    Of every table only the dates that can raise an alert are read: the newest ones that hold the rows a check looks
    at, the newest one of the vaccinations, and the last twelve hours of the check history.
    """
    needed = {table: 1 if table == "vaccination_trend" else limits.scan_rows for table in ANALYTICS}
    # side by side, since each counts the rows of a few dates only
    with ThreadPoolExecutor(max_workers=len(needed)) as pool:
        found = pool.map(lambda table: store.read_newest(spark, database, table, needed[table]), needed)
        current = dict(zip(needed, found))
    recent = as_of_time(as_of) - F.expr("INTERVAL 12 HOURS")
    checks = store.read_table(spark, database, "data_quality_checks", since=recent)
    if checks is None:
        checks = spark.createDataFrame([], schemas.RESULT_SCHEMAS["data_quality_checks"])
    return alerts.alert_feed({**current, "data_quality_checks": checks}, as_of, limits)


def alert_cycle(
    spark: SparkSession,
    database: str,
    as_of=None,
    limits: settings.AlertThresholds = alerts.DEFAULTS,
    cooldown_seconds: int = settings.COOLDOWN_SECONDS,
) -> DataFrame:
    """One poll that remembers earlier ones: its alerts are added to the log as EMITTED or SUPPRESSED and returned.

    Of the log only the dates and rows within the cooldown are read. Polls of one database run one after the other; a
    poll that fails has logged nothing and can be repeated.
    """
    moment = as_of_time(datetime.now(timezone.utc) if as_of is None else as_of)
    feed = poll_alerts(spark, database, moment, limits).withColumn("polled_at", moment)
    since = moment - F.expr(f"INTERVAL {int(cooldown_seconds)} SECONDS")
    log = store.read_table(spark, database, "alert_log", since=since)
    if log is None:
        log = spark.createDataFrame([], schemas.RESULT_SCHEMAS["alert_log"])
    store.append_rows(spark, database, "alert_log", cooldown.suppress_logged(feed, log, cooldown_seconds))
    logged = store.read_table(spark, database, "alert_log", since=moment)
    return logged.where(F.col("polled_at") == moment)

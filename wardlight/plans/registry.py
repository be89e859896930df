"""Named queries over the driver's tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from wardlight import schemas, settings
from wardlight.functions import scoring
from wardlight.operators import aggregates, alerts, charts, quality, reports, risk, route, validate
from wardlight.operators.cooldown import at_polls, suppress_repeats
from wardlight.plans import refresh
from wardlight.session import configure, work_dir
from wardlight.sinks import tables as store
from wardlight.sources import derived, events
from wardlight.streaming import cooldown as streaming_cooldown
from wardlight.streaming import ingest, rates

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries. The limits are lower than the defaults because an hour of the test tables
# holds only a few events.
AS_OF = "2024-01-31 12:00:00"
EARLIER_CHECK, LATER_CHECK = "2024-01-30 23:30:00", "2024-01-31 08:21:00"
TEAM = "team-a"
ALERT_LIMITS = settings.AlertThresholds(
    event_warning=2, event_critical=3, severity_warning=2.0, severity_critical=3.0, vaccination_surge=2
)
BED_LIMITS = settings.BedWarningThresholds(
    beds_warning=150, beds_critical=60, admissions_warning=2, admissions_critical=3
)
COOLDOWN = 6 * 3600
POLL_SECONDS = 60
POLLS = ["2024-01-31 11:20:00", "2024-01-31 11:24:00", "2024-01-31 11:25:00", "2024-01-31 12:00:00"]

QUERIES: dict[str, Query] = {}


def query(fn: Query, name: str | None = None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain_times(fn(configure(spark), sf_dir))

    QUERIES[name or fn.__name__] = run
    return fn


def _plain_times(df: DataFrame) -> DataFrame:
    """UTC timestamps without zone, so that results compare equal whatever the client's zone is."""
    return df.select(
        *[
            F.col(f"`{field.name}`").cast("timestamp_ntz").alias(field.name)
            if isinstance(field.dataType, TimestampType)
            else F.col(f"`{field.name}`")
            for field in df.schema.fields
        ]
    )


# --- inputs ------------------------------------------------------------------------------------------------------


def _typed(spark, sf_dir, *types) -> DataFrame:
    return derived.derived_events(spark, sf_dir, types or schemas.EVENT_TYPES)


def _raw(spark, sf_dir) -> DataFrame:
    return derived.raw_messages(spark, sf_dir)


def _parsed(spark, sf_dir) -> DataFrame:
    return validate.parse(_raw(spark, sf_dir)).where(~validate.is_bad_json())


def _vaccinations(spark, sf_dir) -> DataFrame:
    return _parsed(spark, sf_dir).where(validate.is_vaccination())


def _raw_stream(spark, sf_dir) -> DataFrame:
    source = derived.events_stream(spark, sf_dir)
    return derived.with_faults(derived.derive(source, derived.regions_frame(spark, sf_dir)))


def _typed_stream(spark, sf_dir, *types) -> DataFrame:
    source = derived.events_stream(spark, sf_dir)
    return derived.derive(source, derived.regions_frame(spark, sf_dir), types or schemas.EVENT_TYPES)


def _rate(spark, sf_dir) -> DataFrame:
    return aggregates.hourly_event_rate(_typed(spark, sf_dir))


def _severity(spark, sf_dir) -> DataFrame:
    return aggregates.severity_trend(_typed(spark, sf_dir, schemas.SYMPTOM, schemas.HOSPITAL))


def _beds(spark, sf_dir) -> DataFrame:
    return aggregates.bed_availability(_typed(spark, sf_dir, schemas.HOSPITAL))


def _vaccination(spark, sf_dir) -> DataFrame:
    return aggregates.vaccination_trend(_typed(spark, sf_dir, schemas.VACCINATION))


def _analytics(spark, sf_dir) -> dict[str, DataFrame]:
    return {
        "hourly_event_rate": _rate(spark, sf_dir),
        "severity_trend": _severity(spark, sf_dir),
        "bed_availability": _beds(spark, sf_dir),
        "vaccination_trend": _vaccination(spark, sf_dir),
    }


def _features(spark, sf_dir) -> DataFrame:
    return risk.features_from_rollup(aggregates.event_rollup(_typed(spark, sf_dir)))


def _predictions(spark, sf_dir) -> DataFrame:
    return risk.predictions(_features(spark, sf_dir), AS_OF)


def _with_predictions(spark, sf_dir) -> dict[str, DataFrame]:
    return {**_analytics(spark, sf_dir), "outbreak_predictions": _predictions(spark, sf_dir)}


def _checks(spark, sf_dir) -> DataFrame:
    """Two runs of the quality report."""
    tables = _with_predictions(spark, sf_dir)
    return quality.dq_report(spark, tables, EARLIER_CHECK).unionByName(
        quality.dq_report(spark, tables, LATER_CHECK)
    )


def _database(spark, purpose: str) -> str:
    """A new database in the shared folder."""
    root = work_dir(spark, purpose)
    return store.create_database(spark, root.rsplit("/", 1)[1].replace("-", "_"), root)


def _stored(spark, sf_dir, name: str) -> str:
    """A database with all six result tables, written from one read of the events."""
    database = _database(spark, name)
    refresh.refresh_analytics(spark, events.clean(_typed(spark, sf_dir)), database)
    refresh.refresh_predictions(spark, database, AS_OF)
    for moment in (EARLIER_CHECK, LATER_CHECK):
        refresh.record_checks(spark, database, moment)
    return database


def _all_tables(spark, sf_dir) -> dict[str, DataFrame]:
    """The six result tables as stored."""
    database = _stored(spark, sf_dir, "all-tables")
    return refresh.read_analytics(spark, database, also=("outbreak_predictions", "data_quality_checks"))


# --- sources -----------------------------------------------------------------------------------------------------


@query
def scan_events(spark, sf_dir):
    scanned = events.scan_events(_raw(spark, sf_dir), schemas.merged_event_schema(), ["offset"])
    return scanned.select(*derived.EVENT_COLUMNS)


@query
def parse_json_events(spark, sf_dir):
    decoded = events.decode(_raw(spark, sf_dir), schemas.merged_event_schema(), ["offset"])
    return decoded.select(*derived.EVENT_COLUMNS)


@query
def clean_events(spark, sf_dir):
    decoded = events.decode(_raw(spark, sf_dir), schemas.merged_event_schema(), ["offset"])
    return events.clean(decoded).select("offset", *events.BASE_COLUMNS)


@query
def optional_source_empty(spark, sf_dir):
    optional = events.read_optional_events(
        spark,
        schemas.VACCINATION,
        lambda: events.read_messages(spark, "parquet", f"{sf_dir}/vaccination_records"),
    )
    typed = _typed(spark, sf_dir, schemas.SYMPTOM, schemas.CLINIC, schemas.HOSPITAL)
    return aggregates.hourly_event_rate(typed, optional)


@query
def optional_source_present(spark, sf_dir):
    path = f"{work_dir(spark, 'optional')}/vaccination_records"
    derived.with_faults(_typed(spark, sf_dir, schemas.VACCINATION)).write.parquet(path)
    optional = events.read_optional_events(
        spark, schemas.VACCINATION, lambda: events.read_messages(spark, "parquet", path)
    )
    typed = _typed(spark, sf_dir, schemas.SYMPTOM, schemas.CLINIC, schemas.HOSPITAL)
    return aggregates.hourly_event_rate(typed, optional)


@query
def union_events(spark, sf_dir):
    return events.union_streams(*[_typed(spark, sf_dir, event_type) for event_type in schemas.EVENT_TYPES])


@query
def sample_events(spark, sf_dir):
    sample = events.sample_events(_raw(spark, sf_dir), schemas.VACCINATION, 5, ["offset"])
    return sample.select("offset")


@query
def scan_result_tables(spark, sf_dir):
    scans = []
    for table, df in _all_tables(spark, sf_dir).items():
        region = F.col("region") if "region" in df.columns else F.lit(None).cast("string")
        scans.append(
            df.select(
                F.lit(table).alias("table_name"),
                F.col(schemas.TIME_COLUMN[table]).alias("row_time"),
                region.alias("region"),
            )
        )
    return reduce(DataFrame.unionByName, scans)


def _scan_of(table: str) -> Query:
    def scan(spark: SparkSession, sf_dir: str) -> DataFrame:
        return store.scan_result_table(_all_tables(spark, sf_dir)[table], table)

    return scan


for _table in (*refresh.ANALYTICS, "outbreak_predictions", "data_quality_checks"):
    query(_scan_of(_table), f"stored_{_table}")


# --- validation and routing --------------------------------------------------------------------------------------


@query
def validate_bad_json(spark, sf_dir):
    return validate.parse(_raw(spark, sf_dir)).select("offset", validate.is_bad_json().alias("bad_json"))


@query
def validate_base_required(spark, sf_dir):
    others = _parsed(spark, sf_dir).where(~validate.is_vaccination())
    missing = F.array_join(validate.missing(validate.BASE_REQUIRED), ",")
    return others.select("offset", "event_type", missing.alias("missing"))


@query
def validate_vax_required(spark, sf_dir):
    missing = F.array_join(validate.missing(validate.VACCINATION_REQUIRED), ",")
    return _vaccinations(spark, sf_dir).select("offset", missing.alias("missing"))


@query
def validate_timestamp(spark, sf_dir):
    return _parsed(spark, sf_dir).select("offset", validate.is_timestamp("timestamp").alias("ok"))


@query
def validate_schema_version(spark, sf_dir):
    return _vaccinations(spark, sf_dir).select("offset", validate.is_schema_version().alias("ok"))


@query
def validate_dose_number(spark, sf_dir):
    return _vaccinations(spark, sf_dir).select("offset", validate.is_dose_number().alias("ok"))


@query
def validate_administered_at(spark, sf_dir):
    return _vaccinations(spark, sf_dir).select("offset", validate.is_timestamp("administered_at").alias("ok"))


@query
def validate_events(spark, sf_dir):
    judged = validate.validate_events(_raw(spark, sf_dir))
    return judged.select(
        "offset", "event_type", "reason", F.array_join("missing_fields", ",").alias("missing")
    )


@query
def validation_summary(spark, sf_dir):
    return validate.validation_summary(validate.validate_events(_raw(spark, sf_dir)))


def _targeted(spark, sf_dir) -> DataFrame:
    return route.with_target(validate.valid_messages(_raw(spark, sf_dir)), TEAM, AS_OF)


@query
def enrich_events(spark, sf_dir):
    enriched = route.enrich_events(validate.valid_messages(_raw(spark, sf_dir)), TEAM, AS_OF)
    stored = [F.get_json_object("value", f"$.{name}").alias(f"json_{name}") for name in route.ENRICHMENT]
    kept = F.get_json_object("value", "$.patient_id").alias("json_patient_id")
    return enriched.select("offset", *route.ENRICHMENT, *stored, kept)


@query
def route_events(spark, sf_dir):
    return route.route_events(_targeted(spark, sf_dir)).select("offset", "event_type", "topic")


@query
def unroutable_events(spark, sf_dir):
    return route.unroutable_events(_targeted(spark, sf_dir)).select("offset", "event_type")


@query
def routing_summary(spark, sf_dir):
    return route.routing_summary(_targeted(spark, sf_dir))


# --- hourly aggregates -------------------------------------------------------------------------------------------


@query
def hourly_event_rate(spark, sf_dir):
    return aggregates.in_order(_rate(spark, sf_dir), "hourly_event_rate")


@query
def severity_score(spark, sf_dir):
    labelled = _typed(spark, sf_dir, schemas.SYMPTOM, schemas.HOSPITAL).where(F.col("severity").isNotNull())
    return labelled.select("offset", "severity", scoring.severity_score(F.col("severity")).alias("score"))


@query
def severity_trend(spark, sf_dir):
    return aggregates.in_order(_severity(spark, sf_dir), "severity_trend")


@query
def bed_availability(spark, sf_dir):
    return aggregates.in_order(_beds(spark, sf_dir), "bed_availability")


@query
def vaccination_trend(spark, sf_dir):
    return aggregates.in_order(_vaccination(spark, sf_dir), "vaccination_trend")


@query
def topic_counts(spark, sf_dir):
    return aggregates.topic_counts(_typed(spark, sf_dir))


# --- outbreak risk -----------------------------------------------------------------------------------------------


@query
def risk_event_features(spark, sf_dir):
    return risk.event_features(_rate(spark, sf_dir))


@query
def risk_severity_features(spark, sf_dir):
    return risk.severity_features(_severity(spark, sf_dir))


@query
def risk_bed_features(spark, sf_dir):
    return risk.bed_features(_beds(spark, sf_dir))


@query
def risk_vaccination_features(spark, sf_dir):
    return risk.vaccination_features(_vaccination(spark, sf_dir))


@query
def risk_joined_features(spark, sf_dir):
    return risk.joined_features(*_analytics(spark, sf_dir).values())


@query
def risk_component_scores(spark, sf_dir):
    return risk.component_scores(_features(spark, sf_dir))


@query
def outbreak_risk(spark, sf_dir):
    return risk.outbreak_risk(_features(spark, sf_dir))


@query
def outbreak_risk_joined(spark, sf_dir):
    return risk.outbreak_risk(risk.joined_features(*_analytics(spark, sf_dir).values()))


@query
def top_risk(spark, sf_dir):
    return risk.top_risk(risk.outbreak_risk(_features(spark, sf_dir)))


# --- top-k, latest rows, retention -------------------------------------------------------------------------------


@query
def latest_beds(spark, sf_dir):
    return reports.latest_beds(_beds(spark, sf_dir))


@query
def latest_admission_rate(spark, sf_dir):
    return reports.latest_admission_rate(aggregates.hourly_event_rate(_typed(spark, sf_dir, schemas.HOSPITAL)))


@query
def top_event_rate(spark, sf_dir):
    return alerts.top_event_rate(_rate(spark, sf_dir))


@query
def top_severity(spark, sf_dir):
    return alerts.top_severity(_severity(spark, sf_dir))


@query
def top_bed_pressure(spark, sf_dir):
    return alerts.top_bed_pressure(_beds(spark, sf_dir))


@query
def vaccination_latest_hour(spark, sf_dir):
    return alerts.vaccination_latest_hour(_vaccination(spark, sf_dir))


@query
def recent_rows(spark, sf_dir):
    return reports.recent_rows(_rate(spark, sf_dir), "hourly_event_rate", 10)


@query
def recent_vaccinations(spark, sf_dir):
    return reports.recent_rows(_vaccination(spark, sf_dir), "vaccination_trend", 20)


@query
def recent_checks(spark, sf_dir):
    return reports.recent_rows(_checks(spark, sf_dir), "data_quality_checks", 20)


@query
def retention_filter(spark, sf_dir):
    return reports.retained(_rate(spark, sf_dir), "hour", AS_OF, days=7)


# --- data quality ------------------------------------------------------------------------------------------------


@query
def dq_null_keys(spark, sf_dir):
    decoded = events.decode(_raw(spark, sf_dir), schemas.merged_event_schema())
    counted = decoded.agg(
        F.lit("decoded_events").alias("table_name"),
        F.count("*").alias("row_count"),
        F.count_if(quality.null_keys(events.BASE_COLUMNS)).alias("null_rows"),
    )
    for table, df in _analytics(spark, sf_dir).items():
        stats = quality.table_stats(df, table)
        counted = counted.unionByName(stats.select(F.lit(table).alias("table_name"), "row_count", "null_rows"))
    return counted


@query
def dq_freshness(spark, sf_dir):
    frames = [quality.freshness(table, df, AS_OF) for table, df in _analytics(spark, sf_dir).items()]
    return reduce(DataFrame.unionByName, frames)


@query
def dq_table_state(spark, sf_dir):
    """Tables are looked up in the catalog, which has no predictions yet."""
    watched = {**settings.WATCHED_TABLES, "outbreak_predictions": []}
    database = _refreshed(spark, sf_dir, "table-state")
    tables = {table: store.read_table(spark, database, table) for table in watched}
    frames = [quality.table_state_checks(spark, table, tables[table], keys, AS_OF) for table, keys in watched.items()]
    return reduce(DataFrame.unionByName, frames)


@query
def dq_domain(spark, sf_dir):
    return quality.domain_checks(spark, _analytics(spark, sf_dir), AS_OF)


@query
def dq_report(spark, sf_dir):
    return quality.dq_report(spark, _with_predictions(spark, sf_dir), AS_OF)


@query
def dq_summary(spark, sf_dir):
    return quality.dq_summary(_checks(spark, sf_dir))


# --- alerts ------------------------------------------------------------------------------------------------------


@query
def classify_levels(spark, sf_dir):
    limits = ALERT_LIMITS
    count, mean, least = F.col("event_count"), F.col("avg_severity"), F.col("min_available_beds")
    rate_level = scoring.level_at_least(count, limits.event_warning, limits.event_critical)
    severity_level = scoring.level_at_least(mean, limits.severity_warning, limits.severity_critical)
    bed_level = scoring.level_at_most(least, limits.beds_warning, limits.beds_critical)

    def classified(df, metric, time, value, level):
        return df.select(
            F.lit(metric).alias("metric"),
            F.col(time).alias("row_time"),
            "region",
            value.cast("double").alias("observed"),
            level.alias("level"),
        )

    return (
        classified(_rate(spark, sf_dir), "event_rate", "hour", count, rate_level)
        .unionByName(classified(_severity(spark, sf_dir), "severity", "window_start", mean, severity_level))
        .unionByName(classified(_beds(spark, sf_dir), "bed_availability", "hour", least, bed_level))
    )


@query
def alert_event_rate(spark, sf_dir):
    return alerts.event_rate_alerts(_rate(spark, sf_dir), ALERT_LIMITS)


@query
def alert_severity(spark, sf_dir):
    return alerts.severity_alerts(_severity(spark, sf_dir), ALERT_LIMITS)


@query
def alert_bed_availability(spark, sf_dir):
    return alerts.bed_alerts(_beds(spark, sf_dir), ALERT_LIMITS)


@query
def alert_vaccination(spark, sf_dir):
    return alerts.vaccination_alerts(_vaccination(spark, sf_dir), ALERT_LIMITS)


@query
def alert_data_quality(spark, sf_dir):
    return alerts.data_quality_alerts(_checks(spark, sf_dir), AS_OF, ALERT_LIMITS)


@query
def alert_pipeline_freshness(spark, sf_dir):
    return alerts.freshness_alerts(_rate(spark, sf_dir), "2024-01-31 12:21:00", ALERT_LIMITS)


@query
def alert_feed(spark, sf_dir):
    return refresh.poll_alerts(spark, _stored(spark, sf_dir, "poll"), AS_OF, ALERT_LIMITS)


@query
def alert_cycle(spark, sf_dir):
    database = _stored(spark, sf_dir, "cycle")
    for moment in POLLS:
        refresh.alert_cycle(spark, database, moment, ALERT_LIMITS)
    return store.read_table(spark, database, "alert_log")


def _bed_event_alerts(hospital: DataFrame) -> DataFrame:
    """One alert per admission that reports few beds."""
    level = scoring.level_at_most(
        F.col("available_beds"), alerts.DEFAULTS.beds_warning, alerts.DEFAULTS.beds_critical
    )
    return hospital.select(
        level.alias("level"),
        F.lit("bed_availability").alias("metric"),
        "region",
        F.col("timestamp").alias("polled_at"),
        F.col("offset").alias("position"),
    ).where(F.col("level").isNotNull())


@query
def alert_cooldown(spark, sf_dir):
    return suppress_repeats(_bed_event_alerts(_typed(spark, sf_dir, schemas.HOSPITAL)), COOLDOWN)


@query
def alert_cooldown_polled(spark, sf_dir):
    found = at_polls(_bed_event_alerts(_typed(spark, sf_dir, schemas.HOSPITAL)), POLL_SECONDS)
    return suppress_repeats(found, COOLDOWN)


# --- reports -----------------------------------------------------------------------------------------------------


def _labelled(spark, sf_dir) -> DataFrame:
    rate = aggregates.hourly_event_rate(_typed(spark, sf_dir, schemas.HOSPITAL))
    return reports.labelled_regions(_beds(spark, sf_dir), rate, BED_LIMITS)


@query
def bed_warning_report(spark, sf_dir):
    return reports.bed_warning_report(_labelled(spark, sf_dir))


@query
def bed_warning_summary(spark, sf_dir):
    return reports.bed_warning_summary(_labelled(spark, sf_dir))


@query
def table_state(spark, sf_dir):
    return reports.table_state(_analytics(spark, sf_dir))


def _health(spark, sf_dir) -> DataFrame:
    tables = _analytics(spark, sf_dir)
    states = reports.table_state({name: tables[name] for name in settings.HEALTH_TABLES})
    return reports.pipeline_health(states, "2024-01-31 07:00:00")


@query
def pipeline_health(spark, sf_dir):
    return _health(spark, sf_dir)


@query
def pipeline_health_summary(spark, sf_dir):
    return reports.pipeline_health_summary(_health(spark, sf_dir))


@query
def table_row_counts(spark, sf_dir):
    return reports.table_row_counts(_all_tables(spark, sf_dir))


# --- chart tables ------------------------------------------------------------------------------------------------


@query
def chart_event_rate(spark, sf_dir):
    return charts.event_rate_chart(_rate(spark, sf_dir))


@query
def chart_region_totals(spark, sf_dir):
    return charts.region_totals(_rate(spark, sf_dir))


@query
def chart_severity(spark, sf_dir):
    return charts.severity_chart(_severity(spark, sf_dir), derived.REGIONS)


@query
def chart_beds(spark, sf_dir):
    return charts.beds_chart(_beds(spark, sf_dir), derived.REGIONS)


@query
def chart_risk(spark, sf_dir):
    return charts.risk_chart(_predictions(spark, sf_dir), derived.REGIONS)


@query
def chart_vaccination(spark, sf_dir):
    return charts.vaccination_chart(_vaccination(spark, sf_dir))


@query
def chart_dq_status(spark, sf_dir):
    return charts.status_chart(_checks(spark, sf_dir))


@query
def chart_top_severity(spark, sf_dir):
    return charts.top_severity(_severity(spark, sf_dir))


@query
def chart_top_beds(spark, sf_dir):
    return charts.top_beds(_beds(spark, sf_dir))


@query
def chart_top_risk(spark, sf_dir):
    return charts.top_risk(_predictions(spark, sf_dir))


@query
def chart_top_vaccination(spark, sf_dir):
    return charts.top_vaccination(_vaccination(spark, sf_dir))


@query
def chart_recent_checks(spark, sf_dir):
    return charts.recent_checks(_checks(spark, sf_dir))


# --- stored tables -----------------------------------------------------------------------------------------------


@query
def sink_full_refresh(spark, sf_dir):
    """The second refresh replaces the first, also on dates that it has no rows for."""
    database = _database(spark, "full-refresh")
    early = events.clean(_typed(spark, sf_dir)).where(F.col("timestamp") < "2024-01-10")
    store.refresh_tables(spark, database, {"hourly_event_rate": aggregates.hourly_event_rate(early)})
    results = _analytics(spark, sf_dir)
    store.refresh_tables(spark, database, results)
    return reports.table_state({table: store.read_table(spark, database, table) for table in results})


def _refreshed(spark, sf_dir, purpose: str) -> str:
    database = _database(spark, purpose)
    refresh.refresh_analytics(spark, events.clean(_typed(spark, sf_dir)), database)
    return database


@query
def pipeline_refresh(spark, sf_dir):
    return store.read_table(spark, _refreshed(spark, sf_dir, "pipeline"), "hourly_event_rate")


@query
def pipeline_refresh_state(spark, sf_dir):
    return reports.table_state(refresh.read_analytics(spark, _refreshed(spark, sf_dir, "pipeline")))


@query
def predictions_refresh(spark, sf_dir):
    database = _refreshed(spark, sf_dir, "predictions")
    refresh.refresh_predictions(spark, database, AS_OF)
    return store.read_table(spark, database, "outbreak_predictions")


@query
def dq_history_append(spark, sf_dir):
    database = _refreshed(spark, sf_dir, "history")
    refresh.refresh_predictions(spark, database, AS_OF)
    refresh.record_checks(spark, database, EARLIER_CHECK)
    return refresh.record_checks(spark, database, LATER_CHECK)


@query
def pipeline_from_raw(spark, sf_dir):
    root = work_dir(spark, "from-raw")
    _raw(spark, sf_dir).write.parquet(f"{root}/raw")
    messages = events.read_messages(spark, "parquet", f"{root}/raw")
    database = _database(spark, "from-raw-tables")
    refresh.results_from_raw(spark, messages, database, TEAM, AS_OF)
    return store.read_table(spark, database, "outbreak_predictions")


@query
def retention_clean_up(spark, sf_dir):
    database = _refreshed(spark, sf_dir, "retention")
    store.clean_up(spark, database, AS_OF)
    return store.read_table(spark, database, "hourly_event_rate")


SLICES = 3


def _slices(spark, sf_dir) -> list[DataFrame]:
    """The events in the order of their numbers: each slice has rows of all dates, so later ones bring late rows."""
    typed = events.clean(_typed(spark, sf_dir))
    return [typed.where(F.col("offset") % SLICES == k) for k in range(SLICES)]


def _incremental(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The table after three slices of events, the second of which was merged twice."""
        database = _database(spark, "incremental")
        for k, part in enumerate(_slices(spark, sf_dir)):
            for _ in range(2 if k == 1 else 1):
                refresh.merge_events(spark, part, database, f"slice-{k}", [table])
        return store.read_table(spark, database, table)

    return run


for _table in refresh.ANALYTICS:
    query(_incremental(_table), f"incremental_{_table}")


# --- streams -----------------------------------------------------------------------------------------------------


@query
def ingest_stream(spark, sf_dir):
    root = work_dir(spark, "ingest")
    ingest.ingest(_raw_stream(spark, sf_dir), f"{root}/events", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/events").select("offset", "verdict", "reason")


@query
def publish_valid(spark, sf_dir):
    root = work_dir(spark, "publish")
    stream = _raw_stream(spark, sf_dir)
    ingest.publish_valid(stream, f"{root}/checkpoint", "parquet", f"{root}/valid").awaitTermination()
    published = spark.read.parquet(f"{root}/valid")
    return published.select(
        *[F.get_json_object("value", f"$.{name}").alias(name) for name in ("event_type", "region", "patient_id")]
    )


@query
def publish_routed(spark, sf_dir):
    root = work_dir(spark, "route")
    valid = validate.valid_messages(_raw_stream(spark, sf_dir))
    routed = ingest.publish_routed(
        valid, f"{root}/checkpoint", "parquet", f"{root}/streams", team_id=TEAM, as_of=AS_OF
    )
    routed.awaitTermination()
    return spark.read.parquet(f"{root}/streams").groupBy("topic").agg(F.count("*").alias("messages"))


def _summary_frame(spark, counts: dict[str, int]) -> DataFrame:
    return spark.range(1).select(*[F.lit(value).cast("long").alias(name) for name, value in counts.items()])


@query
def ingest_stream_summary(spark, sf_dir):
    """What the streaming ingestion counted while it stored the messages."""
    root = work_dir(spark, "ingest")
    run = ingest.ingest(_raw_stream(spark, sf_dir), f"{root}/events", f"{root}/checkpoint")
    run.awaitTermination()
    return _summary_frame(spark, ingest.run_summary(run, "validation"))


@query
def route_stream_summary(spark, sf_dir):
    """What the streaming fan-out counted while it wrote the messages."""
    root = work_dir(spark, "route")
    valid = validate.valid_messages(_raw_stream(spark, sf_dir))
    run = ingest.publish_routed(
        valid, f"{root}/checkpoint", "parquet", f"{root}/streams", team_id=TEAM, as_of=AS_OF
    )
    run.awaitTermination()
    return _summary_frame(spark, ingest.run_summary(run, "routing"))


def _streamed(spark, result: DataFrame, name: str) -> DataFrame:
    root = work_dir(spark, name)
    ingest.append_to_files(result, f"{root}/result", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(result.schema).parquet(f"{root}/result")


def _refreshed_by_stream(spark, sf_dir, *tables: str) -> str:
    """A database whose tables a stream has kept up to date over three runs, each with new events."""
    root = work_dir(spark, "stream")
    database = _database(spark, "stream-tables")
    for part in _slices(spark, sf_dir):
        part.write.mode("append").parquet(f"{root}/events")
        stream = spark.readStream.schema(part.schema).parquet(f"{root}/events")
        rates.refresh_stream(stream, database, f"{root}/checkpoint", tables=tables).awaitTermination()
    return database


def _stream_refresh(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rates.with_open_hours(spark, _refreshed_by_stream(spark, sf_dir, table), table)

    return run


for _table, _name in (
    ("hourly_event_rate", "stream_hourly_rate"),
    ("severity_trend", "stream_severity_trend"),
    ("bed_availability", "stream_bed_availability"),
    ("vaccination_trend", "stream_vaccination_trend"),
):
    query(_stream_refresh(_table), _name)


@query
def stream_late_events(spark, sf_dir):
    return store.read_table(spark, _refreshed_by_stream(spark, sf_dir), "late_events")


@query
def stream_progress(spark, sf_dir):
    return store.read_table(spark, _refreshed_by_stream(spark, sf_dir), "stream_progress")


@query
def alert_cooldown_stream(spark, sf_dir):
    bed_alerts = _bed_event_alerts(_typed_stream(spark, sf_dir, schemas.HOSPITAL))
    return _streamed(spark, streaming_cooldown.emitted_alerts(bed_alerts, COOLDOWN), "stream-cooldown")


@query
def alert_cooldown_stream_status(spark, sf_dir):
    """Every alert with its status, over three batches that all go back to the first day."""
    root = work_dir(spark, "stream-cooldown")
    found = _bed_event_alerts(_typed(spark, sf_dir, schemas.HOSPITAL))
    for k in range(SLICES):
        found.where(F.col("position") % SLICES == k).write.mode("append").parquet(f"{root}/alerts")
        stream = spark.readStream.schema(found.schema).parquet(f"{root}/alerts")
        classified = streaming_cooldown.suppress_repeats(stream, COOLDOWN)
        ingest.append_to_files(classified, f"{root}/result", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(classified.schema).parquet(f"{root}/result")

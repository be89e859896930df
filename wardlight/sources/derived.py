"""Surveillance events derived from the driver's ``events`` and ``region`` tables (rules in FIXTURES.md)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight import schemas

# Fixed values of the derivation.
SOURCE_TYPE = {
    schemas.SYMPTOM: "click",
    schemas.CLINIC: "view",
    schemas.HOSPITAL: "purchase",
    schemas.VACCINATION: "signup",
}
OTHER_TYPES = ["general_health_report", "vaccination", "emergency_incident"]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

# Column by column, from a row of ``events`` with ``k`` and the matching row of ``region``.
EVENT_EXPRESSIONS = {
    "offset": "event_id",
    "event_type": """
        CASE event_type
            WHEN 'click' THEN 'symptom_report' WHEN 'view' THEN 'clinic_visit'
            WHEN 'purchase' THEN 'hospital_admission' WHEN 'signup' THEN 'vaccination_record'
            WHEN 'error' THEN element_at(array('general_health_report', 'vaccination', 'emergency_incident'), k % 3 + 1)
        END""",
    "timestamp": "CAST(ts AS TIMESTAMP)",
    "region": "r_name",
    "patient_id": "concat('P', user_id)",
    "severity": """
        CASE
            WHEN event_type NOT IN ('click', 'purchase') OR k % 10 = 0 THEN NULL
            WHEN value < 15 THEN 'low' WHEN value < 35 THEN 'moderate' WHEN value < 70 THEN 'high'
            WHEN value < 140 THEN 'severe' WHEN value < 300 THEN 'critical' ELSE 'unknown'
        END""",
    "available_beds": "CASE WHEN event_type = 'purchase' AND k % 7 <> 0 THEN 3 * k END",
    "schema_version": "CASE WHEN event_type = 'signup' THEN if(k % 13 = 0, 1, 2) END",
    "dose_number": "CASE WHEN event_type = 'signup' THEN k % 4 END",
    "vaccine_type": """
        CASE WHEN event_type = 'signup' AND k % 11 <> 0
            THEN element_at(array('influenza', 'covid19', 'measles'), CAST(user_id % 3 AS INT) + 1) END""",
    "record_id": "CASE WHEN event_type = 'signup' THEN concat('VR', event_id) END",
    "administered_at": f"""
        CASE WHEN event_type = 'signup'
            THEN date_format(CAST(ts AS TIMESTAMP) - INTERVAL 2 MINUTES, "{ISO}") END""",
}
EVENT_COLUMNS = list(EVENT_EXPRESSIONS)

# A raw message has a bad timestamp, no region or an empty one, or a text that is cut off, by rules on its offset.
FAULTY_MESSAGE = f"""
    to_json(named_struct(
        'event_type', event_type,
        'timestamp', if(offset % 89 = 0, 'not-a-time', date_format(timestamp, "{ISO}")),
        'region', CASE WHEN offset % 97 = 1 THEN '' WHEN offset % 97 <> 0 THEN region END,
        {", ".join(f"'{name}', {name}" for name in EVENT_COLUMNS[4:])},
        'data', if(event_type IN ({", ".join(f"'{name}'" for name in OTHER_TYPES)}), 'placeholder', NULL)
    ))"""


# Declared, so that opening the tables needs no job that reads file footers.
EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)
REGION_SCHEMA = "r_regionkey int, r_name string"


def events_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as a file stream."""
    return spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def regions_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(REGION_SCHEMA).parquet(f"{sf_dir}/region.parquet")


def derive(source: DataFrame, regions: DataFrame, types: Sequence[str] | None = None) -> DataFrame:
    """Surveillance events with a typed timestamp.

    ``types`` limits the event types. The limit is put on the source column, so the scan can skip row groups; this is
    the counterpart of reading one typed stream.
    """
    if types is not None:
        source = source.where(F.col("event_type").isin([SOURCE_TYPE[t] for t in types]))
    return (
        source.selectExpr("*", "try_cast(get_json_object(props, '$.k') AS INT) AS k")
        .join(regions, F.expr("pmod(user_id, 5) = r_regionkey"), "left")
        .selectExpr(*[f"{expression} AS {name}" for name, expression in EVENT_EXPRESSIONS.items()])
    )


def derived_events(spark: SparkSession, sf_dir: str, types: Sequence[str] | None = None) -> DataFrame:
    return derive(events_frame(spark, sf_dir), regions_frame(spark, sf_dir), types)


def with_faults(events: DataFrame) -> DataFrame:
    """Raw JSON messages: ``offset`` and ``value``."""
    # explode makes ``value`` a stored column, as it is in a message source
    return events.selectExpr("offset", f"{FAULTY_MESSAGE} AS text").selectExpr(
        "offset", "explode(array(if(offset % 83 = 0, left(text, length(text) div 2), text))) AS value"
    )


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_faults(derived_events(spark, sf_dir))

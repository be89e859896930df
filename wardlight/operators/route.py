"""Enrichment of valid messages and fan-out to typed streams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight import settings
from wardlight.functions.scoring import first_match
from wardlight.functions.text import as_of_time, utc_iso
from wardlight.operators import validate

ENRICHMENT = ["team_id", "processing_timestamp", "event_source"]


def enrich_events(
    messages: DataFrame, team_id: str, as_of=None, event_source: str = settings.EVENT_SOURCE
) -> DataFrame:
    """Add the three enrichment columns and write them into the JSON text, replacing fields of the same name.

    All other fields keep their text, including those that no schema declares.
    """
    columns = [name for name in messages.columns if name not in ENRICHMENT]
    enriched = validate.parse(messages.select(*columns), also=ENRICHMENT).withColumns(
        {
            "team_id": F.lit(team_id),
            "processing_timestamp": utc_iso(as_of_time(as_of)),
            "event_source": F.lit(event_source),
        }
    )
    return (
        enriched.withColumn("bad_json", validate.is_bad_json())
        .withColumn("value", F.when(F.col("bad_json"), F.col("value")).otherwise(_with_enrichment()))
        .drop("_json")
    )


def _with_enrichment() -> Column:
    added = F.to_json(F.struct(*ENRICHMENT))
    trimmed = r"rtrim(' \t\n\r', value)"
    open_object = F.expr(f"left({trimmed}, length({trimmed}) - 1)")
    comma = F.when(open_object.rlike(r"^\s*\{\s*$"), F.lit("")).otherwise(F.lit(","))
    appended = F.concat(open_object, comma, F.substring(added, F.lit(2), F.length(added)))
    # a repeated name can make the rebuilding parse fail; the appended fields then count as the last of their name
    return F.when(_already_enriched(), F.coalesce(_rebuilt(), appended)).otherwise(appended)


def _already_enriched() -> Column:
    # a null in the text is a variant too; only an absent field is NULL
    return F.expr(" OR ".join(f"get(_json, 0).{name} IS NOT NULL" for name in ENRICHMENT))


def _rebuilt() -> Column:
    """The message from its parsed fields, so that no name occurs twice."""
    names = ", ".join(f"'{name}'" for name in ENRICHMENT)
    entries = ", ".join(f"'{name}', cast({name} as variant)" for name in ENRICHMENT)
    return F.expr(
        "to_json(map_concat(map_filter(cast(try_parse_json(value) as map<string, variant>), "
        f"(name, _) -> name not in ({names})), map({entries})))"
    )


def target_stream(event_type: Column, routes: Mapping[str, str]) -> Column:
    return first_match([(event_type == name, target) for name, target in routes.items()]).cast("string")


def with_target(
    messages: DataFrame,
    team_id: str,
    as_of=None,
    routes: Mapping[str, str] = settings.ROUTES,
    event_source: str = settings.EVENT_SOURCE,
) -> DataFrame:
    """Enriched messages with their target stream in ``topic``; NULL where the message will be dropped."""
    enriched = enrich_events(messages, team_id, as_of, event_source)
    target = F.when(~F.col("bad_json"), target_stream(F.col("event_type"), routes))
    return enriched.withColumn("topic", target).drop("bad_json")


def route_events(targeted: DataFrame) -> DataFrame:
    return targeted.where(F.col("topic").isNotNull())


def unroutable_events(targeted: DataFrame) -> DataFrame:
    return targeted.where(F.col("topic").isNull())


def summary_columns() -> list[Column]:
    """Messages processed, routed and dropped, as aggregates over messages with their target."""
    return [
        F.count("*").alias("processed"),
        F.count("topic").alias("routed"),
        F.count_if(F.col("topic").isNull()).alias("dropped"),
    ]


def routing_summary(targeted: DataFrame) -> DataFrame:
    return targeted.agg(*summary_columns())

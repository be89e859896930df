"""Per-record validation of raw JSON messages.

All functions work on batch and streaming frames alike and add columns without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight import schemas
from wardlight.functions.iso_time import is_iso_timestamp

# Required fields, in reporting order.
BASE_REQUIRED = ["event_type", "timestamp", "region"]
VACCINATION_REQUIRED = [
    "event_type",
    "schema_version",
    "timestamp",
    "record_id",
    "patient_id",
    "region",
    "vaccine_type",
    "dose_number",
    "administered_at",
]
REQUIRED_SCHEMA_VERSION = "2"

VALID = "valid"

# A message is parsed as the first of two array elements. If anything follows its JSON value, the second element is
# no longer this marker; parsing the bare text would ignore what follows.
_MARKER = "end-of-message"
_FIELDS = [name for name in VACCINATION_REQUIRED if name != "dose_number"]


def _parsed_type(variants: Sequence[str]) -> str:
    # as text, 2 and "2" are the same but 2.0 is not, which is what the rules ask; only the dose needs its JSON type
    fields = [f"{name}: string" for name in _FIELDS] + [f"{name}: variant" for name in ["dose_number", *variants]]
    return f"array<struct<{', '.join(fields)}, `{_MARKER}`: boolean>>"


def parse(messages: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Add ``_json`` (the needed fields in one pass over the text) and the ``event_type`` text.

    ``also`` names further fields to read, as variants. ``explode`` of the one-element array keeps the parsed value a
    column of its own. Without it, a filter on the verdict is pushed below the parsing and parses the text again for
    every field that it reads.
    """
    wrapped = F.concat(F.lit("["), "value", F.lit(f',{{"{_MARKER}":true}}]'))
    parsed = F.from_json(wrapped, _parsed_type(also), {"allowSingleQuotes": "false"})
    return messages.withColumn("_json", F.explode(F.array(parsed))).withColumn("event_type", field("event_type"))


def field(name: str) -> Column:
    """A field as text; NULL if absent or null."""
    return F.expr(_text(name))


def _text(name: str) -> str:
    if name == "dose_number":
        return "try_variant_get(get(_json, 0).dose_number, '$', 'string')"
    return f"get(_json, 0).{name}"


def is_bad_json() -> Column:
    """Not one JSON object: cut off, followed by other text, another JSON value, or one with a number that JSON lacks.

    The parser's NaN, Infinity and -Infinity are numbers here too, its +INF and -INF are not.
    """
    outside_text = r"""regexp_replace(value, '"([^"\\\\]|\\\\.)*"', '')"""
    return F.expr(f"contains(value, 'INF') AND {outside_text} RLIKE '[+-]INF'") | F.expr(
        f"NOT coalesce(value RLIKE '^[ \\\\t\\\\n\\\\r]*[{{]' AND size(_json) = 2 AND get(_json, 1).`{_MARKER}`, false)"
    )


def is_vaccination() -> Column:
    return F.expr(f"coalesce(event_type = '{schemas.VACCINATION}', false)")


def _absent(name: str) -> str:
    return f"coalesce({_text(name)}, '') = ''"


def missing(required: list[str]) -> Column:
    """Names of the required fields that are absent, null or empty. Blanks and zero count as present."""
    return F.expr(f"array_compact(array({', '.join(f'if({_absent(n)}, {n!r}, NULL)' for n in required)}))")


def missing_fields() -> Column:
    return F.when(is_vaccination(), missing(VACCINATION_REQUIRED)).otherwise(missing(BASE_REQUIRED))


def has_missing_fields() -> Column:
    """The same question without building the list."""
    base, vaccination = (" OR ".join(_absent(n) for n in names) for names in (BASE_REQUIRED, VACCINATION_REQUIRED))
    return F.when(is_vaccination(), F.expr(vaccination)).otherwise(F.expr(base))


def is_timestamp(name: str) -> Column:
    # an integer such as 20260427 reads as a date; the text of any other JSON value does not
    return is_iso_timestamp(field(name))


def is_schema_version() -> Column:
    """2 or "2", but not 2.0."""
    return F.coalesce(field("schema_version") == REQUIRED_SCHEMA_VERSION, F.lit(False))


def is_dose_number() -> Column:
    """Convertible to an integer of at least 1: a number (cut to its integer part), true, or integer text."""
    dose = "get(_json, 0).dose_number"
    number = F.expr(f"try_variant_get({dose}, '$', 'double')")
    kind = F.expr(f"schema_of_variant({dose})")
    # optional blanks and sign, leading zeros, single underscores between digits, and one digit that is not zero
    integer_text = r"(?U)^\s*\+?(?:0_?)*[1-9](?:_?[0-9])*\s*$"
    convertible = (
        F.when(kind == "STRING", field("dose_number").rlike(integer_text))
        .when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)"), (number >= 1) & (number < float("inf")))
        .otherwise(False)
    )
    return F.coalesce(convertible, F.lit(False))


def verdict() -> Column:
    """The first rule that a message fails, or ``valid``."""
    vaccination = is_vaccination()
    return (
        F.when(is_bad_json(), "bad_json")
        .when(has_missing_fields(), "missing_fields")
        .when(~is_timestamp("timestamp"), "bad_timestamp")
        .when(~vaccination, VALID)
        .when(~is_schema_version(), "bad_schema_version")
        .when(~is_dose_number(), "bad_dose_number")
        .when(~is_timestamp("administered_at"), "bad_administered_at")
        .otherwise(VALID)
    )


def validate_events(messages: DataFrame) -> DataFrame:
    """Add ``event_type``, ``reason`` and ``missing_fields`` to every message; unknown fields stay in ``value``."""
    judged = parse(messages).withColumn("reason", verdict())
    listed = F.when(F.col("reason") == "missing_fields", missing_fields()).otherwise(F.array().cast("array<string>"))
    return judged.withColumn("missing_fields", listed).drop("_json")


def valid_messages(messages: DataFrame) -> DataFrame:
    columns = messages.columns
    return parse(messages).where(verdict() == VALID).select(*columns)


def summary_columns() -> list[Column]:
    """Messages seen, valid and invalid, as aggregates over judged messages."""
    valid = F.col("reason") == VALID
    return [
        F.count("*").alias("total_seen"),
        F.count_if(valid).alias("valid"),
        F.count_if(~valid).alias("invalid"),
    ]


def validation_summary(judged: DataFrame) -> DataFrame:
    return judged.agg(*summary_columns())

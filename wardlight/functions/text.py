"""Text and time helpers used in messages."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_time(as_of: datetime | str | Column | None) -> Column:
    """The moment a job looks at the data: a literal for repeatable runs, or the current time."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    # text with an explicit zone, so the session time zone cannot shift it
    return F.lit(as_of.astimezone(timezone.utc).isoformat()).cast("timestamp")


def age_hours(as_of: Column, moment: Column) -> Column:
    seconds = (F.unix_micros(as_of) - F.unix_micros(moment)) / F.lit(1e6)
    return seconds / F.lit(3600.0)


def utc_iso(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def utc_text(moment: Column) -> Column:
    """``2024-01-30 23:00:00+00:00``, with microseconds only where there are any."""
    has_fraction = F.unix_micros(moment) % F.lit(1_000_000) != 0
    return F.when(has_fraction, F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS'+00:00'")).otherwise(
        F.date_format(moment, "yyyy-MM-dd HH:mm:ss'+00:00'")
    )


def fixed_decimals(value: Column, places: int) -> Column:
    """The double as text with ``places`` decimals, rounding its exact binary value and ties to even.

    ``format_string('%.1f')`` would round the shortest decimal form half up: 8.25 gives 8.3 and 8.35 gives 8.4 where
    C-style formatting gives 8.2 and 8.3.
    """
    return F.call_function("format_number", value.cast("double"), F.lit("0." + "0" * places))


def round_decimal(value: Column, places: int) -> Column:
    """Round a double half away from zero after reducing it to 15 significant digits, as a NUMERIC cast does."""
    fifteen_digits = F.format_string("%.14e", value.cast("double")).cast("decimal(38,20)")
    return F.when(value.isNotNull(), F.round(fifteen_digits, places).cast("double"))

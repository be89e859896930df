"""ISO-8601 timestamp check as a Column, accepting what CPython 3.11's ``datetime.fromisoformat`` accepts.

That grammar is wider than Spark's timestamp cast in some places (ISO weeks, compact forms) and narrower in others
(bare years, one-digit months), so the check is one regular expression and never parses the value.
The pattern text is valid for both Java and Python, which lets the tests compare it with the standard library.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_FRACTION = "[.,][0-9]+"
_HOUR, _SIXTY, _NN = "(?:[01][0-9]|2[0-3])", "[0-5][0-9]", "[0-9]{2}"
_END = r"(?![\s\S])"


def _clock(hour: str, minute: str, second: str) -> str:
    """HH, HH:MM, HH:MM:SS or the same without colons, each with an optional fraction."""
    colons = f":{minute}(?:{_FRACTION}|:{second}(?:{_FRACTION}|:[0-9]+)?)?"
    compact = f"{minute}(?:{_FRACTION}|{second}(?:{_FRACTION}|[0-9]{{2,}})?)?"
    return f"{hour}(?:{_FRACTION}|{colons}|{compact})?"


def _time() -> str:
    strict = _clock(_HOUR, _SIXTY, _SIXTY)
    fields = f"{_HOUR}(?::{_SIXTY}(?::{_SIXTY})?|{_SIXTY}(?:{_SIXTY})?)?"
    # before an offset the parser lets pass one stray ASCII character, or any text after six fraction digits
    stray = rf"{fields}[\x01-\x2a,\x2e-\x7f]"
    long_fraction = f"(?:{fields}[.,]|{_HOUR}:{_SIXTY}:{_SIXTY}:|{_HOUR}{_SIXTY}{_SIXTY})[0-9]{{6,}}[^0-9+\\-][^+\\-]*"
    # an offset is any hours, minutes and seconds that add up to less than 24 hours
    offset = "|".join(
        [
            _clock("(?:[01][0-9]|2[0-2])", _NN, _NN),
            _clock("23", "(?:[0-4][0-9]|5[0-8])", _NN),
            _clock("23", "59", _SIXTY),
        ]
    )
    return f"(?:{strict}{_END}|(?:{strict}|{stray}|{long_fraction})[+\\-](?:{offset}){_END})"


def _calendar(dash: str) -> str:
    days = "|".join(
        [
            f"(?:0[13578]|1[02]){dash}(?:0[1-9]|[12][0-9]|3[01])",
            f"(?:0[469]|11){dash}(?:0[1-9]|[12][0-9]|30)",
            f"02{dash}(?:0[1-9]|1[0-9]|2[0-8])",
        ]
    )
    by_four = "(?:0[48]|[2468][048]|[13579][26])"
    leap_year = f"(?:[0-9]{{2}}{by_four}|{by_four}00)"
    return f"(?:(?!0000)[0-9]{{4}}{dash}(?:{days})|{leap_year}{dash}02{dash}29)"


def _week(week: str) -> str:
    time = _time()
    year = "(?!0000)[0-9]{4}"
    # the last two days of that week fall into the year 10000
    day = "(?:[1-5]|(?<!9999-W52-)(?<!9999W52)[67])"
    dashed = (
        f"{year}-W{week}(?:{_END}|[^\\-]{time}|-{time}|-{day}(?:{_END}|[^0-9]{time}))"
    )
    # without dashes a digit may be the separator; the parity of the digit run decides where the date ends
    odd_run, even_run = "(?=[0-9](?:[0-9]{2})+(?![0-9]))", "(?=(?:[0-9]{2})+(?![0-9]))"
    compact = (
        f"{year}W{week}(?:{_END}|[^0-9]{time}|{odd_run}[0-9]{time}"
        f"|{day}(?:{_END}|[^0-9]{time})|{even_run}{day}[0-9]{time})"
    )
    return f"^(?:{dashed}|{compact})"


DATE_PATTERN = rf"^(?:{_calendar('-')}|{_calendar('')})(?:{_END}|[\s\S]{_time()})"
WEEK_PATTERN = _week("(?:0[1-9]|[1-4][0-9]|5[0-2])")
WEEK_53_PATTERN = _week("53")


def _weekday_of_year_end(year: Column) -> Column:
    """Weekday of 31 December, 0 = Sunday."""
    return F.pmod(
        year + F.floor(year / F.lit(4)) - F.floor(year / F.lit(100)) + F.floor(year / F.lit(400)), F.lit(7)
    )


def is_iso_timestamp(text: Column) -> Column:
    """True where ``text`` is a date or date-time; False for anything else, NULL included."""
    utc = F.replace(text, F.lit("Z"), F.lit("+00:00"))
    year = F.substring(text, 1, 4).try_cast("int")
    long_year = (_weekday_of_year_end(year) == 4) | (_weekday_of_year_end(year - 1) == 3)
    accepted = (
        F.when(utc.rlike(DATE_PATTERN), True)
        .when(utc.rlike(WEEK_PATTERN), True)
        .when(utc.rlike(WEEK_53_PATTERN), long_year)
        .otherwise(False)
    )
    return F.coalesce(accepted, F.lit(False))

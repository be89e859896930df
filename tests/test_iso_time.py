from __future__ import annotations

import re
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardlight.functions.iso_time import DATE_PATTERN, WEEK_53_PATTERN, WEEK_PATTERN, is_iso_timestamp

EXAMPLES = [
    "2026-04-27T14:32:00Z",
    "2026-04-27T14:32:00+00:00",
    "2026-04-27 14",
    "2026-04-27",
    "20260427",
    "20260427T143200",
    "2026-W17-1",
    "2026W171",
    "2026W17",
    "2026-W53-1",
    "2025-W53-1",
    "2024-02-29",
    "2026-02-29",
    "2026-04-27T14:32:00,5",
    "2026-04-27T14:32:00.123456789",
    "2026-04-27T14:32:00.",
    "2026-04-27T24:00",
    "2026-13-01",
    "2026-04-31",
    "0000-01-01",
    "2026",
    "2026-04",
    "14:32",
    "2026-4-7T1:2:3",
    " 2026-04-27 ",
    "2026-04-27T",
    "2026-04-27T14:32+24:00",
    "2026-04-27T14:32+23:59",
    "2026-04-27T14:32z",
    "2026-04-27\n14:32",
    "2026-04-27T14:32\n",
    "not-a-time",
    "",
]


def accepted(text: str) -> bool:
    try:
        datetime.fromisoformat(text.replace("Z", "+00:00"))
        return True
    except ValueError:
        return False


def test_column_agrees_with_the_standard_library(spark):
    frame = spark.createDataFrame([(text,) for text in [*EXAMPLES, None]], "text string")
    rows = frame.select("text", is_iso_timestamp(F.col("text")).alias("ok")).collect()
    assert {row.text: row.ok for row in rows} == {**{text: accepted(text) for text in EXAMPLES}, None: False}


def matches(text: str) -> bool:
    text = text.replace("Z", "+00:00")
    if re.search(DATE_PATTERN, text) or re.search(WEEK_PATTERN, text):
        return True
    if not re.search(WEEK_53_PATTERN, text):
        return False
    year = int(text[:4])
    year_end = lambda y: (y + y // 4 - y // 100 + y // 400) % 7
    return year_end(year) == 4 or year_end(year - 1) == 3


digits = st.integers(0, 61).map("{:02d}".format)
clock = st.builds(
    lambda parts, sep, tail: sep.join(parts) + tail,
    st.lists(digits, min_size=1, max_size=3),
    st.sampled_from([":", ""]),
    st.sampled_from(["", ".5", ",25", ".123456", ".1234567", ".", ":", "x", "7"]),
)
day = st.builds(
    lambda year, sep, month, date, week: f"{year}{sep}{week}" if week else f"{year}{sep}{month}{sep}{date}",
    st.sampled_from(["2026", "2024", "1900", "2000", "9999", "0001", "0000", "2020"]),
    st.sampled_from(["-", ""]),
    digits,
    digits,
    st.sampled_from(["", "", "W01", "W53", "W52-7", "W527", "W17-1", "W00"]),
)
text = st.builds(
    lambda date, sep, time, zone: date + sep + time + zone,
    day,
    st.sampled_from(["T", " ", "", "-", "1", "é"]),
    st.one_of(st.just(""), clock),
    st.one_of(st.sampled_from(["", "Z", "+05:30", "-23:59", "+24:00", "+"]), clock.map("+{}".format)),
)


@settings(max_examples=3000, deadline=None)
@given(text)
def test_patterns_agree_with_the_standard_library(value):
    assert matches(value) == accepted(value)


@pytest.mark.parametrize("value", EXAMPLES)
def test_pattern_examples(value):
    assert matches(value) == accepted(value)

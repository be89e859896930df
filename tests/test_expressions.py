"""Scores, levels and message texts at their limits."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from wardlight.functions import scoring
from wardlight.functions.text import age_hours, as_of_time, fixed_decimals, round_decimal, utc_text


def values(spark, ddl, rows, *columns):
    return [tuple(row) for row in spark.createDataFrame(rows, ddl).select(*columns).collect()]


def test_fixed_decimals_follow_c_formatting(spark):
    numbers = [n / d for d in (8, 20, 40, 400, 3) for n in range(0, 3000, 7)]
    numbers += [8.25, 8.35, 2.675, 2.625, 0.05, -8.25, -0.04, 1234.5]
    rows = values(spark, "x double", [(x,) for x in numbers], "x", fixed_decimals(F.col("x"), 1),
                  fixed_decimals(F.col("x"), 2))
    assert [row for row in rows if row[1:] != (f"{row[0]:.1f}", f"{row[0]:.2f}")] == []


def test_round_decimal_is_half_away_from_zero(spark):
    rows = values(spark, "x double", [(0.285,), (2.675,), (0.125,), (-0.125,), (None,)], round_decimal(F.col("x"), 2))
    assert [row[0] for row in rows] == [0.29, 2.68, 0.13, -0.13, None]


def test_severity_scale(spark):
    labels = ["low", "moderate", "high", "severe", "critical", "Low", "unknown", "", None]
    rows = values(spark, "s string", [(s,) for s in labels], scoring.severity_score(F.col("s")))
    assert [row[0] for row in rows] == [1.0, 2.0, 3.0, 3.0, 4.0, None, None, None, None]


def test_limits_are_inclusive(spark):
    high = scoring.level_at_least(F.col("x"), 5, 10)
    low = scoring.level_at_most(F.col("x"), 100, 50)
    rows = values(spark, "x double", [(4.9,), (5.0,), (9.9,), (10.0,), (50.0,), (50.1,), (100.0,), (100.1,)], high, low)
    assert rows == [
        (None, "critical"),
        ("warning", "critical"),
        ("warning", "critical"),
        ("critical", "critical"),
        ("critical", "critical"),
        ("critical", "warning"),
        ("critical", "warning"),
        ("critical", None),
    ]


def test_severity_label_in_both_directions(spark):
    beds = scoring.severity_label(F.col("x"), 10, 5, low_is_bad=True)
    admissions = scoring.severity_label(F.col("x"), 20, 40, low_is_bad=False)
    rows = values(spark, "x int", [(5,), (6,), (10,), (11,), (19,), (20,), (39,), (40,)], beds, admissions)
    assert [row[0] for row in rows] == ["CRITICAL", "WARNING", "WARNING", "OK", "OK", "OK", "OK", "OK"]
    assert [row[1] for row in rows] == ["OK", "OK", "OK", "OK", "OK", "WARNING", "WARNING", "CRITICAL"]


def test_bed_steps(spark):
    rows = values(spark, "x int", [(50,), (51,), (100,), (101,), (200,), (201,), (999,)],
                  scoring.bed_pressure_score(F.col("x")))
    assert [row[0] for row in rows] == [1.0, 0.7, 0.7, 0.4, 0.4, 0.1, 0.1]


def test_risk_score_is_decimal_exact_where_it_can_be(spark):
    """The reference formula with exact decimals for the count-based parts and doubles for the severity part."""
    grid = [(n, s, b, v) for n in (0, 1, 3, 7, 10, 14) for s in (0.0, 1.0, 2.5, 8 / 3, 4.0)
            for b in (50, 100, 200, 999) for v in (0, 1, 3, 7, 19, 20, 25)]
    score = scoring.risk_score(*[F.col(c) for c in "nsbv"])
    rows = values(spark, "n bigint, s double, b int, v bigint", grid, "n", "s", "b", "v", score,
                  scoring.risk_level(score))
    for n, s, b, v, got, level in rows:
        event = Decimal("0.35") * min(Decimal(n) / 10, Decimal(1))
        beds = Decimal("0.20") * Decimal({50: "1.0", 100: "0.7", 200: "0.4", 999: "0.1"}[b])
        doses = Decimal("0.10") * max(Decimal(0), 1 - min(Decimal(v) / 20, Decimal(1)))
        expected = float(event) + 0.35 * min(s / 4.0, 1.0) + float(beds) + float(doses)
        assert got == expected
        assert level == next(
            name for limit, name in [(0.75, "critical"), (0.5, "high"), (0.3, "medium"), (-1, "low")]
            if expected >= limit
        )


def test_documented_example_scores_by_the_formula(spark):
    rows = values(spark, "n bigint, s double, b int, v bigint", [(18, 3.2, 42, 3)],
                  scoring.risk_score(*[F.col(c) for c in "nsbv"]))
    assert abs(rows[0][0] - 0.915) < 1e-12


def test_times(spark):
    moment = as_of_time(datetime(2024, 1, 31, 6, 0, 0))
    row = spark.range(1).select(
        age_hours(moment, as_of_time("2024-01-30 22:00:00")).alias("age"),
        utc_text(as_of_time("2024-01-30 22:00:00")).alias("plain"),
        utc_text(as_of_time("2024-01-30 22:00:00.25")).alias("fraction"),
    ).first()
    assert tuple(row) == (8.0, "2024-01-30 22:00:00+00:00", "2024-01-30 22:00:00.250000+00:00")

"""Cleaning, measures and rating rules against plain Python."""

from __future__ import annotations

import math
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import at, one
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from freightlens.functions import clean, measures, rating


def values(spark, column, data, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, c {kind}")
    return [r[0] for r in frame.orderBy("i").select(column).collect()]


def test_clean_str(spark):
    assert values(spark, clean.clean_str(F.col("c")), [" a ", "", "   ", None, "b"]) == ["a", None, None, None, "b"]


def test_null_markers(spark):
    assert values(spark, clean.null_markers(F.col("c")), ["NULL", " ", "", "null?", " x"]) == [
        None, None, None, "null?", " x",
    ]


def test_safe_ts_normalises_offsets(spark):
    got = values(
        spark,
        clean.safe_ts(F.col("c")),
        ["2024-01-01T05:00:00+00:00", "2024-01-01T05:00:00+02:00", "2024-01-01T05:00:00", " ", "junk", None,
         " 2024-01-01 05:00:00.25 "],
    )
    five = at("2024-01-01T05:00:00")
    assert got == [five, at("2024-01-01T03:00:00"), five, None, None, None, at("2024-01-01T05:00:00.250")]


def test_strict_ts_fails_on_junk(spark):
    with pytest.raises(PySparkException):
        values(spark, clean.strict_ts(F.col("c")), ["junk"])


def test_safe_date(spark):
    assert values(spark, clean.safe_date(F.col("c")), ["2024-02-29", "2023-02-29", "", " 2024-01-02 "]) == [
        date(2024, 2, 29), None, None, date(2024, 1, 2),
    ]


def test_to_bool(spark):
    words = ["1", "t", "TRUE", "Y", "yes", "0", "F", "no", "x", "", None]
    assert values(spark, clean.to_bool(F.col("c")), words) == [True] * 5 + [False] * 3 + [None] * 3
    assert values(spark, clean.to_bool(F.col("c"), default=False), words) == [True] * 5 + [False] * 6


def test_to_num_keeps_cents_and_fails_on_junk(spark):
    assert values(spark, clean.to_num(F.col("c"), "decimal(12,2)"), [" 12.34 ", "", None]) == [
        Decimal("12.34"), None, None,
    ]
    with pytest.raises(PySparkException):
        values(spark, clean.to_num(F.col("c"), "decimal(12,2)"), ["12,5"])


def test_on_time_boundary_is_inclusive(spark):
    plan = at("2024-01-01T10:00:00")
    actual = [plan + timedelta(minutes=60), plan + timedelta(minutes=60, seconds=1), None]
    late = measures.on_time(F.col("c"), F.lit(plan).cast("timestamp_ntz"))
    assert values(spark, late, actual, "timestamp_ntz") == [True, False, False]
    zero_grace = measures.on_time(F.col("c"), F.lit(plan).cast("timestamp_ntz"), 0)
    assert values(spark, zero_grace, [plan, actual[0]], "timestamp_ntz") == [True, False]


def test_otif_forms(spark):
    frame = spark.createDataFrame(
        [(True, True), (True, None), (False, None), (True, False)], "a boolean, b boolean"
    )
    report = [r[0] for r in frame.select(measures.otif(F.col("a"), F.col("b"))).collect()]
    curated = [r[0] for r in frame.select(measures.otif(F.col("a"), F.col("b"), null_is_false=True)).collect()]
    assert report == [True, None, False, False]
    assert curated == [True, False, False, False]


def test_gm_per_mile_zero_miles(spark):
    frame = spark.createDataFrame(
        [(Decimal("100.00"), Decimal("60.00"), Decimal("0.00")), (Decimal("100.00"), Decimal("60.00"), Decimal("80.00"))],
        "r decimal(12,2), c decimal(12,2), m decimal(10,2)",
    )
    got = [r[0] for r in frame.select(measures.gm_per_mile(F.col("r"), F.col("c"), F.col("m"))).collect()]
    assert got == [None, 0.5]


def test_transit_counts_day_boundaries(spark):
    frame = spark.createDataFrame(
        [(at("2024-01-01T23:50:00"), at("2024-01-02T00:10:00")), (at("2024-01-01T00:00:00"), at("2024-01-01T23:59:00"))],
        "p timestamp_ntz, d timestamp_ntz",
    )
    assert [r[0] for r in frame.select(measures.transit_days(F.col("p"), F.col("d"))).collect()] == [1, 0]


def test_lane_label_and_exception_type(spark):
    assert values(spark, measures.lane_label(F.col("c"), F.lit("B")), ["A", None]) == ["A → B", None]
    assert values(spark, measures.exception_type(F.col("c")), [None, "  ", " Weather "]) == [
        "Unknown", "Unknown", "Weather",
    ]


def test_haversine(spark):
    got = one(
        spark.range(1).select(rating.haversine_miles(F.lit(33.749), F.lit(-84.388), F.lit(41.878), F.lit(-87.629)))
    )[0]
    p, q = math.radians(33.749), math.radians(41.878)
    a = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(-87.629 + 84.388) / 2) ** 2
    assert got == pytest.approx(3958.8 * 2 * math.asin(math.sqrt(a)), rel=1e-12)


def test_transit_bucket_edges(spark):
    data = [299.99, 300.0, 599.0, 600.0, 999.0, 1000.0]
    assert values(spark, rating.transit_bucket(F.col("c"), F.lit("TL")), data, "double") == [1, 2, 2, 3, 3, 4]
    assert values(spark, rating.transit_bucket(F.col("c"), F.lit("Intermodal")), data, "double") == [2, 3, 3, 4, 4, 5]


def test_fuel_surcharge_floor_and_cents(spark):
    frame = spark.createDataFrame(
        [(Decimal("100.00"), Decimal("4.100")), (Decimal("100.00"), Decimal("1.000")), (Decimal("333.33"), Decimal("3.500"))],
        "m decimal(10,2), d decimal(6,3)",
    )
    got = [r[0] for r in frame.select(rating.fuel_surcharge(F.col("m"), F.col("d"))).collect()]
    assert got == [Decimal("15.00"), Decimal("5.00"), Decimal("40.00")]


def test_base_rate(spark):
    for mode, long_haul, short_haul in (("TL", 2.2, 2.5), ("LTL", 1.8, 2.0), ("Intermodal", 1.6, 1.8)):
        got = values(spark, rating.base_rate_per_mile(F.lit(mode), F.col("c")), [500.0, 500.01], "double")
        assert got == [short_haul, long_haul]


def test_volume_weight(spark):
    holiday = date(2024, 7, 4)
    days = [date(2024, 7, 1), date(2024, 7, 3), date(2024, 7, 4), date(2024, 7, 6), date(2024, 7, 27), date(2024, 7, 29)]
    weight = rating.volume_weight(F.col("c"), [holiday], 0.12)
    expected = []
    for d in days:
        w = 1.0 + (0.12 if d.day >= 27 else 0) + (0.10 if abs((d - holiday).days) <= 1 else 0)
        expected.append(w * (0.8 if d.weekday() >= 5 else 1.0))
    assert values(spark, weight, days, "date") == pytest.approx(expected)
    assert values(spark, rating.volume_repeats(weight), days, "date") == [max(1, round(w * 10)) for w in expected]
    assert values(spark, rating.volume_weight(F.col("c"), [], 0.0), days[:1], "date") == [1.0]


def test_week_of_year_matches_strftime(spark):
    start = date(2015, 1, 1)
    days = [start + timedelta(days=i) for i in range(16 * 365)]
    got = values(spark, rating.week_of_year_sunday(F.col("c")), days, "date")
    assert got == [int(d.strftime("%U")) for d in days]


def test_literal_now_type(spark):
    from freightlens.operators.shaping import now_literal

    assert spark.range(1).select(now_literal(datetime(2024, 1, 1)).alias("n")).dtypes == [("n", "timestamp_ntz")]


def test_trimmed_text_is_what_a_regular_expression_leaves(spark):
    ends = ["", " ", "\t", "\n", "\r\n", "\x0b", "\x0c", "\x85", " ", " ", "\xa0", "\x1c", " \x85", " \n", "\x85 \x85"]
    texts = [None, *(f"{a}{x}{b}" for a in ends for b in ends for x in ("", "k", "k \n k"))]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    both = df.select("c", clean.trim_spaces(F.col("c")).alias("now"), F.regexp_replace("c", r"^\s+|\s+$", "").alias("was"))
    assert [r for r in both.collect() if r.now != r.was] == []
    padded = df.where("c = '\tk\n' OR c = ' k '").select(clean.trim_spaces(F.col("c")))
    assert {r[0] for r in padded.collect()} == {"k"}

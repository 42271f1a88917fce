import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.functions import calendar, levels, text

# Text, first number, as double, kept by the strict cleaner.
GOLDEN = [
    ("3.488|3.486", "3.488", 3.488, None),
    ("-0.12", "-0.12", -0.12, -0.12),
    (".5", "5", 5.0, 0.5),
    ("-.5", "5", 5.0, -0.5),
    ("1e5", "1", 1.0, 100000.0),
    ("abc12", "12", 12.0, None),
    ("1,234", "1", 1.0, None),
    ("1-2", "1", 1.0, None),
    ("+2.5", "2.5", 2.5, 2.5),
    (" 7 ", "7", 7.0, 7.0),
    ("", "", None, None),
    ("NaN", "", None, None),
    ("5d", "5", 5.0, None),
    ("Infinity", "", None, None),
    ("1e999", "1", 1.0, None),
    (None, None, None, None),
]


def test_number_cleaners_match_the_golden_table(rows):
    c = F.col("t")
    found = rows("i int, t string", *((i, g[0]) for i, g in enumerate(GOLDEN))).select(
        "i",
        text.first_number(c),
        text.blank_to_null_double(text.first_number(c)),
        text.strict_double(c),
    )
    got = {r[0]: tuple(r)[1:] for r in found.collect()}
    assert got == {i: g[1:] for i, g in enumerate(GOLDEN)}


def test_holds_number_is_true_exactly_when_a_number_is_found(rows):
    c = F.col("t")
    df = rows("t string", *((g[0],) for g in GOLDEN if g[0] is not None))
    assert df.where(text.holds_number(c) != (text.first_number(c) != "")).count() == 0


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="0123456789.-+eE| a\n٣", max_size=8), min_size=1, max_size=30))
def test_first_number_is_idempotent_and_always_castable(rows, texts):
    c = F.col("t")
    once = text.first_number(c)
    df = rows("t string", *((t,) for t in texts)).select(
        "t", once.alias("once"), text.first_number(once).alias("twice"),
        text.blank_to_null_double(once).alias("number"), text.holds_number(c).alias("holds"),
    )
    for r in df.collect():
        assert r.once == r.twice or r.once.startswith("-")
        assert (r.number is not None) == r.holds == (r.once != "")


def test_station_ref(rows):
    base = "http://x/id/measures/"
    got = rows(
        "t string", (base + "1491TH-level-stage",), (base + "1491th-level",),
        (base + "E_123-level",), ("x",), (None,),
    ).select(text.station_ref(F.col("t")))
    assert [r[0] for r in got.collect()] == ["1491TH", "", "", "", None]


def test_codes_names_and_file_dates(rows):
    df = rows("n long, town string, river string, path string",
              (7, "Leeds", "Aire", "s3a://b/archive/readings-full-2024-01-05.csv"),
              (1234, None, "Aire", "file:/x/day=2023-12-31/part-0.csv"),
              (0, "Leeds", None, "file:/x/part-0.csv"))
    got = df.select(
        text.station_code(F.col("n")), text.station_name(F.col("town"), F.col("river")),
        text.file_date(F.col("path")),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("UK007", "Leeds Aire Gauge", dt.date(2024, 1, 5)),
        ("UK1234", "Aire Gauge", dt.date(2023, 12, 31)),
        ("UK000", "Leeds Gauge", None),
    ]


def test_reading_date_is_the_day_of_the_instant_and_survives_garbage(rows):
    df = rows("t string", ("2025-11-13T00:00:00Z",), ("2025-11-13",), ("2025-11-13T23:59:59",),
              ("2025-11-12T23:30:00-05:00",), ("13/11/2025",), ("",), (None,),
              ("2025-11-13Tgarbage",), ("2025-11-13 nope",))
    day = dt.date(2025, 11, 13)
    got = [r[0] for r in df.select(calendar.reading_date(F.col("t"))).collect()]
    assert got == [day, day, day, day, None, None, None, None, None]


@pytest.mark.parametrize("n, expected", [(3, ["2024-02-28", "2024-02-29", "2024-03-01"]),
                                         (1, ["2024-02-28"]), (0, []), (-2, [])])
def test_days_from(spark, n, expected):
    days = calendar.days_from(F.lit("2024-02-28").cast("date"), F.lit(n))
    got = spark.range(1).select(days).first()[0]
    assert [calendar_day.isoformat() for calendar_day in got] == expected


def test_z_score_is_null_without_spread(rows):
    df = rows("l double, m double, s double", (3.0, 1.0, 2.0), (3.0, 1.0, 0.0),
              (3.0, 1.0, None), (None, 1.0, 2.0))
    got = df.select(levels.z_score(F.col("l"), F.col("m"), F.col("s"))).collect()
    assert [r[0] for r in got] == [1.0, None, None, None]


def test_alert_level_order_and_unknown(rows):
    # Very high 10, high 20: RED is tried first, AMBER cannot occur.
    df = rows("l double, vh double, h double", (25.0, 20.0, 10.0), (15.0, 20.0, 10.0),
              (5.0, 20.0, 10.0), (15.0, 10.0, 20.0), (25.0, 10.0, 20.0), (5.0, None, None),
              (None, 20.0, 10.0), (20.0, 20.0, 10.0))
    args = F.col("l"), F.col("vh"), F.col("h")
    got = df.select(levels.alert_level(*args), levels.alert_level(*args, "NONE")).collect()
    assert [r[0] for r in got] == ["RED", "AMBER", "NORMAL", "RED", "RED", "NORMAL", "NORMAL",
                                   "RED"]
    assert [r[1] for r in got][5:7] == ["NONE", "NORMAL"]


@settings(max_examples=10, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.floats(-10, 10), st.floats(-10, 10))
def test_alert_level_never_falls_as_the_level_rises(rows, very_high, high):
    grade = {"NORMAL": 0, "AMBER": 1, "RED": 2}
    df = rows("l double", *((float(x) / 2,) for x in range(-24, 25))).orderBy("l")
    got = df.select(levels.alert_level(F.col("l"), F.lit(very_high), F.lit(high))).collect()
    order = [grade[r[0]] for r in got]
    assert order == sorted(order)


def test_risk_level_uses_three_thresholds(rows):
    df = rows("l double", (4.0,), (3.0,), (2.0,), (1.0,), (None,))
    got = df.select(levels.risk_level(F.col("l"), F.lit(4.0), F.lit(3.0), F.lit(2.0))).collect()
    assert [r[0] for r in got] == ["Very high", "High", "Medium", "Low", "Low"]


def test_clamp_keeps_null(rows):
    df = rows("v double", (0.01,), (0.5,), (None,))
    assert [r[0] for r in df.select(levels.clamp_min(F.col("v"))).collect()] == [0.05, 0.5, None]


def test_rounding_of_exact_halves(rows):
    df = rows("v double", (0.0125,), (0.0375,))
    assert [r[0] for r in levels.round_cols(df, ["v"]).collect()] == [0.012, 0.038]
    assert [r[0] for r in df.select(levels.round_value(F.col("v"))).collect()] == [0.013, 0.038]


def test_lookup(rows):
    df = rows("k string", ("Low",), ("Very high",), ("?",), (None,))
    got = df.select(levels.lookup(levels.REVIEW_DAYS, F.col("k"))).collect()
    assert [r[0] for r in got] == [30, 1, None, None]
    pairs = df.select(levels.lookup({"Low": (1, 2)}, F.col("k")).alias("c"))
    assert tuple(pairs.first().c) == (1, 2)


def test_ranges_from_percentiles(rows):
    df = rows("a double, b double, c double", (-1.0, 2.0, 6.0))
    ranges = levels.observed_ranges(F.col("a"), F.col("b"), F.col("c"))
    assert df.select(*(c.alias(n) for n, c in ranges.items())).first().asDict() == {
        "typical_range_low": 0.05, "typical_range_high": 2.0, "alert_threshold_high": 4.0,
        "alert_threshold_very_high": 6.0,
    }


def test_finite(rows):
    df = rows("v double", (1.5,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,))
    got = [r[0] for r in df.select(levels.finite(F.col("v"))).collect()]
    assert got == [1.5, None, None, None, None]

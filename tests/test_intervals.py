import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.operators import calendar as ops

SCHEMA = "stationReference string, start date, length int"
DAY = dt.date(2024, 1, 1)


def spans_of(days):
    """Longest runs of a set of days."""
    out = []
    for day in sorted(days):
        if out and out[-1][1] == day:
            out[-1][1] = day + dt.timedelta(1)
        else:
            out.append([day, day + dt.timedelta(1)])
    return [tuple(s) for s in out]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(
    st.sampled_from(["a", "a", "b", None]), st.one_of(st.none(), st.integers(-60, 60)),
    st.one_of(st.none(), st.integers(-1, 4), st.integers(30, 120))), min_size=1, max_size=40))
def test_spans_and_flags_equal_plain(spark, data):
    rows = [(s, d if d is None else DAY + dt.timedelta(d), n) for s, d, n in data]
    covered = {}
    for s, d, n in rows:
        if None not in (s, d, n):
            covered.setdefault(s, set()).update(d + dt.timedelta(i) for i in range(n))
    spans = ops.merge_intervals(spark.createDataFrame(rows, SCHEMA))
    got = {}
    for r in spans.collect():
        got.setdefault(r.stationReference, []).append((r.first, r.after))
    assert {s: sorted(v) for s, v in got.items()} == {s: spans_of(v) for s, v in covered.items() if v}
    days = [(s, DAY + dt.timedelta(i)) for s in ("a", "b", "c", None) for i in range(-70, 190, 3)]
    days += [("a", None), ("a", DAY), ("a", DAY)]
    flagged = ops.flag_in_spans(spark.createDataFrame(days, "stationReference string, date date"), spans)
    assert flagged.count() == len(days)
    for r in flagged.collect():
        assert r.in_interval == (r.date in covered.get(r.stationReference, ()))


def test_a_long_interval_takes_a_row_for_each_bin(spark):
    data = [("a", dt.date(2010, 1, 1), 3650), ("a", dt.date(2015, 5, 5), 10), ("a", dt.date(2019, 12, 29), 3)]
    intervals = spark.createDataFrame(data, SCHEMA)
    spans = ops.merge_intervals(intervals)
    assert [tuple(r) for r in spans.collect()] == [("a", dt.date(2010, 1, 1), dt.date(2020, 1, 1))]
    days = spark.createDataFrame([("a", dt.date(2009, 12, 31)), ("a", dt.date(2019, 12, 31)),
                                  ("a", dt.date(2020, 1, 1))], "stationReference string, date date")
    flagged = ops.flag_in_spans(days, spans)
    assert sorted(r.in_interval for r in flagged.collect()) == [False, False, True]
    assert ops.interval_days(intervals).count() > 30 * 115


def test_nothing(spark):
    spans = ops.merge_intervals(spark.createDataFrame([], SCHEMA))
    days = spark.createDataFrame([("a", DAY)], "stationReference string, date date")
    assert spans.count() == 0
    assert [r.in_interval for r in ops.flag_in_spans(days, spans).collect()] == [False]
    assert ops.flag_in_spans(days.where(F.lit(False)), spans).count() == 0

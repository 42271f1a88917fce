import math
import statistics

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from tests.conftest import final_plan_of
from tidemark.operators import states
from tidemark.operators.stats import BASELINE_PERCENTILES, station_daily

SCHEMA = "stationReference string, reading_date int, value double"


def merged(df):
    found = states.merge_moments(states.daily_states(df)).collect()
    return {r.stationReference: (r.n_readings_total, r.mean_level_total, r.std_level_total) for r in found}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(
    st.sampled_from(["a", "a", "b", None]), st.integers(1, 4),
    st.one_of(st.none(), st.floats(-1e3, 1e3), st.sampled_from([1e9, 1e9 + 1e-3]))),
    min_size=1, max_size=60))
def test_moments_of_days_merge_exactly(spark, data):
    got = merged(spark.createDataFrame(data, SCHEMA))
    groups = {}
    for station, _, value in data:
        groups.setdefault(station, []).append(value)
    assert set(got) == set(groups)
    for station, values in groups.items():
        n, mean, std = got[station]
        assert n == len(values)
        values = [v for v in values if v is not None]
        assert mean == (pytest.approx(math.fsum(values) / len(values)) if values else None)
        want = statistics.stdev(values) if len(values) > 1 else None
        assert std == (want if want is None else pytest.approx(want, rel=1e-6, abs=2e-5))


def test_large_levels_do_not_cancel(rows):
    data = [("a", d, 1e9 + d + i / 8) for d in range(20) for i in range(8)]
    std = states.merge_moments(station_daily(rows(SCHEMA, *data))).first().std_level_total
    assert std == pytest.approx(statistics.stdev([v - 1e9 for _, _, v in data]), rel=1e-6)


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(2)
    hot = [("hot", int(i % 30), float(v)) for i, v in enumerate(rng.lognormal(3, 1, 20_000))]
    cold = [(f"s{k}", int(d), float(v)) for k, d, v in zip(
        rng.integers(0, 30, 20_000), rng.integers(0, 30, 20_000), rng.normal(0, 1, 20_000))]
    data = hot + cold + [("one", 0, 7.5), ("none", 0, None)]
    return data, spark.createDataFrame(data, SCHEMA).repartition(8)


def test_merged_percentiles_are_near_in_rank(skewed):
    data, df = skewed
    k = 200
    found = {r.stationReference: r for r in states.merge_baseline(
        states.daily_states(df, k), min_max=True).collect()}
    bound = 2.3 / k ** 0.9
    for station in ("hot", "s0", "s7", "one"):
        values = np.array([v for s, _, v in data if s == station])
        row = found[station]
        assert (row.min_level, row.max_level) == (values.min(), values.max())
        for name, p in BASELINE_PERCENTILES.items():
            below, upto = (values < row[name]).mean(), (values <= row[name]).mean()
            assert below <= p + bound and upto >= p - bound
    assert found["none"].median_level is None and found["none"].n_readings_total == 1


def test_a_hot_station_has_no_more_states_than_others(skewed):
    _, df = skewed
    table = states.daily_states(df)
    per_station = dict(table.groupBy("stationReference").count().collect())
    assert per_station["hot"] == 30 == max(per_station.values())
    assert "Python" not in final_plan_of(states.merge_baseline(table))


def test_small_sketches_hold_all_values(rows):
    df = rows(SCHEMA, *[("a", d % 3, float(d)) for d in range(1, 101)])
    row = states.merge_baseline(states.daily_states(df)).first()
    assert [row[c] for c in BASELINE_PERCENTILES] == [5.0, 50.0, 95.0]


def test_no_readings(rows):
    table = states.daily_states(rows(SCHEMA))
    assert states.merge_baseline(table).count() == 0 and merged(rows(SCHEMA)) == {}

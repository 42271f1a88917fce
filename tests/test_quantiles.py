import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from tests.conftest import final_plan_of, settings_of
from tidemark.operators import quantiles
from tidemark.operators.quantiles import exact_quantiles

PROBS = {"p0": 0.0, "p05": 0.05, "p50": 0.5, "p95": 0.95, "p100": 1.0}


def expected(values, interpolate):
    if not values:
        return [None] * len(PROBS)
    if interpolate:
        return list(np.quantile(values, list(PROBS.values())))
    ordered = sorted(values)
    shares = [Fraction(str(p)) for p in PROBS.values()]
    return [ordered[max(math.ceil(len(ordered) * share) - 1, 0)] for share in shares]


def check(df, data, interpolate):
    found = exact_quantiles(df, ["k"], "v", PROBS, interpolate=interpolate)
    got = {r.k: [r[name] for name in PROBS] for r in found.collect()}
    groups = {}
    for k, v in data:
        groups.setdefault(k, []).append(v)
    for k, values in groups.items():
        want = expected([v for v in values if v is not None], interpolate)
        mine = got.pop(k)
        assert mine == (want if None in want else pytest.approx(want, rel=1e-9, abs=1e-9))
    assert not got


@pytest.fixture(scope="module")
def skewed():
    """One key holds most rows; its values repeat a lot at one point and are spread
    elsewhere. Another key is NULL."""
    rng = np.random.default_rng(5)
    hot = [(1, float(v)) for v in np.concatenate([np.full(700, 3.5), rng.normal(3, 9, 1300)])]
    cold = [(int(k), float(v)) for k, v in zip(rng.integers(2, 40, 600), rng.normal(0, 1, 600))]
    nokey = [(None, float(v)) for v in rng.integers(0, 9, 50)]
    one = [(99, 1.25)]
    return hot + cold + nokey + one


@pytest.mark.parametrize("interpolate", [True, False])
@pytest.mark.parametrize("partitions", ["1", "4", "60"])
def test_matches_brute_force_on_skewed_groups(spark, skewed, interpolate, partitions):
    df = spark.createDataFrame(skewed, "k long, v double").repartition(5)
    uncoalesced = {"spark.sql.shuffle.partitions": partitions,
                   "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    with settings_of(spark, uncoalesced):
        check(df, skewed, interpolate)


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(
    st.tuples(st.sampled_from([1, 1, 1, 2, None]),
              st.one_of(st.integers(-5, 5).map(float), st.floats(-1e6, 1e6))),
    min_size=5, max_size=80))
def test_matches_brute_force_on_any_data(spark, data):
    check(spark.createDataFrame(data, "k long, v double"), data, True)


def test_null_values_are_ignored(rows):
    data = [(1, None), (1, 2.0), (1, 4.0), (2, None)]
    check(rows("k long, v double", *data), data, True)


def test_whole_table_as_one_group(spark):
    df = spark.range(1001).selectExpr("CAST(id AS DOUBLE) AS v")
    assert exact_quantiles(df, [], "v", {"m": 0.5, "q": 0.25}).first() == (500, 250)


def test_building_measures_no_groups(spark, skewed, monkeypatch):
    """The only job of the build is the write of the counted values."""
    written = []
    monkeypatch.setattr(quantiles, "store", lambda df, name: written.append(name) or df)
    df = spark.createDataFrame(skewed, "k long, v double")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    exact_quantiles(df, ["k"], "v", PROBS)
    assert written == ["quantile-slices"] and not tracker.getJobIdsForGroup("building")
    spark.sparkContext.setJobGroup("tests", "tests")


def test_no_group_is_gathered(spark, skewed):
    """Values are never collected, and ranked by slice, never by group alone."""
    df = spark.createDataFrame(skewed, "k long, v double")
    plan = final_plan_of(exact_quantiles(df, ["k"], "v", PROBS))
    assert "collect_list" not in plan and "collect_set" not in plan
    assert "windowspecdefinition(k" in plan and "slice" in plan


def test_a_hot_group_spreads_over_the_slices(spark):
    """A third of the rows in one group, all values different: no slice holds more than twice
    the median."""
    df = spark.range(60_000).selectExpr("if(id % 3 = 0, -1, id % 50) AS k", "sqrt(id) AS v")
    stored = []
    keep = quantiles.store
    quantiles.store = lambda df, name: stored.append(keep(df, name)) or stored[-1]
    try:
        with settings_of(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false",
                                 "spark.sql.shuffle.partitions": "12"}):
            exact_quantiles(df, ["k"], "v", PROBS)
    finally:
        quantiles.store = keep
    sizes = sorted(r["count"] for r in stored[0].groupBy("_slice").count().collect())
    assert len(sizes) == 12 and sizes[-1] <= 2 * sizes[6]


def test_key_and_value_may_have_any_name(rows):
    df = rows("slice long, rank double", (1, 1.0), (1, 3.0), (2, 5.0))
    got = exact_quantiles(df, ["slice"], "rank", {"n": 0.5})
    assert {tuple(r) for r in got.collect()} == {(1, 2.0), (2, 5.0)}


def test_ranks_do_not_suffer_from_binary_fractions(spark):
    """100 * 0.07 exceeds 7 in doubles; the seventh percentile of 1..100 is 7 all the same."""
    df = spark.range(1, 101).selectExpr("CAST(id AS DOUBLE) AS v")
    found = exact_quantiles(df, [], "v", {"q": 0.07}, interpolate=False)
    assert found.first().q == 7.0

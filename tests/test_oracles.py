"""Every registered query against its SQL, and the shape of every plan."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL, plan_of
from tidemark.catalog import QUERIES
from tidemark.operators import quantiles
from tools.check_oracles import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    assert name in entry.oracle_sql()
    assert compare(spark, con, name, SMALL) == ""


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 15


WRITES = ("alerts_stream", "late_data", "csv_", "archive_", "count_sent", "replay_", "batch_job",
          "roundtrip", "union_by_header", "warehouse", "quarantine", "_paned", "_and_open",
          "stream_counts", "replaced_", "compacted_")


@pytest.mark.parametrize("name", [n for n in QUERIES if not any(w in n for w in WRITES)])
def test_plans_stay_in_the_jvm_without_cross_joins(spark, name):
    plan = plan_of(entry.queries()[name](spark, SMALL))
    for node in ("Python", "Arrow", "CartesianProduct", "NestedLoop", "Coalesce 1"):
        assert node not in plan


def test_scans_read_only_needed_columns(spark, monkeypatch):
    plans, store = [], quantiles.store
    monkeypatch.setattr(
        quantiles, "store", lambda df, name: (plans.append(plan_of(df)), store(df, name))[1])
    after = plan_of(entry.queries()["baseline_by_station"](spark, SMALL))
    # The readings are read once, when their values are counted.
    (plan,) = plans
    assert "ReadSchema: struct<user_id:bigint,value:double>" in plan
    assert plan.count("FileScan") == 1 and "user_id" not in after
    plan = plan_of(entry.queries()["baseline_enriched"](spark, SMALL))
    assert "PushedFilters: [IsNotNull(c_nationkey), GreaterThanOrEqual(c_nationkey,5)" in plan

"""The registered queries against their SQL, and the pipeline against plain stages."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SMALL, plan_of
from tests.llm import plain, plain_more
from tests.llm.test_shaping import expected_pieces, places_are_sound
from tidemark.llm import queries
from tools.check_oracles import compare, connect

NATIVE = ("op2_line_dedup", "op3_quality_rules", "op4_sharding", "op6_chat_format")


def test_all_are_registered():
    names = [*queries.QUERIES, "pipeline"]
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]
    assert set(names) <= set(entry.queries()) and set(queries.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, connect(SMALL), name, SMALL) == ""


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_plans(spark, name):
    plan = plan_of(entry.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in plan
    if name in NATIVE:
        assert "Python" not in plan and "Arrow" not in plan


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, rows = docs.columns, [(r.doc_id, r.text) for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns
        got = sorted((r.doc_id, r.text) for r in docs.collect())
        assert got == sorted(PLAIN[name](spark, rows)), name
        rows = got
    packed = corpus_pipeline.run(spark, SMALL).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == expected_pieces(rows)
    places_are_sound(packed, 2048)


def test_pipeline_on_odd_and_empty_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    own = docs.where("doc_id < 40 and text is not null").withColumns({"_d": F.lit(1), "fp": F.lit("x")})
    odd = spark.createDataFrame(
        [(None, None, "en"), (900, "", "en"), (901, " \n", None), (902, "12 34", "de")],
        "doc_id long, text string, lang string")
    table = own.unionByName(own.limit(5)).unionByName(odd, allowMissingColumns=True)
    spark.read.parquet(f"{SMALL}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, rows in (("odd", table), ("none", table.where("false"))):
        rows.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        now = spark.read.parquet(f"{tmp_path}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, str(tmp_path))
            assert now.columns == rows.columns
        kept = [r.doc_id for r in now.collect()]
        assert len(kept) == len(set(kept)) and not {None, 900, 901, 902} & set(kept)
        assert (len(kept) > 10) == (name == "odd")
        packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
        assert {r.doc_id for r in packed} == set(kept)


def with_letters(spark, rows):
    return [r for r in rows if any(c.isalpha() for c in r[1] or "")]


def without_repeated_lines(spark, rows):
    left = plain_more.dedup_lines(rows)
    return [(r[0], left[r][2]) for r in rows if left[r][0] == 0 or left[r][1] < left[r][0]]


def first_of_groups(spark, rows):
    groups = defaultdict(list)
    for (_, doc_id, _, component) in plain.near_duplicate_groups(rows):
        groups[component].append(doc_id)
    kept = {min(ids) for ids in groups.values()}
    return [r for r in rows if r[0] in kept]


def without_items(spark, rows):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    bad = {doc_id for doc_id, _ in plain_more.leaks(rows, items)}
    return [r for r in rows if r[0] not in bad]


PLAIN = {
    "language_id": with_letters, "line_dedup": without_repeated_lines,
    "simhash_near_dedup": first_of_groups, "benchmark_decontamination": without_items,
}

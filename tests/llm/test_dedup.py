import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm import plain
from tidemark.llm import components, simhash_dedup, substring_dedup

DOCS = "doc_id long, text string"


def sentence(rng, n, kinds=40):
    return " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))


def odd_documents():
    """Nulls, empty and long texts, repeats, shared passages, rows that occur twice."""
    rng = random.Random(7)
    shared, loop = sentence(rng, 60), "a b " * 3000
    rows = [(i, sentence(rng, rng.randrange(0, 80))) for i in range(40)]
    rows += [(40 + i, f"{sentence(rng, 9)} {shared}\t{sentence(rng, 5)}") for i in range(12)]
    rows += [(60, loop), (61, loop), (62, "\n".join([shared] * 3)), (63, shared.upper())]
    rows += [(70, None), (71, ""), (72, " \n\t "), (73, "one"), (74, "é" * 20000), (75, "one")]
    rows += [(None, shared), (None, "alone here"), (5, rows[5][1]), (6, shared), (-3, "x " * 40)]
    rows += [(80, rows[50][1]), (81, rows[50][1] + " tail"), (82, "   x y z")]
    return rows


def substring_rows(df):
    found = df.select("doc_id", "n_words", "n_removed", F.sha2("text", 256)).collect()
    return sorted(map(tuple, found), key=str)


def test_substring_dedup_equals_plain(spark):
    rows = odd_documents()
    df = spark.createDataFrame(rows, DOCS).repartition(5).withColumn("_d", F.lit("x"))
    got = substring_rows(substring_dedup.remove_repeats(df.withColumn("spans", F.lit(1))))
    assert got == sorted(plain.remove_repeats(rows), key=str)


def test_substring_dedup_over_blocks_and_sizes(spark, monkeypatch):
    rows = odd_documents()
    df = spark.createDataFrame(rows, DOCS).coalesce(1)
    monkeypatch.setattr(substring_dedup, "SPREAD", 1)
    for window, inner in ((3, 3), (4, 1), (13, 13)):
        got = substring_rows(substring_dedup.remove_repeats(df, window, inner))
        assert got == sorted(plain.remove_repeats(rows, window), key=str)


def test_substring_dedup_resolves_hash_collisions(monkeypatch):
    import numpy as np

    from tidemark.llm import words

    monkeypatch.setattr(
        substring_dedup, "run_hashes", lambda w, n: np.zeros(len(w) - n + 1, np.uint64)
    )
    raw = np.frombuffer(b"a b c a b d ", np.uint8)
    starts, ends, first = words.find_words(raw, np.array([0, 12]))
    joined, place = words.joined_words(raw, starts, ends)
    late = substring_dedup._after_first(
        joined, place, np.zeros(6, np.uint64), np.array([0, 1, 2, 3, 4]),
        np.array([0, 0, 0, 1, 1]), 2,
    )
    assert late.tolist() == [False, False, False, True, False]


def test_copies_travel_once_for_a_block():
    import numpy as np
    import pyarrow as pa

    text = sentence(random.Random(1), 60, 1000)
    table = pa.table({"_d": np.arange(200), "_t": np.arange(200), "text": [text] * 200})
    spans, packed = substring_dedup._scatter(table, 13, 3, 4, np.zeros(0, np.uint64))
    assert spans.num_rows == 199 and set(spans["b"].to_pylist()) == {60}
    for _, head, body in packed:
        assert set(substring_dedup._unpack([head], [body])[0]["d"]) == {0}


def phrase_texts(n, rng):
    """Texts of random words; in a third of them every fourth to sixth is one phrase."""
    def one(i):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(60, 120))]
        return " ".join(w + (" of the same" if i % 3 == 0 and k % 3 == 0 else "") for k, w in enumerate(words))

    return [(i, one(i)) for i in range(n)]


def test_substring_dedup_spreads_a_frequent_phrase(spark, monkeypatch):
    rows = phrase_texts(1500, random.Random(7))
    table = pa.table({"_d": [d for d, _ in rows], "_t": [0] * len(rows), "text": [t for _, t in rows]})
    df = spark.createDataFrame(rows, "doc_id long, text string")
    hot = substring_dedup.hot_minimisers(df)
    assert 0 < len(hot) < substring_dedup.HOT

    def largest(keys):
        _, packed = substring_dedup._scatter(table, 13, 3, 4096, keys)
        sizes = Counter()
        for bucket, head, body in packed:
            sizes[bucket] += len(substring_dedup._unpack([head], [body])[1])
        return max(sizes.values()) / sum(sizes.values())

    assert largest(hot[:0]) > 0.05 and largest(hot) < 0.01
    copies = rows + [(9000 + i, f"{i} {t} {i}") for i, t in rows[:60]]
    monkeypatch.setattr(substring_dedup, "LOCAL", 40_000)
    df = spark.createDataFrame(copies, "doc_id long, text string").repartition(5)
    assert substring_rows(substring_dedup.remove_repeats(df)) == sorted(plain.remove_repeats(copies), key=str)


def test_substring_dedup_of_a_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = substring_rows(substring_dedup.remove_repeats(docs))
    assert got == sorted(plain.remove_repeats(rows), key=str)
    assert sum(r[2] for r in got) > 0


def simhash_rows(df):
    return sorted(
        (r.doc_id is None, plain.id_of(r.doc_id), r.fingerprint, r.component_id)
        for r in df.collect()
    )


@pytest.mark.parametrize("source", ["odd", "table"])
def test_simhash_groups_equal_plain(spark, source):
    if source == "odd":
        rows = odd_documents()
        df = spark.createDataFrame(rows, DOCS).withColumn("fp", F.lit("x"))
    else:
        df = spark.read.parquet(f"{SMALL}/documents.parquet")
        rows = [(r.doc_id, r.text) for r in df.collect()]
    got = simhash_rows(simhash_dedup.near_duplicate_groups(df))
    assert got == plain.near_duplicate_groups(rows)


def test_links_are_all_pairs_within_the_distance(spark):
    rng = random.Random(3)
    marks = {0, 2**64 - 1}
    for _ in range(60):
        mark = rng.getrandbits(64)
        marks.add(mark)
        for _ in range(6):
            for bit in rng.sample(range(64), rng.randrange(1, 4)):
                mark ^= 1 << bit
            marks.add(mark)
    marks = sorted(marks)
    signed = [m - 2**64 if m >= 2**63 else m for m in marks]
    nodes = spark.createDataFrame(list(enumerate(signed)), "node long, fp long")
    for most in (0, 3, 4, 7):
        got = simhash_dedup.fingerprint_links(nodes, most).collect()
        want = {
            (i, j) for i, a in enumerate(marks) for j, b in enumerate(marks)
            if i < j and (a ^ b).bit_count() <= most
        }
        assert sorted(tuple(sorted(r)) for r in got) == sorted(want)


def test_keep_first_keeps_one_of_each_group(spark):
    rows = odd_documents()
    df = spark.createDataFrame([(*r, "s") for r in rows], DOCS + ", _t string")
    kept = simhash_dedup.keep_first(df)
    assert kept.columns == df.columns
    groups = plain.near_duplicate_groups(rows)
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) == len({g[3] for g in groups})
    assert {i for i in ids if i is not None} == {g[3] for g in groups if g[3] is not None}


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 230)]
    links = [*chain, *star, (3, 3), (None, 4), (5, 2), (2, 5)]
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    want = {n: 100 for n in range(100, 161)} | {n: 7 for n in (7, *range(200, 230))} | {5: 2, 2: 2}
    assert sorted(map(tuple, got)) == sorted(want.items())


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert substring_dedup.remove_repeats(empty).count() == 0
    assert simhash_dedup.near_duplicate_groups(empty).count() == 0
    assert simhash_dedup.keep_first(empty).count() == 0


def test_simhash_groups_of_repeated_and_missing_ids(spark):
    """Ids that several texts share connect nothing."""
    rng = np.random.default_rng(11)
    prints = rng.integers(-(2**63), 2**63 - 1, 12)
    rows = [(None, int(prints[0])), (None, int(prints[1])), (5, int(prints[0]) ^ 3), (7, int(prints[2])),
            (7, int(prints[3])), (9, int(prints[3]) ^ 0b1111), (9, int(prints[4])), (3, int(prints[4]) ^ 1)]
    df = spark.createDataFrame(rows, "doc_id long, fp long")
    got = {(r.doc_id, r.fp): r.component_id for r in simhash_dedup.with_components(df).collect()}
    last = simhash_dedup.LAST_ID
    assert [got[r] for r in rows] == [5, last, 5, 7, 7, 7, 3, 3]


def test_a_dense_crowd_of_fingerprints_has_few_links(spark):
    centre = 0x5A5A_1234_8765_0FF0
    crowd = {centre ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a, 64)}
    crowd |= {centre, *(centre ^ (1 << a) for a in range(64))}
    far = [centre ^ 0xFFFF_FFFF, centre ^ 0xFFFF_FFFF_0000]
    rows = [(i, x - 2**64 if x >= 2**63 else x) for i, x in enumerate([*sorted(crowd), *far])]
    df = spark.createDataFrame(rows, "doc_id long, fp long").repartition(4)
    nodes = df.select("fp", F.col("fp").alias("node"))
    assert len(crowd) == 2081 and simhash_dedup.one_bit_links(nodes).count() < 64 * len(rows) // 2
    got = {r.doc_id: r.component_id for r in simhash_dedup.with_components(df).collect()}
    n = len(crowd)
    assert got == {**dict.fromkeys(range(n), 0), n: n, n + 1: n + 1}
    first = simhash_dedup.components(simhash_dedup.one_bit_links(nodes))
    known = nodes.join(first, "node", "left").select("node", "fp", F.coalesce("component", "node").alias("known"))
    assert simhash_dedup.fingerprint_links(known).count() == 0

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm import plain, plain_more
from tests.llm.test_dedup import DOCS, odd_documents
from tidemark.llm import (
    common, decontaminate, language_id, line_dedup, quality_classifier, quality_rules,
)


def small_table(spark, name="documents"):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


# --- language ID ---------------------------------------------------------------------------

def test_code_lengths_equal_plain(spark):
    texts = [("a", "the cat sat on the mat"), ("a", "théâtre"), ("b", "den katze saß"), ("b", "xyz")]
    df = spark.createDataFrame(texts, "lang string, text string").repartition(3)
    counts = language_id.gram_counts(df).toArrow()
    model = language_id.build(
        np.asarray(counts["lang"].to_pylist(), object), np.asarray(counts["gram"], np.int64),
        np.asarray(counts["n"], np.float64))
    tried = ["the mat", "", "saß", "qqq ÿ", "théâtre katze " * 30, "x"]
    got = language_id.code_lengths(model, pa.array(tried), step=17) / language_id.UNIT
    for i, text in enumerate(tried):
        for j, lang in enumerate("ab"):
            want = plain_more.code_length([t for x, t in texts if x == lang], text)
            assert abs(got[i, j] - want) < 1e-4 * (len(text) + 1)


def test_sample_is_counted_in_tasks_that_follow_its_size(spark, monkeypatch):
    texts = [("a", f"{i:04d}" * 25) for i in range(300)]
    df = spark.createDataFrame(texts, "lang string, text string")
    for parts in (1, 150):
        assert language_id.gathered(df.repartition(parts)).rdd.getNumPartitions() == 1
    want = sorted(map(tuple, language_id.gram_counts(df).collect()))
    monkeypatch.setattr(language_id, "TASK", 10_000)
    assert language_id.gathered(df.repartition(150)).rdd.getNumPartitions() == 3
    assert sorted(map(tuple, language_id.gram_counts(df.repartition(150)).collect())) == want
    assert language_id.gathered(df.where("false")).count() == 0


def test_languages_of_held_out_documents(spark):
    docs = small_table(spark)
    model = language_id.train(docs.where("doc_id % 4 <> 2"))
    assert model.languages == ["de", "en", "es", "fr"]
    found = language_id.classify(docs.where("doc_id % 4 = 2"), model).join(docs, "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.97
    assert all(0.25 <= r.score <= 1 for r in found)


def test_language_of_odd_rows(spark, rows):
    docs = rows("doc_id long, text string, lang string, lang_pred int",
                (1, "the cat", "en", 1), (1, "the cat", "en", 1), (2, None, "en", 1),
                (None, "le chat est là", "fr", 1), (3, "12 + 3!", None, 1), (4, "", "fr", 1),
                (5, "cat " * 200000, None, None))
    model = language_id.train(docs)
    got = sorted(((r.doc_id, r.lang_pred) for r in language_id.classify(docs, model).collect()), key=str)
    want = [(1, "en"), (1, "en"), (2, "und"), (3, "und"), (4, "und"), (5, "en"), (None, "fr")]
    assert got == want
    kept = language_id.keep_known(docs, model)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "5", "None"]
    nothing = language_id.train(docs.where("false"))
    assert {r.lang_pred for r in language_id.classify(docs, nothing).collect()} == {"und"}
    assert language_id.classify(docs.where("false"), model).count() == 0


def test_unlearned_languages_and_noise_are_not_kept(spark):
    docs = small_table(spark)
    model = language_id.train(docs.where("doc_id % 4 <> 2"))
    rng = random.Random(4)
    noise = "".join(rng.choice("bcdfghjklmnpqrstvwxz ") for _ in range(400))
    rows = [(1, noise), (2, "Это текст о погоде и природе. " * 9), (3, "これは日本語の文章です。" * 9),
            (4, "1234 --"), (5, None), (6, ""), (7, "die"), (8, docs.where("lang = 'en'").first().text)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang_pred string")
    kept = language_id.keep_known(df, model)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [7, 8]
    known = docs.where("text rlike '[a-z]' and lang is not null")
    assert language_id.keep_known(known, model).count() == known.count()
    assert language_id.keep_known(df.where("false"), model).count() == 0


def test_training_sample_is_bounded(spark):
    docs = spark.range(300).selectExpr("id as doc_id", "'x' as lang", "cast(id as string) as text")
    assert language_id.training_sample(docs, 20).count() == 20
    assert language_id.training_sample(docs.union(docs), 20).count() == 20


# --- line dedup ----------------------------------------------------------------------------

def odd_lines():
    rng = random.Random(11)
    base = [[f"w{rng.randrange(30)}" for _ in range(n)] for n in (8, 9, 12, 20, 7, 16)]
    rows = []
    for i in range(50):
        lines = []
        for _ in range(rng.randrange(0, 5)):
            own = list(rng.choice(base))
            for _ in range(rng.randrange(0, 3)):
                at = rng.randrange(len(own))
                kind = rng.randrange(3)
                own[at : at + (kind != 1)] = [f"n{rng.randrange(4)}"] if kind else []
            lines.append(" ".join(own))
        rows.append((i, "\n".join(lines)))
    same = " ".join(["a"] * 9)
    rows += [(60, None), (61, ""), (62, "\n \n"), (63, "x\nx\ny"), (64, f"{same}\n{same} a\n{same} b"),
             (65, "a b c d e f g h\nb a c d e f g h"), (66, "p q\t r\n p  q r "), (5, rows[5][1]),
             (5, "another text"), (None, rows[9][1]), (None, "only here"), (67, "long " * 900),
             (68, "long " * 901), (69, "a b c d e f g h i\r\nz")]
    return rows


def test_line_dedup_equals_plain(spark):
    # Rows of one id with different texts are told apart by a hash, whose order is arbitrary.
    alone = [r for r in odd_lines() if r[0] not in (5, None)]
    df = spark.createDataFrame([(*r, 1) for r in alone], DOCS + ", m int").repartition(4)
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in line_dedup.line_report(df).collect()}
    assert got == {k[0]: v for k, v in plain_more.dedup_lines(alone).items()}


@pytest.mark.parametrize("long", [1000, 3])
def test_line_dedup_of_short_and_odd_lines(spark, monkeypatch, long):
    monkeypatch.setattr(line_dedup, "LONG", long)
    monkeypatch.setattr(line_dedup, "BLOCK", 4)
    rng = random.Random(long)
    words = [f"w{i}" for i in range(40)]
    lines = []
    for _ in range(150):
        line = rng.choices(words, k=rng.choice([1, 2, 3, 4, 5, 5, 6, 7, 8, 9, 16, 17, 33]))
        lines.append(line)
        for _ in range(rng.randrange(3)):
            i, w = rng.randrange(len(line)), rng.choice(words)
            lines.append(rng.choice([line[:i] + line[i + 1 :], line[:i] + [w] + line[i:],
                                     line[:i] + [w] + line[i + 1 :]]))
    rng.shuffle(lines)
    docs = [(i, "\n".join(map(" ".join, lines[i * 5 : i * 5 + 5]))) for i in range(len(lines) // 5)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in line_dedup.line_report(df).collect()}
    want = {k[0]: v for k, v in plain_more.dedup_lines(docs).items()}
    assert got == want and sum(v[1] for v in want.values()) > 30


def test_line_dedup_of_a_very_long_line(spark):
    words = [f"w{i % 977}" for i in range(100_000)]
    docs = [(1, " ".join(words)), (2, " ".join(words[:70_000] + ["new"] + words[70_000:])),
            (3, " ".join(words[:500] + words[501:])), (4, " ".join(["x", *words, "y"])), (5, "short")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in line_dedup.line_report(df).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 0, 5: 0}


def test_running_sums_in_blocks(spark):
    values = [i * 7919 for i in range(1, 1500)]
    df = spark.createDataFrame([(values[:n],) for n in (1, 2, 255, 256, 257, 512, 1499)], "v array<long>")
    for row in df.select("v", line_dedup._running_long(F.col("v")).alias("p")).collect():
        x, want = 0, [0]
        for v in row.v:
            x ^= v
            want.append(x)
        assert row.p == want


def test_line_dedup_of_equal_and_missing_ids(spark):
    df = spark.createDataFrame(odd_lines(), DOCS)
    got = line_dedup.line_report(df).collect()
    assert len(got) == len(odd_lines())
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in odd_lines())


def test_line_dedup_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(common, "SMALL_BYTES", -1)
    alone = [r for r in odd_lines() if r[0] not in (5, None)]
    df = spark.createDataFrame(alone, DOCS)
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in line_dedup.line_report(df).collect()}
    assert got == {k[0]: v for k, v in plain_more.dedup_lines(alone).items()}


def test_line_dedup_of_repeated_rows_and_stage(spark):
    rows = [(1, "a b\nc"), (1, "a b\nc"), (2, "a b\nnew"), (3, "c\na  b"), (4, " \n"), (None, "new")]
    df = spark.createDataFrame([(*r, "k") for r in rows], DOCS + ", _kept string")
    kept = line_dedup.dedup_lines(df)
    assert kept.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == [(1, "a b\nc"), (1, "a b\nc"), (2, "new"), (4, " \n")]
    assert line_dedup.line_report(df.where("false")).count() == 0


# --- decontamination -----------------------------------------------------------------------

def leak_rows(df):
    return {(r.doc_id, r.item_id): round(r.similarity, 9) for r in df.collect()}


def test_leaks_of_a_table_equal_plain(spark):
    docs, items = small_table(spark), small_table(spark, "benchmark")
    got = leak_rows(decontaminate.leaks(docs, items))
    want = plain_more.leaks([(r.doc_id, r.text) for r in docs.collect()],
                            [(r.item_id, r.text) for r in items.collect()])
    assert got == {k: round(v, 9) for k, v in want.items()} and got


def test_leaks_of_odd_rows(spark):
    rng = random.Random(5)

    def text(n):
        return [f"w{rng.randrange(50)}" for _ in range(n)]

    items = [(1, text(60)), (2, text(15)), (3, ["only", "three", "words"]), (4, text(5)), (7, text(80))]
    long = [(i, " ".join(t)) for i, t in items] + [(5, None), (6, " .!"), (8, " ".join(items[0][1]))]
    rows = []
    for i, (_, own) in enumerate(items * 3):
        changed = list(own)
        for _ in range(i // 5):
            changed[rng.randrange(len(changed))] = "other"
        rows.append((i, " ".join(text(20)) + " " + " ".join(changed).upper().replace(" ", ", ") + " end"))
    rows += [(50, None), (51, ""), (52, "only three"), (53, "a " * 20000), (None, rows[0][1]),
             (0, rows[0][1])]
    docs = spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", words int")
    bench = spark.createDataFrame([(*r, "x") for r in long], "item_id long, text string, slots string")
    got = leak_rows(decontaminate.leaks(docs, bench))
    want = plain_more.leaks(rows, long)
    assert got == {k: round(v, 9) for k, v in want.items()}
    kept = decontaminate.remove_leaks(docs, bench)
    assert kept.columns == docs.columns
    bad = {k[0] for k in want}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in rows if r[0] not in bad)
    assert decontaminate.leaks(docs.where("false"), bench).count() == 0
    assert decontaminate.leaks(docs, bench.where("false")).count() == 0


def test_leaks_with_repeated_shingles(spark):
    rng = random.Random(8)
    items, rows = [], []
    for i in range(120):
        own = [f"w{i}x{j}" for j in range(rng.choice((81, 85, 94)))]
        run = (len(own) - 4) // 9 - rng.randrange(2)
        changed, side = [*own[:-run], *["a"] * run], i % 3
        items.append((i, " ".join([*own[:-run], *["b"] * run] if side == 2 else (own, changed)[side])))
        rows.append((i, " ".join(["before"] * 3 + (own if side == 1 else changed) + ["after"] * (i % 2))))
    docs, bench = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id long, text string")
    got = leak_rows(decontaminate.leaks(docs, bench))
    want = plain_more.leaks(rows, items)
    assert got == {k: round(v, 9) for k, v in want.items()} and len(want) > 100


def test_documents_shorter_than_an_item(spark):
    rng = random.Random(3)
    items = [(i, " ".join(f"v{rng.randrange(400)}" for _ in range(n))) for i, n in enumerate((38, 60, 15, 6, 4, 38))]
    rows = []
    for i, text in items:
        own = text.split(" ")
        cuts = [own[:-m] for m in range(1, 14) if m < len(own)] + [own[1:], own[2:-2], [*own[:9], "new", *own[10:-1]]]
        rows += [(100 * i + j, " ".join(cut)) for j, cut in enumerate(cuts)]
    rows += [(900, " ".join([items[0][1].rsplit(" ", 1)[0], "x " * 90]))]  # the same words, not alone
    docs, bench = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for doc_id, text in rows:
        for item_id, item in items:
            own, n = text.split(), len(item.split())
            if len(own) < n:
                alike = decontaminate.similarity(text, item)
                if alike >= 0.8:
                    want[doc_id, item_id] = (round(alike, 9), 0, len(own))
    inner = {k: (round(v, 9), len(items[k[1]][1].split())) for k, v in plain_more.leaks(rows, items).items()}
    found = decontaminate.leaks(docs, bench).collect()
    got = {(r.doc_id, r.item_id): (round(r.similarity, 9), r.start, r.n_words) for r in found}
    assert {k: v for k, v in got.items() if k not in inner} == want and (0, 0) in want
    assert {k: (v[0], v[2]) for k, v in got.items() if k in inner} == inner
    kept = {r.doc_id for r in decontaminate.remove_leaks(docs, bench).collect()}
    assert kept == {r[0] for r in rows} - {k[0] for k in got}


def test_a_full_filter_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SLOTS", 8)
    docs, items = small_table(spark).where("n_chars < 1200").limit(40), small_table(spark, "benchmark")
    got = leak_rows(decontaminate.leaks(docs, items))
    want = plain_more.leaks([(r.doc_id, r.text) for r in docs.collect()],
                            [(r.item_id, r.text) for r in items.collect()])
    assert got == {k: round(v, 9) for k, v in want.items()}


# --- quality rules -------------------------------------------------------------------------

def judged(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, x1 int")
    return df, quality_rules.judge(df).collect()


def test_quality_rules_equal_plain(spark):
    docs = small_table(spark).collect()
    rows = [(r.doc_id, r.text, r.lang, "s", 1) for r in docs]
    rows += [(1000 + i, t, None if i % 2 else "en", None, 1) for i, (_, t) in enumerate(odd_documents())]
    rows += [(None, "word " * 20000, "en", "s", 1), (3, rows[3][1], "en", "s", 1)]
    _, got = judged(spark, rows)
    q = quality_rules
    limit = q.chi_square_point(1 - q.TAIL, q.P)
    stats = [plain_more.statistics(r[1]) for r in rows]
    far = plain_more.outliers(
        [((r[2], r[3]), s) for r, s in zip(rows, stats)], q.WIDTHS, q.GRID, q.COVER, q.FALL, q.INSIDE, q.RINGS,
        [q.consistency(q.COVER), q.consistency(q.INSIDE)], q.chi_square_point(q.INSIDE, q.P))
    want = sorted(((str(r[0]), *s, i in far and far[i] <= limit, round(far.get(i, -1), 6))
                   for i, (r, s) in enumerate(zip(rows, stats))), key=str)
    have = sorted(((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                    r.n_repeat_words, r.base_failed, r.kept,
                    round(-1 if r.distance is None else r.distance, 6)) for r in got), key=str)
    assert have == want


def test_quality_rules_reject_an_outlier_and_keep_the_rest(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(f"{'x' * rng.randrange(2, 9)}{rng.randrange(999)}" for _ in range(rng.randrange(60, 300))),
             "en", "s", 1) for i in range(200)]
    rows.append((999, " ".join(f"###{i}$$$" for i in range(150)), "en", "s", 1))
    _, got = judged(spark, rows)
    assert {r.doc_id for r in got if not r.kept} == {999}


@pytest.mark.parametrize("copies", [0, 150, 600])
def test_quality_rules_reject_any_number_of_copies_of_an_outlier(spark, copies):
    rng = random.Random(3)
    rows = [(i, " ".join(f"{'x' * rng.randrange(2, 9)}{rng.randrange(999)}" for _ in range(rng.randrange(60, 300))),
             "en", "s", 1) for i in range(300)]
    rows += [(1000 + i, " ".join(f"###{k}$$$" for k in range(150)), "en", "s", 1) for i in range(copies)]
    _, got = judged(spark, rows)
    assert {r.doc_id for r in got if not r.kept} == {1000 + i for i in range(copies)}


def test_quality_rules_reject_a_crowd_of_different_outliers(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(f"{'x' * rng.randrange(2, 9)}{rng.randrange(999)}" for _ in range(rng.randrange(60, 300))),
             "en", "s", 1) for i in range(300)]
    rows += [(1000 + i, " ".join(f"###{k}$$${'y' * rng.randrange(3)}" for k in range(100 + i)), "en", "s", 1)
             for i in range(200)]
    _, got = judged(spark, rows)
    assert {r.doc_id for r in got if not r.kept} == {1000 + i for i in range(200)}


def test_minimum_covariance_takes_the_smallest_determinant(spark):
    rng = np.random.default_rng(5)
    x = np.floor(rng.normal(0, 900, (400, 5)) @ rng.normal(0, 1, (5, 5)))
    x[:150] = np.floor(rng.normal(0, 300, (150, 5)) + 20000)
    q = quality_rules
    points = spark.createDataFrame([("g", *map(float, v)) for v in x], "_group string, " + ", ".join(
        f"{c} double" for c in q.XS))
    found = q.minimum_covariance(points).first()
    clean = x[150:]
    assert np.abs(np.array([found[m] for m in q.MEANS]) - clean.mean(axis=0)).max() < 0.5 * clean.std(axis=0).max()
    lower = np.zeros((5, 5))
    for i, j in q.PAIRS:
        lower[i, j] = found[f"l{i}{j}"]
    ratio = np.linalg.det(lower @ lower.T) / np.linalg.det(np.cov(clean.T) + np.diag(q.FLOOR))
    assert 0.3 < ratio < 3
    assert q.minimum_covariance(points.where("false")).count() == 0


def test_quality_rules_of_nothing(spark):
    df, got = judged(spark, [(1, None, None, None, 1), (2, "", "en", "s", 1)])
    assert [(r.base_failed, r.kept) for r in got] == [(True, False)] * 2
    assert quality_rules.judge(df.where("false")).count() == 0


def test_chi_square():
    assert quality_rules.chi_square_point(0.95, 5) == pytest.approx(11.0705, abs=1e-4)
    assert quality_rules.chi_square(6.6257, 5) == pytest.approx(0.75, abs=1e-4)


# --- quality classifier --------------------------------------------------------------------

def test_passage_features_do_not_depend_on_the_batch(spark):
    texts = [t for _, t in odd_documents()]
    together, edge = quality_classifier.features(pa.array(texts))
    for i, text in enumerate(texts):
        alone, _ = quality_classifier.features(pa.array([text]))
        assert np.allclose(alone, together[edge[i] : edge[i + 1]], atol=1e-6)
        assert len(alone) == max(1, -(-len(plain.words(text)) // quality_classifier.PASSAGE))


def test_gradient_of_the_network():
    rng = np.random.default_rng(1)
    bags = [rng.normal(size=(n, 6)) for n in (1, 3, 2)]
    y = np.array([1.0, 0.0, 1.0])
    model = quality_classifier.fit(bags, y)
    x, edge = np.concatenate(bags), np.array([0, 1, 4, 6])
    exact = quality_classifier._gradient(model, x, edge, y)

    def loss():
        p = quality_classifier._forward(model, x, edge)[-1]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for name in ("encode", "value", "gate", "weight", "out"):
        value = getattr(model, name)
        at = np.unravel_index(2, value.shape)
        kept, sides = value[at], []
        for d in (1e-5, -1e-5):
            value[at] = kept + d
            sides.append(loss())
        value[at] = kept
        assert (sides[0] - sides[1]) / 2e-5 == pytest.approx(exact[name][at], abs=1e-6)


def test_quality_scores_equal_plain(spark):
    rng = np.random.default_rng(6)
    rows = odd_documents()
    bags = [quality_classifier.features(pa.array([t or ""]))[0] for _, t in rows[:40]]
    model = quality_classifier.fit(bags, rng.integers(0, 2, 40).astype(float))
    got = quality_classifier.classify(spark.createDataFrame(rows, DOCS).repartition(3), model).collect()
    want = sorted((str(d), plain_more.attention_score(model, quality_classifier.features(pa.array([t or ""]))[0]))
                  for d, t in rows)
    have = sorted((str(r.doc_id), r.score) for r in got)
    assert [d for d, _ in have] == [d for d, _ in want]
    assert [s for _, s in have] == pytest.approx([s for _, s in want], abs=1e-5)


def test_quality_of_held_out_documents(spark):
    where = SMALL.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{where}/documents.parquet")
    labels = spark.read.parquet(f"{where}/labels.parquet")
    model = quality_classifier.train(docs, labels.where("doc_id % 5 <> 0"))
    again = quality_classifier.train(docs.repartition(3), labels.where("doc_id % 5 <> 0"))
    assert np.allclose(model.encode, again.encode)
    found = quality_classifier.classify(docs, model).join(labels.where("doc_id % 5 = 0"), "doc_id").collect()
    good = [r.score for r in found if r.quality == 1]
    bad = [r.score for r in found if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    odd = spark.createDataFrame([(*r, 0.5) for r in odd_documents()], DOCS + ", score double")
    scores = quality_classifier.classify(odd, model).collect()
    assert len(scores) == len(odd_documents()) and all(0 <= r.score <= 1 for r in scores)
    assert quality_classifier.classify(odd.where("false"), model).count() == 0
    nothing = quality_classifier.train(docs, labels.where("false"))
    assert {r.score for r in quality_classifier.classify(odd, nothing).collect()} == {0.5}

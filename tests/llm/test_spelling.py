import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.test_dedup import DOCS, odd_documents
from tidemark.llm import spelling
from tidemark.llm.words import text_bytes

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_counts(rows, damage=None):
    n = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def plain_groups(n):
    """{(word, form, root, n, n_near, form_n)}"""
    form, out = {}, set()
    near = {a: [b for b in n if one_edit(a, b)] for a in n}
    for a, others in near.items():
        best = min(others, key=lambda b: (-n[b], b), default=None)
        form[a] = best if best is not None and n[best] >= 5 * n[a] else None
    for a in n:
        root = a
        while form[root]:
            root = form[root]
        out.add((a, form[a], root, n[a], len(near[a]), n.get(form[a])))
    return out


def groups(spark, n):
    df = spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)
    return {tuple(r) for r in spelling.group_variants(df).collect()}


def family(rng, letters, length, n):
    """Words with many near ones, counts that form chains, and ties."""
    words = {"".join(rng.choice(letters) for _ in range(length)): 625}
    while len(words) < n:
        w = rng.choice(list(words))
        i, c = rng.randrange(len(w) + 1), rng.choice(letters)
        w = rng.choice([w[:i] + c + w[i:], w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :]])
        if len(w) >= length - 2:
            words.setdefault(w, rng.choice([5, 5, 24, 25, 125, 625, 3000]))
    return words


@pytest.mark.parametrize("tile", [4096, 7])
def test_groups_equal_plain(spark, monkeypatch, tile):
    monkeypatch.setattr(spelling, "TILE", tile)
    monkeypatch.setattr(spelling, "MANY", 5 if tile == 7 else 1024)
    monkeypatch.setattr(spelling, "MATRIX_BYTES", 1 if tile == 7 else 32_000_000)
    rng = random.Random(tile)
    n = family(rng, "ab", 7, 120) | family(rng, "aéÿ×", 8, 80) | {"z" * 300: 5, "z" * 299 + "y": 50,
        "z" * 299: 2000, "aaaaaa": 7, "unrelated": 9}
    want = plain_groups(n)
    assert groups(spark, n) == want
    assert max(r[4] for r in want) > 5 and any(r[2] not in (r[0], r[1]) for r in want)


def test_prefix_and_suffix_may_overlap(spark):
    n = {"aaaaaa": 5, "aaaaaaa": 30, "aaaaaaaa": 200, "baaaaaa": 4, "abaaaaa": 3, "aaaaaba": 2}
    assert groups(spark, n) == plain_groups(n)


def test_nothing_and_one_word(spark):
    assert spelling.group_variants(spark.createDataFrame([], "word string, n long")).count() == 0
    assert groups(spark, {"single": 5}) == {("single", None, "single", 5, 0, None)}


def test_counts_equal_plain(spark):
    rng = random.Random(8)
    words = ["Straße", "STRASSE", "straßen", "naïveté", "ÉCOLES", "écoles", "x×y÷zw", "short", "mot-valise",
             "lőrinc", "don't", "Overlapping", "Αlphabet", "a" * 700]
    rows = [(rng.choice([None, *range(40)]), " ".join(rng.choices(words, k=rng.randrange(60))))
            for _ in range(90)]
    rows += odd_documents() + [(3, "tail" + "x" * 3), (4, "joined"), (5, "texts")] * 6
    rows += [(i, "extraordinary " * 3) for i in range(400)]
    df = spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", n int").repartition(4)
    for damage in (None, 7, 199):
        got = {r.word: r.n for r in spelling.count_words(df, damage).collect()}
        assert got == plain_counts(rows, damage)
    assert spelling.count_words(df.where("false"), 199).count() == 0


def test_crc32_of_words():
    words = [b"", b"a", b"hello", bytes(range(256)), b"xyz" * 300]
    data, at = text_bytes(pa.array([w.decode("latin-1") for w in words]))
    seeds = np.array([zlib.crc32(b"%d:" % i) for i in range(5)], np.uint32)
    got = spelling.crc32_of(data, at[:-1], at[1:], seeds)
    assert got.tolist() == [zlib.crc32(b"%d:" % i + w.decode("latin-1").encode()) for i, w in enumerate(words)]

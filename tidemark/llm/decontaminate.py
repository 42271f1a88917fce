"""Benchmark decontamination with SimHash windows and a multi-index of Hamming blocks.

A window of a document is as long as a benchmark item, or is the whole of a shorter document.
Windows and items have 128-bit SimHash fingerprints over their five-word shingles. An item is
listed under every value that is near enough to one of its fingerprint's blocks; any window
within the radius shares a listing. Where a shingle occurs twice in either, or the lengths
differ, the number of bits says too little: such pairs share one of the first shingles in the
order of hashes, without exception. Pairs found are verified by the exact weighted similarity
of their shingles.
"""

import itertools
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_settings, nest, small, unnest
from tidemark.llm.simhash_dedup import _votes
from tidemark.llm.words import (
    blocks, column_of, find_words, is_mark, joined_words, mix, room_left, run_hashes, text_bytes,
    word_hashes,
)
from tidemark.session import store

SHINGLE = 5
SIMILARITY = 0.8
#: Blocks of the 128 bits: (half, first bit, width). Two fingerprints that differ by at most
#: RADIUS bits differ by at most NEAR bits in one of the twelve. At a similarity of 0.8 about
#: 19 bits differ, with a deviation of 4, if no shingle occurs twice.
BLOCKS = [(half, at, width) for half in (0, 1)
          for at, width in ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))]
NEAR = 2
RADIUS = 35
#: Bits of the fixed filter of benchmark shingles that every task holds (2 MB).
SLOTS = 2**24
#: Keys of shingles are at least this, listings of blocks are less.
KEYS = 2**62


def _normal(texts: pa.Array):
    """Lower-case words between ASCII marks and white space: their hashes, the bytes of all
    words with one space after each, the words' places there, and each text's first word."""
    data, at = text_bytes(pc.utf8_lower(texts))
    mark = is_mark()
    starts, ends, first = find_words(data, at, mark)
    raw, place = joined_words(data, starts, ends, mark)
    return word_hashes(data, starts, ends), raw, place, first


def _shingle(n: int) -> int:
    return min(SHINGLE, n)


def _slots(hashes: np.ndarray, n) -> np.ndarray:
    """Filter bits of shingle hashes for items of n words; n = 0: for any item."""
    return (mix(hashes + np.asarray(n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            % np.uint64(SLOTS)).astype(np.int64)


def _common(n, m):
    """How many shingles, repeats included, similar texts of n and m shingles share at least."""
    share = SIMILARITY / (1 + SIMILARITY)
    return np.ceil(share * (np.asarray(n) + np.asarray(m)) - 1e-9).astype(np.int64)


def _shingles(words: np.ndarray, p: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shingle hashes of windows of ``n`` words from the words ``p``, and how many each has."""
    k = np.minimum(n, SHINGLE)
    count = n - k + 1
    at = np.repeat(p - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    hashes = np.zeros(len(at), np.uint64)
    for size in np.unique(k):
        own = np.repeat(k == size, count)
        hashes[own] = run_hashes(words, int(size))[at[own]]
    return hashes, count


def _marks(hashes: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of the fingerprints of windows with ``count`` shingles each."""
    first = np.cumsum(count) - count
    low = _votes(mix(hashes + np.uint64(1)), first)
    high = _votes(mix(hashes + np.uint64(2)), first)
    return low.view(np.int64), high.view(np.int64)


def _first_keys(
    hashes: np.ndarray, count: np.ndarray, most: np.ndarray
) -> tuple[list[np.ndarray], np.ndarray]:
    """The ``most`` smallest keys of each window's shingles, and whether a shingle repeats.

    The first, second and further times of a shingle have keys of their own. Two windows of n
    and m shingles that share c of them share one of their n - c + 1 and m - c + 1 first keys.
    """
    first = np.cumsum(count) - count
    window = np.repeat(np.arange(len(count)), count)
    order = np.lexsort((hashes, window))
    hashes = hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (window[1:] != window[:-1])
    time = np.arange(len(hashes)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    keys = (mix(hashes + mix(time.astype(np.uint64))) >> np.uint64(2)).astype(np.int64) + KEYS
    keys = keys[np.lexsort((keys, window))]
    repeats = np.zeros(len(count), bool)
    repeats[window[~new]] = True
    return [keys[a : a + m] for a, m in zip(first.tolist(), most.tolist())], repeats


def _block_keys(low: np.ndarray, high: np.ndarray, near: int) -> np.ndarray:
    """[window, listing]: block values with up to ``near`` bits flipped, told apart by block."""
    out = []
    for b, (half, at, width) in enumerate(BLOCKS):
        value = ((low, high)[half].view(np.uint64) >> np.uint64(at)) & np.uint64((1 << width) - 1)
        for flips in range(near + 1):
            for bits in itertools.combinations(range(width), flips):
                out.append((value ^ np.uint64(sum(1 << x for x in bits))) + np.uint64(b << 16))
    return np.stack(out, axis=1).astype(np.int64)


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """item_id, n (words), words, the fingerprint (low, high), its listings, the first keys,
    whether a shingle repeats, and filter bits. Items without a word match nothing and are left
    out."""
    arrow_settings(benchmark.sparkSession)

    def prepare(batches):
        for table in blocks(batches, "text"):
            words, raw, place, first = _normal(column_of(table, "text"))
            n = np.diff(first)
            own = np.flatnonzero(n > 0)
            if not len(own):
                continue
            hashes, count = _shingles(words, first[:-1][own], n[own])
            low, high = _marks(hashes, count)
            least = np.ceil(SIMILARITY * count - 1e-9).astype(np.int64)  # of the shortest text
            keys, repeats = _first_keys(hashes, count, count - _common(count, least) + 1)
            slots = []
            for i in own:
                k = _shingle(int(n[i]))
                h = run_hashes(words[first[i] : first[i + 1]], k)
                bits = [_slots(h, n[i])] + ([_slots(h, 0)] if k == SHINGLE else [])
                slots.append(np.unique(np.concatenate(bits)).tolist())
            text = [raw[place[first[i]] : place[first[i + 1]] - 1].tobytes().decode() for i in own]
            yield from pa.table({
                "item_id": column_of(table, "item_id").cast(pa.int64()).take(pa.array(own)),
                "n": n[own], "words": pa.array(text, pa.string()), "low": low, "high": high,
                "listings": pa.array(list(_block_keys(low, high, NEAR)), pa.list_(pa.int64())),
                "keys": pa.array(keys, pa.list_(pa.int64())), "repeats": repeats,
                "slots": pa.array(slots, pa.list_(pa.int64())),
            }).to_batches()

    return benchmark.select("item_id", "text").mapInArrow(
        prepare, "item_id long, n long, words string, low long, high long, "
                 "listings array<long>, keys array<long>, repeats boolean, slots array<long>")


def _windows(table: pa.Table, bits: np.ndarray, lengths: list[int]) -> pa.Table | None:
    """Windows of a block of documents whose shingles are nearly all shingles of items of
    their length, by the filter. Of similar shingle counts n, at least 8/9 n are common where
    the similarity is 0.8, so no similar window is left out. A text shorter than an item, but
    long enough to be similar, is a window as a whole."""
    def has(slots):
        return (bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1

    words, raw, place, first = _normal(column_of(table, "text"))
    found = []
    common = run_hashes(words, SHINGLE)
    hit = np.zeros(len(words) + 1, bool)
    hit[: len(common)] = has(_slots(common, 0))
    before = np.append(0, np.cumsum(hit))
    per_text = before[first[1:]] - before[first[:-1]]
    sizes = np.diff(first)
    whole = np.zeros(len(sizes), bool)

    def hits_until(texts, n, k):
        size = sizes[texts]
        at = np.repeat(first[:-1][texts] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        own = np.zeros(len(words) + 1, bool)
        at = at[hit[at]] if k == SHINGLE else at[at < len(words) - k + 1]
        own[at] = has(_slots((common if k == SHINGLE else run_hashes(words, k))[at], n))
        return np.append(0, np.cumsum(own))

    for n in lengths:
        k = _shingle(n)
        count = sizes - k + 1
        short = (sizes < n) & (count >= SIMILARITY * (n - k + 1) - 1e-9) & ~whole
        short = np.flatnonzero(short & (per_text >= _common(n - k + 1, count)))
        if len(short) and k == SHINGLE:  # below, no fewer words make a shingle of the item's
            sums, p = hits_until(short, n, k), first[:-1][short]
            good = sums[p + count[short]] - sums[p] >= _common(n - k + 1, count[short])
            whole[short[good]] = True
        need = int(_common(n - k + 1, n - k + 1))
        texts = np.flatnonzero((sizes >= n) & ((per_text >= need) | (k < SHINGLE)))
        if not len(texts):
            continue
        size = sizes[texts]
        sums = hits_until(texts, n, k)
        text, p = room_left(np.append(0, np.cumsum(size)), n)
        p = p - (np.cumsum(size) - size)[text] + first[:-1][texts[text]]
        good = sums[p + n - k + 1] - sums[p] >= need
        if good.any():
            found.append((texts[text[good]], p[good], np.full(int(good.sum()), n)))
    inner = sum(len(x[0]) for x in found)
    if whole.any():
        own = np.flatnonzero(whole)
        found.append((own, first[:-1][own], sizes[own]))
    if not found:
        return None
    text, p, n = (np.concatenate(x) for x in zip(*found))
    hashes, count = _shingles(words, p, n)
    low, high = _marks(hashes, count)
    keys, repeats = _first_keys(hashes, count, count - _common(count, count) + 1)
    shown = [raw[place[a] : place[b] - 1].tobytes().decode() for a, b in zip(p, p + n)]
    rows = table.select(["_d", "_t"]).take(pa.array(text))
    for name, values in (("start", p - first[:-1][text]), ("n", n), ("words", shown),
                         ("whole", np.arange(len(n)) >= inner), ("low", low), ("high", high),
                         ("keys", pa.array(keys, pa.list_(pa.int64()))), ("repeats", repeats)):
        rows = rows.append_column(name, pa.array(values))
    return rows


def candidate_windows(rows: DataFrame, items: DataFrame) -> DataFrame:
    """(_d, _t, start, n, words, whole, low, high, keys, repeats) of the documents (_d, _t, text);
    ``whole``: of fewer words than the items it is for. The filter has a fixed size; a fuller
    one lets more windows through and loses none."""
    spark = arrow_settings(rows.sparkSession)
    slots = items.select(F.explode("slots").alias("slot")).distinct().toArrow()["slot"]
    bits = np.zeros(SLOTS // 8, np.uint8)
    slot = np.asarray(slots, np.int64)
    np.bitwise_or.at(bits, slot >> 3, (1 << (slot & 7)).astype(np.uint8))
    lengths = sorted(r.n for r in items.select("n").distinct().collect())
    shared = spark.sparkContext.broadcast((bits.tobytes(), lengths))

    def scan(batches):
        bits, lengths = np.frombuffer(shared.value[0], np.uint8), shared.value[1]
        for table in blocks(batches, "text"):
            found = _windows(table, bits, lengths)
            if found is not None:
                yield from found.to_batches()

    return rows.select("_d", "_t", "text").mapInArrow(
        scan, "_d long, _t long, start long, n long, words string, whole boolean, low long, "
              "high long, keys array<long>, repeats boolean")


def similarity(a: str, b: str) -> float:
    """Weighted Jaccard similarity of two word strings' shingles, weighted by occurrence."""
    def shingles(text):
        words = text.split(" ")
        k = _shingle(len(words))
        return Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1))

    x, y = shingles(a), shingles(b)
    return sum((x & y).values()) / sum((x | y).values())


def _far(part: str) -> Column:
    return F.col(f"w.{part}").bitwiseXOR(F.col(f"i.{part}"))


def _matches(windows: DataFrame, items: DataFrame) -> DataFrame:
    """(n, words, whole, item_id, similarity): the different windows that are similar to items."""
    def values(low, high):
        out = []
        for b, (half, at, width) in enumerate(BLOCKS):
            bits = F.shiftrightunsigned((low, high)[half], at).bitwiseAND(F.lit((1 << width) - 1))
            out.append(bits + F.lit(b << 16))
        return F.array(*out)

    probes = windows.select("n", "words", "whole", "low", "high", "keys", "repeats").distinct().withColumn(
        "key", F.explode(F.concat(values(F.col("low"), F.col("high")), "keys"))).alias("w")
    index = items.select("item_id", "n", F.col("words").alias("item"), "low", "high", "keys", "repeats",
                         F.explode(F.concat("listings", "keys")).alias("key")).alias("i")
    first = F.lit(None).cast("int")
    for b, (half, at, width) in reversed(list(enumerate(BLOCKS))):
        part = F.shiftrightunsigned(_far(("low", "high")[half]), at).bitwiseAND(F.lit((1 << width) - 1))
        first = F.when(F.bit_count(part) <= NEAR, F.lit(b)).otherwise(first)
    exact = F.col("w.whole") | F.col("w.repeats") | F.col("i.repeats")
    by_key = F.col("w.key") == F.array_min(F.array_intersect("w.keys", "i.keys"))
    by_block = (F.bit_count(_far("low")) + F.bit_count(_far("high")) <= RADIUS) & (
        F.shiftright(F.col("w.key"), 16) == first)
    pairs = probes.join(
        index,
        (F.col("w.key") == F.col("i.key"))
        & F.when(F.col("w.whole"), F.col("w.n") < F.col("i.n")).otherwise(F.col("w.n") == F.col("i.n"))
        & F.when(exact, by_key).otherwise(by_block),  # each pair at its first key or listing only
    ).select("w.n", "w.words", "w.whole", "i.item", "i.item_id")

    def verify(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            found = np.array([
                similarity(a, b) for a, b in zip(*(table[c].to_pylist() for c in ("words", "item")))
            ])
            done = table.drop_columns(["item"]).append_column("similarity", pa.array(found, pa.float64()))
            yield from done.filter(pa.array(found >= SIMILARITY)).to_batches()

    return pairs.mapInArrow(
        verify, "n long, words string, whole boolean, item_id long, similarity double")


def _leaks(rows: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(_d, _t, item_id, similarity, start, n): each item's most similar, first window."""
    items = store(benchmark_items(benchmark), "items")
    windows = store(candidate_windows(rows, items), "windows")
    best = F.max(F.struct("similarity", (-F.col("start")).alias("start"))).alias("_best")
    return windows.join(_matches(windows, items), ["n", "words", "whole"]).groupBy(
        "_d", "_t", "item_id", "n").agg(best).select(
        "_d", "_t", "item_id", F.col("_best.similarity").alias("similarity"),
        (-F.col("_best.start")).alias("start"), "n")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity, start and n_words of each benchmark item that a document
    holds: a window of as many words as the item with a similarity of 0.8 or more (the most
    similar, then the first one). A document of fewer words is one window.

    Words are compared in lower case and without ASCII marks; an item shorter than a shingle
    is one shingle. Null and empty texts and items have no words and match nothing. A null
    doc_id comes out null; rows equal in id and text are one document. Empty tables give an
    empty one, other columns are not read.
    """
    rows = nest(docs.select("doc_id", "text")).select("_d", "_t", F.col("row.text").alias("text"))
    return _leaks(rows, benchmark).select(
        F.when(F.col("_d") < 2**63 - 1, F.col("_d")).alias("doc_id"), "item_id", "similarity",
        "start", F.col("n").alias("n_words"))


def remove_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, unchanged, that hold no benchmark item."""
    rows = nest(docs)
    found = _leaks(rows.select("_d", "_t", F.col("row.text").alias("text")), benchmark)
    bad = store(found.select("_d", "_t").distinct(), "leaks")
    return unnest(rows.join(small(bad), ["_d", "_t"], "left_anti"), docs.columns)

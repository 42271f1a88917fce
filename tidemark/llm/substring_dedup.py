"""Exact removal of word windows that start in an earlier document, by super-k-mers.

Consecutive windows that share a minimiser (the smallest hash of their inner word runs) are
one stretch of text. It travels as one packed string to its minimiser's bucket; equal windows
share a minimiser, so a bucket finds all occurrences of its windows by sorting them.
"""

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_settings, nest
from tidemark.llm.words import (
    blocks, column_of, find_words, joined_words, room_left, run_hashes, text_bytes, word_hashes,
)
from tidemark.session import store

WINDOW = 13
INNER = 3
#: Buckets for each shuffle partition; the result does not depend on it.
SPREAD = 2
#: Bytes of text that are compared before the rest travels.
LOCAL = 6_000_000
#: A minimiser of over one in so many windows is hot: its stretches are dealt out by a second
#: key. Those of at least NOTED windows are counted in each block. Neither changes the result.
HOT, NOTED = 2048, 256
#: What travels beside a stretch: the high bits of its key, its place in the list of
#: documents, its first word (low and high half) and its bytes (likewise).
HEAD = [("minimiser", np.uint32), ("doc", np.uint32), ("start", np.uint32),
        ("start_high", np.uint32), ("size", np.uint32), ("size_high", np.uint32)]


def _equal_runs(raw: np.ndarray, place: np.ndarray, p: np.ndarray, q: np.ndarray, length: int):
    """Whether the ``length`` words from p and from q are the same bytes."""
    size = place[p + length] - place[p]
    same = size == place[q + length] - place[q]
    step = max(1, 2_000_000 // max(1, int(size.max(initial=1))))
    for i in range(0, len(p), step):
        part = slice(i, i + step)
        n = np.where(same[part], size[part], 0)
        total = int(n.sum())
        if total:
            from_start = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
            left = raw[np.repeat(place[p[part]], n) + from_start]
            right = raw[np.repeat(place[q[part]], n) + from_start]
            bad = np.repeat(np.arange(len(n)), n)[left != right]
            same[i + bad] = False
    return same


def _after_first(
    raw: np.ndarray, place: np.ndarray, words: np.ndarray, p: np.ndarray, owner: np.ndarray,
    length: int,
) -> np.ndarray:
    """For windows starting at the words ``p``: whether an equal one has a smaller owner.

    ``owner`` must not fall. Windows are sorted by hash; neighbours with equal hashes are
    compared byte by byte, and a collision is resolved by the bytes themselves.
    """
    label = run_hashes(words, length)[p]
    order = np.argsort(label, kind="stable")
    alike = label[order[1:]] == label[order[:-1]]
    a, b = p[order[:-1][alike]], p[order[1:][alike]]
    wrong = ~_equal_runs(raw, place, a, b, length)
    if wrong.any():
        clash = np.isin(label, label[order[:-1][alike][wrong]])
        seen: dict[bytes, int] = {}
        for i in np.flatnonzero(clash):
            text = raw[place[p[i]] : place[p[i] + length]].tobytes()
            label[i] = seen.setdefault(text, len(seen))
        order = np.lexsort((np.arange(len(p)), label, clash))
        alike = (label[order[1:]] == label[order[:-1]]) & (clash[order[1:]] == clash[order[:-1]])
    first = np.flatnonzero(np.concatenate(([True], ~alike)))
    least = np.repeat(owner[order[first]], np.diff(np.append(first, len(order))))
    late = np.empty(len(p), bool)
    late[order] = owner[order] > least
    return late


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Indices at which any of the columns changes, the first index included."""
    change = np.zeros(len(columns[0]), bool)
    change[:1] = True
    for column in columns:
        change[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(change)


def _spans(d, t, start, length: int) -> pa.Table:
    """Rows of covered words [a, b) from windows in order, neighbours put together."""
    cut = _runs(d, t, start - np.arange(len(start)))
    last = np.append(cut[1:], len(start)) - 1
    return pa.table({
        "_d": d[cut], "_t": t[cut], "a": start[cut], "b": start[last] + length,
    }) if len(start) else pa.table({k: pa.array([], pa.int64()) for k in ("_d", "_t", "a", "b")})


def _pack(head: dict[str, np.ndarray], docs: np.ndarray, body: np.ndarray) -> tuple[bytes, bytes]:
    zip_ = zstandard.ZstdCompressor(level=3)
    n = np.array([len(head["doc"]), docs.shape[1]], np.int64)
    doc = np.diff(head["doc"], prepend=0)  # mostly zeros and ones
    columns = [head["minimiser"], doc, head["start"], head["start"] >> 32, head["size"],
               head["size"] >> 32]
    fields = b"".join(
        (c.astype(np.int64) & 0xFFFFFFFF).astype(kind).tobytes()
        for c, (_, kind) in zip(columns, HEAD)
    )
    return zip_.compress(n.tobytes() + docs.tobytes() + fields), zip_.compress(body.tobytes())


def _unpack(heads: list[bytes], bodies: list[bytes]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    unzip = zstandard.ZstdDecompressor()
    parts = []
    for head in heads:
        raw = unzip.decompress(head)
        n, m = np.frombuffer(raw, np.int64, 2).tolist()
        docs = np.frombuffer(raw, np.int64, 2 * m, 16).reshape(2, m)
        at = 16 + 16 * m
        minimiser, doc, start, start_high, size, size_high = (
            np.frombuffer(raw, kind, n, at + 4 * n * i).astype(np.int64)
            for i, (_, kind) in enumerate(HEAD)
        )
        d, t = docs[:, np.cumsum(doc)]
        parts.append((minimiser, d, t, start + (start_high << 32), size + (size_high << 32)))
    joined = [np.concatenate(column) for column in zip(*parts)]
    body = np.frombuffer(b"".join(unzip.decompress(x) for x in bodies), np.uint8)
    return dict(zip(("minimiser", "d", "t", "start", "size"), joined)), body


def _gather(raw: np.ndarray, start: np.ndarray, size: np.ndarray, step: int = 1_000_000):
    """The bytes of all stretches, one after another; their places take memory for about
    ``step`` bytes at a time."""
    end = np.cumsum(size)
    out = np.empty(int(end[-1]) if len(end) else 0, np.uint8)
    i = 0
    while i < len(size):
        done = int(end[i] - size[i])
        j = max(int(np.searchsorted(end, done + step, side="right")), i + 1)
        n = size[i:j]
        at = np.repeat(start[i:j] - (end[i:j] - n - done), n)
        at += np.arange(len(at))
        out[done : done + len(at)] = raw[at]
        i = j
    return out


def _least(words: np.ndarray, window: int, inner: int) -> np.ndarray:
    """The smallest hash of the runs of ``inner`` words in each window."""
    small = run_hashes(words, inner)
    least = small[: max(0, len(words) - window + 1)].copy()
    for j in range(1, window - inner + 1):
        np.minimum(least, small[j : j + len(least)], out=least)
    return least


def _keys(words: np.ndarray, window: int, inner: int, hot: np.ndarray) -> np.ndarray:
    """What equal windows share and neighbours mostly do: the minimiser, and where that is one
    of ``hot`` (in order) the minimiser of longer runs beside it."""
    key = _least(words, window, inner)
    if len(hot) and len(key):
        place = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
        common = np.flatnonzero(hot[place] == key)
        if len(common):
            wide = _least(words, window, (window + inner + 1) // 2)
            key[common] = run_hashes(np.stack([key[common], wide[common]], axis=1).ravel(), 2)[::2]
    return key


def _frequent(table: pa.Table, window: int, inner: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The block's minimisers of at least NOTED windows, their windows, and all its windows."""
    data, at = text_bytes(column_of(table, "text"))
    starts, ends, first = find_words(data, at)
    _, p = room_left(first, window)
    if not len(p):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
    key, n = np.unique(_least(word_hashes(data, starts, ends), window, inner)[p], return_counts=True)
    often = n >= NOTED
    return key[often], n[often], len(p)


def hot_minimisers(rows: DataFrame, window: int = WINDOW, inner: int = INNER) -> np.ndarray:
    """The minimisers of more than one in HOT windows of all texts, in order: fewer than HOT.
    Counted in blocks, so that windows of those rare in a block may be missing."""
    def count(batches):
        for table in blocks(batches, "text", LOCAL):
            key, n, total = _frequent(table, window, inner)
            yield pa.RecordBatch.from_arrays([
                pa.array([None, *key.view(np.int64).tolist()], pa.int64()),
                pa.array([total, *n.tolist()], pa.int64())], names=["key", "n"])

    counted = store(rows.select("text").mapInArrow(count, "key long, n long").groupBy("key").agg(
        F.sum("n").alias("n")), "minimisers")
    total = counted.where("key is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = counted.where(F.col("key").isNotNull() & (F.col("n") * HOT > total)).select("key").collect()
    return np.sort(np.array([r.key for r in found], np.int64).view(np.uint64))


def _scatter(table: pa.Table, window: int, inner: int, buckets: int, hot: np.ndarray):
    """Of one block of documents: spans that are settled inside it, and for each bucket the
    packed stretches of all windows whose first owner in the block is their document."""
    table = table.sort_by("_d")
    data, at = text_bytes(column_of(table, "text"))
    d, t = (np.asarray(column_of(table, k)) for k in ("_d", "_t"))
    starts, ends, first = find_words(data, at)
    text, p = room_left(first, window)
    if not len(p):
        return None, []
    words = word_hashes(data, starts, ends)
    raw, place = joined_words(data, starts, ends)
    late = _after_first(raw, place, words, p, d[text], window)
    spans = _spans(d[text[late]], t[text[late]], (p - first[:-1][text])[late], window)
    keys = _keys(words, window, inner, hot)
    text, p = text[~late], p[~late]
    cut = _runs(text, p - np.arange(len(p)), keys[p])
    last = np.append(cut[1:], len(p)) - 1
    bucket = (keys[p[cut]] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    edges = np.append(_runs(bucket[order]), len(order)) if len(order) else [0]
    packed = []
    for i, j in zip(edges[:-1], edges[1:]):
        own = order[i:j]
        a, b = p[cut[own]], p[last[own]] + window
        size = place[b] - place[a]
        owners, doc = np.unique(text[cut[own]], return_inverse=True)
        head, body = _pack(
            {"minimiser": keys[a] >> np.uint64(32), "doc": doc, "size": size,
             "start": a - first[:-1][owners][doc]},
            np.stack([d[owners], t[owners]]), _gather(raw, place[a], size),
        )
        packed.append((int(bucket[own[0]]), head, body))
    return spans, packed


def _settle(heads: list[bytes], bodies: list[bytes], window: int) -> pa.Table | None:
    """Spans of one bucket's windows that start in a document with a smaller id."""
    head, body = _unpack(heads, bodies)
    place = np.cumsum(head["size"]) - head["size"]
    order = np.lexsort((head["d"], head["minimiser"]))
    group = _runs(head["minimiser"][order])
    until = np.append(group[1:], len(order))
    shared = head["d"][order[group]] < head["d"][order[until - 1]]
    own = order[np.repeat(shared, until - group)]
    if not len(own):
        return None
    own = own[np.argsort(head["d"][own], kind="stable")]
    size = head["size"][own]
    data = _gather(body, place[own], size)
    at = np.append(0, np.cumsum(size))
    starts, ends, first = find_words(data, at)
    text, p = room_left(first, window)
    words = word_hashes(data, starts, ends)
    raw, where = joined_words(data, starts, ends)
    late = _after_first(raw, where, words, p, head["d"][own[text]], window)
    text, p = text[late], p[late]
    return _spans(
        head["d"][own[text]], head["t"][own[text]],
        head["start"][own[text]] + p - first[:-1][text], window,
    )


def covered_spans(rows: DataFrame, window: int = WINDOW, inner: int = INNER) -> DataFrame:
    """(_d, _t, a, b): stretches of words [a, b) of the documents (_d, _t, text) covered by
    windows that also start in a document with a smaller ``_d``.

    Documents are first compared inside a block of a few megabytes (``LOCAL``), and only the earliest
    owner's occurrences of a window travel on. A window that a third of all documents share
    therefore reaches its bucket once for each block, not once for each document. Stretches of
    a phrase that is frequent in different surroundings are dealt out by a second key.
    """
    spark = arrow_settings(rows.sparkSession)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = SPREAD * partitions
    hot = hot_minimisers(rows, window, inner)
    empty = pa.table({k: pa.array([], pa.int64()) for k in ("_d", "_t", "a", "b")})

    def scatter(batches):
        for table in blocks(batches, "text", LOCAL):
            spans, packed = _scatter(table, window, inner, buckets, hot)
            n = 0 if spans is None else spans.num_rows
            if n:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, spans.schema) as out:
                    out.write_table(spans)
                packed.append((packed[0][0] if packed else 0, sink.getvalue().to_pybytes(), None))
            for i in range(0, len(packed), 64):
                some = packed[i : i + 64]
                yield pa.RecordBatch.from_arrays([
                    pa.array([x[0] for x in some], pa.int32()),
                    pa.array([x[1] for x in some], pa.binary()),
                    pa.array([x[2] for x in some], pa.binary()),
                ], names=["bucket", "head", "body"])

    def settle(batches):
        bucket, heads, bodies = None, [], []
        for batch in batches:
            for b, head, body in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if b != bucket and heads:
                    yield from (_settle(heads, bodies, window) or empty).to_batches()
                    heads, bodies = [], []
                bucket = b
                if body is None:
                    yield from pa.ipc.open_stream(head).read_all().to_batches()
                else:
                    heads.append(head)
                    bodies.append(body)
        if heads:
            yield from (_settle(heads, bodies, window) or empty).to_batches()

    return (
        rows.select("_d", "_t", "text")
        .mapInArrow(scatter, "bucket int, head binary, body binary")
        .repartitionById(partitions, "bucket")  # as many buckets in each
        .sortWithinPartitions("bucket")
        .mapInArrow(settle, "_d long, _t long, a long, b long")
    )


def _keep_words(texts: pa.Array, spans: list) -> tuple[list, list, list]:
    data, at = text_bytes(texts)
    starts, ends, first = find_words(data, at)
    raw, place = joined_words(data, starts, ends)
    change = np.zeros(len(starts) + 1, np.int64)
    for i, own in enumerate(spans):
        if own:
            a = np.array([x["a"] for x in own], np.int64) + first[i]
            b = np.array([x["b"] for x in own], np.int64) + first[i]
            np.add.at(change, a, 1)
            np.add.at(change, b, -1)
    gone = np.cumsum(change[:-1]) > 0
    kept = raw[np.repeat(~gone, np.diff(place))].tobytes()
    sizes = np.where(gone, 0, np.diff(place))
    edge = np.append(0, np.cumsum(sizes))[first]
    n = np.diff(first)
    removed = np.diff(np.append(0, np.cumsum(gone))[first])
    texts = [kept[a : max(a, b - 1)].decode("utf-8", "replace") for a, b in zip(edge, edge[1:])]
    return n, removed, texts


def remove_repeats(docs: DataFrame, window: int = WINDOW, inner: int = INNER) -> DataFrame:
    """doc_id, n_words, n_removed and text (the kept words, joined by one space) of each row.

    A word goes if a window of ``window`` words that covers it also starts in a document with
    a smaller doc_id; windows are judged on the input. A null id counts as the largest one, a
    null or empty text has no words. Rows with equal ids never remove from each other. An
    empty table gives an empty one; other columns are not read.
    """
    rows = nest(docs.select("doc_id", "text")).select(
        "_d", "_t", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text")
    )
    # Written, so that the packed strings' shuffle is over before the texts are moved.
    spans = store(covered_spans(rows, window, inner).groupBy("_d", "_t").agg(
        F.collect_list(F.struct("a", "b")).alias("spans")), "spans")
    both = rows.join(spans, ["_d", "_t"], "left").select("doc_id", "text", "spans")

    def keep(batches):
        for table in blocks(batches, "text"):
            n, removed, texts = _keep_words(
                column_of(table, "text"), column_of(table, "spans").to_pylist()
            )
            yield from pa.table({
                "doc_id": column_of(table, "doc_id").cast(pa.int64()), "n_words": n,
                "n_removed": removed, "text": pa.array(texts, pa.string()),
            }).to_batches()

    return both.mapInArrow(keep, "doc_id long, n_words long, n_removed long, text string")

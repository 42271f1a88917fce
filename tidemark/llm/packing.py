"""Packing of tokenized documents into sequences of a fixed length.

Lengths are planned, not documents: a non-negative least squares fit says how often each
pattern of a few lengths is repeated, and what is left goes best-fit into the room that
remains. The plan depends on the histogram of lengths only and has a bounded size. Documents
then take their places in it by their rank among those of equal length.
"""

import itertools
import sys
import types
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import arrow_settings, position
from tidemark.llm.words import (
    blocks, column_of, distinct_words, find_words, lower_table, same_words, text_bytes,
)
from tidemark.session import store

CAPACITY = 2048
END_ID = 0
#: Lengths are rounded up to a UNITS-th of the capacity to enumerate patterns.
UNITS = 64
#: Most lengths in a pattern.
PARTS = 4
#: Shares of the fitted repeats that are tried; the rest is packed best-fit.
SHARES = (1.0, 0.75, 0.5)
#: Words whose ids a Python worker remembers, in about 60 bytes each.
CACHE = 1_000_000
#: Bytes of text that are encoded at once.
PART = 2_000_000
BUCKETS = 256
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def patterns(units: int = UNITS, parts: int = PARTS) -> np.ndarray:
    """[unit size, pattern]: how many pieces of each size, for all ways to fill ``units``
    exactly with up to ``parts`` sizes."""
    def fill(left: int, most: int, n: int):
        if left == 0:
            yield ()
        elif n:
            for size in range(min(left, most), 0, -1):
                if size * n < left:
                    break
                for rest in fill(left - size, size, n - 1):
                    yield (size, *rest)

    found = list(fill(units, units, parts))
    out = np.zeros((units + 1, len(found)))
    for j, sizes in enumerate(found):
        for size in sizes:
            out[size, j] += 1
    return out


def least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 with the smallest |ax - b|, by the active-set method."""
    x, used = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    scale = max(float(np.abs(b).max(initial=0)), 1.0)
    for _ in range(6 * a.shape[0]):
        gain = a.T @ (b - a @ x)
        gain[used] = 0
        new = int(gain.argmax())
        if gain[new] <= 1e-9 * scale:
            break
        used[new] = True
        while True:
            own = np.flatnonzero(used)
            z = np.linalg.lstsq(a[:, own], b, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[own] = z
                break
            low = z <= 0
            with np.errstate(divide="ignore", invalid="ignore"):
                ratio = np.where(low, x[own] / (x[own] - z), np.inf)
            x[own] += ratio.min() * (z - x[own])
            drop = own[low & (x[own] <= 1e-12 * scale)]
            if not len(drop):
                drop = own[[int(ratio.argmin())]]
            x[drop] = 0
            used[drop] = False
    return x


class _Plan:
    """Runs of places: pieces of one length, from a rank on, take one sequence each."""

    def __init__(self, counts: np.ndarray, capacity: int):
        self.left = counts.astype(np.int64).copy()
        self.taken = np.zeros_like(self.left)
        self.capacity = capacity
        self.sequences = 0
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.room: dict[int, list[tuple[int, int, int]]] = defaultdict(list)

    def put(self, length: int, n: int, sequence: int, offset: int) -> None:
        self.runs.append((length, int(self.taken[length]), n, sequence, offset))
        self.taken[length] += n
        self.left[length] -= n

    def leave(self, sequence: int, n: int, offset: int) -> None:
        """``n`` sequences from ``sequence`` on are filled up to ``offset``."""
        if n and offset < self.capacity:
            self.room[self.capacity - offset].append((sequence, n, offset))

    def repeat(
        self, parts: list[list[tuple[int, int]]], free: np.ndarray, least: int, n: int
    ) -> None:
        """``n`` new sequences. ``parts`` are the lengths (length, how many) that they take
        one after another; then each takes the longest piece that fits of those ``free``
        (counts by length), of ``least`` or more."""
        ends = [list(itertools.accumulate(m for _, m in part)) for part in parts]
        cuts = sorted({0, n}.union(*ends))
        at = [0] * len(parts)
        for a, b in zip(cuts, cuts[1:]):
            offset = 0
            for i, part in enumerate(parts):
                while ends[i][at[i]] <= a:
                    at[i] += 1
                length = part[at[i]][0]
                self.put(length, b - a, self.sequences + a, offset)
                offset += length
            while a < b:
                fits = np.flatnonzero(free[least : self.capacity - offset + 1])
                if not len(fits):
                    self.leave(self.sequences + a, b - a, offset)
                    break
                length = least + int(fits[-1])
                m = min(b - a, int(free[length]))
                free[length] -= m
                self.put(length, m, self.sequences + a, offset)
                self.leave(self.sequences + a, m, offset + length)
                a += m
        self.sequences += n

    def best_fit(self) -> None:
        """Longest first, each piece into the smallest room that holds it."""
        for length in range(self.capacity, 0, -1):
            while self.left[length]:
                fits = [room for room in self.room if room >= length and self.room[room]]
                if not fits:
                    self._open(length)
                    continue
                room = min(fits)
                sequence, n, offset = self.room[room].pop()
                m = min(n, int(self.left[length]))
                self.put(length, m, sequence, offset)
                self.leave(sequence, m, offset + length)
                if m < n:
                    self.room[room].append((sequence + m, n - m, offset))

    def _open(self, length: int) -> None:
        """All pieces left of a length into new sequences of their own."""
        each = self.capacity // length
        for copies, n in ((each, int(self.left[length]) // each), (int(self.left[length]) % each, 1)):
            if copies and n:
                for i in range(copies):
                    self.put(length, n, self.sequences, i * length)
                self.leave(self.sequences, n, copies * length)
                self.sequences += n


def _fitted(counts: np.ndarray, units: int, parts: int, share: float) -> _Plan:
    capacity = len(counts) - 1
    work = _Plan(counts, capacity)
    unit = -(-np.arange(capacity + 1) * units // capacity)
    histogram = np.bincount(unit, weights=counts, minlength=units + 1)
    shapes = patterns(units, parts)
    times = share * least_squares(shapes, histogram)
    for j in np.argsort(-times, kind="stable"):
        sizes = np.flatnonzero(shapes[:, j])[::-1]
        supply = [int(work.left[unit == u].sum()) // int(shapes[u, j]) for u in sizes]
        n = min(int(times[j]), *supply)
        if n <= 0:
            continue
        *most, smallest = [u for u in sizes for _ in range(int(shapes[u, j]))]
        left, drawn = work.left.copy(), []
        for u in most:
            need, part = n, []
            for length in np.flatnonzero((unit == u) & (left > 0))[::-1]:
                m = min(need, int(left[length]))
                if m:
                    part.append((int(length), m))
                    left[length] -= m
                    need -= m
            drawn.append(part)
        work.repeat(drawn, left, int(np.flatnonzero(unit == smallest)[0]), n)
    work.best_fit()
    return work


def plan(counts: np.ndarray, units: int = UNITS, parts: int = PARTS) -> np.ndarray:
    """Rows (length, rank, n, sequence, offset): the pieces of ``length`` with ranks from
    ``rank`` on, ``n`` of them, lie at ``offset`` in one sequence each, from ``sequence`` on.

    ``counts[length]`` is the number of pieces; the last index is the capacity. Of a few
    shares of the fitted repeats, the one that takes the fewest sequences counts.
    """
    found = [_fitted(counts, units, parts, share) for share in SHARES]
    best = min(found, key=lambda work: work.sequences)
    return np.array(sorted(best.runs), np.int64).reshape(-1, 5)


class _Ids:
    """Token ids of words, by the words' keys; kept between the tasks of a Python worker."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)
        self.text, self.begin = np.zeros(0, np.uint8), np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)

    def of(
        self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Of each of the different words, sorted by their hashes, the place of its ids in
        ``flat``, and how many there are. A remembered word counts only if its bytes are the
        same; another one with its hash is encoded, but not remembered."""
        if len(self.hashes) > CACHE:
            self.clear()
        at, sizes = np.searchsorted(self.hashes, hashes), ends - starts
        met = np.zeros(len(hashes), bool)
        inside = at < len(self.hashes)
        met[inside] = self.hashes[at[inside]] == hashes[inside]
        known = met.copy()
        known[met] = self.length[at[met]] == sizes[met]
        some = np.flatnonzero(known)
        known[some] = same_words(
            data, starts[some], self.begin[at[some]], sizes[some], self.text)
        start, size = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        start[known], size[known] = self.start[at[known]], self.size[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            raw = data.tobytes()
            own = [raw[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())]
            ids = self.encode(own)
            size[new] = np.fromiter(map(len, ids), np.int64, len(ids))
            start[new] = len(self.flat) + np.cumsum(size[new]) - size[new]
            self.flat = np.append(
                self.flat, np.fromiter(itertools.chain.from_iterable(ids), np.uint32))
            free = ~met[new]
            kept = new[free]
            length = sizes[kept]
            begin = len(self.text) + np.cumsum(length) - length
            self.text = np.append(self.text, np.frombuffer(
                b"".join(itertools.compress(own, free)), np.uint8))
            for name, values in (("start", start[kept]), ("size", size[kept]), ("begin", begin),
                                 ("length", length), ("hashes", hashes[kept])):
                setattr(self, name, np.insert(getattr(self, name), at[kept], values))
        return start, size

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """A word of ASCII letters, in lower case, is one run for the merges; others are split
        up first."""
        merge = self.tokenizer.model.tokenize
        out = [[x.id for x in merge(w.decode())] if w.isalpha() else None for w in words]
        rest = [i for i, ids in enumerate(out) if ids is None]
        done = self.tokenizer.encode_batch_fast(
            [words[i].decode() for i in rest], add_special_tokens=False)
        for i, x in zip(rest, done):
            out[i] = x.ids
        return out


def _remembered(path: str) -> _Ids:
    kept = sys.modules.setdefault("_worker_memory", types.ModuleType("_worker_memory"))
    if getattr(kept, "path", None) != path:
        kept.path, kept.ids = path, _Ids(path)
    return kept.ids


def _split_marks(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words, with a last full stop or comma after an ASCII letter as a word of its own."""
    letter = np.zeros(256, bool)
    letter[65:91] = letter[97:123] = True
    mark = np.zeros(256, bool)
    mark[[0x2C, 0x2E]] = True
    cut = mark[data[ends - 1]] & (ends - starts > 1) & letter[data[np.maximum(ends - 2, 0)]]
    place = np.arange(len(starts)) + np.cumsum(cut) - cut
    total = len(starts) + int(cut.sum())
    s, e = np.empty(total, np.int64), np.empty(total, np.int64)
    s[place], e[place] = starts, ends - cut
    s[place[cut] + 1], e[place[cut] + 1] = ends[cut] - 1, ends[cut]
    return s, e, np.append(place, total)[first]


def _lower_plain(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The bytes, with the words in lower case that are ASCII only and hold no ``<``. Others
    keep theirs: a special token counts in its own case only, and a letter may compose with the
    mark after it in one case alone."""
    special = np.zeros(256, bool)
    special[128:] = special[0x3C] = True
    before = np.zeros(len(data) + 1, np.int32)
    np.cumsum(special[data], out=before[1:])
    own = before[ends] > before[starts]
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts[own]] = 1
    edge[ends[own]] -= 1
    kept = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    return np.where(kept, data, lower_table()[data])


def token_ids(texts: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts' ids, each text closed by ``end_id``, and the texts' places.

    The tokenizer drops white space and never joins across it, nor a letter with a stop or
    comma, and special tokens hold no white space, so a text's ids are those of its words. Each
    different word is encoded once; words of ASCII without special tokens have the same ids in
    lower case and are looked up in it.
    """
    data, at = text_bytes(texts)
    starts, ends, first = _split_marks(data, *find_words(data, at))
    data = _lower_plain(data, starts, ends)
    hashes, some, which = distinct_words(data, starts, ends)
    memory = _remembered(path)
    place, size = memory.of(hashes, data, starts[some], ends[some])
    n = size[which]
    ids = memory.flat[
        np.repeat(place[which] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
    edge = np.append(0, np.cumsum(n))[first]
    out = np.full(len(ids) + len(texts), end_id, np.uint32)
    inside = np.ones(len(out), bool)
    edge += np.arange(len(edge))
    inside[edge[1:] - 1] = False
    out[inside] = ids
    return out, edge


def pieces(
    docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): each document's ids, cut into
    pieces of ``capacity`` if there are more."""
    arrow_settings(docs.sparkSession)

    def cut(batches):
        for table in blocks(batches, "text", PART):
            ids, place = token_ids(column_of(table, "text"), tokenizer, end_id)
            total = np.diff(place)
            n = -(-total // capacity)
            doc = np.repeat(np.arange(len(n)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(total[doc] - start, capacity)
            raw = ids.astype("<u4").tobytes()
            first = (place[:-1][doc] + start).tolist()
            crc = [zlib.crc32(raw[4 * a : 4 * (a + m)]) for a, m in zip(first, length.tolist())]
            columns = {
                "doc_id": column_of(table, "doc_id").cast(pa.int64()).take(pa.array(doc)),
                "piece": pa.array(piece, pa.int32()), "start": start, "length": length,
                "ids_crc32": pa.array(crc, pa.int64()),
            }
            if with_ids:
                edges = np.append(place[:-1][doc] + start, place[-1])
                columns["ids"] = pa.ListArray.from_arrays(
                    pa.array(edges, pa.int32()), pa.array(ids.astype(np.int32)))
            yield from pa.table(columns).to_batches()

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return docs.select("doc_id", "text").mapInArrow(
        cut, schema + (", ids array<int>" if with_ids else ""))


def pack(
    docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """:func:`pieces` with their sequence_id and offset; no sequence exceeds ``capacity``.

    A null or empty text is one piece that holds ``end_id`` only. Ids may be null or repeated;
    every row is a document of its own. An empty table gives an empty one, other columns are
    not read. Only the histogram of lengths reaches the driver, at most ``capacity`` rows.
    """
    stored = store(pieces(docs, tokenizer, capacity, end_id, with_ids), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in stored.groupBy("length").count().collect():
        counts[length] = n
    runs = plan(counts)
    key = (runs[:, 0] << 48) | runs[:, 1]
    order = [F.col(c) for c in ("doc_id", "piece", "ids_crc32")]
    spread = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(BUCKETS))
    ranked = position(stored, ["length"], spread, order, "_rank")
    schema = stored.schema.add("sequence_id", "long").add("offset", "long")

    def place(batches):
        for batch in batches:
            length, rank = (
                np.asarray(batch.column(batch.schema.get_field_index(c))) for c in ("length", "_rank")
            )
            run = np.searchsorted(key, (length << 48) | rank, side="right") - 1
            done = pa.Table.from_batches([batch]).drop_columns(["_rank"])
            done = done.append_column("sequence_id", pa.array(runs[run, 3] + rank - runs[run, 1]))
            done = done.append_column("offset", pa.array(runs[run, 4]))
            yield from done.select(schema.names).to_batches()

    return ranked.mapInArrow(place, schema)

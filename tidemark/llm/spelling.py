"""Spelling variants: words one edit apart, grouped under their most frequent neighbour.

Two words are near if one inserted, deleted or replaced code point makes them equal, that is if
their common prefix and suffix together reach the longer length less one. One of the two then
reaches half of it, so near words share their first or their last half. Words with an equal half
are put into tiles, and in a tile all are compared at once as matrices of code points, padded
at the end for the prefixes and at the front for the suffixes.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_settings
from tidemark.llm.words import blocks, column_of, distinct_words, find_runs, lower_table, text_bytes
from tidemark.session import store

#: Code points and occurrences of a word.
MIN_LENGTH, MIN_COUNT = 6, 5
#: How much more often a form occurs than its variant.
RATIO = 5
#: One of so many occurrences loses a code point.
DAMAGE = 199
#: Bytes of text that a worker holds in arrays at once.
PART = 8_000_000
#: Words with an equal half that make one tile; more are compared tile by tile.
TILE = 4096
#: Rows of small groups that share a matrix, rows of a matrix of a large group, and bytes of one.
FEW, MANY, MATRIX_BYTES = 256, 1024, 32_000_000

WORDS = "word string, n long"


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> 1), table >> 1)
    return table


def crc32_of(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray, long: int = 512
) -> np.ndarray:
    """crc32 of each word's bytes, after what has the crc32 ``before``."""
    table, sizes = _crc_table(), ends - starts
    state = before.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    some, done = np.flatnonzero((sizes > 0) & (sizes <= long)), 0
    while len(some):
        now = state[some]
        state[some] = table[(now ^ data[starts[some] + done]) & 255] ^ (now >> 8)
        done += 1
        some = some[sizes[some] > done]
    out = state ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(sizes > long).tolist():
        out[i] = zlib.crc32(data[starts[i] : ends[i]], int(before[i]))
    return out


def _letters(data: np.ndarray) -> np.ndarray:
    """Whether each byte belongs to one of A-Z, a-z and U+00C0 to U+00FF."""
    plain = np.zeros(256, bool)
    plain[65:91] = plain[97:123] = True
    lead = data == 0xC3
    out = plain[data] | lead
    out[1:] |= lead[:-1]
    return out


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    sizes = ends - starts
    edges = np.append(0, np.cumsum(sizes))
    places = np.arange(edges[-1]) - np.repeat(edges[:-1] - starts, sizes)
    return pa.Array.from_buffers(
        pa.string(), len(starts),
        [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(data[places])])


def _block_words(ids: list, texts: pa.Array, damage: int | None) -> pa.Table:
    """(word, n): each different word of a block of texts and its occurrences."""
    data, at = text_bytes(texts)
    starts, ends, first = find_runs(_letters(data), at)
    data = lower_table()[data]
    leads = np.append(0, np.cumsum(data == 0xC3))
    length = ends - starts - (leads[ends] - leads[starts])
    doc = np.repeat(np.arange(len(ids)), np.diff(first))
    keep = length >= MIN_LENGTH
    starts, ends, length, doc = starts[keep], ends[keep], length[keep], doc[keep]
    cut = []
    if damage:
        seeds = [zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids]
        crc = crc32_of(data, starts, ends, np.array(seeds, np.uint32)[doc])
        hit = crc % np.uint32(damage) == 0
        for i in np.flatnonzero(hit & (length > MIN_LENGTH)).tolist():
            word, k = data[starts[i] : ends[i]].tobytes().decode(), int(crc[i]) % int(length[i])
            cut.append(word[:k] + word[k + 1 :])
        starts, ends = starts[~hit], ends[~hit]
    _, some, which = distinct_words(data, starts, ends)
    found = pa.table({
        "word": _strings(data, starts[some], ends[some]),
        "n": pa.array(np.bincount(which, minlength=len(some)), pa.int64()),
    })
    lost = pa.table({"word": pa.array(cut, pa.string()), "n": pa.array([1] * len(cut), pa.int64())})
    return pa.concat_tables([found, lost])


def count_words(docs: DataFrame, damage: int | None = None) -> DataFrame:
    """(word, n) of the words of at least ``MIN_LENGTH`` code points that occur ``MIN_COUNT``
    times in the texts: runs of letters, A-Z in lower case.

    With ``damage``, a run whose crc32 after its document's id and a colon is divisible by it
    loses the code point at that crc32 modulo the run's length. A null id counts as empty text
    there; null texts hold nothing; repeated rows count each time.
    """
    arrow_settings(docs.sparkSession)

    def count(batches):
        for table in blocks(batches, "text", PART):
            ids = column_of(table, "doc_id").to_pylist()
            yield from _block_words(ids, column_of(table, "text"), damage).to_batches()

    found = docs.select("doc_id", "text").mapInArrow(count, WORDS)
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def _cells(words: DataFrame) -> DataFrame:
    """Each word once for each tile it takes part in.

    The class ``a`` holds the words of lengths a and a - 1; ``side`` says which end of a // 2
    code points is shared. A group of more than ``TILE`` words is cut into blocks by a hash, and
    its tiles are the pairs of blocks: ``lhs`` and ``rhs`` say on which side of the tile a
    word stands. So no task holds more of a group than two blocks.
    """
    m = F.length("word")

    def ends(a):
        k = F.floor(a / 2).cast("int")
        return [
            F.struct(a.alias("a"), F.lit(side).alias("side"), part.alias("half"))
            for side, part in ((0, F.substring("word", F.lit(1), k)), (1, F.substring("word", -k, k)))
        ]

    keyed = words.select("word", "n", F.explode(F.array(*ends(m), *ends(m + 1))).alias("k"))
    keyed = keyed.select("word", "n", "k.*")
    group = ["a", "side", "half"]
    large = keyed.groupBy(*group).agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") > TILE)
    blocks_of = F.coalesce(F.ceil(F.col("_size") / TILE), F.lit(1)).cast("int")
    joined = keyed.join(large, group, "left").withColumn("_blocks", blocks_of)
    own = F.pmod(F.xxhash64("word"), F.col("_blocks")).cast("int")
    spread = joined.withColumn("_own", own).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    return spread.select(
        "a", "side", F.xxhash64(*group, low, high).alias("cell"),
        (F.col("_own") == low).alias("lhs"), (F.col("_own") == high).alias("rhs"), "word", "n",
    )


def _common(x: np.ndarray, y: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """How many first columns of each row of ``x`` equal those of each row of ``y``, where
    ``alive``; the padding of the two never agrees."""
    out = np.zeros(alive.shape, np.uint8 if x.shape[1] < 256 else np.int32)
    for c in range(x.shape[1]):
        alive = alive & (x[:, c][:, None] == y[:, c][None, :])
        if not alive.any():
            break
        out += alive
    return out


def _matrix(words: list[bytes], width: int, pad: int) -> np.ndarray:
    out = np.array(words, f"S{width}").view(np.uint8).reshape(len(words), width).copy()
    out[out == 0] = pad
    return out


class _Tile:
    """Words of a few whole cells, to be compared within them."""

    def __init__(self, columns: dict):
        for name, values in columns.items():
            setattr(self, name, values)
        self.raw = [w.encode("latin-1") for w in self.word]
        self.back = [w[::-1] for w in self.raw]
        self.length = np.fromiter(map(len, self.raw), np.int64, len(self.raw))
        self.width = int(self.length.max())

    def near(self, rows: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The near pairs of ``rows`` with ``others``, each pair of words once."""
        take = [[part[i] for i in at.tolist()] for part in (self.raw, self.back)
                for at in (rows, others)]
        a, side = self.a[rows][:, None], self.side[rows][:, None]
        alive = self.cell[rows][:, None] == self.cell[others][None, :]
        alive &= self.lhs[rows][:, None] & self.rhs[others][None, :]
        # Words of one block stand on both sides of its own tile.
        own = self.lhs[others][None, :] & self.rhs[rows][:, None]
        alive &= ~own | (rows[:, None] < others[None, :])
        alive &= np.maximum(self.length[rows][:, None], self.length[others][None, :]) == a
        prefix = _common(_matrix(take[0], self.width, 0), _matrix(take[1], self.width, 1), alive)
        # Pairs that share both halves are found by their first ones.
        alive &= (prefix >= a // 2) == (side == 0)
        suffix = _common(_matrix(take[2], self.width, 0), _matrix(take[3], self.width, 1), alive)
        x, y = np.nonzero(alive & (prefix.astype(np.int32) + suffix >= a - 1))
        return rows[x], others[y]

    def found(self) -> pa.Table | None:
        """(word, n_near, near_n, near): of each word with near ones how many, and the best."""
        step = min(MANY, max(MATRIX_BYTES // self.width, 16))
        left, right = np.flatnonzero(self.lhs), np.flatnonzero(self.rhs)
        pairs = [
            self.near(left[i : i + step], right[j : j + step])
            for i in range(0, len(left), step) for j in range(0, len(right), step)
        ]
        x = np.concatenate([p[0] for p in pairs] + [p[1] for p in pairs])
        y = np.concatenate([p[1] for p in pairs] + [p[0] for p in pairs])
        if not len(x):
            return None
        rank = np.empty(len(self.raw), np.int64)
        rank[sorted(range(len(self.raw)), key=self.raw.__getitem__)] = np.arange(len(self.raw))
        order = np.lexsort((rank[y], -self.n[y], x))
        x, y = x[order], y[order]
        first = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
        words = pa.array(self.word, pa.string())
        return pa.table({
            "word": words.take(pa.array(x[first])),
            "n_near": pa.array(np.diff(np.append(first, len(x))), pa.int64()),
            "near_n": pa.array(self.n[y[first]], pa.int64()),
            "near": words.take(pa.array(y[first])),
        })


def _tiles(batches):
    """Tiles of whole cells from rows sorted by cell: large cells alone, small ones together."""
    names = ("a", "side", "cell", "lhs", "rhs", "word", "n")
    held: list[pa.Table] = []

    def rows(table: pa.Table) -> dict:
        return {
            c: np.asarray(column_of(table, c).to_pylist(), object) if c == "word"
            else np.asarray(column_of(table, c).to_numpy(zero_copy_only=False)) for c in names
        }

    def cut(table: pa.Table, last: bool):
        """Tiles of the whole cells of a table, and what may go on in the next."""
        cells = np.asarray(column_of(table, "cell"))
        edges = np.append(np.flatnonzero(np.append(True, cells[1:] != cells[:-1])), len(cells))
        if not last:
            edges = edges[:-1]
        k = 0
        while k + 1 < len(edges):
            m = k + 1
            while m + 1 < len(edges) and edges[m + 1] - edges[k] <= FEW:
                m += 1
            if edges[m] - edges[k] > 1:
                yield _Tile(rows(table.slice(edges[k], edges[m] - edges[k])))
            k = m
        held[:] = [] if last else [table.slice(edges[-1])]

    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        if sum(t.num_rows for t in held) >= FEW:
            yield from cut(pa.concat_tables(held).combine_chunks(), False)
    if sum(t.num_rows for t in held):
        yield from cut(pa.concat_tables(held).combine_chunks(), True)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, near_n, near) of each word (word, n) that has near ones: their number and
    the most frequent one, of equally frequent ones the first by code points."""
    arrow_settings(words.sparkSession)

    def compare(batches):
        for tile in _tiles(batches):
            table = tile.found()
            if table is not None:
                yield from table.to_batches()

    cells = _cells(words).repartition("a", "side", "cell").sortWithinPartitions("a", "side", "cell")
    parts = cells.mapInArrow(compare, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_best")).select(
        "word", "n_near", (-F.col("_best.less")).alias("near_n"), F.col("_best.near").alias("near"))


def _last(links: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of links (word, form) from each word.

    A form is more frequent than its word, so chains end; every round doubles the steps taken.
    """
    now = store(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        joined = now.join(ahead, "root", "left")
        moved = store(joined.select(
            "word", F.coalesce("_next", "root").alias("root"),
            F.col("_next").isNotNull().alias("_moved")), "roots")
        now = moved.select("word", "root")
        if moved.where("_moved").isEmpty():
            return now


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Of each word of a table (word, n): form, root, n, n_near and form_n.

    form is the near word of largest n (ties: the first by code points) if it occurs at least
    ``ratio`` times as often, else null; root is the end of the forms' chain, the word itself
    where there is none. Words must be distinct and made of code points up to U+00FF. An empty
    table gives an empty one.
    """
    words = store(words.select("word", "n"), "words")
    often = F.col("near_n") >= ratio * F.col("n")
    forms = store(words.join(near_words(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(often, F.col("near")).alias("form"), F.when(often, F.col("near_n")).alias("form_n"),
    ), "forms")
    roots = _last(forms.where("form is not null"))
    return forms.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""Language identification by prediction by partial matching.

For each language a tree of byte contexts up to ``order`` bytes is counted. A symbol seen in
a context costs -log2(c / (n + d)) bits there, an unseen one costs the escape d / (n + d) and
goes on with the next shorter context, without the symbols already ruled out (n symbols, d
different ones); under all contexts every byte that is left is alike. The statistics are
frozen after training, so the code length of each symbol after each context is a table, and a
text's code length is a sum over its bytes.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_settings
from tidemark.llm.words import blocks, column_of, text_bytes
from tidemark.session import store

#: Most documents for each language that the trees are counted from.
TRAIN_DOCS = 400
ORDER = 3
START = 10  # a text counts as following line feeds
UNIT = 65536  # code lengths are whole numbers of 1/65536 bit, so that sums are exact
UNKNOWN = "und"
SLACK = 256  # bits that a short text may take beyond its own
#: Bytes of the sample that one task counts.
TASK = 16_000_000
#: Bytes of text that are scored at once; workers stay small beside the stages that follow.
PART = 1_000_000


@dataclass
class Model:
    languages: list[str]
    symbol: np.ndarray  # of each byte; the last symbol stands for all bytes not learned
    node: np.ndarray  # of each run of three symbols: its longest known context
    cost: np.ndarray  # [node * symbols + symbol, language]


def training_sample(labelled: DataFrame, most: int = TRAIN_DOCS) -> DataFrame:
    """(lang, text) of up to ``most`` documents of each language: those whose id's md5 is
    smallest, so any part of a table is as likely. Rows with equal ids count once (the
    smallest text). Only the ids are ranked, and each task keeps ``most`` of a language."""
    known = labelled.where("lang is not null and text is not null").select(
        "lang", "text", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("_key")
    )
    def first(keys, *groups):
        rank = F.row_number().over(Window.partitionBy(*groups).orderBy("_key"))
        return keys.withColumn("_rank", rank).where(F.col("_rank") <= most).drop("_rank")

    # Within slices of a language first, so no task sees all of a common one's ids.
    ids = known.select("lang", "_key", F.substring("_key", 1, 2).alias("_slice")).distinct()
    cut = store(  # a written table: its size is known, so a few languages are broadcast
        first(first(ids, "lang", "_slice"), "lang").groupBy("lang").agg(F.max("_key").alias("_cut")),
        "sample",
    )
    chosen = known.join(cut, "lang").where(F.col("_key") <= F.col("_cut"))
    return chosen.groupBy("lang", "_key").agg(F.min("text").alias("text")).select("lang", "text")


def _padded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes with ``ORDER`` start bytes before each text, and the texts' places."""
    data, at = text_bytes(texts)
    n = len(at) - 1
    out = np.full(len(data) + ORDER * n, START, np.uint8)
    starts = at[:-1] + ORDER * np.arange(1, n + 1)
    ends = starts + np.diff(at)
    inside = np.ones(len(out), bool)
    inside[(starts[:, None] - np.arange(1, ORDER + 1)).ravel()] = False
    out[inside] = data
    return out, starts, ends


def gathered(sample: DataFrame) -> DataFrame:
    """The sample, written and read in as many tasks as its bytes ask for, however many
    partitions it came in: every task lists the runs that it finds."""
    stored = store(sample, "sample-texts")
    size = stored.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return stored.coalesce(-(-int(size) // TASK) or 1)


def gram_counts(sample: DataFrame) -> DataFrame:
    """(lang, gram, n): how often each run of ORDER + 1 bytes occurs, big end first."""
    arrow_settings(sample.sparkSession)

    def count(batches):
        for table in blocks(batches, "text"):
            langs = np.asarray(column_of(table, "lang").to_pylist(), object)
            for lang in dict.fromkeys(langs):
                rows = pa.array(np.flatnonzero(langs == lang))
                data, starts, ends = _padded(column_of(table.take(rows), "text"))
                code = np.zeros(max(len(data) - ORDER, 0), np.int64)
                for j in range(ORDER + 1):
                    code = (code << 8) | data[j : j + len(code)]
                whole = np.zeros(len(code) + 1, np.int64)  # no run may reach into a next text
                np.add.at(whole, starts - ORDER, 1)
                np.add.at(whole, np.maximum(ends - ORDER, starts - ORDER), -1)
                grams, n = np.unique(code[np.cumsum(whole[:-1]) > 0], return_counts=True)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(grams), pa.string()), "gram": grams, "n": n,
                })

    return (
        gathered(sample).mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )


def _bits(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(whole, 1e-300)) - np.log2(np.maximum(part, 1e-300))


def _costs(counts: list[np.ndarray], parents: list[np.ndarray]) -> list[np.ndarray]:
    """Code lengths in bits for one language: for each order an array [context, symbol].

    ``counts[k]`` are the symbols' counts after the contexts of k bytes, ``parents[k]`` the
    place of each context's shorter form. The last symbol is never counted.
    """
    seen = counts[0] > 0
    left = np.full_like(counts[0], np.log2(max(256 - int(seen.sum()), 1)), float)
    out = []
    for k, c in enumerate(counts):
        seen = c > 0
        n, d = c.sum(axis=1, keepdims=True), seen.sum(axis=1, keepdims=True)
        if k:
            up = parents[k]
            above, known = counts[k - 1][up], counts[k - 1][up] > 0
            rest = known & ~seen
            m, e = (above * rest).sum(axis=1, keepdims=True), rest.sum(axis=1, keepdims=True)
            escape = np.where(e > 0, _bits(e, m + e), 0.0)
            tail = np.where(rest, _bits(above, m + e), escape + left[up])
        else:
            tail = left
        cost = np.where(seen, _bits(c, n + d), np.where(n > 0, _bits(d, n + d), 0.0) + tail)
        out.append(np.where(n > 0, cost, out[k - 1][parents[k]]) if k else cost)
        left = tail if not k else np.where(n > 0, tail, left[parents[k]])
    return out


def build(langs: np.ndarray, grams: np.ndarray, n: np.ndarray) -> Model:
    """The frozen tables from all counted runs of bytes."""
    languages = sorted(set(langs))
    octets = np.stack([(grams >> (8 * (ORDER - j))) & 255 for j in range(ORDER + 1)])
    known = np.unique(octets[:, : len(grams)]) if len(grams) else np.zeros(0, np.int64)
    size = len(known) + 1
    symbol = np.full(256, size - 1, np.int32)
    symbol[known] = np.arange(size - 1)
    runs = symbol[octets]
    contexts, parents, code = [], [np.zeros(1, np.int64)], np.zeros(len(grams), np.int64)
    codes = [code]
    for k in range(1, ORDER + 1):
        code = code + runs[ORDER - k].astype(np.int64) * size ** (k - 1)
        codes.append(code)
    contexts = [np.unique(c) for c in codes]
    for k in range(1, ORDER + 1):
        parents.append(np.searchsorted(contexts[k - 1], contexts[k] % size ** (k - 1)))
    tables = []
    for lang in languages:
        own = langs == lang
        counts = []
        for k in range(ORDER + 1):
            c = np.zeros((max(len(contexts[k]), 1), size))
            where = np.searchsorted(contexts[k], codes[k][own])
            np.add.at(c, (where, runs[ORDER][own]), n[own])
            counts.append(c)
        tables.append(np.concatenate(_costs(counts, parents)))
    first = np.cumsum([0] + [max(len(c), 1) for c in contexts])
    node = np.zeros(1, np.int32)
    for k in range(1, ORDER + 1):
        node = np.tile(node, size)
        node[contexts[k]] = first[k] + np.arange(len(contexts[k]))
    cost = np.stack(tables, axis=-1) if tables else np.zeros((1, size, 0))
    cost = np.rint(cost * UNIT).astype(np.int32).reshape(cost.shape[0] * size, len(languages))
    return Model(languages, symbol, node, cost)


def train(labelled: DataFrame, most: int = TRAIN_DOCS) -> Model:
    """The model of a table with doc_id, text and lang, from :func:`training_sample`.

    Only the counts of the sample's byte runs reach the driver; they grow with ``most`` and
    the number of languages, not with the table.
    """
    counts = gram_counts(training_sample(labelled, most)).toArrow()
    return build(
        np.asarray(counts["lang"].to_pylist(), object),
        np.asarray(counts["gram"], np.int64), np.asarray(counts["n"], np.float64),
    )


def code_lengths(model: Model, texts: pa.Array, step: int = 250_000) -> np.ndarray:
    """[text, language]: whole code lengths in 1/UNIT bit, from a slice of bytes at a time."""
    data, starts, ends = _padded(texts)
    size = len(model.cost) // (int(model.node.max()) + 1)
    total = np.zeros((len(starts), len(model.languages)), np.int64)
    for i in range(ORDER, len(data), step):
        j = min(i + step, len(data))
        run = model.symbol[data[i - ORDER : j]]
        code = np.zeros(j - i, np.int32)
        for k in range(ORDER):
            code = code * np.int32(size) + run[k : k + j - i]
        costs = model.cost.take(model.node.take(code) * np.int32(size) + run[ORDER:], axis=0)
        lo, hi = np.searchsorted(ends, i, "right"), np.searchsorted(starts, j, "left")
        a, b = np.maximum(starts[lo:hi], i) - i, np.minimum(ends[lo:hi], j) - i
        some = np.flatnonzero(b > a)
        if len(some):
            cuts = np.stack([a[some], b[some]], axis=1).ravel()
            costs = np.concatenate([costs, np.zeros((1, costs.shape[1]), np.int32)])
            sums = np.add.reduceat(costs, cuts, axis=0, dtype=np.int64)[::2]
            total[lo + some] += sums
    return total


def plausible(texts: pa.Array, shortest: np.ndarray) -> np.ndarray:
    """Whether each text's shortest code is no longer than its bytes as they are, eight bits each
    and ``SLACK`` in all. A text in none of the learned languages, or of random letters, takes
    more: it would be shorter without a model."""
    _, at = text_bytes(texts)
    return shortest <= (8 * np.diff(at) + SLACK) * UNIT


def predict(
    model: Model, texts: pa.Array, lengths: np.ndarray | None = None
) -> tuple[list[str], np.ndarray]:
    """The language of each text and the probability of it, if all are as likely before."""
    letter = regex.compile(r"\p{L}").search
    readable = np.array([bool(t) and letter(t) is not None for t in texts.to_pylist()], bool)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    lengths = code_lengths(model, texts) if lengths is None else lengths
    best = lengths.argmin(axis=1)
    more = (lengths - lengths.min(axis=1, keepdims=True)) / UNIT
    score = np.where(readable, 1 / np.exp2(-np.minimum(more, 1000)).sum(axis=1), 0.0)
    return [model.languages[b] if r else UNKNOWN for b, r in zip(best, readable)], score


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of each row's whole text.

    Null texts and texts without a letter are ``und`` with score 0, as is everything under a
    model that learned nothing. Ties go to the first language by name. Repeated rows come out
    as often as they go in, other columns are not read.
    """
    spark = arrow_settings(docs.sparkSession)
    shared = spark.sparkContext.broadcast(tuple(vars(model).values()))

    def run(batches):
        model = Model(*shared.value)
        for table in blocks(batches, "text", PART):
            found, score = predict(model, column_of(table, "text"))
            yield from pa.table({
                "doc_id": column_of(table, "doc_id").cast(pa.int64()),
                "lang_pred": pa.array(found, pa.string()), "score": score,
            }).to_batches()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, unchanged, that have a language with at least ``least`` and whose
    code under it is not longer than the text itself; see :func:`plausible`."""
    spark = arrow_settings(docs.sparkSession)
    shared = spark.sparkContext.broadcast(tuple(vars(model).values()))

    def run(batches):
        model = Model(*shared.value)
        for table in blocks(batches, "text", PART):
            texts = column_of(table, "text")
            lengths = code_lengths(model, texts)
            found, score = predict(model, texts, lengths)
            keep = (np.array(found, object) != UNKNOWN) & (score >= least)
            if model.languages:
                keep &= plausible(texts, lengths.min(axis=1))
            yield from table.filter(pa.array(keep.astype(bool))).to_batches()

    return docs.mapInArrow(run, docs.schema)

"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded from counts of its bytes and words;
a gated attention network learns from the documents' labels alone which passages matter and
scores the weighted sum of their codes.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_settings
from tidemark.llm.words import (
    blocks, column_of, find_words, mix, room_left, run_hashes, text_bytes, word_hashes,
)

#: Words in a passage; the last one of a text may be shorter.
PASSAGE = 64
#: Most labelled documents that the network is fitted on, and most passages of one of them;
#: longer documents are not learned from, but scored like all others. Together at most 361 MB.
TRAIN_DOCS = 6000
TRAIN_PASSAGES = 320
WORD_BINS = 32
RUN = 4
CODE, GATE = 32, 16
EPOCHS, BATCH, RATE, DECAY = 30, 64, 0.005, 1e-5

#: Bytes that are counted together.
KINDS = ["#*$%&|<>", "!?", ".,;:", "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "\n", "(){}[]=/\\\"'_+-@"]


def _seen_before(owner: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether an equal key comes earlier with the same owner."""
    marked = mix(keys + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(marked, kind="stable")
    out = np.zeros(len(keys), bool)
    out[order[1:]] = marked[order[1:]] == marked[order[:-1]]
    return out


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One row for each passage, and for each text the index of its first passage. A text
    without words has one empty passage."""
    data, at = text_bytes(texts)
    starts, ends, first = find_words(data, at)
    n = np.diff(first)
    count = np.maximum(-(-n // PASSAGE), 1)
    edge = np.append(0, np.cumsum(count))
    text = np.repeat(np.arange(len(n)), n)
    passage = edge[:-1][text] + (np.arange(len(starts)) - first[:-1][text]) // PASSAGE
    total = int(edge[-1])
    words = word_hashes(data, starts, ends)
    # A passage's bytes reach from its first word to the next passage's.
    begins = np.full(total, len(data), np.int64)
    np.minimum.at(begins, passage, starts)
    holder = np.repeat(np.arange(len(count)), count)
    begins = np.minimum(begins, at[1:][holder])
    sizes = np.append(begins[1:], at[-1]) - begins
    sizes = np.where(np.arange(total) == edge[1:][holder] - 1, at[1:][holder] - begins, sizes)
    kind = np.zeros(256, np.int64)
    for i, chars in enumerate(KINDS):
        kind[np.frombuffer(chars.encode(), np.uint8)] = i + 1
    kind[128:] = len(KINDS) + 1
    kinds = len(KINDS) + 2
    where = np.repeat(np.arange(total), sizes)
    own = np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    bytes_ = np.bincount(where * kinds + kind[data[own]], minlength=total * kinds)
    bytes_ = bytes_.reshape(total, kinds)[:, 1:]

    def per(values=None):
        return np.bincount(passage, weights=values, minlength=total)

    word_count = per()
    some = np.maximum(word_count, 1)
    length = (ends - starts).astype(float)
    mean = per(length) / some
    spread = np.sqrt(np.maximum(per(length**2) / some - mean**2, 0))
    run_text, run_at = room_left(first, RUN)
    looped = np.zeros(len(starts))
    if len(run_at):
        looped[run_at] = _seen_before(run_text, run_hashes(words, RUN)[run_at])
    stutter = np.zeros(len(starts))
    stutter[1:] = (words[1:] == words[:-1]) & (text[1:] == text[:-1])
    bins = np.bincount(
        passage * WORD_BINS + (words % np.uint64(WORD_BINS)).astype(np.int64),
        minlength=total * WORD_BINS,
    ).reshape(total, WORD_BINS)
    out = np.column_stack([
        np.log1p(word_count), np.log1p(n[holder]), mean, spread,
        per(_seen_before(passage, words)) / some, per(looped) / some, per(stutter) / some,
        np.sqrt(bytes_ / np.maximum(sizes, 1)[:, None]),
        np.sqrt(bins / some[:, None]),
    ])
    return out.astype(np.float32), edge


@dataclass
class Model:
    centre: np.ndarray
    scale: np.ndarray
    encode: np.ndarray
    encode_0: np.ndarray
    value: np.ndarray
    gate: np.ndarray
    weight: np.ndarray
    out: np.ndarray
    out_0: np.ndarray


def _forward(model: Model, x: np.ndarray, edge: np.ndarray):
    bag = np.repeat(np.arange(len(edge) - 1), np.diff(edge))
    h = np.tanh(x @ model.encode + model.encode_0)
    t, g = np.tanh(h @ model.value), 1 / (1 + np.exp(-(h @ model.gate)))
    e = (t * g) @ model.weight
    e = np.exp(e - np.maximum.reduceat(e, edge[:-1])[bag])
    a = e / np.add.reduceat(e, edge[:-1])[bag]
    z = np.add.reduceat(a[:, None] * h, edge[:-1], axis=0)
    logit = np.clip(z @ model.out + model.out_0, -30, 30)
    return bag, h, t, g, a, z, 1 / (1 + np.exp(-logit))


def _gradient(model: Model, x: np.ndarray, edge: np.ndarray, y: np.ndarray) -> dict:
    bag, h, t, g, a, z, p = _forward(model, x, edge)
    dl = (p - y) / len(y)
    dz = np.outer(dl, model.out)[bag]
    da = (h * dz).sum(axis=1)
    de = a * (da - np.add.reduceat(a * da, edge[:-1])[bag])
    dt = np.outer(de, model.weight) * g * (1 - t * t)
    dg = np.outer(de, model.weight) * t * g * (1 - g)
    dh = (a[:, None] * dz + dt @ model.value.T + dg @ model.gate.T) * (1 - h * h)
    return {
        "encode": x.T @ dh, "encode_0": dh.sum(axis=0), "value": h.T @ dt, "gate": h.T @ dg,
        "weight": (t * g).T @ de, "out": z.T @ dl, "out_0": np.array(dl.sum()),
    }


def fit(bags: list[np.ndarray], labels: np.ndarray) -> Model:
    """The network for bags of passage rows and their labels (0 or 1), by Adam from a fixed
    seed. Without bags all scores are one half."""
    width = bags[0].shape[1] if bags else len(features(pa.array([""]))[0][0])
    rng = np.random.default_rng(0)

    def start(*shape):
        return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

    count = max(1, sum(map(len, bags)))
    centre = sum((bag.sum(axis=0, dtype=float) for bag in bags), np.zeros(width)) / count
    spread = np.sqrt(sum((((bag - centre) ** 2).sum(axis=0) for bag in bags), np.zeros(width)) / count)
    model = Model(
        centre, np.maximum(spread, 1e-3), start(width, CODE),
        np.zeros(CODE), start(CODE, GATE), start(CODE, GATE), start(GATE), np.zeros(CODE),
        np.zeros(()),
    )
    if not bags:
        return model
    share = np.clip(labels.mean(), 0.01, 0.99)
    model.out_0 = np.array(np.log(share / (1 - share)))
    step, moments = 0, {}
    for epoch in range(EPOCHS):
        order = rng.permutation(len(bags))
        rate = RATE * (1 - epoch / EPOCHS)
        for i in range(0, len(order), BATCH):
            own = order[i : i + BATCH]
            edge = np.append(0, np.cumsum([len(bags[j]) for j in own]))
            x = (np.concatenate([bags[j] for j in own]) - model.centre) / model.scale
            step += 1
            for name, d in _gradient(model, x, edge, labels[own]).items():
                value = getattr(model, name)
                d = d + DECAY * value
                m, v = moments.get(name, (0.0, 0.0))
                m, v = 0.9 * m + 0.1 * d, 0.999 * v + 0.001 * d * d
                moments[name] = m, v
                unbiased = m / (1 - 0.9**step), v / (1 - 0.999**step)
                setattr(model, name, value - rate * unbiased[0] / (np.sqrt(unbiased[1]) + 1e-8))
    return model


def score(model: Model, texts: pa.Array) -> np.ndarray:
    """The probability of label 1 for each text."""
    x, edge = features(texts)
    return _forward(model, (x - model.centre) / model.scale, edge)[-1]


def training_bags(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> DataFrame:
    """(doc_id, label, passages, rows) of up to ``most`` labelled documents: those whose id's
    md5 is smallest. Rows with null ids or labels teach nothing; of several labels of an id
    the smallest counts, of several texts likewise."""
    arrow_settings(docs.sparkSession)
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").cast("double").alias("label")
    )
    chosen = known.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(most)
    texts = docs.select("doc_id", "text").join(chosen, "doc_id").groupBy("doc_id", "label").agg(
        F.min("text").alias("text")
    )

    def encode(batches):
        for table in blocks(batches, "text"):
            x, edge = features(column_of(table, "text"))
            n = np.diff(edge)
            keep = np.flatnonzero(n <= TRAIN_PASSAGES)
            rows = [x[edge[i] : edge[i + 1]].tobytes() for i in keep]
            yield from table.select(["doc_id", "label"]).take(pa.array(keep)).append_column(
                "rows", pa.array(rows, pa.binary())).to_batches()

    return texts.mapInArrow(encode, "doc_id long, label double, rows binary")


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> Model:
    """The model of a bounded sample of labelled documents; only its rows reach the driver."""
    sample = training_bags(docs, labels, most).orderBy("doc_id").toArrow()
    width = len(features(pa.array([""]))[0][0])
    bags = [np.frombuffer(x.as_buffer(), np.float32).reshape(-1, width) for x in sample["rows"]]
    return fit(bags, np.asarray(sample["label"].to_pylist(), float))


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of each row's whole text; higher: label 1 likelier.

    Null and empty texts are scored as one empty passage. Repeated rows come out as often as
    they go in, other columns are not read.
    """
    arrow_settings(docs.sparkSession)
    weights = tuple(vars(model).values())

    def run(batches):
        own = Model(*weights)
        for table in blocks(batches, "text"):
            yield from pa.table({
                "doc_id": column_of(table, "doc_id").cast(pa.int64()),
                "score": score(own, column_of(table, "text")).astype(np.float64),
            }).to_batches()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")

"""SimHash near-duplicates by deletion-variant signatures."""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LAST_ID, arrow_settings, nest, unnest
from tidemark.llm.components import components
from tidemark.llm.words import (
    blocks, column_of, find_words, joined_words, lower_table, text_bytes,
)
from tidemark.session import store

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: Bytes of text whose shingles are hashed at once.
PART = 2_000_000


def _votes(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each run of hashes from ``first[i]`` on, the 64 bits set in over half of them.

    Bits are counted eight at a time in the bytes of one number: runs are cut into pieces of
    at most 255 hashes, so no byte overflows.
    """
    lanes = ((np.arange(256, dtype=np.uint64)[:, None] >> np.arange(8, dtype=np.uint64)) & 1)
    lanes = (lanes << (8 * np.arange(8, dtype=np.uint64))).sum(axis=1, dtype=np.uint64)
    counts = np.diff(np.append(first, len(hashes)))
    pieces = -(-counts // 255)
    run = np.repeat(np.arange(len(first)), pieces)
    within = np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    cuts = first[run] + 255 * within
    of_run = np.cumsum(pieces) - pieces
    octets = hashes.view(np.uint8).reshape(-1, 8)
    out = np.zeros(len(first), np.uint64)
    for byte in range(8):
        sums = np.add.reduceat(lanes[octets[:, byte]], cuts).view(np.uint8).reshape(-1, 8)
        ones = np.add.reduceat(sums, of_run, axis=0, dtype=np.int64)
        bits = (2 * ones > counts[:, None]).astype(np.uint64)
        place = (8 * byte + np.arange(8)).astype(np.uint64)
        out |= (bits << place).sum(axis=1, dtype=np.uint64)
    return out


def _fingerprints(texts: pa.Array, shingle: int, seed: int) -> np.ndarray:
    data, at = text_bytes(texts)
    data = lower_table()[data]
    starts, ends, first = find_words(data, at)
    joined, place = joined_words(data, starts, ends)
    raw = joined.tobytes()
    n = np.diff(first)
    count = np.where(n == 0, 0, np.maximum(n - shingle + 1, 1))
    text = np.repeat(np.arange(len(n)), count)
    of_text = np.cumsum(count) - count
    word = np.arange(len(text)) - of_text[text] + first[:-1][text]
    last = np.minimum(word + shingle, first[1:][text])
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(raw[a:b], seed) for a, b in zip(place[word].tolist(), (place[last] - 1).tolist())),
        np.uint64, len(text),
    )
    out = np.zeros(len(n), np.uint64)
    some = count > 0
    if some.any():
        out[some] = _votes(hashes, of_text[some])
    return out.view(np.int64)


def with_fingerprints(
    docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, carry: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``carry`` and ``fp`` (long) of each row's whole ``text``.

    A-Z become lower case; shingles of ``shingle`` words, joined by spaces, are hashed with
    XXH64 under ``seed``, repeats included. Fewer words make one shorter shingle. A bit is set
    if more than half of the hashes have it; a text without words, or null, has 0.
    """
    arrow_settings(docs.sparkSession)
    rows = docs.select(*carry, "text")
    schema = rows.drop("text").schema.add("fp", "long")

    def fingerprint(batches):
        for table in blocks(batches, "text", PART):
            marks = _fingerprints(column_of(table, "text"), shingle, seed)
            done = table.drop_columns(["text"]).append_column("fp", pa.array(marks))
            yield from done.to_batches()

    return rows.mapInArrow(fingerprint, schema)


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of the fewest segments of which one must differ by at most one bit
    when the whole differs by at most ``max_bits``: one more than half of them."""
    n = max_bits // 2 + 1
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _mask(first: int, width: int) -> int:
    return _signed(((1 << width) - 1) << first)


def _variants(fp: Column, cuts: list[tuple[int, int]]) -> Column:
    """One struct for each segment and wildcard bit: the segment without that bit."""
    return F.array(*[
        F.struct(
            F.lit(first + bit).alias("wild"),
            fp.bitwiseAND(F.lit(_mask(first, width) & ~_signed(1 << (first + bit)))).alias("rest"),
        )
        for first, width in cuts for bit in range(width)
    ])


def one_bit_links(nodes: DataFrame) -> DataFrame:
    """(a, b): the ``node`` of each two rows whose distinct ``fp`` differ by one bit. Without
    that bit they are equal, and no third one is, so pairs need no join."""
    listed = nodes.select("node", F.explode(_variants(F.col("fp"), [(0, 64)])).alias("v"))
    return listed.groupBy("v.wild", "v.rest").agg(
        F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("a", "b")


def fingerprint_links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): the ``node`` of each two rows whose ``fp`` differ by at most ``max_bits`` bits;
    of those with the same value in a column ``known``, none.

    ``fp`` must be distinct. Each fingerprint is listed under all its one-wildcard segments;
    two that are close enough share a listing, found by an equality join in which the
    distance is verified. A pair counts only at the first listing that it shares, so it comes
    out once.
    """
    cuts = segments(max_bits)
    if "known" not in nodes.columns:
        nodes = nodes.withColumn("known", F.col("fp"))
    listed = nodes.select(
        "node", "fp", "known", F.explode(_variants(F.col("fp"), cuts)).alias("v")
    ).select("node", "fp", "known", F.col("v.wild").alias("wild"), F.col("v.rest").alias("rest"))
    a, b = listed.alias("a"), listed.alias("b")
    differ = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    parts = [differ.bitwiseAND(F.lit(_mask(*cut))) for cut in cuts]
    close = [F.bit_count(part) <= 1 for part in parts]
    at = F.lit(None).cast("int")
    for (first, _), part, near in reversed(list(zip(cuts, parts, close))):
        only = F.when(part == 0, F.lit(first))
        for bit in range(first, first + _):
            only = only.when(part == F.lit(_signed(1 << bit)), F.lit(bit))
        at = F.when(near, only).otherwise(at)
    return a.join(
        b,
        (F.col("a.wild") == F.col("b.wild")) & (F.col("a.rest") == F.col("b.rest"))
        & (F.col("a.fp") < F.col("b.fp")) & (F.bit_count(differ) <= max_bits)
        & (F.col("a.wild") == at) & (F.col("a.known") != F.col("b.known")),
    ).select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))


def with_components(marked: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Adds ``component_id`` to rows with ``doc_id`` and ``fp``: the smallest id reachable
    over links between fingerprints. A null id counts as the largest one and comes last.

    Fingerprints one bit apart are joined first. In a dense crowd nearly all are connected by
    that, and of the other links only those between its groups are listed, not every pair."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))
    nodes = store(marked.groupBy("fp").agg(F.min(key).alias("lowest")), "fingerprints")
    marks = nodes.select("fp", F.col("fp").alias("node"))  # ids may be null or repeated
    if max_bits:
        first = store(components(one_bit_links(marks)), "groups")
        known = F.coalesce("component", "node").alias("known")
        grouped = store(marks.join(first, "node", "left").select("node", "fp", known), "known")
        links = fingerprint_links(grouped, max_bits).unionByName(first.select(
            F.col("node").alias("a"), F.col("component").alias("b")))
        joined = store(components(links).withColumnRenamed("node", "fp").join(nodes, "fp"), "groups")
        least = joined.groupBy("component").agg(F.min("lowest").alias("_least"))
        groups = joined.join(least, "component").select("fp", "_least")
        nodes = nodes.join(groups, "fp", "left")
    else:
        nodes = nodes.withColumn("_least", F.col("lowest"))
    named = nodes.select(F.col("fp").alias("_fp"), F.coalesce("_least", "lowest").alias("_component"))
    return marked.join(named, F.col("fp") == F.col("_fp")).drop("_fp").withColumnRenamed(
        "_component", "component_id"
    )


def near_duplicate_groups(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of each row.

    Fingerprints as in :func:`with_fingerprints`; texts whose fingerprints differ by at most
    ``max_bits`` bits are linked, copies share a fingerprint. Repeated rows come out as often
    as they go in, an empty table gives an empty one, other columns are not read. A null
    doc_id comes out null; its component_id is null only if no known id is reachable.
    """
    marked = store(with_fingerprints(docs, shingle), "marked")
    return with_components(marked, max_bits).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("component_id") < LAST_ID, F.col("component_id")).alias("component_id"),
    )


def keep_first(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group the row with the smallest
    doc_id stays (ties: the smallest text hash; equal rows: one)."""
    rows = nest(docs).withColumn("text", F.col("row.text")).withColumn("doc_id", F.col("_d"))
    marked = store(with_fingerprints(rows, shingle, carry=("doc_id", "_t")), "marked")
    first = with_components(marked, max_bits).groupBy("component_id").agg(
        F.min(F.struct("doc_id", "_t")).alias("_first")
    ).select(F.col("_first.doc_id").alias("_d"), F.col("_first._t").alias("_t"))
    once = nest(docs).join(first, ["_d", "_t"], "left_semi").dropDuplicates(["_d", "_t"])
    return unnest(once, docs.columns)

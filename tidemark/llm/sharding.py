"""Proportional stratified interleaving into shards. DataFrame operations only."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import position
from tidemark.session import store

SHARDS = 16
SEED = 20
#: Slices that a source, and then the whole order, is ranked in.
BUCKETS = 4096


def shuffle_key(seed: int = SEED) -> Column:
    """Thirty-two hex digits by which a source's rows are shuffled; a null id is empty text."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def interleave(
    rows: DataFrame, ties: list[str], shards: int = SHARDS, seed: int = SEED,
) -> DataFrame:
    """``rows`` (with doc_id and source) plus shard and slot.

    Within each source rows are shuffled under the seed and ranked; (rank - 1/2) / size is
    where a row stands in its source. Sorted by that (ties: by source, then the shuffle), the
    rows are cut into ``shards`` runs whose counts differ by at most one, so that each shard
    holds each source in proportion. ``slot`` is the place in the shard, without gaps.

    Rows travel whole: pass only the columns that you need. Equal doc_ids of a source are
    ordered by the columns ``ties``; rows equal in those too are alike. A null source is a
    source of its own. Needs no column of another name, and an empty table gives an empty one.
    """
    columns = rows.columns
    nested = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("_s"),
        shuffle_key(seed).alias("_k"),
    )
    last = [F.col(f"row.`{c}`") for c in ties]
    slice_ = F.conv(F.substring("_k", 1, 3), 16, 10).cast("int")
    ranked = position(nested, ["_s"], slice_, [F.col("_k"), *last], "_rank")
    sizes = nested.groupBy("_s").agg(F.count(F.lit(1)).alias("_size"))
    placed = store(ranked.join(sizes, "_s").withColumn(
        "_at", (F.col("_rank") + 0.5) / F.col("_size")), "ranks")
    total = placed.agg(F.count(F.lit(1)).alias("_total"))
    ordered = position(
        placed.withColumn("_all", F.lit(0)), ["_all"],
        F.floor(F.col("_at") * BUCKETS).cast("int"), [F.col("_at"), F.col("_s"), F.col("_k"), *last],
        "_place",
    ).join(total)
    shard = F.expr(f"_place * {shards} div _total")
    first = F.expr(f"(_shard * _total + {shards - 1}) div {shards}")
    return ordered.withColumn("_shard", shard).select(
        *[F.col(f"row.`{c}`").alias(c) for c in columns],
        F.col("_shard").cast("int").alias("shard"), (F.col("_place") - first).alias("slot"),
    )

"""Keys, ranks and settings that several operators share."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of text sent to a Python worker at once; a batch stays a few megabytes.
ARROW_ROWS = 1000
LAST_ID = 2**63 - 1
#: Most bytes of a written table that is broadcast to avoid moving the texts.
SMALL_BYTES = 64_000_000


def arrow_settings(spark: SparkSession) -> SparkSession:
    """Keep the batches that travel to Python workers small, whatever the texts' lengths."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def nest(docs: DataFrame) -> DataFrame:
    """Rows under one column ``row``, so that no helper column can clash with theirs.

    ``_d`` is the id (a null id counts as the largest) and ``_t`` a hash of the text;
    rows equal in both count as one document and get the same verdict.
    """
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("_d"),
        F.xxhash64("text").alias("_t"),
    )


def unnest(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns under ``row`` again."""
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in columns])


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of a column's text, modulo ``modulus``; a null counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


def position(
    df: DataFrame, groups: list[str], bucket: Column, order: list[Column], name: str
) -> DataFrame:
    """Adds each row's place (from 0) in its group, sorted by ``bucket`` and then ``order``.

    A group is numbered bucket by bucket and the buckets' sizes are summed up apart, so a
    group of any size spreads over as many tasks as it has buckets. ``bucket`` must rise with
    the wanted order; ``groups`` must not be null.
    """
    rows = df.withColumn("_bucket", bucket)
    keys = [*groups, "_bucket"]
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size")).select(
        *keys, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy(*keys).orderBy(*order)
    return (
        rows.withColumn("_inside", F.row_number().over(inside))
        .join(starts, keys)
        .withColumn(name, F.col("_start") + F.col("_inside") - 1)
        .drop("_bucket", "_inside", "_start")
    )


def small(df: DataFrame, column: str | None = None, width: int = 0) -> DataFrame:
    """A written table ``df`` for a join with texts: broadcast if it takes at most
    ``SMALL_BYTES``, so that the texts stay where they are; otherwise both sides are shuffled.

    The size is counted: 64 bytes a row and ``width`` for each item of the arrays in
    ``column``.
    """
    items = F.lit(0) if column is None else F.coalesce(F.sum(F.size(column)), F.lit(0))
    rows, n = df.agg(F.count(F.lit(1)), items).first()
    return F.broadcast(df) if 64 * rows + width * n <= SMALL_BYTES else df


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)

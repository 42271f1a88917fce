"""Connected components of a graph of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import store


def _lowest(links: DataFrame) -> DataFrame:
    """For each node its smallest neighbour, itself included."""
    return links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); the component is the smallest
    node reachable.

    Alternates two steps until nothing changes. The first hangs every larger neighbour of a
    node onto its smallest one, the second every smaller neighbour. Both are one aggregation
    and one join on the node; a hub is reduced to its minimum before the shuffle, and Spark
    may split its rows in the join. Links that are null or lead to themselves count for
    nothing. Each round is a written table.
    """
    pairs = store(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_lowest(both), "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = store(large, "links")
        low = _lowest(large)
        small = (
            large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        small = store(small, "links")
        # A forest of stars: no node is both a leaf and a centre, no leaf has two centres.
        centres = small.select(F.col("v").alias("u")).distinct()
        nested = small.join(centres, "u", "left_semi").limit(1).count()
        twice = small.groupBy("u").count().where("count > 1").limit(1).count()
        pairs = small
        if not nested and not twice:
            break
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )

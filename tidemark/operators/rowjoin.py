"""Equi-join of a row-level table with a per-key table."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def row_join(rows: DataFrame, per_key: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on ``keys``; a NULL key is a key like any other.

    For tables in which one key may hold a large share of the rows. Spark splits skewed
    partitions only where both sides were shuffled for the join itself. Null-safe keys
    have that effect: an aggregated ``per_key`` side is not joined on the partitioning
    its aggregation left behind. Small sides are broadcast as usual.
    """
    renamed = per_key.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    joined = rows.join(renamed, reduce(Column.__and__, same, F.lit(True)), how)
    return joined.drop(*(f"_r_{k}" for k in keys))

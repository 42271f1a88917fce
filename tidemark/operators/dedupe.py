"""Deduplication and first-per-group selection."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.schemas import STATION_KEY


def first_per_group(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each group in the given order.

    Spark limits each group inside the map tasks before the shuffle, so a hot group
    sends one row per task and no group is ever sorted as a whole in one place.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def dedupe_station(df: DataFrame, order: list[Column | str] | None = None) -> DataFrame:
    """One row per station. Without an order all other columns decide, left to right,
    so the survivor never depends on row placement."""
    return first_per_group(df, [STATION_KEY], order or [c for c in df.columns if c != STATION_KEY])

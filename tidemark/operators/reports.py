"""Small reports over large tables."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from tidemark.operators.labels import label_shares
from tidemark.operators.stats import describe


def first_rows(df: DataFrame, order: list[Column | str], n: int = 5) -> DataFrame:
    """First ``n`` rows in order: each task keeps its own first ``n``, then these meet."""
    return df.orderBy(*order).limit(n)


def preview(
    df: DataFrame, order: list[Column | str], level: str, label: str, n: int = 5
) -> dict[str, Callable[[], DataFrame]]:
    """First rows, level distribution and label shares: three tables, each built on call."""
    return {
        "first_rows": lambda: first_rows(df, order, n),
        "distribution": lambda: describe(df, level),
        "label_shares": lambda: label_shares(df, label),
    }

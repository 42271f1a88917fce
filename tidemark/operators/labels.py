"""Label statistics: counts, most frequent label, shares."""

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.dedupe import first_per_group
from tidemark.schemas import STATION_KEY


def label_counts(df: DataFrame, label: str = "flood_risk") -> DataFrame:
    """Rows per station and label; rows without a label are not counted."""
    return df.where(F.col(label).isNotNull()).groupBy(STATION_KEY, label).agg(
        F.count("*").alias("n")
    )


def dominant_label(
    df: DataFrame, label: str = "flood_risk", name: str = "dominant_risk"
) -> DataFrame:
    """Most frequent label per station; ties go to the alphabetically first."""
    top = first_per_group(label_counts(df, label), [STATION_KEY], [F.desc("n"), F.asc(label)])
    return top.select(STATION_KEY, F.col(label).alias(name))


def label_shares(df: DataFrame, label: str = "flood_risk", digits: int = 3) -> DataFrame:
    """Share of each label among all labelled rows, most frequent first."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return (
        counts.withColumn("share", F.bround(F.col("n") / total, digits))
        .orderBy(F.desc("n"), label)
        .drop("n")
    )

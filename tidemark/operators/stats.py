"""Grouped statistics.

Every aggregate here has a partial phase that runs before the shuffle, so a station
that holds a large share of the rows reaches its reducer as one partial row per map
task, not as rows.
"""

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tidemark.operators.quantiles import grouped_quantiles
from tidemark.schemas import STATION_KEY

# Percentiles of a baseline, accuracy of the approximate form.
BASELINE_PERCENTILES = {"p05_level": 0.05, "median_level": 0.50, "p95_level": 0.95}
PERCENTILE_ACCURACY = 10000
MOMENTS = {"mean_level_total": "mean", "std_level_total": "std"}


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows, as a one-row table."""
    return df.agg(F.count("*").alias("n_rows"))


def mean_std(value: Column, mean_name: str, std_name: str) -> list[Column]:
    """Mean and sample deviation (NULL for a single row)."""
    return [F.avg(value).alias(mean_name), F.stddev_samp(value).alias(std_name)]


def station_daily(readings: DataFrame, more: Sequence[Column] = ()) -> DataFrame:
    """Facts per station and day, and ``more`` aggregates."""
    return readings.groupBy(STATION_KEY, "reading_date").agg(
        F.count("*").alias("n_readings_day"),
        *mean_std(F.col("value"), "mean_level_day", "std_level_day"), *more,
    )


def station_baseline(
    readings: DataFrame, min_max: bool = False, exact: bool = True
) -> DataFrame:
    """Long-term statistics per station; percentiles are observed values.

    By default the values are ranked exactly, hot stations split over many tasks (see
    :mod:`tidemark.operators.quantiles`), and all statistics come from one pass over the
    readings, which counts equal values. ``exact=False`` takes the approximate
    aggregate (rank error at most 1/10000, none up to 10000 rows), with all three
    percentiles off one sketch and no table written between. Each map task sends a sketch
    per station, and those of a hot station all meet in one task.
    """
    value = F.col("value")
    if exact:
        moments = {"n_readings_total": "rows", **MOMENTS}
        if min_max:
            moments |= {"min_level": "min", "max_level": "max"}
        return grouped_quantiles(
            readings, [STATION_KEY], "value", BASELINE_PERCENTILES, moments, interpolate=False)
    stats = [
        F.count("*").alias("n_readings_total"),
        *mean_std(value, "mean_level_total", "std_level_total"),
    ]
    if min_max:
        stats += [F.min(value).alias("min_level"), F.max(value).alias("max_level")]
    sketch = F.percentile_approx(value, list(BASELINE_PERCENTILES.values()), PERCENTILE_ACCURACY)
    rows = readings.groupBy(STATION_KEY).agg(*stats, sketch.alias("_percentiles"))
    return rows.withColumns(
        {name: F.col("_percentiles")[i] for i, name in enumerate(BASELINE_PERCENTILES)}
    ).drop("_percentiles")


def summary_stats(daily: DataFrame) -> DataFrame:
    """Count, mean, deviation and interpolated quantiles of ``level`` per station.

    NULL and NaN levels count as missing; a station without any level keeps its row.
    """
    level = F.nanvl(F.col("level"), F.lit(None).cast("double"))
    rows = daily.select(STATION_KEY, level.alias("level"))
    moments = {"n_readings_total": "count", **MOMENTS}
    return grouped_quantiles(rows, [STATION_KEY], "level", BASELINE_PERCENTILES, moments)


def describe(df: DataFrame, column: str) -> DataFrame:
    """Distribution of one column as one row: count, mean, std, min, quartiles, max."""
    value = F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))
    moments = {name: name for name in ("count", "mean", "std", "min", "max")}
    quartiles = {"p25": 0.25, "p50": 0.50, "p75": 0.75}
    rows = df.select(value.alias("value"))
    return grouped_quantiles(rows, [], "value", quartiles, moments).select(
        "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def count_sent(df: DataFrame, file_column: str = "file_path") -> DataFrame:
    """Messages per source file."""
    return df.groupBy(file_column).agg(F.count("*").alias("n_sent"))


def observe_sent(df: DataFrame, name: str | None = None) -> tuple[DataFrame, Observation]:
    """Count rows while another action runs, without a second pass.

    Read ``observation.get["n_sent"]`` after the action; without a name it gets one of its
    own. On a stream use
    ``df.observe`` with the same expression and read the query progress.
    """
    observation = Observation(name or f"sent-{uuid.uuid4().hex}")
    return df.observe(observation, F.count("*").alias("n_sent")), observation

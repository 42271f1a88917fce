"""Sliding event-time windows; the same function serves batch and stream."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.stats import mean_std
from tidemark.schemas import STATION_KEY
from tidemark.streaming.panes import windows_of_panes, windows_of_readings

# Default window geometry and lateness.
WINDOW_SIZE = "10 minutes"
WINDOW_SLIDE = "5 minutes"
WATERMARK_DELAY = "10 minutes"


def windowed_stats(
    events: DataFrame,
    size: str = WINDOW_SIZE,
    slide: str = WINDOW_SLIDE,
    delay: str = WATERMARK_DELAY,
) -> DataFrame:
    """Statistics per station and window ``[start, end)``, windows aligned to the epoch.

    All events are counted, also those without a value. On a stream the watermark
    closes windows and drops what arrives later than ``delay``; on a table it has no
    effect.
    """
    return (
        events.withWatermark("dateTime", delay)
        .groupBy(STATION_KEY, F.window("dateTime", size, slide))
        .agg(
            F.count("*").alias("n_readings_window"),
            *mean_std(F.col("value"), "mean_level_window", "std_level_window"),
        )
    )


def _merged(a: Column, b: Column) -> Column:
    """Count, mean and squares about the mean of two disjoint sets of values."""
    n = a["c"] + b["c"]
    apart = b["mean"] - a["mean"]
    return F.when(b["c"] == 0, F.struct((a["n"] + b["n"]).alias("n"), a["c"], a["mean"], a["m2"])).otherwise(
        F.struct(
            (a["n"] + b["n"]).alias("n"), n.alias("c"),
            (a["mean"] + apart * b["c"] / n).alias("mean"),
            (a["m2"] + b["m2"] + apart * apart * a["c"] * b["c"] / n).alias("m2"),
        ))


def _windows_of_table(panes: DataFrame, size: str, slide: str) -> DataFrame:
    """:func:`windows_of_panes` for panes that are all there."""
    windows = panes.groupBy(STATION_KEY, F.window(F.window_time("pane"), size, slide)).agg(
        F.collect_list(F.struct("n", "c", "mean", "m2")).alias("panes"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("c"),
                    F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    # In order of the states themselves, so that sums do not depend on the order of arrival.
    merged = windows.withColumn("all", F.aggregate(F.array_sort("panes"), zero, _merged))
    return merged.select(STATION_KEY, "window", "all.*")


def paned_stats(
    events: DataFrame,
    size: str = WINDOW_SIZE,
    slide: str = WINDOW_SLIDE,
    delay: str = WATERMARK_DELAY,
) -> DataFrame:
    """:func:`windowed_stats` by panes as long as the slide, for sizes that are a multiple of it.

    A reading goes into one pane, and only closed panes go into the windows over them, so state
    is touched once for each station and pane in a micro-batch, and not once for each of size /
    slide windows. On a stream :mod:`tidemark.streaming.panes` keeps the panes until their last
    window closes; a window closes when the direct form would close it as well.
    """
    value = F.col("value")
    panes = (
        events.withWatermark("dateTime", delay)
        .groupBy(STATION_KEY, F.window("dateTime", slide).alias("pane"))
        .agg(F.count("*").alias("n"), F.count(value).alias("c"),
             F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"),
             F.coalesce(F.var_pop(value) * F.count(value), F.lit(0.0)).alias("m2"))
    )
    return _moments((windows_of_panes if events.isStreaming else _windows_of_table)(panes, size, slide))


def grouped_stats(
    events: DataFrame,
    size: str = WINDOW_SIZE,
    slide: str = WINDOW_SLIDE,
    delay: str = WATERMARK_DELAY,
) -> DataFrame:
    """:func:`windowed_stats` with a stream's open windows kept by groups of stations.

    The direct form gets, puts, finds and removes a state row for each window, which is most of
    its time where stations are many and windows hold few readings. On a stream
    :mod:`tidemark.streaming.panes` keeps one row for each group; a table has no state.
    """
    if not events.isStreaming:
        return windowed_stats(events, size, slide, delay)
    return _moments(windows_of_readings(events.withWatermark("dateTime", delay), size, slide))


def _moments(merged: DataFrame) -> DataFrame:
    """Merged count, mean and squares as the columns of :func:`windowed_stats`."""
    c, nan = F.col("c"), F.lit(float("nan"))
    return merged.select(
        STATION_KEY, "window", F.col("n").alias("n_readings_window"),
        F.when(c > 0, F.coalesce("mean", nan)).alias("mean_level_window"),
        F.when(c > 1, F.coalesce(F.sqrt(F.col("m2") / (c - 1)), nan)).alias("std_level_window"),
    )


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows that a stream of :func:`windowed_stats` holds open, as they stand after its
    last micro-batch: those that its output lacks because the watermark has not passed them.

    Read from the state in the checkpoint, which the stream may go on writing meanwhile.
    """
    # Partial results in the order of the aggregates; their own names repeat.
    layout = "struct<n:bigint,total:double,c:bigint,_n:double,_mean:double,m2:double>"
    state = spark.read.format("statestore").load(checkpoint).select(
        "key.*", F.col("value").cast(layout).alias("v"))
    c = F.col("v.c")
    return state.select(
        STATION_KEY, "window", F.col("v.n").alias("n_readings_window"),
        F.when(c > 0, F.col("v.total") / c).alias("mean_level_window"),
        F.when(c > 1, F.sqrt(F.col("v.m2") / (c - 1))).alias("std_level_window"),
    )


def flatten_window(df: DataFrame) -> DataFrame:
    """Window struct to ``window_start`` and ``window_end``."""
    return df.withColumns(
        {"window_start": F.col("window.start"), "window_end": F.col("window.end")}
    ).drop("window")

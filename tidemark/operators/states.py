"""Daily facts as states that merge into baselines, without another pass over the readings.

Count, mean and deviation of a day hold all that a longer period needs of it; percentiles are
merged from sketches. A station has one state for each day, however many readings it holds, so a
hot station's states are no more than those of others.
"""

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.rowjoin import row_join
from tidemark.operators.stats import BASELINE_PERCENTILES, station_daily
from tidemark.schemas import STATION_KEY

#: Size of a sketch. A percentile's rank is wrong by at most about 2.3 / k ** 0.9 of the count,
#: with a probability of 99 percent; up to k values the sketch holds them all.
SKETCH_K = 1000


def merge_moments(daily: DataFrame, keys: list[str] | None = None, min_max: bool = False) -> DataFrame:
    """Daily facts to count, mean and sample deviation per station (or other ``keys``).

    The squares are summed about the merged mean, not about zero, so nothing cancels. Facts of
    :func:`tidemark.operators.stats.station_daily` must be of readings that all have a value, as
    clean ones do; those of :func:`daily_states` know how many have. A null key is a key like any
    other. ``min_max`` takes the columns that :func:`daily_states` has.
    """
    keys = [STATION_KEY] if keys is None else keys
    mean, std = F.col("mean_level_day"), F.col("std_level_day")
    values = "n_values_day" if "n_values_day" in daily.columns else "n_readings_day"
    days = daily.withColumn("_n", F.when(mean.isNull(), 0).otherwise(F.col(values)))
    merged = [F.sum("n_readings_day").alias("n_readings_total"), F.sum("_n").alias("_values"),
              F.try_divide(F.sum(F.col("_n") * mean), F.sum("_n")).alias("mean_level_total")]
    if min_max:
        merged += [F.min("min_level_day").alias("min_level"), F.max("max_level_day").alias("max_level")]
    totals = days.groupBy(*keys).agg(*merged)
    inside = F.coalesce(std * std * (F.col("_n") - 1), F.lit(0.0))
    between = F.col("_n") * F.pow(mean - F.col("mean_level_total"), 2)
    squares = row_join(days, totals.select(*keys, "mean_level_total"), keys, "inner").groupBy(
        *keys).agg(F.sum(inside + F.coalesce(between, F.lit(0.0))).alias("_m2"))
    out = row_join(totals, squares, keys, "inner")
    n = F.col("_values")
    deviation = F.when(n > 1, F.sqrt(F.col("_m2") / (n - 1)))
    return out.withColumn("std_level_total", deviation).drop("_m2", "_values")


def daily_states(readings: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """Facts per station and day with the number, minimum, maximum and a KLL sketch of the
    values."""
    value = F.col("value")
    return station_daily(readings, more=[
        F.count(value).alias("n_values_day"),
        F.min(value).alias("min_level_day"), F.max(value).alias("max_level_day"),
        F.kll_sketch_agg_double(value, F.lit(k)).alias("level_sketch"),
    ])


def merge_sketches(states: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One sketch for each station (or other ``keys``) from those of its days."""
    keys = [STATION_KEY] if keys is None else keys
    return states.groupBy(*keys).agg(F.kll_merge_agg_double("level_sketch").alias("level_sketch"))


def sketched(probability: float, sketch: str = "level_sketch") -> Column:
    """The value at a share of the sketched ones; NULL if there are none."""
    at = F.kll_sketch_get_quantile_double(F.col(sketch), F.lit(float(probability)))
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, at)


def merge_baseline(states: DataFrame, min_max: bool = False) -> DataFrame:
    """The baseline of :func:`tidemark.operators.stats.station_baseline` from daily states only:
    exact counts and moments, percentiles within the sketches' rank error."""
    percentiles = merge_sketches(states).withColumns(
        {name: sketched(p) for name, p in BASELINE_PERCENTILES.items()}).drop("level_sketch")
    return row_join(merge_moments(states, min_max=min_max), percentiles, [STATION_KEY], "inner")

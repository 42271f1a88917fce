"""Enrichment joins.

No broadcast hints: Spark broadcasts the metadata side when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and shuffles both sides otherwise. Most sides
joined here hold one row per station (or per closed window), so no key is hot; the
exception is :func:`reading_baseline`.
"""

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import levels
from tidemark.operators.cleaning import drop_null
from tidemark.operators.dedupe import dedupe_station
from tidemark.operators.rowjoin import row_join
from tidemark.schemas import BASELINE_VIEW_COLUMNS, STATION_KEY, STATIONS


def stations_view(stations: DataFrame) -> DataFrame:
    """The station columns that travel with a baseline."""
    return stations.select(*STATIONS.names)


def baseline_view(baseline: DataFrame) -> DataFrame:
    """The baseline columns that alerts need."""
    return baseline.select(*BASELINE_VIEW_COLUMNS)


def enrich_baseline(
    baseline: DataFrame, stations: DataFrame, order: list[Column | str] | None = None
) -> DataFrame:
    """Left join with the metadata; duplicate station rows are reduced to one first, so
    the baseline never fans out."""
    return baseline.join(dedupe_station(stations_view(stations), order), STATION_KEY, "left")


def alert_thresholds(baseline: DataFrame) -> DataFrame:
    """High threshold: 95th percentile. Very high threshold: mean plus two deviations."""
    very_high = levels.very_high_threshold(F.col("mean_level_total"), F.col("std_level_total"))
    return baseline.withColumns(
        {"alert_threshold_high": F.col("p95_level"), "alert_threshold_very_high": very_high}
    )


def join_baseline(windows: DataFrame, baseline: DataFrame) -> DataFrame:
    """Left join of windows (batch or stream) with the per-station baseline."""
    return windows.join(baseline, STATION_KEY, "left")


def reading_baseline(readings: DataFrame, baseline: DataFrame) -> DataFrame:
    """Left join of single readings with the baseline; a hot station's readings are split
    where the baseline is too large to broadcast."""
    return row_join(readings, drop_null(baseline, STATION_KEY), [STATION_KEY], "left")

"""Station summary: risk-graded daily levels and one summary row per station."""

import argparse

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import calendar, levels
from tidemark.operators.calendar import flag_in_interval, station_day_spine
from tidemark.operators.labels import dominant_label
from tidemark.operators.stats import summary_stats
from tidemark.schemas import DAILY_RISK, STATION_KEY, STATION_METADATA
from tidemark.session import build_session, clear_scratch, store
from tidemark.sinks.files import write_csv
from tidemark.sources.files import read_csv

# Columns rounded in the summary, columns kept out of it.
ROUNDED = ["mean_level_total", "std_level_total", "p05_level", "median_level", "p95_level"]
INTERNAL = ["base_level"]


def expected_levels(
    stations: DataFrame, intervals: DataFrame, day_means: DataFrame, start: str, n_days: int
) -> DataFrame:
    """The expected ``level`` of every station on every day, from what was observed.

    ``stations`` carries ``base_level``, the station's usual level; ``day_means`` the mean
    ``season`` of all stations by ``date``; ``intervals`` the events (``start``, ``length``
    in days). On a day of an event a station is expected at no less than that day's mean.
    """
    days = flag_in_interval(
        station_day_spine(stations, start, n_days), intervals, name="in_event"
    ).join(day_means, "date", "left")
    base, season = F.col("base_level"), F.col("season")
    raised = F.when(F.col("in_event") & (season > base), season).otherwise(base)
    return days.withColumn("level", levels.clamp_min(raised))


def expected_daily(
    stations: DataFrame, intervals: DataFrame, day_means: DataFrame, start: str, n_days: int
) -> DataFrame:
    """:func:`expected_levels`, graded by each station's thresholds."""
    days = expected_levels(stations, intervals, day_means, start, n_days)
    graded = days.withColumn(
        "flood_risk",
        levels.risk_level(
            F.col("level"),
            F.col("alert_threshold_very_high"),
            F.col("alert_threshold_high"),
            F.col("typical_range_high"),
        ),
    )
    return graded.withColumns(
        {"level": levels.round_value(F.col("level")), "date": calendar.iso_date(F.col("date"))}
    ).select(*DAILY_RISK.names)


def summarize_stations(daily: DataFrame, stations: DataFrame) -> DataFrame:
    """Metadata, level statistics and dominant risk of the stations that have all three.

    All sides hold one row per station; Spark picks the join by measured size.
    """
    joined = (
        stations.drop(*INTERNAL)
        .join(summary_stats(daily), STATION_KEY, "inner")
        .join(dominant_label(daily), STATION_KEY, "inner")
    )
    return levels.round_cols(joined, ROUNDED)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--daily", required=True, help="CSVs of daily risk readings")
    parser.add_argument("--stations", required=True, help="station metadata CSV")
    parser.add_argument("--out", required=True, help="folder of the summary CSV")
    args = parser.parse_args(argv)
    spark = build_session("station-summary")
    try:
        # Statistics and labels each read the daily table; the CSV is parsed once.
        daily = store(read_csv(spark, args.daily, DAILY_RISK), "daily")
        stations = read_csv(spark, args.stations, STATION_METADATA)
        write_csv(summarize_stations(daily, stations), args.out)
    finally:
        clear_scratch(spark)
        spark.stop()


if __name__ == "__main__":
    main()

"""Batch job: raw readings to clean readings, daily facts and station baselines."""

import argparse

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.cleaning import clean_readings
from tidemark.operators.joins import alert_thresholds, enrich_baseline
from tidemark.operators.states import daily_states, merge_baseline
from tidemark.operators.stats import station_baseline, station_daily
from tidemark.session import build_session, clear_scratch
from tidemark.sinks.files import write_curated
from tidemark.sinks.versions import replace_table
from tidemark.sources.files import has_csv, read_archive_text, read_readings, read_stations

# Folders of the curated zone.
CLEAN, DAILY, BASELINE = "clean_readings", "batch_station_daily", "batch_station_baseline"
STATES = "batch_station_states"


def baseline_table(readings: DataFrame, stations: DataFrame, **options) -> DataFrame:
    """Clean readings and metadata to the enriched baseline with thresholds."""
    return alert_thresholds(enrich_baseline(station_baseline(readings, **options), stations))


def batch_baseline(
    spark: SparkSession,
    readings_path: str,
    stations_path: str,
    out: str,
    parameter: str | None = None,
    min_max: bool = False,
    exact: bool = True,
    allow_empty: bool = False,
    at_once: bool = False,
) -> dict[str, str]:
    """Run the job and return the output paths.

    The CSV is parsed and cleaned once, into Parquet by day; both aggregations then
    read only the columns they need from there. With ``exact=False`` the readings are read once:
    the daily facts are written with a sketch of each day (a fourth table), and the baseline is
    merged from these, its percentiles within the sketches' rank error. Input folders without any file are an
    error, so that a wrong path does not replace good tables with empty ones;
    ``allow_empty`` lets them through. ``at_once`` replaces the baseline as a whole, for a
    stream that reads it meanwhile; such a table is read by
    :func:`tidemark.sinks.versions.read_table`.
    """
    paths = {name: f"{out}/{name}" for name in (CLEAN, DAILY, BASELINE)}
    for path in (readings_path, stations_path):
        if not allow_empty and not has_csv(spark, path):
            raise ValueError(f"no CSV file under {path}")
    if parameter is None:
        raw = read_readings(spark, readings_path)
    else:
        needed = ("dateTime", "measure", "value", "parameter")
        raw = read_archive_text(spark, readings_path, required=needed)
    clean = clean_readings(raw, parameter)
    write_curated(clean, paths[CLEAN], partition_by="reading_date")

    # The schema is given because a folder without readings cannot tell it.
    readings = spark.read.schema(clean.schema).parquet(paths[CLEAN])
    stations = read_stations(spark, stations_path)
    if exact:
        write_curated(station_daily(readings), paths[DAILY])
        baseline = baseline_table(readings, stations, min_max=min_max)
    else:
        paths[STATES] = f"{out}/{STATES}"
        write_curated(daily_states(readings), paths[STATES])
        states = spark.read.parquet(paths[STATES])
        write_curated(states.select(*station_daily(readings).columns), paths[DAILY])
        merged = merge_baseline(states, min_max=min_max)
        baseline = alert_thresholds(enrich_baseline(merged, stations))
    (replace_table if at_once else write_curated)(baseline, paths[BASELINE])
    return paths


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--readings", required=True, help="folder or glob of reading CSVs")
    parser.add_argument("--stations", required=True, help="station metadata CSV")
    parser.add_argument("--out", required=True, help="folder of the curated zone")
    parser.add_argument("--parameter", help="keep only this measured parameter")
    parser.add_argument("--min-max", action="store_true", help="add minimum and maximum")
    parser.add_argument("--allow-empty", action="store_true", help="accept folders without files")
    parser.add_argument("--at-once", action="store_true", help="replace the baseline as a whole")
    parser.add_argument("--approximate", action="store_true", help="approximate percentiles")
    args = parser.parse_args(argv)
    spark = build_session("batch-baseline")
    try:
        batch_baseline(
            spark, args.readings, args.stations, args.out, args.parameter, args.min_max,
            exact=not args.approximate, allow_empty=args.allow_empty, at_once=args.at_once,
        )
    finally:
        clear_scratch(spark)
        spark.stop()


if __name__ == "__main__":
    main()

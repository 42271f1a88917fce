"""Baseline queries."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog import cleaning
from tidemark.catalog import tables as t
from tidemark.catalog.files import write_raw_zone
from tidemark.catalog.registry import query
from tidemark.operators import joins
from tidemark.operators.dedupe import dedupe_station as first_of_station
from tidemark.operators.rowjoin import row_join
from tidemark.operators.states import daily_states, merge_baseline, merge_moments
from tidemark.operators.stats import BASELINE_PERCENTILES, station_baseline, station_daily
from tidemark.plans import batch_baseline as job
from tidemark.plans.load_warehouse import load_warehouse
from tidemark.session import scratch_path, store
from tidemark.sources.files import read_baseline

MOMENTS = ["mean_level_total", "std_level_total"]
BASELINE_BODY = """
SELECT stationReference, n_readings_total, round(mean_level_total, 8) AS mean_level_total,
       round(std_level_total, 8) AS std_level_total, p05_level, median_level, p95_level,
       min_level, max_level
FROM baseline"""
ENRICHED_BODY = """
SELECT stationReference, n_readings_total, round(mean_level_total, 8) AS mean_level_total,
       round(std_level_total, 8) AS std_level_total, p05_level, median_level, p95_level,
       label, riverName, catchmentName, town, lat, long, status, alert_threshold_high,
       round(alert_threshold_very_high, 8) AS alert_threshold_very_high
FROM graded_baseline"""
SUPPLIER_BODY = BASELINE_BODY.replace(", 8)", ", 6)")
SUPPLIER_BASELINE = t.CTE["baseline"].replace("FROM readings", "FROM supplies")


@query(t.sql("readings baseline", BASELINE_BODY))
def baseline_by_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.rounded(station_baseline(t.readings(spark, sf_dir), min_max=True), *MOMENTS)


@query(t.sql("readings baseline", BASELINE_BODY))
def baseline_approximate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles off the sketch, which is exact for groups of this size."""
    stats = station_baseline(t.readings(spark, sf_dir), min_max=True, exact=False)
    return t.rounded(stats, *MOMENTS)


@query(t.sql("readings baseline", BASELINE_BODY))
def baseline_exact_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked from a stored table in another order; the result is the same."""
    stored = store(t.readings(spark, sf_dir).repartition("event_id"), "readings")
    return t.rounded(station_baseline(stored, min_max=True), *MOMENTS)


@query(t.sql("supplies baseline", SUPPLIER_BODY, baseline=SUPPLIER_BASELINE))
def baseline_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = station_baseline(t.supplies(spark, sf_dir), min_max=True)
    return t.rounded(stats, *MOMENTS, digits=6)


@query(t.sql("supplies baseline", SUPPLIER_BODY, baseline=SUPPLIER_BASELINE))
def baseline_by_supplier_approximate(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = station_baseline(t.supplies(spark, sf_dir), min_max=True, exact=False)
    return t.rounded(stats, *MOMENTS, digits=6)


def _dated(readings: DataFrame) -> DataFrame:
    return readings.withColumn("reading_date", F.to_date("dateTime"))


@query(t.sql("readings baseline", """
SELECT stationReference, n_readings_total, round(mean_level_total, 8) AS mean_level_total,
       round(std_level_total, 8) AS std_level_total
FROM baseline"""))
def baseline_from_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and moments merged from the daily facts."""
    return t.rounded(merge_moments(station_daily(_dated(t.readings(spark, sf_dir)))), *MOMENTS)


@query(t.sql("readings baseline", BASELINE_BODY))
def baseline_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole baseline merged from daily states; sketches of this size hold all values."""
    states = store(daily_states(_dated(t.readings(spark, sf_dir))), "states")
    return t.rounded(merge_baseline(states, min_max=True), *MOMENTS)


@query(t.sql("supplies", """
SELECT stationReference, count(*) AS n_readings_total, true AS p05_near, true AS median_near,
       true AS p95_near
FROM supplies GROUP BY 1"""))
def sketch_rank_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the exact rank of each merged percentile, off small sketches, is within two
    hundredths of the one that was asked for."""
    supplies = _dated(t.supplies(spark, sf_dir))
    merged = merge_baseline(daily_states(supplies, k=256))
    joined = row_join(supplies.select("stationReference", "value"), merged, ["stationReference"], "inner")
    n = F.count("*")

    def near(name: str, p: float) -> F.Column:
        below, upto = (F.count_if(c) / n for c in (F.col("value") < F.col(name), F.col("value") <= F.col(name)))
        return ((below <= p + 0.02) & (upto >= p - 0.02)).alias(f"{name.removesuffix('_level')}_near")

    return joined.groupBy("stationReference").agg(
        n.alias("n_readings_total"), *(near(name, p) for name, p in BASELINE_PERCENTILES.items()))


@query(t.sql("readings baseline stations graded_baseline", ENRICHED_BODY,
             stations=t.KNOWN_STATIONS))
def baseline_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = job.baseline_table(t.readings(spark, sf_dir), t.known_stations(spark, sf_dir))
    return t.rounded(table, *MOMENTS, "alert_threshold_very_high")


@query(t.sql("readings baseline stations graded_baseline", """
SELECT stationReference, round(mean_level_total, 8) AS mean_level_total,
       round(std_level_total, 8) AS std_level_total, alert_threshold_high,
       round(alert_threshold_very_high, 8) AS alert_threshold_very_high,
       riverName, catchmentName, town
FROM graded_baseline""", stations=t.KNOWN_STATIONS))
def baseline_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = job.baseline_table(t.readings(spark, sf_dir), t.known_stations(spark, sf_dir))
    return t.rounded(joins.baseline_view(table), *MOMENTS, "alert_threshold_very_high")


@query(t.sql("readings", """
SELECT stationReference, event_id, dateTime, value, event_type FROM (
    SELECT *, row_number() OVER (PARTITION BY stationReference
                                 ORDER BY dateTime DESC, event_id DESC) AS rn
    FROM readings) WHERE rn = 1"""))
def baseline_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest reading per station out of all its readings."""
    order = [F.desc("dateTime"), F.desc("event_id")]
    return t.plain_times(first_of_station(t.readings(spark, sf_dir), order))


def _run_job(spark: SparkSession, sf_dir: str, out: str | None = None) -> dict[str, str]:
    raw = write_raw_zone(spark, sf_dir, t.known_stations(spark, sf_dir))
    out = out or scratch_path(spark, "curated")
    return job.batch_baseline(spark, raw["archive"], raw["stations"], out, parameter="level")


JOB_BASELINE = t.CTE["baseline"].replace("FROM readings", "FROM clean WHERE parameter = 'level'")


@query(t.sql("archive clean baseline stations graded_baseline", ENRICHED_BODY,
             clean=cleaning.CLEAN, baseline=JOB_BASELINE, stations=t.KNOWN_STATIONS))
def batch_job_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch job, from dirty CSV to the curated baseline."""
    table = read_baseline(spark, _run_job(spark, sf_dir)[job.BASELINE])
    return t.rounded(table, *MOMENTS, "alert_threshold_very_high")


@query(t.sql("archive clean", """
SELECT stationReference, reading_date, count(*) AS n_readings_day,
       round(avg(value), 8) AS mean_level_day, round(stddev_samp(value), 8) AS std_level_day
FROM clean WHERE parameter = 'level' GROUP BY 1, 2""", clean=cleaning.CLEAN))
def batch_job_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch job, from dirty CSV to the daily facts."""
    table = read_baseline(spark, _run_job(spark, sf_dir)[job.DAILY])
    return t.rounded(table, "mean_level_day", "std_level_day")


@query(t.sql("archive clean baseline", f"""
SELECT '{job.BASELINE}' AS name, count(*) AS n_rows FROM baseline
UNION ALL
SELECT '{job.DAILY}', count(*) FROM (
    SELECT DISTINCT stationReference, reading_date FROM clean WHERE parameter = 'level')""",
             clean=cleaning.CLEAN, baseline=JOB_BASELINE))
def warehouse_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job's results, loaded into catalog tables and counted there."""
    out, location = scratch_path(spark, "curated"), scratch_path(spark, "warehouse")
    _run_job(spark, sf_dir, out)
    prefix = "tidemark_" + location.rsplit("-", 1)[1] + "_"
    counts = [
        (name, table.count())
        for name, table in load_warehouse(spark, out, prefix, location).items()
    ]
    for name, _ in counts:
        spark.sql(f"DROP TABLE {prefix}{name}")
    return spark.createDataFrame(counts, "name string, n_rows long")

"""Station summary queries."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog import tables as t
from tidemark.catalog.registry import query
from tidemark.functions import levels
from tidemark.operators import labels, reports, stats
from tidemark.operators.quantiles import exact_quantiles
from tidemark.plans.station_summary import ROUNDED, summarize_stations
from tidemark.session import store

DAILY_CTES = "readings baseline stations station_meta daily"
SUMMARY = """summary AS (
    SELECT stationReference, count(level) AS n_readings_total, avg(level) AS mean_level_total,
           stddev_samp(level) AS std_level_total, quantile_cont(level, 0.05) AS p05_level,
           median(level) AS median_level, quantile_cont(level, 0.95) AS p95_level
    FROM daily GROUP BY 1)"""
SUMMARY_BODY = "SELECT stationReference, n_readings_total, " + ", ".join(
    f"round({c}, 8) AS {c}" for c in ROUNDED
) + " FROM summary"
DESCRIBE = """
SELECT count(value) AS count, round(avg(value), 8) AS mean, round(stddev_samp(value), 8) AS std,
       min(value) AS min, round(quantile_cont(value, 0.25), 8) AS p25,
       round(quantile_cont(value, 0.5), 8) AS p50, round(quantile_cont(value, 0.75), 8) AS p75,
       max(value) AS max
FROM """
DOUBLES = ["mean", "std", "p25", "p50", "p75"]


@query(t.sql(f"{DAILY_CTES} summary", SUMMARY_BODY, summary=SUMMARY))
def summary_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.rounded(stats.summary_stats(t.daily(spark, sf_dir)), *ROUNDED)


@query(t.sql(f"{DAILY_CTES} summary", SUMMARY_BODY, summary=SUMMARY))
def summary_stats_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over a table that is stored first, as the summary job reads it."""
    return t.rounded(stats.summary_stats(store(t.daily(spark, sf_dir), "daily")), *ROUNDED)


@query(t.sql("supplies", """
SELECT stationReference, round(quantile_cont(value, 0.05), 8) AS p05,
       round(quantile_cont(value, 0.5), 8) AS p50, round(quantile_cont(value, 0.95), 8) AS p95
FROM supplies GROUP BY 1"""))
def supplier_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    probs = {"p05": 0.05, "p50": 0.5, "p95": 0.95}
    found = exact_quantiles(t.supplies(spark, sf_dir), ["stationReference"], "value", probs)
    return t.rounded(found, *probs)


@query(t.sql(DAILY_CTES, """
SELECT stationReference, flood_risk, count(*) AS n FROM daily GROUP BY 1, 2"""))
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.label_counts(t.daily(spark, sf_dir))


@query(t.sql("readings", """
SELECT stationReference, event_type AS dominant_type FROM (
    SELECT stationReference, event_type,
           row_number() OVER (PARTITION BY stationReference
                              ORDER BY count(*) DESC, event_type) AS rn
    FROM readings GROUP BY 1, 2) WHERE rn = 1"""))
def dominant_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most frequent event type per station; ties are common here."""
    return labels.dominant_label(t.readings(spark, sf_dir), "event_type", "dominant_type")


@query(t.sql("readings", """
SELECT event_type, round_even(count(*) / (SELECT count(*) FROM readings), 3) AS share
FROM readings GROUP BY 1"""))
def label_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.label_shares(t.readings(spark, sf_dir), "event_type")


ROUNDED_SQL = ", ".join(f"round_even(s.{c}, 3) AS {c}" for c in ROUNDED)


@query(t.sql(f"{DAILY_CTES} summary", f"""
SELECT m.* EXCLUDE (base_level, spread),
       s.n_readings_total, {ROUNDED_SQL}, d.dominant_risk
FROM station_meta m JOIN summary s USING (stationReference)
JOIN (SELECT stationReference, flood_risk AS dominant_risk FROM (
        SELECT stationReference, flood_risk,
               row_number() OVER (PARTITION BY stationReference
                                  ORDER BY count(*) DESC, flood_risk) AS rn
        FROM daily GROUP BY 1, 2) WHERE rn = 1) d USING (stationReference)""", summary=SUMMARY))
def station_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = store(t.daily(spark, sf_dir), "daily")
    return summarize_stations(daily, t.station_meta(spark, sf_dir).drop("spread"))


@query(DESCRIBE + "events")
def describe_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.rounded(stats.describe(t.table(spark, sf_dir, "events"), "value"), *DOUBLES)


@query(DESCRIBE.replace(", 8)", ", 4)") + "(SELECT l_extendedprice AS value FROM lineitem)")
def describe_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One group that holds the whole table, at volume."""
    prices = t.table(spark, sf_dir, "lineitem")
    return t.rounded(stats.describe(prices, "l_extendedprice"), *DOUBLES, digits=4)


@query(t.sql("readings", "SELECT * FROM readings ORDER BY dateTime, event_id LIMIT 5"))
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.readings(spark, sf_dir)
    report = reports.preview(rows, ["dateTime", "event_id"], "value", "event_type")
    return t.plain_times(report["first_rows"]())


@query(t.sql("stations", """
SELECT stationReference, round_even(lat / 7, 5) AS lat, round_even(long / 7, 5) AS long
FROM stations"""))
def round_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = t.stations(spark, sf_dir).select(
        "stationReference", (F.col("lat") / 7).alias("lat"), (F.col("long") / 7).alias("long")
    )
    return levels.round_cols(scaled, ["lat", "long"], 5)

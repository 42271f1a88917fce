"""Cleaning queries."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog import tables as t
from tidemark.catalog.registry import query
from tidemark.functions import calendar, text
from tidemark.operators import cleaning as ops
from tidemark.operators import stats
from tidemark.streaming.events import archive_events

FIRST_NUMBER = r"regexp_extract(value, '(-?\d+(\.\d+)?)', 0)"
STRICT_NUMBER = (
    r"regexp_full_match(value, '\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*')"
)
CLEAN = rf"""clean AS (
    SELECT regexp_extract(measure, '/id/measures/([0-9A-Z]+)-', 1) AS stationReference,
           try_cast(substr(dateTime, 1, 10) AS DATE) AS reading_date,
           CAST(nullif({FIRST_NUMBER}, '') AS DOUBLE) AS value, parameter
    FROM archive
    WHERE nullif({FIRST_NUMBER}, '') IS NOT NULL
      AND regexp_extract(measure, '/id/measures/([0-9A-Z]+)-', 1) <> '')"""


@query(t.sql("archive", "SELECT dateTime, measure, value FROM archive WHERE value IS NOT NULL"))
def select_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.drop_null(ops.select_reading(t.archive(spark, sf_dir)), "value")


@query(t.sql("archive", f"""
SELECT event_id, {FIRST_NUMBER} AS number_text,
       CAST(nullif({FIRST_NUMBER}, '') AS DOUBLE) AS number
FROM archive"""))
def first_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = text.first_number(F.col("value"))
    return t.archive(spark, sf_dir).select(
        "event_id",
        found.alias("number_text"),
        text.blank_to_null_double(found).alias("number"),
    )


@query(t.sql("archive", f"""
SELECT event_id, CAST(nullif({FIRST_NUMBER}, '') AS DOUBLE) AS value
FROM archive WHERE nullif({FIRST_NUMBER}, '') IS NOT NULL"""))
def clean_first_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.clean_first_number(t.archive(spark, sf_dir).select("event_id", "value"))


@query(t.sql("archive", f"""
SELECT stationReference, label AS stationName, dateTime, date, unitName, valueType, datumType,
       CAST(trim(value) AS DOUBLE) AS value
FROM archive WHERE parameter = 'level' AND {STRICT_NUMBER}"""))
def clean_strict_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_events(t.archive(spark, sf_dir))


@query(t.sql("archive", "SELECT event_id, parameter FROM archive WHERE parameter = 'level'"))
def filter_parameter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.filter_parameter(t.archive(spark, sf_dir).select("event_id", "parameter"))


@query(t.sql("archive", """
SELECT event_id, regexp_extract(measure, '/id/measures/([0-9A-Z]+)-', 1) AS station
FROM archive"""))
def station_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.archive(spark, sf_dir).select(
        "event_id", text.station_ref(F.col("measure")).alias("station")
    )


# Every tenth time text is broken, so the malformed case is exercised too.
@query(t.sql("archive", """
SELECT event_id, CASE WHEN event_id % 10 = 9 THEN NULL
                      ELSE CAST(substr(dateTime, 1, 10) AS DATE) END AS reading_date
FROM archive"""))
def reading_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    moment = F.when(F.col("event_id") % 10 == 9, F.concat(F.lit("at "), "dateTime")).otherwise(
        F.col("dateTime")
    )
    return t.archive(spark, sf_dir).select(
        "event_id", calendar.reading_date(moment).alias("reading_date")
    )


@query(t.sql("archive clean", """
SELECT stationReference, reading_date, count(*) AS n_readings_day,
       round(avg(value), 8) AS mean_level_day, round(stddev_samp(value), 8) AS std_level_day
FROM clean WHERE parameter = 'level' GROUP BY 1, 2""", clean=CLEAN))
def station_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = ops.clean_readings(t.archive(spark, sf_dir), parameter="level")
    return t.rounded(stats.station_daily(readings), "mean_level_day", "std_level_day")


@query(t.sql("archive", f"""
SELECT regexp_extract(measure, '/id/measures/([0-9A-Z]+)-', 1) AS stationReference,
       count(*) AS n_rows
FROM archive WHERE nullif({FIRST_NUMBER}, '') IS NOT NULL GROUP BY 1"""))
def unnamed_station_pooled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without ``require_station`` the unreadable ids share one empty key."""
    readings = ops.clean_readings(t.archive(spark, sf_dir), require_station=False)
    return readings.groupBy("stationReference").agg(F.count("*").alias("n_rows"))


@query("SELECT count(*) AS n_rows FROM events")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.row_count(t.table(spark, sf_dir, "events"))

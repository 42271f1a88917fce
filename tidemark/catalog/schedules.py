"""Calendar, threshold and grading queries."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog import tables as t
from tidemark.catalog.registry import query
from tidemark.functions import calendar, levels, text
from tidemark.operators import calendar as ops
from tidemark.plans.station_summary import expected_daily as expected_risk
from tidemark.plans.station_summary import expected_levels
from tidemark.session import store

START, N_DAYS = "2024-01-01", 30
SPINE = f"""spine AS (
    SELECT m.*, CAST(d AS DATE) AS day
    FROM station_meta m,
         generate_series(TIMESTAMP '{START}', TIMESTAMP '{START}' + INTERVAL {N_DAYS - 1} DAY,
                         INTERVAL 1 DAY) g(d))"""
IN_EVENT = """EXISTS (SELECT 1 FROM intervals i
               WHERE i.stationReference = s.stationReference
                 AND s.day >= i.start AND s.day < i.start + i.length)"""
EXPECTED = f"""expected AS (
    SELECT *, greatest(0.05e0, CASE WHEN in_event AND season > base_level THEN season
                                    ELSE base_level END) AS level
    FROM (SELECT s.*, {IN_EVENT} AS in_event, m.season
          FROM spine s LEFT JOIN (
            SELECT CAST(dateTime AS DATE) AS day, round(avg(value), 6) AS season
            FROM readings GROUP BY 1) m ON m.day = s.day) s)"""
EXPECTED_CTES = "readings baseline stations station_meta spine intervals expected"


def _day_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean level of all stations on each day."""
    day = calendar.reading_date(F.col("dateTime")).alias("date")
    return t.readings(spark, sf_dir).groupBy(day).agg(F.round(F.avg("value"), 6).alias("season"))


@query(t.sql("stations spine", """
SELECT stationReference, strftime(day, '%Y-%m-%d') AS date, dayofyear(day) AS day_of_year
FROM spine""", spine=SPINE.replace("station_meta", "stations")))
def station_day_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    stations = t.stations(spark, sf_dir).select("stationReference")
    spine = ops.station_day_spine(stations, START, N_DAYS)
    return spine.select(
        "stationReference",
        calendar.iso_date(F.col("date")).alias("date"),
        F.dayofyear("date").cast("long").alias("day_of_year"),
    )


@query(t.sql("readings", """
SELECT CAST(d AS DATE) AS date, count(event_id) AS n_readings
FROM generate_series((SELECT date_trunc('day', min(dateTime)) FROM readings),
                     (SELECT max(dateTime) FROM readings), INTERVAL 1 DAY) g(d)
LEFT JOIN readings ON CAST(dateTime AS DATE) = CAST(d AS DATE)
GROUP BY 1"""))
def date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings on every day between the first and the last, days without any included."""
    readings = t.readings(spark, sf_dir)
    day = calendar.reading_date(F.col("dateTime")).alias("date")
    per_day = store(readings.groupBy(day).agg(F.count("*").alias("n_readings")), "per-day")
    first, last = per_day.agg(F.min("date"), F.max("date")).first()
    spine = ops.date_spine(spark, first.isoformat(), (last - first).days + 1)
    return spine.join(per_day, "date", "left").fillna({"n_readings": 0})


@query(t.sql("intervals", """
SELECT DISTINCT stationReference, CAST(start + CAST(k AS INTEGER) AS DATE) AS date
FROM intervals, range(0, 4) r(k) WHERE k < length"""))
def interval_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.interval_days(t.intervals(spark, sf_dir))


@query(t.sql("readings intervals", """
SELECT s.event_id, s.stationReference, s.day AS date, EXISTS (
    SELECT 1 FROM intervals i WHERE i.stationReference = s.stationReference
      AND s.day >= i.start AND s.day < i.start + i.length) AS in_interval
FROM (SELECT *, CAST(dateTime AS DATE) AS day FROM readings) s"""))
def interval_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = t.readings(spark, sf_dir).select(
        "event_id", "stationReference", F.to_date("dateTime").alias("date")
    )
    return ops.flag_in_interval(days, t.intervals(spark, sf_dir))


LONG_INTERVALS = """long_intervals AS (
    SELECT printf('%05dTH', o_custkey) AS stationReference,
           DATE '2014-01-01' + CAST(o_orderkey % 3700 AS INTEGER) AS start,
           CAST(CASE WHEN o_orderkey % 41 = 0 THEN 3650 ELSE o_orderkey % 6 END AS INTEGER) AS length
    FROM orders)"""


def _long_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals of some days, of none and of ten years, which overlap and touch."""
    order = F.col("o_orderkey")
    return t.table(spark, sf_dir, "orders").select(
        t.station_key("o_custkey").alias("stationReference"),
        F.date_add(F.lit("2014-01-01").cast("date"), (order % 3700).cast("int")).alias("start"),
        F.when(order % 41 == 0, 3650).otherwise(order % 6).cast("int").alias("length"),
    )


@query(t.sql("long_intervals", """
SELECT stationReference, min(start) AS first, max(after) AS after FROM (
    SELECT *, sum(opens) OVER (PARTITION BY stationReference ORDER BY start, after) AS island FROM (
        SELECT stationReference, start, start + length AS after, CASE WHEN start <= max(start + length) OVER (
            PARTITION BY stationReference ORDER BY start, start + length
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens
        FROM (SELECT DISTINCT * FROM long_intervals WHERE length > 0)))
GROUP BY stationReference, island""", long_intervals=LONG_INTERVALS))
def merged_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.merge_intervals(_long_intervals(spark, sf_dir))


@query(t.sql("readings long_intervals", """
SELECT s.event_id, s.stationReference, s.day AS date, EXISTS (
    SELECT 1 FROM long_intervals i WHERE i.stationReference = s.stationReference
      AND s.day >= i.start AND s.day < i.start + i.length) AS in_interval
FROM (SELECT *, CAST(dateTime AS DATE) AS day FROM readings) s""", long_intervals=LONG_INTERVALS))
def interval_flag_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership in intervals of up to ten years, by merged spans and bins of days."""
    days = t.readings(spark, sf_dir).select(
        "event_id", "stationReference", F.to_date("dateTime").alias("date"))
    return ops.flag_in_spans(days, ops.merge_intervals(_long_intervals(spark, sf_dir)))


@query(t.sql(EXPECTED_CTES, """
SELECT stationReference, day AS date, in_event, season, level FROM expected""",
             spine=SPINE, expected=EXPECTED))
def seasonal_expected_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A station's median, on event days at least the mean of all stations that day."""
    return expected_levels(
        t.station_meta(spark, sf_dir), t.intervals(spark, sf_dir), _day_means(spark, sf_dir),
        START, N_DAYS,
    ).select("stationReference", "date", "in_event", "season", "level")


@query(t.sql(EXPECTED_CTES, """
SELECT stationReference, strftime(day, '%Y-%m-%d') AS date, round(level, 3) AS level,
       typical_range_low, typical_range_high,
       CASE WHEN level >= alert_threshold_very_high THEN 'Very high'
            WHEN level >= alert_threshold_high THEN 'High'
            WHEN level >= typical_range_high THEN 'Medium' ELSE 'Low' END AS flood_risk
FROM expected""", spine=SPINE, expected=EXPECTED))
def expected_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expected_risk(
        t.station_meta(spark, sf_dir), t.intervals(spark, sf_dir), _day_means(spark, sf_dir),
        START, N_DAYS,
    )


@query("""
SELECT event_id, CASE WHEN value >= 150 THEN 'Very high' WHEN value >= 75 THEN 'High'
                      WHEN value >= 25 THEN 'Medium' ELSE 'Low' END AS risk
FROM events""")
def risk_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    grade = levels.risk_level(F.col("value"), F.lit(150.0), F.lit(75.0), F.lit(25.0))
    return t.table(spark, sf_dir, "events").select("event_id", grade.alias("risk"))


@query("""
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL
                      ELSE greatest(value - 20, 0.05e0) END AS level
FROM events""")
def clamp_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.col("event_id") % 5 != 0, F.col("value") - 20)
    return t.table(spark, sf_dir, "events").select(
        "event_id", levels.clamp_min(value).alias("level")
    )


@query("""
SELECT c_custkey, printf('UK%03d', c_custkey) AS code,
       concat_ws(' ', c_mktsegment, n_name, 'Gauge') AS name
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def station_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = t.table(spark, sf_dir, "customer"), t.table(spark, sf_dir, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey",
        text.station_code(F.col("c_custkey")).alias("code"),
        text.station_name(F.col("c_mktsegment"), F.col("n_name")).alias("name"),
    )


GRADE_OF_SPREAD = """CASE WHEN spread >= 450 THEN 'Very high' WHEN spread >= 425 THEN 'High'
                          WHEN spread >= 400 THEN 'Medium' ELSE 'Low' END"""


@query(t.sql("readings baseline stations station_meta", f"""
SELECT stationReference, {GRADE_OF_SPREAD} AS spread_grade,
       CASE {GRADE_OF_SPREAD} WHEN 'Low' THEN 30 WHEN 'Medium' THEN 14 WHEN 'High' THEN 7
                              ELSE 1 END AS review_days
FROM station_meta"""))
def profile_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations graded by the spread of their readings, and when each is due for a review."""
    grade = levels.risk_level(F.col("spread"), F.lit(450.0), F.lit(425.0), F.lit(400.0))
    return t.station_meta(spark, sf_dir).select(
        "stationReference", grade.alias("spread_grade"),
        levels.lookup(levels.REVIEW_DAYS, grade).alias("review_days"),
    )


@query(t.sql("readings baseline stations station_meta", """
SELECT stationReference, typical_range_low, typical_range_high, alert_threshold_high,
       alert_threshold_very_high
FROM station_meta"""))
def range_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.station_meta(spark, sf_dir).select(
        "stationReference", "typical_range_low", "typical_range_high", "alert_threshold_high",
        "alert_threshold_very_high",
    )

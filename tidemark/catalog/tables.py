"""The test tables in the roles the operators expect, in Spark and as SQL.

Each Spark function has a SQL twin of the same name in ``CTE``; both run over whole
tables.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import calendar, levels, text
from tidemark.operators.stats import station_baseline
from tidemark.schemas import DAILY_RISK, STATION_METADATA, STATIONS

# Stations of the first five nations have no metadata where that is the point of a query.
KNOWN_NATIONS = "c_nationkey >= 5"
ISO_INSTANT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def station_key(number: str) -> F.Column:
    return F.format_string("%05dTH", F.col(number))


def plain_times(df: DataFrame) -> DataFrame:
    """Instants as zone-less timestamps, the type the SQL side has."""
    instants = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in instants})


def rounded(df: DataFrame, *columns: str, digits: int = 8) -> DataFrame:
    """Round doubles, whose last bits depend on the order of addition.

    The readings have two decimals, so the mean of fewer than 128 of them never lies
    half-way between two neighbours of eight decimals.
    """
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


CTE = {
    "readings": """readings AS (
        SELECT event_id, printf('%05dTH', user_id) AS stationReference, ts AS dateTime,
               value, event_type
        FROM events)""",
    "supplies": """supplies AS (
        SELECT printf('%05dTH', l_suppkey) AS stationReference, l_shipdate AS dateTime,
               l_extendedprice AS value
        FROM lineitem)""",
    "archive": """archive AS (
        SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS dateTime,
               strftime(ts, '%Y-%m-%d') AS date,
               'http://fixture/id/measures/' || printf('%05d', user_id)
                 || CASE WHEN event_id % 16 = 15 THEN 'th' ELSE 'TH' END
                 || '-level-stage' AS measure,
               CASE event_id % 8
                 WHEN 0 THEN CAST(value AS VARCHAR) || '|9.99'
                 WHEN 1 THEN NULL
                 WHEN 2 THEN ''
                 WHEN 3 THEN 'abc'
                 WHEN 4 THEN '-' || CAST(value AS VARCHAR)
                 ELSE CAST(value AS VARCHAR) END AS value,
               CASE WHEN event_type = 'error' THEN 'flow' ELSE 'level' END AS parameter,
               printf('%05dTH', user_id) AS stationReference,
               'Gauge ' || CAST(user_id AS VARCHAR) AS label,
               'm' AS unitName, 'instantaneous' AS valueType, event_type AS datumType
        FROM events)""",
    "stations": """stations AS (
        SELECT printf('%05dTH', c_custkey) AS stationReference, c_name AS label,
               n_name AS riverName, r_name AS catchmentName, c_mktsegment AS town,
               c_acctbal / 200e0 AS lat, c_acctbal / 100e0 AS long, 'active' AS status
        FROM customer JOIN nation ON c_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey)""",
    "station_meta": """station_meta AS (
        SELECT s.stationReference,
               concat_ws(' ', s.town, s.riverName, 'Gauge') AS stationName,
               s.riverName, s.catchmentName, s.town, s.lat, s.long,
               greatest(0.05e0, b.p05_level) AS typical_range_low,
               b.median_level AS typical_range_high, s.status,
               (b.median_level + b.p95_level) / 2 AS alert_threshold_high,
               b.p95_level AS alert_threshold_very_high,
               b.median_level AS base_level, b.p95_level - b.p05_level AS spread
        FROM stations s JOIN baseline b USING (stationReference))""",
    "daily": """daily AS (
        SELECT d.stationReference, strftime(d.day, '%Y-%m-%d') AS date, d.level,
               m.typical_range_low, m.typical_range_high,
               CASE WHEN d.level >= m.alert_threshold_very_high THEN 'Very high'
                    WHEN d.level >= m.alert_threshold_high THEN 'High'
                    WHEN d.level >= m.typical_range_high THEN 'Medium'
                    ELSE 'Low' END AS flood_risk
        FROM (SELECT stationReference, CAST(dateTime AS DATE) AS day,
                     floor(max(value)) AS level
              FROM readings GROUP BY 1, 2) d
        JOIN station_meta m USING (stationReference))""",
    "intervals": """intervals AS (
        SELECT printf('%05dTH', o_custkey) AS stationReference,
               DATE '2024-01-01' + CAST(o_orderkey % 28 AS INTEGER) AS start,
               CAST(2 + o_orderkey % 3 AS INTEGER) AS length
        FROM orders)""",
    "baseline": """baseline AS (
        SELECT stationReference, count(*) AS n_readings_total, avg(value) AS mean_level_total,
               stddev_samp(value) AS std_level_total,
               quantile_disc(value, 0.05) AS p05_level,
               quantile_disc(value, 0.5) AS median_level,
               quantile_disc(value, 0.95) AS p95_level,
               min(value) AS min_level, max(value) AS max_level
        FROM readings GROUP BY 1)""",
    "graded_baseline": """graded_baseline AS (
        SELECT b.*, s.label, s.riverName, s.catchmentName, s.town, s.lat, s.long, s.status,
               b.p95_level AS alert_threshold_high,
               b.mean_level_total + 2 * b.std_level_total AS alert_threshold_very_high
        FROM baseline b LEFT JOIN stations s USING (stationReference))""",
}


KNOWN_STATIONS = CTE["stations"].removesuffix(")") + f"\n        WHERE {KNOWN_NATIONS})"


def sql(ctes: str, body: str, **extra: str) -> str:
    """SQL text: the named CTEs in order, then the body. ``extra`` adds or replaces CTEs."""
    named = {**CTE, **extra}
    return "WITH " + ",\n".join(named[c] for c in ctes.split()) + "\n" + body


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric readings."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        station_key("user_id").alias("stationReference"),
        F.col("ts").cast("timestamp").alias("dateTime"),
        "value",
        "event_type",
    )


def supplies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings at volume."""
    return table(spark, sf_dir, "lineitem").select(
        station_key("l_suppkey").alias("stationReference"),
        F.col("l_shipdate").cast("timestamp").alias("dateTime"),
        F.col("l_extendedprice").alias("value"),
    )


def archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive rows as text, with the usual kinds of dirt in ``value`` and ``measure``."""
    value = F.col("value").cast("string")
    kind = F.col("event_id") % 8
    dirty = (
        F.when(kind == 0, F.concat(value, F.lit("|9.99")))
        .when(kind == 1, F.lit(None))
        .when(kind == 2, "")
        .when(kind == 3, "abc")
        .when(kind == 4, F.concat(F.lit("-"), value))
        .otherwise(value)
    )
    unit = F.when(F.col("event_id") % 16 == 15, "th").otherwise("TH")
    number = F.format_string("%05d", "user_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format("ts", ISO_INSTANT).alias("dateTime"),
        calendar.iso_date(F.col("ts")).alias("date"),
        F.concat(F.lit("http://fixture/id/measures/"), number, unit, F.lit("-level-stage"))
        .alias("measure"),
        dirty.alias("value"),
        F.when(F.col("event_type") == "error", "flow").otherwise("level").alias("parameter"),
        station_key("user_id").alias("stationReference"),
        F.concat(F.lit("Gauge "), F.col("user_id").cast("string")).alias("label"),
        F.lit("m").alias("unitName"),
        F.lit("instantaneous").alias("valueType"),
        F.col("event_type").alias("datumType"),
    )


def stations(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    """Station metadata, of the customers that ``where`` selects."""
    customer = table(spark, sf_dir, "customer").where(where)
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            station_key("c_custkey").alias("stationReference"),
            F.col("c_name").alias("label"),
            F.col("n_name").alias("riverName"),
            F.col("r_name").alias("catchmentName"),
            F.col("c_mktsegment").alias("town"),
            (F.col("c_acctbal") / 200.0).alias("lat"),
            (F.col("c_acctbal") / 100.0).alias("long"),
            F.lit("active").alias("status"),
        )
        .select(*STATIONS.names)
    )


def known_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of some stations only, so that some baselines lack a station."""
    return stations(spark, sf_dir, KNOWN_NATIONS)


def station_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of the stations that have readings, with the ranges observed in them."""
    observed = station_baseline(readings(spark, sf_dir)).select(
        "stationReference", "p05_level", "median_level", "p95_level"
    )
    ranges = levels.observed_ranges(
        F.col("p05_level"), F.col("median_level"), F.col("p95_level")
    )
    return stations(spark, sf_dir).join(observed, "stationReference").withColumns(
        {
            **ranges,
            "stationName": text.station_name(F.col("town"), F.col("riverName")),
            "base_level": F.col("median_level"),
            "spread": F.col("p95_level") - F.col("p05_level"),
        }
    ).select(*STATION_METADATA.names, "base_level", "spread")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risk-graded daily levels: the day's highest reading, in whole units."""
    highest = (
        readings(spark, sf_dir)
        .groupBy("stationReference", calendar.reading_date(F.col("dateTime")).alias("day"))
        .agg(F.floor(F.max("value")).cast("double").alias("level"))
    )
    graded = highest.join(station_meta(spark, sf_dir), "stationReference").withColumns(
        {
            "date": calendar.iso_date(F.col("day")),
            "flood_risk": levels.risk_level(
                F.col("level"),
                F.col("alert_threshold_very_high"),
                F.col("alert_threshold_high"),
                F.col("typical_range_high"),
            ),
        }
    )
    return graded.select(*DAILY_RISK.names)


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event intervals: start day and length in days."""
    order = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        station_key("o_custkey").alias("stationReference"),
        F.date_add(F.lit("2024-01-01").cast("date"), (order % 28).cast("int")).alias("start"),
        (order % 3 + 2).cast("int").alias("length"),
    )

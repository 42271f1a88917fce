"""File and table round trips. Written folders are fresh per run, in the shared folder."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import schemas
from tidemark.catalog import tables as t
from tidemark.catalog.registry import query
from tidemark.operators.joins import stations_view
from tidemark.operators.stats import count_sent as sent_per_file
from tidemark.session import scratch_path
from tidemark.sinks.files import load_table, write_csv, write_curated
from tidemark.sinks.messages import publish_json
from tidemark.sinks.versions import read_table, replace_days, replace_table
from tidemark.sources import files as src
from tidemark.streaming.events import encode_events

# Spark names the files it writes itself; the day is in the folder name.
SPARK_FILES = {"prefix": "part-", "suffix": ".csv"}


def write_raw_zone(
    spark: SparkSession, sf_dir: str, stations: DataFrame | None = None
) -> dict[str, str]:
    """The archive and station CSVs as the jobs expect them; all stations by default."""
    root = scratch_path(spark, "raw")
    paths = {"archive": f"{root}/archive", "stations": f"{root}/stations"}
    write_csv(t.archive(spark, sf_dir).drop("event_id"), paths["archive"])
    write_csv(stations or t.stations(spark, sf_dir), paths["stations"])
    return paths


def write_archive_days(spark: SparkSession, sf_dir: str) -> str:
    """The archive as date-stamped folders with a file each, next to files that are not
    archive files."""
    folder = scratch_path(spark, "archive-days")
    rows = t.archive(spark, sf_dir).drop("event_id")
    days = rows.withColumn("day", F.col("date")).repartition("day")
    write_csv(days, folder, partition_by="day")
    publish_json(encode_events(rows), f"{folder}/notes")
    return folder


@query(t.sql("archive", """
SELECT dateTime, measure, nullif(value, '') AS value FROM archive"""))
def csv_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings written as CSV and read back; CSV has one form for empty and NULL."""
    rows = src.read_readings(spark, write_raw_zone(spark, sf_dir)["archive"])
    return rows.withColumn("value", F.nullif(F.col("value"), F.lit("")))


@query(t.sql("stations", "SELECT * FROM stations"))
def csv_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stations_view(src.read_stations(spark, write_raw_zone(spark, sf_dir)["stations"]))


@query(t.sql("archive", """
SELECT dateTime, date, measure, nullif(value, '') AS value, parameter, stationReference, label,
       unitName, valueType, datumType
FROM archive"""))
def csv_archive_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.read_archive_text(spark, write_raw_zone(spark, sf_dir)["archive"])
    return rows.withColumn("value", F.nullif(F.col("value"), F.lit("")))


@query(t.sql("archive", """
SELECT dateTime, measure, nullif(value, '') AS value FROM archive"""))
def csv_header_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same readings under a header in another case and order."""
    folder = scratch_path(spark, "header-case")
    write_csv(t.archive(spark, sf_dir).select(
        F.col("value").alias("Value"), F.col("dateTime").alias("DATETIME"), "event_id",
        F.col("measure").alias("Measure")), folder)
    rows = src.read_readings(spark, folder)
    return rows.withColumn("value", F.nullif(F.col("value"), F.lit("")))


@query(t.sql("readings", """
SELECT CASE WHEN event_id % 11 = 0 THEN 'short' WHEN event_id % 13 = 0 THEN 'long' ELSE 'row' END AS kind,
       count(*) AS n, sum(event_id)::BIGINT AS ids
FROM readings GROUP BY 1"""))
def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files with lines that lack a field or have one too many; those are set aside whole."""
    folder, number = scratch_path(spark, "dirty"), F.col("event_id")
    fields = [F.col("dateTime").cast("string"), F.concat(F.lit("m/"), number.cast("string"))]
    line = (F.when(number % 11 == 0, F.concat_ws(",", *fields))
            .when(number % 13 == 0, F.concat_ws(",", *fields, F.lit("1"), F.lit("2")))
            .otherwise(F.concat_ws(",", *fields, F.col("value").cast("string"))))
    lines = t.readings(spark, sf_dir).select(line.alias("value"), (number % 4).alias("part"), F.lit(1).alias("_o"))
    headers = spark.range(4).select(
        F.lit("dateTime,measure,value").alias("value"), F.col("id").alias("part"), F.lit(0).alias("_o"))
    whole = lines.unionByName(headers).repartition("part").sortWithinPartitions("part", "_o")
    whole.drop("_o").write.partitionBy("part").text(folder)
    good, bad = src.read_csv_checked(spark, folder, schemas.READINGS, required=["value"])
    size = F.size(F.split("line", ","))
    kinds = good.select(F.lit("row").alias("kind"), "measure").unionByName(bad.select(
        F.when(size < 3, "short").otherwise("long").alias("kind"),
        F.get(F.split("line", ","), F.lit(1)).alias("measure")))
    number = F.regexp_extract("measure", "[0-9]+", 0).cast("long")
    return kinds.groupBy("kind").agg(F.count("*").alias("n"), F.sum(number).alias("ids"))


@query(t.sql("readings baseline stations station_meta", """
SELECT * EXCLUDE (base_level, spread) FROM station_meta"""))
def csv_station_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "station-metadata")
    write_csv(t.station_meta(spark, sf_dir).select(*schemas.STATION_METADATA.names), path)
    return src.read_csv(spark, path, schemas.STATION_METADATA)


@query(t.sql("archive", """
SELECT CAST(date AS DATE) AS file_date, count(*) AS n_rows,
       CAST(row_number() OVER (ORDER BY date DESC) AS INTEGER) AS position
FROM archive GROUP BY date"""))
def archive_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive files newest first, with their places."""
    archive = src.archive_files(spark, write_archive_days(spark, sf_dir), **SPARK_FILES)
    files = src.archive_order(archive, newest_first=True)
    return files.select("file_date", "n_rows", "position")


@query(t.sql("archive", """
SELECT CAST(date AS DATE) AS file_date, count(*) AS n_sent FROM archive
WHERE parameter = 'level' GROUP BY 1"""))
def count_sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = src.archive_files(spark, write_archive_days(spark, sf_dir), **SPARK_FILES)
    return sent_per_file(archive.where(F.col("parameter") == "level"), "file_date")


@query(t.sql("archive", "SELECT dateTime, stationReference, label FROM archive"))
def replay_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All archive files as one union."""
    folder = write_archive_days(spark, sf_dir)
    rows = src.replay_all(
        spark, folder, schemas.ARCHIVE_ROW, **src.selection(**SPARK_FILES)
    )
    return rows.select("dateTime", "stationReference", "label")


@query(t.sql("archive", """
SELECT stationReference, nullif(value, '') AS value, NULL::VARCHAR AS label
FROM archive WHERE parameter = 'level'
UNION ALL
SELECT stationReference, NULL, label FROM archive WHERE parameter <> 'level'"""))
def union_by_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders with different headers; columns a folder lacks are NULL."""
    root = scratch_path(spark, "headers")
    rows, is_level = t.archive(spark, sf_dir), F.col("parameter") == "level"
    write_csv(rows.where(is_level).select("value", "stationReference"), f"{root}/level")
    write_csv(rows.where(~is_level).select("stationReference", "label"), f"{root}/other")
    return src.union_by_header(spark, [f"{root}/level", f"{root}/other"]).select(
        "stationReference", F.nullif(F.col("value"), F.lit("")).alias("value"), "label"
    )


@query(t.sql("readings", "SELECT * FROM readings"))
def curated_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice: the second write replaces the first."""
    path = scratch_path(spark, "curated")
    for _ in range(2):
        write_curated(t.readings(spark, sf_dir), path)
    return t.plain_times(src.read_baseline(spark, path))


@query(t.sql("readings", "SELECT * FROM readings"))
def load_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, location = scratch_path(spark, "curated"), scratch_path(spark, "warehouse")
    write_curated(t.readings(spark, sf_dir), path)
    name = "tidemark_" + location.rsplit("-", 1)[1]
    load_table(spark, path, name, location)
    spark.sql(f"DROP TABLE {name}")  # its files stay at the location
    return t.plain_times(src.read_baseline(spark, location))


@query(t.sql("readings", """
SELECT stationReference, CAST(dateTime AS DATE) AS reading_date, count(*) AS n_rows
FROM readings GROUP BY 1, 2"""))
def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated by day; the day comes back from the folder names."""
    path = scratch_path(spark, "by-day")
    dated = t.readings(spark, sf_dir).withColumn("reading_date", F.to_date("dateTime"))
    write_curated(dated, path, partition_by="reading_date")
    by_day = src.read_baseline(spark, path)
    return by_day.groupBy("stationReference", "reading_date").agg(F.count("*").alias("n_rows"))


@query(t.sql("readings", "SELECT * FROM readings WHERE event_id % 2 = 0"))
def replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced twice; the second time from itself, while it is open."""
    path, readings = scratch_path(spark, "replaced"), t.readings(spark, sf_dir)
    replace_table(readings, path)
    replace_table(read_table(spark, path).where(F.col("event_id") % 2 == 0), path)
    return t.plain_times(read_table(spark, path))


@query(t.sql("readings", """
SELECT event_id, stationReference, dateTime, CAST(dateTime AS DATE) AS reading_date,
       CASE WHEN day(dateTime) % 3 = 0 THEN -value ELSE value END AS value
FROM readings"""))
def replaced_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the days corrected and written anew; the others stay as they are."""
    path = scratch_path(spark, "days")
    days = t.readings(spark, sf_dir).drop("event_type").withColumn("reading_date", F.to_date("dateTime"))
    write_curated(days, path, partition_by="reading_date")
    late = days.where(F.dayofmonth("reading_date") % 3 == 0).withColumn("value", -F.col("value"))
    replace_days(late, path)
    return t.plain_times(src.read_baseline(spark, path)).select(
        "event_id", "stationReference", "dateTime", "reading_date", "value")

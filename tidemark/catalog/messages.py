"""Message queries: encode, decode, replay."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog import tables as t
from tidemark.catalog.alerts import WINDOW_BODY, WINDOW_MOMENTS, window_sql
from tidemark.catalog.cleaning import STRICT_NUMBER
from tidemark.catalog.files import SPARK_FILES, write_archive_days
from tidemark.catalog.registry import query
from tidemark.operators.stats import observe_sent as observed
from tidemark.plans.replay import replay_in_order
from tidemark.schemas import EVENT_SCHEMA
from tidemark.session import scratch_path
from tidemark.sinks.files import write_csv
from tidemark.sinks.messages import publish_json
from tidemark.sources import files as src
from tidemark.sources.replay import replay_by_name
from tidemark.streaming import events as ops
from tidemark.streaming.alerts import run, run_to_end, start_alerts
from tidemark.streaming.quarantine import accepted, checked_events, start_quarantine
from tidemark.streaming.windows import flatten_window, windowed_stats as stats_by_window

REPLAYED = f"""
SELECT stationReference, CAST(replace(dateTime, 'Z', '') AS TIMESTAMP) AS dateTime,
       CAST(trim(value) AS DOUBLE) AS value, label AS stationName
FROM archive WHERE parameter = 'level' AND {STRICT_NUMBER}"""


@query(t.sql("readings", "SELECT stationReference, dateTime, value FROM readings"))
def event_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings to JSON bytes and back."""
    messages = ops.encode_events(t.readings(spark, sf_dir))
    events = ops.valid_events(ops.parse_events(messages))
    return t.plain_times(events.select("stationReference", "dateTime", "value"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = t.table(spark, sf_dir, "events").select("event_id", "props")
    return props.withColumn("k", F.from_json("props", "k INT")["k"]).drop("props")


@query("SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def parse_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = t.table(spark, sf_dir, "events")
    return ops.parse_json(events, "props", "k INT")


@query(t.sql("archive replayed", """
SELECT *, CAST(dense_rank() OVER (ORDER BY CAST(dateTime AS DATE)) AS INTEGER) AS position
FROM replayed""", replayed=f"replayed AS ({REPLAYED})"))
def replay_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive files to published JSON messages to events, in the order of the dates in their
    names; ``position`` is the place of a message's file."""
    root, archive = scratch_path(spark, "topic"), write_archive_days(spark, sf_dir)

    def publish(messages: DataFrame) -> None:
        publish_json(messages, root, partition_by="position")

    replay_in_order(spark, archive, publish, files_per_job=15, **SPARK_FILES)
    published = spark.read.text(root)
    parsed = published.select("position", F.from_json("value", EVENT_SCHEMA).alias("e"))
    events = ops.valid_events(parsed.select("position", "e.*"))
    return t.plain_times(
        events.select("stationReference", "dateTime", "value", "stationName", "position"))


@query(t.sql("archive", REPLAYED))
def replay_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same archive through the throttled streaming source, ten files at a time."""
    root, archive = scratch_path(spark, "replay"), write_archive_days(spark, sf_dir)
    rows = src.replay_stream(spark, archive, max_files=10, **SPARK_FILES)
    events = ops.parse_events(ops.encode_events(ops.archive_events(rows)))
    run(start_alerts(events, f"{root}/out", f"{root}/checkpoint", interval=None))
    out = src.read_baseline(spark, f"{root}/out")
    return t.plain_times(out.select("stationReference", "dateTime", "value", "stationName"))


@query(t.sql("archive replayed windows", WINDOW_BODY, replayed=f"replayed AS ({REPLAYED})",
             windows=window_sql("12 hours", 2, "replayed", closed=True)))
def replay_windows_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows over the archive as a stream in the order of its files' names, in batches of
    a tenth of its rows. The files of the later half are the older ones by modification time,
    so a stream that went by these would drop the earlier half as late."""
    root = scratch_path(spark, "by-name")
    rows = t.archive(spark, sf_dir).drop("event_id")
    days = rows.withColumn("day", F.col("date")).repartition("day").sortWithinPartitions("day", "dateTime")
    middle, n = rows.agg(F.percentile_approx(F.to_date("date"), 0.5), F.count("*")).first()
    for half, later in (("b", True), ("a", False)):
        own = days.where((F.to_date("date") >= F.lit(middle)) == later)
        write_csv(own, f"{root}/in/{half}", partition_by="day")
    stream = replay_by_name(spark, f"{root}/in", max(n // 10, 1), **SPARK_FILES)
    events = ops.valid_events(ops.parse_events(ops.encode_events(ops.archive_events(stream))))
    windows = flatten_window(stats_by_window(events, "1 day", "12 hours"))
    run_to_end(start_alerts(windows, f"{root}/out", f"{root}/checkpoint", interval="0 seconds", files=1))
    return t.plain_times(t.rounded(src.read_baseline(spark, f"{root}/out"), *WINDOW_MOMENTS))


@query("""
SELECT reason, count(*) AS n FROM (
    SELECT CASE WHEN event_id % 13 = 0 OR event_id % 17 = 0 OR event_id % 19 = 0 THEN 'malformed'
                WHEN event_id % 23 = 0 THEN 'no station or time' ELSE 'accepted' END AS reason
    FROM events) GROUP BY 1""")
def quarantined_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream's messages, some of them garbage, cut off, of another type or without a station:
    what windows take and what a second stream sets aside add up to all of them."""
    root, number = scratch_path(spark, "quarantine"), F.col("event_id")
    readings = t.readings(spark, sf_dir)
    plain = ops.encode_events(readings.drop("event_type"), keep=["event_id"])
    text = F.col("value").cast("string")
    nameless = F.regexp_replace(text, '"stationReference":"[^"]*"', '"stationReference":null')
    dirty = (F.when(number % 13 == 0, "no json").when(number % 17 == 0, F.left(text, F.lit(40)))
             .when(number % 19 == 0, F.regexp_replace(text, '"value":([0-9.]+)', '"value":"$1"'))
             .when(number % 23 == 0, nameless).otherwise(text))
    publish_json(plain.select(dirty.alias("value")).repartition(4), f"{root}/topic")
    messages = src.json_events_stream(spark, f"{root}/topic", max_files=2)
    run(start_quarantine(messages, f"{root}/bad", f"{root}/c1", interval=None))
    good = accepted(checked_events(messages))
    run(start_alerts(good, f"{root}/good", f"{root}/c2", interval=None))
    parts = spark.read.parquet(f"{root}/bad").select(F.col("reject_reason").alias("reason")).unionByName(
        spark.read.parquet(f"{root}/good").select(F.lit("accepted").alias("reason")))
    return parts.groupBy("reason").agg(F.count("*").alias("n"))


@query(t.sql("archive", f"""
SELECT count(*) AS n_sent FROM archive WHERE parameter = 'level' AND {STRICT_NUMBER}"""))
def observe_sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages counted while they are published, without a second pass."""
    events, sent = observed(ops.archive_events(t.archive(spark, sf_dir)))
    publish_json(ops.encode_events(events), scratch_path(spark, "topic"))
    return spark.createDataFrame([(sent.get["n_sent"],)], "n_sent long")

"""Window and alert queries, in batch and as streams."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog import tables as t
from tidemark.catalog.registry import query
from tidemark.functions import levels
from tidemark.operators.joins import reading_baseline
from tidemark.operators.stats import station_baseline
from tidemark.plans.batch_baseline import baseline_table
from tidemark.plans.stream_alerts import stream_alerts
from tidemark.schemas import LEVEL_EVENT
from tidemark.session import scratch_path
from tidemark.sinks.files import write_curated
from tidemark.sinks.messages import publish_json
from tidemark.sinks.versions import compact, read_compacted
from tidemark.sources.files import json_events_stream, read_baseline
from tidemark.streaming import alerts as ops
from tidemark.streaming.counts import counts_of, observed_events
from tidemark.streaming.events import encode_events, parse_events, valid_events
from tidemark.streaming.windows import (
    flatten_window, open_windows, paned_stats, windowed_stats as stats_by_window,
)

WINDOW_MOMENTS = ["mean_level_window", "std_level_window"]
ALERT_DOUBLES = [
    *WINDOW_MOMENTS, "mean_level_total", "std_level_total", "z_score",
    "alert_threshold_very_high",
]
WINDOW_BODY = """
SELECT stationReference, window_start, window_end, n_readings_window,
       round(mean_level_window, 8) AS mean_level_window,
       round(std_level_window, 8) AS std_level_window
FROM windows"""


def window_sql(slide: str, copies: int, source: str = "readings", closed: bool = False) -> str:
    """SQL for sliding windows: each reading goes to ``copies`` consecutive windows."""
    step = f"INTERVAL '{slide}'"
    end = f"time_bucket({step}, dateTime) - k * {step} + {copies} * {step}"
    until = (
        f"WHERE {end} <= (SELECT max(dateTime) FROM {source}) - INTERVAL '10 minutes'"
        if closed else ""
    )
    return f"""windows AS (
    SELECT stationReference, time_bucket({step}, dateTime) - k * {step} AS window_start,
           {end} AS window_end, count(*) AS n_readings_window,
           avg(value) AS mean_level_window, stddev_samp(value) AS std_level_window
    FROM {source}, range(0, {copies}) r(k) {until}
    GROUP BY 1, 2, 3)"""


ALERT_BODY = """
SELECT stationReference, window_start, window_end, n_readings_window,
       round(mean_level_window, 8) AS mean_level_window,
       round(std_level_window, 8) AS std_level_window,
       round(mean_level_total, 8) AS mean_level_total,
       round(std_level_total, 8) AS std_level_total,
       round((mean_level_window - mean_level_total) / nullif(std_level_total, 0), 8) AS z_score,
       CASE WHEN mean_level_window >= alert_threshold_very_high THEN 'RED'
            WHEN mean_level_window >= alert_threshold_high THEN 'AMBER'
            ELSE 'NORMAL' END AS alert_level,
       alert_threshold_high, round(alert_threshold_very_high, 8) AS alert_threshold_very_high,
       riverName, catchmentName, town
FROM windows LEFT JOIN graded_baseline USING (stationReference)"""
ALERT_CTES = "readings baseline stations graded_baseline windows"


def _comparable(alerts: DataFrame) -> DataFrame:
    return t.plain_times(t.rounded(alerts, *ALERT_DOUBLES))


def _batch_alerts(spark: SparkSession, sf_dir: str, *window: str) -> DataFrame:
    readings = t.readings(spark, sf_dir)
    baseline = baseline_table(readings, t.known_stations(spark, sf_dir))
    return _comparable(ops.grade_windows(stats_by_window(readings, *window), baseline))


@query(t.sql("readings windows", WINDOW_BODY, windows=window_sql("5 minutes", 2)))
def windowed_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = flatten_window(stats_by_window(t.readings(spark, sf_dir)))
    return t.plain_times(t.rounded(windows, *WINDOW_MOMENTS))


@query(t.sql("readings windows", WINDOW_BODY, windows=window_sql("12 hours", 2)))
def windowed_stats_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide windows, which hold several readings each."""
    windows = flatten_window(stats_by_window(t.readings(spark, sf_dir), "1 day", "12 hours"))
    return t.plain_times(t.rounded(windows, *WINDOW_MOMENTS))


@query(t.sql(ALERT_CTES, ALERT_BODY, stations=t.KNOWN_STATIONS,
             windows=window_sql("5 minutes", 2)))
def alerts_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batch_alerts(spark, sf_dir)


@query(t.sql(ALERT_CTES, ALERT_BODY, stations=t.KNOWN_STATIONS,
             windows=window_sql("12 hours", 2)))
def alerts_batch_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batch_alerts(spark, sf_dir, "1 day", "12 hours")


@query(t.sql("readings baseline", """
SELECT r.event_id,
       round((r.value - b.mean_level_total) / nullif(b.std_level_total, 0), 8) AS z_score,
       CASE WHEN r.value >= b.mean_level_total + 2 * b.std_level_total THEN 'RED'
            WHEN r.value >= b.p95_level THEN 'AMBER'
            WHEN b.stationReference IS NULL THEN 'UNKNOWN'
            ELSE 'NORMAL' END AS alert_level
FROM readings r LEFT JOIN (SELECT * FROM baseline WHERE mean_level_total >= 45) b
  USING (stationReference)"""))
def reading_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every single reading graded; stations without baseline get a grade of their own."""
    readings = t.readings(spark, sf_dir)
    baseline = station_baseline(readings).where("mean_level_total >= 45")
    mean, std = F.col("mean_level_total"), F.col("std_level_total")
    very_high = levels.very_high_threshold(mean, std)
    joined = reading_baseline(readings, baseline)
    return joined.select(
        "event_id",
        F.round(levels.z_score(F.col("value"), mean, std), 8).alias("z_score"),
        levels.alert_level(F.col("value"), very_high, F.col("p95_level"), "UNKNOWN")
        .alias("alert_level"),
    )


def _publish(events: DataFrame, topic: str) -> None:
    publish_json(encode_events(events.drop("event_id", "event_type")), topic)


BAD_VALUES = "event_id % 7 = 0 OR event_id % 11 = 0"


@query(t.sql("readings finite windows", WINDOW_BODY, finite=f"""finite AS (
    SELECT stationReference, dateTime, CASE WHEN NOT ({BAD_VALUES}) THEN value END AS value
    FROM readings)""", windows=window_sql("12 hours", 2, source="finite")))
def windowed_stats_not_finite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages whose value is NaN or infinite count in their windows, but not in the mean."""
    readings = t.readings(spark, sf_dir)
    value = F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).when(
        F.col("event_id") % 11 == 0, F.lit(float("-inf"))).otherwise(F.col("value"))
    topic = scratch_path(spark, "topic")
    _publish(readings.withColumn("value", value), topic)
    events = valid_events(parse_events(spark.read.text(topic), LEVEL_EVENT))
    windows = flatten_window(stats_by_window(events, "1 day", "12 hours"))
    return t.plain_times(t.rounded(windows, *WINDOW_MOMENTS))


#: Parts that the readings are published in, and the least rows in each of a part's files if it
#: has more than one.
PARTS, FILE_ROWS = 5, 100_000


def prepare_stream(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the baseline and the published readings."""
    root = scratch_path(spark, "alerts")
    readings = t.readings(spark, sf_dir)
    write_curated(baseline_table(readings, t.known_stations(spark, sf_dir)), f"{root}/baseline")
    # In the order of time, each part written after the one before: at least five micro-batches.
    steps = [i / PARTS for i in range(1, PARTS)]
    cuts = readings.agg(F.percentile_approx(F.unix_micros("dateTime"), steps)).first()[0] or []
    part = sum((F.unix_micros("dateTime") > cut).cast("int") for cut in cuts) + F.lit(0)
    sizes = readings.where("dateTime IS NOT NULL").groupBy(part.alias("part")).count().collect()
    rows = [r["count"] for r in sizes]
    # As many files in every part, so that a micro-batch can take just one part.
    files = max(1, min(rows) // FILE_ROWS) if len(rows) == PARTS else 1
    for i in range(PARTS):
        _publish(readings.where(part == i).repartition(files), f"{root}/topic")
    found = len(spark.read.text(f"{root}/topic").inputFiles())
    if found != files * PARTS:
        raise ValueError(f"{found} files published instead of {files} in each of {PARTS} parts")
    return root


def part_stream(spark: SparkSession, root: str) -> DataFrame:
    """The published readings as a stream of messages, a part in each micro-batch."""
    topic = f"{root}/topic"
    files = len(spark.read.text(topic).inputFiles())
    return json_events_stream(spark, topic, max_files=files // PARTS)


def run_stream(spark: SparkSession, root: str, refresh: bool = False) -> DataFrame:
    """Stream the published readings to the end, a part at a time, and read the alerts."""
    started = stream_alerts(
        spark, part_stream(spark, root), f"{root}/baseline",
        f"{root}/out", f"{root}/checkpoint", interval=None, refresh=refresh,
    )
    ops.run(started)
    return read_baseline(spark, f"{root}/out")


def _stream(spark: SparkSession, sf_dir: str, refresh: bool) -> DataFrame:
    alerts = run_stream(spark, prepare_stream(spark, sf_dir), refresh)
    return _comparable(alerts.drop("batch_id"))


@query(t.sql(ALERT_CTES, ALERT_BODY, stations=t.KNOWN_STATIONS,
             windows=window_sql("5 minutes", 2, closed=True)))
def alerts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alert stream: all windows that the watermark has closed."""
    return _stream(spark, sf_dir, refresh=False)


@query(t.sql(ALERT_CTES, ALERT_BODY, stations=t.KNOWN_STATIONS,
             windows=window_sql("5 minutes", 2, closed=True)))
def alerts_stream_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, re-reading the baseline in every micro-batch."""
    return _stream(spark, sf_dir, refresh=True)


def _stream_windows(spark: SparkSession, sf_dir: str, form, *window: str) -> tuple[DataFrame, str]:
    """Windows of the published readings, streamed to the end, and the stream's checkpoint."""
    root = prepare_stream(spark, sf_dir)
    events = valid_events(parse_events(part_stream(spark, root), LEVEL_EVENT))
    windows = flatten_window(form(events, *window))
    ops.run(ops.start_alerts(windows, f"{root}/out", f"{root}/checkpoint", interval=None))
    return read_baseline(spark, f"{root}/out"), f"{root}/checkpoint"


@query(t.sql("readings windows", WINDOW_BODY, windows=window_sql("5 minutes", 12, closed=True)))
def windowed_stats_paned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of long windows, merged from panes: all that the watermark has closed."""
    closed, _ = _stream_windows(spark, sf_dir, paned_stats, "1 hour", "5 minutes")
    return t.plain_times(t.rounded(closed, *WINDOW_MOMENTS))


@query(t.sql("readings windows", WINDOW_BODY, windows=window_sql("12 hours", 2)))
def windows_closed_and_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream has put out and what its state still holds: together all windows."""
    closed, checkpoint = _stream_windows(spark, sf_dir, stats_by_window, "1 day", "12 hours")
    held = flatten_window(open_windows(spark, checkpoint))
    return t.plain_times(t.rounded(closed.unionByName(held), *WINDOW_MOMENTS))


@query(t.sql("readings windows", WINDOW_BODY, windows=window_sql("12 hours", 2, closed=True)))
def compacted_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream's output, compacted in the middle and read with what came after."""
    root = prepare_stream(spark, sf_dir)
    out, packed = f"{root}/out", f"{root}/packed"
    windows = flatten_window(stats_by_window(
        valid_events(parse_events(part_stream(spark, root), LEVEL_EVENT)), "1 day", "12 hours"))
    started = ops.start_alerts(windows, out, f"{root}/checkpoint", interval=None)
    while not started.awaitTermination(0.5):
        if started.lastProgress and started.lastProgress.batchId >= 2:
            compact(spark, out, packed)
            break
    ops.run(started)
    return t.plain_times(t.rounded(read_compacted(spark, out, packed), *WINDOW_MOMENTS))


@query(t.sql("readings", """
SELECT count(*) AS n_messages, count(*) FILTER (event_id % 9 = 0 OR event_id % 10 = 0) AS n_rejected
FROM readings"""))
def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages counted by a listener while a stream runs, some without a station or a time."""
    root, number = scratch_path(spark, "counts"), F.col("event_id")
    readings = t.readings(spark, sf_dir).withColumns({
        "stationReference": F.when(number % 9 != 0, F.col("stationReference")),
        "dateTime": F.when(number % 10 != 0, F.col("dateTime")),
    })
    _publish(readings.repartition(6, "event_id"), f"{root}/topic")
    messages = json_events_stream(spark, f"{root}/topic", max_files=2)
    events = valid_events(observed_events(parse_events(messages, LEVEL_EVENT)))
    found = ops.start_alerts(events, f"{root}/out", f"{root}/checkpoint", interval=None)
    counts = counts_of(ops.run(found))
    return spark.createDataFrame(
        [(counts["n_messages"], counts["n_rejected"])], "n_messages long, n_rejected long")


NEWER_HALF = """newer AS (
    SELECT * FROM readings
    WHERE dateTime >= (SELECT min(dateTime) + (max(dateTime) - min(dateTime)) / 2
                       FROM readings))"""


@query(t.sql("readings newer windows", WINDOW_BODY, newer=NEWER_HALF,
             windows=window_sql("5 minutes", 2, source="newer", closed=True)))
def late_data_lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest half first: the older half arrives behind the watermark and is dropped.

    The second run continues from the first one's checkpoint, as after a restart.
    """
    root = scratch_path(spark, "late")
    readings = t.readings(spark, sf_dir)
    first, last = F.min("dateTime"), F.max("dateTime")
    middle = readings.agg(first + (last - first) / 2).scalar()
    for half in (F.col("dateTime") >= middle, F.col("dateTime") < middle):
        _publish(readings.where(half), f"{root}/topic")
        events = valid_events(parse_events(json_events_stream(spark, f"{root}/topic")))
        windows = flatten_window(stats_by_window(events))
        started = ops.start_alerts(windows, f"{root}/out", f"{root}/checkpoint", interval=None)
        ops.run(started)
    return t.plain_times(t.rounded(read_baseline(spark, f"{root}/out"), *WINDOW_MOMENTS))

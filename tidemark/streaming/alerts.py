"""Alert grading and the streaming sinks."""

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import levels
from tidemark.operators.dedupe import dedupe_station
from tidemark.operators.joins import baseline_view, join_baseline
from tidemark.schemas import ALERT_COLUMNS
from tidemark.sinks.versions import read_either
from tidemark.streaming.counts import counted, counts_of, stop_counting
from tidemark.streaming.windows import flatten_window

# Fixed value: default micro-batch interval.
TRIGGER_INTERVAL = "30 seconds"


def grade_windows(
    windows: DataFrame,
    baseline: DataFrame,
    unknown: str = levels.ALERT_NORMAL,
    unique: bool = False,
) -> DataFrame:
    """Windows to alerts: baseline join, z-score, alert level. Works on both kinds.

    ``unique`` says that the baseline has one row per station, as the batch job writes it; a
    stream then joins it as read, instead of deduplicating it in every micro-batch.
    """
    known = baseline_view(baseline)
    joined = join_baseline(windows, known if unique else dedupe_station(known))
    level = F.col("mean_level_window")
    graded = joined.withColumns(
        {
            "z_score": levels.z_score(level, F.col("mean_level_total"), F.col("std_level_total")),
            "alert_level": levels.alert_level(
                level,
                F.col("alert_threshold_very_high"),
                F.col("alert_threshold_high"),
                unknown,
            ),
        }
    )
    return flatten_window(graded).select(*ALERT_COLUMNS)


def _trigger(interval: str | None) -> dict:
    return {"processingTime": interval} if interval else {"availableNow": True}


def _pack(alerts: DataFrame, files: int | None) -> DataFrame:
    return alerts.repartition(files) if files else alerts


def start_alerts(
    alerts: DataFrame,
    out: str,
    checkpoint: str,
    interval: str | None = TRIGGER_INTERVAL,
    files: int | None = None,
) -> StreamingQuery:
    """Append closed windows to Parquet, exactly once.

    ``interval=None`` processes what is there and stops (backfill, tests). ``files`` packs
    each micro-batch into that many files; by default every state partition writes its
    own, which with many partitions and short intervals makes many small files.
    """
    return counted(
        alerts.sparkSession,
        _pack(alerts, files).writeStream.outputMode("append")
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start,
    )


def baseline_writer(
    baseline_path: str,
    out: str,
    unknown: str = levels.ALERT_NORMAL,
    files: int | None = None,
    unique: bool = False,
) -> Callable[[DataFrame, int], None]:
    """Batch function that grades closed windows against the baseline of the moment.

    Each batch overwrites its own folder, so a batch repeated after a failure replaces
    its first attempt. A baseline that is replaced at once (:mod:`tidemark.sinks.versions`) is
    found whole; a batch that finds one half overwritten fails rather than grade without it, and
    is repeated when the query restarts.
    """
    def write(windows: DataFrame, batch_id: int) -> None:
        baseline = read_either(windows.sparkSession, baseline_path)
        alerts = grade_windows(windows, baseline, unknown, unique)
        _pack(alerts, files).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return write


def start_alerts_refreshing(
    windows: DataFrame,
    baseline_path: str,
    out: str,
    checkpoint: str,
    interval: str | None = TRIGGER_INTERVAL,
    files: int | None = None,
    unknown: str = levels.ALERT_NORMAL,
    unique: bool = False,
) -> StreamingQuery:
    """Like :func:`start_alerts`, but re-reads the baseline in every micro-batch, so the
    batch job may overwrite it while the stream runs."""
    return counted(
        windows.sparkSession,
        windows.writeStream.outputMode("append")
        .foreachBatch(baseline_writer(baseline_path, out, unknown, files, unique))
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start,
    )


def run(query: StreamingQuery, timeout: int | None = None) -> StreamingQuery:
    """Block until the query ends. With a timeout (seconds) a query still running then
    is stopped and reported, so a caller never reads half a result."""
    try:
        if timeout is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout):
            query.stop()
            raise TimeoutError(f"stream still running after {timeout} s")
    finally:
        stop_counting(query)
    return query


def run_to_end(query: StreamingQuery) -> StreamingQuery:
    """Let a query with an interval go on until its source has nothing new, then stop it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
        stop_counting(query)
    return query


def late_rows(query: StreamingQuery) -> int:
    """Partial window rows dropped behind the watermark since this run of the query began.
    Counted after partial aggregation, so not in readings."""
    return counts_of(query)["n_late"]

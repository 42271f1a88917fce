"""What a stream has taken in, counted while it runs.

A listener adds up the progress of every micro-batch, so nothing is lost however many there
are, and nothing has to look at the query from time to time.
"""

import threading
from collections import Counter

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.streaming.events import is_event

OBSERVED = "readings"
#: Seconds to wait for the listener to hear of a query that has ended.
PATIENCE = 60


def observed_events(events: DataFrame) -> DataFrame:
    """The events, counted as they pass: ``n_messages`` in all, and ``n_rejected`` of them
    without a station or a time, which no window can take."""
    rejected = F.count_if(~F.coalesce(is_event(), F.lit(False)))
    return events.observe(
        OBSERVED, F.count("*").alias("n_messages"), rejected.alias("n_rejected"))


class RunCounts(StreamingQueryListener):
    """Totals of one run of a query: ``n_batches``, ``n_rows`` read from the source, ``n_late``
    (partial window rows dropped behind the watermark), ``n_updated`` state rows, and what
    :func:`observed_events` counts."""

    def __init__(self) -> None:
        self.by_run: dict[str, Counter] = {}
        self.ended: dict[str, threading.Event] = {}
        self.lock = threading.Lock()

    def _of(self, run: str) -> tuple[Counter, threading.Event]:
        with self.lock:
            return (self.by_run.setdefault(run, Counter()),
                    self.ended.setdefault(run, threading.Event()))

    def onQueryStarted(self, event) -> None:
        self._of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts, _ = self._of(str(progress.runId))
        with self.lock:
            counts["n_batches"] += 1
            counts["n_rows"] += max(progress.numInputRows, 0)
            for state in progress.stateOperators:
                counts["n_late"] += state.numRowsDroppedByWatermark
                counts["n_updated"] += state.numRowsUpdated
            for row in progress.observedMetrics.values():
                counts.update(row.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._of(str(event.runId))[1].set()

    def of(self, query: StreamingQuery) -> Counter:
        """The totals so far; of a query that has ended, all of them."""
        counts, ended = self._of(str(query.runId))
        if not query.isActive and not ended.wait(PATIENCE):
            raise TimeoutError("the end of the query was not reported")
        with self.lock:
            return Counter(counts)


def counted(spark: SparkSession, start) -> StreamingQuery:
    """Starts a query by ``start()`` and counts it from its first micro-batch on. The counts live
    and end with the query: :func:`counts_of` reads them, :func:`stop_counting` takes the
    listener off the session."""
    listener = RunCounts()
    spark.streams.addListener(listener)
    try:
        query = start()
    except Exception:
        spark.streams.removeListener(listener)
        raise
    query.run_counts, query.counting = listener, spark
    return query


def counts_of(query: StreamingQuery) -> Counter:
    """Totals of a query that :func:`counted` has started."""
    return query.run_counts.of(query)


def stop_counting(query: StreamingQuery) -> None:
    """Wait for the last counts of a query that has ended, and stop listening."""
    spark = getattr(query, "counting", None)
    if spark is not None and not query.isActive:
        query.run_counts.of(query)
        spark.streams.removeListener(query.run_counts)
        query.counting = None

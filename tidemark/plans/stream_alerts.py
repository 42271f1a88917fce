"""Streaming job: event messages to graded alert windows."""

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.levels import ALERT_NORMAL
from tidemark.schemas import LEVEL_EVENT
from tidemark.session import build_session
from tidemark.sinks.versions import read_either
from tidemark.sources.files import json_events_stream
from tidemark.sources.kafka import kafka_events
from tidemark.streaming.alerts import (
    TRIGGER_INTERVAL, grade_windows, run, start_alerts, start_alerts_refreshing,
)
from tidemark.streaming.counts import observed_events
from tidemark.streaming.events import parse_events, valid_events
from tidemark.streaming.windows import (
    WATERMARK_DELAY, WINDOW_SIZE, WINDOW_SLIDE, grouped_stats, paned_stats,
)


def stream_alerts(
    spark: SparkSession,
    messages: DataFrame,
    baseline_path: str,
    out: str,
    checkpoint: str,
    interval: str | None = TRIGGER_INTERVAL,
    refresh: bool = False,
    size: str = WINDOW_SIZE,
    slide: str = WINDOW_SLIDE,
    delay: str = WATERMARK_DELAY,
    files: int | None = None,
    unknown: str = ALERT_NORMAL,
    unique: bool = True,
    panes: bool = False,
) -> StreamingQuery:
    """Start the alert stream over a streaming table of messages.

    Only the three fields that the windows use are parsed. ``unknown`` grades windows of
    stations without thresholds; ``unique=False`` is for baselines that may hold a station
    twice.

    ``refresh`` re-reads the baseline in each micro-batch; the default keeps the files
    it saw at the start and is for a baseline that is not overwritten meanwhile. ``files``
    limits the output files per micro-batch. Open windows are kept by groups of stations.
    ``panes`` gathers readings in panes of the slide's length first, for windows many times as
    long and intervals shorter than the slide; a checkpoint belongs to one of the two forms, and
    one with a state row for each window to neither. What comes in is counted, see
    :mod:`tidemark.streaming.counts`.
    """
    events = valid_events(observed_events(parse_events(messages, LEVEL_EVENT)))
    windows = (paned_stats if panes else grouped_stats)(events, size, slide, delay)
    if refresh:
        return start_alerts_refreshing(
            windows, baseline_path, out, checkpoint, interval, files, unknown, unique
        )
    alerts = grade_windows(windows, read_either(spark, baseline_path), unknown, unique)
    return start_alerts(alerts, out, checkpoint, interval, files)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka bootstrap servers")
    source.add_argument("--json", help="folder of JSON-lines events")
    parser.add_argument("--topic", help="Kafka topic")
    parser.add_argument("--starting", default="earliest", help="Kafka starting offsets")
    parser.add_argument("--max-files", type=int, help="JSON files per micro-batch")
    parser.add_argument("--max-offsets", type=int, help="Kafka messages per micro-batch")
    parser.add_argument("--baseline", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--interval", default=TRIGGER_INTERVAL)
    parser.add_argument("--files", type=int, help="output files per micro-batch")
    parser.add_argument("--unknown", default=ALERT_NORMAL, help="grade without thresholds")
    parser.add_argument("--deduplicate", action="store_true", help="of the baseline's stations")
    parser.add_argument("--once", action="store_true", help="process what is there and stop")
    parser.add_argument("--refresh", action="store_true", help="re-read the baseline per batch")
    args = parser.parse_args(argv)
    if args.servers and not args.topic:
        parser.error("--servers needs --topic")
    spark = build_session("stream-alerts")
    if args.servers:
        messages = kafka_events(
            spark, args.servers, args.topic, args.starting, args.max_offsets
        )
    else:
        messages = json_events_stream(spark, args.json, args.max_files)
    interval = None if args.once else args.interval
    run(
        stream_alerts(
            spark, messages, args.baseline, args.out, args.checkpoint, interval, args.refresh,
            files=args.files, unknown=args.unknown, unique=not args.deduplicate,
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

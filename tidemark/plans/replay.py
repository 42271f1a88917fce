"""Replay job: archive CSVs to event messages, as one distributed job."""

import argparse
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tidemark.operators.stats import observe_sent
from tidemark.session import build_session
from tidemark.sinks.messages import publish_events, publish_json
from tidemark.sources.files import ARCHIVE_PREFIX, ARCHIVE_SUFFIX, archive_files, list_archive
from tidemark.streaming.events import archive_events, encode_events


def replay_messages(
    spark: SparkSession,
    folder: str,
    parameter: str = "level",
    prefix: str = ARCHIVE_PREFIX,
    suffix: str = ARCHIVE_SUFFIX,
) -> DataFrame:
    """Messages of all archive files; a folder without archive files gives none."""
    return encode_events(archive_events(archive_files(spark, folder, prefix, suffix), parameter))


def replay_in_order(
    spark: SparkSession,
    folder: str,
    publish: Callable[[DataFrame], None],
    parameter: str = "level",
    newest_first: bool = False,
    prefix: str = ARCHIVE_PREFIX,
    suffix: str = ARCHIVE_SUFFIX,
    files_per_job: int = 1,
) -> list[tuple[str, int]]:
    """Publish the archive in the order of the dates in its files' names, and return how many
    messages each file gave.

    ``publish`` gets messages (``value``) with the ``position`` of their file, from 1 on. A job
    takes ``files_per_job`` files, whose headers must be alike, and ends before the next begins.
    One file a job is for sinks that keep no more than the order of arrival; a sink that keeps
    positions takes more. Files are found by a listing, and the driver holds the list only.
    Modification times play no part.
    """
    files = list_archive(spark, folder, newest_first, prefix, suffix)
    sent = []
    for first in range(0, len(files), files_per_job):
        run = files[first : first + files_per_job]
        places = F.create_map(*(F.lit(x) for i, path in enumerate(run) for x in (path, first + i + 1)))
        rows = archive_files(spark, run, prefix, suffix)
        place = places[F.col("file_path")].alias("position")
        events = archive_events(rows, parameter, place)
        messages = encode_events(events, keep=["position"])
        observation = Observation(f"sent-{uuid.uuid4().hex}")
        counts = [
            F.count(F.when(F.col("position") == first + i + 1, 1)).alias(str(i))
            for i in range(len(run))
        ]
        publish(messages.observe(observation, *counts))
        n = observation.get
        sent += [(path, n[str(i)]) for i, path in enumerate(run)]
    return sent


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--archive", required=True, help="folder of archive CSVs")
    parser.add_argument("--parameter", default="level")
    parser.add_argument("--unordered", action="store_true", help="all files at once")
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--topic", help="Kafka topic")
    parser.add_argument("--json", help="write JSON lines to this folder instead")
    args = parser.parse_args(argv)
    if not args.json and not (args.servers and args.topic):
        parser.error("give --json, or --servers and --topic")
    spark = build_session("replay")

    def publish(messages: DataFrame) -> None:
        if args.json:
            publish_json(messages, args.json)
        else:
            publish_events(messages, args.servers, args.topic)

    if args.unordered:
        messages, observation = observe_sent(replay_messages(spark, args.archive, args.parameter))
        publish(messages)
        sent = [(args.archive, observation.get["n_sent"])]
    else:
        sent = replay_in_order(spark, args.archive, publish, args.parameter)
    for path, n in sent:
        print(f"{n} messages from {path}")
    spark.stop()


if __name__ == "__main__":
    main()

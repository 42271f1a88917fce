"""Message sinks: publish encoded events to a topic or as JSON lines."""

from pyspark.sql import DataFrame, functions as F


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def publish_events(messages: DataFrame, servers: str, topic: str) -> None:
    """Send the ``value`` column as messages without key.

    Each task owns a producer, which flushes and closes when the task ends; batching
    is the connector's. Without a key the messages spread over all partitions.
    """
    messages.select("value").write.format("kafka").options(
        **kafka_sink_options(servers, topic)
    ).save()


def publish_json(
    messages: DataFrame, folder: str, mode: str = "append", partition_by: str | None = None
) -> None:
    """Write the ``value`` column as JSON-lines files, in a folder for each value of
    ``partition_by``; such rows are brought together first."""
    rows = messages.withColumn("value", messages["value"].cast("string"))
    if partition_by is None:
        rows.select("value").write.mode(mode).text(folder)
    else:
        together = rows.select("value", partition_by).hint("rebalance", F.col(partition_by))
        together.write.mode(mode).partitionBy(partition_by).text(folder)

"""Kafka source. Needs the Spark Kafka connector on the submit command."""

from pyspark.sql import DataFrame, SparkSession


def kafka_source_options(
    servers: str, topic: str, starting: str = "earliest", max_offsets: int | None = None
) -> dict[str, str]:
    """Reader options; ``max_offsets`` throttles the messages per micro-batch."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_events(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    max_offsets: int | None = None,
) -> DataFrame:
    """Messages of one topic as a streaming table (binary ``value``)."""
    options = kafka_source_options(servers, topic, starting, max_offsets)
    return spark.readStream.format("kafka").options(**options).load()

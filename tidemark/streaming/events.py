"""Event messages: shape, encode, decode.

Producer and consumer share one contract, ``EVENT_SCHEMA``: the encoder names time and
level as the decoder expects them. Fields a message lacks decode to NULL, fields the
schema lacks are ignored.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tidemark.functions.levels import finite
from tidemark.operators.cleaning import clean_strict_number, filter_parameter
from tidemark.schemas import EVENT_SCHEMA

# Fixed value: ISO instants with all six fractional digits Spark keeps.
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def shape_event(archive: DataFrame, *more: Column) -> DataFrame:
    """Archive row (numeric ``value``) to event fields, and ``more`` columns."""
    return archive.select(
        *more,
        "stationReference",
        F.col("label").alias("stationName"),
        F.col("dateTime"),
        F.col("date"),
        "unitName",
        "valueType",
        "datumType",
        F.col("value"),
    )


def archive_events(archive: DataFrame, parameter: str = "level", *more: Column) -> DataFrame:
    """Archive text rows to events: one parameter, strictly numeric values only."""
    return shape_event(clean_strict_number(filter_parameter(archive, parameter)), *more)


def encode_events(
    events: DataFrame, keep_nulls: bool = True, keep: Sequence[str] = ()
) -> DataFrame:
    """Each row as one JSON message (binary ``value``); the columns in ``keep`` stay beside it."""
    options = {**JSON_OPTIONS, "ignoreNullFields": str(not keep_nulls).lower()}
    fields = F.struct(*(F.col(f"`{c}`") for c in events.columns if c not in keep))
    return events.select(*keep, F.to_json(fields, options).cast("binary").alias("value"))


def parse_json(df: DataFrame, column: str, schema: T.StructType | str) -> DataFrame:
    """JSON text (or bytes) to columns; unreadable messages give NULL fields.

    ``inline`` keeps later filters above the parser. Over a plain projection they are
    pushed below it, where every filtered field parses the message once more.
    """
    return df.select(F.inline(F.array(F.from_json(F.col(column).cast("string"), schema))))


def parse_events(messages: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Messages (``value``) to event columns."""
    return parse_json(messages, "value", schema)


def is_event() -> Column:
    """Whether a row can go into a window."""
    return F.col("stationReference").isNotNull() & F.col("dateTime").isNotNull()


def valid_events(events: DataFrame) -> DataFrame:
    """Events that have a station and a time; the value may be missing.

    A value that is no finite number counts as missing: one NaN would else make the mean of
    its windows NaN, which compares above every threshold.
    """
    known = events.where(is_event())
    return known.withColumn("value", finite(F.col("value")))

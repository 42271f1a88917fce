"""Messages that no window can take, kept instead of lost.

A message is rejected if it is no JSON object of the expected types, or lacks a station or a
time. The alert stream drops such messages; a second stream over the same source writes them,
with its own checkpoint, so each appears exactly once there, whatever happens to the other one.
"""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.schemas import EVENT_SCHEMA
from tidemark.sources.files import UNREADABLE
from tidemark.streaming.alerts import TRIGGER_INTERVAL, start_alerts
from tidemark.streaming.events import is_event

#: Why a message was rejected.
MALFORMED, NO_KEY = "malformed", "no station or time"


def checked_events(messages: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Messages (``value``) to event columns with the ``message`` and ``reject_reason``, NULL for
    those that count. A null or blank message is malformed, as is one with a field of another
    type, or with something behind the object."""
    with_text = T.StructType([*schema.fields]).add(UNREADABLE, "string")
    text = F.col("value").cast("string")
    parsed = F.from_json(text, with_text, {"columnNameOfCorruptRecord": UNREADABLE})
    # As in parse_json: what follows must not make the parser run once more for each field.
    rows = messages.select(F.inline(F.array(F.struct(
        text.alias("message"), F.coalesce(parsed, F.from_json(F.lit("{}"), with_text)).alias("event")))))
    broken = F.col(UNREADABLE).isNotNull() | F.col("message").isNull() | (F.trim("message") == "")
    reason = F.when(broken, MALFORMED).when(~is_event(), NO_KEY)
    flat = rows.select("message", "event.*").withColumn("reject_reason", reason)
    return flat.drop(UNREADABLE)


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where("reject_reason IS NULL").drop("message", "reject_reason")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where("reject_reason IS NOT NULL").select("message", "reject_reason")


def start_quarantine(
    messages: DataFrame,
    out: str,
    checkpoint: str,
    interval: str | None = TRIGGER_INTERVAL,
    schema: T.StructType = EVENT_SCHEMA,
    files: int | None = 1,
) -> StreamingQuery:
    """Append the rejected messages of a stream to Parquet, exactly once."""
    return start_alerts(rejected(checked_events(messages, schema)), out, checkpoint, interval, files)

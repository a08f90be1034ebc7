"""A message log derived from the driver's ``events`` table.

Each event is one message: topic ``events.<event_type>``, partition
``user_id % 4``, offset = event_id (increasing per partition), timestamp =
event time, key = user id (NULL for every tenth user), value = the event as a
JSON object. The log is written as Parquet segments that a file-source
stream picks up segment by segment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITIONS = 4
# Message bodies carry timestamps with microseconds (the JSON default is milliseconds).
JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])
PROPS_SCHEMA = T.StructType([T.StructField("k", T.IntegerType())])
EVENT_COLUMNS = tuple(f.name for f in EVENT_SCHEMA.fields)


def event_messages(events: DataFrame) -> DataFrame:
    user = F.col("user_id")
    return events.select(
        F.concat(F.lit("events."), F.col("event_type")).alias("topic"),
        (user % PARTITIONS).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        F.when(user % 10 != 0, user.cast("string")).alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in EVENT_COLUMNS]), JSON_OPTIONS).alias("value"),
    )


def write_segment(messages: DataFrame, folder: str) -> None:
    """Append one segment of the log (new files; earlier files stay untouched)."""
    messages.write.mode("append").parquet(folder)


def decoded_events(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Message value -> event columns, plus ``k`` from the event's JSON props."""
    from settlekit.streaming.drain import decode_json
    ev = decode_json(messages, EVENT_SCHEMA, keep=keep, options=JSON_OPTIONS)
    return ev.withColumn("k", F.from_json("props", PROPS_SCHEMA, {"mode": "FAILFAST"})["k"])

"""Bounded drains of a message log with Structured Streaming.

A drain reads everything available when it starts and then stops
(``trigger(availableNow=True)``); offsets live in the query's checkpoint, so
the next drain reads only newer messages, and a lost checkpoint means a
replay from the earliest message (absorbed downstream by dedup).

The operators take any streaming DataFrame with the message-log columns of
Spark's Kafka source (topic, partition, offset, timestamp, timestampType, key,
value); locally the log is a folder of Parquet files read with the file
source, on a cluster it would be ``readStream.format("kafka")``.

Sinks write below a key made of the checkpoint's own identity and the batch id:
a retried batch replaces its own output, a new checkpoint (whose batch ids start
at 0 again) never touches what an earlier one landed.

A drain with an end bound, with offsets per partition, or of a log that may be wiped
and filled anew is ``streaming.ledger``'s: it plans ranges of offsets, so later messages
stay unread. Here, wiping a topic must also drop the drain's checkpoint folder.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGE_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType(), False),
    T.StructField("partition", T.IntegerType(), False),
    T.StructField("offset", T.LongType(), False),
    T.StructField("timestamp", T.TimestampNTZType(), True),
    T.StructField("timestampType", T.IntegerType(), True),
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
])

Sink = Callable[[DataFrame, str], None]


# --- message-level operators (work on batch and streaming DataFrames) ----------------

def envelope(messages: DataFrame) -> DataFrame:
    """Default message record: ``_kafka`` struct (partition, topic, key, offset,
    ts{type, value}, data) and ``_kafka_msg_id`` = md5(topic || partition || key),
    a NULL key hashed as the text 'None'."""
    key_text = F.coalesce(F.col("key").cast("string"), F.lit("None"))
    return messages.select(
        F.struct(
            F.col("partition"), F.col("topic"), F.col("key").cast("string").alias("key"), F.col("offset"),
            F.struct(F.col("timestampType").alias("type"), F.col("timestamp").alias("value")).alias("ts"),
            F.col("value").cast("string").alias("data"),
        ).alias("_kafka"),
        F.md5(F.concat(F.col("topic"), F.col("partition").cast("string"), key_text)).alias("_kafka_msg_id"),
    )


def decode_json(messages: DataFrame, schema: T.StructType, col: str = "value",
                keep: tuple[str, ...] = (), options: Mapping[str, str] | None = None) -> DataFrame:
    """JSON object body -> typed columns; a malformed body fails the batch (FAILFAST)."""
    parsed = F.from_json(F.col(col).cast("string"), schema, {"mode": "FAILFAST", **(options or {})})
    return messages.select(*[F.col(k) for k in keep], parsed.alias("_m")).select(*keep, "_m.*")


def _ts(v) -> Column:
    return F.lit(str(v)).cast("timestamp_ntz")


def check_time_range(start_from=None, end_time=None) -> None:
    """``end_time`` needs ``start_from``; ``start_from`` must not be after ``end_time``."""
    if end_time is not None:
        if start_from is None:
            raise ValueError(f"the range up to {end_time} has no beginning: start_from is missing")
        if dt.datetime.fromisoformat(str(start_from)) > dt.datetime.fromisoformat(str(end_time)):
            raise ValueError(f"the range ends ({end_time}) before it begins ({start_from})")


def time_range(messages: DataFrame, start_from=None, end_time=None, ts_col: str = "timestamp") -> DataFrame:
    """Messages with start_from <= timestamp < end_time (either bound optional,
    validated like the queue consumer's arguments)."""
    check_time_range(start_from, end_time)
    cond = F.lit(True)
    if start_from is not None:
        cond = cond & (F.col(ts_col) >= _ts(start_from))
    if end_time is not None:
        cond = cond & (F.col(ts_col) < _ts(end_time))
    return messages.filter(cond)


# --- the drain ---------------------------------------------------------------------------

def read_log(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Streaming read of a message-log folder (Parquet files, MESSAGE_SCHEMA)."""
    r = spark.readStream.schema(MESSAGE_SCHEMA)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.parquet(folder)


def read_topics(spark: SparkSession, bootstrap_servers: str, topics: list[str],
                batch_size: int | None = None, start_from=None, skip_lost: bool = False,
                options: Mapping[str, str] | None = None) -> DataFrame:
    """Streaming read of queue topics (needs the Spark Kafka connector on the
    classpath), columns as in MESSAGE_SCHEMA. ``batch_size`` bounds the messages
    per micro-batch (unset: what is there). Offsets that the queue no longer holds
    fail the drain unless ``skip_lost``. An end bound needs a read by ranges
    (``streaming.ledger.queue_range_options``)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
         .option("subscribe", ",".join(topics)).option("startingOffsets", "earliest")
         .option("failOnDataLoss", str(not skip_lost).lower()))
    if batch_size is not None:
        r = r.option("maxOffsetsPerTrigger", batch_size)
    if start_from is not None:
        ms = int(dt.datetime.fromisoformat(str(start_from)).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
        r = r.option("startingTimestamp", str(ms))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return from_queue(r.load())


def from_queue(messages: DataFrame) -> DataFrame:
    """Rows of the queue connector as MESSAGE_SCHEMA: instants as UTC wall time, key and value as text."""
    return messages.select(
        "topic", "partition", "offset",
        F.timestamp_add("MICROSECOND", F.unix_micros("timestamp"),
                        F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).alias("timestamp"),
        "timestampType", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def drain(stream: DataFrame, sink: Sink, checkpoint: str, name: str | None = None, start_from=None) -> int:
    """Run one bounded drain: process everything available now, then stop.

    ``sink(batch_df, batch_key)`` is called per micro-batch (``foreachBatch``);
    it must be idempotent per key (a retried batch is re-delivered).
    Messages before ``start_from`` are left out. Returns the rows handed to the
    sink, counted from the batches themselves.
    """
    checkpoint = checkpoint.rstrip("/")
    landed: dict[str, int] = {}

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        key = f"{checkpoint_identity(batch.sparkSession, checkpoint)}-{batch_id:08d}"
        inside = batch if start_from is None else time_range(batch, start_from)
        sink(inside, key)
        landed[key] = inside.count()

    w = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return sum(landed.values())


def checkpoint_identity(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint folder got when its query first started; a new folder has a new one."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]


def append_sink(path: str, mapper: Callable[[DataFrame], DataFrame] | None = None,
                tag: Mapping[str, object] | None = None) -> Sink:
    """foreachBatch sink: map the batch (e.g. decode + canonicalise) and append it
    as Parquet in a folder of the batch's key, which a retried batch replaces."""
    def sink(batch: DataFrame, key: str) -> None:
        out = mapper(batch) if mapper else batch
        for k, v in (tag or {}).items():
            out = out.withColumn(k, F.lit(v))
        out.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={key}")
    return sink


def topic_table(topic: Column, overrides: Mapping[str, str]) -> Column:
    """Table name of a topic: the override if one is given, else the topic name
    with every character outside [A-Za-z0-9_] replaced by '_'."""
    default = F.regexp_replace(topic, "[^A-Za-z0-9_]", "_")
    if not overrides:
        return default
    mapping = F.create_map(*[F.lit(x) for kv in overrides.items() for x in kv])
    return F.coalesce(F.element_at(mapping, topic), default)


def routing_sink(root: str, overrides: Mapping[str, str] | None = None,
                 mapper: Callable[[DataFrame], DataFrame] | None = None) -> Sink:
    """foreachBatch sink landing every topic in its own table
    (``<root>/table_name=<table>/batch=<key>/``), in ONE partitioned write per
    batch; dynamic partition overwrite makes a retried batch replace only its
    own folders."""
    def sink(batch: DataFrame, key: str) -> None:
        table = topic_table(F.col("topic"), overrides or {})
        routed = batch.withColumn("table_name", table)
        out = mapper(routed) if mapper else routed
        (out.withColumn("batch", F.lit(key))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("table_name", "batch").parquet(root))
    return sink


def read_routed(spark: SparkSession, root: str, table: str | None = None) -> DataFrame:
    """Routed tables (all, or one via partition pruning on ``table_name``)."""
    df = spark.read.parquet(root).drop("batch")
    return df if table is None else df.filter(F.col("table_name") == table)


def read_sink(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path).drop("batch")

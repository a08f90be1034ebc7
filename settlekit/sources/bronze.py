"""Bronze zone: one dataset per channel, ``<root>/bronze/<channel>/<table>/load=<id>/``.

A channel's write disposition can only touch its own folder. Each load is a folder of
its own, which counts once the channel's commit names it; promotion reads the named
folders of every channel of a table and unions them by column name.

A channel's commits also hold its schema registry: the first good load of a table
freezes the columns that it had, and a later load with a new or retyped column is
refused before anything is written. Missing columns pass, tables evolve, channels
are independent, and a reviewed change is a new version (``approve_schema``).
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settlekit.contracts import TABLE_COLUMNS, TABLE_SCHEMAS
from settlekit.operators.canonical import Drift, SchemaDriftError, enforce_contract, guard_identifiers, schema_drift
from settlekit.session import forget_at_exit
from settlekit.sources.commits import CommitLog, drop_folder, folders

DISPOSITIONS = ("replace", "append")


def bronze_path(root: str, channel: str, table: str) -> str:
    return f"{root.rstrip('/')}/bronze/{channel}/{table}"


def silver_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/silver/{table}"


def channel_log(spark: SparkSession, root: str, channel: str) -> CommitLog:
    """The channel's commits: ``tables`` (the folders that count), ``schemas`` (table: versions), and whatever its loads add."""
    return CommitLog(spark, f"{root.rstrip('/')}/bronze/{channel}/_commits")


# --- schema registry -------------------------------------------------------------------

def _business(schema: T.StructType, table: str) -> T.StructType:
    """Columns under the freeze: the contract's, and all others but transport metadata (``_...``)."""
    known = set(TABLE_COLUMNS.get(table, ()))
    return T.StructType([f for f in schema.fields if f.name in known or not f.name.startswith("_")])


def _frozen(document: dict, table: str) -> T.StructType | None:
    versions = document.get("schemas", {}).get(table)
    return T.StructType.fromJson(versions[-1]) if versions else None


def frozen_schema(spark: SparkSession, root: str, channel: str, table: str) -> T.StructType | None:
    """Columns of ``table`` as the channel's first good load or a later approval left them; None before the first load."""
    return _frozen(channel_log(spark, root, channel).latest()[1], table)


def schema_versions(spark: SparkSession, root: str, channel: str, table: str) -> list[T.StructType]:
    """The frozen schema and its approved successors, oldest first."""
    document = channel_log(spark, root, channel).latest()[1]
    return [T.StructType.fromJson(v) for v in document.get("schemas", {}).get(table, [])]


def approve_schema(spark: SparkSession, root: str, channel: str, table: str, schema: T.StructType) -> int:
    """Make a reviewed schema the table's newest version; returns its number."""
    def edit(document: dict) -> None:
        document.setdefault("schemas", {}).setdefault(table, []).append(_business(schema, table).jsonValue())

    return len(channel_log(spark, root, channel).change(edit)[1]["schemas"][table])


def check_frozen(document: dict, channel: str, table: str, observed: T.StructType) -> list[Drift]:
    """Raise ``SchemaDriftError`` on a column that the channel's registry does not know or knows with another type; returns what is missing."""
    frozen = _frozen(document, table)
    drifts = schema_drift(frozen, _business(observed, table)) if frozen is not None else []
    bad = [d for d in drifts if d.kind != "missing_ok"]
    if bad:
        raise SchemaDriftError(f"{channel}/{table} was frozen by its first load: " + ", ".join(f"{d.kind}:{d.column_name}" for d in bad))
    return drifts


# --- loads ------------------------------------------------------------------------------

def write_bronze(df: DataFrame, root: str, channel: str, table: str, disposition: str = "replace",
                 validate: bool = True) -> str:
    """Validate (frozen schema, contract, identifier guard), write one load of a channel's table and publish it.

    Validation runs before the write, so a refused batch writes nothing. A load counts
    from its commit on: a write that dies midway leaves the channel as it was. The
    folders of a replaced load are dropped with the load after it, so that readers of
    the one before can end. Returns the load's folder.
    """
    if disposition not in DISPOSITIONS:
        raise ValueError(f"disposition {disposition!r} is none of {DISPOSITIONS}")
    spark, log = df.sparkSession, channel_log(df.sparkSession, root, channel)
    if validate:
        check_frozen(log.latest()[1], channel, table, df.schema)
        if table in TABLE_SCHEMAS:
            enforce_contract(df.select(*_business(df.schema, table).names), TABLE_SCHEMAS[table], source=f"{channel}/{table}")
    load = f"load={uuid.uuid4().hex[:12]}"
    path = f"{bronze_path(root, channel, table)}/{load}"
    # The batch is computed once for the guard pass and the write (spills to disk if large).
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if validate:
            guard_identifiers(df.select(*_business(df.schema, table).names))
        df.write.parquet(path)
    finally:
        df.unpersist()

    def edit(document: dict) -> None:
        if validate:
            check_frozen(document, channel, table, df.schema)  # another load may have frozen it meanwhile
        publish(document, channel, table, load, df.schema, disposition)

    log.change(edit)
    drop_unnamed(spark, root, channel, table, log)
    return path


def publish(document: dict, channel: str, table: str, load: str, schema: T.StructType, disposition: str) -> None:
    """Name a load's folder in the channel's state, and freeze the table's schema if this is its first."""
    named = document.setdefault("tables", {})
    named[table] = ([] if disposition == "replace" else named.get(table, [])) + [load]
    document.setdefault("schemas", {}).setdefault(table, [_business(schema, table).jsonValue()])


def drop_unnamed(spark: SparkSession, root: str, channel: str, table: str, log: CommitLog) -> None:
    """Drop the table's folders that neither of the two newest commits names: replaced loads and writes that died.

    A channel has one loader at a time (two would drop each other's unpublished folders)."""
    kept = {name for document in log.kept(2) for name in document.get("tables", {}).get(table, [])}
    path = bronze_path(root, channel, table)
    for name in folders(spark, path):
        if name not in kept:
            drop_folder(spark, f"{path}/{name}")


def named_folders(spark: SparkSession, root: str, table: str) -> dict[str, list[str]]:
    """Per channel the folders of ``table`` that count."""
    base, found = f"{root.rstrip('/')}/bronze", {}
    for channel in folders(spark, base):
        named = channel_log(spark, root, channel).latest()[1].get("tables", {}).get(table, [])
        if named:
            found[channel] = [f"{base}/{channel}/{table}/{name}" for name in named]
    return found


SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
_writing = threading.RLock()


@contextmanager
def at_least_partitions(spark: SparkSession, n: int) -> Iterator[None]:
    """Exchanges planned inside have at least ``n`` partitions; the session's own number is set again afterwards."""
    with _writing:
        own = spark.conf.get(SHUFFLE_PARTITIONS)
        if int(own) >= n:
            yield
            return
        spark.conf.set(SHUFFLE_PARTITIONS, str(n))
        try:
            yield
        finally:
            spark.conf.set(SHUFFLE_PARTITIONS, own)


def write_bucketed(df: DataFrame, path: str, table_name: str, key: str = "transaction_id",
                   buckets: int | None = None) -> DataFrame:
    """Write ``df`` as an external table at ``path`` bucketed and sorted by ``key``.

    Two tables bucketed the same way join on ``key`` without any shuffle or
    sort (the bucketed scans already have the join's distribution and order).
    The table is registered in the session catalog under ``table_name``; its
    files stay in ``path``. Tables that are to join without a shuffle need one
    number of buckets; without one given it is the session's shuffle partitions, so
    a job over tables of known size passes it (``buckets_for_bytes``, ``buckets_for_rows``).
    The rows are exchanged into at least as many partitions, so a task that sorts
    them for the write holds no more than a bucket however few the session asks for.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get(SHUFFLE_PARTITIONS))
    with at_least_partitions(spark, n):
        (df.write.mode("overwrite").bucketBy(n, key).sortBy(key).format("parquet")
           .option("path", path).saveAsTable(table_name))
    forget_at_exit(spark, table_name)
    return spark.table(table_name)


def buckets_for_bytes(total: int, bucket_bytes: int = 256 << 20) -> int:
    """Number of buckets, a power of two, that keeps each at about ``bucket_bytes`` or less."""
    return 1 << (max(1, -(-total // bucket_bytes)) - 1).bit_length()


#: Rows of a bucket: each is sorted in one task, with some 300 bytes a row and side.
BUCKET_ROWS = 300_000


def buckets_for_rows(spark: SparkSession, rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """The session's shuffle partitions, or as many more (a power of two) as keep a bucket at about ``bucket_rows`` or less."""
    needed = 1 << (max(1, -(-rows // bucket_rows)) - 1).bit_length()
    return max(int(spark.conf.get(SHUFFLE_PARTITIONS)), needed)


def union_channels(frames: Mapping[str, DataFrame], table: str, keep_channel: bool = True) -> DataFrame:
    """Union every channel's rows BY NAME (channels differ in metadata columns),
    then keep the contract's business columns (plus the channel name)."""
    out = None
    for channel, df in frames.items():
        tagged = df.withColumn("channel", F.lit(channel))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    cols = (["channel"] if keep_channel else []) + list(TABLE_COLUMNS[table])
    return out.select(*cols)


def read_bronze(spark: SparkSession, root: str, table: str, keep_channel: bool = True,
                only: Mapping[str, list[str]] | None = None) -> DataFrame:
    """All channels of ``table`` in ONE scan of the folders that their commits name, with
    schema merging (union by name; a column a channel lacks reads as NULL), the
    channel taken from the file path, then the contract projection. ``only`` reads
    some of those folders (by channel), as an incremental promotion does."""
    paths = [p for named in (named_folders(spark, root, table) if only is None else only).values() for p in named]
    if not paths:
        raise FileNotFoundError(f"no channel has loaded {table} below {root}")
    df = (spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(*paths)
          .withColumn("channel", F.regexp_extract(F.col("_metadata.file_path"), r"/bronze/([^/]+)/", 1)))
    missing = [F.lit(None).cast(TABLE_SCHEMAS[table][c].dataType).alias(c) for c in TABLE_COLUMNS[table] if c not in df.columns]
    cols = (["channel"] if keep_channel else []) + list(TABLE_COLUMNS[table])
    return df.select("*", *missing).select(*cols)

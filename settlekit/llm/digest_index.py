"""Exact dedup against a persistent digest index.

The index is a folder of Parquet files, bucketed and sorted by SHA-256 digest,
with one row per distinct text seen so far. New data is reduced to its
distinct digests, anti-joined (sort-merge; the index side is read bucket by
bucket and not shuffled) and the rest is appended. Texts never travel through
a shuffle, only digests.

A text shared by a third of all rows is reduced in ``SALTS`` pieces first, and
its decision goes back to the rows piece by piece, so no task holds a group.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_folder
from .common import salt

#: Buckets of an index created without a number of its own. At 32 bytes a
#: digest and 256 MB a bucket, 4096 buckets hold about 30 billion texts.
DEFAULT_BUCKETS = 64


class DigestIndex:
    """The digests seen so far, kept in ``path`` (a folder all executors share).

    Opening an existing folder goes on with it; the number of buckets must be
    the one it was created with.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = DEFAULT_BUCKETS):
        self.spark, self.path = spark, path
        self.name = f"digest_index_{uuid.uuid4().hex[:12]}"
        spark.sql(f"CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")
        self.buckets = buckets

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def append(self, groups: DataFrame) -> None:
        """Add the (digest, keep_id) rows, one per digest, whose digest is not there yet.

        Running it again with the same rows adds nothing, so a failed job can be
        repeated as a whole.
        """
        fresh = groups.join(self.read().select("digest").hint("merge"), "digest", "left_anti")
        (fresh.select("digest", "keep_id").repartition(self.buckets, "digest").sortWithinPartitions("digest")
         .write.insertInto(self.name))


def text_digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest, copies: one row per document; rows that repeat id and text are one document."""
    digest = F.unhex(F.sha2(F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8"), 256))
    return docs.select("doc_id", digest.alias("digest")).groupBy("doc_id", "digest").agg(F.count("*").alias("copies"))


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """Decide for every document whether its text stays, and enter the new texts in the index.

    Returns doc_id, keep_id, group_size, kept, text_sha256, copies. Texts are equal
    when identical; null is the empty text. Among new equal texts the largest
    doc_id stays (``keep_id``); a text that an earlier ``append`` already entered
    keeps that earlier document, and none of the new rows stay. Rows that repeat
    both id and text are one document (``copies`` of them). A null doc_id stays
    only if no document with an id has its text. An empty table gives no rows.
    Other columns are not read, whatever their names.

    Digests stand for texts: two different texts under one SHA-256 are taken not to occur.
    """
    spark = docs.sparkSession
    index = index or DigestIndex(spark, scratch_folder(spark, "digest-index"))
    rows = text_digests(docs).withColumn("piece", salt("doc_id")).checkpoint()
    parts = rows.groupBy("digest", "piece").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n"))
    groups = parts.groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    index.append(groups)
    known = index.read().withColumnRenamed("keep_id", "stays")
    decided = (groups.select("digest", "group_size").join(known.hint("merge"), "digest")
               .join(parts.select("digest", "piece"), "digest"))
    return (rows.join(decided, ["digest", "piece"])
            .select("doc_id", F.col("stays").alias("keep_id"), "group_size",
                    F.col("doc_id").eqNullSafe(F.col("stays")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256"), "copies"))


def keep_first(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The rows of ``docs`` (all their columns) that ``exact_dedup`` keeps, one row per text."""
    decided = exact_dedup(docs, index).filter("kept").select(
        F.col("doc_id").alias("__id"), F.unhex("text_sha256").alias("__digest"), "copies").checkpoint()
    digest = F.unhex(F.sha2(F.encode(F.coalesce(docs["text"], F.lit("")), "UTF-8"), 256))
    once = docs.join(decided, docs["doc_id"].eqNullSafe(decided["__id"]) & (digest == decided["__digest"]), "left_semi")
    if decided.filter("copies > 1").isEmpty():
        return once
    return once.withColumn("__digest", digest).dropDuplicates(["doc_id", "__digest"]).drop("__digest")

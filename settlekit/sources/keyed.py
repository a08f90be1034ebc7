"""Keyed tables in hash buckets: the newest row per key, kept by rewriting only the buckets that an increment touches.

A row's bucket is a hash of its key. Each bucket is a set of folders
``data/write=<id>/bucket=<b>`` that the table's newest commit names. A merge finds the
increment's buckets, reads those, decides per key which row is newer, writes them below
a new id and commits; all other buckets keep their files. Readers see the table before
or after a merge, never between; folders that neither of the two newest commits names
are dropped.

The rows of the touched buckets are not shuffled if the increment's keys can be
broadcast (their size is measured): each row meets its newer version where it is read.
Beyond that both are joined by shuffle. The commit also holds whatever a loader notes
in it (``marks``), so what was merged and that it was merged become visible together.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settlekit.operators.joins import bounded_broadcast
from settlekit.operators.promote import KEY, VERSION, latest_per_key
from settlekit.sources.commits import CommitLog, drop_folder, folders


@dataclass(frozen=True)
class Merged:
    """What a merge did: rows of the increment's newest keys, buckets rewritten, buckets of the table."""

    keys: int
    touched: int
    buckets: int


class KeyedTable:
    def __init__(self, spark: SparkSession, root: str, key: str = KEY, version: str = VERSION, buckets: int = 64):
        """``buckets`` counts when the table is made; later its commits say."""
        self.spark, self.root, self.key, self.version, self._buckets = spark, root.rstrip("/"), key, version, buckets
        self.commits = CommitLog(spark, f"{self.root}/_commits")

    # state ---------------------------------------------------------------------------

    def state(self) -> dict:
        return self.commits.latest()[1]

    def exists(self) -> bool:
        return bool(self.state().get("writes"))

    def marks(self) -> dict:
        return self.state().get("marks", {})

    def _paths(self, document: dict, only: set[int] | None = None) -> list[str]:
        """Folders that count: ``writes`` maps each write id to the buckets it still holds."""
        return [f"{self.root}/data/write={w}/bucket={b}" for w, held in sorted(document.get("writes", {}).items()) for b in held if only is None or b in only]

    def bucket_of(self, n: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(n)).cast("int")

    # reading -------------------------------------------------------------------------

    def _read(self, document: dict, only: set[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(document["schema"]))
        paths = self._paths(document, only)
        if not paths:
            return self.spark.createDataFrame([], schema).withColumn("bucket", F.lit(0))
        with_bucket = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
        return self.spark.read.option("basePath", f"{self.root}/data").schema(with_bucket).parquet(*paths).select(*schema.names, "bucket")

    def read(self) -> DataFrame:
        """One row per key; no window, no shuffle."""
        document = self.state()
        if "schema" not in document:
            raise FileNotFoundError(f"no rows were ever merged into {self.root}")
        return self._read(document).drop("bucket")

    def files(self) -> dict[int, list[str]]:
        """Folders per bucket, as the newest commit names them."""
        found: dict[int, list[str]] = {}
        for path in self._paths(self.state()):
            found.setdefault(int(path.rsplit("=", 1)[1]), []).append(path)
        return found

    # merging -------------------------------------------------------------------------

    def merge(self, increment: DataFrame, note: Callable[[dict], None] | None = None) -> Merged:
        """Upsert ``increment`` (any versions of any keys): per key the newest row of table and increment stays,
        ties as in ``latest_per_key``. ``note(marks)`` changes the marks in the same commit."""
        number, document = self.commits.latest()
        n = document.get("buckets", self._buckets)
        columns = T.StructType.fromJson(json.loads(document["schema"])).names if "schema" in document else increment.columns
        newest = latest_per_key(increment.select(*columns), self.key, self.version).withColumn("bucket", self.bucket_of(n)).persist()
        try:
            sizes = {r["bucket"]: r["n"] for r in newest.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per bucket
            touched = set(sizes)
            write = uuid.uuid4().hex[:12]
            if touched:
                rows = self._merged(document, newest, columns, touched) if document.get("writes") else newest.repartition("bucket")
                rows.write.partitionBy("bucket").parquet(f"{self.root}/data/write={write}")
        finally:
            newest.unpersist()
        writes = {w: left for w, held in document.get("writes", {}).items() if (left := [b for b in held if b not in touched])}
        if touched:
            writes[write] = sorted(touched)
        document |= {"buckets": n, "writes": writes, "schema": document.get("schema") or increment.select(*columns).schema.json()}
        if note is not None:
            note(document.setdefault("marks", {}))
        self.commits.commit(number, document)  # a second merger at the same time fails here and starts anew
        self._drop_unnamed()
        return Merged(sum(sizes.values()), len(touched), n)

    def _merged(self, document: dict, newest: DataFrame, columns: list[str], touched: set[int]) -> DataFrame:
        order = [self.version, *[c for c in columns if c not in (self.key, self.version)]]

        def packed(side: str) -> Column:  # structs compare field by field, NULL lowest; NULL where the side has no such key
            return F.when(F.col(f"{side}.bucket").isNotNull(), F.struct(*[F.col(f"{side}.{c}").alias(c) for c in order]))

        def picked(both: DataFrame, key: Column) -> DataFrame:
            return both.select(key.alias("__key"), F.coalesce("s.bucket", "i.bucket").alias("bucket"), F.greatest(packed("s"), packed("i")).alias("row")).select(
                *[F.col("__key").alias(c) if c == self.key else F.col(f"row.{c}").alias(c) for c in columns], "bucket")

        stored = self._read(document, touched)
        small = bounded_broadcast(newest)
        same = F.col(f"s.{self.key}").eqNullSafe(F.col(f"i.{self.key}"))
        if small is newest:
            both = stored.alias("s").join(newest.alias("i"), same, "full_outer")
            return picked(both, F.coalesce(f"s.{self.key}", f"i.{self.key}")).repartition("bucket")
        kept = picked(stored.alias("s").join(small.alias("i"), same, "left"), F.col(f"s.{self.key}"))
        # keys that the table lacks; both broadcasts hold at most the increment's keys, whose rows have been measured
        met = stored.select(self.key).alias("s").join(F.broadcast(newest.select(self.key)).alias("i"), same, "left_semi")
        new = newest.alias("i").join(F.broadcast(met).alias("s"), same, "left_anti")
        return kept.unionByName(new.select(*columns, "bucket").repartition("bucket"))  # a task and file per bucket

    def _drop_unnamed(self) -> None:
        kept = {(w, b) for document in self.commits.kept(2) for w, held in document.get("writes", {}).items() for b in held}
        ids = {w for w, _ in kept}
        for name in folders(self.spark, f"{self.root}/data"):
            w = name.removeprefix("write=")
            if w not in ids:
                drop_folder(self.spark, f"{self.root}/data/{name}")
                continue
            for bucket in folders(self.spark, f"{self.root}/data/{name}"):
                if (w, int(bucket.removeprefix("bucket="))) not in kept:
                    drop_folder(self.spark, f"{self.root}/data/{name}/{bucket}")

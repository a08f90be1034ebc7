"""Keyed tables fed by micro-batches: the latest version wins, whichever batch
brings it (late and out-of-order milestone updates).

Batches append their versions (cost O(batch)). ``fold`` merges what has been appended
since the last fold into a keyed table, rewriting only the buckets that it touches,
and drops those batches once no reader needs them. Readers take the keyed table as it
is and resolve only the batches that are not folded yet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from settlekit.operators.promote import KEY, VERSION, latest_per_key
from settlekit.sources.commits import drop_folder, folders
from settlekit.sources.keyed import KeyedTable, Merged
from settlekit.streaming.drain import Sink, append_sink


def versions_sink(root: str) -> Sink:
    """foreachBatch sink appending the batch's versions below ``root``."""
    return append_sink(f"{root.rstrip('/')}/versions")


def _table(spark: SparkSession, root: str, key: str, version: str, buckets: int = 64) -> KeyedTable:
    return KeyedTable(spark, f"{root.rstrip('/')}/current", key, version, buckets)


def _unfolded(spark: SparkSession, root: str, table: KeyedTable) -> list[str]:
    done = set(table.marks().get("folded", []))
    return [name for name in folders(spark, f"{root.rstrip('/')}/versions") if name.startswith("batch=") and name not in done]


def fold(spark: SparkSession, root: str, key: str = KEY, version: str = VERSION, buckets: int = 64) -> Merged | None:
    """Merge the batches appended since the last fold into the table; None if there are none.

    No drain may be writing below ``root`` meanwhile. A batch folded by the fold before
    this one is dropped, so readers that began before it can end.
    """
    root, table = root.rstrip("/"), _table(spark, root, key, version, buckets)
    names = _unfolded(spark, root, table)
    earlier = table.marks().get("folded", [])
    if not names:
        return None
    increment = spark.read.parquet(*[f"{root}/versions/{name}" for name in names])
    done = table.merge(increment, lambda marks: marks.update(folded=names))
    for name in earlier:
        drop_folder(spark, f"{root}/versions/{name}")
    return done


def read_current(spark: SparkSession, root: str, key: str = KEY, version: str = VERSION) -> DataFrame:
    """Newest version per key: the folded table and the batches after it; a missing table raises."""
    root, table = root.rstrip("/"), _table(spark, root, key, version)
    names = _unfolded(spark, root, table)
    if not table.exists():  # nothing folded yet
        return latest_per_key(spark.read.parquet(f"{root}/versions").drop("batch"), key, version)
    if not names:
        return table.read()
    fresh = spark.read.parquet(*[f"{root}/versions/{name}" for name in names])
    # the window's partial limit runs before its shuffle; the folded rows are one a key
    return latest_per_key(table.read().unionByName(fresh), key, version)

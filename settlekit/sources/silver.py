"""Incremental promotion: only what bronze has gained since the last run is merged into silver.

Silver is a keyed table. Its marks hold, per channel, the bronze loads that it has
merged and the newest version seen; a run reads the loads that are not among them. A
channel that is snapshotted anew each day names one new load with all its rows: with a
lookback only its rows from that long before the channel's newest version on are read
(the filter reaches the Parquet scan), which is the same as reading all of them as long
as a change to a row comes with a version inside the window. Rows that vanish from a
snapshot stay in silver, as transactions are never taken back; a new silver
folder starts anew.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from settlekit.operators.promote import KEY, VERSION, contract_projection
from settlekit.sources.bronze import named_folders, read_bronze
from settlekit.sources.keyed import KeyedTable, Merged


@dataclass(frozen=True)
class Promoted:
    """A run's loads per channel, the rows read from them, and what the merge did (None: nothing new)."""

    loads: dict[str, list[str]]
    rows: int
    merged: Merged | None


def silver_table(spark: SparkSession, root: str, table: str, buckets: int = 64) -> KeyedTable:
    return KeyedTable(spark, f"{root.rstrip('/')}/silver_keyed/{table}", KEY, VERSION, buckets)


def promote_incremental(spark: SparkSession, root: str, table: str, lookback: dt.timedelta | None = None,
                        buckets: int = 64) -> Promoted:
    """Merge the loads that silver has not seen; without a ``lookback`` all their rows."""
    silver = silver_table(spark, root, table, buckets)
    named = named_folders(spark, root, table)
    marks = silver.marks()
    seen, newest = marks.get("loads", {}), marks.get("newest", {})
    new = {c: left for c, paths in named.items() if (left := [p for p in paths if p.rsplit("/", 1)[1] not in seen.get(c, [])])}
    if not new:
        return Promoted({}, 0, None)
    rows = read_bronze(spark, root, table, only=new)
    if lookback is not None:
        inside = F.lit(True)
        for channel in new:
            if channel in newest:
                since = dt.datetime.fromisoformat(newest[channel]) - lookback
                inside = inside & ((F.col("channel") != channel) | F.col(VERSION).isNull()
                                   | (F.col(VERSION) >= F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz")))
        rows = rows.filter(inside)
    stats = {r["channel"]: r for r in rows.groupBy("channel").agg(F.count(F.lit(1)).alias("n"), F.max(VERSION).alias("newest")).collect()}  # a row per channel

    def note(marks: dict) -> None:
        marks["loads"] = {c: [p.rsplit("/", 1)[1] for p in paths] for c, paths in named.items()}
        known = marks.setdefault("newest", {})
        for channel, r in stats.items():
            if r["newest"] is not None:
                known[channel] = max(known.get(channel, ""), r["newest"].isoformat())

    merged = silver.merge(contract_projection(rows, table), note)
    return Promoted({c: [p.rsplit("/", 1)[1] for p in paths] for c, paths in new.items()}, sum(r["n"] for r in stats.values()), merged)

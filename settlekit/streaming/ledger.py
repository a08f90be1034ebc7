"""Bounded drains of a message log by an offset ledger.

The ledger holds, per topic and partition, the offset to read next. A drain fixes each
partition's end when it starts, turns time bounds into offsets, reads the ranges
between, and commits the new offsets together with the landed batch: one document
(``sources.commits``) names both, so a sink that fails leaves the ledger where it was
and what it wrote does not count. Messages past the end bound stay unread in the log.

What the log holds is known from a segment index: per file and partition the first and
last offset and time, made once per new file. Ends, starts and times are looked up
there; only files that a range touches are read, and only files that straddle a time
are scanned to find its offset.

A log that was wiped and filled anew is noticed before the drain: its offsets end
before the ledger, or the message at a remembered first offset is another one. The
partition's offset is then dropped and the drain reads it from its start. Offsets that
the log no longer holds (retention) fail the drain unless ``skip_lost``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settlekit.operators.joins import bounded_broadcast
from settlekit.sources.commits import CommitLog, drop_folder, folders
from settlekit.streaming.drain import MESSAGE_SCHEMA, check_time_range
from settlekit.streaming.faults import Outcome, SoftFault, with_retries

Part = tuple[str, int]
LandingSink = Callable[[DataFrame, str], None]

INDEX_SCHEMA = ("file string, length bigint, changed bigint, topic string, partition int, first_offset bigint, last_offset bigint, "
                "first_ts timestamp_ntz, last_ts timestamp_ntz, messages bigint, first_digest string")


class OffsetsLost(RuntimeError):
    """The log no longer holds messages that the ledger has not read."""


@dataclass(frozen=True)
class Range:
    """Messages [start, end) of one partition."""

    topic: str
    partition: int
    start: int
    end: int


def queue_range_options(ranges: Iterable[Range]) -> dict[str, str]:
    """Options of Spark's batch read of a queue (``spark.read.format("kafka")``) for these ranges."""
    starts: dict[str, dict[str, int]] = {}
    ends: dict[str, dict[str, int]] = {}
    for r in ranges:
        starts.setdefault(r.topic, {})[str(r.partition)] = r.start
        ends.setdefault(r.topic, {})[str(r.partition)] = r.end
    return {"subscribe": ",".join(sorted(starts)), "startingOffsets": json.dumps(starts, sort_keys=True),
            "endingOffsets": json.dumps(ends, sort_keys=True), "failOnDataLoss": "true"}


# --- what the log holds -----------------------------------------------------------------

class MessageLog:
    """A message log folder (Parquet files, MESSAGE_SCHEMA) and its segment index below ``index``."""

    def __init__(self, spark: SparkSession, folder: str, index: str):
        self.spark, self.folder, self.index = spark, folder.rstrip("/"), index.rstrip("/")

    def files(self) -> dict[str, tuple[int, int]]:
        """Data files as Spark names them (``_metadata.file_path``: a URI), with length and time of change."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        found: dict[str, tuple[int, int]] = {}
        listed = fs.listFiles(p, True) if fs.exists(p) else None
        while listed is not None and listed.hasNext():
            status = listed.next()
            if not status.getPath().getName().startswith(("_", ".")) and status.getLen() > 0:
                found[_spelled(status.getPath().toUri().toString())] = (status.getLen(), status.getModificationTime())
        return found

    def _files(self, uris: list[str]) -> DataFrame:
        return self.spark.read.schema(MESSAGE_SCHEMA).parquet(*map(unquote, uris))

    def segments(self) -> DataFrame:
        """The index's rows of the files that are there now; new files are scanned once and added."""
        files = self.files()
        known = self.spark.read.schema(INDEX_SCHEMA).parquet(f"{self.index}/*") if folders(self.spark, self.index) else None
        have = {(r["file"], r["length"], r["changed"]) for r in known.select("file", "length", "changed").distinct().collect()} if known is not None else set()
        new = sorted(f for f, (n, t) in files.items() if (f, n, t) not in have)
        if new:
            m = self._files(new)
            at = F.struct("offset", F.md5(F.concat_ws("\u0001", F.col("timestamp").cast("string"), "key", "value")).alias("digest"))
            rows = m.groupBy(F.col("_metadata.file_path").alias("file"), "topic", "partition").agg(
                F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"), F.min("timestamp").alias("first_ts"),
                F.max("timestamp").alias("last_ts"), F.count(F.lit(1)).alias("messages"), F.min(at)["digest"].alias("first_digest"))
            stat = self.spark.createDataFrame([(f, *files[f]) for f in new], "name string, length bigint, changed bigint")
            spelled = F.regexp_replace("file", "^file:/+", "file:/")
            rows = rows.withColumn("file", spelled).join(F.broadcast(stat), F.col("file") == F.col("name")).drop("name")  # a row per new file
            rows.select(*[c.split()[0] for c in INDEX_SCHEMA.split(", ")]).coalesce(1).write.parquet(f"{self.index}/add-{uuid.uuid4().hex[:12]}")
        if not files or not folders(self.spark, self.index):
            return self.spark.createDataFrame([], INDEX_SCHEMA)
        now = self.spark.createDataFrame([(f, n, t) for f, (n, t) in files.items()], "file string, length bigint, changed bigint")
        return self.spark.read.schema(INDEX_SCHEMA).parquet(f"{self.index}/*").join(
            bounded_broadcast(now, known_rows=len(files)), ["file", "length", "changed"], "left_semi").dropDuplicates(["file", "topic", "partition"])

    def bounds(self, segments: DataFrame) -> dict[Part, tuple[int, int, str]]:
        """Per partition its first offset, the offset after its last, and the first message's digest."""
        rows = segments.groupBy("topic", "partition").agg(
            F.min(F.struct("first_offset", "first_digest")).alias("first"), F.max("last_offset").alias("last")).collect()  # a row per partition
        return {(r["topic"], r["partition"]): (r["first"]["first_offset"], r["last"] + 1, r["first"]["first_digest"]) for r in rows}

    def offsets_at(self, segments: DataFrame, time) -> dict[Part, int]:
        """Per partition the smallest offset whose message is not before ``time``; partitions without one are left out.

        Only files with messages on both sides of the time are read.
        """
        t = F.lit(str(time)).cast("timestamp_ntz")
        whole = segments.filter(F.col("first_ts") >= t).select("topic", "partition", F.col("first_offset").alias("offset"))
        straddling = [r["file"] for r in segments.filter((F.col("first_ts") < t) & (F.col("last_ts") >= t)).select("file").distinct().collect()]
        if straddling:
            inside = self._files(straddling).filter(F.col("timestamp") >= t)
            whole = whole.unionByName(inside.select("topic", "partition", "offset"))
        found = whole.groupBy("topic", "partition").agg(F.min("offset").alias("offset")).collect()
        return {(r["topic"], r["partition"]): r["offset"] for r in found}

    def touched(self, segments: DataFrame, ranges: list[Range]) -> list[str]:
        """Files that hold a message of any of the ranges' spans."""
        wanted = self._frame(ranges)
        hit = segments.join(wanted, ["topic", "partition"]).filter("first_offset < `end` AND last_offset >= `start`")
        return sorted(r["file"] for r in hit.select("file").distinct().collect())

    def read(self, segments: DataFrame, ranges: list[Range]) -> DataFrame:
        """The ranges' messages, from the files that hold them."""
        files = self.touched(segments, ranges)
        if not files:
            return self.spark.createDataFrame([], MESSAGE_SCHEMA)
        low, high = min(r.start for r in ranges), max(r.end for r in ranges)  # reaches the scan
        rows = self._files(files).filter((F.col("offset") >= low) & (F.col("offset") < high))
        return rows.join(self._frame(ranges), ["topic", "partition"]).filter("offset >= `start` AND offset < `end`").select(*MESSAGE_SCHEMA.names)

    def _frame(self, ranges: list[Range]) -> DataFrame:
        rows = [(r.topic, r.partition, r.start, r.end) for r in ranges]
        return bounded_broadcast(self.spark.createDataFrame(rows, "topic string, partition int, start bigint, end bigint"), known_rows=len(rows))


def _spelled(path: str) -> str:
    """One spelling for a local file: ``file:/x``, not ``file:///x``; other stores have one."""
    return "file:/" + path[5:].lstrip("/") if path.startswith("file:/") else path


# --- the drain ---------------------------------------------------------------------------

@dataclass
class Drained:
    """What a drain did: messages landed per partition, ranges read, files read of all, partitions begun anew, offsets skipped, batch keys."""

    landed: dict[Part, int] = field(default_factory=dict)
    ranges: list[Range] = field(default_factory=list)
    files_read: int = 0
    files: int = 0
    recreated: list[Part] = field(default_factory=list)
    skipped: dict[Part, tuple[int, int]] = field(default_factory=dict)
    batches: list[str] = field(default_factory=list)

    @property
    def rows(self) -> int:
        return sum(self.landed.values())


def _name(part: Part) -> str:
    return f"{part[0]}/{part[1]}"


def _part(name: str) -> Part:
    topic, _, partition = name.rpartition("/")
    return topic, int(partition)


class LedgerDrain:
    """Drains of one message log into one sink; ``commits`` holds ``offsets``, ``identity`` and ``landed`` (batch keys that count).

    ``on_commit(document, key)`` may note more in the commit, such as the folders that a batch landed in.
    """

    def __init__(self, log: MessageLog, commits: CommitLog, on_commit: Callable[[dict, str], None] | None = None):
        self.log, self.commits, self.on_commit, self.spark = log, commits, on_commit, log.spark

    def offsets(self) -> dict[Part, int]:
        """The offset to read next, per partition."""
        return {_part(k): v for k, v in self.commits.latest()[1].get("offsets", {}).items()}

    def plan(self, start_from=None, end_time=None, skip_lost: bool = False) -> tuple[Drained, DataFrame]:
        """The ranges that a drain starting now reads, and the index rows that they were planned from."""
        check_time_range(start_from, end_time)
        document = self.commits.latest()[1]
        at, identity = document.get("offsets", {}), document.get("identity", {})
        segments = self.log.segments().cache()
        bounds, out = self.log.bounds(segments), Drained()
        starts = self.log.offsets_at(segments, start_from) if start_from is not None else None
        ends = self.log.offsets_at(segments, end_time) if end_time is not None else {}
        for part, (first, end, digest) in sorted(bounds.items()):
            name, known = _name(part), identity.get(_name(part))
            start = at.get(name)
            if start is not None and (end < start or (known and first <= known["offset"] and (first, digest) != (known["offset"], known["digest"]))):
                out.recreated.append(part)
                start = None
            if start is not None and start < first:
                if not skip_lost:
                    raise OffsetsLost(f"{name}: offsets {start} to {first - 1} are no longer in the log")
                out.skipped[part] = (start, first)
            start = first if start is None else max(start, first)
            if starts is not None:
                start = max(start, starts.get(part, end))
            stop = min(end, ends.get(part, end))
            if start < stop:
                out.ranges.append(Range(*part, start, stop))
        return out, segments

    def run(self, sink: LandingSink, start_from=None, end_time=None, skip_lost: bool = False, batch_size: int | None = None) -> Drained:
        """Drain up to the ends found now; ``sink(batch, key)`` lands a batch under its key.

        With ``batch_size`` a partition gives at most so many offsets a batch, and each batch commits by itself.
        """
        out, segments = self.plan(start_from, end_time, skip_lost)
        bounds = self.log.bounds(segments)
        try:
            out.files = segments.select("file").distinct().count()
            out.files_read = len(self.log.touched(segments, out.ranges)) if out.ranges else 0
            left = list(out.ranges)
            while left:
                now = [Range(r.topic, r.partition, r.start, r.end if batch_size is None else min(r.end, r.start + batch_size)) for r in left]
                key = uuid.uuid4().hex[:16]
                rows = self.log.read(segments, now)
                sink(rows, key)
                landed = {(r["topic"], r["partition"]): r["n"] for r in rows.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("n")).collect()}
                self._commit(now, key, bounds, out)
                out.batches.append(key)
                for part, n in landed.items():
                    out.landed[part] = out.landed.get(part, 0) + n
                left = [Range(r.topic, r.partition, n.end, r.end) for r, n in zip(left, now, strict=True) if n.end < r.end]
        finally:
            segments.unpersist()
        return out

    def _commit(self, ranges: list[Range], key: str, bounds: Mapping[Part, tuple[int, int, str]], out: Drained) -> None:
        def edit(document: dict) -> None:
            offsets, identity = document.setdefault("offsets", {}), document.setdefault("identity", {})
            for r in ranges:
                name = _name((r.topic, r.partition))
                offsets[name] = r.end
                first, _, digest = bounds[(r.topic, r.partition)]
                identity[name] = {"offset": first, "digest": digest}
            document.setdefault("landed", []).append(key)
            if self.on_commit is not None:
                self.on_commit(document, key)

        self.commits.change(edit)
        self.commits.kept(2)

    def run_with_retries(self, sink: LandingSink, attempts: int = 4, wait_seconds: float = 1.0, skip_lost: bool = False, sleep=None, **bounds) -> Outcome:
        """``run`` with errors handled by class: retriable ones are tried again from the ledger, which batches that passed have advanced.

        Offsets skipped as lost make the outcome ``partial``.
        """
        def step() -> Drained:
            return self.run(sink, skip_lost=skip_lost, **bounds)

        def checked() -> Drained:
            done = step()
            if done.skipped:
                raise SoftFault(f"offsets no longer in the log: {done.skipped}", done)
            return done

        return with_retries(checked, attempts, wait_seconds, **({"sleep": sleep} if sleep else {}))


def landing_sink(path: str, mapper: Callable[[DataFrame], DataFrame] | None = None) -> LandingSink:
    """Sink that lands each batch in a folder of its key."""
    def sink(batch: DataFrame, key: str) -> None:
        (mapper(batch) if mapper else batch).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={key}")
    return sink


def read_landed(spark: SparkSession, path: str, commits: CommitLog) -> DataFrame:
    """The batches that the ledger names; what a failed drain left beside them does not count."""
    keys = commits.latest()[1].get("landed", [])
    if not keys:
        raise FileNotFoundError(f"no batch has landed in {path}")
    return spark.read.parquet(*[f"{path.rstrip('/')}/batch={k}" for k in keys])


def drop_uncommitted(spark: SparkSession, path: str, commits: CommitLog) -> int:
    """Drop folders of batches that no commit names (drains that died); no drain may be running. Returns how many."""
    keys = set(commits.latest()[1].get("landed", []))
    dead = [name for name in folders(spark, path) if name.startswith("batch=") and name.removeprefix("batch=") not in keys]
    for name in dead:
        drop_folder(spark, f"{path.rstrip('/')}/{name}")
    return len(dead)

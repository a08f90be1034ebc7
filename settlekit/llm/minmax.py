"""Near-duplicate detection by min-max hashing.

A document's set of word shingles is hashed under P permutations, and of each
both the smallest and the largest hash is kept: 2 P unbiased signature values for
P evaluations. Bands of the values bring candidates together; links are confirmed
on full sets. Equal sets are one candidate throughout.

Candidates of a bucket are not paired off. (1) Every member is tested against
the bucket's smallest member. (2) The confirmed links' components show which
buckets still hold members of several components; there the members outside the
largest component are tested, block by block, against each other and against it,
and only links that join two components come out. What is not tested lies inside
a component, so no link between components is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import salt, written
from .components import components

#: Members of a bucket that are tested against each other in one task.
BLOCK = 128
#: Words that a task remembers.
REMEMBERED = 400_000
#: Hashes that are held at once.
TILE = 1_024


@dataclass(frozen=True)
class MinMax:
    """Shingle length, similarity in percent, and the banding.

    With 32 bands of ``rows`` values, two sets at the threshold share no band with a probability of
    3e-7 (85 %, 6 rows) or 3e-6 (80 %, 5 rows), and less above it.
    """

    words: int = 5
    percent: int = 80
    rows: int = 5
    bands: int = 32

    @property
    def permutations(self) -> int:
        return self.rows * self.bands // 2


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


class Shingles:
    """Shingle sets of texts, for one task."""

    def __init__(self, words: int):
        self.words, self.hashes = words, _WordHashes()

    def of(self, text: str | None) -> np.ndarray:
        """Sorted distinct shingle hashes of the whole text; with fewer words, the sequence as one.

        Words are cut at ASCII white space, and A-Z are lower-cased (what bytes.lower and bytes.split do).
        """
        words = (text or "").encode().lower().split()
        if not words:
            return np.empty(0, np.uint64)
        h = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        k = min(self.words, len(words))
        code = np.full(len(words) - k + 1, k, np.uint64)
        for i in range(k):
            code = (code + h[i:len(words) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            code ^= code >> np.uint64(29)
        return np.unique(_mix(code))


class Signatures:
    """Band keys of shingle sets."""

    def __init__(self, p: MinMax):
        rng = np.random.default_rng(20_011)
        self.p = p
        self.a = rng.integers(0, 2**64, p.permutations, np.uint64) | np.uint64(1)
        self.b = rng.integers(0, 2**64, p.permutations, np.uint64)

    def min_max(self, shingles: np.ndarray) -> np.ndarray:
        """The smallest hash under each permutation, then the largest."""
        low, high = np.full(self.p.permutations, np.iinfo(np.uint64).max), np.zeros(self.p.permutations, np.uint64)
        for i in range(0, len(shingles), TILE):
            v = shingles[i:i + TILE, None] * self.a + self.b
            low, high = np.minimum(low, v.min(axis=0)), np.maximum(high, v.max(axis=0))
        return np.concatenate((low, high))

    def bands(self, shingles: np.ndarray) -> np.ndarray:
        values = self.min_max(shingles).reshape(self.p.bands, self.p.rows)
        key = np.arange(1, self.p.bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for i in range(self.p.rows):
            key = _mix(key + values[:, i])
        return key.view(np.int64)


def alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, for sorted distinct arrays."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)) or not len(x) or not len(y):
        return False
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def signatures(docs: DataFrame, p: MinMax) -> DataFrame:
    """doc_id, n, digest, bands of every document: set size, digest of the set (null if empty), band keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, signer = Shingles(p.words), Signatures(p)
        for batch in batches:
            n, digest, bands = [], [], []
            for text in batch.column(1):
                x = shingles.of(text.as_py())
                n.append(len(x))
                digest.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None)
                bands.append(signer.bands(x) if len(x) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                                             ["doc_id", "n", "digest", "bands"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, digest binary, bands array<long>")


def shingle_sets(docs: DataFrame, p: MinMax) -> DataFrame:
    """id, shingles (sorted 64-bit hashes, packed) of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(p.words)
        for batch in batches:
            sets = [shingles.of(t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["id", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(run, "id long, shingles binary")


def _star_links(edges: DataFrame, sets: DataFrame, p: MinMax) -> DataFrame:
    """The edges (a, b) whose sets are alike. An ``a`` with many edges is a hot key that Spark splits."""
    percent = p.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, x = [], None, np.empty(0, np.uint64)
            for a, left, right in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if a != last:
                    last, x = a, np.frombuffer(left.as_py(), np.uint64)
                keep.append(alike(x, np.frombuffer(right.as_py(), np.uint64), percent))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    members = edges.join(sets.withColumnRenamed("id", "b"), "b").select("a", "b", F.col("shingles").alias("right"))
    return (members.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("left")).hint("merge"), "a")
            .select("a", "b", "left", "right").mapInArrow(run, "a long, b long"))


def _block_links(members: DataFrame, sets: DataFrame, p: MinMax) -> DataFrame:
    """Links between different components (column comp) within the buckets (column key), as the pairs (a, b) of components.

    The largest component's members meet those of the others, these meet each other; members come
    in blocks, and a group is a pair of blocks.
    """
    percent = p.percent
    per = members.groupBy("key", "comp").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"))
    buckets = per.groupBy("key").agg(F.count("*").alias("comps"), F.sum("n").alias("n"), F.max("n").alias("most"), F.max_by("comp", "n").alias("main"),
                                     F.bit_xor("x").alias("x")).filter("comps > 1")
    # buckets of several bands that hold the same members are one
    once = written(buckets.groupBy("x", "n", "most").agg(F.min("key").alias("key"), F.min_by("main", "key").alias("main")).select(
        F.col("key").alias("bucket"), "main", F.ceil(F.col("most") / BLOCK).alias("main_blocks"), F.ceil((F.col("n") - F.col("most")) / BLOCK).alias("blocks")), "minmax-buckets")
    rest = F.col("comp") != F.col("main")
    spread = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    own = F.pmod(F.xxhash64(F.lit(7), F.col("id")), F.when(rest, F.col("blocks")).otherwise(F.col("main_blocks")))
    pair = lambda i, j: F.struct(i.cast("long").alias("i"), j.cast("long").alias("j"))
    against_main = F.when(rest, F.transform(spread("main_blocks"), lambda j: pair(F.col("own"), j))).otherwise(F.transform(spread("blocks"), lambda i: pair(i, F.col("own"))))
    against_rest = F.when(rest, F.transform(F.filter(spread("blocks"), lambda k: k != F.col("own")), lambda k: pair(F.least(F.col("own"), k), -1 - F.greatest(F.col("own"), k))))
    none = F.array().cast("array<struct<i:bigint,j:bigint>>")
    dealt = (members.join(once.hint("merge"), F.col("key") == F.col("bucket")).withColumn("own", own).withColumn("is_rest", rest)
             .select("key", "id", "comp", "is_rest", F.explode(F.concat(F.coalesce(against_main, none), F.coalesce(against_rest, none))).alias("at"))
             .select("key", "at.i", "at.j", "id", "comp", "is_rest").join(sets, "id").drop("id"))

    def solve(group: pa.Table) -> pa.Table:
        comp, rest_of, j = group["comp"].to_pylist(), group["is_rest"].to_pylist(), group["j"][0].as_py()
        x = [np.frombuffer(s.as_py(), np.uint64) for s in group["shingles"]]
        parent = {c: c for c in comp}

        def root(c: int) -> int:
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        found = []
        for a in range(len(comp)):
            for b in range(a + 1, len(comp)):
                if not (rest_of[a] or rest_of[b]) or (j > 0 and rest_of[a] and rest_of[b]):
                    continue  # rest against rest within a block is looked at once, beside the first main block
                ra, rb = root(comp[a]), root(comp[b])
                if ra != rb and alike(x[a], x[b], percent):
                    parent[max(ra, rb)] = min(ra, rb)
                    found.append((comp[a], comp[b]))
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return dealt.groupBy("key", "i", "j").applyInArrow(solve, "a long, b long")


def near_duplicates(docs: DataFrame, p: MinMax = MinMax()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, copies: one row per document.

    ``component_id`` is the smallest doc_id reachable over links of at least ``p.percent`` per cent Jaccard
    similarity of the sets of ``p.words``-word shingles; ``kept`` marks it. Null and empty texts and those of
    white space have the empty set and stay alone. Rows that repeat id and text are one document (``copies``);
    an id stands for one text.
    Rows without an id take no part: their component is null, and they are kept. An empty table gives no rows.
    Only doc_id and text are read.
    """
    signed = signatures(docs, p).withColumn("piece", salt("doc_id")).checkpoint()
    # equal sets: the smallest id stands for all; a set that many documents share is reduced in pieces
    has = F.col("doc_id").isNotNull() & F.col("digest").isNotNull()
    parts = signed.filter(has).groupBy("digest", "piece").agg(F.min("doc_id").alias("least"))
    firsts = parts.groupBy("digest").agg(F.min("least").alias("id"))
    groups = parts.select("digest", "piece").join(firsts, "digest").checkpoint()
    standing = groups.filter(F.col("piece") == salt("id")).select("id", F.col("digest").alias("d"))
    # a row that repeats is one member: the buckets' members are compared by their xor
    keys = (signed.filter(has).join(standing, (F.col("doc_id") == F.col("id")) & (F.col("digest") == F.col("d"))).dropDuplicates(["id", "d"])
            .select("id", F.explode("bands").alias("key")))
    heads = written(keys.groupBy("key").agg(F.min("id").alias("head"), F.max("id").alias("last")).filter("head <> last")
                    .select(F.col("key").alias("bucket"), "head"), "minmax-heads")
    members = keys.join(heads.hint("merge"), F.col("key") == F.col("bucket")).select("key", "id", "head").checkpoint()
    wanted = members.select(F.col("id").alias("wanted")).distinct()
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("wanted"), "left_semi").dropDuplicates(["doc_id"])
    sets = written(shingle_sets(texts, p), "minmax-sets")
    edges = members.filter("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b")).distinct()
    stars = components(_star_links(edges, sets, p)).withColumnRenamed("u", "id")
    others = (members.filter("id <> head").select("key", "id").join(stars, "id", "left")
              .select("key", "id", F.coalesce("root", "id").alias("comp")).checkpoint())
    links = written(_block_links(others, sets, p).distinct(), "minmax-links")
    placed = groups.join(stars, "id", "left").select(F.col("digest").alias("d"), F.col("piece").alias("q"), F.coalesce("root", "id").alias("root"))
    if not links.isEmpty():  # stars stand for their members: only roots are joined up further
        joined = written(components(links), "minmax-joined").select(F.col("u").alias("of"), F.col("root").alias("least"))
        placed = placed.join(joined, F.col("root") == F.col("of"), "left").select("d", "q", F.coalesce("least", "root").alias("root"))
    return (signed.join(placed, (F.col("digest") == F.col("d")) & (F.col("piece") == F.col("q")), "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id"))
            .groupBy("doc_id", "n_shingles", "component_id").agg(F.count("*").alias("copies"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def keep_representatives(docs: DataFrame, p: MinMax = MinMax()) -> DataFrame:
    """The rows of ``docs`` (all their columns) whose document ``near_duplicates`` keeps, one row per document."""
    found = near_duplicates(docs, p).checkpoint()
    dropped = found.filter("NOT kept").select(F.col("doc_id").alias("__dropped"))
    rest = docs.join(dropped, docs["doc_id"] == dropped["__dropped"], "left_anti")
    if found.filter("kept AND copies > 1 AND doc_id IS NOT NULL").isEmpty():
        return rest
    return rest.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).unionByName(rest.filter("doc_id IS NULL"))


def oracle(p: MinMax) -> str:
    """The query of ``near_duplicates`` for DuckDB: every pair that shares a shingle is counted."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^ 	-
]+') AS ws FROM documents),
        s AS MATERIALIZED (
          SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < {p.words} THEN [array_to_string(ws, ' ')]
            ELSE list_transform(range(1, len(ws) - {p.words} + 2), lambda i: array_to_string(ws[i:i + {p.words} - 1], ' ')) END)) AS sh FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        link AS MATERIALIZED (
          SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY 1, 2)
          JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * i >= {p.percent} * (p.n + q.n - i)),
        reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
        least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
        SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(m, w.doc_id)) AS component_id,
               w.doc_id <= coalesce(m, w.doc_id) AS kept
        FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least ON a = w.doc_id
    """

"""Exact top-k inner-product search as a Voronoi kNN join.

Vectors fall into the cell of their nearest pivot. A cell's summary (count,
radius, largest norm) bounds the scores of a query with any of its members:
``q.c - |q| r <= q.x <= min(q.c + |q| r, |q| max|x|)``. From the lower bounds a
query knows a score that its k-th best certainly reaches, and needs only the
cells whose upper bound is not below it. Queries are packed into groups, cells
are cut into blocks, a block is sent to the groups in which some query needs it
(and nowhere else), and each pair of group and block is solved locally.

What the driver holds is one summary per pivot, at most ``MAX_PIVOTS``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_sample

SCALE = 256
K = 5
#: Rows that a pivot stands for, and the bounds of their number.
ROWS_A_PIVOT, MIN_PIVOTS, MAX_PIVOTS = 2_000, 16, 1_024
#: Queries in a group and vectors in a block, at most (about).
GROUP_QUERIES, BLOCK_VECTORS = 16_384, 16_384
#: Scores that are held at once.
TILE = 4_000_000
EXACT = 2.0**52
#: Scaled components of this size or more have no finite bounds.
TOO_LARGE = 2.0**480
LONG = 2**63


def integers(vectors: pa.Array, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """floor(256 x) of the usable vectors as floats, and which ones are usable.

    Unusable: null, of another length than ``dim`` (default: the first usable one's), or holding a
    null, a non-finite component or one that is not below ``TOO_LARGE`` when scaled. The floats are
    exact: scaling is by a power of two.
    """
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = np.asarray(vectors.value_lengths().fill_null(-1))
    if dim is None:
        dim = int(lengths[lengths > 0][0]) if (lengths > 0).any() else 0
    usable = np.asarray(vectors.is_valid()) & (lengths == dim) & (dim > 0)
    flat = vectors.filter(pa.array(usable)).flatten()
    x = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, max(dim, 1))
    finite = (np.abs(x) < TOO_LARGE / SCALE).all(axis=1)
    usable[np.flatnonzero(usable)[~finite]] = False
    return np.floor(SCALE * x[finite]), usable


def _packed(x: np.ndarray) -> pa.Array:
    """Four bytes a component where all of the batch fit, else the floats."""
    return pa.array([row.tobytes() for row in x.astype("<i4" if np.abs(x).max(initial=0) < 2**31 else "<f8")], pa.binary())


def _unpacked(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    raw = column.to_pylist()
    wide = {len(r) for r in raw}
    if len(wide) == 1:
        return np.frombuffer(b"".join(raw), "<i4" if wide == {4 * dim} else "<f8").reshape(-1, dim).astype(np.float64)
    return np.stack([np.frombuffer(r, "<i4" if len(r) == 4 * dim else "<f8").astype(np.float64) for r in raw]) if raw else np.empty((0, dim))


def _assign(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest pivot of each vector and a distance that is not less than the true one."""
    cell, dist = np.zeros(len(x), np.int32), np.zeros(len(x))
    for a in range(0, len(x), max(1, TILE // len(pivots))):
        part = x[a:a + max(1, TILE // len(pivots))]
        near = ((pivots**2).sum(axis=1)[None, :] - 2 * part @ pivots.T).argmin(axis=1)
        cell[a:a + len(part)] = near
        dist[a:a + len(part)] = np.sqrt(((part - pivots[near]) ** 2).sum(axis=1)) * (1 + 1e-9) + 1e-6
    return cell, dist


def pivots_of(data: DataFrame, id_col: str, vec_col: str) -> np.ndarray:
    """Distinct usable vectors of a bounded sample (about a pivot per ``ROWS_A_PIVOT`` rows), of the commonest length."""
    rows = data.select(F.col(id_col).alias("key"), F.col(vec_col).alias("vec"), F.lit(0).alias("one")).filter("key IS NOT NULL AND vec IS NOT NULL")
    lengths = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not lengths or lengths[0]["d"] < 1:
        return np.empty((0, 0))
    dim, n = lengths[0]["d"], lengths[0]["n"]
    sample, _ = bounded_sample(rows.filter(F.size("vec") == dim), "one", "key", int(np.clip(n // ROWS_A_PIVOT, MIN_PIVOTS, MAX_PIVOTS)))
    x, _ = integers(pa.array([r["vec"] for r in sample], pa.list_(pa.float64())), dim)
    distinct = np.unique(x, axis=0)
    return distinct[np.random.default_rng(3).permutation(len(distinct))][:MAX_PIVOTS]


def voronoi_top_k(queries: DataFrame, data: DataFrame, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` best rows of ``data`` by integer inner product.

    ``queries`` are rows of ``data``. A query's own row (same id) is no candidate; fewer than ``k`` candidates are
    all returned; equal scores go to the smaller id. Scores are exact at any size of the components; one beyond a
    long is returned as the nearest long, and ranked by what it is. Rows without an id, null vectors, those with a null or a
    non-finite component (or one of 1e142 or more) and those that do not have the commonest length take no part. Repeated rows are
    candidates of their own; a repeated query id is answered once. No usable vector: no rows. Only the two
    columns are read.
    """
    spark = data.sparkSession
    pivots = pivots_of(data, id_col, vec_col)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not len(pivots):
        return empty
    dim = pivots.shape[1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, usable = integers(batch.column(1), dim)
            cell, dist = _assign(x, pivots)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(usable)), _packed(x), pa.array(cell), pa.array(dist), pa.array(np.sqrt((x**2).sum(axis=1)))],
                                             ["id", "v", "cell", "dist", "norm"])

    placed = "id long, v binary, cell int, dist double, norm double"
    pick = lambda df: df.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), vec_col)
    vectors = pick(data).mapInArrow(place, placed).checkpoint()
    # One row per pivot, at most MAX_PIVOTS.
    cells = {r["cell"]: r for r in vectors.groupBy("cell").agg(F.count("*").alias("n"), F.max("dist").alias("radius"), F.max("norm").alias("norm")).collect()}
    used = sorted(cells)
    if not used:
        return empty
    centre, count = pivots[used], np.array([cells[c]["n"] for c in used])
    radius, norm = np.array([cells[c]["radius"] for c in used]), np.array([cells[c]["norm"] for c in used])
    reach = np.maximum(norm, np.sqrt((centre**2).sum(axis=1)))  # bounds the rounding of a cell's products
    blocks = np.ceil(count / max(1, min(BLOCK_VECTORS, count.sum() // len(used)))).astype(int)

    def needs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = _unpacked(batch.column(1), dim)
            size = np.sqrt((q**2).sum(axis=1))[:, None]
            at_centre, slack = q @ centre.T, 1e-6 * (1 + size * reach[None, :])
            low, high = at_centre - size * radius[None, :] - slack, np.minimum(at_centre + size * radius[None, :], size * norm[None, :]) + slack
            order = np.argsort(-low, axis=1)
            reached = np.cumsum(count[order], axis=1) >= (k + np.asarray(batch.column(2)))[:, None]
            last = np.where(reached.any(axis=1), reached.argmax(axis=1), -1)
            floor = np.where(last >= 0, np.take_along_axis(low, np.take_along_axis(order, np.maximum(last, 0)[:, None], axis=1), axis=1)[:, 0], -np.inf)
            wanted = [np.flatnonzero(h >= f).astype(np.int32) for h, f in zip(high, floor, strict=True)]
            near, _ = _assign(q, centre)
            offsets = np.concatenate(([0], np.cumsum([len(w) for w in wanted]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near), pa.array(floor),
                                              pa.ListArray.from_arrays(offsets, np.concatenate([*wanted, np.empty(0, np.int32)]))], ["query_id", "q", "home", "floor", "wanted"])

    asked = pick(queries).mapInArrow(place, placed).groupBy("id").agg(F.min("v").alias("v"), F.count("*").alias("copies"))
    asked = asked.mapInArrow(needs, "query_id long, q binary, home int, floor double, wanted array<int>").checkpoint()
    homes = {r["home"]: r["n"] for r in asked.groupBy("home").agg(F.count("*").alias("n")).collect()}  # at most MAX_PIVOTS
    groups = _pack(homes, centre)
    if not groups:
        return empty
    # Both tables have a row per pivot at most.
    group_table = F.broadcast(spark.createDataFrame([(int(h), int(g), int(n)) for h, (g, n) in groups.items()], "home int, first int, parts int"))
    block_table = F.broadcast(spark.createDataFrame([(i, c, int(b)) for i, (c, b) in enumerate(zip(used, blocks, strict=True))], "place int, cell int, blocks int"))
    part = lambda key, n: F.pmod(F.xxhash64(F.lit(41), F.col(key)), F.col(n)).cast("int")
    sent = (asked.join(group_table, "home").withColumn("grp", F.col("first") + part("query_id", "parts"))
            .select("grp", "query_id", "q", "floor", F.explode("wanted").alias("place")).join(block_table, "place")
            .select("grp", "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "query_id", "q", "floor"))
    wanted = sent.select(F.col("grp").alias("to"), F.col("cell"), F.col("block")).distinct()
    copies = (vectors.join(block_table, "cell").withColumn("block", part("id", "blocks")).select("cell", "block", "id", "v")
              .join(wanted, ["cell", "block"]).select("to", F.col("cell").alias("of"), F.col("block").alias("piece"), "id", "v"))

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        return _local(left, right, k, dim)

    best = sent.groupBy("grp", "cell", "block").cogroup(copies.groupBy("to", "of", "piece")).applyInArrow(solve, "query_id long, vec_id long, score long, beyond binary")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")  # scores beyond a long share its ends
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _pack(homes: dict[int, int], centre: np.ndarray) -> dict[int, tuple[int, int]]:
    """First group and number of groups of each cell's queries; neighbouring cells share a group while it is small."""
    out: dict[int, tuple[int, int]] = {}
    left, group, size, at = set(homes), 0, 0, min(homes, default=None)
    while left:
        n = homes[at]
        if n > GROUP_QUERIES:
            parts = -(-n // GROUP_QUERIES)
            group, size = group + (size > 0), 0
            out[at] = (group, parts)
            group += parts
        else:
            if size and size + n > GROUP_QUERIES:
                group, size = group + 1, 0
            out[at] = (group, 1)
            size += n
        left.discard(at)
        if left:
            rest = sorted(left)
            at = rest[int(((centre[rest] - centre[at]) ** 2).sum(axis=1).argmin())]
    return out


def _local(left: pa.Table, right: pa.Table, k: int, dim: int) -> pa.Table:
    """The k best rows of a block for each query of a group, without the query's own and those below its floor."""
    found_q, found_v, found_s, found_o = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)], []
    if left.num_rows and right.num_rows:
        ids = right["id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], _unpacked(right["v"], dim)[order]
        query_ids, q, floor = left["query_id"].to_numpy(), _unpacked(left["q"], dim), left["floor"].to_numpy()
        n, step = len(ids), max(1, TILE // len(ids))
        size_q, size_x = np.sqrt((q**2).sum(axis=1)), np.sqrt((x**2).sum(axis=1))
        exact = float(size_q.max()) * float(size_x.max()) < EXACT  # bounds every partial sum of a product
        for a in range(0, len(q), step):
            score = q[a:a + step] @ x.T
            own = query_ids[a:a + step, None] == ids[None, :]
            if not exact:
                off = 2.0**-51 * dim * size_q[a:a + step, None] * size_x[None, :]
                for i, (row, at) in enumerate(_exact_best(q[a:a + step], x, score, off, own, k)):
                    keep = [(v, c) for v, c in zip(row, at, strict=True) if v >= floor[a + i]]
                    found_q.append(np.full(len(keep), query_ids[a + i], np.int64))
                    found_v.append(ids[[c for _, c in keep]].astype(np.int64))
                    found_s.append(np.array([min(max(v, -LONG), LONG - 1) for v, _ in keep], np.int64))
                    found_o.append(_rank_keys([v for v, _ in keep]))
                continue
            score[own] = -np.inf
            if np.abs(score[~own]).max(initial=0) * n < EXACT:  # score and place in one number: ties go to the smaller id
                key = score * n + (n - 1 - np.arange(n))[None, :]
                top = np.argpartition(-key, min(k, n) - 1, axis=1)[:, :k]
                top = np.take_along_axis(top, np.argsort(-np.take_along_axis(key, top, axis=1), axis=1), axis=1)
            else:
                top = np.argsort(-score, axis=1, kind="stable")[:, :k]
            value = np.take_along_axis(score, top, axis=1)
            row, column = np.nonzero(np.isfinite(value) & (value >= floor[a:a + step, None]))
            found_q.append(query_ids[a:a + step][row])
            found_v.append(ids[top[row, column]])
            found_s.append(value[row, column].astype(np.int64))
            found_o.append([None] * len(row))
    return pa.table({"query_id": np.concatenate(found_q), "vec_id": np.concatenate(found_v), "score": np.concatenate(found_s),
                     "beyond": pa.array([o for part in found_o for o in part], pa.binary())})


def _exact_best(q: np.ndarray, x: np.ndarray, score: np.ndarray, off: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[list[int], list[int]]]:
    """Scores as Python integers and places of each query's ``k`` best; ``off`` bounds the rounding of ``score``."""
    for i in range(len(q)):
        low = np.where(own[i], -np.inf, score[i] - off[i])
        least = np.partition(low, -k)[-k] if len(low) > k else -np.inf
        places = np.flatnonzero(~own[i] & (score[i] + off[i] >= least))
        mine = [int(v) for v in q[i]]
        values = [int(score[i, c]) if off[i, c] < 0.25 else sum(m * int(v) for m, v in zip(mine, x[c], strict=True)) for c in places]
        best = sorted(zip(values, places.tolist(), strict=True), key=lambda p: (-p[0], p[1]))[:k]
        yield [v for v, _ in best], [c for _, c in best]


def _rank_keys(values: list[int]) -> list[bytes | None]:
    """For a score beyond a long, bytes that order as the score does; null for all others."""
    return [v.to_bytes(256, "big") if v >= LONG else (v + (1 << 2047)).to_bytes(256, "big") if v <= -LONG else None for v in values]

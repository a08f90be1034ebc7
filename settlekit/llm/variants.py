"""Spelling variants: words one edit apart, found by range searches in k-d trees over letter counts.

One replaced letter moves two letter counts by one, one inserted letter moves one: so
near words lie within an L1 distance of two. For each length, a k-d tree over a sample
of its words' vectors cuts the words into cells (the tree is small, the cells hold every
word). A word is sent to the cells of its own length that can hold a vector with at most
one count higher and one lower, and to those of the next length with one count higher;
each cell is one group, with a k-d tree of its own whose boxes prune the queries, and
the letter order of what is left is checked. Letters are folded into DIMS counts, and
counts end at 120: both only bring vectors closer, so no near word is missed.

A pair is met in one cell only: of two cells of a length the lower one's word is the
query, within a cell the smaller word is. A cell that a tree cannot split (words of the
same letters) is dealt into a grid of pieces of its words and pieces of its queries, so
groups stay bounded and no pair is lost.

Defined cases: a null text has no words; a null doc_id counts as an empty text in the
drop rule; repeated rows count each; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}

MIN_LENGTH, MIN_COUNT, DROP_ONE_IN = 5, 3, 97

#: Letter counts of a word: a to z, and the other letters folded.
DIMS, OTHERS = 32, 6
MOST_OF_A_LETTER = 120

#: Words of a cell, about; pieces of a larger one hold twice that, pieces of its queries sixteen times.
CELL = 8192
#: Words whose vectors fit the trees (a bound over all lengths; every word is placed).
SAMPLE = 100_000
#: Words of a leaf of a cell's own tree, and pairs compared at a time.
LEAF, PAIRS = 96, 1 << 20
#: Words that a task counts before it hands them on.
COUNTED = 400_000


# ---- words -----------------------------------------------------------------
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def found() -> pa.RecordBatch:
        out = pa.record_batch({"word": pa.array(list(counts.keys()), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})
        counts.clear()
        return out

    lowered: dict[str, tuple[str, bytes]] = {}
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
            start = zlib.crc32(b":" if doc_id is None else f"{doc_id}:".encode())
            for run, n in Counter(RUN.findall(text.as_py() or "")).items():
                if (known := lowered.get(run)) is None:
                    word = run.translate(LOWER)
                    known = lowered[run] = word, word.encode()
                    if len(lowered) > COUNTED:
                        lowered.clear()
                word, raw = known
                h = zlib.crc32(raw, start)
                if h % DROP_ONE_IN == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1:]
                if len(word) >= MIN_LENGTH:
                    counts[word] += n
            if len(counts) > COUNTED:
                yield found()
    if counts:
        yield found()


def words(docs: DataFrame) -> DataFrame:
    """word, n: the words that are long and frequent enough."""
    counted = docs.select("doc_id", "text").mapInArrow(_count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


# ---- vectors and trees -----------------------------------------------------
def vectors(found: list[str]) -> np.ndarray:
    """Letter counts, a row of DIMS a word."""
    codes = np.frombuffer("".join(found).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(found)), np.fromiter(map(len, found), np.int64, len(found)))
    low = codes.astype(np.int64) - 97
    dim = np.where((low >= 0) & (low < 26), low, 26 + codes % OTHERS)
    return np.minimum(np.bincount(row * DIMS + dim, minlength=len(found) * DIMS), MOST_OF_A_LETTER).reshape(-1, DIMS).astype(np.int8)


def best_split(v: np.ndarray) -> tuple[int, int] | None:
    """Dimension and highest count of the lower half, the most even one; None where all vectors are alike."""
    best, most = None, 0
    for dim in np.flatnonzero(v.min(0) < v.max(0)).tolist():
        upto = np.cumsum(np.bincount(v[:, dim]))[:-1]
        even = np.minimum(upto, len(v) - upto)
        if even.max() > most:
            best, most = (dim, int(even.argmax())), int(even.max())
    return best


@dataclass
class Node:
    """A split (words whose count at ``dim`` is at most ``upto`` go low) or, with no children, a cell."""

    cell: int = -1
    dim: int = 0
    upto: int = 0
    low: Node | None = None
    high: Node | None = None


def fit(sample: np.ndarray, stands_for: float, cell: int) -> Node:
    """A tree over sampled vectors, each of which stands for so many words; cells are numbered from the left."""
    cells = iter(range(1 << 62))

    def grow(v: np.ndarray) -> Node:
        split = best_split(v) if len(v) * stands_for > cell and len(v) > 1 else None
        if split is None:
            return Node(cell=next(cells))
        low = v[:, split[0]] <= split[1]
        return Node(dim=split[0], upto=split[1], low=grow(v[low]), high=grow(v[~low]))

    return grow(sample)


def places(tree: Node, v: np.ndarray) -> np.ndarray:
    """The cell of each vector."""
    out = np.zeros(len(v), np.int64)

    def walk(node: Node, rows: np.ndarray) -> None:
        if node.low is None:
            out[rows] = node.cell
        elif len(rows):
            low = v[rows, node.dim] <= node.upto
            walk(node.low, rows[low])
            walk(node.high, rows[~low])

    walk(tree, np.arange(len(v)))
    return out


def reached(tree: Node, v: np.ndarray, lower: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) of each cell that can hold a vector with counts at most 1 higher and at most ``lower`` lower in all."""
    rows_out, cells_out = [], []

    def walk(node: Node, rows: np.ndarray, up: np.ndarray, down: np.ndarray, box: dict[int, tuple[int, int]]) -> None:
        if not len(rows):
            return
        if node.low is None:
            rows_out.append(rows)
            cells_out.append(np.full(len(rows), node.cell))
            return
        count = v[rows, node.dim].astype(np.int64)
        least, most = box.get(node.dim, (0, MOST_OF_A_LETTER))
        fewer = down - np.maximum(count - most, 0) + np.maximum(count - node.upto, 0)
        keep = fewer <= lower
        walk(node.low, rows[keep], up[keep], fewer[keep], box | {node.dim: (least, node.upto)})
        more = up - np.maximum(least - count, 0) + np.maximum(node.upto + 1 - count, 0)
        keep = more <= 1
        walk(node.high, rows[keep], more[keep], down[keep], box | {node.dim: (node.upto + 1, most)})

    start = np.zeros(len(v), np.int64)
    walk(tree, np.arange(len(v)), start, start, {})
    return np.concatenate(rows_out or [start[:0]]), np.concatenate(cells_out or [start[:0]])


# ---- near words ------------------------------------------------------------
def one_edit(a: list[str], b: list[str]) -> np.ndarray:
    """Whether each pair is one edit apart; ``b`` is as long as ``a`` or one longer, and all of a list are of one length."""
    la, lb = len(a[0]), len(b[0])
    x = np.frombuffer("".join(a).encode("utf-32-le"), np.uint32).reshape(len(a), la)
    y = np.frombuffer("".join(b).encode("utf-32-le"), np.uint32).reshape(len(b), lb)
    if la == lb:
        return (x != y).sum(1) == 1
    same_front = np.logical_and.accumulate(x == y[:, :-1], axis=1).sum(1)
    same_back = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], axis=1).sum(1)
    return same_front + same_back >= la


def signatures(v: np.ndarray) -> np.ndarray:
    """Two bits a count: at least one, at least two."""
    bits = np.concatenate([v >= 1, v >= 2], axis=1)
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()


@dataclass
class Cell:
    """The words of one cell (all of one length) as a k-d tree whose nodes have the tight box of their vectors."""

    words: list[str]
    v: np.ndarray = field(init=False)
    marks: np.ndarray = field(init=False)

    def __post_init__(self):
        self.v = vectors(self.words)
        self.marks = signatures(self.v)

    def near(self, asked: list[str], same_cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of asked, row of words) of all pairs one edit apart; ``asked`` are as long as the cell's words or one shorter.

        Of a word asked within its own cell only larger words are found.
        """
        same_length = len(asked[0]) == len(self.words[0])
        lower, q = int(same_length), vectors(asked)
        q_marks, found_q, found_w = signatures(q), [], []

        def compare(rows: np.ndarray, at: np.ndarray) -> None:
            width = max(1, PAIRS // len(at))
            for i in range(0, len(rows), width):
                part = rows[i:i + width]
                apart = np.bitwise_count(self.marks[None, at] & ~q_marks[part, None]) <= 1
                apart &= np.bitwise_count(q_marks[part, None] & ~self.marks[None, at]) <= lower
                a, b = np.nonzero(apart)
                a, b = part[a], at[b]
                gap = self.v[b] - q[a]
                keep = (np.maximum(gap, 0).sum(1) <= 1) & (np.maximum(-gap, 0).sum(1) <= lower)
                self._verify(asked, same_cell, a[keep], b[keep], found_q, found_w)

        def walk(rows: np.ndarray, at: np.ndarray) -> None:
            v = self.v[at]
            least, most, counts = v.min(0), v.max(0), q[rows]
            keep = (np.maximum(least - counts, 0).sum(1) <= 1) & (np.maximum(counts - most, 0).sum(1) <= lower)
            rows = rows[keep]
            if not len(rows):
                return
            split = best_split(v) if len(at) > LEAF else None
            if split is None:
                compare(rows, at)
                return
            low = v[:, split[0]] <= split[1]
            walk(rows, at[low])
            walk(rows, at[~low])

        walk(np.arange(len(asked)), np.arange(len(self.words)))
        return np.concatenate(found_q or [np.arange(0)]), np.concatenate(found_w or [np.arange(0)])

    def _verify(self, asked: list[str], same_cell: np.ndarray, a: np.ndarray, b: np.ndarray, found_q: list, found_w: list) -> None:
        width = max(1, PAIRS // len(self.words[0]))
        for i in range(0, len(a), width):
            x, y = a[i:i + width], b[i:i + width]
            left, right = [asked[k] for k in x.tolist()], [self.words[k] for k in y.tolist()]
            ok = one_edit(left, right)
            ok &= ~same_cell[x] | np.fromiter((u < w for u, w in zip(left, right, strict=True)), bool, len(left))
            found_q.append(x[ok])
            found_w.append(y[ok])


def _cells(trees: dict[int, Node]):
    """Each word as a member of its cell and as a query of those that can hold near words."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, lengths = np.array(batch["word"].to_pylist(), object), batch["length"].to_numpy()
            rows, length, cell, asks, own = [], [], [], [], []

            def add(at: np.ndarray, of: int, to: np.ndarray, kind: bool, same: np.ndarray) -> None:
                rows.append(at)
                length.append(np.full(len(at), of))
                cell.append(to)
                asks.append(np.full(len(at), kind))
                own.append(same)

            for n in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == n)
                v, none = vectors(found[at].tolist()), np.zeros(len(at), np.int64)
                here = places(trees[n], v) if n in trees else none
                add(at, n, here, False, none > 0)
                k, to = reached(trees[n], v, 1) if n in trees else (np.arange(len(at)), none)
                k, to = k[to >= here[k]], to[to >= here[k]]
                add(at[k], n, to, True, to == here[k])
                k, to = reached(trees[n + 1], v, 0) if n + 1 in trees else (np.arange(len(at)), none)
                add(at[k], n + 1, to, True, np.zeros(len(k), bool))
            if rows:
                at = pa.array(np.concatenate(rows))
                yield pa.record_batch({"word": batch["word"].take(at), "n": batch["n"].take(at), "length": pa.array(np.concatenate(length), pa.int32()),
                                       "cell": pa.array(np.concatenate(cell), pa.int32()), "asks": pa.array(np.concatenate(asks)), "own": pa.array(np.concatenate(own))})

    return place


LINKS = "word string, n_near long, minus long, form string"


def _search(rows: pa.Table) -> pa.Table:
    """Of a cell's piece: each word with near ones in it, how many, and the best."""
    asks = rows["asks"].combine_chunks()
    members, queries = rows.filter(pc.invert(asks)), rows.filter(asks)
    out: dict[str, list] = {}
    if len(members) and len(queries):
        cell, n = Cell(members["word"].to_pylist()), members["n"].to_pylist()
        lengths = pc.utf8_length(queries["word"])
        for length in pc.unique(lengths):
            part = queries.filter(pc.equal(lengths, length))
            asked, asked_n = part["word"].to_pylist(), part["n"].to_pylist()
            for i, k in zip(*(x.tolist() for x in cell.near(asked, part["own"].to_numpy())), strict=True):
                for word, other, count in ((asked[i], cell.words[k], n[k]), (cell.words[k], asked[i], asked_n[i])):
                    best = (-count, other)
                    known = out.get(word)
                    if known is None:
                        out[word] = [1, best]
                    else:
                        known[0] += 1
                        known[1] = min(known[1], best)
    return pa.table({"word": pa.array(list(out), pa.string()), "n_near": pa.array([k for k, _ in out.values()], pa.int64()),
                     "minus": pa.array([m for _, (m, _) in out.values()], pa.int64()), "form": pa.array([f for _, (_, f) in out.values()], pa.string())})


def _trees(sized: DataFrame, cell: int, sample: int) -> dict[int, Node]:
    """A tree for each length with more than a cell of words, from a sample of at most ``sample`` words."""
    counts = {r["length"]: r["k"] for r in sized.groupBy("length").agg(F.count("*").alias("k")).filter(F.col("k") > cell).collect()}
    if not counts:
        return {}
    rate = min(1.0, sample / 2 / sum(counts.values()))
    draw = F.pmod(F.xxhash64(F.lit(41), "word"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = sized.withColumn("draw", draw).filter(F.col("draw") < rate).filter(F.col("length").isin(list(counts)))
    by_length: dict[int, list[str]] = {}
    for r in drawn.orderBy("draw", "word").limit(sample).select("length", "word").collect():
        by_length.setdefault(r["length"], []).append(r["word"])
    return {n: fit(vectors(found), counts[n] / len(found), cell) for n, found in by_length.items()}


def near_words(found: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """word, n_near, best (minus: its n negated, form) for each of ``found`` (word, n: distinct words) with near words among them."""
    sized = found.select("word", "n", F.length("word").alias("length"))
    trees = _trees(sized, cell, sample)
    placed = written(sized.mapInArrow(_cells(trees), "word string, n long, length int, cell int, asks boolean, own boolean"), "variants-cells")
    members, queries = F.count(F.when(~F.col("asks"), 1)), F.count(F.when(F.col("asks"), 1))
    pieces = placed.groupBy("length", "cell").agg(
        F.ceil(members / (2 * cell)).cast("int").alias("of_members"), F.ceil(queries / (16 * cell)).cast("int").alias("of_queries")).filter(
        "of_members > 0 AND of_queries > 0")  # a cell without members or queries has no pairs
    own = F.pmod(F.xxhash64(F.lit(43), "word"), F.when(F.col("asks"), F.col("of_queries")).otherwise(F.col("of_members"))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("asks"), F.col("of_members")).otherwise(F.col("of_queries")) - 1))
    dealt = placed.join(pieces, ["length", "cell"]).select("*", own.alias("mine"), other.alias("met")).select(
        "word", "n", "length", "cell", "asks", "own",
        F.when(F.col("asks"), F.col("met")).otherwise(F.col("mine")).alias("member_piece"),
        F.when(F.col("asks"), F.col("mine")).otherwise(F.col("met")).alias("query_piece"))
    links = dealt.groupBy("length", "cell", "member_piece", "query_piece").applyInArrow(_search, LINKS)
    return links.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("minus", "form")).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root for ``forms`` (word, form): the end of each word's chain, by doubling; counts grow along a chain, so rounds are few."""
    hops = written(forms.select("word", F.col("form").alias("root")), "variants-hops")
    while True:
        ahead = hops.select(F.col("word").alias("__word"), F.col("root").alias("__next"))
        moved = written(hops.join(ahead, hops["root"] == ahead["__word"], "left").select(
            "word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("moved")), "variants-hops")
        hops = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return hops


def group(found: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """word, form, root, n, n_near, form_n for ``found`` (word, n)."""
    base = written(found, "variants-words")
    near = near_words(base, cell, sample)
    strong = -F.col("best.minus") >= 2 * F.col("n")
    known = written(base.join(near.withColumnRenamed("word", "__word"), base["word"] == F.col("__word"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(strong, F.col("best.form")).alias("form"),
        F.when(strong, -F.col("best.minus")).alias("form_n")), "variants-forms")
    ends = roots(known.filter("form IS NOT NULL")).select(F.col("word").alias("__word"), "root")
    return known.join(ends, known["word"] == ends["__word"], "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """The variants among all words of all documents."""
    return group(words(docs))


def oracle() -> str:
    bit = "CASE WHEN (xor(c, b) & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"""
        WITH RECURSIVE runs AS (
          SELECT coalesce(doc_id::VARCHAR, '') AS d, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
        seen AS (SELECT d, w, count(*) AS k, hex(encode(d || ':' || w)) AS x FROM runs GROUP BY d, w),
        hashed AS (
          SELECT w, k, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(x) + 1, 2),
                   lambda i: list_transform(range(0, 8), lambda s:
                     ((16 * (strpos('0123456789ABCDEF', substr(x, i, 1)) - 1) + strpos('0123456789ABCDEF', substr(x, i + 1, 1)) - 1) >> s)::BIGINT & 1)))),
                   lambda c, b: {bit}), 4294967295) AS h FROM seen),
        kept AS (SELECT CASE WHEN h % {DROP_ONE_IN} = 0 THEN substr(w, 1, (h % length(w))::BIGINT) || substr(w, (h % length(w))::BIGINT + 2) ELSE w END AS word, k FROM hashed),
        words AS (SELECT word, sum(k)::BIGINT AS n FROM kept WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(k) >= {MIN_COUNT}),
        cuts AS (
          SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
          FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
        one AS (
          SELECT a.word AS u, b.word AS v FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
          UNION SELECT word, rest FROM cuts WHERE rest IN (SELECT word FROM words)
          UNION SELECT rest, word FROM cuts WHERE rest IN (SELECT word FROM words)),
        near AS (
          SELECT u AS word, count(*) AS n_near, max(n) AS most, arg_min(v, row(-n, encode(v))) AS best FROM one JOIN words ON words.word = v GROUP BY u),
        forms AS (
          SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * n THEN best END AS form, CASE WHEN most >= 2 * n THEN most END AS form_n
          FROM words w LEFT JOIN near ON near.word = w.word),
        chain AS (
          SELECT word, word AS root FROM forms
          UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL)
        SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
        FROM forms f JOIN chain c ON c.word = f.word JOIN forms e ON e.word = c.root WHERE e.form IS NULL
    """

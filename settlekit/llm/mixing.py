"""Mixing sources to target weights with soft domain membership.

A classifier learned from a labelled table gives every document a posterior over
the domains. Document rates r >= 0 are then fitted so that the expected tokens of
each domain, sum of tokens * p(domain) * r, meet their targets in the least-squares
sense, by projected gradients in the lazy form: a vector s with a number per domain
gathers the gradient steps, scaled by the Gram matrix of the documents whose rate is
not at a bound, and the rates are the projection r = clip(1 + p . s). A round tries
several lengths of the next step in one aggregation; only domain totals reach the
driver. A weak pull towards r = 1, made weaker until it no longer matters, keeps the
solution unique. A rate depends on the posterior alone, so documents with one
posterior count as one row; posteriors are whole multiples of 1/GRID, so their number
is bounded however many documents there are. Rates become copies by a draw that
depends on the id alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, written
from .quality import HALF, QualityModel, _mixed, calibrate, dual_coordinate_descent, log_count_ratios, shape_of

#: Labelled rows of each domain that the classifier is fitted on, and how many of them calibrate it (one in so many).
SAMPLE_ROWS, CALIBRATE_EVERY = 1_000, 4
SHAPE_ORDER = 3
#: Added to the shape (below 128) of a word that repeats the one before.
REPEATED = 128
#: Marks around a word that do not belong to it; words that a task remembers.
MARKED = ".,;:!?\"'()*#$%&|-"
REMEMBERED = 300_000
#: Posteriors are multiples of one over this.
GRID = 4096
#: Rounds at most (a guard; it takes some ten to forty), and the rest of the gradient, as a share of all tokens, that ends them.
ROUNDS, TOLERANCE = 200, 1e-8
#: Lengths of a step that a round tries, and the pulls towards 1, as a share of the largest eigenvalue of the Gram matrix.
LENGTHS, PULLS = tuple(2.0**-i for i in range(0, 24, 2)), (1e-2, 1e-4, 1e-6, 1e-8, 1e-10)

#: Domains of the labels table and their share of the tokens.
TARGETS = {"good": 0.94, "poor": 0.04, "toxic": 0.02}


class _Words(dict):
    """Number of a word in this task, by which its hash and its shape are looked up."""

    def __init__(self) -> None:
        super().__init__()
        self.hashes, self.shapes = np.empty(1 << 16, np.int32), np.empty(1 << 16, np.int32)

    def __missing__(self, word: str) -> int:
        number = len(self)
        if number == len(self.hashes):
            self.hashes, self.shapes = np.resize(self.hashes, 2 * number), np.resize(self.shapes, 2 * number)
        core = word.strip(MARKED).lower().encode()
        self.hashes[number] = zlib.crc32(core) % HALF
        self.shapes[number] = shape_of(word)
        self[word] = number
        return number


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


class WordFeatures:
    """Indicators of hashed words and of n-grams of word shapes, for one task."""

    def __init__(self) -> None:
        self.words = _Words()

    def of(self, text: str | None) -> tuple[np.ndarray, int]:
        """Distinct feature numbers of the whole text, and its words at white space (its tokens)."""
        words = (text or "").split()
        if not words:
            return np.empty(0, np.int64), 0
        if len(self.words) > REMEMBERED:
            self.words = _Words()
        number = np.fromiter(map(self.words.__getitem__, words), np.int32, len(words))
        shape = self.words.shapes[number]
        shape[1:][number[1:] == number[:-1]] += REPEATED
        found = [distinct(self.words.hashes[number]).astype(np.int64)]
        code = np.zeros(len(words), np.int32)
        for n in range(1, SHAPE_ORDER + 1):
            if len(words) < n:
                break
            code = (code[:len(words) - n + 1] << 8) + shape[n - 1:]
            found.append(distinct(_mixed(distinct(code).astype(np.uint64) + np.uint64(n << 24))) + HALF)
        return distinct(np.concatenate(found)), len(words)


def on_grid(p: np.ndarray) -> np.ndarray:
    """The nearest multiples of 1/GRID that sum to 1: the largest remainders are rounded up."""
    whole = np.floor(p * GRID)
    up = np.argsort(-(p * GRID - whole), kind="stable")[:int(round(GRID - whole.sum()))]
    whole[up] += 1
    return whole / GRID


@dataclass
class DomainModel:
    """One calibrated linear model per domain, in the order of ``domains``; without models the posterior is uniform."""

    domains: list[str]
    models: list[QualityModel]
    #: Domains with labelled rows.
    seen: frozenset[str] = frozenset()

    def posterior(self, features: np.ndarray) -> np.ndarray:
        if not self.models:
            return np.full(len(self.domains), 1.0 / len(self.domains))
        p = np.array([m.score(features) for m in self.models])
        return on_grid(p / p.sum())  # scores are never 0


def train(docs: DataFrame, labelled: DataFrame, domains: list[str]) -> DomainModel:
    """Fit on a bounded sample (``SAMPLE_ROWS`` of each domain) of the labelled rows (doc_id, domain).

    Rows without an id or of another domain are left out; a domain without rows gets a posterior near 0.
    """
    spark = docs.sparkSession
    usable = labelled.filter(F.col("domain").isin(domains) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("key"), "domain")
    sample, counts = bounded_sample(usable, "domain", "key", SAMPLE_ROWS)
    if not sample:
        return DomainModel(domains, [])
    chosen = F.broadcast(spark.createDataFrame(sorted({(r["key"], r["domain"]) for r in sample}), "key long, domain string"))  # bounded by the sample

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = WordFeatures()
        for batch in batches:
            rows = [features.of(t.as_py())[0].astype(np.int32) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.int32()))], ["key", "domain", "features"])

    # an id that repeats without bound adds no more rows than a sample has; which ones stay is set by their texts
    joined = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("key")).select("key", "domain", "text")
    found = (joined.orderBy(F.xxhash64("key", "text"), "domain").limit(3 * SAMPLE_ROWS * len(domains)).mapInArrow(extract, "key long, domain string, features array<int>").toArrow())
    order = np.argsort(found["key"].to_numpy(), kind="stable")  # rows of one key are in the order of their hashes
    lists = found["features"].combine_chunks()
    rows = [lists[int(i)].values.to_numpy().astype(np.int64) for i in order]
    names = np.array(found["domain"].to_pylist(), object)[order] if len(order) else np.empty(0, object)
    held = np.arange(len(rows)) % CALIBRATE_EVERY == 0
    total, models = sum(counts.values()), []
    for d in domains:
        y = names == d
        share = counts.get(d, 0) / total
        if not y[held].any() or y[held].all() or not y[~held].any() or y[~held].all():
            share = min(max(share, 1e-6), 1 - 1e-6)
            models.append(QualityModel(np.zeros(2 * HALF), np.zeros(2 * HALF), 0.0, 1.0, float(np.log(share / (1 - share)))))
            continue
        part = [r for r, h in zip(rows, held, strict=True) if not h]
        ratio = log_count_ratios(part, y[~held])
        w, bias = dual_coordinate_descent(part, y[~held], ratio)
        model = QualityModel(w * ratio, ratio, bias, 1.0, 0.0)
        margins = np.array([model.margin(r) for r, h in zip(rows, held, strict=True) if h])
        model.slope, model.offset = calibrate(margins, y[held], (1 - share, share))
        models.append(model)
    return DomainModel(domains, models, frozenset(counts))


def posteriors(docs: DataFrame, model: DomainModel) -> DataFrame:
    """doc_id, digest (MD5 of the text), tokens, posterior (one number per domain) of every whole text; a text without words has no tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = WordFeatures()
        for batch in batches:
            tokens, p = [], []
            for text in batch.column(2):
                x, n = features.of(text.as_py())
                tokens.append(n)
                p.append(model.posterior(x))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tokens, pa.int64()), pa.array(p, pa.list_(pa.float64()))],
                                             ["doc_id", "digest", "tokens", "posterior"])

    return docs.select("doc_id", text_digest().alias("digest"), "text").mapInArrow(run, "doc_id long, digest string, tokens long, posterior array<double>")


def text_digest() -> Column:
    return F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))


def rate(steps: list[list[float]], most: float | None = None) -> Column:
    """The rate after these steps: r + p . step, kept within [0, ``most``], one after another, from 1."""
    if not steps:
        return F.lit(1.0)
    dot = lambda s: F.aggregate(F.zip_with("posterior", s, lambda p, q: p * q), F.lit(0.0), lambda a, x: a + x)
    within = lambda r: F.greatest(F.lit(0.0), r) if most is None else F.least(F.lit(float(most)), F.greatest(F.lit(0.0), r))
    return F.aggregate(F.array(*(F.array(*map(F.lit, s)) for s in steps)), F.lit(1.0), lambda r, s: within(r + dot(s)))


def fit_rates(members: DataFrame, shares: list[float], total: float | None = None, most: float | None = None, keep: int | None = None) -> list[list[float]]:
    """The step (none, if all rates stay 1) for ``posteriors`` rows, towards ``shares`` (they are normalised) of ``total`` tokens.

    ``total`` defaults to the most tokens that need no domain beyond what there is of it, ``most`` bounds the
    rates. Targets that cannot be met are met as nearly as can be, in the least-squares sense. With ``keep``, a place
    in ``shares``, the total is that of which this domain's tokens are its share, and the other shares are ceilings:
    a domain with fewer tokens stays as it is.
    """
    return fit(members, shares, total, most, keep).steps


@dataclass
class Fit:
    """The steps; the target and the expected tokens of each domain; how many aggregations it took; whether they ended at the optimum."""

    steps: list[list[float]]
    target: list[float]
    expected: list[float]
    rounds: int
    settled: bool


def _tried(batches: Iterator[pa.RecordBatch], tries: np.ndarray, high: float) -> Iterator[pa.RecordBatch]:
    """Per try s: domain tokens at the rates clip(1 + p . s), the Gram matrix of the rows between the bounds, and the tokens' sum of the
    rate's integral (whose gradient in s the domain tokens are)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        p = batch.column(0).values.to_numpy().reshape(-1, tries.shape[1])
        t = batch.column(1).to_numpy().astype(float)
        out = []
        for s in tries:
            u = 1.0 + p @ s
            r = np.clip(u, 0.0, high)
            area = np.where(u > high, high * u - high * high / 2, r * r / 2) if np.isfinite(high) else r * r / 2
            out += [p.T @ (t * r), ((p * (t * ((u >= 0) & (u <= high)))[:, None]).T @ p).ravel(), [float(t @ area)]]
        flat = np.concatenate(out)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["place", "value"])


def fit(members: DataFrame, shares: list[float], total: float | None = None, most: float | None = None, keep: int | None = None) -> Fit:
    """``fit_rates`` with what it reached."""
    k = len(shares)
    want = np.asarray(shares, float) / sum(shares)
    high = np.inf if most is None else float(most)
    cells = written(members.groupBy("posterior").agg(F.sum("tokens").alias("tokens")).filter("tokens > 0"), "mixing-cells")
    width, rounds = k + k * k + 1, 0

    def totals(tries: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
        nonlocal rounds
        rounds += 1
        parts = cells.mapInArrow(partial(_tried, tries=np.array(tries), high=high), "place int, value double")
        flat = np.zeros(len(tries) * width)
        for r in parts.groupBy("place").agg(F.sum("value").alias("sum")).collect():  # a number per try and place
            flat[r["place"]] = r["sum"]
        flat = flat.reshape(len(tries), width)
        return [(f[:k], f[k:-1].reshape(k, k), float(f[-1])) for f in flat]

    s = np.zeros(k)
    ((have, gram, area),) = totals([s])
    if not have.sum():
        return Fit([], [0.0] * k, [0.0] * k, rounds, True)
    if keep is not None:
        total = float(have[keep] / want[keep])
    elif total is None:
        total = float(min(have[i] / want[i] for i in range(k) if want[i] > 0))
    target = want * total if keep is None else np.minimum(want * total, have)
    enough, largest = TOLERANCE * max(total, 1.0), float(np.linalg.eigvalsh(gram)[-1])
    settled = bool(np.abs(have - target).max() <= enough)
    for pull in () if settled else PULLS:
        pull *= largest
        settled = False
        while rounds < ROUNDS:
            slope = have - target + pull * s
            if np.abs(slope).max() <= enough:
                settled = True
                break
            step = -np.linalg.solve(gram + pull * np.eye(k), slope)
            tries = [s + a * step for a in LENGTHS]
            found = totals(tries)
            value = [f[2] - target @ x + pull / 2 * x @ x for x, f in zip(tries, found, strict=True)]
            best = int(np.argmin(value))
            if value[best] >= area - target @ s + pull / 2 * s @ s:
                settled = True  # no length gains: the rest is rounding
                break
            s, (have, gram, area) = tries[best], found[best]
        if np.abs(have - target).max() <= enough:
            break
    return Fit([s.tolist()] if s.any() else [], target.tolist(), have.tolist(), rounds, settled)


def copies(rate_col: str = "rate", key: str = "doc_id") -> Column:
    """Whole copies for a rate: its floor, and one more with the rest as probability, by a draw from the id."""
    draw = F.pmod(F.xxhash64(F.lit(31), F.col(key)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return (F.floor(rate_col) + (draw < F.col(rate_col) - F.floor(rate_col)).cast("int")).cast("int")


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] = TARGETS, total: float | None = None, most: float | None = None,
        keep: str | None = None) -> DataFrame:
    """doc_id, digest, tokens, posterior, rate, copies of every document: one row per input row.

    A document without an id has no draw and stays once. Repeated rows get the same rate and copies. An
    empty table gives no rows; without labels every posterior is uniform. ``fit`` gives the tokens that each
    domain comes to. With ``keep``, this domain's tokens set
    the total and the others' shares are ceilings; without a label of it nothing tells it apart, and every rate
    is 1. Only doc_id and text are read.
    """
    domains = sorted(targets)
    model = train(docs, labelled, domains)
    members = posteriors(docs, model).checkpoint()
    steps = fit_rates(members, [targets[d] for d in domains], total, most, None if keep is None else domains.index(keep)) if keep is None or keep in model.seen else []
    return members.withColumn("rate", rate(steps, most)).withColumn("copies", F.when(F.col("doc_id").isNull(), 1).otherwise(copies()))


def keep_mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] = TARGETS, total: float | None = None, most: float | None = None,
               keep: str | None = None) -> DataFrame:
    """The rows of ``docs`` (all their columns), each as often as its copies: those of its id and text."""
    changed = mix(docs, labelled, targets, total, most, keep).filter("copies <> 1").select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__text"), F.col("copies").alias("__copies")).distinct()
    dealt = docs.join(changed, (docs["doc_id"] == changed["__id"]) & (text_digest() == changed["__text"]), "left").withColumn(
        "__copies", F.coalesce("__copies", F.lit(1)))
    return dealt.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.col("__copies")))).filter("__copy > 0").select(docs.columns)


def label_domains(labels: DataFrame) -> DataFrame:
    """doc_id, domain of the labels table: toxic, else good or poor by quality; rows without both labels are left out."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").otherwise("poor")
    return labels.filter("quality IS NOT NULL AND toxic IS NOT NULL").select("doc_id", domain.alias("domain"))

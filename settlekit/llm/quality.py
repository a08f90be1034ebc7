"""Quality classifier: Naive Bayes support vectors.

A text's features are indicators of hashed n-grams: byte n-grams, and n-grams of
word shapes (case, digits, marks, whether a word repeats the one before). Each
indicator is scaled by its class log-count ratio, rows are brought to unit length,
and a linear hinge-loss model is fitted by dual coordinate descent. Margins of a
held-back part of the sample calibrate the score.

The model is fitted on the driver from a bounded sample of the labelled rows
(``SAMPLE_ROWS`` of each class); every whole text is scored in one pass without a
shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, crc_bucket

#: Labelled rows of each class that the model is fitted on.
SAMPLE_ROWS = 2_000
#: Hashed features: the first half holds byte n-grams, the second shape n-grams.
HALF = 1 << 17
BYTE_ORDERS = (1, 2, 3)
SHAPE_ORDERS = (1, 2, 3)
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 30
#: Rows of the sample that calibrate the score: one in so many.
CALIBRATE_EVERY = 4
THRESHOLD = 0.3

MARKS = re.compile(r"[^\w\s]+\Z")


def shape_of(word: str) -> int:
    """Number below 128 for a word's case, the marks at its end and its length."""
    core = word if word[-1].isalnum() else MARKS.sub("", word)
    case = 2 if core.islower() else 0 if not core else 1 if core.isdigit() else 3 if core.isupper() and len(core) > 1 else 4 if core.istitle() else 5
    marks = len(word) - len(core)
    tail = 0 if not marks else 1 if word[-1] in ".,;:?" and marks == 1 else 2 + min(marks - 1, 2)
    size = 0 if len(core) < 4 else 1 if len(core) < 13 else 2 if len(core) < 30 else 3
    return 1 + case + 6 * tail + 30 * size


class _Shapes(dict):
    """Shape of a word; a word is looked at once per task and piece of memory."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        shape = self[word] = shape_of(word)
        return shape


def _mixed(grams: np.ndarray) -> np.ndarray:
    """Hash of n-gram codes to [0, HALF)."""
    return ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(47)).astype(np.int64)


class Features:
    """Feature numbers of texts, for one task."""

    def __init__(self) -> None:
        self.shapes = _Shapes()

    def of(self, text: str) -> np.ndarray:
        """Sorted distinct feature numbers of the whole text; none for an empty one."""
        seen = np.zeros(2 * HALF, bool) if len(text) > HALF else None
        found: list[np.ndarray] = []
        raw = np.frombuffer(text.encode(), np.uint8).astype(np.uint64)
        words = text.split()
        shape = np.fromiter(map(self.shapes.__getitem__, words), np.uint64, len(words))
        if len(words) > 1:
            same = np.fromiter(map(str.__eq__, words[1:], words[:-1]), bool, len(words) - 1)
            shape[1:][same] += np.uint64(128)
        for series, orders, base in ((raw, BYTE_ORDERS, 0), (shape, SHAPE_ORDERS, HALF)):
            for n in orders:
                if len(series) < n:
                    continue
                code = np.full(len(series) - n + 1, n, np.uint64)
                for i in range(n):
                    code = code * np.uint64(257) + series[i:len(series) - n + 1 + i]
                number = _mixed(code) + base
                if seen is None:
                    found.append(number)
                else:
                    seen[number] = True
        if seen is not None:
            return np.flatnonzero(seen)
        return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)


@dataclass
class QualityModel:
    """Weight of each feature (already scaled by its ratio), the ratios, bias, and calibration of the margin."""

    weight: np.ndarray
    ratio: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, features: np.ndarray) -> float:
        length = float(np.sqrt((self.ratio[features] ** 2).sum()))
        return (float(self.weight[features].sum()) / length if length else 0.0) + self.bias

    def score(self, features: np.ndarray) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * self.margin(features) + self.offset, -30, 30))))


def log_count_ratios(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """log of (smoothed share of the feature in class 1 / in class 0)."""
    p, q = np.full(2 * HALF, SMOOTHING), np.full(2 * HALF, SMOOTHING)
    for features, y in zip(rows, good, strict=True):
        (p if y else q)[features] += 1
    return np.log((p / p.sum()) / (q / q.sum()))


def dual_coordinate_descent(rows: list[np.ndarray], good: np.ndarray, ratio: np.ndarray, cost: float = COST, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and bias of min |w|^2 / 2 + cost * sum of hinge losses, over unit rows of ratio-scaled indicators."""
    w, bias, alpha = np.zeros(len(ratio)), 0.0, np.zeros(len(rows))
    values = [ratio[f] / max(1e-12, np.sqrt((ratio[f] ** 2).sum())) for f in rows]
    y = np.where(good, 1.0, -1.0)
    norm = np.array([float((v**2).sum()) + 1.0 for v in values])  # the bias is a feature that is always 1
    rng = np.random.default_rng(5)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            gradient = y[i] * (float(w[rows[i]] @ values[i]) + bias) - 1.0
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cost)
            if (step := new - alpha[i]) != 0.0:
                alpha[i] = new
                w[rows[i]] += step * y[i] * values[i]
                bias += step * y[i]
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, bias


def calibrate(margins: np.ndarray, good: np.ndarray, shares: tuple[float, float]) -> tuple[float, float]:
    """Slope and offset of the logistic curve through the margins, for classes that occur with these shares."""
    weight = np.where(good, shares[1] / max(1, good.sum()), shares[0] / max(1, (~good).sum()))
    weight = weight / weight.sum()
    a, b, y = 1.0, 0.0, good.astype(float)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g = np.array([(weight * (p - y) * margins).sum() + 1e-4 * a, (weight * (p - y)).sum()])
        h = weight * p * (1 - p)
        hess = np.array([[(h * margins**2).sum() + 1e-4, (h * margins).sum()], [(h * margins).sum(), h.sum() + 1e-9]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, g)
        step *= min(1.0, 4.0 / max(1e-12, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(max(a, 1e-3)), float(b)


def fit(rows: list[np.ndarray], good: np.ndarray, shares: tuple[float, float]) -> QualityModel:
    """The model of labelled feature rows; with one class only, a constant score near its share."""
    total = sum(shares)
    if not len(rows) or good.all() or not good.any():
        share = 0.5 if not total else (shares[1] + 0.5) / (total + 1)
        return QualityModel(np.zeros(2 * HALF), np.zeros(2 * HALF), 0.0, 1.0, float(np.log(share / (1 - share))))
    held = np.arange(len(rows)) % CALIBRATE_EVERY == 0
    part = [r for r, h in zip(rows, held, strict=True) if not h]
    if good[~held].all() or not good[~held].any() or good[held].all() or not good[held].any():
        part, held = rows, np.ones(len(rows), bool)
        ratio = log_count_ratios(part, good)
        w, bias = dual_coordinate_descent(part, good, ratio)
    else:
        ratio = log_count_ratios(part, good[~held])
        w, bias = dual_coordinate_descent(part, good[~held], ratio)
    model = QualityModel(w * ratio, ratio, bias, 1.0, 0.0)
    margins = np.array([model.margin(r) for r, h in zip(rows, held, strict=True) if h])
    model.slope, model.offset = calibrate(margins, good[held], shares)
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> QualityModel:
    """Fit on a bounded sample of the labelled documents of the training fold (crc32 of the id, mod 5, not 0).

    Labels other than 0 and 1 and null ids are left out; without labels the score is 0.5.
    """
    spark = docs.sparkSession
    usable = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (crc_bucket("doc_id", 5) != 0)).select(
        F.col("doc_id").alias("key"), F.col(label).cast("int").alias("y"))
    sample, counts = bounded_sample(usable, "y", "key", SAMPLE_ROWS)
    if not sample:
        return fit([], np.empty(0, bool), (0, 0))
    chosen = F.broadcast(spark.createDataFrame(sorted({(r["key"], r["y"]) for r in sample}), "key long, y int"))  # bounded by the sample

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            rows = [features.of(t or "").astype(np.int32) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.int32()))], ["key", "y", "features"])

    found = (docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("key")).select("key", "y", "text").limit(6 * SAMPLE_ROWS)
             .mapInArrow(extract, "key long, y int, features array<int>").toArrow())
    order = np.argsort(found["key"].to_numpy(), kind="stable")
    lists = found["features"].combine_chunks()
    rows = [lists[int(i)].values.to_numpy().astype(np.int64) for i in order]
    return fit(rows, found["y"].to_numpy()[order] == 1, (counts.get(0, 0), counts.get(1, 0)))


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, score, predicted of every whole text (null: empty), one row per input row.

    Higher means label 1 is likelier; ``predicted`` is 1 from ``THRESHOLD`` on. An empty text gets the
    score of the bias alone. Only doc_id and text are read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            s = np.array([model.score(features.of(t.as_py() or "")) for t in batch.column(1)], float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], ["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, predicted int")

"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

Texts are lower-cased; n-grams of 3 to 5 characters are hashed to 2 ** BITS features. From a bounded labelled sample
come, for each feature, the log ratio of its smoothed document counts in the two classes and, for the features whose
document shares clearly differ, logistic weights on (count over the root of the text's n-gram number) x (ratio). A
text's score is the sum of these products, mapped by a logistic curve that has the value `cut` where balanced
accuracy on the sample's calibration part is best. Every text is scored whole, in one pass without a shuffle.

Defined cases: null and empty texts, and texts of fewer than 3 characters, get the score of the sum 0; without both
labels in the sample every score is 0; ids, repeated rows and other columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._arrow import slices, text_bytes
from ._learn import best_cut, held_out, sigmoid, training_sample
from ._spark import small_batches

BITS = 18
SIZES = (3, 4, 5)
#: The bound of the sample, and how clearly (in standard errors) a feature's shares must differ to get a weight.
PER_CLASS, LEAST_Z = 3000, 4.5
#: Characters scored at once.
CHARS = 1 << 16
_A = np.random.default_rng(20240609).integers(0, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = np.uint64(0x9E3779B97F4A7C15)


def _codes(texts: list[str | None]):
    """Characters of lower-cased texts in one array, where each text begins, and how long it is."""
    low = [(t or "").lower() for t in texts]
    n = np.array([len(t) for t in low])
    begin = np.concatenate(([0], np.cumsum(n + 1)))[:-1]
    return np.frombuffer("\0".join([*low, "\0" * 8]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64), begin, n


def _features(codes: np.ndarray):
    """For each n-gram size, the feature of the n-gram at each position."""
    h = np.zeros(len(codes), np.uint64)
    for k in range(SIZES[-1]):
        h = h[: len(codes) - k] + codes[k:] * _A[k]
        if k + 1 in SIZES:
            x = h ^ (h >> np.uint64(29))
            yield k + 1, (x * _B >> np.uint64(64 - BITS)).astype(np.int64)


def _runs(texts: list):
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size < CHARS):
            size += len(texts[j] or "")
            j += 1
        yield i, j
        i = j


def weigh(texts: list[str | None], weights: np.ndarray) -> np.ndarray:
    """For each text the sum of its n-grams' weights over the root of their number."""
    out = np.zeros(len(texts))
    for i, j in _runs(texts):
        codes, begin, n = _codes(texts[i:j])
        total, count = np.zeros(j - i), np.zeros(j - i)
        for size, f in _features(codes):
            run = np.concatenate(([0.0], np.cumsum(weights[f], dtype=np.float64)))
            many = np.maximum(n - size + 1, 0)
            total += run[begin + many] - run[begin]
            count += many
        out[i:j] = total / np.sqrt(np.maximum(count, 1))
    return out


def _counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features of one text, with their numbers over the root of the number of its n-grams."""
    codes, _, n = _codes([text])
    f = np.concatenate([x[: max(n[0] - size + 1, 0)] for size, x in _features(codes)])
    found, many = np.unique(f, return_counts=True)
    return found, many / np.sqrt(max(len(f), 1))


class Model:
    def __init__(self, weights: np.ndarray, slope: float, at: float, cut: float):
        self.weights, self.slope, self.at, self.cut = weights, slope, at, cut

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        if self.slope == 0:
            return np.zeros(len(texts))
        return sigmoid(self.slope * (weigh(texts, self.weights) - self.at) + np.log(self.cut / (1 - self.cut)))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", cut: float = 0.3, per_class: int = PER_CLASS, **columns: str) -> Model:
    sample = training_sample(docs, labels, label, per_class, **columns).repartition(6, "h")

    def tally(batches):
        docs_with, sizes = np.zeros((2, 1 << BITS), np.int32), [0, 0]
        for b in batches:
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                docs_with[y][_counts(text)[0]] += 1
                sizes[y] += 1
        yield pa.RecordBatch.from_arrays([pa.array([docs_with.tobytes()], pa.binary()), pa.array([sizes], pa.list_(pa.int64()))], names=["n", "sizes"])

    n, sizes = np.ones((2, 1 << BITS)), np.zeros(2)
    for row in sample.mapInArrow(tally, "n binary, sizes array<long>").toLocalIterator():
        n += np.frombuffer(row[0], np.int32).reshape(2, -1)
        sizes += row[1]
    if (sizes == 0).any():
        return Model(np.zeros(1 << BITS, np.float32), 0, 0, cut)
    ratio = np.log(n[1] / n[1].sum()) - np.log(n[0] / n[0].sum())
    # A feature is used if the shares of documents that have it differ clearly between the classes.
    seen, docs_of = n - 1, sizes
    p, pooled = seen / docs_of[:, None], seen.sum(axis=0) / docs_of.sum()
    z = np.abs(p[1] - p[0]) / np.sqrt(pooled * (1 - pooled) * (1 / docs_of).sum() + 1e-12)
    z[seen.sum(axis=0) < 3] = 0
    chosen = z >= LEAST_Z
    ratio[~chosen] = 0
    spread = docs.sparkSession.sparkContext.broadcast(chosen)

    def extract(batches):
        for b in batches:
            rows = []
            for text in b.column(0).to_pylist():
                f, share = _counts(text)
                keep = spread.value[f]
                rows.append((f[keep].astype(np.int32).tobytes(), share[keep].astype(np.float32).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary()), b.column(1), b.column(2)], names=["f", "v", "y", "h"])

    rows = sorted(sample.mapInArrow(extract, "f binary, v binary, y int, h long").collect(), key=lambda r: (r[3], r[2], r[0]))
    f = np.concatenate([np.frombuffer(r[0], np.int32) for r in rows])
    v = np.concatenate([np.frombuffer(r[1], np.float32) for r in rows]).astype(np.float64) * ratio[f]
    at = np.repeat(np.arange(len(rows)), [len(r[0]) // 4 for r in rows])
    y = np.array([r[2] for r in rows], float)
    fit = np.arange(len(rows)) % 4 > 0  # the others calibrate
    if y[fit].min() == y[fit].max() or y[~fit].min() == y[~fit].max():
        fit[:] = True
    weights = _logistic(f, v, at, y, fit, 1 << BITS)
    score = np.bincount(at, v * weights[f], minlength=len(rows))
    trial = score[~fit] if (~fit).any() else score
    truth = y[~fit] if (~fit).any() else y
    where = best_cut(trial, truth)
    return Model((weights * ratio).astype(np.float32), 4 / max(float(np.std(trial)), 1e-12), where, cut)


def _logistic(f, v, at, y, fit, size, steps: int = 150) -> np.ndarray:
    """Weights near 1 (plain naive Bayes), moved by accelerated descent on the class-balanced logistic loss."""
    n = len(y)
    scale = 1 / max(np.sqrt(np.mean(np.bincount(at, v * v, minlength=n))), 1e-12)
    v = v * scale
    side = np.where(y > 0, 0.5 / max(y[fit].sum(), 1), 0.5 / max((1 - y)[fit].sum(), 1)) * fit
    w, bias, ahead, bias_ahead = np.ones(size), 0.0, np.ones(size), 0.0
    bias = bias_ahead = -float(np.sum(np.bincount(at, v, minlength=n) * side))
    for k in range(steps):
        error = (sigmoid(np.bincount(at, v * ahead[f], minlength=n) + bias_ahead) - y) * side
        grad = np.bincount(f, v * error[at], minlength=size) + 1e-4 * (ahead - 1)
        w_new, b_new = ahead - 2.0 * grad, bias_ahead - 2.0 * error.sum()
        m = k / (k + 3)
        ahead, bias_ahead = w_new + m * (w_new - w), b_new + m * (b_new - bias)
        w, bias = w_new, b_new
    return w


def toxicity(docs: DataFrame, model: Model, cut: float = 0.3, text_col: str = "text") -> DataFrame:
    """`docs` with score (0 to 1) and predicted (1 if score >= cut), which take the place of columns of these names."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        parts = [shared.value(text.slice(i, j - i).to_pylist()) for i, j in slices(text_bytes(text)[0])]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return docs.withColumn("score", score(text_col)).withColumn("predicted", (F.col("score") >= cut).cast("int"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(docs, labels)
    return toxicity(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "score", "predicted")

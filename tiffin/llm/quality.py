"""Quality by Bradley-Terry ranking.

Each document has a few text statistics. All labelled documents that may train give preference pairs, each document
marked good over each marked bad; the logistic loss on the differences of their standardised statistics gives a linear
score, as in the Bradley-Terry model. The pairs are not built: documents whose scores fall into one cell of 0.05 share
their mean score, and a pass over the documents sums each cell's statistics, from which loss and gradient of all pairs
follow. The threshold is the exact quantile of the documents' scores at their share of bad ones; scores are mapped to
0..1 so that the threshold lies at `cut`.

Defined cases: null and empty texts have the statistics 0; without both labels among the documents every score is 1; ids,
repeated rows and other columns do not matter; of rows that share an id the least statistics enter. Every text is scored
whole, in one pass without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.operators.selection import exact_percentiles

from ._arrow import SPACES, Words, slices, text_bytes
from ._learn import first_known, held_out, known_labels, sigmoid
from ._spark import checkpoint, discard, sized, small_batches

CELL, REACH, PASSES, RIDGE = 0.05, 40, 30, 1e-3

_CLASS = np.zeros(256, np.int64)  # 0 other, 1 upper, 2 lower, 3 digit, 4 space, 5 newline, 6 comma or full stop, 7 "!", 8 other ASCII mark, 9 non-ASCII
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[33:48], _CLASS[58:65], _CLASS[91:97], _CLASS[123:127], _CLASS[128:] = 1, 2, 3, 8, 8, 8, 8, 9
_CLASS[32], _CLASS[9], _CLASS[10], _CLASS[44], _CLASS[46], _CLASS[33] = 4, 4, 5, 6, 6, 7
STATISTICS = 2 * 10 + 6


def statistics(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """A row of statistics for each text: shares of byte classes, their roots, repeated words, word lengths."""
    out = np.zeros((len(offsets) - 1, STATISTICS))
    for i, j in slices(offsets):
        w = Words(offsets[i : j + 1], data, SPACES)
        raw = data[offsets[i] : offsets[j]]
        n = np.diff(offsets[i : j + 1])
        row = np.repeat(np.arange(j - i), n)
        share = np.bincount(row * 10 + _CLASS[raw], minlength=10 * (j - i)).reshape(-1, 10) / np.maximum(n, 1)[:, None]
        words = np.diff(w.first)
        of = np.repeat(np.arange(j - i), words)
        size = w.end - w.start
        out[i:j, :10], out[i:j, 10:20] = share, np.sqrt(share)
        for k, lag in enumerate((1, 2, 3)):
            same = (w.hash[lag:] == w.hash[:-lag]) & (of[lag:] == of[:-lag])
            out[i:j, 20 + k] = np.bincount(of[lag:][same], minlength=j - i) / np.maximum(words, 1)
        out[i:j, 23] = np.sqrt(out[i:j, 20])
        out[i:j, 24] = np.bincount(of, size, minlength=j - i) / np.maximum(words, 1) / 10
        out[i:j, 25] = np.bincount(of, size == 1, minlength=j - i) / np.maximum(words, 1)
    return out


class Model:
    def __init__(self, weights: np.ndarray, at: float, slope: float, cut: float):
        self.weights, self.at, self.slope, self.cut = weights, at, slope, cut

    def __call__(self, column: pa.Array) -> np.ndarray:
        if self.slope == 0:
            return np.ones(len(column))
        x = statistics(*text_bytes(column)) @ self.weights
        return sigmoid(self.slope * (x - self.at) + np.log(self.cut / (1 - self.cut)))


def _sums(rows: DataFrame, add) -> dict[int, np.ndarray]:
    """`add` gives (keys, rows of numbers) for statistics and labels of a batch; the sums of the numbers by key."""

    def scan(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            if b.num_rows:
                keys, values = add(b.column(0).flatten().to_numpy().reshape(-1, STATISTICS), b.column(1).to_numpy())
                order = np.argsort(keys, kind="stable")
                found, first = np.unique(keys[order], return_index=True)
                for k, v in zip(found.tolist(), np.add.reduceat(values[order], first), strict=True):
                    held[k] = held[k] + v if k in held else v
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(list(held.values()), pa.list_(pa.float64()))], names=["k", "v"])

    one = rows.mapInArrow(scan, "k long, v array<double>").select("k", F.posexplode("v")).groupBy("k", "pos").agg(F.sum("col").alias("s"))
    made = one.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("pos", "s"))).getField("s").alias("v")).collect()
    return {r["k"]: np.array(r["v"]) for r in made}


def _loss(rows: DataFrame, w: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean logistic loss over all pairs of a good and a bad document, with its gradient, from sums by cell of score."""

    def cells(x, y):
        z = (x - mean) / spread
        score = np.clip(z @ w, -REACH, REACH)
        return np.floor(score / CELL).astype(np.int64) * 2 + y, np.column_stack([np.ones(len(z)), score, z])

    found = _sums(rows, cells)
    good, bad = (np.array([found[k] for k in sorted(found) if k % 2 == y]) for y in (1, 0))
    n, m = good[:, 0].sum(), bad[:, 0].sum()
    d = (good[:, 1] / good[:, 0])[:, None] - (bad[:, 1] / bad[:, 0])[None]
    lost = good[:, 0] / n @ np.logaddexp(0, -d) @ (bad[:, 0] / m)
    wrong = sigmoid(-d)
    grad = (good[:, 0] / n @ wrong) @ bad[:, 2:] / m - (wrong @ (bad[:, 0] / m)) @ good[:, 2:] / n
    return float(lost + RIDGE / 2 * w @ w), grad + RIDGE * w


def _fit(rows: DataFrame, mean: np.ndarray, spread: np.ndarray, curvature: np.ndarray) -> np.ndarray:
    """BFGS from a bound of the curvature; each step is a pass over the documents."""
    w, inverse = np.zeros(STATISTICS), np.linalg.inv(curvature)
    f, g = _loss(rows, w, mean, spread)
    step = 1.0
    for _ in range(PASSES):
        to = w - step * (inverse @ g)
        f1, g1 = _loss(rows, to, mean, spread)
        if f1 > f:
            step /= 4
            continue
        s, y = to - w, g1 - g
        done = f - f1 <= 1e-5 * f
        if (sy := s @ y) > 1e-12:
            left = np.eye(len(w)) - np.outer(s, y) / sy
            inverse = left @ inverse @ left.T + np.outer(s, s) / sy
        w, f, g, step = to, f1, g1, 1.0
        if done:
            break
    return np.round(w, 9)  # sums in another order change later digits


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", cut: float = 0.7, per_class: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model of all labelled documents that are not held out; `per_class` bounds them for each label, if given."""
    small_batches(docs.sparkSession)

    def scan(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(statistics(*text_bytes(b.column(1)))), pa.list_(pa.float64()))], names=["id", "x"])

    known = known_labels(labels, label, id_col).withColumnRenamed(id_col, "id")
    if per_class is not None:
        known = first_known(known, per_class, "id")
    # Statistics before the join: texts are not shuffled, however many labels there are.
    made = docs.where(F.col(id_col).isNotNull() & ~held_out(id_col)).select(id_col, text_col).mapInArrow(scan, f"id {docs.schema[id_col].dataType.simpleString()}, x array<double>")
    rows = checkpoint(made.join(sized(known.select("id", "y")), "id").groupBy("id").agg(F.min("x").alias("x"), F.max("y").cast("int").alias("y")).select("x", "y"))
    wide = STATISTICS + 1
    moments = _sums(rows, lambda x, y: (y.astype(np.int64), np.einsum("ij,ik->ijk", *[np.column_stack([np.ones(len(x)), x])] * 2).reshape(len(x), -1)))
    if len(moments) < 2:
        discard(rows)
        return Model(np.zeros(STATISTICS), 0, 0, cut)
    bad, good = (moments[y].reshape(wide, wide) for y in (0, 1))
    whole = bad + good
    n = whole[0, 0]
    mean = whole[0, 1:] / n
    covariance = whole[1:, 1:] / n - np.outer(mean, mean)
    spread = np.sqrt(np.maximum(np.diag(covariance), 0))
    spread[spread < 1e-6] = np.inf
    scaled = lambda m: m / spread[:, None] / spread[None]
    of = [(m[0, 1:] / m[0, 0], m[1:, 1:] / m[0, 0]) for m in (good, bad)]
    apart = of[0][0] - of[1][0]
    differences = sum(m2 - np.outer(m1, m1) for m1, m2 in of) + np.outer(apart, apart)
    weights = _fit(rows, mean, spread, scaled(differences) / 4 + RIDGE * np.eye(STATISTICS)) / spread

    def score(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(b.column(0).flatten().to_numpy().reshape(-1, STATISTICS) @ weights)], names=["s"])

    # Between the last of as many scores as there are bad documents and the next.
    found = exact_percentiles(checkpoint(rows.mapInArrow(score, "s double")), [], "s", {"at": float((bad[0, 0] - 0.5) / (n - 1))})
    at = float(found.first()["at"])
    discard(rows)
    return Model(weights, at, 4 / max(float(np.sqrt(max(weights @ covariance @ weights, 0))), 1e-12), cut)


def score_quality(docs: DataFrame, model: Model, cut: float = 0.7, text_col: str = "text") -> DataFrame:
    """`docs` with score (0 to 1) and predicted (1 if score >= cut), which take the place of columns of these names."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        return pa.array(shared.value(text))

    return docs.withColumn("score", score(text_col)).withColumn("predicted", (F.col("score") >= cut).cast("int"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(docs, labels)
    return score_quality(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "score", "predicted")

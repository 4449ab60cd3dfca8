"""Hard-negative mining with scores from a residue number system.

Vectors are integers, and every score of an anchor and a row is wanted exactly. Both matrices are reduced modulo a few
small primes, the residues are multiplied as float32 matrices, which is exact as long as a sum of products stays below
2 ** 24, and the signed scores come back by Chinese remaindering (mixed radix). How many primes are needed follows
from the lengths of the vectors in hand (Cauchy-Schwarz).

Anchors are a given share of the rows, taken in groups of a fixed size that are broadcast one after the other; all rows
are scanned in place for each, without a shuffle of vectors. The first scan finds each anchor's best rows of its own
label, the second its best rows of other labels inside the window that each positive opens. A task keeps its best few
of each anchor and gives them out once, at its end, so what is shuffled grows with tasks and anchors, not with scores.

Defined cases: rows without a label, or whose vector is null or has null or non-finite components, take no part, nor
do those whose vector is not as long as that of the smallest id; integer components saturate at 2 ** 22. A null id
counts as the largest and is no anchor. Every row is one of its own: rows that share an id are different rows, all of
them anchors if the id is one, and a copy of an anchor is another row of the same label. Ties of score go to the
smaller id. Anchors without rows of their label, and positives whose window is empty, give no row; a negative positive
score opens no window. Columns of other names are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._spark import checkpoint, discard, small_batches
from ._vectors import dimension, integers, lists, matrix, whole

#: Anchors of one broadcast, and the sides of the tiles in which scores are made.
GROUP, ROWS, ANCHORS = 1 << 13, 1 << 10, 1 << 10
#: Stands for no score and for a null id.
NONE, NO_ID = np.iinfo(np.int64).min, np.iinfo(np.int64).max


@functools.lru_cache(maxsize=8)
def primes_for(dim: int) -> tuple[int, ...]:
    """Primes, the largest first, whose residues' products summed over `dim` terms float32 holds exactly."""
    top = 3
    while dim * ((top + 1) // 2) ** 2 < 1 << 24 and top < 4095:
        top += 2
    return tuple(p for p in range(top, 2, -2) if all(p % q for q in range(3, int(p**0.5) + 1, 2)))[:40]


def residues(x: np.ndarray, prime: int) -> np.ndarray:
    """x modulo a prime, between -(prime - 1) / 2 and (prime - 1) / 2, as float32."""
    half = prime // 2
    return ((x + half) % prime - half).astype(np.float32)


def _length(x: np.ndarray) -> float:
    return float(np.sqrt((x.astype(np.float64) ** 2).sum(1).max(initial=0))) + 1


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two int64 matrices; vectors longer than 4096 are summed in pieces."""
    if a.shape[1] > 4096:
        return scores(a[:, :4096], b[:, :4096]) + scores(a[:, 4096:], b[:, 4096:])
    # A tenth more than twice the bound, so that the last digit alone tells the sign.
    bound, use, product = 2.2 * _length(a) * _length(b) + 2, [], 1
    for p in primes_for(a.shape[1]):
        if product > bound:
            break
        use.append(p)
        product *= p
    digits, scale = [], [1]
    total = np.zeros((len(a), len(b)), np.int64)
    for p in use:
        r = np.rint(residues(a, p) @ residues(b, p).T).astype(np.int64)
        for q, d in zip(scale, digits):  # what the digits so far stand for goes
            r -= (q % p) * d
        r = r * pow(scale[-1], -1, p) % p
        # The last digit may be negative, so that the number lies around 0.
        if p == use[-1]:
            r -= np.where(r > p // 2, p, 0)
        digits.append(r)
        total += scale[-1] * r
        scale.append(scale[-1] * p)
    return total


class _Kept:
    """The k best (score, id) of each of n places, over the tiles of a task."""

    def __init__(self, n: int, k: int):
        self.k, self.score, self.id = k, np.full((n, k), NONE), np.full((n, k), NO_ID)

    def add(self, places: np.ndarray, masked: np.ndarray, ids: np.ndarray) -> None:
        """`masked` has the scores of `places` (rows) with columns in the order of `ids`; NONE is no candidate."""
        most = masked.max(1, initial=NONE)
        some = np.flatnonzero((most > NONE) & (most >= self.score[places, -1]))
        if not len(some):
            return
        masked, places = masked[some], places[some]
        k = min(self.k, masked.shape[1])
        value = np.full((len(some), k), NONE)
        line, at = np.arange(len(some)), np.zeros((len(some), k), np.int64)
        for i in range(k):
            at[:, i] = masked.argmax(1)
            value[:, i] = masked[line, at[:, i]]
            masked[line, at[:, i]] = NONE
        score, name = np.hstack([self.score[places], value]), np.hstack([self.id[places], ids[at]])
        order = np.lexsort((name, -np.maximum(score, NONE + 1)), axis=1)[:, : self.k]
        self.score[places], self.id[places] = np.take_along_axis(score, order, 1), np.take_along_axis(name, order, 1)

    def batch(self) -> pa.RecordBatch:
        place, rank = np.nonzero(self.score > NONE)
        return pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(self.score[place, rank]), pa.array(self.id[place, rank])], names=["place", "score", "id"])


def _scan(rows: DataFrame, dim: int, anchors, k: int, windows) -> DataFrame:
    """Best rows of each place of a task: of an anchor's own label, or, with windows, of other labels inside a window.

    `anchors` and `windows` are broadcast: (row, label, vectors), and (anchor, low, high) sorted by anchor.
    """

    def own(batches):
        row, label, x = anchors.value
        kept = _Kept(len(row), k)
        for ids, names, labels, q in _tiles(batches, dim):
            for value in np.intersect1d(labels, label):
                mine, near = np.flatnonzero(label == value), np.flatnonzero(labels == value)
                for i in range(0, len(mine), ANCHORS):
                    at = mine[i : i + ANCHORS]
                    s = scores(x[at], q[near])
                    s[row[at][:, None] == names[near][None, :]] = NONE
                    kept.add(at, s, ids[near])
        yield kept.batch()

    def other(batches):
        row, label, x = anchors.value
        anchor, low, high = windows.value
        kept = _Kept(len(anchor), k)
        first = np.searchsorted(anchor, np.arange(len(row) + 1))
        for ids, _, labels, q in _tiles(batches, dim):
            for i in range(0, len(row), ANCHORS):
                j = min(i + ANCHORS, len(row))
                s = scores(x[i:j], q)
                s[label[i:j][:, None] == labels[None, :]] = NONE
                for n in range(int(np.diff(first[i : j + 1]).max(initial=0))):  # the n-th window of each anchor
                    place = first[i:j] + n
                    has = np.flatnonzero(place < first[i + 1 : j + 1])
                    place = place[has]
                    t = s[has]
                    t[(t < low[place][:, None]) | (t > high[place][:, None])] = NONE
                    kept.add(place, t, ids)
        yield kept.batch()

    return rows.select("id", "row", "label", "q").mapInArrow(own if windows is None else other, "place int, score long, id long")


def _tiles(batches, dim: int):
    """(ids, rows, labels, vectors) of up to ROWS rows in the order of their ids."""
    for b in batches:
        ids, names, labels = (b.column(c).to_numpy() for c in range(3))
        q = matrix(b.column(3), dim).astype(np.int64)
        order = np.argsort(ids, kind="stable")
        for i in range(0, len(order), ROWS):
            at = order[i : i + ROWS]
            yield ids[at], names[at], labels[at], q[at]


def _first(found: DataFrame, k: int) -> DataFrame:
    """The k best of each place over all tasks, with their rank."""
    w = W.partitionBy("place").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: tuple[int, int] = (50, 100), high: tuple[int, int] = (95, 100), scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `anchor` is a condition on vec_id and label. A negative's score lies between low[0] / low[1] and high[0] / high[1]
    of the positive's, both ends included.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).alias("vec")).where(F.col("label").isNotNull() & whole(F.col("vec")))
    dim = dimension(rows, "vec_id", "vec")
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    if not dim:
        return empty

    def cut(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:4], lists(integers(b.column(4), dim, scale), pa.int32())], names=["id", "row", "label", "anchor", "q"])

    rows = rows.where(F.size("vec") == dim).withColumns({"anchor": F.coalesce(anchor & F.col("vec_id").isNotNull(), F.lit(False)), "row": F.monotonically_increasing_id()})
    rows = checkpoint(rows.select(F.coalesce("vec_id", F.lit(int(NO_ID))).alias("id"), "row", "label", "anchor", "vec").mapInArrow(cut, "id long, row long, label long, anchor boolean, q array<int>"))
    chosen = rows.where("anchor")
    groups = -(-chosen.count() // GROUP)
    if not groups:
        return empty
    chosen = checkpoint(chosen.repartition(groups).withColumn("part", F.spark_partition_id()))
    out = []
    for g in range(groups):
        part = chosen.where(F.col("part") == g).toArrow()  # about GROUP rows
        ids = part["id"].to_numpy()
        mine = (part["row"].to_numpy(), part["label"].to_numpy(), matrix(part["q"].combine_chunks(), dim).astype(np.int64))
        sent = spark.sparkContext.broadcast(mine)
        best = _first(_scan(rows, dim, sent, positives, None), positives).orderBy("place", "rank").toArrow()  # at most `positives` an anchor
        place, score = best["place"].to_numpy(), best["score"].to_numpy()
        windows = (place, -(-score * low[0] // low[1]), score * high[0] // high[1])
        limits = spark.sparkContext.broadcast(windows)
        names = pa.table({"place": pa.array(np.arange(len(place)), pa.int32()), "anchor_id": ids[place], "positive_id": best["id"], "positive_score": score})
        found = _first(_scan(rows, dim, sent, negatives, limits), negatives)
        found = found.join(F.broadcast(spark.createDataFrame(names)), "place")
        known = lambda c: F.when(F.col(c) != int(NO_ID), F.col(c))
        out.append(checkpoint(found.select("anchor_id", known("positive_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), known("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))))
        sent.unpersist()
        limits.unpersist()
    discard(rows, chosen)
    return functools.reduce(DataFrame.union, out)

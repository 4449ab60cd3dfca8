"""Training on a bounded sample of labelled documents."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._spark import checkpoint


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that never train: crc32 of the id as text, modulo 4, is 2. A null id is not held out (nor labelled)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, y) of at most `per_class` documents for each of the labels 0 and 1, the first by a hash of the id.

    A document with several labels counts by the largest; of rows of `docs` that share an id the first text enters. The
    sample is written once, with its texts, so that training does not read `docs` again.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1) & ~held_out(id_col)).groupBy(id_col).agg(F.max(label).alias("y"))
    known = known.withColumn("h", F.xxhash64(id_col))
    picked = known.where("y = 0").orderBy("h", id_col).limit(per_class).union(known.where("y = 1").orderBy("h", id_col).limit(per_class))
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text")).join(F.broadcast(picked.select(id_col, "y", "h")), id_col)
    return checkpoint(rows.groupBy(id_col, "y", "h").agg(F.min("text").alias("text")).select("text", "y", "h"))


def known_labels(labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """(id, y) of all documents with the label 0 or 1 that are not held out; of several labels the largest."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1) & ~held_out(id_col))
    return known.groupBy(id_col).agg(F.max(label).alias("y"))


def first_known(known: DataFrame, per_class: int, id_col: str = "doc_id") -> DataFrame:
    """At most `per_class` rows of known_labels() for each label, the first by a hash of the id."""
    first = lambda y: known.where(F.col("y") == y).orderBy(F.xxhash64(id_col), id_col).limit(per_class)
    return first(0).union(first(1))


def class_sizes(labels: DataFrame, label: str, id_col: str = "doc_id") -> tuple[int, int]:
    """How many documents that are not held out have label 0 and label 1."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1) & ~held_out(id_col)).groupBy(id_col).agg(F.max(label).alias("y"))
    row = known.agg(F.count_if(F.col("y") == 0), F.count_if(F.col("y") == 1)).first()
    return row[0], row[1]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def best_cut(score: np.ndarray, y: np.ndarray) -> float:
    """The midpoint between two neighbouring scores at which balanced accuracy is best."""
    order = np.argsort(score)
    s, y = score[order], y[order].astype(float)
    pos, neg = max(y.sum(), 1), max((1 - y).sum(), 1)
    right = np.concatenate(([0], np.cumsum(1 - y))) / neg + (y.sum() - np.concatenate(([0], np.cumsum(y)))) / pos
    edge = np.concatenate(([s[0] - 1e-6], (s[1:] + s[:-1]) / 2, [s[-1] + 1e-6]))
    right[1:-1][s[1:] == s[:-1]] = -1
    return float(edge[int(np.argmax(right))])

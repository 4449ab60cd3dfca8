"""Exact deduplication by composable polynomial fingerprints.

A text is cut into chunks; every chunk has a polynomial hash, and hash(a + b) = hash(a) + P ** len(a) * hash(b), so
chunk hashes combine by shifts of their lengths, whichever task or thread made them. Two prime moduli and the length
make the fingerprint. Rows with equal fingerprints are then compared chunk by chunk: for every (fingerprint, chunk
number) the smallest and largest chunk must be the same. That is an aggregate which Spark combines before the
shuffle, so a group of any size costs one row for each task and chunk. Groups that fail it are split by their texts.

Defined cases: null counts as empty; texts are equal when they are identical after lower-casing A-Z only; of equal
texts the row with the largest id stays, a null id being the smallest; rows that repeat an id in one group all share
its fate, so both stay if it is the largest; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._arrow import LOWER, text_bytes
from ._spark import checkpoint, sized, small_batches

#: Bytes of a chunk: 2 ** 16 products of 8 and 31 bits add up without overflow.
CHUNK = 1 << 16
PRIMES, BASE = (2147483647, 2147483629), (1103515245, 1664525)
KEY = ["f1", "f2", "size"]


def _power_table(base: int, prime: int) -> np.ndarray:
    p = np.ones(CHUNK, np.uint64)
    have = 1
    while have < CHUNK:
        p[have : 2 * have] = p[:have] * np.uint64(pow(base, have, prime)) % np.uint64(prime)
        have *= 2
    return p


_TABLES = [_power_table(b, p) for b, p in zip(BASE, PRIMES)]


def combine(a: tuple[int, int, int], b: tuple[int, int, int]) -> tuple[int, int, int]:
    """The fingerprint (h1, h2, length) of a text from those of its two halves."""
    return (*((x + pow(base, a[2], p) * y) % p for x, y, base, p in zip(a, b, BASE, PRIMES)), a[2] + b[2])


def chunk_fingerprints(data: np.ndarray) -> list[tuple[int, int, int]]:
    out = []
    for i in range(0, len(data), CHUNK):
        x = data[i : i + CHUNK].astype(np.uint64) + np.uint64(1)
        out.append((*(int(np.dot(x, t[: len(x)]) % np.uint64(p)) for t, p in zip(_TABLES, PRIMES)), len(x)))
    return out


def fingerprint(data: np.ndarray) -> tuple[int, int, int]:
    """Chunk hashes combined pairwise, as a tree: any split gives the same result."""
    parts = chunk_fingerprints(data) or [(0, 0, 0)]
    while len(parts) > 1:
        parts = [combine(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def _fingerprints(docs: DataFrame, id_col: str, text_col: str, with_text: bool) -> DataFrame:
    def scan(batches):
        for b in batches:
            offsets, data = text_bytes(b.column(1))
            rows = []
            for i in range(b.num_rows):
                low = LOWER[data[offsets[i] : offsets[i + 1]]]
                rows.append((*fingerprint(low), low.tobytes() if with_text else hashlib.sha256(low).hexdigest()))
                if with_text and len(rows) >= 1000 or i == b.num_rows - 1:
                    cols = list(zip(*rows))
                    at = i + 1 - len(rows)
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(rows)), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.binary() if with_text else pa.string())], names=["doc_id", *KEY, "x"])
                    rows = []

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(scan, f"doc_id long, f1 long, f2 long, size long, x {'binary' if with_text else 'string'}")


def _chunks(rows: DataFrame) -> DataFrame:
    def cut(batches):
        for b in batches:
            at, no, part = [], [], []
            for i, x in enumerate(b.column(3)):
                x = x.as_py()
                for k in range(0, max(len(x), 1), CHUNK):
                    at.append(i)
                    no.append(k // CHUNK)
                    part.append(x[k : k + CHUNK])
            keys = [b.column(c).take(pa.array(at, pa.int64())) for c in range(3)]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(no, pa.int64()), pa.array(part, pa.binary())], names=[*KEY, "no", "part"])

    return rows.mapInArrow(cut, "f1 long, f2 long, size long, no long, part binary")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, keep_id, group_size, kept, text_sha256), one for every row of `docs`."""
    small_batches(docs.sparkSession)
    prints = checkpoint(_fingerprints(docs, id_col, text_col, False).withColumnRenamed("x", "text_sha256"))
    groups = prints.groupBy(*KEY).agg(F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id")).where("group_size > 1")
    groups = checkpoint(groups)
    few = sized(groups)
    texts = _fingerprints(docs, id_col, text_col, True).join(few.select(*KEY), KEY, "left_semi").select(*KEY, "x")
    unequal = _chunks(texts).groupBy(*KEY, "no").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi").select(*KEY).distinct()
    unequal = checkpoint(unequal)
    one = prints.join(few, KEY, "left")
    if not unequal.isEmpty():  # equal fingerprints of different texts: these few groups go by their whole texts
        split = _fingerprints(docs, id_col, text_col, True).join(sized(unequal), KEY, "left_semi")
        split = split.groupBy(*KEY, F.sha2("x", 256).alias("text_sha256"), "x").agg(F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id")).drop("x")
        one = prints.join(sized(unequal), KEY, "left_anti").join(few, KEY, "left").select(*KEY, "doc_id", "text_sha256", "group_size", "keep_id")
        one = one.unionByName(prints.join(split, [*KEY, "text_sha256"]).select(*one.columns))
    keep = F.coalesce("keep_id", "doc_id")
    return one.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")

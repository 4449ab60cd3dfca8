"""Vector code compression: product codes from Lloyd's algorithm that looks at active entries only.

Each vector is cut into equal parts, and each part is known by the number of the nearest entry of its position's
codebook. A part stores its entry and the exact squared distance to it. When a round has moved some entries, a part
whose own entry did not move compares the moved ones alone against what it has stored: the others are as far as they
were, so none of them can have become better. A part whose entry did move scans all entries. Ties go to the lower
index in both cases, so the codes are those of a full scan.

Rows never meet: a task sums its parts by (position, entry), Spark adds up these sums, and only codebooks, whose size
is fixed by the parameters, reach the driver. The rows with their entries and distances are written between rounds.

Defined cases: vectors that are null, or hold null or non-finite components, take no part, nor do those whose length
differs from that of the smallest id's vector; a length that the parts do not divide raises a ValueError. Integer
components saturate at 2 ** 22. Codebooks start from the vectors of the smallest ids (null ids last, rows that share
an id in the order of their vectors); fewer rows than entries give smaller codebooks. Repeated rows are rows like
others. An empty table gives an empty result. Columns of other names are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import checkpoint, discard, sized, small_batches
from ._vectors import dimension, integers, lists, matrix, whole


def _distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of x to those of book."""
    top = int(max(np.abs(x).max(initial=0), np.abs(book).max(initial=0)))
    if 4 * x.shape[1] * top * top < 1 << 53:  # every term and sum is a whole number that a double holds
        x, book = x.astype(np.float64), book.astype(np.float64)
    return ((x * x).sum(1)[:, None] - 2 * (x @ book.T) + (book * book).sum(1)[None, :]).astype(np.int64)


def _scan(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = _distances(x, book)
    at = d.argmin(1)  # the first of equal ones
    return at, d[np.arange(len(x)), at]


def assign(x: np.ndarray, books: np.ndarray, moved: np.ndarray | None, at: np.ndarray | None, dist: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entries and squared distances of parts x (rows, parts, width), given those of the round before.

    `moved` (parts, entries) tells which entries changed since `at` and `dist` were found; None scans everything.
    """
    n, parts, _ = x.shape
    if moved is None:
        at, dist, moved = np.zeros((n, parts), np.int64), np.zeros((n, parts), np.int64), np.ones(books.shape[:2], bool)
    else:
        at, dist = at.astype(np.int64), dist.astype(np.int64)
    for p in range(parts):
        active = np.flatnonzero(moved[p])
        if not len(active):
            continue
        lost = moved[p][at[:, p]]
        held = np.flatnonzero(~lost)
        if len(held):
            k, d = _scan(x[held, p], books[p][active])
            k = active[k]
            old, had = at[held, p], dist[held, p]
            better = (d < had) | ((d == had) & (k < old))
            at[held, p], dist[held, p] = np.where(better, k, old), np.where(better, d, had)
        full = np.flatnonzero(lost)
        if len(full):
            at[full, p], dist[full, p] = _scan(x[full, p], books[p])
    return at, dist


def _sums(rows: DataFrame, parts: int, entries: int, width: int) -> DataFrame:
    """Number and componentwise sum of the parts of each (position, entry), as slot = position * entries + entry."""

    def add(batches):
        n, s = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, width), np.int64)
        for b in batches:
            x = matrix(b.column(0), parts * width).astype(np.int64).reshape(-1, width)
            slot = (matrix(b.column(1), parts) + np.arange(parts) * entries).ravel()
            n += np.bincount(slot, minlength=len(n))
            order = np.argsort(slot, kind="stable")
            used, first = np.unique(slot[order], return_index=True)
            if len(used):
                s[used] += np.add.reduceat(x[order], first, axis=0)
        used = np.flatnonzero(n)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(n[used]), lists(s[used], pa.int64())], names=["slot", "n", "s"])

    out = rows.select("q", "at").mapInArrow(add, "slot int, n long, s array<long>")
    return out.groupBy("slot").agg(F.sum("n").alias("n"), *(F.sum(F.col("s")[k]).alias(f"s{k}") for k in range(width)))


def vector_codes(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """Rows (vec_id, label, code, error), and the codebooks (parts, entries, width).

    `code` has one entry number a part in hexadecimal, two digits each or as many as the entries need; `error` is the
    sum of the squared distances.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"), F.col(label_col).alias("label")).where(whole(F.col("vec")))
    dim = dimension(rows, "vec_id", "vec")
    if dim % parts:
        raise ValueError(f"{parts} parts do not divide vectors of {dim} components")
    rows, width, digits = rows.where(F.size("vec") == dim), dim // parts, max(2, (entries - 1).bit_length() + 3 >> 2)
    label = rows.schema["label"].dataType.simpleString()
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vec").select("vec").limit(entries).toArrow()
    if not first.num_rows or not dim:
        return spark.createDataFrame([], f"vec_id long, label {label}, code string, error long"), np.zeros((parts, 0, width), np.int64)
    books = integers(first.column(0).combine_chunks(), dim, scale).reshape(-1, parts, width).transpose(1, 0, 2).copy()
    entries, moved, table = books.shape[1], None, None
    schema = f"vec_id long, label {label}, q array<int>, at array<int>, dist array<long>"

    def step(source: DataFrame, books: np.ndarray, moved: np.ndarray | None, last: bool) -> DataFrame:
        def find(batches):
            for b in batches:
                x = integers(b.column(2), dim, scale) if moved is None else matrix(b.column(2), dim).astype(np.int64)
                held = (None, None) if moved is None else (matrix(b.column(3), parts), matrix(b.column(4), parts))
                at, dist = assign(x.reshape(-1, parts, width), books, moved, *held)
                if last:
                    code = ["".join(f"{k:0{digits}x}" for k in row) for row in at.tolist()]
                    out, names = [pa.array(code, pa.string()), pa.array(dist.sum(1))], ["code", "error"]
                else:
                    out, names = [lists(x, pa.int32()), lists(at, pa.int32()), lists(dist, pa.int64())], ["q", "at", "dist"]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *out], names=["vec_id", "label", *names])

        return source.mapInArrow(find, f"vec_id long, label {label}, code string, error long" if last else schema)

    source = rows.select("vec_id", "label", "vec")
    for _ in range(rounds):
        before, table = table, checkpoint(step(source, books, moved, False))
        if before is not None:
            discard(before)
        source, new = table, books.copy()
        for r in _sums(table, parts, entries, width).collect():  # at most parts * entries rows
            new[r["slot"] // entries, r["slot"] % entries] = [r[f"s{k}"] // r["n"] for k in range(width)]
        moved, books = (new != books).any(2), new
    out = checkpoint(step(source, books, moved, True))
    if table is not None:
        discard(table)
    return out, books


def codebook_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def coded_vectors(vectors: DataFrame, **options) -> DataFrame:
    """vector_codes() with the error of each label's vectors together and the digest of the codebooks."""
    codes, books = vector_codes(vectors, **options)
    by = codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    out = codes.join(sized(checkpoint(by)), F.col("label").eqNullSafe(F.col("_label")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256"))

"""Benchmark decontamination: a broadcast hash set of normalised test n-grams against the windows of training texts.

The benchmark's windows are hashed and broadcast in blocks of a bounded number of bytes; documents are scanned once
for each block. A window of a document is looked up in a small bit table, then in the sorted hashes, and a hit is
verified word by word. Only documents pass between blocks, so no shuffle is needed.

Defined cases: null and empty texts have no words and are clean; an item without words has no window; an item with
fewer words than the window is one window; rows of equal or null id are judged each by its own text; equal items are
all counted; other columns stay.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._arrow import _STEP, ALNUM, Words, mix, slices, text_bytes, texts
from ._spark import checkpoint, free_names, small_batches

#: Bytes of benchmark text that one block of the broadcast set comes from, and of a piece of a long item.
BLOCK_BYTES, PIECE_BYTES = 2_000_000, 1 << 16
BITS = 22


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    if len(words) < width:
        return words[:0]
    out = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        out += words[k : len(words) - width + 1 + k] * _STEP[k]
    return mix(out + np.uint64(width))


class Windows:
    """Windows of some pieces of benchmark text: by width, a bit table, sorted hashes, and where each window begins.

    The pieces' words are held once; a window is a place among them.
    """

    def __init__(self, pieces: list[tuple[str | None, str]], width: int):
        raw = [t.encode() for _, t in pieces]
        offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
        self.words = w = Words(offsets, np.frombuffer(b"".join(raw) or b" ", np.uint8), ALNUM)
        self.items = [item for item, _ in pieces]
        n = np.diff(w.first)
        self.by_width = []
        for span in sorted({min(width, int(k)) for k in n if k}):
            h = window_hashes(w.hash, span)
            at = np.arange(len(h))
            piece = np.searchsorted(w.first, at, "right") - 1
            fits = (at + span <= w.first[piece + 1]) & ((n[piece] >= width) if span == width else (n[piece] == span))
            h, at, piece = h[fits], at[fits], piece[fits]
            order = np.argsort(h, kind="stable")
            bits = np.zeros(1 << BITS, bool)
            bits[h >> np.uint64(64 - BITS)] = True
            self.by_width.append((span, bits, h[order], at[order], piece[order]))

    def hits(self, w: Words):
        """(row, first word, width, items) of every verified occurrence that lies within one row."""
        for span, bits, hashes, places, pieces in self.by_width:
            h = window_hashes(w.hash, span)
            if not len(h):
                continue
            at = np.flatnonzero(bits[h >> np.uint64(64 - BITS)])
            low, high = np.searchsorted(hashes, h[at], "left"), np.searchsorted(hashes, h[at], "right")
            row = np.searchsorted(w.first, at, "right") - 1
            good = (high > low) & (at + span <= w.first[row + 1])
            for i, k, a, b in zip(at[good].tolist(), row[good].tolist(), low[good].tolist(), high[good].tolist()):
                text = w.text(i, i + span)
                items = {self.items[pieces[j]] for j in range(a, b) if self.words.text(int(places[j]), int(places[j]) + span) == text}
                if items:
                    yield k, i - int(w.first[k]), span, items


def _pieces(benchmark: DataFrame, item_col: str, text_col: str, width: int) -> DataFrame:
    """Distinct rows (item, text) of the benchmark, long texts cut into pieces that share width - 1 words."""

    def cut(batches):
        for b in batches:
            items, out = [], []
            for item, text in zip(b.column(0).to_pylist(), texts(b.column(1))):
                raw = (text or "").encode()
                if len(raw) <= PIECE_BYTES:
                    parts = [raw]
                else:
                    w = Words(np.array([0, len(raw)]), np.frombuffer(raw, np.uint8), ALNUM)
                    n, step = len(w.hash), PIECE_BYTES // 8
                    begins = range(0, max(n - width + 1, 1), step)
                    parts = [w.text(i, min(n, i + step + width - 1)) for i in begins]
                items += [item] * len(parts)
                out += [p.decode() for p in parts]
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(out, pa.string())], names=["item", "text"])

    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).distinct()
    return checkpoint(rows.mapInArrow(cut, "item string, text string").distinct())


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, width: int):
    rows = _pieces(benchmark, item_col, text_col, width)
    n = 1 + (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES
    for k in range(n):
        yield [(r[0], r[1]) for r in rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).collect()]


#: What mark_contamination adds.
MARKS = ("n_words", "hit_spans", "hit_items")


def mark_contamination(docs: DataFrame, benchmark: DataFrame, width: int = 13, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", names: tuple[str, ...] = MARKS) -> DataFrame:
    """`docs` with n_words, hit_spans (flat array of first word and end, in words) and hit_items (as strings).

    An item without an id counts as the item "". The columns, which `names` can rename, take the place of such as
    have their names.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop(*names)
    made = (F.lit(0).cast("long"), F.array().cast("array<long>"), F.array().cast("array<string>"))
    out = docs.withColumns(dict(zip(names, made)))
    spark, column = docs.sparkSession, docs.columns.index(text_col)
    for no, items in enumerate(_blocks(benchmark, item_col, item_text_col, width)):
        if no:
            out = checkpoint(out)
        shared = spark.sparkContext.broadcast(items)

        def scan(batches, shared=shared):
            windows = Windows(shared.value, width)
            for b in batches:
                n, spans, names = np.zeros(b.num_rows, np.int64), {}, {}
                offsets, data = text_bytes(b.column(column))
                for i, j in slices(offsets):
                    w = Words(offsets[i : j + 1], data, ALNUM)
                    n[i:j] = np.diff(w.first)
                    for k, first, span, found in windows.hits(w):
                        run = spans.setdefault(i + k, [])
                        run.append((first, first + span))
                        names.setdefault(i + k, set()).update(x or "" for x in found)
                old_spans, old_names = b.column(b.num_columns - 2), b.column(b.num_columns - 1)
                all_spans, all_names = [], []
                for i in range(b.num_rows):
                    s, a = spans.get(i), names.get(i)
                    before, had = old_spans[i].as_py(), old_names[i].as_py()
                    if s:
                        s = sorted(s + list(zip(before[::2], before[1::2])))
                        merged = [list(s[0])]
                        for x, y in s[1:]:
                            if x <= merged[-1][1]:
                                merged[-1][1] = max(merged[-1][1], y)
                            else:
                                merged.append([x, y])
                        before = [x for pair in merged for x in pair]
                    all_spans.append(before)
                    all_names.append(sorted({*had, *(a or ())}) if a else had)
                cols = [*b.columns[:-3], pa.array(n), pa.array(all_spans, pa.list_(pa.int64())), pa.array(all_names, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

        out = out.mapInArrow(scan, out.schema)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 13, part: int = 20, **columns: str) -> DataFrame:
    """`docs` with n_words, n_hit, n_items, items_sha256 and contaminated: at least 1 of `part` words is hit.

    They take the place of columns of these names.
    """
    spans, items = free_names(docs, "hit_spans", "hit_items")
    marked = mark_contamination(docs, benchmark, width, names=("n_words", spans, items), **columns)
    out = marked.withColumns({"n_hit": _hit(spans), "n_items": F.size(items).cast("long"), "items_sha256": F.sha2(F.concat_ws(",", items).cast("binary"), 256)})
    return out.withColumn("contaminated", F.expr(f"n_hit > 0 and {part} * n_hit >= n_words")).drop(spans, items)


def _hit(spans: str) -> Column:
    total = F.expr(f"aggregate(sequence(1, size(`{spans}`), 2), 0L, (s, i) -> s + `{spans}`[i] - `{spans}`[i - 1])")
    return F.when(F.size(spans) > 0, total).otherwise(F.lit(0)).cast("long")


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 13, part: int = 20, mode: str = "documents", text_col: str = "text") -> DataFrame:
    """`docs` without contaminated documents, or (mode "spans") with the hit words cut out of all texts.

    All columns of `docs` stay as they are.
    """
    names = tuple(free_names(docs, *MARKS))
    marked = mark_contamination(docs, benchmark, width, text_col, names=names)
    if mode == "documents":
        n_hit = _hit(names[1])
        return marked.where(~((n_hit > 0) & (part * n_hit >= F.col(names[0])))).select(*docs.columns)

    @F.arrow_udf("string")
    def cut(text: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for t, s in zip(texts(text), spans.to_pylist()):
            if t is not None and len(s):
                raw = t.encode()
                data = np.frombuffer(raw, np.uint8)
                w, kept, at = Words(np.array([0, len(data)]), data, ALNUM), [], 0
                for a, b in zip(s[::2], s[1::2]):
                    kept.append(raw[at : w.start[a]])
                    at = w.end[b - 1]
                t = b"".join([*kept, raw[at:]]).decode()
            out.append(t)
        return pa.array(out, pa.string())

    return marked.withColumn(text_col, cut(text_col, names[1])).select(*docs.columns)


def digest(items) -> str:
    """items_sha256 of some item ids, for tests."""
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()

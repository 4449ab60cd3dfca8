"""Fuzzy line deduplication by MinHash.

Lines are sets of 8-character shingles. One-permutation MinHash signatures, whose empty bins take over other bins in an
order of their own, are banded for high recall (a pair of similarity 0.8 is missed with a chance of about 0.2 %); the
lines of a band are compared by their exact Jaccard similarity; distributed union-find joins similar lines; of every
component, over all documents, the first line stays: of the smallest document id, then the smallest line number.
Lines too short for a shingle are similar only to equal lines.

Bands are sent to tasks with the texts of their lines, and only links leave a task: no pairs are listed. Of bands with
the same lines one is compared. A band of many lines is dealt into blocks of bounded size and number of characters,
and each two blocks meet in a task of their own; within a task, common shingles are counted by a product of 0/1
matrices over runs of shingles, so memory is bounded whatever the band holds. What the rows of blocks cost grows
with the square of a band's size over BLOCK_LINES.

Defined cases: a line is what newlines separate, trimmed and with A-Z lower-cased for comparison; blank lines are always
kept; null texts stay null and empty ones empty; a null id comes after all others; rows with the same id and text
count as one document, so both lose the same lines; other columns stay, but for n_lines and n_dropped, which are
replaced. Lines are known by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._arrow import _STEP, LOWER, mix, texts
from ._spark import checkpoint, components, free_names, partitions, repeated_keys, sized, small_batches

#: Characters of a shingle (a power of 2), bands of a signature and bins of a band.
WIDTH, BANDS, ROWS = 8, 12, 4
BINS = BANDS * ROWS
#: Every line that is not blank takes part.
MIN_CHARS = 1
#: Lines that a task remembers; characters hashed at once.
REMEMBERED, CHARS = 1_000_000, 1 << 16
#: Lines and characters of a block of a crowded band; cells of the matrix of lines and shingles that a task holds.
BLOCK_LINES, BLOCK_CHARS, CELLS = 1024, 1 << 20, 1 << 20
#: Lines of a band that are compared as sets.
FEW = 8
_LOWER, _SIGN = bytes(LOWER), 1 << 63
#: For each bin the order in which it asks all bins for a value when it is empty.
_ASKS = np.argsort(np.random.default_rng(20240609).random((BINS, BINS)), axis=1)


def split_lines(text: str | None) -> list[str]:
    """The lines of a text in the form in which they are compared."""
    if not text:
        return []
    low = text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")
    return [x.strip() for x in low.split("\n")]


def line_id(line: str) -> int:
    return (xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass")) ^ _SIGN) - _SIGN


def _shingles(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of some lines of at least WIDTH characters, and the line of each."""
    codes = np.frombuffer("\n".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.array([len(x) for x in lines])
    span, step = 1, int(_STEP[5])
    while span < WIDTH:  # a polynomial of twice as many characters
        codes = codes[:-span] * np.uint64(step) + codes[span:]
        span, step = 2 * span, step * step % (1 << 64)
    inside = np.ones(len(codes), bool)
    last = np.cumsum(size + 1)[:-1]
    for k in range(WIDTH):  # windows that touch a line's end
        inside[last - 1 - k] = False
    return mix(codes[inside]), np.repeat(np.arange(len(lines)), size - WIDTH + 1)


def band_keys(lines: list[str]) -> np.ndarray:
    """BANDS keys for each line; keys of earlier bands are smaller."""
    h, of = _shingles(lines)
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    sign = np.full(len(lines) * BINS, none)
    bins = (h >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)
    np.minimum.at(sign, of * BINS + bins.astype(np.int64), h & np.uint64(0xFFFFFFFF))
    sign = sign.reshape(-1, BINS)
    have = new = sign
    left = np.arange(len(lines))  # the lines with empty bins
    for k in range(BINS):
        more = (new == none).any(axis=1)
        left, have, new = left[more], have[more], new[more]
        if not len(left):
            break
        new = np.where(new == none, have[:, _ASKS[:, k]], new)
        sign[left] = new
    keys = np.zeros((len(lines), BANDS), np.uint64)
    for k in range(ROWS):
        keys += sign[:, k::ROWS] * _STEP[k]
    bands = np.arange(BANDS, dtype=np.uint64)
    return (bands << np.uint64(59) | mix(keys + bands * _STEP[ROWS]) >> np.uint64(5)).view(np.int64)


def _distinct_lines(docs: DataFrame, text_col: str, make, schema: str) -> DataFrame:
    """make(lines, ids) for batches of lines that the task has not met (as far as it remembers)."""

    def scan(batches):
        seen: set[int] = set()
        for b in batches:
            lines, ids, size = [], [], 0
            for text in texts(b.column(0)):
                for line in split_lines(text):
                    if len(line) >= WIDTH and (i := line_id(line)) not in seen:
                        if len(seen) < REMEMBERED:
                            seen.add(i)
                        lines.append(line)
                        ids.append(i)
                        size += len(line) + BINS
                if size >= CHARS:
                    yield make(lines, ids)
                    lines, ids, size = [], [], 0
            if lines:
                yield make(lines, ids)

    return docs.select(F.col(text_col).alias("text")).mapInArrow(scan, schema)


def _keys(lines, ids):
    k = band_keys(lines)
    return pa.RecordBatch.from_arrays([pa.array(k.ravel()), pa.array(np.repeat(np.array(ids, np.int64), BANDS))], names=["key", "node"])


def _texts(lines, ids):
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lines, pa.string())], names=["node", "line"])


def _line_texts(docs: DataFrame, text_col: str, wanted: DataFrame) -> DataFrame:
    """(node, line, size) of the wanted lines."""
    found = _distinct_lines(docs, text_col, _texts, "node long, line string").join(sized(wanted), "node", "left_semi")
    return checkpoint(found.groupBy("node").agg(F.first("line").alias("line")).withColumn("size", F.length("line")))


def _few(lines: list[str], groups: list[tuple[int, int]], per_mille: int):
    """Links (member, first member) of similar lines within groups (begin, end) of a few lines."""
    h, of = _shingles(lines)
    end = np.cumsum(np.bincount(of, minlength=len(lines))).tolist()
    h, begin = h.tolist(), [0, *end]
    for first, last in groups:
        sets = [frozenset(h[begin[k] : end[k]]) for k in range(first, last)]
        up = list(range(first, last))
        for j in range(1, len(sets)):
            for i in range(j):
                if up[i] != up[j]:
                    least, most = sorted((len(sets[i]), len(sets[j])))
                    if 1000 * least >= per_mille * most:
                        common = len(sets[i] & sets[j])
                        if 1000 * common >= per_mille * (least + most - common):
                            x, y = sorted((up[i], up[j]))
                            up = [x if u == y else u for u in up]
        yield from ((k, u) for k, u in zip(range(first, last), up) if u != k)


def _common(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the shingle sets of many lines, and how many shingles each two have in common."""
    m = len(lines)
    common, sizes = np.zeros((m, m), np.float32), np.zeros(m, np.int64)
    for token, of in _shingle_runs(lines):
        column = np.cumsum(np.concatenate(([0], token[1:] != token[:-1])))
        fresh = np.concatenate(([True], (token[1:] != token[:-1]) | (of[1:] != of[:-1])))
        column, of = column[fresh], of[fresh]
        sizes += np.bincount(of, minlength=m)
        shared = np.bincount(column)[column] > 1  # shingles of one line only count nowhere else
        column, of = column[shared], of[shared]
        column = np.unique(column, return_inverse=True)[1]
        step = max(1, CELLS // m)
        for c in range(0, int(column[-1]) + 1 if len(column) else 0, step):
            i, j = np.searchsorted(column, (c, c + step))
            x = np.zeros((m, min(step, int(column[-1]) + 1 - c)), np.float32)
            x[of[i:j], column[i:j] - c] = 1
            common += x @ x.T
    return sizes, common


def _shingle_runs(lines: list[str]):
    """All shingle hashes with their lines, sorted, in runs of bounded length that split no hash."""
    total = sum(map(len, lines))
    parts = 1 + total // (4 * BLOCK_CHARS)
    for part in range(parts):
        tokens, owners, at = [], [], 0
        while at < len(lines):
            end, size = at, 0
            while end < len(lines) and size < CHARS:
                size += len(lines[end])
                end += 1
            h, of = _shingles(lines[at:end])
            if parts > 1:
                mine = h % np.uint64(parts) == part
                h, of = h[mine], of[mine]
            tokens.append(h)
            owners.append(of + at)
            at = end
        token, of = np.concatenate(tokens), np.concatenate(owners)
        order = np.argsort(token, kind="stable")
        yield token[order], of[order]


def _many(lines: list[str], per_mille: int):
    """The same for one group of many lines."""
    sizes, common = _common(lines)
    similar = np.empty(common.shape, bool)
    for i in range(0, len(lines), 128):
        some = common[i : i + 128].astype(np.int64)
        similar[i : i + 128] = 1000 * some >= per_mille * (sizes[i : i + 128, None] + sizes - some)
    todo = np.ones(len(lines), bool)
    for i in range(len(lines)):
        if todo[i]:
            reach = edge = np.arange(len(lines)) == i
            while edge.any():
                edge = similar[edge].any(axis=0) & ~reach
                reach = reach | edge
            todo &= ~reach
            yield from ((k, i) for k in np.flatnonzero(reach).tolist() if k != i)


def _links(rows: DataFrame, per_mille: int) -> DataFrame:
    """Links (a, b) of lines from rows (key, cell, node, line): all lines of a key and cell are compared.

    Each task streams its sorted rows and holds one key and cell, or some small ones.
    """

    def scan(batches):
        held, begin, size = None, 0, 0
        nodes: list[int] = []  # of the small groups that wait, and of the open one, which begins at `begin`
        lines: list[str] = []
        groups: list[tuple[int, int]] = []
        found: list[tuple[int, int]] = []

        def close() -> None:
            nonlocal begin, size
            if len(lines) - begin < FEW:
                groups.append((begin, len(lines)))
            else:
                found.extend((nodes[begin + i], nodes[begin + j]) for i, j in _many(lines[begin:], per_mille))
                size -= sum(map(len, lines[begin:]))
                del lines[begin:], nodes[begin:]
            begin = len(lines)

        def links():
            nonlocal begin, size
            if groups:
                found.extend((nodes[i], nodes[j]) for i, j in _few(lines[:begin], groups, per_mille))
                size -= sum(map(len, lines[:begin]))
                del lines[:begin], nodes[:begin], groups[:]
                begin = 0
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=["a", "b"])
                found.clear()

        for batch in batches:
            for key, cell, node, line in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, cell) != held:
                    if held is not None:
                        close()
                        if size > CHARS:
                            yield from links()
                    held = key, cell
                nodes.append(node)
                lines.append(line)
                size += len(line)
        if held is not None:
            close()
        yield from links()

    dealt = rows.repartition(partitions(rows.sparkSession), "key", "cell").sortWithinPartitions("key", "cell", "node")
    return dealt.select("key", "cell", "node", "line").mapInArrow(scan, "a long, b long").distinct()


def similar_lines(docs: DataFrame, threshold: float = 0.8, text_col: str = "text") -> DataFrame:
    """Rows (node, component) of line ids that are similar to another line."""
    per_mille = round(threshold * 1000)
    shared = checkpoint(repeated_keys(_distinct_lines(docs, text_col, _keys, "key long, node long"), "key", "node"))
    # Of the bands that hold the same lines, known by two hashes, the first is compared.
    bands = shared.groupBy("key").agg(F.count("*").alias("n"), *(F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"h{k}") for k in (1, 2)))
    bands = checkpoint(bands.groupBy("n", "h1", "h2").agg(F.min("key").alias("key")).select("key"))
    shared = checkpoint(shared.join(sized(bands), "key"))
    held = _line_texts(docs, text_col, checkpoint(shared.select("node").distinct()))
    load = shared.join(held.select("node", "size"), "node").groupBy("key").agg(F.greatest(F.ceil(F.sum("size") / BLOCK_CHARS), F.ceil(F.count("*") / BLOCK_LINES)).alias("blocks"))
    crowded = checkpoint(load.where("blocks > 1"))
    rows = shared.join(sized(crowded), "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    # Block k of n meets block j in the cell of the two; with two blocks or more, a cell holds both whole.
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    others = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("blocks") - 1, F.lit(0)))
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.when(F.col("blocks") < 3, F.array(F.lit(0).cast("long"))).otherwise(others))).where("blocks < 3 or own <> other")
    cell = F.when(F.col("blocks") < 3, 0).otherwise(F.least("own", "other") * F.col("blocks") + F.greatest("own", "other"))
    rows = rows.select("key", cell.alias("cell"), "node").join(held.select("node", "line"), "node")
    return components(_links(rows, per_mille))


def dedup_lines(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with texts without repeated lines, and n_lines and n_dropped."""
    small_batches(docs.sparkSession)
    docs = docs.drop("n_lines", "n_dropped")
    similar = similar_lines(docs, threshold, text_col)
    doc_key = F.xxhash64(F.col(id_col).cast("string"), F.lit("|"), F.col(text_col))

    def number(batches):
        for b in batches:
            keys, orders, nos, ids = [], [], [], []
            for key, order, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts(b.column(2))):
                for n, line in enumerate(split_lines(text)):
                    if len(line) >= MIN_CHARS:
                        keys.append(key)
                        orders.append(order)
                        nos.append(n)
                        ids.append(line_id(line))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (keys, orders, nos, ids)], names=["doc_key", "doc_order", "no", "node"])

    rows = docs.select(doc_key.alias("doc_key"), F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("doc_order"), F.col(text_col).alias("text"))
    lines = rows.mapInArrow(number, "doc_key long, doc_order long, no long, node long").join(sized(similar), "node", "left")
    lines = checkpoint(lines.select("doc_key", "doc_order", "no", F.coalesce("component", "node").alias("class")))
    several = checkpoint(lines.groupBy("class").agg(F.count("*").alias("n")).where("n > 1").select("class"))
    lines = checkpoint(lines.join(sized(several), "class"))
    place = F.struct("doc_order", "doc_key", "no")
    first = checkpoint(lines.groupBy("class").agg(F.min(place).alias("first")))
    drop = lines.join(sized(first), "class").where(place != F.col("first")).groupBy("doc_key").agg(F.collect_set("no").alias("drop"))
    drop = checkpoint(drop)
    numbers = drop.agg(F.sum(F.size("drop"))).first()[0] or 0  # what a broadcast would hold, at least a number a row

    names, at = [*docs.columns, "n_lines", "n_dropped"], docs.columns.index(text_col)

    def without(batches):
        for b in batches:
            text, drop = b.column(at), b.column(b.num_columns - 1)
            lines = pc.fill_null(pc.add(pc.count_substring(text, "\n"), pc.cast(pc.greater(pc.binary_length(text), 0), pa.int32())), 0)
            have = pc.and_(drop.is_valid(), text.is_valid())
            kept = []
            for t, d in zip(texts(text.filter(have)), drop.filter(have).to_pylist()):
                gone = set(d)
                kept.append("\n".join([x for n, x in enumerate(t.split("\n")) if n not in gone]))
            if kept:
                text = pc.replace_with_mask(text, have, pa.array(kept, text.type))
            n_dropped = pc.fill_null(pc.list_value_length(drop), 0)
            cols = [*b.columns[:at], text, *b.columns[at + 1 : -1], pc.cast(lines, pa.int64()), pc.cast(n_dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    key, gone = free_names(docs, "doc_key", "drop")
    out = docs.withColumn(key, doc_key).join(sized(drop, numbers).toDF(key, gone), key, "left").select(*(F.col(f"`{c}`") for c in docs.columns), gone)
    schema = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return out.mapInArrow(without, schema)

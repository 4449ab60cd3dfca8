"""Substring dedup: words inside long passages that occur more than once go, all copies of them.

A window is a fixed number of consecutive words. Documents are cut into pieces so that equal windows meet: of the
hashes of all short runs of words in a window, the least is the window's key, and a piece is a row of windows that share
one. A key whose run occurs in one place alone holds no repeated window. The other pieces are counted, one copy of each is sent
to the shard of its key, and every shard builds a compressed FM-index of the pieces with their counts and streams them
through it as queries; what it reports for a piece holds for all places where the piece occurs.

Pieces repeat as often as texts are copied, but they are counted before they move, so a group of copies of any size is
one row in its shard. A key with more than LIMIT different pieces (a common phrase) is dealt anew by the hashes of
its whole windows; each of those is one piece. Shards are cut between keys, so an index has a bounded size.

Words are compared as text inside a shard; keys, pieces and rows are known by 64-bit hashes, pieces by two of them.

Defined cases: a null or empty text has no words; a text of fewer words than a window loses nothing; rows that repeat
wholly, or share an id, are rows of their own, so windows of a repeated row are repeated; ids may be null. Texts are
taken whole. Columns of other names are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._arrow import _STEP, SPACES, Words, mix, powers, slices, text_bytes
from ._spark import checkpoint, discard, partitions, sized, small_batches
from .fmindex import FMIndex

#: Words of the runs whose hashes make keys, windows of a piece, and different pieces of a key.
RUN, LONGEST, LIMIT = 12, 64, 4096
#: Words of an index; one more key may come on top.
SHARD = 1 << 19


def _words(column: pa.Array):
    """(first row, Words) of some rows at a time; each row's words lie between two entries of `first`."""
    offsets, data = text_bytes(column)
    for i, j in slices(offsets, 1 << 19):
        yield i, Words(offsets[i : j + 1], data, SPACES, lower=False)


def keyed_windows(words: Words, window: int, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, first word, row) of every window, its key being the least hash of the runs inside it, and all these hashes."""
    h, first, n = words.hash, words.first, len(words.hash)
    if n < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    runs = np.zeros(n - run + 1, np.uint64)
    for k in range(run):
        runs += h[k : n - run + 1 + k] * _STEP[k]
    runs = mix(runs)
    least, have, need = runs, 1, window - run + 1
    while have < need:
        step = min(have, need - have)
        least, have = np.minimum(least[:-step], least[step:]), have + step
    start = np.arange(len(least))
    row = np.searchsorted(first, start, "right") - 1
    fits = start + window <= first[row + 1]
    return least[fits], start[fits], row[fits], runs


def _polynomial(words: Words) -> tuple[np.ndarray, np.ndarray]:
    up, down = powers(len(words.hash))
    total = np.zeros(len(words.hash) + 1, np.uint64)
    np.cumsum(words.hash * up, out=total[1:])
    return total, down


def pieces(words: Words, window: int, run: int) -> tuple[np.ndarray, ...]:
    """(key, hash, first word, windows, row, runs) of each piece: neighbouring windows of one row and key, LONGEST at most.

    `runs` is 2 if the run that makes the key occurs more than once in the piece, else 1.
    """
    key, start, row, runs = keyed_windows(words, window, run)
    if not len(key):
        return key, key, start, start, row, row
    new = np.concatenate(([True], (key[1:] != key[:-1]) | (row[1:] != row[:-1])))
    begin = np.flatnonzero(new)
    inside = np.arange(len(key)) - np.repeat(begin, np.diff(np.append(begin, len(key))))
    begin = np.flatnonzero(inside % LONGEST == 0)
    count = np.diff(np.append(begin, len(key)))
    total, down = _polynomial(words)
    a = start[begin]
    digest = mix((total[a + count + window - 1] - total[a]) * down[a] + count.astype(np.uint64))
    near, width = np.arange(window - run + 1), window - run + 1
    leftmost = a + (runs[a[:, None] + near] == key[begin][:, None]).argmax(1)
    last = a + count - 1
    rightmost = last + width - 1 - (runs[last[:, None] + near[::-1]] == key[begin][:, None]).argmax(1)
    return key[begin], digest, a, count, row[begin], 1 + (leftmost != rightmost)


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, row, text), `row` being a hash of both."""
    name = F.xxhash64(F.col(id_col).isNull(), F.col(id_col).cast("string"), F.lit("|"), F.col(text_col))
    return docs.select(F.col(id_col).alias("id"), name.alias("row"), F.col(text_col).alias("text"))


def _occurrences(named: DataFrame, window: int, run: int) -> DataFrame:
    """(key, piece, row, at, n, runs): every piece of every row, the number of its first word and of its windows."""

    def scan(batches):
        for b in batches:
            for i, w in _words(b.column(1)):
                key, digest, at, n, row, runs = pieces(w, window, run)
                if len(key):
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(digest.view(np.int64)), b.column(0).take(pa.array(row + i)), pa.array((at - w.first[row]).astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(runs.astype(np.int32))], names=["key", "piece", "row", "at", "n", "runs"])

    return named.select("row", "text").mapInArrow(scan, "key long, piece long, row long, at int, n int, runs int")


def _windows(named: DataFrame, keys: DataFrame, window: int, run: int) -> DataFrame:
    """The windows of the given keys as pieces of one window, keyed by the hash of the whole window."""

    def scan(batches):
        for b in batches:
            for i, w in _words(b.column(1)):
                key, start, row, _ = keyed_windows(w, window, run)
                if len(key):
                    total, down = _polynomial(w)
                    digest = mix((total[start + window] - total[start]) * down[start] + np.uint64(1))
                    begin = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (row[1:] != row[:-1]))))
                    ends = pa.array(np.append(begin, len(key)).astype(np.int32))
                    yield pa.RecordBatch.from_arrays([pa.array(key[begin].view(np.int64)), b.column(0).take(pa.array(row[begin] + i)), pa.array((start - w.first[row])[begin].astype(np.int32)), pa.ListArray.from_arrays(ends, pa.array(digest.view(np.int64)))], names=["key", "row", "at", "all"])

    runs = named.select("row", "text").mapInArrow(scan, "key long, row long, at int, all array<long>")
    runs = runs.join(sized(keys), "key", "left_semi")
    return runs.select("row", "at", F.posexplode("all").alias("k", "key")).select("key", F.col("key").alias("piece"), "row", (F.col("at") + F.col("k")).alias("at"), F.lit(1).alias("n"), F.lit(1).alias("runs"))


def _shared(occurrences: DataFrame) -> DataFrame:
    """The occurrences of keys whose runs occur twice or more, written as a table."""
    keys = checkpoint(occurrences.groupBy("key").agg(F.sum("runs").alias("runs")).where("runs > 1").select("key"))
    out = checkpoint(occurrences.join(sized(keys), "key", "left_semi").drop("runs"))
    discard(keys)
    return out


def _joined_words(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The words with one space after each, and where each begins (one entry more)."""
    keep = np.zeros(len(words.buf) + 1, np.int8)
    keep[words.start] += 1
    keep[words.end + 1] -= 1
    buf = words.buf.copy()
    buf[words.end] = 0x20
    at = np.concatenate(([0], np.cumsum(words.end + 1 - words.start)))
    return buf[np.cumsum(keep[:-1], dtype=np.int8) > 0], at


def _copies(named: DataFrame, chosen: DataFrame, window: int) -> DataFrame:
    """(key, piece, weight, words) of the chosen pieces, which say where one copy of them lies."""
    wanted = chosen.groupBy("row").agg(F.collect_list(F.struct("key", "piece", "weight", "at", "n")).alias("wanted"))

    def cut(batches):
        for b in batches:
            ends = b.column(1).offsets.to_numpy()
            flat = b.column(1).flatten()  # the pieces of all rows of the batch
            base = ends[0]
            at, n = (flat.field(c).to_numpy() for c in ("at", "n"))
            for i, w in _words(b.column(0)):
                data, begin = _joined_words(w)
                rows = len(w.first) - 1
                lo, hi = ends[i] - base, ends[i + rows] - base
                row = np.repeat(np.arange(rows), np.diff(ends[i : i + rows + 1]))
                a = w.first[row] + at[lo:hi]
                z = a + n[lo:hi] + window - 1
                fits = np.flatnonzero(z <= w.first[row + 1])  # a row of an equal hash can be another text
                text = [data[p : q - 1].tobytes() for p, q in zip(begin[a[fits]], begin[z[fits]])]
                took = flat.slice(lo, hi - lo).take(pa.array(fits))
                yield pa.RecordBatch.from_arrays([*(took.field(c) for c in ("key", "piece", "weight")), pa.array(text, pa.binary())], names=["key", "piece", "weight", "words"])

    return named.select("row", "text").join(wanted, "row").select("text", "wanted").mapInArrow(cut, "key long, piece long, weight long, words binary")


def repeated_stretches(words: pa.Array, weights: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, first word, end) of the stretches covered by windows that occur twice or more in weighted sequences."""
    lists = pc.split_pattern(words.cast(pa.string()), " ")
    ends = lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()
    tokens = lists.flatten().dictionary_encode().indices.to_numpy() + 1
    index = FMIndex(tokens, ends.astype(np.int64), weights)
    edge = np.diff(np.concatenate(([0], index.repeated(window).astype(np.int8), [0])))
    a, z = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    owner = np.searchsorted(index.stop, a)
    return owner, a - index.start[owner], z - index.start[owner]


def _search(copies: DataFrame, window: int) -> DataFrame:
    """(key, piece, a, z): stretches of the pieces to remove, from one FM-index after the other, cut between keys."""

    def answer(table: pa.Table):
        key, piece = (table[c].to_numpy() for c in ("key", "piece"))
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (piece[1:] != piece[:-1])))  # copies of a repeated row
        at = np.flatnonzero(new)
        words = table["words"].combine_chunks().take(pa.array(at))
        owner, a, z = repeated_stretches(words, table["weight"].to_numpy()[at], window)
        at = at[owner]
        return pa.RecordBatch.from_arrays([pa.array(key[at]), pa.array(piece[at]), pa.array(a.astype(np.int32)), pa.array(z.astype(np.int32))], names=["key", "piece", "a", "z"])

    def scan(batches):
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += sum(pc.count_substring(b.column(3), b" ").to_pylist()) + 2 * b.num_rows
            if size < SHARD:
                continue
            table = pa.Table.from_batches(held)
            key = table["key"].to_numpy()
            cut = int(np.searchsorted(key, key[-1]))  # the last key may go on
            if cut:
                yield answer(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                size = sum(sum(pc.count_substring(x.column(3), b" ").to_pylist()) + 2 * x.num_rows for x in held)
        if size:
            yield answer(pa.Table.from_batches(held))

    rows = copies.repartition(partitions(copies.sparkSession), "key").sortWithinPartitions("key", "piece")
    return rows.mapInArrow(scan, "key long, piece long, a int, z int")


def _removal(named: DataFrame, spans: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Each row without the words of its spans."""
    kind = named.schema["id"].dataType.simpleString()
    types = {"n_words": "long", "n_removed": "long", "text": "string", "kept_sha256": "string"}

    def cut(batches):
        for b in batches:
            out = {c: [] for c in columns}
            ends = np.concatenate(([0], np.cumsum(np.nan_to_num(pc.list_value_length(b.column(2)).to_numpy(zero_copy_only=False)).astype(np.int64))))
            flat = b.column(2).flatten()
            low, high = flat.field("a").to_numpy(), flat.field("z").to_numpy()
            for i, w in _words(b.column(1)):
                data, begin = _joined_words(w)
                rows = len(w.first) - 1
                part = slice(ends[i], ends[i + rows])
                base = np.repeat(w.first[:-1], np.diff(ends[i : i + rows + 1]))
                edge = np.zeros(len(begin), np.int64)
                np.add.at(edge, base + low[part], 1)
                np.add.at(edge, base + high[part], -1)
                stays = np.cumsum(edge)[:-1] == 0
                size = np.diff(begin)
                data = data[np.repeat(stays, size)]
                at = np.concatenate(([0], np.cumsum(size * stays)))[w.first]
                left = np.concatenate(([0], np.cumsum(stays)))[w.first]
                for k in range(rows):
                    text = data[at[k] : max(at[k], at[k + 1] - 1)].tobytes()
                    n = int(w.first[k + 1] - w.first[k])
                    made = {"n_words": n, "n_removed": n - int(left[k + 1] - left[k])}
                    for c in columns:
                        out[c].append(made[c] if c in made else text if c == "text" else hashlib.sha256(text).hexdigest())
            arrays = [pa.array(out[c], pa.binary()).cast(pa.string()) if c == "text" else pa.array(out[c], pa.int64() if types[c] == "long" else pa.string()) for c in columns]
            yield pa.RecordBatch.from_arrays([b.column(0), *arrays], names=["id", *columns])

    rows = named.join(spans, "row", "left").select("id", "text", "spans")
    return rows.mapInArrow(cut, f"id {kind}, " + ", ".join(f"{c} {types[c]}" for c in columns))


def remove_repeats(docs: DataFrame, window: int = 35, columns: tuple[str, ...] = ("text", "n_words", "n_removed"), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` as rows (id, columns...) without the words of windows that also start anywhere else.

    `columns` are some of text (the words left, one space between them), n_words, n_removed and kept_sha256.
    """
    small_batches(docs.sparkSession)
    named, run = _named(docs, id_col, text_col), min(RUN, window)
    found = _shared(_occurrences(named, window, run))
    crowded = found.groupBy("key", "piece").agg(F.count("*").alias("weight")).groupBy("key").count().where(F.col("count") > LIMIT).select("key")
    crowded = checkpoint(crowded)
    parts = [found]
    if not crowded.isEmpty():
        parts.append(_shared(_windows(named, crowded, window, run)))
        found = found.join(sized(crowded), "key", "left_anti").union(parts[1])
    chosen = found.groupBy("key", "piece").agg(F.count("*").alias("weight"), F.min(F.struct("row", "at", "n")).alias("one"))
    copies = _copies(named, chosen.select("key", "piece", "weight", "one.*"), window)
    stretches = checkpoint(_search(copies, window))
    spans = found.join(sized(stretches), ["key", "piece"]).select("row", (F.col("at") + F.col("a")).alias("a"), (F.col("at") + F.col("z")).alias("z"))
    spans = checkpoint(spans.groupBy("row").agg(F.collect_set(F.struct("a", "z")).alias("spans")))
    discard(*parts, crowded, stretches)
    return _removal(named, spans, columns).withColumnRenamed("id", id_col)

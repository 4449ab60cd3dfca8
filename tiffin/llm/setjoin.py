"""N-gram Jaccard self-join of documents by a token-group matrix.

Documents are sets of word shingles. Documents that agree on a key drawn from a part of their sets are similar
enough to look at; they are partitioned into groups around the most central of them, and each group's row of the
token-group matrix holds the union of its members' tokens. A query document opens a group only if its overlap with
that union can still reach the threshold, and is then compared exactly with the group's members.

The keys lose no link. Of two sets with Jaccard similarity of at least t, the smaller having n tokens, at most
d = (1 - t) / t * n tokens are in one of them only. Token hashes deal every set into d + 1 + e parts, so at least
e + 1 parts hold the same tokens in both; a key is the hash of one part. Parts without tokens give no key, unless a
set has more than e of them. Every set is keyed by the part count of its own size class and of the class below,
which covers all sizes that its smaller partners can have.

Defined cases: null and empty texts have no tokens and link with nothing; equal sets link, however short; rows with
the same or a null id are separate documents with that id; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._arrow import SPACES, Words, mix, shingles, slices, text_bytes
from ._spark import checkpoint, components, partitions, repeated_keys, sized, small_batches

#: Members and tokens of a block, the unit in which a group is stored and opened.
BLOCK, BLOCK_TOKENS = 512, 1 << 19
#: Tokens of the queries that one task compares with a block at a time.
QUERY_TOKENS = 1 << 21
#: Sets whose keys a task remembers to have given out already.
REMEMBERED = 1_000_000


def token_sets(offsets, data, width: int):
    """For each row the sorted distinct shingle hashes of its text."""
    for i, j in slices(offsets):
        w = Words(offsets[i : j + 1], data, SPACES)
        for k in range(j - i):
            yield np.unique(shingles(w.hash[w.first[k] : w.first[k + 1]], width))


def set_id(tokens: np.ndarray) -> int:
    """A 64-bit name of a set; 0 is the empty set."""
    return int(mix(np.add.reduce(mix(tokens), keepdims=True) + np.uint64(len(tokens))).view(np.int64)[0]) if len(tokens) else 0


def size_class(n: int, threshold: float) -> int:
    return int(math.floor(math.log(n) / -math.log(threshold) + 1e-9))


def scheme(c: int, threshold: float) -> tuple[int, int]:
    """(d, e) of a size class, for smaller partners of up to its largest size."""
    top = math.floor(threshold ** -(c + 1) + 1e-6)
    d = math.floor((1 - threshold) / threshold * top + 1e-6)
    return d, (3 + math.ceil(2.5 * d * math.exp(-threshold * top / (d + 1))) if d else 0)


def part_keys(tokens: np.ndarray, threshold: float) -> np.ndarray:
    own, out = size_class(len(tokens), threshold), []
    for c in (own, own - 1):
        d, spare = scheme(c, threshold) if c >= 0 else (0, 0)
        if not d:
            continue  # such partners have equal sets
        m = d + 1 + spare
        x = mix(tokens + np.uint64(c))
        part = (x >> np.uint64(33)) % np.uint64(m)
        key = np.zeros(m, np.uint64)
        np.add.at(key, part, x)
        full = np.bincount(part.astype(np.int64), minlength=m) > 0
        ids = np.arange(m) if m - full.sum() > spare else np.flatnonzero(full)
        out.append(mix(key[ids] + np.uint64(c << 32) + ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shared_keys_needed(tokens: np.ndarray, threshold: float) -> int:
    """How many keys a set shares at least with every set of another content that it links with.

    Of the parts that have keys, at most d differ.
    """
    own, out = size_class(len(tokens), threshold), []
    for c in (own, own - 1):
        d, spare = scheme(c, threshold) if c >= 0 else (0, 0)
        if d:
            m = d + 1 + spare
            part = (mix(tokens + np.uint64(c)) >> np.uint64(33)) % np.uint64(m)
            empty = m - int((np.bincount(part.astype(np.int64), minlength=m) > 0).sum())
            out.append(m - d - (empty if empty <= spare else 0))
    return min(out, default=1)


def _ids(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    def scan(batches):
        for b in batches:
            sets = [(len(s), set_id(s)) for s in token_sets(*text_bytes(b.column(1)), width)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([n for n, _ in sets], pa.int64()), pa.array([s for _, s in sets], pa.int64())], names=["doc_id", "n", "sid"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(scan, "doc_id long, n long, sid long")


def _keys(docs: DataFrame, text_col: str, width: int, threshold: float) -> DataFrame:
    def scan(batches):
        seen: set[int] = set()
        for b in batches:
            keys, sids = [], []
            for s in token_sets(*text_bytes(b.column(0)), width):
                if not len(s) or (sid := set_id(s)) in seen:
                    continue
                if len(seen) < REMEMBERED:
                    seen.add(sid)
                k = part_keys(s, threshold)
                keys.append(k.view(np.int64))
                sids.append(np.full(len(k), sid, np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(sids))], names=["key", "sid"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(scan, "key long, sid long")


def _sets(docs: DataFrame, text_col: str, width: int, threshold: float, wanted: DataFrame) -> DataFrame:
    """(sid, n, need, tokens) of the wanted sets."""

    def scan(batches):
        seen: set[int] = set()
        for b in batches:
            rows = []
            for s in token_sets(*text_bytes(b.column(0)), width):
                if len(s) and (sid := set_id(s)) not in seen:
                    if len(seen) < REMEMBERED:
                        seen.add(sid)
                    rows.append((sid, len(s), shared_keys_needed(s, threshold), s.tobytes()))
            for i in range(0, len(rows), 2000):
                sids, n, need, tokens = zip(*rows[i : i + 2000])
                yield pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), pa.array(n, pa.int64()), pa.array(need, pa.int64()), pa.array(tokens, pa.binary())], names=["sid", "n", "need", "tokens"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(scan, "sid long, n long, need long, tokens binary")
    return rows.join(sized(wanted), "sid", "left_semi").groupBy("sid").agg(*(F.first(c).alias(c) for c in ("n", "need", "tokens")))


def _ints(share: float) -> int:
    return round(share * 1000)


def _linked(common: np.ndarray, n: int, m: np.ndarray, per_mille: int) -> np.ndarray:
    return 1000 * common >= per_mille * (n + m - common)


def _verify_pairs(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Of pairs (a, b), those that link."""
    t = _ints(threshold)
    both = pairs.join(sets.select(F.col("sid").alias("a"), F.col("tokens").alias("x")), "a").join(sets.select(F.col("sid").alias("b"), F.col("tokens").alias("y")), "b")

    def scan(batches):
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            for i, (x, y) in enumerate(zip(b.column(2), b.column(3))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = _linked(common, len(x), len(y), t)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep))

    return both.select("a", "b", "x", "y").mapInArrow(scan, "a long, b long")


class _Block:
    """Members of a block: their tokens' union, and which members have each of it."""

    def __init__(self, sids: list[int], tokens: list[np.ndarray]):
        self.sid, self.size = np.array(sids, np.int64), np.array([len(x) for x in tokens])
        token = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(tokens)), self.size)
        order = np.argsort(token, kind="stable")
        token, self.owner = token[order], owner[order]
        self.union, begin = np.unique(token, return_index=True)
        self.begin = np.append(begin, len(token))

    def links(self, a: int, x: np.ndarray, per_mille: int):
        """Members that link with a query, if its overlap with the union lets it open the block."""
        union, begin = self.union, self.begin
        at = np.searchsorted(union, x)
        at = at[(at < len(union)) & (union[np.minimum(at, len(union) - 1)] == x)] if len(union) else at[:0]
        if 1000 * len(at) < per_mille * len(x):
            return  # no member can reach the threshold
        n = begin[at + 1] - begin[at]
        hits = np.repeat(begin[at] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        common = np.bincount(self.owner[hits], minlength=len(self.sid))
        for b in self.sid[_linked(common, len(x), self.size, per_mille)].tolist():
            if a != b:
                yield min(a, b), max(a, b)


def _open_groups(queries: DataFrame, blocks: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between queries and the members of the blocks that they open; both (block, chunk, sid, tokens).

    A task holds one block and an Arrow batch: of each block and chunk the members come first, then the queries stream.
    """
    t = _ints(threshold)

    def compare(batches):
        held, block, sids, tokens = None, None, [], []
        for batch in batches:
            found = []
            keys = zip(*(batch.column(c).to_pylist() for c in range(4)))
            for (key, chunk, asks, sid), x in zip(keys, batch.column(4)):
                if (key, chunk) != held:
                    held, block, sids, tokens = (key, chunk), None, [], []
                x = np.frombuffer(x.as_buffer(), np.uint64)
                if not asks:
                    sids.append(sid)
                    tokens.append(x.copy())
                    continue
                if block is None:
                    block, tokens = _Block(sids, tokens), []
                found.extend(block.links(sid, x, t))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    rows = blocks.select("block", "chunk", F.lit(False).alias("asks"), "sid", "tokens").union(queries.select("block", "chunk", F.lit(True), "sid", "tokens"))
    rows = rows.repartition(partitions(rows.sparkSession), "block", "chunk").sortWithinPartitions("block", "chunk", "asks")
    return rows.mapInArrow(compare, "a long, b long")


def similar_components(docs: DataFrame, width: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_shingles, component_id): the smallest id that links lead to, or the row's own id.

    `threshold` is read to three decimals. Only sets with a shared key are fetched; hot keys pass through in a
    stream. Within a group, members linked to the centre need no comparison with each other, and a block is opened
    only by queries of another component.
    """
    small_batches(docs.sparkSession)
    ids = checkpoint(_ids(docs, id_col, text_col, width))
    shared = checkpoint(repeated_keys(_keys(docs, text_col, width, threshold), "key", "sid").toDF("key", "sid"))
    hot = shared.groupBy("key").agg(F.count("*").alias("n"))
    score = checkpoint(shared.join(hot, "key").groupBy("sid").agg(F.sum("n").alias("score")))
    ranked = shared.join(score, "sid").select("key", "sid", F.struct("score", "sid").alias("rank"))
    centre = ranked.groupBy("key").agg(F.max("rank").alias("centre"))
    group = checkpoint(shared.join(centre, "key").groupBy("sid").agg(F.max("centre").alias("c")).select("sid", F.col("c.sid").alias("centre")))
    sets = checkpoint(_sets(docs, text_col, width, threshold, group.select("sid")))
    star = checkpoint(_verify_pairs(group.where("sid <> centre").select(F.col("sid").alias("a"), F.col("centre").alias("b")), sets, threshold))
    first = components(star)
    member = checkpoint(group.join(first.select(F.col("node").alias("sid"), "component"), "sid", "left").select("sid", "centre", F.coalesce("component", "sid").alias("component")))
    # A group's linked core and its other members go to blocks of their own, of about BLOCK members each.
    kind = F.when(F.col("component") == F.col("sid"), F.lit(0).cast("long")).otherwise(F.col("component"))
    member = member.withColumn("kind", kind)
    member = checkpoint(member.join(sets.select("sid", "n"), "sid"))
    many = member.groupBy("centre", "kind").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_TOKENS)).alias("blocks"))
    member = checkpoint(member.join(many, ["centre", "kind"]).withColumn("block", F.xxhash64("centre", "kind", F.pmod(F.xxhash64("sid"), F.col("blocks")))))
    mixed = shared.join(member.select("sid", "component"), "sid").groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
    open_keys = shared.join(sized(mixed), "key").join(member.select("sid", "component", "kind", "centre"), "sid")
    open_keys = checkpoint(open_keys)
    # Queries meet whole groups first, each once, and then the blocks of those. A set shares with each one that it links
    # with, and so with its group, as many keys as it needs; groups that have fewer of its keys are bounded away before
    # any token moves. Of a core and another member, the latter asks.
    met = open_keys.select("key", "sid", "component", "kind").join(open_keys.select("key", F.col("centre"), F.col("kind").alias("core")).distinct(), "key")
    met = met.groupBy("sid", "component", "kind", "centre", "core").agg(F.count("*").alias("common"))
    met = met.join(sets.select("sid", "need"), "sid").where("common >= need")
    held = checkpoint(member.select("centre", F.col("kind").alias("core"), "block").distinct())
    asked = met.join(sized(held), ["centre", "core"]).where("core = 0 and kind = 0 or core <> 0 and core <> component").select("sid", "block")
    asked = checkpoint(asked.join(sets.select("sid", "n"), "sid"))
    load = asked.groupBy("block").agg(F.ceil(F.sum("n") / QUERY_TOKENS).cast("int").alias("chunks"))
    queries = asked.join(load, "block").select("block", F.pmod(F.xxhash64("sid"), F.col("chunks")).cast("int").alias("chunk"), "sid").join(sets, "sid")
    opened = load.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    blocks = member.select("sid", "block").join(opened, "block").select("block", "chunk", "sid").join(sets, "sid")
    links = _open_groups(queries, blocks, threshold)
    final = components(star.union(links))
    named = ids.where("n > 0").groupBy("sid", "n").agg(F.min("doc_id").alias("least"))
    named = named.join(final.select(F.col("node").alias("sid"), "component"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    known = checkpoint(named.join(least, "component").select("sid", "component_id"))
    out = ids.join(sized(known), "sid", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))

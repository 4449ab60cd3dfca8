"""Token counts of documents in flat, unindexed token files, by a separator scan.

A token file is a sequence of 16-bit ids in which an end-of-document id closes each document; it is held as rows
(file, block, tokens, ...), cut anywhere. Each block is searched for separators with numpy. A document may begin in
one block and end blocks later: a block's open tail is carried over the blocks that follow by a prefix scan over the
block summaries (a few numbers a block), never over tokens.

Defined cases: a file without a separator has no documents; two separators in a row close an empty document; tokens
after a file's last separator are not counted as a document (`tails=True` gives them a row of their own); a null or
empty text is an empty document; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import text_batches, tokenizer, vocabulary
from ._spark import checkpoint, small_batches

#: Tokens of a block.
BLOCK = 1 << 18


def token_files(docs: DataFrame, path: str, eod: int, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode texts into token files, one for each partition: rows (file, block, tokens, doc_ids).

    `tokens` are little-endian 16-bit ids; `doc_ids` lists the documents that end in the block, as a writer's log
    would, and is not used to find boundaries. `eod` must not be an id of the vocabulary.
    A file is named by the partition that it holds; store the files before they are read, as `stored` does, so that the
    name is settled.
    """
    small_batches(docs.sparkSession)
    shared = vocabulary(docs, path)
    names = ["block", "tokens", "doc_ids"]

    def write(batches):
        bpe, no, have, size, ids, ends, at = tokenizer(shared.value), 0, [], 0, [], [], 0
        if bpe.kind != "H":
            raise ValueError("the vocabulary has ids of more than 16 bits")
        if eod in bpe.token:
            raise ValueError(f"the end-of-document id {eod} is a token")
        closing = np.array([eod], np.uint16).tobytes()

        def cut(everything: bool):
            nonlocal no, have, size, ids, ends, at
            data = b"".join(have)
            while size >= block or everything and size:
                n = min(block, size)
                k = int(np.searchsorted(ends, at + n, "right"))
                yield pa.RecordBatch.from_arrays([pa.array([no], pa.int64()), pa.array([data[: 2 * n]], pa.binary()), pa.array([ids[:k]], pa.list_(pa.int64()))], names=names)
                data, size, no, at = data[2 * n :], size - n, no + 1, at + n
                ids, ends = ids[k:], ends[k:]
            have = [data]

        for b in batches:
            doc_ids = b.column(0).to_pylist()
            for first, some in text_batches(b.column(1)):
                for k, raw in enumerate(bpe.encode_batch(some)):
                    run = raw + closing
                    have.append(run)
                    size += len(run) // 2
                    ids.append(doc_ids[first + k])
                    ends.append(at + size)
                if size >= block:
                    yield from cut(False)
        yield from cut(True)
        bpe.forget()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(write, "block long, tokens binary, doc_ids array<long>").withColumn("file", F.spark_partition_id())


def stored(files: DataFrame) -> DataFrame:
    """The token files written into the shared folder, and their blocks read back."""
    return checkpoint(files)


def count_tokens(blocks: DataFrame, eod: int, tails: bool = False) -> DataFrame:
    """Rows (file, block, nth, n_tokens, doc_id): the nth document that ends in a block, without its separator.

    doc_id is the nth entry of the block's `doc_ids`, null without that column.
    """
    named = "doc_ids" in blocks.columns
    rows = blocks.select("file", "block", "tokens", F.col("doc_ids") if named else F.array().cast("array<long>").alias("doc_ids"))

    def scan(batches):
        for b in batches:
            inner, tail = [], []
            for t in b.column(2):
                x = np.frombuffer(t.as_buffer(), "<u2") if t.is_valid else np.zeros(0, "<u2")
                ends = np.flatnonzero(x == eod)
                inner.append(np.diff(ends, prepend=-1) - 1)
                tail.append(len(x) - 1 - ends[-1] if len(ends) else len(x))
            cols = [b.column(0), b.column(1), b.column(3), pa.array(inner, pa.list_(pa.int64())), pa.array(tail, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["file", "block", "doc_ids", "lengths", "tail"])

    found = rows.select("file", "block", "tokens", "doc_ids").mapInArrow(scan, f"file {dict(rows.dtypes)['file']}, block long, doc_ids array<long>, lengths array<long>, tail long")
    # The scan: `open` counts the separators' blocks so far; tails since the last such block add up to the carry.
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("run", F.coalesce(F.sum(F.when(F.size("lengths") > 0, 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)))
    found = found.withColumn("all_tails", F.coalesce(F.sum("tail").over(before), F.lit(0)))
    start = F.when(F.size("lengths") > 0, F.col("all_tails"))
    found = found.withColumn("carry", F.col("all_tails") - F.coalesce(F.last(start, ignorenulls=True).over(before), F.lit(0)))
    docs = found.select("file", "block", "carry", "doc_ids", F.posexplode("lengths").alias("nth", "n"))
    out = docs.select("file", "block", "nth", (F.col("n") + F.when(F.col("nth") == 0, F.col("carry")).otherwise(0)).alias("n_tokens"), F.try_element_at("doc_ids", F.col("nth") + 1).alias("doc_id"))
    if tails:
        last = found.groupBy("file").agg(F.max("block").alias("block"), F.max_by(F.when(F.size("lengths") > 0, F.col("tail")).otherwise(F.col("carry") + F.col("tail")), "block").alias("n_tokens"))
        out = out.union(last.where("n_tokens > 0").select("file", "block", F.lit(None).cast("int"), "n_tokens", F.lit(None).cast("long")))
    return out

"""Sharding along a Hilbert curve.

Source, language and size of every document are quantised to 2 ** BITS steps; the cell that they name has an index
on the Hilbert curve. Documents sorted by that index are cut into runs of equal row counts, so that a shard spans few
values of every dimension and files can be pruned on each of them.

Ranks come without a global sort: rows are counted by (cell, bucket), where hashing texts deals a crowded cell into
buckets of about BUCKET_ROWS rows; the counts' running sum gives each bucket its first rank, and rows are ranked within
their bucket. Texts of more than BUCKET_ROWS copies have buckets of their own, dealt by row number. A third of all rows
in one cell, or of one text, or the same row again and again, thus spreads over as many tasks as its rows need, and
equal texts of a cell follow each other in the order. The table of buckets, a few rows for every BUCKET_ROWS documents,
is summed up in one task.

Defined cases: null source, language, text or id is a value of its own; rows that repeat are separate rows; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._spark import checkpoint, sized

BITS = 5
BUCKET_ROWS = 20_000
OVERHEAD = 16


def hilbert_index(coords: list[np.ndarray], bits: int) -> np.ndarray:
    """Index on the Hilbert curve of points with `bits` bits in every dimension."""
    x = [np.asarray(c, np.int64).copy() for c in coords]
    n = len(x)
    step = 1 << (bits - 1)
    while step > 1:  # undo the rotations, from the largest cube to the smallest
        low = step - 1
        for i in range(n):
            flip = (x[i] & step) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        step >>= 1
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    step = 1 << (bits - 1)
    while step > 1:
        turn = np.where((x[n - 1] & step) != 0, turn ^ (step - 1), turn)
        step >>= 1
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            index = index << 1 | (x[i] ^ turn) >> b & 1
    return index


def _category(col: str):
    """A step for a category: 0 for null, else by hash."""
    return F.when(F.col(col).isNull(), 0).otherwise(1 + F.pmod(F.crc32(F.encode(F.col(col).cast("string"), "UTF-8")), F.lit((1 << BITS) - 1))).cast("long")


def hilbert_shards(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", categories: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """Rows (doc_id, size, text_crc32, shard, slot, hilbert): shards of row counts at most one apart, by the curve.

    The order is by curve index, then by bucket, text checksum, id; equal texts of one language and source thus lie in one
    shard, or in some that follow each other.
    """

    @F.arrow_udf("long")
    def index(dims: pa.Array) -> pa.Array:
        return pa.array(hilbert_index([dims.field(k).to_numpy() for k in range(dims.type.num_fields)], BITS))

    raw = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    size = (F.octet_length(F.coalesce(F.col(text_col), F.lit(""))) + OVERHEAD).cast("long")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), size.alias("size"), F.crc32(raw).alias("text_crc32"), *(_category(c).alias(f"d{i}") for i, c in enumerate(categories)))
    log_size = F.least(F.floor(F.log2(F.col("size")) * 2 - 8), F.lit((1 << BITS) - 1)).cast("long")
    rows = rows.withColumn("hilbert", index(F.struct(*(f"d{i}" for i in range(len(categories))), F.greatest(log_size, F.lit(0).cast("long")).alias("ds"))))
    rows = checkpoint(rows.select("doc_id", "size", "text_crc32", "hilbert", F.monotonically_increasing_id().alias("row")))
    cells = checkpoint(rows.groupBy("hilbert").agg(F.count("*").alias("n"))).withColumn("buckets", F.ceil(F.col("n") / BUCKET_ROWS))
    crowds = checkpoint(rows.groupBy("hilbert", "text_crc32").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET_ROWS)).select("hilbert", "text_crc32", F.ceil(F.col("n") / BUCKET_ROWS).alias("parts"))
    rows = rows.join(sized(cells.select("hilbert", "buckets")), "hilbert").join(sized(crowds), ["hilbert", "text_crc32"], "left")
    crowd = F.col("parts").isNotNull()
    bucket = F.struct(F.pmod(F.xxhash64("text_crc32"), "buckets").alias("b"), F.when(crowd, F.col("text_crc32")).otherwise(-1).alias("text"), F.when(crowd, F.pmod(F.xxhash64("row"), "parts")).otherwise(0).alias("part"))
    rows = rows.select("doc_id", "size", "text_crc32", "hilbert", bucket.alias("bucket"))
    counts = checkpoint(rows.groupBy("hilbert", "bucket").agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    first = counts.withColumn("first", F.sum("n").over(Window.orderBy("hilbert", "bucket")) - F.col("n")).drop("n")
    place = Window.partitionBy("hilbert", "bucket").orderBy("text_crc32", "doc_id", "size")
    ranked = rows.withColumn("at", F.row_number().over(place) - 1).join(sized(first), ["hilbert", "bucket"]).withColumn("at", F.col("at") + F.col("first"))
    shard = F.expr(f"at * {shards} div {max(total, 1)}")
    ranked = ranked.withColumn("shard", shard.cast("int"))
    slot = F.col("at") - F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")
    return ranked.select("doc_id", "size", "text_crc32", "shard", slot.cast("long").alias("slot"), "hilbert")


def write_shards(docs: DataFrame, path: str, shards: int = 40, id_col: str = "doc_id", **columns) -> None:
    """Write `docs` as Parquet, one folder for each shard, rows in curve order; ids must be unique and not null."""
    placed = hilbert_shards(docs, shards, id_col, **columns).select(F.col("doc_id").alias(id_col), "shard", "slot")
    out = docs.drop("shard", "slot").join(placed, id_col).repartition(shards, "shard").sortWithinPartitions("shard", "slot")
    out.drop("slot").write.partitionBy("shard").parquet(path)

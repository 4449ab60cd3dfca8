"""Spark helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a few plain columns that may be broadcast; beyond that the join is shuffled.
BROADCAST_ROWS = 1_000_000
BATCH_BYTES = 4 << 20


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder in spark.checkpoint.dir; in local mode, where that is unset, a folder of our own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        own = sc.getConf().get("spark.checkpoint.dir")
        if not own and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(own or tempfile.mkdtemp(prefix="tiffin-checkpoint-"))
    return sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches have at most BATCH_BYTES in this session: a batch of ten thousand long texts fills an executor."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name).rstrip("bB")) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage by a table written in the shared folder.

    Unlike checkpoint(), which keeps the plan's size estimate, the table has its true size; over the rounds of a loop
    the estimates of joins of joins would otherwise grow to numbers of millions of digits. The tables lie in the
    folder `tables` there and can be removed when the results have been written.
    """
    path = f"{scratch_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.table_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables that checkpoint() wrote, once nothing reads them any more."""
    for table in tables:
        jvm = table.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(table.table_path)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def sized(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint if it has at most `limit` rows, else as it is."""
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if rows <= limit else df


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as keep it apart from the columns of `df`."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name in taken:
            name = f"_{name}"
        taken.add(name)
        out.append(name)
    return out


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def repeated_keys(df: DataFrame, key: str, node: str) -> DataFrame:
    """Distinct rows (key, node) of the keys that at least two nodes have.

    One shuffle on the key; each task streams its rows sorted by key and holds one Arrow batch and one row more,
    so a key of any size passes through in bounded memory. The sort is by the key alone, which Spark does by radix;
    what comes twice is few and goes in the end.
    """
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64())])

    def scan(batches):
        held = None  # of the open key: key, its first node, whether another was met
        for batch in batches:
            k, v = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(k):
                continue
            if held is not None:
                k, v = np.append(held[0], k), np.append(held[1], v)
            begin = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
            size = np.diff(np.append(begin, len(k)))
            other = np.add.reduceat(v != np.repeat(v[begin], size), begin) > 0
            if held is not None and held[2]:
                other[0] = True
            out = np.repeat(other, size)
            if held is not None and held[2]:
                out[0] = False  # given out before
            held = (k[begin[-1]], v[begin[-1]], bool(other[-1]))
            out &= np.concatenate(([True], (k[1:] != k[:-1]) | (v[1:] != v[:-1])))
            if out.any():
                yield pa.RecordBatch.from_arrays([pa.array(k[out]), pa.array(v[out])], schema=schema)

    rows = df.select(F.col(key).alias("key"), F.col(node).alias("node")).repartition(partitions(df.sparkSession), "key")
    return rows.sortWithinPartitions("key").mapInArrow(scan, "key long, node long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): rows (node, component), the component being its smallest node.

    Randomised contraction: in each round nodes get a fresh random order, every node is merged into the first of its
    neighbours and itself, and that one again into its own first; the edges between what is left remain. In any graph
    the expected number of nodes that still have edges falls by a constant factor, so there are O(log n) rounds, also
    for chains; only counts reach the driver. Nodes without an edge are not in the result.
    """
    spark = edges.sparkSession
    left = checkpoint(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    label, rounds = None, 0
    while not left.isEmpty():
        rank = lambda c: F.xxhash64(c, F.lit(rounds))  # noqa: B023, E731
        both = left.select(F.col("a").alias("node"), F.col("b").alias("to")).union(left.select("b", "a")).withColumn("r", rank("to"))
        first = both.groupBy("node").agg(F.min("r").alias("r"), F.min_by("to", "r").alias("to"))
        first = first.select("node", F.when(F.col("r") < rank("node"), F.col("to")).otherwise(F.col("node")).alias("to"))
        hop = checkpoint(first.join(first.select(F.col("node").alias("to"), F.col("to").alias("root")), "to").select("node", "root"))
        few = sized(hop)
        if label is None:
            label = hop.select("node", F.col("root").alias("at"))
        else:
            label = label.join(few.select(F.col("node").alias("at"), "root"), "at", "left")
            label = checkpoint(label.select("node", F.coalesce("root", "at").alias("at")))
        left = left.join(few.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a").join(few.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
        left = checkpoint(left.where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
        rounds += 1
    if label is None:
        return spark.createDataFrame([], "node long, component long")
    least = label.groupBy("at").agg(F.min("node").alias("component"))
    return label.join(sized(checkpoint(least)), "at").select("node", "component")

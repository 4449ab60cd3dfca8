"""Intermediate tables in the shared folder, and broadcasts of a checked size."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a few plain columns that may be broadcast; beyond that a join is shuffled.
BROADCAST_ROWS = 1_000_000
#: Rows of a task that holds their different keys.
DEALT_ROWS = 1_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, or the context's; in local mode, without either, one of our own."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if base is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tiffin-")
        sc.setCheckpointDir(base)
    return base


def written(df: DataFrame) -> DataFrame:
    """The rows of `df` from a table in the shared folder: the plan behind them is cut, and runs once."""
    path = f"{shared_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, *keys: str, rows: int = DEALT_ROWS) -> DataFrame:
    """The rows of `df` dealt by a hash of `keys` over at least as many tasks as they need.

    A file's row group is read by one task whatever its size, so that an aggregation right behind the scan would hold
    all its keys. `keys` should be of many values, such as the row's own id.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
    return df.repartition(tasks, *keys)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint if it has at most `rows` rows, else as it is."""
    return F.broadcast(df) if df.count() <= rows else df

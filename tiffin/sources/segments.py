"""Tables that epochs are added to and that are compacted into planned segments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.operators.tables import broadcast_if_small


class SegmentTable:
    """A table in a shared folder: a base of segments, and the epochs since, each in a folder that a replay replaces.

    `merge` makes one table of rows that came in parts: the identity for plain rows, an aggregation for partial
    roll-ups with sketches (merge_rollups). Readers merge base and epochs, so late rows and batches that were run again
    count once and at once. compact() writes a new base of all epochs so far, cut by `partition` and inside it into as
    many files as its rows ask for, dealt by a hash of `spread`. One small file names the base and the last epoch that is
    in it; it takes effect as a whole, and what it no longer names is removed at the next compaction, so a reader that
    began before keeps its files. Epochs come in order; one that the base holds already is ignored when it comes again.
    """

    def __init__(self, spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame] | None = None, partition: str = "dt", spread: tuple[str, ...] = (), rows_per_file: int = 5_000_000):
        self.spark, self.path, self.merge = spark, path, merge
        self.partition, self.spread, self.rows_per_file = partition, spread, rows_per_file
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def base(self) -> int:
        """The last epoch in the base, -1 without one."""
        found = self._fs.globStatus(self._path(f"{self.path}/current-*")) or []
        return max((int(s.getPath().getName().rpartition("-")[2]) for s in found), default=-1)

    def epochs(self) -> list[int]:
        """Epochs that are complete and not in the base."""
        done = self._fs.globStatus(self._path(f"{self.path}/epochs/epoch=*/_SUCCESS")) or []
        found = sorted(int(s.getPath().getParent().getName().rpartition("=")[2]) for s in done)
        return [e for e in found if e > self.base()]

    def replace(self, batch: DataFrame, epoch: int) -> None:
        """Take an epoch; also as a sink of fan_out()."""
        if epoch > self.base():
            batch.write.mode("overwrite").parquet(f"{self.path}/epochs/epoch={epoch}")

    def _parts(self) -> DataFrame | None:
        base, parts = self.base(), [f"{self.path}/epochs/epoch={e}" for e in self.epochs()]
        made = [self.spark.read.parquet(*parts)] if parts else []
        if base >= 0:
            stream = self._fs.open(self._path(f"{self.path}/current-{base}"))
            kind = stream.readUTF()  # folder names alone do not tell text from dates
            stream.close()
            rows = self.spark.read.parquet(f"{self.path}/base-{base}")
            made.append(rows.withColumn(self.partition, F.col(self.partition).cast(kind)))
        return made[0].unionByName(made[1]) if len(made) == 2 else made[0] if made else None

    def read(self) -> DataFrame:
        if (parts := self._parts()) is None:
            raise ValueError(f"no epoch is complete in {self.path}")
        return parts if self.merge is None else self.merge(parts)

    def compact(self) -> None:
        """Make a new base of the old one and all epochs; nothing to do without an epoch."""
        epochs, before = self.epochs(), self.base()
        if not epochs:
            return
        last, rows = epochs[-1], self.read()
        planned = f"{self.path}/merged-{last}"
        if self.merge is not None:  # plain rows are planned where they lie
            rows.write.mode("overwrite").parquet(planned)
            rows = self.spark.read.parquet(planned)
        need = rows.groupBy(F.col(self.partition).alias("_key")).agg(F.greatest(F.lit(1), F.ceil(F.count("*") / self.rows_per_file)).cast("int").alias("_files"))
        names, kind = rows.columns, rows.schema[self.partition].dataType.simpleString()
        spread = self.spread or tuple(c for c, t in rows.dtypes if not t.startswith("map"))
        rows = rows.join(broadcast_if_small(need), F.col(self.partition).eqNullSafe(F.col("_key")))
        rows = rows.withColumn("_file", F.pmod(F.xxhash64(*spread), "_files"))
        rows = rows.repartition(self.partition, "_file").sortWithinPartitions(self.partition, "_file", *self.spread)
        rows = rows.select(*names).write.mode("overwrite").partitionBy(self.partition)
        rows.option("maxRecordsPerFile", self.rows_per_file).parquet(f"{self.path}/base-{last}")  # also where tasks are joined
        stream = self._fs.create(self._path(f"{self.path}/.current-{last}"), True)
        stream.writeUTF(kind)
        stream.close()
        self._fs.rename(self._path(f"{self.path}/.current-{last}"), self._path(f"{self.path}/current-{last}"))
        # What the base before this one had, and the epochs in that, are of no use to anyone by now.
        gone = [f"{self.path}/merged-{last}"]
        for s in self._fs.globStatus(self._path(f"{self.path}/base-*")) or []:
            if int(s.getPath().getName().rpartition("-")[2]) < before:
                gone.append(s.getPath().toString())
        for s in self._fs.globStatus(self._path(f"{self.path}/current-*")) or []:
            if int(s.getPath().getName().rpartition("-")[2]) < before:
                gone.append(s.getPath().toString())
        for s in self._fs.globStatus(self._path(f"{self.path}/epochs/epoch=*")) or []:
            if int(s.getPath().getName().rpartition("=")[2]) <= before:
                gone.append(s.getPath().toString())
        for p in gone:
            self._fs.delete(self._path(p), True)


def merge_rollups(dims: list[str], sums: list[str] = [], lows: list[str] = [], highs: list[str] = [], thetas: list[str] = [], hlls: list[str] = [], quantiles: list[str] = [], bucket: str | None = None) -> Callable[[DataFrame], DataFrame]:  # noqa: B006
    """A merge of partial roll-ups of the same time and dimensions: sums add up, sketches are united."""

    def merge(rows: DataFrame) -> DataFrame:
        made = [F.sum(c).alias(c) for c in ["count", *sums]] + [F.min(c).alias(c) for c in lows] + [F.max(c).alias(c) for c in highs]
        made += [F.theta_union_agg(c).alias(c) for c in thetas] + [F.hll_union_agg(c).alias(c) for c in hlls] + [F.kll_merge_agg_double(c).alias(c) for c in quantiles]
        time = F.date_trunc(bucket, "time").alias("time") if bucket else F.col("time")
        return rows.groupBy(time, *dims).agg(*made)

    return merge

"""Sinks and table maintenance."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.operators.cdc import merge_versions


def write_orc(df: DataFrame, path: str, partition_by: list[str], bloom: list[str] = [], mode: str = "append") -> None:  # noqa: B006
    """Snappy ORC with bloom filters on key columns."""
    w = df.write.mode(mode).partitionBy(*partition_by).option("compression", "snappy").option("orc.stripe.size", str(256 << 20))
    (w.option("orc.bloom.filter.columns", ",".join(bloom)) if bloom else w).orc(path)


def append_or_create(df: DataFrame, table: str, partition_by: list[str], fmt: str = "orc") -> None:
    """Append to a catalog table, or create it. Columns that only one side has are null in the rows of the other."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.write.format(fmt).partitionBy(*partition_by).option("compression", "snappy").saveAsTable(table)
        return
    have = {f.name.lower() for f in spark.table(table).schema}
    if new := [f for f in df.schema if f.name.lower() not in have]:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
    given = {f.name.lower() for f in df.schema}
    rows = df.select(*((F.col(f.name) if f.name.lower() in given else F.lit(None).cast(f.dataType)).alias(f.name) for f in spark.table(table).schema))
    rows.write.format(fmt).mode("append").partitionBy(*partition_by).saveAsTable(table)


def register_partitions(spark: SparkSession, table: str) -> None:
    """Make the catalog know the partition folders that jobs have written beside it."""
    spark.sql(f"MSCK REPAIR TABLE {table}")
    spark.catalog.refreshTable(table)


def archive_stream(messages: DataFrame, schema: str, ts: str = "updated_at") -> DataFrame:
    """Messages (value, topic, partition, offset) as typed columns with their place in the log and hourly partitions."""
    rows = messages.select(F.from_json("value", schema).alias("r"), "topic", F.col("partition").alias("_partition"), F.col("offset").alias("_offset")).select("r.*", "topic", "_partition", "_offset")
    t = F.col(ts).cast("timestamp")
    return rows.withColumns({"year": F.date_format(t, "yyyy"), "month": F.date_format(t, "MM"), "day": F.date_format(t, "dd"), "hour": F.date_format(t, "HH")})


def materialise(df: DataFrame, path: str, partition_by: list[str], sort_by: list[str] = [], run: str = "run", fmt: str = "parquet", rows_per_file: int = 2_000_000) -> None:  # noqa: B006
    """Replace the partitions that `df` has rows for, with audit columns; running it again gives the same table.

    A partition is dealt over as many tasks as its rows need, so one day's load is not one task. `df` is counted by
    partition first.
    """
    df = df.withColumns({"last_refreshed_at": F.current_timestamp(), "pipeline_run_id": F.concat(F.lit(f"{run}-"), F.current_date().cast("string"))})
    need = df.groupBy(*partition_by).agg(F.ceil(F.count("*") / rows_per_file).alias("_files"))
    names = df.columns
    salt = F.pmod(F.xxhash64(*(c for c, t in df.dtypes if not t.startswith("map") and c not in ("last_refreshed_at", "pipeline_run_id"))), F.col("_files"))
    same = need.select(*(F.col(c).alias(f"_p{i}") for i, c in enumerate(partition_by)), "_files")
    match = F.lit(True)
    for i, c in enumerate(partition_by):
        match = match & F.col(c).eqNullSafe(F.col(f"_p{i}"))
    df = df.join(same, match).withColumn("_salt", salt)
    df = df.repartition(*partition_by, "_salt").sortWithinPartitions(*partition_by, "_salt", *sort_by).select(*names)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").format(fmt).partitionBy(*partition_by).save(path)


def upsert(spark: SparkSession, changes: DataFrame, path: str, keys: list[str], order: list[str], op: str = "op_type", buckets: int = 64, horizon: str | None = None) -> None:
    """Apply changes to a Parquet table that is partitioned by a hash bucket of the keys; only touched buckets are rewritten.

    The table keeps each key's largest version (merge_versions): a change that comes late loses to a newer one that is
    there, and deleted keys leave a grave in the folder `_deleted`, which readers skip, so that an older change does not
    bring them back. `horizon`, a value of the first order column, says that older changes no longer come: graves
    before it go when their bucket is next rewritten. It is kept with the table and only moves on.

    A key's bucket never changes, so no old copy stays elsewhere. The new buckets are written beside the table; then
    each old one is set aside (under a name that readers skip), the new one takes its place, and the old one goes;
    graves are changed before rows. If the driver is lost in between, the next call brings back what was set aside, and
    the same changes can be applied again. `buckets` belongs to the table and must not change; choose it by the size
    that the table will have.
    """
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    graves = f"{path}/_deleted"
    fs.mkdirs(fs_path(graves))
    for folder in (graves, path):
        _recover_buckets(fs, fs_path, folder)
    horizon = _horizon(spark, fs, fs_path(f"{path}/_horizon"), horizon, changes.schema[order[0]].dataType)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    touched = [r[0] for r in changes.select(bucket).distinct().collect()]  # at most `buckets` numbers
    names, held = [c for c in changes.columns if c != op], list(dict.fromkeys([*keys, *order]))
    merged = merge_versions(_buckets(changes, fs, fs_path, path, touched, names), _buckets(changes, fs, fs_path, graves, touched, held), changes, keys, order, op, horizon)
    staged = f"{path}_staged"
    merged.withColumns({"_side": F.when(F.col("_gone"), "graves").otherwise("rows"), "_bucket": bucket}).drop("_gone").write.mode("overwrite").partitionBy("_side", "_bucket").parquet(staged)
    for side, folder in (("graves", graves), ("rows", path)):
        for b in touched:
            new, old, aside = (fs_path(x) for x in (f"{staged}/_side={side}/_bucket={b}", f"{folder}/_bucket={b}", f"{folder}/.old_bucket={b}"))
            if fs.exists(old):
                fs.rename(old, aside)
            if fs.exists(new):
                fs.rename(new, old)
            fs.delete(aside, True)
    fs.delete(fs_path(staged), True)


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table that upsert() keeps."""
    return spark.read.parquet(path).drop("_bucket")


def _buckets(changes: DataFrame, fs, fs_path, path: str, touched: list[int], names: list[str]) -> DataFrame:
    """Columns of some buckets of a table; no rows where it has none of them."""
    there = [p for b in touched if fs.exists(fs_path(p := f"{path}/_bucket={b}"))]
    if not there:
        return changes.select(*names).limit(0)
    return changes.sparkSession.read.option("basePath", path).parquet(*there).select(*names)


def _horizon(spark: SparkSession, fs, file, given: str | None, kind) -> str | None:
    """The later one of a given horizon and the one that is kept in a file; the file then has it."""
    kept = None
    if fs.exists(file):
        stream = fs.open(file)
        kept = stream.readUTF()
        stream.close()
    if given is None or kept is not None and not spark.range(1).select(F.lit(given).cast(kind) > F.lit(kept).cast(kind)).first()[0]:
        return kept
    stream = fs.create(file, True)
    stream.writeUTF(given)
    stream.close()
    return given


def _recover_buckets(fs, fs_path, path: str) -> None:
    """Undo a swap that broke off: an old bucket comes back if its new one is not in place, else it goes."""
    for s in [*(fs.globStatus(fs_path(f"{path}/.old_bucket=*")) or []), *(fs.globStatus(fs_path(f"{path}/_old_bucket=*")) or [])]:
        name = s.getPath().getName()[len(".old") :].removeprefix("_")
        back = fs_path(f"{path}/_{name.removeprefix('_')}")
        if fs.exists(back):
            fs.delete(s.getPath(), True)
        else:
            fs.rename(s.getPath(), back)


def to_topic(df: DataFrame, topic: str | None = None, key: str | None = None) -> DataFrame:
    """Rows as key and JSON value for a message sink; a column `topic` stays if no topic is named."""
    rest = [c for c in df.columns if c != "topic" or topic]
    k = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(k.alias("key"), F.to_json(F.struct(*rest)).alias("value"), (F.lit(topic) if topic else F.col("topic")).alias("topic"))


def write_archive(df: DataFrame, path: str, table: str, ts: str) -> None:
    """NDJSON by table and hour."""
    t = F.col(ts).cast("timestamp")
    parts = {"year": F.date_format(t, "yyyy"), "month": F.date_format(t, "MM"), "day": F.date_format(t, "dd"), "hour": F.date_format(t, "HH")}
    df.withColumns(parts).write.mode("append").partitionBy(table, *parts).json(path)


def file_health(spark: SparkSession, path: str, partition: str, fmt: str = "parquet") -> DataFrame:
    """Files, rows and bytes of each partition."""
    files = spark.read.format(fmt).load(path).select(partition, "_metadata.file_path", "_metadata.file_size").groupBy(partition, "file_path", "file_size").agg(F.count("*").alias("n"))
    return files.groupBy(partition).agg(F.count("*").alias("file_count"), F.sum("n").alias("record_count"), F.sum("file_size").alias("total_bytes"))


def compact(spark: SparkSession, path: str, out: str, partition: str, target_bytes: int = 256 << 20, sort_by: list[str] = [], fmt: str = "parquet") -> None:  # noqa: B006
    """Rewrite a partitioned table into files of about `target_bytes`, each partition into as many as its bytes need."""
    need = file_health(spark, path, partition, fmt).select(partition, F.greatest(F.lit(1), F.ceil(F.col("total_bytes") / target_bytes)).cast("int").alias("_files"))
    df = spark.read.format(fmt).load(path)
    names = [c for c in df.columns if c != partition]
    df = df.join(F.broadcast(need), partition) if need.count() <= 1_000_000 else df.join(need, partition)
    df = df.withColumn("_part", F.pmod(F.xxhash64(*names), "_files")).repartition(partition, "_part").sortWithinPartitions(partition, "_part", *sort_by)
    df.select(*names, partition).write.partitionBy(partition).format(fmt).save(out)


def expire(spark: SparkSession, path: str, before: str, partition: str = "dt") -> list[str]:
    """Remove partition folders dated before a day; returns their names."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    gone = [s.getPath() for s in fs.listStatus(fs_path(path)) if s.getPath().getName().startswith(f"{partition}=") and s.getPath().getName() < f"{partition}={before}"]
    for p in gone:
        fs.delete(p, True)
    return sorted(p.getName() for p in gone)


class CommitLog:
    """Which epochs of a streaming query each sink has taken, as empty files in a shared folder.

    An entry is made after its write, so a lost driver can only leave a write without one. Epochs come in order;
    of long runs of entries the early ones go, and epochs below the first that is left count as taken.
    """

    def __init__(self, spark: SparkSession, path: str, query: str, keep: int = 1000):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self.folder, self.keep = f"{path}/{query}", keep

    def taken(self, sink: str) -> list[int]:
        """The epochs that have entries, in order."""
        found = self._fs.globStatus(self._path(f"{self.folder}/{sink}/[0-9]*")) or []
        return sorted(int(s.getPath().getName()) for s in found)

    def has(self, sink: str, epoch: int) -> bool:
        have = self.taken(sink)
        return bool(have) and (epoch < have[0] and len(have) > self.keep // 2 or epoch in have)

    def add(self, sink: str, epoch: int) -> None:
        self._fs.create(self._path(f"{self.folder}/{sink}/{epoch}"), True).close()
        have = self.taken(sink)
        for old in have[: -(self.keep // 2 + 1)] if len(have) > self.keep else []:
            self._fs.delete(self._path(f"{self.folder}/{sink}/{old}"), False)


class EpochFiles:
    """A sink of files with a folder for each epoch, which a replay of the epoch replaces."""

    def __init__(self, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()):
        self.path, self.fmt, self.partition_by = path, fmt, partition_by

    def replace(self, batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").partitionBy(*self.partition_by).format(self.fmt).save(f"{self.path}/epoch={epoch}")

    def read(self, spark: SparkSession, log: CommitLog | None = None, sink: str = "") -> DataFrame:
        """The rows of all epochs, or of those that the log has."""
        rows = spark.read.format(self.fmt).load(self.path)
        if log is not None:
            have = log.taken(sink)
            early = F.col("epoch") < (have[0] if have and len(have) > log.keep // 2 else -1)
            rows = rows.where(early | F.col("epoch").isin(have))
        return rows.drop("epoch")


class Selected:
    """A sink that takes the rows of a condition."""

    def __init__(self, sink, condition: str):
        self.sink, self.condition = sink, condition

    def replace(self, batch: DataFrame, epoch: int) -> None:
        self.sink.replace(batch.where(self.condition), epoch)


class UpsertSink:
    """A sink that applies each epoch to an upserted table; the table is the same however often an epoch comes."""

    def __init__(self, path: str, keys: list[str], order: list[str], op: str = "op_type", buckets: int = 64):
        self.path, self.keys, self.order, self.op, self.buckets = path, keys, order, op, buckets

    def replace(self, batch: DataFrame, epoch: int) -> None:
        upsert(batch.sparkSession, batch, self.path, self.keys, self.order, self.op, self.buckets)


def fan_out(outputs: dict[str, Callable[[DataFrame], None] | EpochFiles | UpsertSink], log: CommitLog | None = None):
    """A foreachBatch function that gives one cached batch to several sinks, each epoch once.

    A sink has replace(batch, epoch), which gives the same result when it is called again; a plain function of the
    batch may be given too. A sink whose epoch is in the log is skipped, so a replay goes on with the first one that
    failed. What a lost driver leaves between a write and its entry is written again: that is exactly once for sinks
    that replace, and at least once for plain functions. Without a log, this run's epochs alone are remembered.
    """
    seen: set[tuple[str, int]] = set()

    def write(batch: DataFrame, epoch: int) -> None:
        open_ = {n: f for n, f in outputs.items() if (n, epoch) not in seen and not (log is not None and log.has(n, epoch))}
        if not open_:
            return
        batch.persist()
        try:
            for name, sink in open_.items():
                if hasattr(sink, "replace"):
                    sink.replace(batch, epoch)
                else:
                    sink(batch)
                if log is not None:
                    log.add(name, epoch)
                seen.add((name, epoch))
        finally:
            batch.unpersist()

    return write

"""Data quality as DataFrames of findings, and the gate that acts on them."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Order statuses that may follow each other.
TRANSITIONS = {
    "PLACED": ["CONFIRMED", "CANCELLED"],
    "CONFIRMED": ["PREPARING", "CANCELLED"],
    "PREPARING": ["READY"],
    "READY": ["PICKED_UP"],
    "PICKED_UP": ["DELIVERING"],
    "DELIVERING": ["DELIVERED"],
    "DELIVERED": [],
    "CANCELLED": [],
}


def null_ratios(df: DataFrame, columns: list[str], limit: float = 0.01) -> DataFrame:
    """For each column its nulls and their share, in one pass; an empty table passes."""
    one = df.agg(F.count("*").alias("n"), *(F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(columns)))
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("nulls")) for i, c in enumerate(columns)))
    out = one.select("n", F.explode(pairs).alias("p")).select("p.*", "n")
    share = F.coalesce(F.try_divide(F.col("nulls").cast("double"), F.col("n").cast("double")), F.lit(0.0))
    return out.select("column", "nulls", F.col("n").alias("rows"), share.alias("ratio"), (share < limit).alias("passed"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.count_distinct(F.struct(*keys)).alias("distinct_keys")).withColumn("duplicates", F.col("rows") - F.col("distinct_keys"))


def rule_failures(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """For each rule the rows for which it is false or null, in one pass."""
    one = df.agg(F.count("*").alias("n"), *(F.count_if(~F.coalesce(c, F.lit(False))).alias(f"r{i}") for i, c in enumerate(rules.values())))
    pairs = F.array(*(F.struct(F.lit(r).alias("rule"), F.col(f"r{i}").alias("failures")) for i, r in enumerate(rules)))
    return one.select("n", F.explode(pairs).alias("p")).select("p.rule", "p.failures", F.col("n").alias("rows"))


def freshness(tables: dict[str, tuple[DataFrame, str, float]], now: str) -> DataFrame:
    """Of tables (frame, time column, limit in minutes): newest time, age and whether it is within the limit."""
    out = None
    for name, (df, ts, limit) in tables.items():
        one = df.agg(F.max(ts).cast("timestamp").alias("newest")).select(F.lit(name).alias("table"), "newest", F.lit(float(limit)).alias("limit_minutes"))
        out = one if out is None else out.union(one)
    age = (F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("newest")) / 60.0
    return out.withColumn("age_minutes", age).withColumn("fresh", F.coalesce(F.col("age_minutes") <= F.col("limit_minutes"), F.lit(False)))


def row_counts(tables: dict[str, tuple[DataFrame, int]]) -> DataFrame:
    out = None
    for name, (df, least) in tables.items():
        one = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows", F.lit(least).cast("long").alias("least"))
        out = one if out is None else out.union(one)
    return out.withColumn("passed", F.col("rows") >= F.col("least"))


def row_ratio(source: DataFrame, target: DataFrame, least: float) -> DataFrame:
    both = source.agg(F.count("*").alias("source_rows")).join(target.agg(F.count("*").alias("target_rows")), F.lit(True))
    share = F.coalesce(F.try_divide(F.col("target_rows").cast("double"), F.col("source_rows").cast("double")), F.lit(1.0))
    return both.withColumn("ratio", share).withColumn("passed", F.col("ratio") >= least)


def schema_drift(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Columns that are missing, of another type, or (as a note that breaks nothing) not expected.

    Another type breaks nothing if its values can be read as the expected one, as those of an int as a bigint.
    """
    have, want = {f.name: f for f in df.schema}, {f.name: f for f in expected}
    rows = [(n, f.dataType.simpleString(), None, "missing", not f.nullable) for n, f in want.items() if n not in have]
    rows += [(n, f.dataType.simpleString(), have[n].dataType.simpleString(), "type", not promotes(have[n].dataType, f.dataType)) for n, f in want.items() if n in have and have[n].dataType != f.dataType]
    rows += [(n, None, f.dataType.simpleString(), "extra", False) for n, f in have.items() if n not in want]
    return df.sparkSession.createDataFrame(rows, "column string, expected string, found string, finding string, breaking boolean")


_WIDER = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]


def promotes(written: T.DataType, read: T.DataType) -> bool:
    """Whether values of one plain type can be read as another without loss of range: equal or wider numbers, text as bytes."""
    if written == read or {type(written), type(read)} == {T.StringType, T.BinaryType}:
        return True
    if isinstance(written, T.DecimalType) and isinstance(read, T.DecimalType):
        return read.scale >= written.scale and read.precision - read.scale >= written.precision - written.scale
    if type(written) in _WIDER and type(read) in _WIDER:
        return _WIDER.index(type(written)) <= _WIDER.index(type(read))
    return False


def schema_compatibility(spark: SparkSession, written: T.StructType, read: T.StructType, defaults: frozenset[str] = frozenset()) -> DataFrame:
    """Whether data of one schema can be read by another, later one (BACKWARD): a row for each field that differs.

    A field that only the reader has must be nullable or have a default (`defaults` names paths such as a.b); one that
    only the data has is skipped; types may widen; a field that may be null in the data must be so for the reader, or
    have a default. Structs, arrays and maps are compared inside: `[]` stands for elements, `{}` for values.
    """
    rows: list[tuple] = []

    def note(path: str, w: T.DataType | None, r: T.DataType | None, finding: str, breaking: bool) -> None:
        rows.append((path, w and w.simpleString(), r and r.simpleString(), finding, breaking))

    def value(path: str, w: T.DataType, r: T.DataType) -> None:
        if isinstance(w, T.StructType) and isinstance(r, T.StructType):
            struct(f"{path}.", w, r)
        elif isinstance(w, T.ArrayType) and isinstance(r, T.ArrayType):
            if w.containsNull and not r.containsNull:
                note(f"{path}[]", w.elementType, r.elementType, "nullable", True)
            value(f"{path}[]", w.elementType, r.elementType)
        elif isinstance(w, T.MapType) and isinstance(r, T.MapType):
            if w.valueContainsNull and not r.valueContainsNull:
                note(f"{path}{{}}", w.valueType, r.valueType, "nullable", True)
            value(f"{path}{{key}}", w.keyType, r.keyType)
            value(f"{path}{{}}", w.valueType, r.valueType)
        elif w != r:
            note(path, w, r, "type", not promotes(w, r))

    def struct(at: str, w: T.StructType, r: T.StructType) -> None:
        have, want = {f.name: f for f in w}, {f.name: f for f in r}
        for name, f in want.items():
            path = f"{at}{name}"
            if name not in have:
                note(path, None, f.dataType, "added", not (f.nullable or path in defaults))
                continue
            if have[name].nullable and not f.nullable:
                note(path, have[name].dataType, f.dataType, "nullable", path not in defaults)
            value(path, have[name].dataType, f.dataType)
        for name in have.keys() - want.keys():
            note(f"{at}{name}", have[name].dataType, None, "removed", False)

    struct("", written, read)
    return spark.createDataFrame(sorted(rows, key=str), "path string, written string, read string, finding string, breaking boolean")


def incompatible_versions(spark: SparkSession, versions: list[T.StructType], defaults: frozenset[str] = frozenset()) -> DataFrame:
    """Breaking differences of each version, from the first on, to every one before it, by the numbers of both."""
    out = None
    for i, new in enumerate(versions):
        for j in range(i):
            found = schema_compatibility(spark, versions[j], new, defaults).where("breaking").select(F.lit(j).alias("written_version"), F.lit(i).alias("read_version"), "path", "finding")
            out = found if out is None else out.union(found)
    return out if out is not None else spark.createDataFrame([], "written_version int, read_version int, path string, finding string")


#: Which status of a delivery may follow which.
DELIVERY_TRANSITIONS = {"ASSIGNED": ["PICKED_UP", "CANCELLED"], "PICKED_UP": ["DELIVERED", "CANCELLED"], "DELIVERED": [], "CANCELLED": []}


def illegal_transitions(changes: DataFrame, key: str, status: str, ts: str, tie: str, legal: dict[str, list[str]] | None = None) -> DataFrame:
    """Changes whose status may not follow the key's status before."""
    w = Window.partitionBy(key).orderBy(ts, tie)
    allowed = F.create_map(*(x for s, to in (legal or TRANSITIONS).items() for x in (F.lit(s), F.array(*map(F.lit, to)))))
    rows = changes.withColumn("previous", F.lag(status).over(w)).where(f"previous is not null and previous <> {status}")
    return rows.where(~F.coalesce(F.array_contains(F.try_element_at(allowed, F.col("previous")), F.col(status)), F.lit(False)))


def referential_gaps(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key is not null and not among the parent's."""
    return df.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def freshness_lag(df: DataFrame, ts: str, now: str, keys: list[str] = [], limit_seconds: float = 300) -> DataFrame:  # noqa: B006
    """By key (or over all) the newest event, how many seconds it lies before `now`, and whether that is within the limit."""
    newest = df.groupBy(*keys).agg(F.max(ts).cast("timestamp").alias("newest"))
    lag = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("newest")
    return newest.withColumn("lag_seconds", lag).withColumn("passed", F.coalesce(F.col("lag_seconds") <= limit_seconds, F.lit(False)))


def partition_completeness(files: DataFrame, partition: Column, least_files: int = 1, least_bytes: int = 1, extensions: tuple[str, ...] = ()) -> DataFrame:
    """Of files (path, length; see sources.readers.list_files): by partition their number, bytes and whether both suffice.

    Files of other extensions than the named ones do not count; a partition all of whose files are such stays, with 0.
    """
    counts = F.lit(True)
    if extensions:
        counts = F.lit(False)
        for e in extensions:
            counts = counts | F.col("path").endswith(e)
    out = files.groupBy(partition.alias("partition")).agg(F.count_if(counts).alias("file_count"), F.coalesce(F.sum(F.when(counts, F.col("length"))), F.lit(0)).alias("total_bytes"))
    return out.withColumn("passed", (F.col("file_count") >= least_files) & (F.col("total_bytes") >= least_bytes))


def order_rules() -> dict[str, Column]:
    """The business rules of order records, for rule_failures; e-mail and telephone are rules of form."""
    c = F.col
    return {
        "total_positive": c("total_amount") > 0,
        "subtotal_below_total": c("subtotal_amount") <= c("total_amount"),
        "amounts_add_up": F.abs(c("subtotal_amount") + c("tax_amount") + c("delivery_fee") - c("total_amount")) <= F.lit("0.01").cast("decimal(12,2)"),
        "discount_not_negative": c("discount_amount") >= 0,
        "items_present": c("item_count") > 0,
    }


def value_rules(email: str, phone: str, latitude: str, longitude: str, rating: str, prep_minutes: str, start: str, end: str, used: str, allowed: str) -> dict[str, Column]:
    """Rules of form and range over named columns: contacts, places, ratings, preparation, validity and use."""
    c = F.col
    return {
        "email_form": c(email).rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$"),
        "phone_form": c(phone).rlike(r"^\+?[0-9][0-9 -]{6,14}[0-9]$"),
        "latitude_range": c(latitude).between(-90, 90),
        "longitude_range": c(longitude).between(-180, 180),
        "rating_range": c(rating).between(0, 5),
        "preparation_range": c(prep_minutes).between(1, 120),
        "validity_order": c(start) < c(end),
        "usage_bounded": c(used) <= c(allowed),
    }


def dead_letter_growth(letters: DataFrame, ts: str, limit: int = 1000, bucket: str = "30 minutes") -> DataFrame:
    """Dead letters by time bucket, and whether more came than the limit."""
    out = letters.groupBy(F.window(ts, bucket)["start"].alias("bucket")).agg(F.count("*").alias("n"))
    return out.withColumn("alert", F.col("n") > limit)


def throughput_drops(events: DataFrame, ts: str, share: float = 0.1, bucket: str = "5 minutes", past: int = 12) -> DataFrame:
    """Buckets with events in which the count is under `share` of the mean of the `past` buckets before."""
    counts = events.groupBy(F.window(ts, bucket)["start"].alias("bucket")).agg(F.count("*").alias("n"))
    mean = F.avg("n").over(Window.orderBy("bucket").rowsBetween(-past, -1))
    return counts.withColumn("mean_before", mean).withColumn("dropped", F.coalesce(F.col("n") < F.col("mean_before") * share, F.lit(False)))


def error_rates(events: DataFrame, ts: str, bad: Column, bucket: str = "1 hour", warn: float = 0.05, critical: float = 0.2) -> DataFrame:
    out = events.groupBy(F.window(ts, bucket)["start"].alias("bucket")).agg(F.count("*").alias("n"), F.count_if(bad).alias("errors"))
    rate = F.col("errors") / (F.col("n") + 0.001)
    return out.withColumn("error_rate", rate).withColumn("level", F.when(rate > critical, "critical").when(rate > warn, "warning").otherwise("ok"))


class QualityError(RuntimeError):
    pass


def gate(findings: DataFrame, fail: bool | None = None) -> bool:
    """Whether all findings passed; raises if not, unless FAIL_ON_QUALITY_ERROR is "false" or `fail` is False.

    Reads at most 20 failed findings to name them.
    """
    failed = findings.where("not passed").limit(20).collect()
    fail = os.environ.get("FAIL_ON_QUALITY_ERROR", "true").lower() != "false" if fail is None else fail
    if failed and fail:
        raise QualityError("; ".join(str(r.asDict()) for r in failed))
    return not failed

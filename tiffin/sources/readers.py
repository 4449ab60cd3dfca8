"""Sources: partitioned and incremental JDBC, JSON, lake tables, event streams."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.functions.expr import became_unavailable, event_time, parse_enum, price_change


@dataclass
class TableConfig:
    table: str
    partition_column: str
    num_partitions: int = 8
    incremental_column: str = "updated_at"
    primary_key: str = "id"
    fetch_size: int = 10_000
    decimal_columns: list[str] = field(default_factory=list)
    null_check_columns: list[str] = field(default_factory=list)


def _subquery(cfg: TableConfig, last: str | None) -> str:
    where = f" WHERE {cfg.incremental_column} >= '{last}'" if last else ""
    return f"(SELECT * FROM {cfg.table}{where}) src"


def jdbc_bounds(spark: SparkSession, url: str, properties: dict, cfg: TableConfig, last: str | None = None) -> tuple:
    """Smallest and largest value of the partition column among the rows to read; (None, None) if there are none."""
    c, where = cfg.partition_column, f" WHERE {cfg.incremental_column} >= '{last}'" if last else ""
    bounds = f"(SELECT MIN({c}) AS low, MAX({c}) AS high FROM {cfg.table}{where}) bounds"  # the database does it
    return tuple(spark.read.jdbc(url, bounds, properties=properties).first())


def _quoted(value: str, url: str = "") -> str:
    value = value.replace("\\", "\\\\") if url.startswith(("jdbc:mysql", "jdbc:mariadb")) else value  # they escape by it
    return "'" + value.replace("'", "''") + "'"


def bounds_query(cfg: TableConfig, rows: int, last: str | None = None, url: str = "") -> str:
    """SQL for every key whose rank among `rows` keys crosses a share of 1 / num_partitions, with its rank.

    The database ranks the keys by its own collation, which is what it will compare them by.
    """
    c = cfg.partition_column
    where = f" WHERE {c} IS NOT NULL" + (f" AND {cfg.incremental_column} >= '{last}'" if last else "")
    if url.startswith("jdbc:derby"):  # it numbers rows only in the order in which they come
        ranked, step = f"SELECT k, ROW_NUMBER() OVER () AS r FROM (SELECT {c} AS k FROM {cfg.table}{where} ORDER BY {c}) o", "MOD(r * {0}, {1})"
    else:
        ranked = f"SELECT {c} AS k, ROW_NUMBER() OVER (ORDER BY {c}) AS r FROM {cfg.table}{where}"
        step = "MOD(r * {0}, {1})" if url.startswith(("jdbc:oracle", "jdbc:db2")) else "(r * {0}) % {1}"
    return f"SELECT k, r FROM ({ranked}) t WHERE {step.format(cfg.num_partitions, max(rows, 1))} < {cfg.num_partitions} AND r < {rows}"


def text_bounds(spark: SparkSession, url: str, properties: dict, cfg: TableConfig, last: str | None = None) -> list[str]:
    """Keys that cut a text column into num_partitions ranges of about equally many rows, in the database's order."""
    c = cfg.partition_column
    where = f" WHERE {c} IS NOT NULL" + (f" AND {cfg.incremental_column} >= '{last}'" if last else "")
    rows = spark.read.jdbc(url, f"(SELECT COUNT(*) AS n FROM {cfg.table}{where}) counted", properties=properties).first()[0]
    found = spark.read.jdbc(url, f"({bounds_query(cfg, rows, last, url)}) bounds", properties=properties).collect()  # one a partition
    return [r[0] for r in sorted(found, key=lambda r: r[1])]


def text_ranges(column: str, parts: int, bounds: list[str] | None = None, url: str = "") -> list[str]:
    """Conditions that deal a text column into disjoint parts, nulls included.

    `bounds` come in the database's order, as text_bounds() gives them. Without them, printable ASCII is divided evenly by
    the first two characters; as a database may order text otherwise, a value then goes to the first part whose bound
    lies above it, which no collation can make two. A key that makes up more than a part's share of the rows stays in
    one part, as does every range of keys that the database takes for equal.
    """
    if bounds is not None:
        at = [_quoted(b, url) for b in bounds]
        below = [[a] for a in at]
    else:
        steps = [i * 95 * 95 // parts for i in range(1, parts)]
        at = [_quoted(chr(32 + s // 95) + chr(32 + s % 95), url) for s in steps]
        below = [at[: i + 1] for i in range(len(at))]
    if not at:
        return ["1 = 1"]
    held = [" AND ".join(f"{column} >= {a}" for a in b) for b in below]
    return [f"{column} < {at[0]} OR {column} IS NULL", *(f"{h} AND {column} < {a}" for h, a in zip(held, at[1:])), held[-1]]


def read_table_jdbc(spark: SparkSession, url: str, properties: dict, cfg: TableConfig, last: str | None = None) -> DataFrame:
    """A table over parallel connections: ranges of a numeric or time column, or ranges of equally many text keys."""
    source, props = _subquery(cfg, last), properties | {"fetchsize": str(cfg.fetch_size)}
    plain = spark.read.jdbc(url, source, properties=props)
    kind = next(f.dataType for f in plain.schema if f.name.lower() == cfg.partition_column.lower())
    if isinstance(kind, T.StringType):
        ranges = text_ranges(cfg.partition_column, cfg.num_partitions, text_bounds(spark, url, properties, cfg, last), url)
        return spark.read.jdbc(url, source, predicates=ranges, properties=props)
    low, high = jdbc_bounds(spark, url, properties, cfg, last)
    if low is None or not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType)):
        return plain
    return spark.read.jdbc(url, source, column=cfg.partition_column, lowerBound=str(low), upperBound=str(high), numPartitions=cfg.num_partitions, properties=props)


def etl_transform(df: DataFrame, cfg: TableConfig, loaded_at: str | None = None) -> DataFrame:
    """Listed columns as DECIMAL(18,2), created_at and updated_at as timestamps, and audit columns dt and _etl_loaded_at."""
    made = {c: F.col(c).cast("decimal(18,2)") for c in cfg.decimal_columns if c in df.columns}
    made |= {c: F.col(c).cast("timestamp") for c in ("created_at", "updated_at") if c in df.columns}
    now = F.lit(loaded_at).cast("timestamp") if loaded_at else F.current_timestamp()
    return df.withColumns(made).withColumns({"dt": F.date_format(now, "yyyy-MM-dd"), "_etl_loaded_at": now})


def last_value(spark: SparkSession, path: str, table: str) -> str | None:
    """The last imported value of a table in the state folder, None before the first import."""
    try:
        state = spark.read.schema("table string, last_value string, imported_at timestamp").parquet(path)
        row = state.where(F.col("table") == table).orderBy(F.col("imported_at").desc()).first()
    except Exception as e:  # Spark reports a missing folder by an error class
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    return row["last_value"] if row else None


def save_last_value(df: DataFrame, path: str, cfg: TableConfig) -> None:
    """Append the largest incremental value of a loaded batch; an empty batch leaves the state as it is."""
    top = df.agg(F.max(F.col(cfg.incremental_column).cast("string")).alias("last_value")).where("last_value is not null")
    top.select(F.lit(cfg.table).alias("table"), "last_value", F.current_timestamp().alias("imported_at")).write.mode("append").parquet(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """JSON lines of a path or pattern: (good rows, rows that do not parse, as text)."""
    lines = spark.read.text(path)
    parsed = lines.select("value", F.from_json("value", _with_corrupt(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    return parsed.where("r._bad is null").select("r.*").drop("_bad"), parsed.where("r._bad is not null").select("value")


def _with_corrupt(schema: T.StructType | str) -> T.StructType:
    made = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    return T.StructType([*made.fields, T.StructField("_bad", T.StringType())])


def parse_events(values: DataFrame, schema: str, column: str = "value", aliases: dict[str, str] | None = None) -> DataFrame:
    """JSON text to typed columns; `aliases` maps a column to another spelling that counts where it is null."""
    made = T.StructType.fromDDL(schema)
    other = [T.StructField(a, made[c].dataType) for c, a in (aliases or {}).items()]
    rows = values.select(F.from_json(column, T.StructType([*made.fields, *other])).alias("r"))
    return rows.select(*(F.coalesce(f"r.{f.name}", f"r.{aliases[f.name]}").alias(f.name) if f.name in (aliases or {}) else F.col(f"r.{f.name}") for f in made.fields))


#: The columns of the change streams and of the menu events.
CHANGE_SCHEMAS = {
    "orders": "order_id string, user_id string, restaurant_id string, status string, subtotal decimal(10,2), tax decimal(10,2), delivery_fee decimal(10,2), total_amount decimal(10,2), payment_method string, city string, created_at timestamp, updated_at timestamp",
    "users": "user_id string, name string, email string, phone string, city string, signup_date timestamp, is_pro_member boolean, preferred_cuisine array<string>, total_orders bigint, average_order_value decimal(10,2), last_order_at timestamp, updated_at timestamp",
    "menu": "item_id string, restaurant_id string, name string, category string, cuisine_type string, price decimal(10,2), is_vegetarian boolean, is_available boolean, preparation_time_mins int, rating float, updated_at timestamp",
    "promo": "promo_id string, promo_code string, discount_type string, discount_value decimal(10,2), min_order_value decimal(10,2), max_discount decimal(10,2), valid_from timestamp, valid_until timestamp, usage_count bigint, max_usage bigint, is_active boolean, updated_at timestamp",
}
MENU_EVENT = "event_type string, item_id string, restaurant_id string, name string, category string, price decimal(10,2), previous_price decimal(10,2), is_available boolean, last_updated bigint, updated_at bigint"
MENU_EVENT_TYPES = ["MENU_ITEM_ADDED", "MENU_ITEM_UPDATED", "MENU_ITEM_REMOVED", "MENU_ITEM_PRICE_CHANGED", "MENU_ITEM_AVAILABILITY_CHANGED"]


def change_stream(values: DataFrame, table: str, column: str = "value", avro_schema: str | None = None) -> DataFrame:
    """Change envelopes (before, after, op, ts_ms) of one of CHANGE_SCHEMAS, from JSON text or, with a schema, Avro bytes."""
    row = CHANGE_SCHEMAS[table]
    if avro_schema is not None:
        from pyspark.sql.avro.functions import from_avro  # needs Spark's Avro package on the cluster

        return values.select(from_avro(F.col(column), avro_schema).alias("r")).select("r.*")
    return values.select(F.from_json(column, f"before struct<{_fields(row)}>, after struct<{_fields(row)}>, op string, ts_ms bigint").alias("r")).select("r.*")


def _fields(ddl: str) -> str:
    return ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in T.StructType.fromDDL(ddl))


def menu_events(values: DataFrame, column: str = "value") -> DataFrame:
    """Menu events from JSON text with their time, price change and whether the item became unavailable.

    An event of an unknown type has none; it stays.
    """
    rows = parse_events(values, MENU_EVENT, column).withColumn("event_type", parse_enum(F.col("event_type"), MENU_EVENT_TYPES))
    made = {"event_time": event_time(F.col("last_updated"), F.col("updated_at")), **price_change(F.col("previous_price"), F.col("price"))}
    return rows.withColumns(made | {"became_unavailable": became_unavailable(F.col("event_type"), F.col("is_available"))})


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of all files below a folder, of any kind; their contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")


def good_rows(good: DataFrame, bad: DataFrame, dead_letters: str, most: int, batch: str | None = None) -> DataFrame:
    """`good`, once its bad rows are in a folder of dead letters; raises if they are more than `most`.

    A batch with a name has its own folder there, which a retry replaces; without a name the rows are appended.
    """
    rows = bad.select("value", F.current_timestamp().alias("failed_at"))
    if batch is None:
        rows.write.mode("append").parquet(dead_letters)
    else:
        rows.write.mode("overwrite").parquet(f"{dead_letters}/batch={batch}")
    if (n := bad.count()) > most:
        raise ValueError(f"{n} rows do not parse; at most {most} may")
    return good


def kafka_stream(spark: SparkSession, servers: str, topics: list[str], starting: str = "latest") -> DataFrame:
    """Several topics as one stream; needs Spark's Kafka package on the cluster."""
    return spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", ",".join(topics)).option("startingOffsets", starting).load().selectExpr("cast(key as string) as key", "cast(value as string) as value", "topic", "partition", "offset", "timestamp")


def lake_table(spark: SparkSession, path: str, fmt: str = "parquet", since: str | None = None, until: str | None = None) -> DataFrame:
    """A table partitioned by dt, pruned to a range of dates."""
    df = spark.read.format(fmt).load(path)
    df = df.where(F.col("dt") >= since) if since else df
    return df.where(F.col("dt") <= until) if until else df

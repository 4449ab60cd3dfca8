"""Change events: envelopes, typed attributes, upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.functions.expr import attribute_value
from tiffin.operators.curated import latest_by_key

OPERATIONS = {"c": "INSERT", "u": "UPDATE", "d": "DELETE", "r": "SNAPSHOT"}


def unwrap(envelopes: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Envelopes (before, after, op, ts_ms) to rows: `after`, or `before` of a delete, with the operation and time.

    `exclude` names columns that must not leave the source, such as personal ones.
    """
    names = [f.name for f in envelopes.schema["after"].dataType.fields if f.name not in exclude]
    code = F.create_map(*(F.lit(x) for kv in OPERATIONS.items() for x in kv))
    row = [F.coalesce(F.col(f"after.{n}"), F.when(F.col("after").isNull(), F.col(f"before.{n}"))).alias(n) for n in names]
    return envelopes.select(*row, F.try_element_at(code, F.col("op")).alias("op_type"), F.timestamp_millis("ts_ms").alias("changed_at"), (F.col("op") == "d").alias("__deleted"))


def change_rows(envelopes: DataFrame, time: str, now: str, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Unwrapped rows with processing_time (a given instant) and dt, the date of the row's own time column."""
    rows = unwrap(envelopes, exclude)
    return rows.withColumns({"processing_time": F.lit(now).cast("timestamp"), "dt": F.date_format(time, "yyyy-MM-dd")})


def merge_late(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """`target` with the rows of `source`: a row of equal keys takes its place, others are added.

    Keys may be several columns, such as id, date and city; rows of `source` must not repeat them. One shuffle.
    """
    both = target.withColumn("_new", F.lit(0)).unionByName(source.select(*target.columns).withColumn("_new", F.lit(1)))
    return latest_by_key(both, keys, ["_new"]).select(*target.columns)


def apply_changes(target: DataFrame, changes: DataFrame, keys: list[str], order: list[str], op: str = "op_type") -> DataFrame:
    """`target` after the changes: the latest row of each key wins, and a latest DELETE removes it.

    Rows of the target are older than any change. One shuffle on the keys.
    """
    base = target.withColumns({op: F.lit("TARGET"), "_new": F.lit(0)})
    for c, t in changes.select(*order).dtypes:
        if c not in base.columns:
            base = base.withColumn(c, F.lit(None).cast(t))
    both = base.unionByName(changes.withColumn("_new", F.lit(1)).select(*base.columns))
    last = latest_by_key(both, keys, ["_new", *order])
    return last.where(f"{op} <> 'DELETE'").select(*target.columns)


def merge_versions(live: DataFrame, graves: DataFrame, changes: DataFrame, keys: list[str], order: list[str], op: str = "op_type", horizon: str | None = None) -> DataFrame:
    """The largest version of each key among a table's rows, its graves and changes, deletes as rows with `_gone`.

    A version is the order columns, then whether it is a delete, then a hash of the row, so no two different rows have
    the same one and the result is a maximum: batches can come in any order, twice or in parts, and give one table.
    `graves` has the keys and order columns of deleted rows. Where the first order column lies before `horizon`, graves
    are dropped, and so are changes of keys of which nothing is stored: they might bring a forgotten key back. One
    shuffle on the keys.
    """
    names = live.columns
    rest = [c for c, t in live.dtypes if c not in keys and c not in order and not t.startswith("map")]
    blank = [F.col(c) if c in keys or c in order else F.lit(None).cast(t).alias(c) for c, t in live.dtypes]
    gone = F.col(op).eqNullSafe("DELETE")
    both = live.select(*names, F.lit(False).alias("_gone"), F.lit(True).alias("_stored"))
    both = both.union(graves.select(*blank, F.lit(True).alias("_gone"), F.lit(True).alias("_stored")))
    fresh = changes.select(*(F.col(c) if c in keys or c in order else F.when(~gone, F.col(c)).alias(c) for c in names), gone.alias("_gone"), F.lit(False).alias("_stored"))
    both = both.union(fresh)
    version = F.struct(*order, "_gone", F.xxhash64(*rest) if rest else F.lit(0))
    best = both.groupBy(*keys).agg(F.max_by(F.struct(*names, "_gone"), version).alias("row"), F.max("_stored").alias("_stored"))
    if horizon is not None:
        old = F.col(f"row.{order[0]}") < F.lit(horizon).cast(live.schema[order[0]].dataType)
        best = best.where(~F.coalesce(old & (F.col("row._gone") | ~F.col("_stored")), F.lit(False)))
    return best.select("row.*")


def flatten_change_records(records: DataFrame) -> DataFrame:
    """Typed change records to flat ones: event, table of the ARN, time, and the image's attributes as text.

    The new image counts, else the old one. `records` has eventID, eventName, eventSourceARN and dynamodb with
    ApproximateCreationDateTime, SequenceNumber, NewImage, OldImage: map<string, struct<S, N, BOOL, NULL>>.
    """
    image = F.coalesce(F.col("dynamodb.NewImage"), F.col("dynamodb.OldImage"))
    return records.select(
        F.col("eventID").alias("event_id"),
        F.col("eventName").alias("event_name"),
        F.coalesce(F.try_element_at(F.split("eventSourceARN", "/"), F.lit(2)), F.lit("unknown")).alias("table_name"),
        F.col("dynamodb.ApproximateCreationDateTime").alias("approximate_creation_time"),
        F.col("dynamodb.SequenceNumber").alias("sequence_number"),
        F.transform_values(image, lambda _, v: attribute_value(v)).alias("data"),
    )


#: The columns of the four projections of change records, with their types.
PROJECTIONS = {
    "user-sessions": {"user_id": "string", "session_id": "string", "device_type": "string", "app_version": "string", "pages_viewed": "int", "actions_count": "int", "city": "string", "started_at": "string", "ended_at": "string", "is_active": "boolean", "session_duration_secs": "bigint"},
    "delivery-tracking": {"delivery_id": "string", "order_id": "string", "partner_id": "string", "latitude": "double", "longitude": "double", "status": "string", "estimated_arrival": "string", "distance_km": "double", "last_updated": "string"},
    "restaurant-inventory": {"restaurant_id": "string", "item_id": "string", "item_name": "string", "is_available": "boolean", "stock_count": "int", "preparation_time_mins": "int", "last_updated": "string"},
    "user-preferences": {"user_id": "string", "preferred_cuisines": "string", "dietary_filters": "string", "favorite_restaurants": "string", "price_range": "string", "notifications_enabled": "boolean", "last_updated": "string"},
}
#: What names a row of each projection.
PROJECTION_KEYS = {"user-sessions": ["session_id"], "delivery-tracking": ["delivery_id"], "restaurant-inventory": ["restaurant_id", "item_id"], "user-preferences": ["user_id"]}


def latest_projection(flat: DataFrame, table: str) -> DataFrame:
    """The typed rows of one of PROJECTIONS, the latest of each key by time and sequence number."""
    rows = project_records(flat, table, PROJECTIONS[table])
    rows = rows.withColumn("_length", F.length("sequence_number"))
    last = latest_by_key(rows, PROJECTION_KEYS[table], ["event_time", "_length", "sequence_number"])
    return last.select(F.col("event_name").alias("cdc_operation"), *PROJECTIONS[table], "event_time", "dt", "hour")


def latest_records(flat: DataFrame, key: str) -> DataFrame:
    """The latest flat record of each value of data[key]: by time, then by sequence number, longer numbers larger."""
    rows = flat.withColumns({"_key": F.col("data")[key], "_length": F.length("sequence_number")})
    return latest_by_key(rows, ["_key"], ["approximate_creation_time", "_length", "sequence_number"]).drop("_key", "_length")


def project_records(flat: DataFrame, table: str, columns: dict[str, str]) -> DataFrame:
    """Of one table's flat records typed columns (name -> type), with event time, date and hour; bad values are null."""
    ts = F.timestamp_seconds("approximate_creation_time")
    return flat.where(F.col("table_name") == table).select("event_id", "event_name", "sequence_number", *(F.col("data")[n].try_cast(t).alias(n) for n, t in columns.items()), ts.alias("event_time"), F.date_format(ts, "yyyy-MM-dd").alias("dt"), F.hour(ts).alias("hour"))

"""Structured Streaming operators; each takes a streaming (or batch) DataFrame and returns one that is not started."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.functions.expr import spike_level


def flatten_events(events: DataFrame, extra: dict[str, tuple[str, str]] = {}) -> DataFrame:  # noqa: B006
    """Events with property, device and location maps to flat columns; bad numbers are null.

    `extra` names more columns: name -> (map, key).
    """
    at = lambda m, k: F.try_element_at(F.col(m), F.lit(k))
    return events.select(
        "event_id",
        "event_type",
        "source",
        "user_id",
        "session_id",
        F.col("timestamp").alias("event_timestamp"),
        at("location", "city").alias("city"),
        at("location", "latitude").try_cast("double").alias("latitude"),
        at("location", "longitude").try_cast("double").alias("longitude"),
        at("device", "platform").alias("platform"),
        at("properties", "order_id").alias("order_id"),
        at("properties", "total_amount").try_cast("double").alias("total_amount"),
        F.date_format("timestamp", "yyyy-MM-dd").alias("dt"),
        F.hour("timestamp").alias("hour"),
        *(at(m, k).alias(n) for n, (m, k) in extra.items()),
    )


def olap_feed(events: DataFrame) -> DataFrame:
    """The nine columns of the OLAP feed, with a constant count of one."""
    return flatten_events(events).select(F.col("event_timestamp").alias("__time"), "event_type", "user_id", "session_id", "city", "platform", "order_id", "total_amount", F.lit(1).alias("event_count"))


def _watermarked(df: DataFrame, ts: str, delay: str) -> DataFrame:
    return df.withWatermark(ts, delay) if df.isStreaming else df


def city_velocity(events: DataFrame, size: str = "5 minutes", delay: str = "10 seconds", exact: bool = False) -> DataFrame:
    """Orders by city and tumbling window: count, revenue, mean and distinct users.

    Users are counted by a theta sketch, which is exact below 2 ** 14 and bounds the window's state; `exact` keeps the
    set of ids instead.
    """
    users = F.size(F.collect_set("user_id")) if exact else F.theta_sketch_estimate(F.theta_sketch_agg("user_id", 14))
    flat = _watermarked(flatten_events(events.where("event_type = 'ORDER_PLACED'")), "event_timestamp", delay)
    out = flat.groupBy("city", F.window("event_timestamp", size).alias("w")).agg(F.count("*").alias("order_count"), F.sum("total_amount").alias("total_revenue"), F.avg("total_amount").alias("avg_order_value"), users.cast("long").alias("unique_users"))
    return out.select("city", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "order_count", "total_revenue", "avg_order_value", "unique_users")


def spike_alerts(velocity: DataFrame, least: int = 100) -> DataFrame:
    return velocity.where(F.col("order_count") > least).withColumn("alert_level", spike_level(F.col("order_count")))


def restaurant_velocity(changes: DataFrame, size: str = "5 minutes", delay: str = "5 seconds") -> DataFrame:
    """Inserted and updated orders by restaurant, city and tumbling window."""
    rows = _watermarked(changes.where("op_type in ('INSERT', 'UPDATE')"), "updated_at", delay)
    out = rows.groupBy("restaurant_id", "city", F.window("updated_at", size).alias("w")).agg(F.count("*").alias("order_count"), F.sum("total_amount").alias("total_revenue"), F.avg("total_amount").alias("avg_order_value"))
    return out.select("restaurant_id", "city", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "order_count", "total_revenue", "avg_order_value")


def cancellation_counts(events: DataFrame, key: str, ts: str, size: str = "10 minutes", slide: str = "1 minute", delay: str = "30 seconds") -> DataFrame:
    out = _watermarked(events, ts, delay).groupBy(key, F.window(ts, size, slide).alias("w")).agg(F.count("*").alias("n"))
    return out.select(key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n")


def sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "10 seconds") -> DataFrame:
    rows = _watermarked(events, "timestamp", delay)
    out = rows.groupBy("user_id", F.session_window("timestamp", gap).alias("s")).agg(F.count("*").alias("events"))
    return out.select("user_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "events")


def dedup(events: DataFrame, keys: list[str], ts: str, delay: str = "10 seconds") -> DataFrame:
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys) if events.isStreaming else events.dropDuplicates(keys)


def streaming_rollup(flat: DataFrame, ts: str, dims: list[str], delay: str = "10 seconds") -> DataFrame:
    """Continuous minute roll-up: count, revenue and a theta sketch of users."""
    out = _watermarked(flat, ts, delay).groupBy(F.window(ts, "1 minute").alias("w"), *dims).agg(F.count("*").alias("count"), F.sum("total_amount").alias("total_revenue"), F.theta_sketch_agg("user_id", 14).alias("users"))
    return out.select(F.col("w.start").alias("time"), *dims, "count", "total_revenue", "users")


def file_sink(df: DataFrame, path: str, checkpoint: str, partition_by: list[str], fmt: str = "orc", trigger: str = "1 minute"):
    """A started query that appends files by partition, once per committed batch."""
    return df.writeStream.format(fmt).partitionBy(*partition_by).option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(processingTime=trigger).start()


def drain(df: DataFrame, write, checkpoint: str) -> None:
    """Run a stream over what its source has now, giving each epoch to a foreachBatch function."""
    df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def run_once(df: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """Run a stream over what its source has now, into Parquet under `folder`, and read the result back."""
    spark: SparkSession = df.sparkSession
    out = f"{folder}/out"

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    q = df.writeStream.foreachBatch(keep).outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(out).drop("epoch")

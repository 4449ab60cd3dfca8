"""The ordering domain's tables, bound to the driver's tables by fixed formulas.

Every table is derived from the given Parquet files, so its size follows theirs. AS_OF stands for the current date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-06-28"
EVENTS_AS_OF = "2024-01-28"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumns({c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"})


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).selectExpr("n_nationkey as zone_id", "n_name as zone_name", "n_regionkey as city_id", "r_name as city_name")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("item_count"), F.min("l_suppkey").alias("restaurant_id"), F.min("l_partkey").alias("first_item_id"))
    o = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    o = o.selectExpr(
        "o_orderkey as order_id",
        "o_custkey as customer_id",
        "restaurant_id",
        "item_count",
        "first_item_id",
        "case o_orderstatus when 'F' then 'delivered' when 'P' then 'cancelled' else 'placed' end as order_status",
        "case o_orderkey % 3 when 0 then 'delivery' when 1 then 'pickup' else 'dine_in' end as order_type",
        "case o_orderpriority when '1-URGENT' then 'upi' when '2-HIGH' then 'credit_card' when '3-MEDIUM' then 'cod' when '5-LOW' then 'debit_card' else 'wallet' end as payment_method",
        "case o_orderkey % 3 when 0 then 'android' when 1 then 'ios' else 'web' end as platform",
        "cast(o_totalprice as decimal(12,2)) as total_amount",
        "case when o_orderkey % 5 = 0 then concat('C', cast(o_orderkey % 7 as string)) end as coupon_code",
        "o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 as int), cast(o_orderkey % 60 as int)) as order_placed_at",
        "case o_orderkey % 4 when 0 then 'customer changed' when 1 then 'restaurant closed' when 2 then 'rider missing' else 'other' end as reason",
        "cast(20 + o_orderkey % 50 as int) as minutes",
    )
    done, gone = "order_status = 'delivered'", "order_status = 'cancelled'"
    return o.selectExpr(
        "*",
        "case when coupon_code is not null then cast(total_amount * 0.1 as decimal(12,2)) else cast(0 as decimal(12,2)) end as discount_amount",
        "cast(total_amount * 0.05 as decimal(12,2)) as tax_amount",
        "cast(30 as decimal(12,2)) as delivery_fee",
        "cast(total_amount - cast(total_amount * 0.05 as decimal(12,2)) - 30 as decimal(12,2)) as subtotal_amount",
        "case when order_status <> 'placed' then order_placed_at + interval 2 minutes end as order_accepted_at",
        f"case when {done} then order_placed_at + interval 12 minutes end as order_picked_up_at",
        f"case when {done} then order_placed_at + make_dt_interval(0, 0, minutes) end as order_delivered_at",
        f"case when {gone} then order_placed_at + interval 5 minutes end as order_cancelled_at",
        f"case when {gone} then reason end as cancellation_reason",
        "30 as estimated_delivery_min",
        f"case when {done} then minutes end as actual_delivery_min",
        f"case when {done} then order_id % 97 end as rider_id",
        f"case when {done} and order_id % 2 = 0 then cast(1 + order_id % 5 as int) end as order_rating",
    ).drop("reason", "minutes")


def restaurants(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = zones(spark, sf_dir)
    s = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as restaurant_id",
        "s_name as restaurant_name",
        "s_nationkey as zone_id",
        "cast(0.15 + 0.05 * (s_suppkey % 3) as decimal(5,4)) as commission_rate",
        "cast(1 + s_suppkey % 5 as double) as restaurant_rating",
        "case s_suppkey % 4 when 0 then 'north' when 1 then 'south' when 2 then 'east' else 'west' end as cuisine",
    )
    return s.join(F.broadcast(z), "zone_id")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").selectExpr("c_custkey as user_id", "c_name as name", "c_nationkey as zone_id", "c_mktsegment as segment", "c_mktsegment = 'BUILDING' as is_pro_member", "cast(c_acctbal as decimal(12,2)) as balance")
    return c.join(F.broadcast(zones(spark, sf_dir)), "zone_id")


def app_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App events with maps as they arrive, from the events table."""
    return table(spark, sf_dir, "events").selectExpr(
        "cast(event_id as string) as event_id",
        "case event_type when 'purchase' then 'ORDER_PLACED' when 'error' then 'ORDER_CANCELLED' when 'signup' then 'USER_SIGNUP' when 'view' then 'MENU_VIEWED' else 'APP_OPENED' end as event_type",
        "'app' as source",
        "cast(user_id as string) as user_id",
        "concat('s', cast(user_id as string)) as session_id",
        "ts as timestamp",
        "map('order_id', cast(event_id as string), 'restaurant_id', cast(user_id % 20 as string), 'total_amount', cast(value as string), 'k', get_json_object(props, '$.k')) as properties",
        "map('platform', case event_id % 3 when 0 then 'android' when 1 then 'ios' else 'web' end, 'app_version', concat('4.', cast(event_id % 4 as string))) as device",
        "map('latitude', cast(12.5 + (event_id % 100) / 100.0 as string), 'longitude', cast(77.25 + (event_id % 50) / 100.0 as string), 'city', case user_id % 5 when 0 then 'Mumbai' when 1 then 'Delhi' when 2 then 'Pune' when 3 then 'Chennai' else 'Agra' end) as location",
        "props",
    )

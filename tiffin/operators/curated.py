"""Curated orders: latest record of each order, gates, enrichment and derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiffin.functions import expr as X
from tiffin.operators.tables import broadcast_if_small

CRITICAL = ("order_id", "customer_id", "restaurant_id", "total_amount", "order_placed_at")


def latest_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by `order`, larger being later.

    max_by combines before the shuffle, unlike a row number over the whole key. Ties are broken by the other
    columns, so the result does not depend on the partitioning. The keys are the grouping's own, so a join on them needs
    no other shuffle.
    """
    rest = [c for c, t in df.dtypes if c not in keys and c not in order and not t.startswith("map")]
    rank = F.struct(*(F.col(c) for c in order), F.xxhash64(*keys, *rest))
    others = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*(F.col(c) for c in others or keys)), rank).alias("_row"))
    return best.select(*(F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns))


def nth_latest(df: DataFrame, keys: list[str], order: list[str], n: int = 1) -> DataFrame:
    """Rows 1 to n of each key, latest first."""
    w = Window.partitionBy(*keys).orderBy(*(F.col(c).desc() for c in order))
    return df.withColumn("_n", F.row_number().over(w)).where(f"_n <= {n}").drop("_n")


def curate_orders(
    orders: DataFrame,
    restaurants: DataFrame,
    users: DataFrame,
    *,
    max_total: float = 100_000,
    max_items: int = 100,
    earliest: str = "2020-01-01",
    before: str | None = None,
    payments: DataFrame | None = None,
    deliveries: DataFrame | None = None,
    versions: list[str] | None = None,
    snapshots: list[str] | None = None,
) -> DataFrame:
    """One row per plausible order, enriched from restaurants, users, first orders and optional payments and deliveries.

    Rows that miss a critical field or break a bound go. `versions` names the columns that order the records of one
    order, delivery or payment (such as log time and offset), `snapshots` those of the dimensions' records; the latest
    of each key counts. Without them each must hold one row a key. An order is a first order when its date is that of
    the customer's first order. An `items` array gives item features. Payment status is the settled one, if there is one.
    """
    last = lambda df, key, order: latest_by_key(df, [key], order) if order and df is not None else df
    restaurants, users = last(restaurants, "restaurant_id", snapshots), last(users, "user_id", snapshots)
    gated = last(orders.dropna(subset=list(CRITICAL)), "order_id", versions)
    payments, deliveries = last(payments, "order_id", versions[:1] if versions else None), last(deliveries, "order_id", versions[:1] if versions else None)
    count = F.count_distinct("order_id") if versions else F.count("*")
    first = orders.groupBy("customer_id").agg(F.min("order_placed_at").alias("first_order_time"), count.alias("customer_lifetime_orders"))
    own_items = "items" in orders.columns
    r = restaurants.select("restaurant_id", "restaurant_name", "zone_id", "zone_name", "city_id", "city_name", "commission_rate", "restaurant_rating", *([] if own_items else [F.col("cuisine").alias("cuisine_primary")]))
    u = users.select(F.col("user_id").alias("customer_id"), "is_pro_member", F.col("segment").alias("user_segment"))
    out = gated
    if payments is not None:
        out = out.join(payments.select("order_id", F.col("payment_status").alias("final_payment_status")), "order_id", "left")
        given = F.col("payment_status") if "payment_status" in orders.columns else F.lit(None)
        out = out.withColumn("payment_status", F.coalesce("final_payment_status", given))
    if deliveries is not None:
        out = out.join(deliveries.select("order_id", F.col("total_distance_km").alias("delivery_distance_km")), "order_id", "left")
    # What is known by order comes first, where the latest records lie; then orders move once, to their customers.
    if snapshots:
        r = broadcast_if_small(r)
    out = out.join(r, "restaurant_id", "left").join(u, "customer_id", "left").join(first, "customer_id", "left")
    total, placed = F.col("total_amount"), F.col("order_placed_at")
    plausible = (total > 0) & (total < max_total) & (F.col("item_count") > 0) & (F.col("item_count") <= max_items) & (placed > F.lit(earliest).cast("timestamp"))
    if before is not None:
        plausible &= placed < F.lit(before).cast("timestamp")
    actual, estimate = F.col("actual_delivery_min"), F.col("estimated_delivery_min")
    derived = {
        "is_completed": F.col("order_status") == "delivered",
        "is_cancelled": F.col("order_status").isin("cancelled", "rejected"),
        "coupon_type": X.coupon_type(F.col("coupon_code"), F.col("discount_amount"), F.col("subtotal_amount")),
        **X.money_columns(total, F.col("discount_amount"), F.col("commission_rate")),
        "delivery_delay_min": actual - estimate,
        "is_late_delivery": actual > estimate,
        "sla_breach": actual > estimate * 1.5,
        "cancellation_source": X.cancellation_source(F.col("cancellation_reason"), F.col("order_cancelled_at")),
        "accept_to_deliver_min": X.minutes_between(F.col("order_accepted_at"), F.col("order_delivered_at")).cast("double"),
        "is_first_order": F.to_date(placed) == F.to_date("first_order_time"),
        "is_pro_member": F.coalesce("is_pro_member", F.lit(False)),
        **X.time_dimensions(placed),
        **(X.item_features(F.col("items")) if own_items else {}),
    }
    return out.where(plausible).withColumns(derived).drop("first_order_time", *(["items"] if own_items else []))


def price_changes(snapshots: DataFrame, days: tuple[int, ...] = (7, 30)) -> DataFrame:
    """Snapshots (item_id, snapshot_date, price) with the change in percent over the last known price some days before.

    Range frames look the earlier price up, so gaps between snapshots do no harm and nothing is joined.
    """
    w = Window.partitionBy("item_id").orderBy("day")
    rows = snapshots.withColumn("day", F.datediff("snapshot_date", F.lit("1970-01-01").cast("date")))
    for n in days:
        before = F.last("price").over(w.rangeBetween(Window.unboundedPreceding, -n))
        rows = rows.withColumn(f"price_change_{n}d_pct", X.growth("price", before))
    return rows.drop("day")


def curate_menu(snapshots: DataFrame, sales: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """One row per item as of a date: its price and changes, its sales of the last days, ranks and a popularity score.

    `snapshots` has item_id, restaurant_id, city_id, category, snapshot_date and price; `sales` has item_id, order_date,
    customer_id and amount. The score (0 to 100) is the mean of the item's shares of the most orders, customers and
    reorders. Customers reorder who have the item at least twice in the span.
    """
    day = F.lit(as_of).cast("date")
    priced = price_changes(snapshots.where(F.col("snapshot_date") <= day))
    now = latest_by_key(priced, ["item_id"], ["snapshot_date"])
    sold = sales.where((F.col("order_date") > F.date_sub(day, days)) & (F.col("order_date") <= day))
    sold = sold.groupBy("item_id", "customer_id").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))
    sold = sold.groupBy("item_id").agg(F.sum("n").alias("total_orders_30d"), F.sum("amount").alias("total_revenue_30d"), F.count("*").alias("unique_customers_30d"), F.count_if(F.col("n") > 1).alias("again"))
    out = now.join(sold, "item_id", "left").fillna(0, ["total_orders_30d", "unique_customers_30d", "again"])
    orders = F.col("total_orders_30d")
    rank = lambda *keys: F.rank().over(Window.partitionBy(*keys).orderBy(orders.desc()))
    tier = X.ladder((F.col("price") < 150, "budget"), (F.col("price") < 400, "mid_range"), (F.col("price") < 1000, "premium"), otherwise="luxury")
    reorder = F.coalesce(X.ratio("again", "unique_customers_30d"), F.lit(0.0))
    out = out.withColumns({"price_tier": tier, "reorder_rate_30d": reorder, "restaurant_rank_by_orders": rank("restaurant_id"), "city_category_rank": rank("city_id", "category")})
    top = out.agg(F.max("total_orders_30d").alias("_o"), F.max("unique_customers_30d").alias("_c"), F.max("reorder_rate_30d").alias("_r"))
    share = lambda c, m: F.coalesce(X.ratio(c, m), F.lit(0.0))
    score = (share("total_orders_30d", "_o") + share("unique_customers_30d", "_c") + share("reorder_rate_30d", "_r")) / 3 * 100
    return out.join(F.broadcast(top), F.lit(True)).withColumn("overall_popularity_score", F.round(score, 4)).drop("_o", "_c", "_r", "again")  # one row

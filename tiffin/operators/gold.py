"""Gold tables: daily order metrics and their weekly and monthly roll-ups, and per-entity metric tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiffin.functions.expr import growth, ratio


def _if(condition: str) -> Column:
    return F.count_if(F.expr(condition))


def _pick(condition: str, value: str) -> Column:
    return F.when(F.expr(condition), F.col(value))


def _percentile(value: str, p: float, exact: bool) -> Column:
    c = F.col(value).cast("double")
    return F.percentile(c, F.lit(p)) if exact else F.percentile_approx(c, F.lit(p), F.lit(10_000))


def _distinct(value: Column, exact: bool) -> Column:
    return F.count_distinct(value) if exact else F.theta_sketch_estimate(F.theta_sketch_agg(value, 14))


def daily_order_metrics(curated: DataFrame, exact_percentiles: bool = False, exact_distinct: bool = False) -> DataFrame:
    """Metrics by order date, city, zone and weekend flag, in one aggregation.

    Percentiles are approximate by default, as a mergeable sketch; exact ones hold a group's values in memory. Distinct
    counts come from theta sketches, which are exact below 2 ** 14 in a group; exact ones repeat every row for each of
    them.
    """
    p = exact_percentiles
    counts = {
        "completed_orders": "is_completed",
        "cancelled_orders": "is_cancelled",
        "first_time_orders": "is_first_order",
        "repeat_orders": "not is_first_order",
        **{f"{t}_orders": f"order_type = '{t}'" for t in ("delivery", "pickup", "dine_in")},
        **{f"{m}_orders": f"payment_method = '{m}'" for m in ("upi", "cod", "wallet")},
        "card_orders": "payment_method in ('credit_card', 'debit_card', 'card')",
        "sla_breach_count": "sla_breach",
        **{f"{s}_cancellations": f"cancellation_source = '{s}'" for s in ("customer", "restaurant", "rider", "system")},
        "pro_member_orders": "is_pro_member",
        "peak_hour_orders": "is_peak_hour",
        "off_peak_orders": "not is_peak_hour",
        "orders_with_rating": "order_rating is not null",
        "negative_feedback_count": "order_rating <= 2",
    }
    sums = {"gross_merchandise_value": "total_amount", "net_revenue": "net_revenue", "total_discount_given": "discount_amount", "total_delivery_fee": "delivery_fee", "total_tax_collected": "tax_amount", "platform_commission": "platform_commission"}
    distinct = {
        "active_restaurants": _pick("is_completed", "restaurant_id"),
        "active_riders": F.col("rider_id"),
        "unique_customers": F.col("customer_id"),
        "new_customers": _pick("is_first_order", "customer_id"),
        "returning_customers": _pick("not is_first_order", "customer_id"),
    }
    day = curated.groupBy(F.col("order_date").alias("metric_date"), "city_id", "city_name", "zone_id", "zone_name", F.col("is_weekend").alias("weekend_flag")).agg(
        F.count("*").alias("total_orders"),
        *(_if(c).alias(n) for n, c in counts.items()),
        *(F.sum(c).alias(n) for n, c in sums.items()),
        F.sum(_pick("is_pro_member", "total_amount")).alias("pro_member_gmv"),
        _percentile("total_amount", 0.5, p).alias("median_order_value"),
        _percentile("total_amount", 0.9, p).alias("p90_order_value"),
        F.avg("actual_delivery_min").alias("avg_delivery_time_min"),
        *(_percentile("actual_delivery_min", q, p).alias(n) for n, q in (("median_delivery_time_min", 0.5), ("p90_delivery_time_min", 0.9), ("p99_delivery_time_min", 0.99))),
        F.avg((F.unix_timestamp("order_picked_up_at") - F.unix_timestamp("order_accepted_at")) / 60.0).alias("avg_accept_to_pickup_min"),
        F.avg((F.unix_timestamp("order_delivered_at") - F.unix_timestamp("order_picked_up_at")) / 60.0).alias("avg_pickup_to_deliver_min"),
        F.avg("order_rating").alias("avg_order_rating"),
        *(_distinct(c, exact_distinct).alias(n) for n, c in distinct.items()),
    )
    return day.withColumns(
        {
            "completion_rate": ratio("completed_orders", "total_orders"),
            "repeat_rate": ratio("repeat_orders", "total_orders"),
            "avg_order_value": ratio("gross_merchandise_value", "total_orders"),
            "sla_breach_rate": ratio("sla_breach_count", "completed_orders"),
            "orders_per_rider": ratio("completed_orders", "active_riders"),
        }
    )


def period_rollup(daily: DataFrame, period: str) -> DataFrame:
    """Weekly ("week") or monthly ("month") metrics by city with the growth over the period before.

    As in the daily table's other roll-ups, daily uniques are summed and daily peaks maximised. A week that spans New
    Year gives two rows, by calendar year. The period before is looked up by its date, so gaps give no growth.
    """
    start = F.to_date(F.date_trunc(period, "metric_date"))
    keys = {"period_start": start, "city_id": F.col("city_id"), "city_name": F.col("city_name")}
    if period == "week":
        keys |= {"iso_week": F.weekofyear("metric_date"), "iso_year": F.year("metric_date")}
    total = ("total_orders", "completed_orders", "cancelled_orders", "gross_merchandise_value", "net_revenue", "total_discount_given", "total_delivery_fee", "platform_commission", "unique_customers", "new_customers", "returning_customers", "pro_member_orders", "sla_breach_count")
    out = daily.groupBy(*(c.alias(n) for n, c in keys.items())).agg(
        *(F.sum(c).alias(c) for c in total),
        F.avg(F.col("total_orders").cast("double")).alias("avg_daily_orders"),
        F.avg("avg_delivery_time_min").alias("avg_delivery_time_min"),
        *(F.max(c).alias(c) for c in ("p90_delivery_time_min", "active_restaurants", "active_riders")),
    )
    earlier = out.groupBy(F.col("city_id"), F.col("period_start").alias("before")).agg(F.sum("total_orders").alias("prev_orders"), F.sum("gross_merchandise_value").alias("prev_gmv"))
    step = F.expr("period_start - interval 7 days") if period == "week" else F.add_months("period_start", -1)
    end = F.date_add("period_start", 6) if period == "week" else F.last_day("period_start")
    out = out.withColumn("before", F.to_date(step)).join(earlier, ["city_id", "before"], "left").drop("before")
    return out.withColumns(
        {
            "period_end": end,
            "completion_rate": ratio("completed_orders", "total_orders"),
            "avg_order_value": ratio("gross_merchandise_value", "total_orders"),
            "sla_breach_rate": ratio("sla_breach_count", "completed_orders"),
            "customer_retention_rate": ratio("returning_customers", "unique_customers"),
            "pro_member_share_pct": ratio("pro_member_orders", "total_orders") * 100,
            "order_growth_pct": growth("total_orders", "prev_orders", 6),
            "gmv_growth_pct": growth("gross_merchandise_value", "prev_gmv", 6),
        }
    ).drop("prev_orders", "prev_gmv", "sla_breach_count")


def delivery_metrics(curated: DataFrame, exact_percentiles: bool = False) -> DataFrame:
    """Hourly delivery KPIs by date, hour, city and zone."""
    p = exact_percentiles
    out = curated.groupBy(F.col("order_date").alias("metric_date"), F.col("order_hour").alias("metric_hour"), "city_id", "city_name", "zone_id", "zone_name").agg(
        F.count("*").alias("total_deliveries"),
        _if("is_completed").alias("completed_deliveries"),
        _if("is_cancelled").alias("failed_deliveries"),
        F.avg("actual_delivery_min").alias("avg_total_delivery_time"),
        *(_percentile("actual_delivery_min", q, p).alias(f"{n}_total_delivery_time") for n, q in (("median", 0.5), ("p90", 0.9), ("p99", 0.99))),
        _if("is_completed and not sla_breach").alias("sla_met_count"),
        _if("sla_breach").alias("sla_breach_count"),
        F.count_distinct("rider_id").alias("total_active_riders"),
        F.avg("order_rating").alias("avg_delivery_rating"),
        F.sum("delivery_fee").alias("total_delivery_cost"),
    )
    return out.withColumns({"completion_rate": ratio("completed_deliveries", "total_deliveries"), "sla_breach_rate": ratio("sla_breach_count", "completed_deliveries"), "avg_deliveries_per_rider": ratio("completed_deliveries", "total_active_riders"), "avg_cost_per_delivery": ratio("total_delivery_cost", "completed_deliveries")})


def delivery_stages(curated: DataFrame) -> DataFrame:
    """Hourly stage times, distances, rider supply, cancellations and breaches by cause, by date, hour, city and zone.

    A breach lies with the restaurant if the order waited longer to be picked up than it was under way, else with the
    rider. A rider is batched in an hour with more than one order. `curated` has delivery_distance_km.
    """
    keys = ["metric_date", "metric_hour", "city_id", "zone_id"]
    minutes = lambda a, b: (F.unix_timestamp(b) - F.unix_timestamp(a)) / 60.0
    rows = curated.withColumns({"metric_date": F.col("order_date"), "metric_hour": F.col("order_hour"), "waited": minutes("order_accepted_at", "order_picked_up_at"), "moved": minutes("order_picked_up_at", "order_delivered_at")})
    by_rider = rows.groupBy(*keys, "rider_id").agg(
        F.count("*").alias("n"),
        _if("is_completed").alias("done"),
        F.sum(minutes("order_placed_at", "order_accepted_at")).alias("accept"),
        F.count(minutes("order_placed_at", "order_accepted_at")).alias("accepts"),
        *(F.sum(c).alias(c) for c in ("waited", "moved")),
        *(F.count(c).alias(f"{c}_n") for c in ("waited", "moved")),
        F.sum("delivery_distance_km").alias("km"),
        F.count("delivery_distance_km").alias("km_n"),
        _if("sla_breach and waited > moved").alias("by_restaurant"),
        _if("sla_breach and not coalesce(waited > moved, false)").alias("by_rider"),
        _if("is_cancelled and order_accepted_at is not null").alias("cancelled_accepted"),
        _if("is_cancelled and order_picked_up_at is not null").alias("cancelled_picked"),
        F.count("order_rating").alias("rated"),
    )
    rider = F.col("rider_id").isNotNull()
    out = by_rider.groupBy(*keys).agg(
        F.sum("n").alias("total_deliveries"),
        F.sum("accept").alias("a"),
        F.sum("accepts").alias("an"),
        *(F.sum(c).alias(c) for c in ("waited", "waited_n", "moved", "moved_n", "km", "km_n")),
        F.sum("by_restaurant").alias("sla_breach_by_restaurant"),
        F.sum("by_rider").alias("sla_breach_by_rider"),
        F.sum("cancelled_accepted").alias("cancel_after_accept"),
        F.sum("cancelled_picked").alias("cancel_after_pickup"),
        F.sum("rated").alias("deliveries_with_rating"),
        F.count_if(rider).alias("total_active_riders"),
        F.count_if(rider & (F.col("done") > 0)).alias("riders_on_delivery"),
        F.count_if(rider & (F.col("n") > 1)).alias("riders_with_multi_order"),
        F.sum(F.when(rider & (F.col("n") > 1), F.col("n")).otherwise(0)).alias("batched_orders"),
    )
    made = {
        "avg_accept_time": ratio("a", "an"),
        "avg_pickup_time": ratio("waited", "waited_n"),
        "avg_transit_time": ratio("moved", "moved_n"),
        "avg_delivery_distance_km": ratio("km", "km_n"),
        "total_distance_covered_km": F.col("km").cast("double"),
        "avg_distance_per_rider_km": ratio("km", "total_active_riders"),
        "rider_utilization_rate": ratio("riders_on_delivery", "total_active_riders"),
        "batch_rate": ratio("batched_orders", "total_deliveries"),
        "avg_batch_size": ratio("batched_orders", "riders_with_multi_order"),
    }
    return out.withColumns(made).drop("a", "an", "waited", "waited_n", "moved", "moved_n", "km", "km_n")


def restaurant_details(curated: DataFrame, exact_percentiles: bool = False) -> DataFrame:
    """Daily money, times, customers, ratings and cancellations by restaurant, with its rank by rating in the city.

    A customer is new on the day of the first order, and repeats otherwise.
    """
    ready = (F.unix_timestamp("order_picked_up_at") - F.unix_timestamp("order_accepted_at")) / 60.0
    rows = curated.withColumns({"metric_date": F.col("order_date"), "preparation": ready})
    out = rows.groupBy("restaurant_id", "metric_date", "city_id").agg(
        _if("is_cancelled").alias("cancelled_orders"),
        F.sum("restaurant_payout").cast("decimal(14,2)").alias("net_revenue_to_restaurant"),
        F.sum("platform_commission").cast("decimal(14,2)").alias("platform_commission_paid"),
        F.sum("discount_amount").cast("decimal(14,2)").alias("total_discounts"),
        F.sum("item_count").alias("total_items_sold"),
        F.avg("preparation").alias("avg_preparation_time_min"),
        *(_percentile("preparation", q, exact_percentiles).alias(f"{n}_preparation_time_min") for n, q in (("median", 0.5), ("p90", 0.9))),
        F.avg("actual_delivery_min").alias("avg_delivery_time_min"),
        F.avg(F.unix_timestamp("order_accepted_at") - F.unix_timestamp("order_placed_at")).alias("avg_accept_time_sec"),
        _distinct(F.col("customer_id"), False).alias("unique_customers"),
        _distinct(_pick("is_first_order", "customer_id"), False).alias("new_customers"),
        _distinct(_pick("not is_first_order", "customer_id"), False).alias("repeat_customers"),
        F.avg("order_rating").alias("avg_order_rating"),
        F.count("order_rating").alias("total_ratings"),
        _if("order_rating = 5").alias("five_star_count"),
        _if("order_rating = 1").alias("one_star_count"),
        _if("order_rating <= 2").alias("negative_review_count"),
        *(_if(f"cancellation_source = '{c}'").alias(f"cancelled_by_{c}") for c in ("customer", "restaurant", "rider", "system")),
    )
    rank = F.rank().over(Window.partitionBy("metric_date", "city_id").orderBy(F.col("avg_order_rating").desc_nulls_last()))
    return out.withColumns({"repeat_customer_rate": ratio("repeat_customers", "unique_customers"), "city_rank_by_rating": rank})


def promo_rates(curated: DataFrame, distribution: DataFrame) -> DataFrame:
    """By coupon code its way from impression to completed order, with rates, costs and use per customer.

    `distribution` has coupon_code, total_impressions, total_distributed and total_applied; a code that only one side
    has keeps nulls for the other.
    """
    used = curated.where("coupon_code is not null and is_completed").groupBy("coupon_code", "customer_id")
    used = used.agg(F.count("*").alias("n"), F.sum("total_amount").alias("g"), F.sum("discount_amount").alias("d"), F.max("is_first_order").alias("new"), F.sum(_pick("is_first_order", "discount_amount")).alias("nd"))
    out = used.groupBy("coupon_code").agg(F.sum("n").alias("total_redeemed"), F.sum("g").cast("decimal(16,2)").alias("total_gmv"), F.sum("d").cast("decimal(16,2)").alias("total_discount_cost"), F.count("*").alias("unique_users_redeemed"), _if("new").alias("new_users_acquired"), F.sum("nd").alias("nd"))
    out = distribution.join(out, "coupon_code", "full")
    made = {
        "apply_rate": ratio("total_applied", "total_distributed"),
        "redemption_rate": ratio("total_redeemed", "total_distributed"),
        "conversion_rate": ratio("total_redeemed", "total_applied"),
        "avg_discount_per_order": ratio("total_discount_cost", "total_redeemed"),
        "discount_as_pct_of_gmv": ratio("total_discount_cost", "total_gmv") * 100,
        "customer_acquisition_cost": ratio("nd", "new_users_acquired"),
        "avg_uses_per_user": ratio("total_redeemed", "unique_users_redeemed"),
    }
    return out.withColumns(made).drop("nd")


def restaurant_performance(curated: DataFrame) -> DataFrame:
    """Daily metrics by restaurant, its most ordered first item, and its ranks in city and zone by value and orders."""
    keys = ["restaurant_id", "metric_date", "city_id", "zone_id"]
    rows = curated.withColumn("metric_date", F.col("order_date"))
    day = rows.groupBy(*keys).agg(
        F.count("*").alias("total_orders"),
        _if("is_completed").alias("completed_orders"),
        F.sum("total_amount").alias("gross_merchandise_value"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.avg("order_rating").alias("avg_order_rating"),
        _if("sla_breach").alias("sla_breach_count"),
    )
    items = rows.groupBy(*keys, "first_item_id").agg(F.count("*").alias("n"))
    top = items.groupBy(*keys).agg(F.max_by("first_item_id", F.struct(F.col("n"), -F.col("first_item_id"))).alias("top_item_id"))
    out = day.join(top, keys)
    for area in ("city", "zone"):
        for by, c in (("gmv", "gross_merchandise_value"), ("orders", "total_orders")):
            w = Window.partitionBy("metric_date", f"{area}_id").orderBy(F.col(c).desc())
            out = out.withColumn(f"{area}_rank_by_{by}", F.rank().over(w))
    return out.withColumns({"avg_order_value": ratio("gross_merchandise_value", "total_orders"), "completion_rate": ratio("completed_orders", "total_orders"), "sla_breach_rate": ratio("sla_breach_count", "completed_orders")})


def user_cohorts(curated: DataFrame, as_of: str | list[str]) -> DataFrame:
    """One row per customer as of a date, or of each of some dates: cohort, activity by month, value, recency, favourites.

    Orders are aggregated once, by customer, restaurant, cuisine and date; all else are windows and one aggregation
    over that on one partitioning by customer.
    """
    days = [as_of] if isinstance(as_of, str) else as_of
    day = F.col("snapshot_date")
    base = curated.where(F.col("order_date") <= F.lit(max(days)).cast("date")).groupBy("customer_id", "restaurant_id", "cuisine_primary", "order_date")
    base = base.agg(F.count("*").alias("n"), F.sum("total_amount").alias("gmv"), F.max("is_pro_member").alias("pro"), F.max("user_segment").alias("segment"))
    rows = base.withColumn("snapshot_date", F.explode(F.array(*(F.lit(d).cast("date") for d in days)))).where(F.col("order_date") <= day)
    keys = ["snapshot_date", "customer_id"]
    # One sort serves three of the windows, another the fourth and the aggregation; each sort of a task holds its rows.
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "restaurant_id", "order_date", "cuisine_primary")
    rows = rows.withColumn("first_order_date", F.min("order_date").over(Window.partitionBy(*keys)))
    rows = rows.withColumn("of_restaurant", F.sum("n").over(Window.partitionBy(*keys, "restaurant_id")))
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*keys, "restaurant_id").orderBy("order_date", "cuisine_primary")))
    rows = rows.withColumn("of_cuisine", F.sum("n").over(Window.partitionBy(*keys, "cuisine_primary")))
    month = F.floor(F.months_between(F.date_trunc("month", "order_date"), F.date_trunc("month", "first_order_date"))).cast("int")
    out = rows.withColumn("month_no", month).groupBy(*keys).agg(
        F.min("first_order_date").alias("first_order_date"),
        *(F.max(F.col("month_no") == m).alias(f"has_order_m{m}") for m in (0, 1, 2, 3, 6, 12)),
        F.sum("n").alias("lifetime_order_count"),
        F.sum("gmv").cast("decimal(22,2)").alias("lifetime_gmv"),
        F.max("order_date").alias("last_order_date"),
        F.max("pro").alias("is_pro_member"),
        F.max("segment").alias("user_segment"),
        F.sum(F.col("n") * F.col("of_restaurant")).alias("squares"),  # the squares of restaurants' counts, row by row
        F.count_if(F.col("nth") == 1).alias("distinct_restaurants"),
        F.max_by("cuisine_primary", F.struct("of_cuisine", "cuisine_primary")).alias("preferred_cuisine"),
    )
    idle, total = F.datediff(day, F.col("last_order_date")), F.col("lifetime_order_count")
    stage = F.when(idle > 180, "churned").when(idle > 60, "dormant").when(total == 1, "new").otherwise("active")
    return out.withColumns({"cohort_month": F.date_format("first_order_date", "yyyy-MM"), "days_since_last_order": idle, "lifecycle_stage": stage, "avg_order_value": ratio("lifetime_gmv", "lifetime_order_count"), "restaurant_concentration": F.col("squares") / (total * total)}).drop("squares")


def user_activity(curated: DataFrame) -> DataFrame:
    """Daily activity by customer with the most used platform (the last by name among equals)."""
    keys = ["customer_id", "order_date"]
    day = curated.groupBy(*keys).agg(F.count("*").alias("orders"), _if("is_completed").alias("completed_orders"), F.sum("total_amount").alias("spend"), F.sum("discount_amount").alias("discounts"), F.count_distinct("restaurant_id").alias("restaurants"), F.min("order_placed_at").alias("first_order_at"), F.max("order_placed_at").alias("last_order_at"))
    used = curated.groupBy(*keys, "platform").agg(F.count("*").alias("n")).groupBy(*keys).agg(F.max_by("platform", F.struct("n", "platform")).alias("main_platform"))
    return day.join(used, keys)


def promo_effect(curated: DataFrame, days: tuple[int, ...] = (7, 14, 30)) -> DataFrame:
    """By coupon code: use, cost, value, new customers, and customers who ordered again within some days.

    The next order of the same customer is one lead() away, so no self-join is needed.
    """
    w = Window.partitionBy("customer_id").orderBy("order_placed_at", "order_id")
    rows = curated.withColumn("again", F.lead("order_date").over(w)).where("coupon_code is not null")
    gap = F.datediff("again", "order_date")
    out = rows.groupBy("coupon_code").agg(
        F.count("*").alias("redemptions"), F.sum("total_amount").alias("gross_value"), F.sum("discount_amount").alias("discount_cost"), F.count_distinct("customer_id").alias("promo_users"), _if("is_first_order").alias("new_user_orders"), *(F.count_if(gap <= d).alias(f"repeat_within_{d}d") for d in days)
    )
    return out.withColumns({"roi": ratio(F.col("gross_value") - F.col("discount_cost"), "discount_cost"), "cost_per_order": ratio("discount_cost", "redemptions")})


def promo_lift(curated: DataFrame) -> DataFrame:
    """By city: average order value with and without a coupon and its lift in percent."""
    out = curated.groupBy("city_name").agg(*(X for n, c in (("with", "coupon_code is not null"), ("without", "coupon_code is null")) for X in (_if(c).alias(f"orders_{n}"), F.sum(_pick(c, "total_amount")).alias(f"gmv_{n}"))))
    out = out.withColumns({"aov_with": ratio("gmv_with", "orders_with"), "aov_without": ratio("gmv_without", "orders_without")})
    return out.withColumn("lift_pct", growth("aov_with", "aov_without"))


def restaurant_rolling(curated: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Per restaurant the metrics of the last `days` days, with ranks in the city."""
    day = F.lit(as_of).cast("date")
    rows = curated.where((F.col("order_date") > F.date_sub(day, days)) & (F.col("order_date") <= day))
    out = rows.groupBy("restaurant_id", "restaurant_name", "city_id", "city_name", "zone_name", "cuisine_primary").agg(
        F.count("*").alias("total_orders_30d"),
        _if("is_completed").alias("completed_orders_30d"),
        _if("is_cancelled").alias("cancelled_orders_30d"),
        F.sum("total_amount").alias("gmv_30d"),
        F.count_distinct("customer_id").alias("unique_customers_30d"),
        F.count_distinct(_pick("not is_first_order", "customer_id")).alias("repeat_customers_30d"),
        _if("sla_breach").alias("sla_breaches_30d"),
        F.max("restaurant_rating").alias("overall_rating"),
    )
    out = out.withColumns({"completion_rate_30d": ratio("completed_orders_30d", "total_orders_30d"), "repeat_customer_rate_30d": ratio("repeat_customers_30d", "unique_customers_30d"), "sla_breach_rate_30d": ratio("sla_breaches_30d", "completed_orders_30d"), "avg_order_value_30d": ratio("gmv_30d", "total_orders_30d")})
    for by, c in (("orders", "total_orders_30d"), ("gmv", "gmv_30d"), ("rating", "overall_rating")):
        out = out.withColumn(f"city_rank_by_{by}", F.rank().over(Window.partitionBy("city_id").orderBy(F.col(c).desc())))
    return out

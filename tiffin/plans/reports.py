"""Reports over the gold tables; every report takes the tables it reads and the date that stands for today."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiffin.functions.expr import growth, health_score, ladder, pct, ratio


def _day(as_of: str, back: int = 0):
    return F.date_sub(F.lit(as_of).cast("date"), back)


def _mean(value: str):
    """A mean that does not depend on the order of the rows, as sums of doubles do: of decimals of twelve places."""
    return F.avg(F.col(value).cast("decimal(24,12)"))


def _rounded(value, places: int):
    """Rounded half up, where a value within 1e-9 of a half is that half: what double or decimal division lost is no matter."""
    return F.round(F.round(value, 9), places).cast("double")


def city_days(daily: DataFrame) -> DataFrame:
    """The daily metrics by city."""
    total = ("total_orders", "completed_orders", "gross_merchandise_value", "net_revenue", "total_discount_given", "platform_commission", "unique_customers", "new_customers", "active_restaurants", "active_riders", "sla_breach_count", "pro_member_gmv")
    return daily.groupBy("metric_date", "city_id", "city_name").agg(*(F.sum(c).alias(c) for c in total), F.avg("avg_delivery_time_min").alias("avg_delivery_time"), F.avg("avg_order_rating").alias("avg_rating"))


def daily_gmv(daily: DataFrame, as_of: str) -> DataFrame:
    """Value by city on a day, against the day before and the mean of the seven days before, from one aggregation."""
    days = city_days(daily.where(F.col("metric_date").between(_day(as_of, 7), _day(as_of))))
    today, before = F.col("metric_date") == _day(as_of), F.col("metric_date") == _day(as_of, 1)
    pick = lambda c, when: F.max(F.when(when, F.col(c)))
    names = ("total_orders", "completed_orders", "gross_merchandise_value", "net_revenue", "total_discount_given", "unique_customers", "new_customers", "platform_commission", "avg_delivery_time")
    out = days.groupBy("city_id", "city_name").agg(
        *(pick(c, today).alias(c) for c in names),
        pick("gross_merchandise_value", before).alias("gmv_prev"),
        pick("total_orders", before).alias("orders_prev"),
        F.avg(F.when(~today, F.col("gross_merchandise_value").cast("double"))).alias("gmv_week"),
    )
    gmv = F.col("gross_merchandise_value")
    return out.where("total_orders is not null").select(
        _day(as_of).alias("metric_date"),
        "city_name",
        "total_orders",
        "completed_orders",
        gmv.cast("double").alias("gmv"),
        F.col("net_revenue").cast("double").alias("net_revenue"),
        "unique_customers",
        "new_customers",
        ratio("completed_orders", "total_orders", 6).alias("completion_rate"),
        F.round("avg_delivery_time", 4).alias("avg_delivery_time"),
        growth(gmv, "gmv_prev").alias("gmv_dod_change_pct"),
        growth("total_orders", "orders_prev").alias("orders_dod_change_pct"),
        growth(gmv, "gmv_week").alias("gmv_vs_weekly_avg_pct"),
        pct("total_discount_given", gmv).alias("discount_burn_rate_pct"),
        ratio("net_revenue", "completed_orders", 2).alias("revenue_per_order"),
        ratio("platform_commission", "completed_orders", 2).alias("commission_per_order"),
    )


def national(daily: DataFrame) -> DataFrame:
    """All cities together, by day."""
    out = daily.groupBy("metric_date").agg(*(F.sum(c).alias(c) for c in ("total_orders", "completed_orders", "gross_merchandise_value", "pro_member_gmv", "unique_customers")))
    return out.select("metric_date", F.lit("ALL").alias("scope"), "total_orders", "completed_orders", F.col("gross_merchandise_value").cast("double").alias("total_gmv"), "unique_customers", pct("pro_member_gmv", "gross_merchandise_value").alias("pro_gmv_share_pct"))


def city_scorecard(daily: DataFrame, as_of: str) -> DataFrame:
    """Thirty days by city against the thirty before, with ranks (over cities, so few rows) and a size tier."""
    days = city_days(daily.where(F.col("metric_date").between(_day(as_of, 60), _day(as_of))))
    now, week, past = F.col("metric_date") >= _day(as_of, 30), F.col("metric_date") >= _day(as_of, 7), F.col("metric_date") <= _day(as_of, 31)
    s = lambda c, when, n: F.sum(F.when(when, F.col(c))).alias(n)
    out = days.groupBy("city_id", "city_name").agg(
        s("total_orders", now, "orders_30d"),
        s("gross_merchandise_value", now, "gmv_30d"),
        s("net_revenue", now, "revenue_30d"),
        s("sla_breach_count", now, "breaches"),
        s("completed_orders", now, "completed"),
        s("gross_merchandise_value", week, "gmv_7d"),
        s("total_orders", past, "orders_prev"),
        s("gross_merchandise_value", past, "gmv_prev"),
        F.avg(F.when(now, F.col("avg_delivery_time"))).alias("delivery"),
        F.avg(F.when(now, ratio("total_orders", "active_riders"))).alias("per_rider"),
    )
    rank = lambda c: F.rank().over(Window.orderBy(c))
    return out.where("orders_30d is not null").select(
        "city_name",
        "orders_30d",
        F.col("gmv_30d").cast("double").alias("gmv_30d"),
        F.col("gmv_7d").cast("double").alias("gmv_last_7d"),
        growth("gmv_30d", "gmv_prev").alias("gmv_mom_growth_pct"),
        growth("orders_30d", "orders_prev").alias("orders_mom_growth_pct"),
        ratio("gmv_30d", "orders_30d", 2).alias("aov_30d"),
        ratio("revenue_30d", "orders_30d", 2).alias("revenue_per_order"),
        F.round("delivery", 1).alias("avg_delivery_time_min"),
        F.round("per_rider", 1).alias("avg_orders_per_rider"),
        pct("breaches", "completed").alias("sla_breach_rate_pct"),
        rank(F.col("gmv_30d").desc()).alias("rank_by_gmv"),
        rank(F.col("orders_30d").desc()).alias("rank_by_orders"),
        ladder((F.col("orders_30d") >= 5_000_000, "Tier 1"), (F.col("orders_30d") >= 1_000_000, "Tier 2"), (F.col("orders_30d") >= 200_000, "Tier 3"), otherwise="Tier 4").alias("city_tier"),
    )


def _mean_double(value: str):
    """The mean of doubles below 10^8, as a double: added up as decimals that hold all their digits, in whatever order."""
    return F.avg(F.col(value).cast("decimal(28,20)")).cast("double")


def _rounded_double(value, places: int):
    """Rounded as SQL engines round doubles: the product with the power of ten, half away from zero, with the value's sign."""
    size = F.round(F.abs(value) * 10.0**places) / 10.0**places
    return F.when(value < 0, -size).otherwise(size)


def delivery_hourly(delivery: DataFrame, as_of: str) -> DataFrame:
    """A day's hourly deliveries by zone against the same hour of the day before and of the week before, by city.

    Differences are taken and rounded as doubles, so one that is a half in decimals falls to where its double lies.
    """
    rows = delivery.where(F.col("metric_date").between(_day(as_of, 7), _day(as_of)))
    hours = rows.where(F.col("metric_date") < _day(as_of)).groupBy("metric_date", "metric_hour", "city_id").agg(F.sum("total_deliveries").alias("n"), _mean_double("avg_total_delivery_time").alias("t"), _mean_double("sla_breach_rate").alias("b"))
    before = F.col("metric_date") == _day(as_of, 1)
    base = hours.groupBy("metric_hour", "city_id").agg(*(F.max(F.when(before, F.col(c))).alias(f"{c}_prev") for c in "ntb"), F.avg("n").alias("n_week"), _mean_double("t").alias("t_week"))
    out = rows.where(F.col("metric_date") == _day(as_of)).join(base, ["metric_hour", "city_id"], "left")
    time, rate, n = F.col("avg_total_delivery_time"), F.col("sla_breach_rate"), F.col("total_deliveries")
    change = lambda then: _rounded_double(ratio(n - F.col(then), then) * 100, 1)
    return out.select(
        "metric_date",
        "metric_hour",
        "city_name",
        "zone_name",
        "total_deliveries",
        "completed_deliveries",
        _rounded_double(time, 1).alias("avg_delivery_min"),
        _rounded_double(rate * 100, 2).alias("sla_breach_pct"),
        change("n_prev").alias("deliveries_dod_pct"),
        _rounded_double(time - F.col("t_prev"), 1).alias("delivery_time_dod_delta"),
        _rounded_double((rate - F.col("b_prev")) * 100, 2).alias("sla_breach_dod_delta_pp"),
        change("n_week").alias("deliveries_vs_weekly_pct"),
        _rounded_double(time - F.col("t_week"), 1).alias("delivery_time_vs_weekly_delta"),
        ladder((rate > 0.2, "CRITICAL_SLA"), (rate > 0.15, "HIGH_SLA"), (time > 45, "SLOW_DELIVERY"), otherwise="NORMAL").alias("ops_alert"),
    )


def delivery_daily(delivery: DataFrame) -> DataFrame:
    out = delivery.groupBy("metric_date", "city_name").agg(F.sum("total_deliveries").alias("total_deliveries"), F.sum("completed_deliveries").alias("completed_deliveries"), _rounded(_mean("avg_total_delivery_time"), 1).alias("avg_delivery_min"), F.sum("sla_breach_count").alias("b"), F.sum("total_delivery_cost").alias("c"), _rounded(_mean("avg_delivery_rating"), 2).alias("avg_rating"))
    return out.withColumns({"overall_sla_breach_pct": pct("b", "total_deliveries"), "cost_per_delivery": ratio("c", "completed_deliveries", 2)}).drop("b", "c")


def restaurant_scorecard(rolling: DataFrame, performance: DataFrame, as_of: str) -> DataFrame:
    """Restaurants against their peers of city and cuisine, the last day against seven rows before, and a health score."""
    of = Window.partitionBy("city_id", "cuisine_primary")
    value = F.col("gmv_30d").cast("double")
    peers = {"peer_orders": F.avg("total_orders_30d"), "peer_gmv": F.avg(value), "peer_rating": F.avg("overall_rating"), "peer_gmv_p75": F.percentile(value, F.lit(0.75))}
    w = Window.partitionBy("restaurant_id").orderBy("metric_date")
    trend = performance.where(F.col("metric_date") > _day(as_of, 30)).withColumns({"gmv_7": F.lag("gross_merchandise_value", 7).over(w), "last": F.max("metric_date").over(Window.partitionBy("restaurant_id"))})
    trend = trend.where("metric_date = last").select("restaurant_id", growth("gross_merchandise_value", "gmv_7", 1).alias("gmv_wow_change_pct"))
    out = rolling.withColumns({n: c.over(of) for n, c in peers.items()}).join(trend, "restaurant_id", "left")
    flag = ladder((F.col("sla_breach_rate_30d") > 0.15, "HIGH_SLA_BREACH"), (F.col("overall_rating") < 3.5, "LOW_RATING"), otherwise="HEALTHY")
    return out.select(
        "restaurant_id",
        "city_name",
        "cuisine_primary",
        "total_orders_30d",
        F.col("gmv_30d").cast("double").alias("gmv_30d"),
        "city_rank_by_gmv",
        growth("total_orders_30d", "peer_orders", 1).alias("orders_vs_peer_pct"),
        growth("gmv_30d", "peer_gmv", 1).alias("gmv_vs_peer_pct"),
        F.round(F.col("overall_rating") - F.col("peer_rating"), 2).alias("rating_vs_peer"),
        F.round("peer_gmv_p75", 2).alias("peer_gmv_p75"),
        "gmv_wow_change_pct",
        health_score(F.col("completion_rate_30d"), F.col("overall_rating"), F.col("repeat_customer_rate_30d"), F.col("sla_breach_rate_30d")).alias("health_score"),
        flag.alias("primary_flag"),
    )


def retention_matrix(cohorts: DataFrame) -> DataFrame:
    latest = cohorts.join(cohorts.agg(F.max("snapshot_date").alias("snapshot_date")), "snapshot_date", "left_semi")
    out = latest.groupBy("cohort_month").agg(F.count_distinct("customer_id").alias("cohort_size"), *(F.count_distinct(F.when(F.col(f"has_order_m{m}"), F.col("customer_id"))).alias(f"active_m{m}") for m in (0, 1, 2, 3, 6, 12)))
    return out.withColumns({f"retention_m{m}_pct": pct(f"active_m{m}", "active_m0") for m in (1, 2, 3, 6, 12)})


def segment_ltv(cohorts: DataFrame) -> DataFrame:
    out = cohorts.groupBy("user_segment", "lifecycle_stage").agg(F.count_distinct("customer_id").alias("user_count"), F.round(F.avg("lifetime_order_count"), 1).alias("avg_lifetime_orders"), F.sum("lifetime_gmv").alias("g"), F.round(F.avg("distinct_restaurants"), 1).alias("avg_distinct_restaurants"), F.count_distinct(F.when(F.col("is_pro_member"), F.col("customer_id"))).alias("pro_member_count"))
    return out.withColumns({"avg_lifetime_gmv": ratio("g", "user_count", 2), "pro_penetration_pct": pct("pro_member_count", "user_count")}).drop("g")


def churn_list(cohorts: DataFrame, churn_probability: str, ltv: str, limit: int = 10_000) -> DataFrame:
    """The customers with the most value at risk; model scores are columns of the input."""
    score = F.round(F.col(churn_probability) * F.col(ltv), 2)
    rows = cohorts.where((F.col("lifecycle_stage") != "churned") & (F.col(churn_probability) >= 0.5) & (F.col(ltv) > 500))
    return rows.select("customer_id", "cohort_month", "user_segment", "lifecycle_stage", "days_since_last_order", "lifetime_order_count", score.alias("intervention_priority_score")).orderBy(F.col("intervention_priority_score").desc(), "customer_id").limit(limit)


def reactivation_list(cohorts: DataFrame, low: int, high: int, least_orders: int, limit: int = 10_000) -> DataFrame:
    rows = cohorts.where(F.col("days_since_last_order").between(low, high) & (F.col("lifetime_order_count") >= least_orders))
    return rows.select("customer_id", "lifetime_order_count", F.col("lifetime_gmv").cast("double").alias("lifetime_gmv"), "days_since_last_order", "preferred_cuisine").orderBy(F.col("lifetime_gmv").desc(), "customer_id").limit(limit)


def retention_trend(snapshots: DataFrame) -> DataFrame:
    """By snapshot (snapshot_date, customer_id, lifecycle_stage): shares and the change from the snapshot before."""
    out = snapshots.groupBy("snapshot_date").agg(F.count_distinct("customer_id").alias("total_users"), F.count_distinct(F.when(F.col("lifecycle_stage") == "active", F.col("customer_id"))).alias("retained"), F.count_distinct(F.when(F.col("lifecycle_stage") == "churned", F.col("customer_id"))).alias("churned"))
    share = ratio("retained", "total_users") * 100
    return out.select("snapshot_date", "total_users", F.round(share, 2).alias("m1_retention_pct"), "churned", pct("churned", "total_users").alias("churn_rate_pct"), F.round(share - F.lag(share).over(Window.orderBy("snapshot_date")), 2).alias("retention_wow_delta_pp"))


def order_funnel(curated: DataFrame) -> DataFrame:
    out = curated.groupBy(F.date_trunc("hour", "order_placed_at").alias("hour_bucket")).agg(F.count("*").alias("orders_placed"), *(F.count(f"order_{c}_at").alias(f"orders_{c}") for c in ("accepted", "picked_up", "delivered", "cancelled")), F.round(F.avg("actual_delivery_min"), 1).alias("avg_delivery_min"))
    return out.withColumn("delivery_rate_pct", pct("orders_delivered", "orders_placed"))


def cannibalization(curated: DataFrame, as_of: str, fresh: int = 30, span: int = 90) -> DataFrame:
    """Zones with new restaurants: orders of the others in the 30 days before, and of both in the 30 days after.

    A zone with several new restaurants counts its orders once for each of them. Only the days that can count are
    read, and they are counted by restaurant and day before any join.
    """
    rows = curated.where(F.col("order_date") >= _day(as_of, max(span, fresh + 30))).groupBy("restaurant_id", "city_id", "zone_id", "order_date").agg(F.count("*").alias("n"))
    first = rows.where(F.col("order_date") >= _day(as_of, span)).groupBy("restaurant_id", "city_id", "zone_id").agg(F.min("order_date").alias("opened"))
    new = first.where(F.col("opened") >= _day(as_of, fresh))
    ids = new.select("restaurant_id").distinct().withColumn("is_new", F.lit(True))
    pairs = rows.join(ids, "restaurant_id", "left").join(new.select("city_id", "zone_id", "opened"), ["city_id", "zone_id"])
    old, gap = F.col("is_new").isNull(), F.datediff("order_date", "opened")
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0))
    out = pairs.groupBy("zone_id", "city_id").agg(total(old & gap.between(-30, -1)).alias("existing_orders_before"), total(old & gap.between(0, 30)).alias("existing_orders_after"), total(~old & gap.between(0, 30)).alias("new_restaurant_orders"))
    return out.where("existing_orders_before > 0").withColumns({"existing_order_change_pct": growth("existing_orders_after", "existing_orders_before"), "new_restaurant_share_pct": pct("new_restaurant_orders", F.col("existing_orders_after") + F.col("new_restaurant_orders"))})


def peak_capacity(curated: DataFrame, least: float = 1.0) -> DataFrame:
    hours = curated.where("is_completed and is_peak_hour").groupBy("city_name", "zone_name", "order_date", "order_hour").agg(F.count("*").alias("n"), F.count_distinct("rider_id").alias("riders"), F.avg("actual_delivery_min").alias("t"), F.percentile("actual_delivery_min", F.lit(0.9)).alias("p90"))
    use = ratio("n", "riders")
    out = hours.groupBy("city_name", "zone_name").agg(F.round(F.avg("n"), 4).alias("avg_peak_orders"), F.round(F.avg("riders"), 4).alias("avg_peak_riders"), F.avg(use).alias("u"), F.max(use).alias("max_utilization"), F.round(F.avg("t"), 3).alias("avg_delivery_min"), F.round(F.avg("p90"), 3).alias("avg_p90_delivery"))
    u = F.col("u")
    return out.where(u >= least).withColumns({"avg_utilization": F.round(u, 4), "capacity_status": ladder((u >= 4, "CRITICAL"), (u >= 3, "HIGH"), (u >= 2, "MODERATE"), otherwise="LOW")}).drop("u")


def cuisine_trend(curated: DataFrame, least: int = 10) -> DataFrame:
    """First and last month of each city and cuisine: max_by and min_by need no window."""
    months = curated.where("is_completed and cuisine_primary is not null").groupBy("city_name", "cuisine_primary", F.to_date(F.date_trunc("month", "order_date")).alias("m")).agg(F.count("*").alias("n"), F.sum("total_amount").alias("g"))
    out = months.groupBy("city_name", "cuisine_primary").agg(F.sum("n").alias("total_orders"), F.sum("g").cast("double").alias("total_gmv"), F.min_by("n", "m").alias("earliest_month_orders"), F.max_by("n", "m").alias("latest_month_orders"))
    a, b = F.col("earliest_month_orders"), F.col("latest_month_orders")
    return out.where(F.col("total_orders") >= least).withColumns({"growth_pct": growth(b, a), "trend": ladder((b > a * 1.5, "RISING"), (b < a * 0.7, "DECLINING"), otherwise="STABLE")})

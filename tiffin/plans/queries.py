"""Named queries: library operators bound to the driver's tables, each with independent SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.operators import curated as C
from tiffin.operators import gold as G
from tiffin.plans import binding as B
from tiffin.plans import reports as R

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

_RAW = f"""
lines as (select l_orderkey, count(*) as item_count, min(l_suppkey) as restaurant_id, min(l_partkey) as first_item_id from lineitem group by 1),
raw0 as (
  select o_orderkey as order_id, o_custkey as customer_id, restaurant_id, item_count, first_item_id, o_orderkey % 4 as r4, 20 + o_orderkey % 50 as mins,
    case o_orderstatus when 'F' then 'delivered' when 'P' then 'cancelled' else 'placed' end as order_status,
    case o_orderkey % 3 when 0 then 'delivery' when 1 then 'pickup' else 'dine_in' end as order_type,
    case o_orderpriority when '1-URGENT' then 'upi' when '2-HIGH' then 'credit_card' when '3-MEDIUM' then 'cod' when '5-LOW' then 'debit_card' else 'wallet' end as payment_method,
    case o_orderkey % 3 when 0 then 'android' when 1 then 'ios' else 'web' end as platform,
    o_totalprice::decimal(12,2) as total_amount, case when o_orderkey % 5 = 0 then 'C' || (o_orderkey % 7) end as coupon_code,
    o_orderdate::timestamp + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 60) as order_placed_at
  from orders left join lines on o_orderkey = l_orderkey),
raw as (
  select *, case when coupon_code is null then 0 else total_amount * 0.1 end::decimal(12,2) as discount_amount, (total_amount * 0.05)::decimal(12,2) as tax_amount,
    30::decimal(12,2) as delivery_fee,
    case when order_status <> 'placed' then order_placed_at + interval 2 minutes end as order_accepted_at,
    case when order_status = 'delivered' then order_placed_at + interval 12 minutes end as order_picked_up_at,
    case when order_status = 'delivered' then order_placed_at + to_minutes(mins) end as order_delivered_at,
    case when order_status = 'cancelled' then order_placed_at + interval 5 minutes end as order_cancelled_at,
    case when order_status = 'cancelled' then case r4 when 0 then 'customer' when 1 then 'restaurant' when 2 then 'rider' else 'system' end end as cancellation_source,
    case when order_status = 'delivered' then mins end as actual_delivery_min,
    case when order_status = 'delivered' then order_id % 97 end as rider_id,
    case when order_status = 'delivered' and order_id % 2 = 0 then 1 + order_id % 5 end as order_rating
  from raw0),
zone as (select n_nationkey as zone_id, n_name as zone_name, r_regionkey as city_id, r_name as city_name from nation join region on n_regionkey = r_regionkey),
rest as (
  select s_suppkey as restaurant_id, s_name as restaurant_name, z.*, (0.15 + 0.05 * (s_suppkey % 3))::decimal(5,4) as rate, (1 + s_suppkey % 5)::double as restaurant_rating,
    case s_suppkey % 4 when 0 then 'north' when 1 then 'south' when 2 then 'east' else 'west' end as cuisine_primary
  from supplier join zone z on s_nationkey = zone_id),
usr as (select c_custkey as user_id, c_mktsegment as user_segment, c_mktsegment = 'BUILDING' as is_pro_member, c_acctbal::decimal(12,2) as balance, z.* from customer join zone z on c_nationkey = zone_id),
cur as (
  select r.* exclude (r4, mins), e.restaurant_name, e.zone_id, e.zone_name, e.city_id, e.city_name, e.restaurant_rating, e.cuisine_primary, u.user_segment, coalesce(u.is_pro_member, false) as is_pro_member,
    order_status = 'delivered' as is_completed, order_status = 'cancelled' as is_cancelled, actual_delivery_min > 45 as sla_breach,
    (total_amount * coalesce(rate, 0.2))::decimal(12,2) as platform_commission,
    (total_amount - discount_amount - total_amount * (1 - coalesce(rate, 0.2)))::decimal(12,2) as net_revenue,
    case when coupon_code is null or discount_amount = 0 then null when discount_amount <= 100 then 'flat' when discount_amount::double / (total_amount - tax_amount - 30)::double < 0.5 then 'percentage' else 'flat' end as coupon_type,
    order_placed_at::date = (min(order_placed_at) over (partition by customer_id))::date as is_first_order,
    order_placed_at::date as order_date, hour(order_placed_at) as order_hour, isodow(order_placed_at) in (6, 7) as is_weekend,
    hour(order_placed_at) in (12, 13, 14, 19, 20, 21, 22) as is_peak_hour
  from raw r left join rest e using (restaurant_id) left join usr u on customer_id = user_id),
c as (select * from cur where restaurant_id is not null and total_amount > 0 and total_amount < 1000000 and item_count between 1 and 100)"""

_DAILY = """,
d as (
  select order_date as metric_date, city_id, city_name, zone_id, zone_name, is_weekend as weekend_flag, count(*) as total_orders,
    count(*) filter (is_completed) as completed_orders, count(*) filter (is_cancelled) as cancelled_orders,
    count(*) filter (is_first_order) as first_time_orders, count(*) filter (not is_first_order) as repeat_orders,
    count(*) filter (payment_method in ('credit_card', 'debit_card')) as card_orders, count(*) filter (payment_method = 'upi') as upi_orders,
    count(*) filter (order_type = 'pickup') as pickup_orders, count(*) filter (sla_breach) as sla_breach_count,
    count(*) filter (cancellation_source = 'rider') as rider_cancellations, count(*) filter (cancellation_source = 'system') as system_cancellations,
    count(*) filter (is_pro_member) as pro_member_orders, count(*) filter (is_peak_hour) as peak_hour_orders,
    count(order_rating) as orders_with_rating, count(*) filter (order_rating <= 2) as negative_feedback_count,
    sum(total_amount) as gmv, sum(net_revenue) as rev, sum(discount_amount) as disc, sum(delivery_fee) as fee, sum(tax_amount) as tax, sum(platform_commission) as com,
    sum(total_amount) filter (is_pro_member) as pro_gmv, quantile_cont(total_amount::double, 0.5) as median_order_value, quantile_cont(total_amount::double, 0.9) as p90_order_value,
    avg(actual_delivery_min) as avg_delivery_time_min, quantile_cont(actual_delivery_min::double, 0.9) as p90_delivery_time_min,
    avg(epoch(order_delivered_at - order_picked_up_at) / 60.0) as avg_pickup_to_deliver_min, avg(order_rating) as avg_order_rating,
    count(distinct restaurant_id) filter (is_completed) as active_restaurants, count(distinct rider_id) as active_riders, count(distinct customer_id) as unique_customers,
    count(distinct customer_id) filter (is_first_order) as new_customers, count(distinct customer_id) filter (not is_first_order) as returning_customers
  from c group by all)"""


def _register(name: str, sql: str | None, prelude: str = ""):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = f"with {prelude.strip()}\n{sql}" if prelude else sql
        return f

    return keep


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.curate_orders(B.raw_orders(spark, sf_dir), B.restaurants(spark, sf_dir), B.users(spark, sf_dir), max_total=1_000_000, earliest="1990-01-01")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.daily_order_metrics(curated(spark, sf_dir), exact_percentiles=True)


@_register("q_curated_orders", "select order_id, customer_id, restaurant_id, city_name, zone_name, order_status, coupon_type, platform_commission::double as platform_commission, net_revenue::double as net_revenue, sla_breach, cancellation_source, is_first_order, is_pro_member, order_date, order_hour::int as order_hour, is_weekend, is_peak_hour from c", _RAW)
def _(s, d):
    return curated(s, d).select("order_id", "customer_id", "restaurant_id", "city_name", "zone_name", "order_status", "coupon_type", F.col("platform_commission").cast("double"), F.col("net_revenue").cast("double"), "sla_breach", "cancellation_source", "is_first_order", "is_pro_member", "order_date", "order_hour", "is_weekend", "is_peak_hour")


@_register(
    "q_gold_daily",
    """select metric_date, city_name, zone_name, weekend_flag, total_orders, completed_orders, cancelled_orders, first_time_orders, card_orders, upi_orders, pickup_orders, sla_breach_count,
  rider_cancellations, system_cancellations, pro_member_orders, peak_hour_orders, orders_with_rating, negative_feedback_count, gmv::double as gmv, rev::double as net_revenue, disc::double as discounts,
  tax::double as tax, pro_gmv::double as pro_member_gmv, median_order_value, p90_order_value, avg_delivery_time_min, p90_delivery_time_min, round(avg_pickup_to_deliver_min, 4) as avg_pickup_to_deliver_min,
  avg_order_rating, active_restaurants, active_riders, unique_customers, new_customers, returning_customers, completed_orders::double / total_orders as completion_rate,
  sla_breach_count::double / nullif(completed_orders, 0) as sla_breach_rate, gmv::double / total_orders as avg_order_value from d""",
    _RAW + _DAILY,
)
def _(s, d):
    money = {"gmv": "gross_merchandise_value", "net_revenue": "net_revenue", "discounts": "total_discount_given", "tax": "total_tax_collected", "pro_member_gmv": "pro_member_gmv"}
    plain = "metric_date city_name zone_name weekend_flag total_orders completed_orders cancelled_orders first_time_orders card_orders upi_orders pickup_orders sla_breach_count rider_cancellations system_cancellations pro_member_orders peak_hour_orders orders_with_rating negative_feedback_count median_order_value p90_order_value avg_delivery_time_min p90_delivery_time_min avg_order_rating active_restaurants active_riders unique_customers new_customers returning_customers completion_rate sla_breach_rate avg_order_value"
    return daily(s, d).select(*plain.split(), F.round("avg_pickup_to_deliver_min", 4).alias("avg_pickup_to_deliver_min"), *(F.col(c).cast("double").alias(n) for n, c in money.items()))


def _rollup_sql(period: str, step: str, extra: str, keys: str) -> str:
    return f"""select p.period_start, p.city_name, {extra} p.total_orders::bigint as total_orders, p.completed_orders::bigint as completed_orders, p.gmv::double as gmv, p.uniq::bigint as unique_customers,
  p.ret::double / nullif(p.uniq, 0) as customer_retention_rate, round(p.t, 4) as avg_delivery_time_min, p.riders as active_riders, round((p.total_orders::double - q.o) / q.o * 100, 6) as order_growth_pct, round((p.gmv::double - q.g::double) / q.g::double * 100, 6) as gmv_growth_pct
from (select date_trunc('{period}', metric_date)::date as period_start, city_id, city_name, {keys} sum(total_orders) as total_orders, sum(completed_orders) as completed_orders, sum(gmv) as gmv, sum(unique_customers) as uniq, sum(returning_customers) as ret, avg(avg_delivery_time_min) as t, max(active_riders) as riders from d group by all) p
left join (select date_trunc('{period}', metric_date)::date as s, city_id, sum(total_orders) as o, sum(gmv) as g from d group by all) q on p.city_id = q.city_id and q.s = (p.period_start - interval {step})::date"""


def _period(df: DataFrame, *extra: str) -> DataFrame:
    return df.select("period_start", "city_name", *extra, "total_orders", "completed_orders", F.col("gross_merchandise_value").cast("double").alias("gmv"), "unique_customers", "customer_retention_rate", F.round("avg_delivery_time_min", 4).alias("avg_delivery_time_min"), "active_riders", "order_growth_pct", "gmv_growth_pct")


@_register("q_gold_weekly", _rollup_sql("week", "7 days", "p.iso_week::int as iso_week, p.iso_year::int as iso_year,", "week(metric_date) as iso_week, year(metric_date) as iso_year,"), _RAW + _DAILY)
def _(s, d):
    return _period(G.period_rollup(daily(s, d), "week"), "iso_week", "iso_year")


@_register("q_gold_monthly", _rollup_sql("month", "1 month", "last_day(p.period_start) as period_end,", ""), _RAW + _DAILY)
def _(s, d):
    return _period(G.period_rollup(daily(s, d), "month"), "period_end")


_DELIVERY = """,
dm as (select order_date as metric_date, order_hour as metric_hour, city_id, city_name, zone_id, zone_name, count(*) as n, count(*) filter (is_completed) as done, count(*) filter (is_cancelled) as failed,
  avg(actual_delivery_min) as t, quantile_cont(actual_delivery_min::double, 0.9) as p90, count(*) filter (sla_breach) as b, count(distinct rider_id) as riders, avg(order_rating) as rating, sum(delivery_fee) as fee from c group by all)"""


@_register("q_gold_delivery", "select metric_date, metric_hour::int as metric_hour, zone_name, n as total_deliveries, done as completed_deliveries, failed as failed_deliveries, t as avg_total_delivery_time, p90 as p90_total_delivery_time, b as sla_breach_count, riders as total_active_riders, b::double / nullif(done, 0) as sla_breach_rate, fee::double / nullif(done, 0) as avg_cost_per_delivery from dm", _RAW + _DELIVERY)
def _(s, d):
    return G.delivery_metrics(curated(s, d), True).select("metric_date", "metric_hour", "zone_name", "total_deliveries", "completed_deliveries", "failed_deliveries", "avg_total_delivery_time", "p90_total_delivery_time", "sla_breach_count", "total_active_riders", "sla_breach_rate", "avg_cost_per_delivery")


@_register(
    "q_gold_restaurant",
    """, p as (select restaurant_id, order_date as metric_date, city_id, zone_id, count(*) as total_orders, count(*) filter (is_completed) as completed_orders, sum(total_amount) as g, count(distinct customer_id) as unique_customers from c group by all),
i as (select restaurant_id, order_date as metric_date, first_item_id, row_number() over (partition by restaurant_id, order_date order by count(*) desc, first_item_id) as rn from c group by restaurant_id, order_date, first_item_id)
select p.restaurant_id, p.metric_date, total_orders, completed_orders, g::double as gmv, unique_customers, i.first_item_id as top_item_id, g::double / total_orders as avg_order_value,
  (rank() over (partition by p.metric_date, city_id order by g desc))::int as city_rank_by_gmv, (rank() over (partition by p.metric_date, zone_id order by total_orders desc))::int as zone_rank_by_orders
from p join i on p.restaurant_id = i.restaurant_id and p.metric_date = i.metric_date and rn = 1""",
    _RAW,
)
def _(s, d):
    return G.restaurant_performance(curated(s, d)).select("restaurant_id", "metric_date", "total_orders", "completed_orders", F.col("gross_merchandise_value").cast("double").alias("gmv"), "unique_customers", "top_item_id", "avg_order_value", "city_rank_by_gmv", "zone_rank_by_orders")


_COHORT = f""",
k0 as (select *, min(order_date) over (partition by customer_id) as f from c where order_date <= date '{B.AS_OF}'),
fav as (select customer_id, cuisine_primary from (select customer_id, cuisine_primary, row_number() over (partition by customer_id order by count(*) desc, cuisine_primary desc) as rn from k0 group by 1, 2) where rn = 1),
conc as (select customer_id, sum(n * n)::double / (sum(n) * sum(n)) as restaurant_concentration, count(*) as distinct_restaurants from (select customer_id, restaurant_id, count(*) as n from k0 group by 1, 2) group by 1),
k as (
  select k0.customer_id, f, strftime(f, '%Y-%m') as cohort_month, user_segment, is_pro_member, count(*) as lifetime_order_count, sum(total_amount) as g, date '{B.AS_OF}' - max(order_date) as idle,
    {", ".join(f"bool_or((year(order_date) - year(f)) * 12 + month(order_date) - month(f) = {m}) as m{m}" for m in (0, 1, 2, 3, 6, 12))},
    case when idle > 180 then 'churned' when idle > 60 then 'dormant' when count(*) = 1 then 'new' else 'active' end as stage
  from k0 group by k0.customer_id, f, user_segment, is_pro_member)"""


def cohorts(s, d):
    return G.user_cohorts(curated(s, d), B.AS_OF)


@_register("q_gold_cohorts", "select customer_id, cohort_month, user_segment, lifetime_order_count, g::double as lifetime_gmv, idle::int as days_since_last_order, m0 as has_order_m0, m1 as has_order_m1, m12 as has_order_m12, stage as lifecycle_stage, cuisine_primary as preferred_cuisine, distinct_restaurants, restaurant_concentration from k join fav using (customer_id) join conc using (customer_id)", _RAW + _COHORT)
def _(s, d):
    return cohorts(s, d).select("customer_id", "cohort_month", "user_segment", "lifetime_order_count", F.col("lifetime_gmv").cast("double"), "days_since_last_order", "has_order_m0", "has_order_m1", "has_order_m12", "lifecycle_stage", "preferred_cuisine", "distinct_restaurants", "restaurant_concentration")


@_register(
    "q_gold_promo",
    """, n as (select *, lead(order_date) over (partition by customer_id order by order_placed_at, order_id) - order_date as gap from c)
select coupon_code, count(*) as redemptions, sum(total_amount)::double as gross_value, sum(discount_amount)::double as discount_cost, count(distinct customer_id) as promo_users, count(*) filter (is_first_order) as new_user_orders,
  count(*) filter (gap <= 7) as repeat_within_7d, count(*) filter (gap <= 14) as repeat_within_14d, count(*) filter (gap <= 30) as repeat_within_30d, (sum(total_amount) - sum(discount_amount))::double / sum(discount_amount)::double as roi from n where coupon_code is not null group by 1""",
    _RAW,
)
def _(s, d):
    return G.promo_effect(curated(s, d)).withColumns({c: F.col(c).cast("double") for c in ("gross_value", "discount_cost")}).drop("cost_per_order")


@_register("q_promo_lift", "select city_name, count(coupon_code) as orders_with, count(*) - count(coupon_code) as orders_without, a as aov_with, b as aov_without, round((a - b) / b * 100, 2) as lift_pct from (select *, (sum(total_amount) filter (coupon_code is not null) over w)::double / count(coupon_code) over w as a, (sum(total_amount) filter (coupon_code is null) over w)::double / (count(*) over w - count(coupon_code) over w) as b from c window w as (partition by city_name)) group by city_name, a, b", _RAW)
def _(s, d):
    return G.promo_lift(curated(s, d)).drop("gmv_with", "gmv_without")


_ROLL = f""",
r30 as (select restaurant_id, city_id, city_name, cuisine_primary, count(*) as n, count(*) filter (is_completed) as done, sum(total_amount) as g, count(distinct customer_id) as u, count(distinct customer_id) filter (not is_first_order) as ru, count(*) filter (sla_breach) as b, max(restaurant_rating) as rating
  from c where order_date > date '{B.AS_OF}' - 30 and order_date <= date '{B.AS_OF}' group by all)"""


@_register("q_rolling30", "select restaurant_id, city_name, n as total_orders_30d, g::double as gmv_30d, u as unique_customers_30d, ru::double / u as repeat_customer_rate_30d, b::double / nullif(done, 0) as sla_breach_rate_30d, (rank() over (partition by city_id order by n desc))::int as city_rank_by_orders, (rank() over (partition by city_id order by rating desc))::int as city_rank_by_rating from r30", _RAW + _ROLL)
def _(s, d):
    return G.restaurant_rolling(curated(s, d), B.AS_OF).select("restaurant_id", "city_name", "total_orders_30d", F.col("gmv_30d").cast("double"), "unique_customers_30d", "repeat_customer_rate_30d", "sla_breach_rate_30d", "city_rank_by_orders", "city_rank_by_rating")


@_register("q_user_activity", """, p as (select customer_id, order_date, platform, row_number() over (partition by customer_id, order_date order by count(*) desc, platform desc) as rn from c group by 1, 2, 3)
select c.customer_id, c.order_date, count(*) as orders, count(*) filter (is_completed) as completed_orders, sum(total_amount)::double as spend, count(distinct restaurant_id) as restaurants, min(p.platform) as main_platform, min(order_placed_at) as first_order_at from c join p on c.customer_id = p.customer_id and c.order_date = p.order_date and rn = 1 group by 1, 2""", _RAW)
def _(s, d):
    return G.user_activity(curated(s, d)).select("customer_id", "order_date", "orders", "completed_orders", F.col("spend").cast("double"), "restaurants", "main_platform", "first_order_at")


_CITY = """,
cd as (select metric_date, city_id, city_name, sum(total_orders) as o, sum(completed_orders) as done, sum(gmv) as g, sum(rev) as r, sum(disc) as disc, sum(com) as com, sum(unique_customers) as u, sum(new_customers) as nu, sum(active_riders) as riders, sum(sla_breach_count) as b, avg(avg_delivery_time_min) as t from d group by all)"""


@_register(
    "q_daily_gmv",
    f"""select a.metric_date, a.city_name, a.o::bigint as total_orders, a.done::bigint as completed_orders, a.g::double as gmv, a.r::double as net_revenue, a.u::bigint as unique_customers, a.nu::bigint as new_customers, round(a.done::double / a.o, 6) as completion_rate, round(a.t, 4) as avg_delivery_time,
  round((a.g::double - p.g::double) / p.g::double * 100, 2) as gmv_dod_change_pct, round((a.o - p.o)::double / p.o * 100, 2) as orders_dod_change_pct, round((a.g::double - w.g) / w.g * 100, 2) as gmv_vs_weekly_avg_pct,
  round(a.disc::double / a.g::double * 100, 2) as discount_burn_rate_pct, round(a.r::double / nullif(a.done, 0), 2) as revenue_per_order, round(a.com::double / nullif(a.done, 0), 2) as commission_per_order
from cd a left join cd p on p.city_id = a.city_id and p.metric_date = a.metric_date - 1
left join (select city_id, avg(g::double) as g from cd where metric_date between date '{B.AS_OF}' - 7 and date '{B.AS_OF}' - 1 group by 1) w on w.city_id = a.city_id where a.metric_date = date '{B.AS_OF}'""",
    _RAW + _DAILY + _CITY,
)
def q_daily_gmv(s, d):
    return R.daily_gmv(daily(s, d), B.AS_OF)


@_register("q_national", "select metric_date, 'ALL' as scope, sum(total_orders)::bigint as total_orders, sum(completed_orders)::bigint as completed_orders, sum(gmv)::double as total_gmv, sum(unique_customers)::bigint as unique_customers, round(sum(pro_gmv)::double / sum(gmv)::double * 100, 2) as pro_gmv_share_pct from d group by 1", _RAW + _DAILY)
def _(s, d):
    return R.national(daily(s, d))


@_register(
    "q_city_scorecard",
    f""", n as (select city_id, city_name, sum(o) as o, sum(g) as g, sum(r) as r, sum(b) as b, sum(done) as done, avg(t) as t, avg(o::double / nullif(riders, 0)) as pr from cd where metric_date between date '{B.AS_OF}' - 30 and date '{B.AS_OF}' group by all),
w as (select city_id, sum(g) as g from cd where metric_date between date '{B.AS_OF}' - 7 and date '{B.AS_OF}' group by 1), p as (select city_id, sum(o) as o, sum(g) as g from cd where metric_date between date '{B.AS_OF}' - 60 and date '{B.AS_OF}' - 31 group by 1)
select city_name, n.o::bigint as orders_30d, n.g::double as gmv_30d, w.g::double as gmv_last_7d, round((n.g::double - p.g::double) / p.g::double * 100, 2) as gmv_mom_growth_pct, round((n.o - p.o)::double / p.o * 100, 2) as orders_mom_growth_pct, round(n.g::double / n.o, 2) as aov_30d, round(n.r::double / n.o, 2) as revenue_per_order,
  round(n.t, 1) as avg_delivery_time_min, round(n.pr, 1) as avg_orders_per_rider, round(n.b::double / n.done * 100, 2) as sla_breach_rate_pct, (rank() over (order by n.g desc))::int as rank_by_gmv, (rank() over (order by n.o desc))::int as rank_by_orders,
  case when n.o >= 5000000 then 'Tier 1' when n.o >= 1000000 then 'Tier 2' when n.o >= 200000 then 'Tier 3' else 'Tier 4' end as city_tier from n left join w using (city_id) left join p using (city_id)""",
    _RAW + _DAILY + _CITY,
)
def _(s, d):
    return R.city_scorecard(daily(s, d), B.AS_OF)


@_register(
    "q_delivery_hourly",
    f""", h as (select metric_date, metric_hour, city_id, sum(n) as n, avg(t) as t, avg(b::double / nullif(done, 0)) as b from dm group by all),
w as (select metric_hour, city_id, avg(n) as n, avg(t) as t from h where metric_date between date '{B.AS_OF}' - 7 and date '{B.AS_OF}' - 1 group by all)
select m.metric_date, m.metric_hour::int as metric_hour, city_name, zone_name, m.n as total_deliveries, m.done as completed_deliveries, round(m.t, 1) as avg_delivery_min, round(m.b::double / nullif(m.done, 0) * 100, 2) as sla_breach_pct,
  round((m.n - h.n)::double / h.n * 100, 1) as deliveries_dod_pct, round(m.t - h.t, 1) as delivery_time_dod_delta, round((m.b::double / nullif(m.done, 0) - h.b) * 100, 2) as sla_breach_dod_delta_pp, round((m.n - w.n) / w.n * 100, 1) as deliveries_vs_weekly_pct, round(m.t - w.t, 1) as delivery_time_vs_weekly_delta,
  case when m.b::double / nullif(m.done, 0) > 0.2 then 'CRITICAL_SLA' when m.b::double / nullif(m.done, 0) > 0.15 then 'HIGH_SLA' when m.t > 45 then 'SLOW_DELIVERY' else 'NORMAL' end as ops_alert
from dm m left join h on h.metric_date = m.metric_date - 1 and h.metric_hour = m.metric_hour and h.city_id = m.city_id left join w on w.metric_hour = m.metric_hour and w.city_id = m.city_id where m.metric_date = date '{B.AS_OF}'""",
    _RAW + _DELIVERY,
)
def _(s, d):
    return R.delivery_hourly(G.delivery_metrics(curated(s, d), True), B.AS_OF)


@_register("q_delivery_daily", "select metric_date, city_name, sum(n)::bigint as total_deliveries, sum(done)::bigint as completed_deliveries, round(avg(t), 1) as avg_delivery_min, round(avg(rating), 2) as avg_rating, round(sum(b)::double / sum(n) * 100, 2) as overall_sla_breach_pct, round(sum(fee)::double / nullif(sum(done), 0), 2) as cost_per_delivery from dm group by 1, 2", _RAW + _DELIVERY)
def _(s, d):
    return R.delivery_daily(G.delivery_metrics(curated(s, d), True))


@_register(
    "q_restaurant_scorecard",
    f""", pe as (select city_id, cuisine_primary, avg(n) as n, avg(g::double) as g, avg(rating) as rating, quantile_cont(g::double, 0.75) as p75 from r30 group by all),
pf as (select restaurant_id, order_date, sum(total_amount) as g from c group by all),
tr as (select restaurant_id, g, lag(g, 7) over (partition by restaurant_id order by order_date) as g7, row_number() over (partition by restaurant_id order by order_date desc) as rn from pf where order_date > date '{B.AS_OF}' - 30)
select r.restaurant_id, city_name, r.cuisine_primary, r.n as total_orders_30d, r.g::double as gmv_30d, (rank() over (partition by r.city_id order by r.g desc))::int as city_rank_by_gmv, round((r.n - pe.n) / pe.n * 100, 1) as orders_vs_peer_pct, round((r.g::double - pe.g) / pe.g * 100, 1) as gmv_vs_peer_pct,
  round(r.rating - pe.rating, 2) as rating_vs_peer, round(p75, 2) as peer_gmv_p75, round((tr.g::double - g7::double) / g7::double * 100, 1) as gmv_wow_change_pct,
  round((coalesce(done::double / r.n, 0) + least(r.rating / 5.0, 1.0) + coalesce(ru::double / u, 0) + 1.0 - coalesce(b::double / nullif(done, 0), 0)) * 25, 1) as health_score,
  case when b::double / nullif(done, 0) > 0.15 then 'HIGH_SLA_BREACH' when r.rating < 3.5 then 'LOW_RATING' else 'HEALTHY' end as primary_flag
from r30 r left join pe using (city_id, cuisine_primary) left join tr on tr.restaurant_id = r.restaurant_id and rn = 1""",
    _RAW + _ROLL,
)
def _(s, d):
    c = curated(s, d)
    return R.restaurant_scorecard(G.restaurant_rolling(c, B.AS_OF), G.restaurant_performance(c), B.AS_OF)


@_register("q_retention_matrix", f"select cohort_month, count(*) as cohort_size, {', '.join(f'count(*) filter (m{m}) as active_m{m}' for m in (0, 1, 2, 3, 6, 12))}, {', '.join(f'round(count(*) filter (m{m})::double / nullif(count(*) filter (m0), 0) * 100, 2) as retention_m{m}_pct' for m in (1, 2, 3, 6, 12))} from k group by 1", _RAW + _COHORT)
def _(s, d):
    return R.retention_matrix(cohorts(s, d))


@_register("q_segment_ltv", "select user_segment, stage as lifecycle_stage, count(*) as user_count, round(avg(lifetime_order_count), 1) as avg_lifetime_orders, round(avg(distinct_restaurants), 1) as avg_distinct_restaurants, count(*) filter (is_pro_member) as pro_member_count, round(sum(g)::double / count(*), 2) as avg_lifetime_gmv, round(count(*) filter (is_pro_member)::double / count(*) * 100, 2) as pro_penetration_pct from k join conc using (customer_id) group by 1, 2", _RAW + _COHORT)
def _(s, d):
    return R.segment_ltv(cohorts(s, d))


@_register("q_churn_topk", "select customer_id, cohort_month, user_segment, stage as lifecycle_stage, idle::int as days_since_last_order, lifetime_order_count, round(least(idle / 180.0, 1.0)::double * g::double, 2) as intervention_priority_score from k where stage <> 'churned' and least(idle / 180.0, 1.0) >= 0.5 and g > 500 order by 7 desc, 1 limit 10000", _RAW + _COHORT)
def _(s, d):
    scored = cohorts(s, d).withColumns({"p": F.least(F.col("days_since_last_order") / 180.0, F.lit(1.0)), "ltv": F.col("lifetime_gmv").cast("double")})
    return R.churn_list(scored, "p", "ltv")


@_register("q_reactivation", "select customer_id, lifetime_order_count, g::double as lifetime_gmv, idle::int as days_since_last_order, cuisine_primary as preferred_cuisine from k join fav using (customer_id) where idle between 60 and 400 and lifetime_order_count >= 5 order by 3 desc, 1 limit 10000", _RAW + _COHORT)
def _(s, d):
    return R.reactivation_list(cohorts(s, d), 60, 400, 5)


@_register(
    "q_retention_wow",
    """, days as (select unnest([date '2001-04-30', date '2001-05-31', date '2001-06-30']) as snapshot_date),
l as (select snapshot_date, customer_id, snapshot_date - max(order_date) as idle, count(*) as n from days join c on order_date <= snapshot_date group by 1, 2),
g as (select snapshot_date, count(*) as total_users, count(*) filter (idle <= 60 and n > 1) as a, count(*) filter (idle > 180) as churned from l group by 1)
select snapshot_date, total_users, round(a::double / total_users * 100, 2) as m1_retention_pct, churned, round(churned::double / total_users * 100, 2) as churn_rate_pct, round(a::double / total_users * 100 - lag(a::double / total_users * 100) over (order by snapshot_date), 2) as retention_wow_delta_pp from g""",
    _RAW,
)
def _(s, d):
    snapshots = G.user_cohorts(curated(s, d), ["2001-04-30", "2001-05-31", "2001-06-30"])
    return R.retention_trend(snapshots)


@_register("q_order_funnel", "select date_trunc('hour', order_placed_at) as hour_bucket, count(*) as orders_placed, count(order_accepted_at) as orders_accepted, count(order_picked_up_at) as orders_picked_up, count(order_delivered_at) as orders_delivered, count(order_cancelled_at) as orders_cancelled, round(avg(actual_delivery_min), 1) as avg_delivery_min, round(count(order_delivered_at)::double / count(*) * 100, 2) as delivery_rate_pct from c group by 1", _RAW)
def _(s, d):
    return R.order_funnel(curated(s, d))


@_register(
    "q_cannibalization",
    f""", nw as (select restaurant_id, city_id, zone_id, min(order_date) as opened from c where order_date >= date '{B.AS_OF}' - 90 group by all having min(order_date) >= date '{B.AS_OF}' - 30),
b as (select c.zone_id, c.city_id, count(*) as n from c join nw on c.zone_id = nw.zone_id and c.city_id = nw.city_id where order_date between opened - 30 and opened - 1 and c.restaurant_id not in (select restaurant_id from nw) group by all),
a as (select c.zone_id, c.city_id, count(*) filter (c.restaurant_id in (select restaurant_id from nw)) as x, count(*) filter (c.restaurant_id not in (select restaurant_id from nw)) as y from c join nw on c.zone_id = nw.zone_id and c.city_id = nw.city_id where order_date between opened and opened + 30 group by all)
select b.zone_id, b.city_id, b.n as existing_orders_before, coalesce(y, 0) as existing_orders_after, coalesce(x, 0) as new_restaurant_orders, round((coalesce(y, 0) - b.n)::double / b.n * 100, 2) as existing_order_change_pct, round(x::double / nullif(x + y, 0) * 100, 2) as new_restaurant_share_pct from b left join a using (zone_id, city_id)""",
    _RAW,
)
def _(s, d):
    return R.cannibalization(curated(s, d), B.AS_OF)


@_register(
    "q_capacity",
    """, h as (select city_name, zone_name, order_date, order_hour, count(*) as n, count(distinct rider_id) as r, avg(actual_delivery_min) as t, quantile_cont(actual_delivery_min::double, 0.9) as p from c where is_completed and is_peak_hour group by all)
select city_name, zone_name, round(avg(n), 4) as avg_peak_orders, round(avg(r), 4) as avg_peak_riders, round(avg(n::double / nullif(r, 0)), 4) as avg_utilization, max(n::double / nullif(r, 0)) as max_utilization, round(avg(t), 3) as avg_delivery_min, round(avg(p), 3) as avg_p90_delivery,
  case when avg(n::double / nullif(r, 0)) >= 4 then 'CRITICAL' when avg(n::double / nullif(r, 0)) >= 3 then 'HIGH' when avg(n::double / nullif(r, 0)) >= 2 then 'MODERATE' else 'LOW' end as capacity_status from h group by 1, 2 having avg(n::double / nullif(r, 0)) >= 1""",
    _RAW,
)
def _(s, d):
    return R.peak_capacity(curated(s, d))


@_register(
    "q_cuisine_trend",
    """, m as (select city_name, cuisine_primary, date_trunc('month', order_date) as m, count(*) as n, sum(total_amount) as g from c where is_completed group by all),
f as (select *, first_value(n) over w as a, last_value(n) over w as b, sum(n) over w as tot, sum(g) over w as gt, row_number() over (partition by city_name, cuisine_primary order by m) as rn from m window w as (partition by city_name, cuisine_primary order by m rows between unbounded preceding and unbounded following))
select city_name, cuisine_primary, tot::bigint as total_orders, gt::double as total_gmv, a as earliest_month_orders, b as latest_month_orders, round((b - a)::double / a * 100, 2) as growth_pct, case when b > a * 1.5 then 'RISING' when b < a * 0.7 then 'DECLINING' else 'STABLE' end as trend from f where rn = 1 and tot >= 10""",
    _RAW,
)
def _(s, d):
    return R.cuisine_trend(curated(s, d))

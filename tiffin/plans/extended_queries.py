"""More queries with their SQL: full curation, menus, gold details, change data, quality, sketches within their bounds."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiffin.functions import expr as X
from tiffin.operators import cdc, cep
from tiffin.operators import curated as C
from tiffin.operators import gold as G
from tiffin.operators import quality as Q
from tiffin.operators import rollup as R
from tiffin.operators.joins import not_in
from tiffin.operators.tables import dealt
from tiffin.plans import binding as B
from tiffin.plans.operator_queries import _CITY, _EMA, _placed, scratch
from tiffin.plans.queries import _RAW, _register, curated
from tiffin.sources import readers, sinks
from tiffin.streaming import stateful, streams

T = B.table

# --- sources and expressions ----------------------------------------------------------------------------------------


@_register("q_etl_transform", "select o_orderkey, o_totalprice::decimal(18,2)::double as o_totalprice, o_orderdate as created_at, '2024-02-01' as dt, timestamp '2024-02-01 03:00:00' as _etl_loaded_at from orders")
def _(s, d):
    cfg = readers.TableConfig("orders", "o_orderkey", decimal_columns=["o_totalprice"])
    rows = T(s, d, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderdate").cast("string").alias("created_at"))
    return readers.etl_transform(rows, cfg, "2024-02-01 03:00:00").withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@_register("q_price_change", "select p_partkey, p_size % 3 <> 0 as price_changed, round(case when p_retailprice = 0 then 0 else (p_size % 3 * 25) / p_retailprice end, 4) * 100 as price_change_pct, p_size > 40 as became_unavailable from part")
def _(s, d):
    """Menu events as JSON text, through the typed parse."""
    p = T(s, d, "part")
    kind = F.when(F.col("p_size") > 20, "menu_item_availability_changed").otherwise("MENU_ITEM_PRICE_CHANGED")
    old = F.col("p_retailprice").cast("decimal(10,2)")
    event = F.struct(kind.alias("event_type"), F.col("p_partkey").cast("string").alias("item_id"), (old + F.col("p_size") % 3 * 25).cast("decimal(10,2)").alias("price"), old.alias("previous_price"), (F.col("p_size") <= 40).alias("is_available"), F.lit(0).cast("long").alias("last_updated"), F.lit(1_700_000_000_000).alias("updated_at"))
    out = readers.menu_events(p.select(F.to_json(event).alias("value")))
    return out.select(F.col("item_id").cast("long").alias("p_partkey"), "price_changed", "price_change_pct", "became_unavailable")


@_register("q_menu_event_parse", "select p_partkey::varchar as item_id, case when p_size > 45 then null else 'MENU_ITEM_ADDED' end as event_type, p_retailprice::decimal(10,2)::double as price, timestamp '2023-11-14 22:13:20' as event_time from part")
def _(s, d):
    kind = F.when(F.col("p_size") > 45, "unheard_of").otherwise(" menu_item_added ")
    event = F.struct(kind.alias("event_type"), F.col("p_partkey").cast("string").alias("item_id"), F.col("p_retailprice").cast("decimal(10,2)").alias("price"), F.lit(1_700_000_000_000).alias("updated_at"))
    out = readers.menu_events(T(s, d, "part").select(F.to_json(event).alias("value")))
    return out.select("item_id", "event_type", F.col("price").cast("double").alias("price"), "event_time")


@_register("q_hashed_columns", "select c_custkey, sha256('pepper' || c_name) as c_name, c_mktsegment from customer")
def _(s, d):
    return T(s, d, "customer").select("c_custkey", "c_name", "c_mktsegment").withColumns(X.hashed(["c_name"], "pepper"))


@_register("q_effective_amount", "select event_id, coalesce(case when event_id % 3 = 0 then null else value end, value * 2) as amount from events")
def _(s, d):
    return T(s, d, "events").select("event_id", X.effective_amount(F.when(F.col("event_id") % 3 != 0, F.col("value")), F.col("value") * 2).alias("amount"))


# --- aggregates -------------------------------------------------------------------------------------------------------


@_register("q_distinct_case", "select c_mktsegment, count(distinct c_nationkey) as nations, count(distinct case when c_acctbal > 0 then c_nationkey end) as in_credit, count(distinct case when c_acctbal < 0 then c_custkey end) as debtors from customer group by 1")
def _(s, d):
    when = lambda c, v: F.count_distinct(F.when(F.expr(c), F.col(v)))
    return T(s, d, "customer").groupBy("c_mktsegment").agg(F.count_distinct("c_nationkey").alias("nations"), when("c_acctbal > 0", "c_nationkey").alias("in_credit"), when("c_acctbal < 0", "c_custkey").alias("debtors"))


@_register("q_having", "select o_custkey, count(*) as n, sum(o_totalprice::decimal(12,2))::double as total from orders group by 1 having count(*) > 5 and sum(o_totalprice::decimal(12,2)) > 500000")
def _(s, d):
    out = T(s, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("double").alias("total"))
    return out.where("n > 5 and total > 500000")


@_register("q_lag_expr", "select m, n, round((n - lag(n) over (order by m))::double / lag(n) over (order by m) * 100, 4) as change_pct, lag(n * 2 + 1) over (order by m) as before from (select date_trunc('month', o_orderdate)::date as m, count(*) as n from orders group by 1)")
def _(s, d):
    """The window without a partition runs over one row a month."""
    m = T(s, d, "orders").groupBy(F.to_date(F.date_trunc("month", "o_orderdate")).alias("m")).agg(F.count("*").alias("n"))
    w = Window.orderBy("m")
    return m.select("m", "n", X.growth(F.col("n"), F.lag("n").over(w), 4).alias("change_pct"), F.lag(F.col("n") * 2 + 1).over(w).alias("before"))


_RANKS = "select c.l_linestatus, count(*) as n from lineitem c group by 1"


@_register("q_quantile_sketch", f"select l_linestatus, n, true as p50_close, true as p90_close, true as p99_close from ({_RANKS})")
def _(s, d):
    """Quantiles of merged daily sketches; the true rank of each estimate must lie within 0.02 of the one asked for."""
    rows = T(s, d, "lineitem").select("l_linestatus", "l_shipdate", "l_extendedprice")
    day = rows.groupBy("l_linestatus", F.to_date("l_shipdate").alias("day")).agg(F.kll_sketch_agg_double(F.col("l_extendedprice").cast("double")).alias("k"))
    asked = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
    est = day.groupBy("l_linestatus").agg(*(R.quantile("k", p).alias(n) for n, p in asked.items()))
    return _rank_error(rows, est, asked, 0.02)


def _rank_error(rows: DataFrame, est: DataFrame, asked: dict[str, float], bound: float) -> DataFrame:
    """By line status whether estimates have ranks within `bound` of those asked for; two status values, so `est` is tiny."""
    both = rows.join(F.broadcast(est), "l_linestatus").groupBy("l_linestatus").agg(
        F.count("*").alias("n"),
        *(F.count_if(F.col("l_extendedprice") < F.col(n)).alias(f"{n}_lo") for n in asked),
        *(F.count_if(F.col("l_extendedprice") <= F.col(n)).alias(f"{n}_hi") for n in asked),
    )
    close = lambda n, p: (F.col(f"{n}_lo") / F.col("n") <= p + bound) & (F.col(f"{n}_hi") / F.col("n") >= p - bound)
    return both.select("l_linestatus", "n", *(close(n, p).alias(f"{n}_close") for n, p in asked.items()))


@_register("q_approx_pct_bound", f"select l_linestatus, n, true as p50_close, true as p90_close, true as p99_close from ({_RANKS})")
def _(s, d):
    asked = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
    rows = T(s, d, "lineitem").select("l_linestatus", "l_extendedprice")
    return _rank_error(rows, rows.groupBy("l_linestatus").agg(*(F.percentile_approx("l_extendedprice", F.lit(p), F.lit(10000)).alias(n) for n, p in asked.items())), asked, 0.001)


@_register("q_approx_distinct", "select event_type, count(distinct user_id) as users, true as approx_close, true as hll_close from events group by 1")
def _(s, d):
    """Approximate distinct counts, directly and from merged daily sketches, within a tenth of the exact count."""
    e = T(s, d, "events")
    day = e.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.hll_sketch_agg("user_id", 12).alias("h"))
    merged = day.groupBy("event_type").agg(R.distinct_hll("h").alias("hll"))
    # Apart from the exact count: in one aggregation every pair of type and user would carry the registers of the estimate.
    about = e.groupBy("event_type").agg(F.approx_count_distinct("user_id", 0.02).alias("about"))
    out = dealt(e.select("event_id", "event_type", "user_id"), "event_id").groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))
    for more in (about, merged):
        out = out.join(more.withColumnRenamed("event_type", "_type"), F.col("event_type").eqNullSafe(F.col("_type"))).drop("_type")
    close = lambda c: F.abs(F.col(c) - F.col("users")) <= F.col("users") * 0.1 + 1
    return out.select("event_type", "users", close("about").alias("approx_close"), close("hll").alias("hll_close"))


@_register("q_gold_daily_bound", ", g as (select order_date as metric_date, zone_id, is_weekend, count(*) as total_orders, count(distinct customer_id) as unique_customers, count(distinct rider_id) as active_riders from c group by 1, 2, 3, city_id, city_name, zone_name) select *, true as median_close from g", _RAW)
def _(s, d):
    """The daily table as it is by default, with approximate percentiles and sketched distinct counts."""
    c = curated(s, d)
    day = G.daily_order_metrics(c).select("metric_date", "zone_id", F.col("weekend_flag").alias("is_weekend"), "total_orders", "unique_customers", "active_riders", "median_order_value")
    keys = ["metric_date", "zone_id"]
    near = c.select(F.col("order_date").alias("metric_date"), "zone_id", "total_amount").join(day.select(*keys, "median_order_value"), keys)
    side = near.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(F.col("total_amount") < F.col("median_order_value")).alias("lo"), F.count_if(F.col("total_amount") <= F.col("median_order_value")).alias("hi"))
    close = (F.col("lo") <= F.col("n") * 0.5 + 1) & (F.col("hi") >= F.col("n") * 0.5 - 1)
    return day.drop("median_order_value").join(side, keys).select(*keys, "is_weekend", "total_orders", "unique_customers", "active_riders", close.alias("median_close"))


# --- joins ------------------------------------------------------------------------------------------------------------


@_register("q_not_in_nulls", """select 'nulls' as kind, count(*) as n from customer where c_custkey not in (select case when o_orderkey % 100 = 0 then null else o_custkey end from orders where o_totalprice > 300000)
union all select 'none', count(*) from customer where case when c_custkey % 5 = 0 then null else c_custkey end not in (select o_custkey from orders where o_totalprice < 0)
union all select 'some', count(*) from customer where case when c_custkey % 5 = 0 then null else c_custkey end not in (select o_custkey from orders where o_totalprice > 300000)""")
def _(s, d):
    o, c = T(s, d, "orders"), T(s, d, "customer").select("c_custkey")
    gaps = c.select(F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey")).alias("c_custkey"))
    big = o.where("o_totalprice > 300000")
    cases = {"nulls": (c, big.select(F.when(F.col("o_orderkey") % 100 != 0, F.col("o_custkey")).alias("k"))), "none": (gaps, o.where("o_totalprice < 0").select(F.col("o_custkey").alias("k"))), "some": (gaps, big.select(F.col("o_custkey").alias("k")))}
    out = None
    for kind, (left, right) in cases.items():
        one = not_in(left, "c_custkey", right, "k").agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
        out = one if out is None else out.union(one)
    return out


# --- full curation, menus, gold details ----------------------------------------------------------------------------------


def _items(s, d) -> DataFrame:
    item = F.struct("l_linenumber", F.when(F.col("l_linenumber") != 3, F.col("l_partkey")).alias("item_id"), (F.col("l_partkey") % 2 == 0).alias("is_veg"), F.concat(F.lit("c"), F.col("l_partkey") % 4).alias("category"))
    return T(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(F.array_sort(F.collect_list(item)).alias("items"))


def _full(s, d) -> DataFrame:
    """Orders with older versions, dimensions with older snapshots, payments and deliveries with several records."""
    orders = B.raw_orders(s, d).join(_items(s, d), "order_id", "left").withColumn("payment_status", F.lit("pending"))
    version = F.explode(F.when(F.col("order_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1))))
    orders = orders.withColumn("version", version).withColumn("order_status", F.when(F.col("version") == 1, F.col("order_status")).otherwise("placed"))
    twice = lambda df, cols: df.withColumn("at", F.explode(F.array(F.lit(1), F.lit(2)))).withColumns({n: F.when(F.col("at") == 2, F.col(n)) for n in cols})
    restaurants = twice(B.restaurants(s, d), ["commission_rate", "restaurant_rating"])
    users = twice(B.users(s, d), ["is_pro_member", "segment"])
    steps = lambda n: F.explode(F.sequence(F.lit(1), n))
    o = T(s, d, "orders").selectExpr("o_orderkey as order_id", "o_totalprice")
    payments = o.where("order_id % 4 <> 3").withColumn("version", steps((F.col("order_id") % 3 + 1).cast("int"))).selectExpr("order_id", "version", "element_at(array('INITIATED', 'PROCESSING', 'COMPLETED'), version) as payment_status")
    deliveries = o.where("order_id % 3 = 0").withColumn("version", steps(F.lit(2))).selectExpr("order_id", "version", "cast(version * (order_id % 17) as double) as total_distance_km")
    return C.curate_orders(orders, restaurants, users, max_total=1_000_000, earliest="1990-01-01", payments=payments, deliveries=deliveries, versions=["version"], snapshots=["at"])


_FULL = """, f as (select order_id, count(l_partkey) filter (l_linenumber <> 3) as unique_item_count, bool_or(l_partkey % 2 = 0) as has_veg_items, bool_or(l_partkey % 2 = 1) as has_non_veg_items, 'c' || (arg_min(l_partkey, (l_linenumber, coalesce(case when l_linenumber <> 3 then l_partkey end, -1), l_partkey % 2 = 0, 'c' || (l_partkey % 4))) % 4) as cuisine_primary from (select l_orderkey as order_id, * from lineitem) group by 1),
full_ as (select c.order_id, c.order_status, c.is_pro_member, c.is_first_order, c.platform_commission::double as platform_commission, (c.total_amount * (1 - coalesce(e.rate, 0.2)))::decimal(12,2)::double as restaurant_payout, case when c.order_id % 4 = 3 then 'pending' else ['INITIATED', 'PROCESSING', 'COMPLETED'][(c.order_id % 3 + 1)::int] end as payment_status,
  case when c.order_id % 3 = 0 then 2.0 * (c.order_id % 17) end::double as delivery_distance_km, f.unique_item_count::int as unique_item_count, f.has_veg_items, f.has_non_veg_items, f.cuisine_primary, case when c.actual_delivery_min is not null then c.actual_delivery_min - 30 end::int as delivery_delay_min, c.actual_delivery_min > 30 as is_late_delivery, c.city_id, c.zone_id, c.order_date, c.order_hour, c.rider_id, c.is_completed, c.is_cancelled, c.sla_breach, c.order_rating,
  c.order_placed_at, c.order_accepted_at, c.order_picked_up_at, c.order_delivered_at from c join f using (order_id) left join rest e using (restaurant_id))"""


@_register("q_curated_full", "select order_id, order_status, is_pro_member, is_first_order, platform_commission, restaurant_payout, payment_status, delivery_distance_km, unique_item_count, has_veg_items, has_non_veg_items, cuisine_primary, delivery_delay_min, is_late_delivery from full_", _RAW + _FULL)
def _(s, d):
    return _full(s, d).select("order_id", "order_status", "is_pro_member", "is_first_order", F.col("platform_commission").cast("double"), F.col("restaurant_payout").cast("double"), "payment_status", "delivery_distance_km", "unique_item_count", "has_veg_items", "has_non_veg_items", "cuisine_primary", "delivery_delay_min", "is_late_delivery")


def _sales(s, d) -> DataFrame:
    line, o = T(s, d, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice"), T(s, d, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date"))
    return line.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_partkey").alias("item_id"), "order_date", F.col("o_custkey").alias("customer_id"), F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"))


def _menu(s, d) -> DataFrame:
    """A price of each item on each day on which it was shipped."""
    price = F.max(F.round(F.col("l_extendedprice") / 100, 0)).cast("decimal(12,2)")
    day = T(s, d, "lineitem").groupBy(F.col("l_partkey").alias("item_id"), F.to_date("l_shipdate").alias("snapshot_date")).agg(price.alias("price"))
    return day.withColumns({"restaurant_id": F.col("item_id") % 50, "city_id": F.col("item_id") % 5, "category": F.concat(F.lit("c"), F.col("item_id") % 7)})


_MENU = "ms as (select l_partkey as item_id, l_shipdate::date as snapshot_date, max(round(l_extendedprice / 100, 0))::decimal(12,2) as price from lineitem group by 1, 2)"


@_register("q_menu_price_changes", f"""with {_MENU}, w as (select *, last_value(price) over (partition by item_id order by snapshot_date range between unbounded preceding and interval 7 days preceding) as p7, last_value(price) over (partition by item_id order by snapshot_date range between unbounded preceding and interval 30 days preceding) as p30 from ms)
select item_id, snapshot_date, price::double as price, round((price::double - p7::double) / p7::double * 100, 2) as price_change_7d_pct, round((price::double - p30::double) / p30::double * 100, 2) as price_change_30d_pct from w""")
def _(s, d):
    return C.price_changes(_menu(s, d)).select("item_id", "snapshot_date", F.col("price").cast("double"), "price_change_7d_pct", "price_change_30d_pct")


@_register("q_menu_curated", f"""with {_MENU}, w as (select *, last_value(price) over (partition by item_id order by snapshot_date range between unbounded preceding and interval 7 days preceding) as p7, row_number() over (partition by item_id order by snapshot_date desc) as rn from ms where snapshot_date <= date '{B.AS_OF}'),
b as (select l_partkey as item_id, o_custkey, count(*) as n, sum(l_extendedprice::decimal(12,2)) as amount from lineitem join orders on l_orderkey = o_orderkey where o_orderdate::date > date '{B.AS_OF}' - 30 and o_orderdate::date <= date '{B.AS_OF}' group by 1, 2),
g as (select item_id, sum(n) as n, sum(amount)::double as amount, count(*) as u, count(*) filter (n > 1) as again from b group by 1),
o as (select w.item_id, price, round((price::double - p7::double) / p7::double * 100, 2) as p, coalesce(n, 0) as n, amount, coalesce(u, 0) as u, coalesce(again::double / nullif(u, 0), 0) as r from w left join g using (item_id) where rn = 1),
m as (select nullif(max(n), 0) as n, nullif(max(u), 0) as u, nullif(max(r), 0) as r from o)
select item_id, price::double as price, p as price_change_7d_pct, o.n::bigint as total_orders_30d, amount as total_revenue_30d, o.u::bigint as unique_customers_30d, o.r as reorder_rate_30d, case when price < 150 then 'budget' when price < 400 then 'mid_range' when price < 1000 then 'premium' else 'luxury' end as price_tier,
  (rank() over (partition by item_id % 50 order by o.n desc))::int as restaurant_rank_by_orders, (rank() over (partition by item_id % 5, item_id % 7 order by o.n desc))::int as city_category_rank, round((coalesce(o.n::double / m.n, 0) + coalesce(o.u::double / m.u, 0) + coalesce(o.r / m.r, 0)) / 3 * 100, 4) as overall_popularity_score from o, m""")
def _(s, d):
    out = C.curate_menu(_menu(s, d), _sales(s, d), B.AS_OF)
    return out.select("item_id", F.col("price").cast("double"), "price_change_7d_pct", "total_orders_30d", F.col("total_revenue_30d").cast("double"), "unique_customers_30d", "reorder_rate_30d", "price_tier", "restaurant_rank_by_orders", "city_category_rank", "overall_popularity_score")


@_register("q_gold_delivery_stages", """, t as (select *, epoch(order_accepted_at - order_placed_at) / 60.0 as a, epoch(order_picked_up_at - order_accepted_at) / 60.0 as w, epoch(order_delivered_at - order_picked_up_at) / 60.0 as m from full_),
k as (select order_date, order_hour, city_id, zone_id, rider_id, count(*) as n, count(*) filter (is_completed) as done from t where rider_id is not null group by all),
r as (select order_date, order_hour, city_id, zone_id, count(*) as riders, count(*) filter (done > 0) as busy, count(*) filter (n > 1) as multi, coalesce(sum(n) filter (n > 1), 0) as batched from k group by all)
select t.order_date as metric_date, t.order_hour::int as metric_hour, t.city_id, t.zone_id, count(*) as total_deliveries, round(avg(a), 6) as avg_accept_time, round(avg(w), 6) as avg_pickup_time, round(avg(m), 6) as avg_transit_time, round(avg(delivery_distance_km), 6) as avg_delivery_distance_km, count(*) filter (sla_breach and w > m) as sla_breach_by_restaurant, count(*) filter (sla_breach and not coalesce(w > m, false)) as sla_breach_by_rider,
  count(*) filter (is_cancelled and order_accepted_at is not null) as cancel_after_accept, count(order_rating) as deliveries_with_rating, coalesce(any_value(riders), 0)::bigint as total_active_riders, coalesce(any_value(busy), 0)::bigint as riders_on_delivery, coalesce(any_value(multi), 0)::bigint as riders_with_multi_order, coalesce(any_value(batched), 0)::bigint as batched_orders
from t left join r using (order_date, order_hour, city_id, zone_id) group by 1, 2, 3, 4""", _RAW + _FULL)
def _(s, d):
    out = G.delivery_stages(_full(s, d))
    rounded = {c: F.round(c, 6) for c in ("avg_accept_time", "avg_pickup_time", "avg_transit_time", "avg_delivery_distance_km")}
    return out.withColumns(rounded).select("metric_date", "metric_hour", "city_id", "zone_id", "total_deliveries", *rounded, "sla_breach_by_restaurant", "sla_breach_by_rider", "cancel_after_accept", "deliveries_with_rating", "total_active_riders", "riders_on_delivery", "riders_with_multi_order", "batched_orders")


@_register("q_gold_restaurant_details", """, t as (select restaurant_id, order_date, city_id, count(*) filter (is_cancelled) as cancelled_orders, sum(item_count)::bigint as total_items_sold, sum(platform_commission)::double as platform_commission_paid, round(avg(epoch(order_picked_up_at - order_accepted_at) / 60.0), 6) as avg_preparation_time_min, round(quantile_cont(epoch(order_picked_up_at - order_accepted_at) / 60.0, 0.9), 6) as p90_preparation_time_min, count(distinct customer_id) as unique_customers, count(distinct customer_id) filter (is_first_order) as new_customers, count(distinct customer_id) filter (not is_first_order) as repeat_customers,
  avg(order_rating) as avg_order_rating, count(order_rating) as total_ratings, count(*) filter (order_rating = 5) as five_star_count, count(*) filter (order_rating <= 2) as negative_review_count, count(*) filter (cancellation_source = 'restaurant') as cancelled_by_restaurant from c group by 1, 2, 3)
select * exclude (order_date), order_date as metric_date, (rank() over (partition by order_date, city_id order by avg_order_rating desc nulls last))::int as city_rank_by_rating from t""", _RAW)
def _(s, d):
    out = G.restaurant_details(curated(s, d), True).withColumns({"platform_commission_paid": F.col("platform_commission_paid").cast("double"), "avg_preparation_time_min": F.round("avg_preparation_time_min", 6), "p90_preparation_time_min": F.round("p90_preparation_time_min", 6)})
    return out.select("restaurant_id", "metric_date", "city_id", "cancelled_orders", "total_items_sold", "platform_commission_paid", "avg_preparation_time_min", "p90_preparation_time_min", "unique_customers", "new_customers", "repeat_customers", "avg_order_rating", "total_ratings", "five_star_count", "negative_review_count", "cancelled_by_restaurant", "city_rank_by_rating")


_FUNNEL = "select 'C' || (user_id % 9) as coupon_code, count(*) filter (event_type in ('view', 'click', 'purchase')) as total_impressions, count(*) filter (event_type in ('click', 'purchase')) as total_distributed, count(*) filter (event_type = 'purchase') as total_applied from events group by 1"


@_register("q_gold_promo_rates", f""", f as ({_FUNNEL}), u as (select coupon_code, customer_id, count(*) as n, sum(total_amount) as g, sum(discount_amount) as d, max(is_first_order) as fresh, sum(discount_amount) filter (is_first_order) as nd from c where coupon_code is not null and is_completed group by 1, 2),
r as (select coupon_code, sum(n)::bigint as n, sum(g)::double as g, sum(d)::double as d, count(*) as u, count(*) filter (fresh) as nu, sum(nd)::double as nd from u group by 1)
select coupon_code, total_applied, r.n as total_redeemed, round(total_applied / nullif(total_distributed, 0), 6) as apply_rate, round(r.n / nullif(total_distributed, 0), 6) as redemption_rate, round(r.n / nullif(total_applied, 0), 6) as conversion_rate, round(d / n, 4) as avg_discount_per_order, round(d / g * 100, 6) as discount_as_pct_of_gmv, round(nd / nullif(nu, 0), 4) as customer_acquisition_cost, round(n / u, 6) as avg_uses_per_user from f full join r using (coupon_code)""", _RAW)
def _(s, d):
    k = lambda *v: F.count_if(F.col("event_type").isin(*v))
    funnel = T(s, d, "events").groupBy(F.concat(F.lit("C"), F.col("user_id") % 9).alias("coupon_code")).agg(k("view", "click", "purchase").alias("total_impressions"), k("click", "purchase").alias("total_distributed"), k("purchase").alias("total_applied"))
    out = G.promo_rates(curated(s, d), funnel)
    digits = {"apply_rate": 6, "redemption_rate": 6, "conversion_rate": 6, "avg_discount_per_order": 4, "discount_as_pct_of_gmv": 6, "customer_acquisition_cost": 4, "avg_uses_per_user": 6}
    return out.select("coupon_code", "total_applied", "total_redeemed", *(F.round(c, n).alias(c) for c, n in digits.items()))


# --- change data ----------------------------------------------------------------------------------------------------------


@_register("q_merge_late", f""", a as (select customer_id, order_date, city_id, count(*) as orders, sum(total_amount)::double as spend from c group by 1, 2, 3), late as (select customer_id, order_date, city_id, orders + 1 as orders, spend + 10 as spend from a where customer_id % 3 = 0 union all select customer_id, date '2002-01-01', 77, 1, 5.0 from a group by 1)
select * from late union all select * from a where (customer_id, order_date, city_id) not in (select (customer_id, order_date, city_id) from late)""", _RAW)
def _(s, d):
    """Late rows replace those of the same customer, date and city, or are added."""
    a = G.user_activity(curated(s, d).withColumn("city", F.col("city_id"))).select("customer_id", "order_date").distinct()
    c = curated(s, d).groupBy("customer_id", "order_date", "city_id").agg(F.count("*").alias("orders"), F.sum("total_amount").cast("double").alias("spend"))
    late = c.where("customer_id % 3 = 0").selectExpr("customer_id", "order_date", "city_id", "orders + 1 as orders", "spend + 10 as spend")
    more = a.select("customer_id").distinct().selectExpr("customer_id", "date '2002-01-01' as order_date", "77 as city_id", "1L as orders", "5D as spend")
    return cdc.merge_late(c, late.union(more), ["customer_id", "order_date", "city_id"])


@_register("q_change_rows", "select user_id as id, value as amount, case event_type when 'error' then 'DELETE' when 'signup' then 'INSERT' else 'UPDATE' end as op_type, timestamp '2024-03-01 00:00:00' as processing_time, strftime(ts, '%Y-%m-%d') as dt from events")
def _(s, d):
    """Envelopes as JSON text, parsed by a schema, unwrapped, with their processing time and date."""
    e = T(s, d, "events")
    row = F.struct(F.col("user_id").cast("string").alias("order_id"), F.lit("x").alias("user_id"), F.col("value").cast("decimal(10,2)").alias("total_amount"), F.col("ts").alias("updated_at"))
    op = F.when(F.col("event_type") == "error", "d").when(F.col("event_type") == "signup", "c").otherwise("u")
    text = F.to_json(F.struct(F.when(op == "d", row).alias("before"), F.when(op != "d", row).alias("after"), op.alias("op"), F.unix_millis("ts").alias("ts_ms")), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    rows = cdc.change_rows(readers.change_stream(e.select(text.alias("value")), "orders"), "updated_at", "2024-03-01", ("user_id",))
    return rows.select(F.col("order_id").cast("long").alias("id"), F.col("total_amount").cast("double").alias("amount"), "op_type", "processing_time", "dt")


@_register("q_typed_attr_nested", """select event_id, '["a",' || user_id || ',true,null]' as list_value, '{"k":' || event_id || ',"deep":["' || event_type || '"]}' as map_value, '["x","' || event_type || '"]' as set_value, '[' || user_id || ',1.5]' as numbers, '"Ynl0ZXM="' as bytes_value from events""")
def _(s, d):
    n = lambda c: F.concat(F.lit('{"N":"'), F.col(c).cast("string"), F.lit('"}'))
    e = T(s, d, "events")
    made = {
        "list_value": F.concat(F.lit('{"L":[{"S":"a"},'), n("user_id"), F.lit(',{"BOOL":true},{"NULL":true}]}')),
        "map_value": F.concat(F.lit('{"M":{"k":'), n("event_id"), F.lit(',"deep":{"L":[{"S":"'), F.col("event_type"), F.lit('"}]}}}')),
        "set_value": F.concat(F.lit('{"SS":["x","'), F.col("event_type"), F.lit('"]}')),
        "numbers": F.concat(F.lit('{"NS":["'), F.col("user_id").cast("string"), F.lit('","1.5"]}')),
        "bytes_value": F.lit('{"B":"Ynl0ZXM="}'),
    }
    return e.select("event_id", *(X.attribute_json(c).alias(k) for k, c in made.items()))


def _flat(s, d) -> DataFrame:
    """Flat change records of the four tables, from the events."""
    data = {"session_id": "event_id % 40", "user_id": "user_id", "pages_viewed": "event_id % 9", "is_active": "event_id % 2 = 0", "session_duration_secs": "event_id", "city": "event_type", "delivery_id": "event_id % 50", "latitude": "value", "distance_km": "value / 2", "status": "event_type", "restaurant_id": "user_id % 20", "item_id": "event_id % 6", "is_available": "value > 50", "stock_count": "event_id % 100", "preferred_cuisines": "concat('[', event_type, ']')", "notifications_enabled": "value < 20"}
    pairs = [x for k, v in data.items() for x in (F.lit(k), F.expr(v).cast("string"))]
    table = F.element_at(F.array(*map(F.lit, cdc.PROJECTIONS)), (F.col("event_id") % 4 + 1).cast("int"))
    return T(s, d, "events").select(F.col("event_id").cast("string").alias("event_id"), F.lit("MODIFY").alias("event_name"), table.alias("table_name"), F.unix_timestamp("ts").alias("approximate_creation_time"), F.col("event_id").cast("string").alias("sequence_number"), F.create_map(*pairs).alias("data"))


def _last(n: int, key: str, cols: str) -> str:
    return f"select {cols} from (select *, row_number() over (partition by {key} order by epoch(date_trunc('second', ts))::bigint desc, event_id desc) as rn from events where event_id % 4 = {n}) where rn = 1"


@_register("q_project_sessions", _last(0, "event_id % 40", "(event_id % 40)::varchar as session_id, user_id::varchar as user_id, (event_id % 9)::int as pages_viewed, event_id % 2 = 0 as is_active, event_id as session_duration_secs, event_type as city, hour(ts)::int as hour"))
def _(s, d):
    return cdc.latest_projection(_flat(s, d), "user-sessions").select("session_id", "user_id", "pages_viewed", "is_active", "session_duration_secs", "city", "hour")


@_register("q_project_tracking", _last(1, "event_id % 50", "(event_id % 50)::varchar as delivery_id, value as latitude, round(value / 2, 6) as distance_km, event_type as status, strftime(ts, '%Y-%m-%d') as dt"))
def _(s, d):
    return cdc.latest_projection(_flat(s, d), "delivery-tracking").select("delivery_id", "latitude", F.round("distance_km", 6).alias("distance_km"), "status", "dt")


@_register("q_project_inventory", _last(2, "user_id % 20, event_id % 6", "(user_id % 20)::varchar as restaurant_id, (event_id % 6)::varchar as item_id, value > 50 as is_available, (event_id % 100)::int as stock_count"))
def _(s, d):
    return cdc.latest_projection(_flat(s, d), "restaurant-inventory").select("restaurant_id", "item_id", "is_available", "stock_count")


@_register("q_project_preferences", _last(3, "user_id", "user_id::varchar as user_id, '[' || event_type || ']' as preferred_cuisines, value < 20 as notifications_enabled"))
def _(s, d):
    return cdc.latest_projection(_flat(s, d), "user-preferences").select("user_id", "preferred_cuisines", "notifications_enabled")


# --- data quality and maintenance ------------------------------------------------------------------------------------------


@_register("q_dq_order_transitions", "select event_id, previous, status from (select *, lag(status) over (partition by user_id order by ts, event_id) as previous from (select event_id, ts, user_id, ['PLACED', 'CONFIRMED', 'PREPARING', 'READY', 'CANCELLED', 'DELIVERED'][(event_id * 7 + user_id) % 6 + 1] as status from events)) where previous is not null and previous <> status and (previous, status) not in (('PLACED', 'CONFIRMED'), ('PLACED', 'CANCELLED'), ('CONFIRMED', 'PREPARING'), ('CONFIRMED', 'CANCELLED'), ('PREPARING', 'READY'))")
def _(s, d):
    """The default table of transitions."""
    names = F.array(*map(F.lit, ["PLACED", "CONFIRMED", "PREPARING", "READY", "CANCELLED", "DELIVERED"]))
    e = T(s, d, "events").select("event_id", "ts", "user_id", F.element_at(names, ((F.col("event_id") * 7 + F.col("user_id")) % 6 + 1).cast("int")).alias("status"))
    return Q.illegal_transitions(e, "user_id", "status", "ts", "event_id").select("event_id", "previous", "status")


@_register("q_dq_order_rules", "select 'total_positive' as rule, count(*) filter (not coalesce(total_amount > 0, false)) as failures, count(*) as rows from raw union all select 'subtotal_below_total', count(*) filter (not coalesce(total_amount - tax_amount - 30 <= total_amount, false)), count(*) from raw union all select 'amounts_add_up', 0, count(*) from raw union all select 'discount_not_negative', count(*) filter (discount_amount < 0), count(*) from raw union all select 'items_present', count(*) filter (not coalesce(item_count > 0, false)), count(*) from raw", _RAW)
def _(s, d):
    return Q.rule_failures(B.raw_orders(s, d), Q.order_rules())


@_register("q_dq_value_rules", """select 'email_form' as rule, count(*) filter (event_id % 11 = 0) as failures, count(*) as rows from events union all select 'phone_form', count(*) filter (event_id % 13 = 0), count(*) from events union all select 'latitude_range', count(*) filter (value > 90), count(*) from events union all select 'longitude_range', count(*) filter (value * 3 > 180), count(*) from events
union all select 'rating_range', count(*) filter (event_id % 7 > 5), count(*) from events union all select 'preparation_range', count(*) filter (event_id % 130 not between 1 and 120), count(*) from events union all select 'validity_order', count(*) filter (event_id % 5 <= 2), count(*) from events union all select 'usage_bounded', count(*) filter (event_id % 4 > 2), count(*) from events""")
def _(s, d):
    e = T(s, d, "events").selectExpr("if(event_id % 11 = 0, 'no mail', concat('u', user_id, '@x.org')) as email", "if(event_id % 13 = 0, '12ab', '+91 98765 43210') as phone", "value as lat", "value * 3 as lng", "event_id % 7 as rating", "event_id % 130 as prep", "2 as lo", "event_id % 5 as hi", "event_id % 4 as used", "2 as allowed")
    return Q.rule_failures(e, Q.value_rules("email", "phone", "lat", "lng", "rating", "prep", "lo", "hi", "used", "allowed"))


@_register("q_freshness_lag", f"select {_CITY} as city, max(ts) as newest, epoch(timestamp '2024-01-31')::bigint - floor(epoch(max(ts)))::bigint as lag_seconds, epoch(timestamp '2024-01-31')::bigint - floor(epoch(max(ts)))::bigint <= 3600 as passed from events group by 1")
def _(s, d):
    return Q.freshness_lag(T(s, d, "events").withColumn("city", F.expr(_CITY)), "ts", "2024-01-31", ["city"], 3600)


@_register("q_dead_letter_growth", "select time_bucket(interval 30 minutes, ts) as bucket, count(*) as n, count(*) > 3 as alert from events where event_type = 'error' group by 1")
def _(s, d):
    return Q.dead_letter_growth(T(s, d, "events").where("event_type = 'error'"), "ts", 3)


@_register("q_file_health", "select strftime(ts, '%Y-%m-%d') as dt, count(*) as record_count, true as has_files, true as passed from events group by 1")
def _(s, d):
    """Files of a table written from the events, one partition a day: rows by partition, and complete partitions."""
    path = f"{scratch(s)}/health-{uuid.uuid4().hex}"
    T(s, d, "events").withColumn("dt", F.date_format("ts", "yyyy-MM-dd")).repartition("dt").write.partitionBy("dt").parquet(path)
    health = sinks.file_health(s, path, "dt").select(F.col("dt").cast("string").alias("dt"), "record_count", ((F.col("file_count") > 0) & (F.col("total_bytes") > 0)).alias("has_files"))
    whole = Q.partition_completeness(readers.list_files(s, path), F.regexp_extract("path", "dt=([^/]+)/", 1), 1, 100, (".parquet",))
    return health.join(whole.select(F.col("partition").alias("dt"), "passed"), "dt")


# --- streams in append mode ------------------------------------------------------------------------------------------------


_DONE = "timestamp '2024-01-20'"


@_register("stream_restaurant_velocity", "select restaurant_id, city, time_bucket(interval 1 hour, ts) as window_start, count(*) as order_count, round(sum(value), 4) as total_revenue, round(avg(value), 4) as avg_order_value from (select user_id % 20 as restaurant_id, " + _CITY + " as city, * from events where event_type <> 'error') where ts < " + _DONE + " group by 1, 2, 3")
def _(s, d):
    """Change rows by restaurant and window in append mode: the windows that the watermark has closed, to a given day."""
    from tiffin.plans.operator_queries import _run, _stream

    e = _stream(s, d).selectExpr("user_id % 20 as restaurant_id", f"{_CITY} as city", "value as total_amount", "ts as updated_at", "case event_type when 'error' then 'DELETE' when 'signup' then 'INSERT' else 'UPDATE' end as op_type")
    out = _run(streams.restaurant_velocity(e, "1 hour")).where(F.col("window_start") < F.lit("2024-01-20").cast("timestamp"))
    return out.select("restaurant_id", "city", "window_start", "order_count", F.round("total_revenue", 4).alias("total_revenue"), F.round("avg_order_value", 4).alias("avg_order_value"))


@_register("stream_rollup", f"select time_bucket(interval 1 minute, ts) as time, {_CITY} as city, count(*) as count, round(sum(value), 4) as total_revenue, count(distinct user_id) as users from events where ts < {_DONE} group by 1, 2")
def _(s, d):
    from tiffin.plans.operator_queries import _app, _run, _stream

    flat = streams.flatten_events(_app(_stream(s, d)))
    out = _run(streams.streaming_rollup(flat, "event_timestamp", ["city"])).where(F.col("time") < F.lit("2024-01-20").cast("timestamp"))
    return out.select("time", "city", "count", F.round("total_revenue", 4).alias("total_revenue"), F.theta_sketch_estimate("users").alias("users"))


@_register("stream_cancel_anomaly_closed", "with recursive x as (select 1)" + _EMA.replace("select city, window_start, n, round(base, 6) as baseline from r where", "select city, window_start, n, round(base, 6) as baseline from r where window_start < timestamp '2024-01-20' and"))
def _(s, d):
    """The stream's anomalies among the windows before a day that the watermark has passed."""
    from tiffin.plans.operator_queries import _app, _run, _stream

    e = _app(_stream(s, d)).where("event_type = 'ORDER_CANCELLED'").select(F.col("location")["city"].alias("city"), "timestamp")
    counts = streams.cancellation_counts(e, "city", "timestamp", "6 hours", "1 hour")
    s.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    out = _run(stateful.ema_anomalies(counts, "city", spike=1.5, least=2)).where(F.col("window_start") < F.lit("2024-01-20").cast("timestamp"))
    return out.select("city", "window_start", "n", F.round("baseline", 6).alias("baseline"))


# --- more sources, alerts and columns ----------------------------------------------------------------------------------------


@_register("q_federated_join", "select n_name, c_mktsegment, count(*) as orders, sum(o_totalprice::decimal(12,2))::double as total from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1, 2")
def _(s, d):
    """Orders from Parquet, customers from ORC and nations from JSON lines, in one plan."""
    base = f"{scratch(s)}/federated-{uuid.uuid4().hex}"
    T(s, d, "customer").write.orc(f"{base}/customer")
    T(s, d, "nation").write.json(f"{base}/nation")
    customer = readers.lake_table(s, f"{base}/customer", "orc").select("c_custkey", "c_mktsegment", "c_nationkey")
    nation, _ = readers.read_json(s, f"{base}/nation", "n_nationkey int, n_name string")
    o = T(s, d, "orders").select("o_custkey", F.col("o_totalprice").cast("decimal(12,2)").alias("price"))
    day = o.groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("price").alias("t"))
    j = day.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name", "c_mktsegment").agg(F.sum("n").alias("orders"), F.sum("t").cast("double").alias("total"))


@_register("q_json_paths", "select event_id, json_extract_string(props, '$.k')::bigint as k, json_extract_string(props, '$.missing.deep') as deep from events")
def _(s, d):
    return T(s, d, "events").select("event_id", *(c.alias(n) for n, c in X.json_paths("props", {"k": ("$.k", "bigint"), "deep": ("$.missing.deep", "string")}).items()))


@_register("q_order_events", "select event_id, case when event_type in ('view', 'error') then null else upper(event_type) end as event_type, case when event_id % 2 = 0 then value else value * 2 end as amount, case when event_id % 3 = 0 then timestamp '2024-01-01 00:00:01' else timestamp '2024-01-01 00:00:02' end as event_time from events")
def _(s, d):
    """Typed order events from JSON text: enumerated types, effective amounts and times, spellings that stand in."""
    first = F.unix_millis(F.lit("2024-01-01 00:00:01").cast("timestamp"))
    event = F.struct("event_id", F.concat(F.lit(" "), "event_type").alias("eventType"), F.when(F.col("event_id") % 2 == 0, F.col("value")).alias("order_amount"), (F.col("value") * 2).alias("total_amount"), F.when(F.col("event_id") % 3 == 0, first).otherwise(0).alias("timestamp"), (first + 1000).alias("updated_at"))
    rows = readers.parse_events(T(s, d, "events").select(F.to_json(event).alias("value")), "event_id bigint, event_type string, order_amount double, total_amount double, timestamp bigint, updated_at bigint", aliases={"event_type": "eventType"})
    kinds = ["PURCHASE", "CLICK", "SIGNUP"]
    return rows.select("event_id", X.parse_enum(F.col("event_type"), kinds).alias("event_type"), X.effective_amount(F.col("order_amount"), F.col("total_amount")).alias("amount"), X.event_time(F.col("timestamp"), F.col("updated_at")).alias("event_time"))


@_register("q_fraud_alerts", """with o as (select user_id::varchar as user_id, event_id::varchar as order_id, ts, 'street ' || (event_id % 3) as a from events where event_type in ('purchase', 'click')),
w as (select o.user_id, o.order_id, o.ts, string_agg(distinct p.a, ',' order by p.a) as distinct_addresses, string_agg(p.order_id, ',' order by p.order_id) as order_ids, count(distinct p.a) as n from o join o p on o.user_id = p.user_id and p.ts between o.ts - interval 5 minutes and o.ts group by 1, 2, 3)
select user_id, order_id, order_ids, distinct_addresses, strftime(ts, '%Y-%m-%d') as dt from w where n >= 2""")
def _(s, d):
    """The alert table's columns, with the orders of each alert and its date."""
    out = cep.multi_address_fraud(_placed(s, d))
    return out.select("user_id", "order_id", "order_ids", "distinct_addresses", F.date_format("window_end", "yyyy-MM-dd").alias("dt"))


@_register("q_session_places", "select user_id, min(ts) as start, string_agg(value::varchar, ';' order by ts, value) as places from (select user_id, ts, round(value, 2)::decimal(12,2) as value from events) group by 1")
def _(s, d):
    e = T(s, d, "events").select("user_id", "ts", F.round("value", 2).cast("decimal(12,2)").alias("latitude"), F.lit(0).alias("longitude"))
    out = cep.session_summary(e)
    return out.select("user_id", "start", F.array_join(F.transform("places", lambda p: p["latitude"].cast("string")), ";").alias("places"))


@_register("q_curated_times", "select order_id, epoch(order_delivered_at - order_accepted_at) / 60.0 as accept_to_deliver_min, (total_amount * (1 - coalesce((select rate from rest e where e.restaurant_id = c.restaurant_id), 0.2)))::decimal(12,2)::double as restaurant_payout, actual_delivery_min > 30 as is_late_delivery from c", _RAW)
def _(s, d):
    return curated(s, d).select("order_id", "accept_to_deliver_min", F.col("restaurant_payout").cast("double"), "is_late_delivery")


@_register("q_merge_upsert_table", "select c_custkey as id, case when c_custkey % 4 = 1 then 'new' else 'base' end as status from customer where c_custkey % 4 <> 2")
def _(s, d):
    """A table of hash buckets: loaded, then changed and partly deleted; read back from its files."""
    path = f"{scratch(s)}/upsert-{uuid.uuid4().hex}"
    base = T(s, d, "customer").selectExpr("c_custkey as id", "'base' as status", "1L as at", "'INSERT' as op_type")
    sinks.upsert(s, base, path, ["id"], ["at"], buckets=8)
    changes = base.where("id % 4 in (1, 2)").selectExpr("id", "'new' as status", "2L as at", "if(id % 4 = 2, 'DELETE', 'UPDATE') as op_type")
    sinks.upsert(s, changes, path, ["id"], ["at"], buckets=8)
    return s.read.parquet(path).select("id", "status")


@_register("q_compact", "select strftime(ts, '%Y-%m-%d') as dt, count(*) as record_count, 1::bigint as file_count from events group by 1")
def _(s, d):
    """A partitioned table of many small files, rewritten into one file a partition, then its health."""
    base = f"{scratch(s)}/compact-{uuid.uuid4().hex}"
    T(s, d, "events").withColumn("dt", F.date_format("ts", "yyyy-MM-dd")).repartition(4).write.partitionBy("dt").parquet(f"{base}/in")
    sinks.compact(s, f"{base}/in", f"{base}/out", "dt", sort_by=["event_id"])
    return sinks.file_health(s, f"{base}/out", "dt").select(F.col("dt").cast("string").alias("dt"), "record_count", "file_count")

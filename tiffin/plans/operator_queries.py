"""Single-operator queries: joins, windows, aggregates, quality, change data, events and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiffin.functions import expr as X
from tiffin.operators import cdc, cep
from tiffin.operators import curated as C
from tiffin.operators import quality as Q
from tiffin.operators.joins import not_in
from tiffin.operators.tables import dealt
from tiffin.plans import binding as B
from tiffin.plans.olap import _EVENTS
from tiffin.plans.queries import _RAW, _register, curated
from tiffin.streaming import stateful, streams

T = B.table
_CITY = "case user_id % 5 when 0 then 'Mumbai' when 1 then 'Delhi' when 2 then 'Pune' when 3 then 'Chennai' else 'Agra' end"

# --- scheduled aggregates -------------------------------------------------------------------------------------------


@_register("q_daily_order_summary", "select restaurant_id, city_name, order_date, count(*) as total_orders, sum(total_amount)::double as total_revenue, count(distinct customer_id) as unique_customers, count(*) filter (is_cancelled) as cancelled_orders, count(*) filter (is_completed) as delivered_orders from c group by 1, 2, 3", _RAW)
def _(s, d):
    return curated(s, d).groupBy("restaurant_id", "city_name", "order_date").agg(F.count("*").alias("total_orders"), F.sum("total_amount").cast("double").alias("total_revenue"), F.count_distinct("customer_id").alias("unique_customers"), F.count_if("is_cancelled").alias("cancelled_orders"), F.count_if("is_completed").alias("delivered_orders"))


@_register("q_daily_user_activity", f"select u.city_name, count(distinct u.user_id) as active_users, count(distinct case when u.is_pro_member then u.user_id end) as pro_users, count(c.order_id) as total_orders, sum(c.total_amount)::double / count(c.order_id) as avg_spend from usr u left join c on c.customer_id = u.user_id and c.order_date >= date '{B.AS_OF}' - 30 group by 1", _RAW)
def _(s, d):
    u, o = B.users(s, d), curated(s, d).where(F.col("order_date") >= F.date_sub(F.lit(B.AS_OF).cast("date"), 30)).select("order_id", "customer_id", "total_amount")
    j = u.join(o, u.user_id == o.customer_id, "left")
    return j.groupBy("city_name").agg(F.count_distinct("user_id").alias("active_users"), F.count_distinct(F.when(F.col("is_pro_member"), F.col("user_id"))).alias("pro_users"), F.count("order_id").alias("total_orders"), X.ratio(F.sum("total_amount"), F.count("order_id")).alias("avg_spend"))


@_register("q_popular_items", "select p_type, p_name, count(*) as order_count, round(sum(p_retailprice), 2) as total_revenue from lineitem join part on l_partkey = p_partkey group by 1, 2")
def _(s, d):
    j = T(s, d, "lineitem").select("l_partkey").join(T(s, d, "part").select("p_partkey", "p_type", "p_name", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
    return j.groupBy("p_type", "p_name").agg(F.count("*").alias("order_count"), F.round(F.sum("p_retailprice"), 2).alias("total_revenue"))


@_register("q_promo_effectiveness", """, p as (select order_date, coupon_code, sum(discount_amount) as d, count(*) as m from c where coupon_code is not null group by 1, 2), o as (select order_date, count(*) as n, sum(total_amount) as g from c group by 1)
select coupon_code, sum(n * m)::bigint as usage_count, sum(g * m)::double as total_order_value, sum(d * n)::double as total_discount_given from p join o using (order_date) group by 1""", _RAW)
def _(s, d):
    """Orders times promotions of the same day; both sides are aggregated by day first, so the product is never built."""
    c = curated(s, d)
    promo = c.where("coupon_code is not null").groupBy("order_date", "coupon_code").agg(F.sum("discount_amount").alias("d"), F.count("*").alias("m"))
    day = c.groupBy("order_date").agg(F.count("*").alias("n"), F.sum("total_amount").alias("g"))
    return promo.join(day, "order_date").groupBy("coupon_code").agg(F.sum(F.col("n") * F.col("m")).alias("usage_count"), F.sum(F.col("g") * F.col("m")).cast("double").alias("total_order_value"), F.sum(F.col("d") * F.col("n")).cast("double").alias("total_discount_given"))


@_register("q_saved_gmv", f"select city_name, sum(total_amount)::double as gmv, count(*) as orders from c where order_date = date '{B.AS_OF}' group by 1", _RAW)
def _(s, d):
    return curated(s, d).where(F.col("order_date") == F.lit(B.AS_OF).cast("date")).groupBy("city_name").agg(F.sum("total_amount").cast("double").alias("gmv"), F.count("*").alias("orders"))


@_register("q_saved_sla", "select city_name, count(*) filter (sla_breach) as breaches, count(*) filter (sla_breach)::double / nullif(count(*) filter (is_completed), 0) * 100 as breach_pct from c group by 1", _RAW)
def _(s, d):
    b, n = F.count_if("sla_breach"), F.count_if("is_completed")
    return curated(s, d).groupBy("city_name").agg(b.alias("breaches"), (X.ratio(b, n) * 100).alias("breach_pct"))


@_register("q_saved_active", f"select user_segment, count(distinct customer_id) as active_users from c where order_date > date '{B.AS_OF}' - 30 group by 1", _RAW)
def _(s, d):
    return curated(s, d).where(F.col("order_date") > F.date_sub(F.lit(B.AS_OF).cast("date"), 30)).groupBy("user_segment").agg(F.count_distinct("customer_id").alias("active_users"))


# --- aggregates ---------------------------------------------------------------------------------------------------


@_register("q_filter_agg", "select l_returnflag, count(*) filter (l_discount > 0.05) as discounted, count(*) as n, avg(l_quantity) filter (l_tax > 0.02) as q from lineitem group by 1")
def _(s, d):
    return T(s, d, "lineitem").groupBy("l_returnflag").agg(F.expr("count(*) filter (where l_discount > 0.05)").alias("discounted"), F.count("*").alias("n"), F.avg(F.when(F.col("l_tax") > 0.02, F.col("l_quantity"))).alias("q"))


@_register("q_count_distinct", "select o_orderstatus, count(distinct o_custkey) as users, count(distinct o_custkey) filter (o_totalprice > 100000) as big from orders group by 1")
def _(s, d):
    o = dealt(T(s, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), "o_orderkey")
    return o.groupBy("o_orderstatus").agg(F.count_distinct("o_custkey").alias("users"), F.count_distinct(F.when(F.col("o_totalprice") > 100000, F.col("o_custkey"))).alias("big"))


@_register("q_cond_sum", "select o_orderpriority, sum(case when o_orderstatus = 'F' then 1 else 0 end)::bigint as done, sum(case when o_orderstatus = 'P' then 1 else 0 end)::bigint as lost from orders group by 1")
def _(s, d):
    n = lambda v: F.sum(F.when(F.col("o_orderstatus") == v, 1).otherwise(0))
    return T(s, d, "orders").groupBy("o_orderpriority").agg(n("F").alias("done"), n("P").alias("lost"))


@_register("q_percentile_cont", "select l_linestatus, quantile_cont(l_extendedprice, 0.75) as p75 from lineitem group by 1")
def _(s, d):
    return T(s, d, "lineitem").groupBy("l_linestatus").agg(F.expr("percentile_cont(0.75) within group (order by l_extendedprice)").alias("p75"))


@_register("q_approx_pct", None)
def _(s, d):
    return T(s, d, "lineitem").groupBy("l_linestatus").agg(*(F.percentile_approx("l_extendedprice", F.lit(p), F.lit(10000)).alias(n) for n, p in (("p50", 0.5), ("p90", 0.9), ("p99", 0.99))))


@_register("q_two_level_agg", "select o_custkey, avg(t) as avg_day, count(*) as days from (select o_custkey, o_orderdate, sum(o_totalprice::decimal(12,2))::double as t from orders group by 1, 2) group by 1 having count(*) >= 2")
def _(s, d):
    day = T(s, d, "orders").groupBy("o_custkey", "o_orderdate").agg(F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("double").alias("t"))
    return day.groupBy("o_custkey").agg(F.avg("t").alias("avg_day"), F.count("*").alias("days")).where("days >= 2")


@_register("q_rollup_scope", "select coalesce(city_name, 'ALL') as scope, order_date, count(*) as orders from c group by rollup (order_date, city_name) having order_date is not null", _RAW)
def _(s, d):
    return curated(s, d).rollup("order_date", "city_name").agg(F.count("*").alias("orders")).where("order_date is not null").select(F.coalesce("city_name", F.lit("ALL")).alias("scope"), "order_date", "orders")


# --- joins --------------------------------------------------------------------------------------------------------


@_register("q_join_inner", "select o_orderkey, c_mktsegment, n_name from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey where o_orderstatus = 'P'")
def _(s, d):
    o = T(s, d, "orders").where("o_orderstatus = 'P'").select("o_orderkey", "o_custkey")
    return o.join(T(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(T(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("o_orderkey", "c_mktsegment", "n_name")


@_register("q_join_left", "select c_custkey, count(o_orderkey) as orders from customer left join orders on o_custkey = c_custkey group by 1")
def _(s, d):
    o = T(s, d, "orders").groupBy("o_custkey").agg(F.count("o_orderkey").alias("orders"))
    return T(s, d, "customer").join(o, F.col("o_custkey") == F.col("c_custkey"), "left").select("c_custkey", F.coalesce("orders", F.lit(0)).alias("orders"))


@_register("q_join_left_on_pred", "select c_custkey, o_orderkey from customer left join orders on o_custkey = c_custkey and o_orderdate >= timestamp '2001-06-01'")
def _(s, d):
    o, c = T(s, d, "orders"), T(s, d, "customer")
    return c.join(o, (o.o_custkey == c.c_custkey) & (o.o_orderdate >= F.lit("2001-06-01").cast("timestamp")), "left").select("c_custkey", "o_orderkey")


@_register("q_join_interval", "select a.o_custkey, count(*) as pairs from orders a join orders b on a.o_custkey = b.o_custkey and a.o_orderkey <> b.o_orderkey and b.o_orderdate between a.o_orderdate and a.o_orderdate + interval 30 days group by 1")
def _(s, d):
    """A range frame counts the orders of the next 30 days, so no pair is built."""
    w = Window.partitionBy("o_custkey").orderBy("at").rangeBetween(0, 30 * 86400)
    rows = T(s, d, "orders").select("o_custkey", F.unix_timestamp("o_orderdate").alias("at"))
    return rows.withColumn("n", F.count("*").over(w) - 1).groupBy("o_custkey").agg(F.sum("n").alias("pairs")).where("pairs > 0")


@_register("q_join_anti", "select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_totalprice > 300000)")
def _(s, d):
    return not_in(T(s, d, "customer").select("c_custkey"), "c_custkey", T(s, d, "orders").where("o_totalprice > 300000").select("o_custkey"), "o_custkey")


@_register("q_join_semi", "select s_suppkey, s_name from supplier where s_suppkey in (select l_suppkey from lineitem where l_discount >= 0.1)")
def _(s, d):
    hit = T(s, d, "lineitem").where("l_discount >= 0.1").select(F.col("l_suppkey").alias("s_suppkey"))
    return T(s, d, "supplier").join(hit, "s_suppkey", "left_semi").select("s_suppkey", "s_name")


@_register("q_scalar_subquery", "select o_orderkey from orders where o_orderdate = (select max(o_orderdate) from orders)")
def _(s, d):
    o = T(s, d, "orders")
    return o.join(o.agg(F.max("o_orderdate").alias("o_orderdate")), "o_orderdate", "left_semi").select("o_orderkey")


@_register("q_period_compare", "with m as (select date_trunc('month', o_orderdate)::date as m, sum(o_totalprice::decimal(12,2))::double as g from orders group by 1) select a.m, a.g, round((a.g - b.g) / b.g * 100, 4) as growth_pct from m a left join m b on b.m = (a.m - interval 1 month)::date")
def _(s, d):
    m = T(s, d, "orders").groupBy(F.to_date(F.date_trunc("month", "o_orderdate")).alias("m")).agg(F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("double").alias("g"))
    before = m.select(F.add_months("m", 1).alias("m"), F.col("g").alias("b"))
    return m.join(before, "m", "left").select("m", "g", X.growth("g", "b", 4).alias("growth_pct"))


# --- windows and top-k --------------------------------------------------------------------------------------------


@_register("q_dedup_latest", "select user_id, event_id, event_type from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as rn from events) where rn = 1")
def _(s, d):
    return C.latest_by_key(T(s, d, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@_register("q_rank", "select n_name, g, (rank() over (order by g desc))::int as r from (select n_name, count(*) as g from customer join nation on c_nationkey = n_nationkey group by 1)")
def _(s, d):
    g = T(s, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("g")).join(T(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return g.select("n_name", "g", F.rank().over(Window.orderBy(F.col("g").desc())).alias("r"))


@_register("q_rank_partitioned", "select p_partkey, (rank() over (partition by p_brand order by p_retailprice desc))::int as r from part")
def _(s, d):
    return T(s, d, "part").select("p_partkey", F.rank().over(Window.partitionBy("p_brand").orderBy(F.col("p_retailprice").desc())).alias("r"))


@_register("q_lag7", "select l_suppkey, day, n, lag(n, 7) over (partition by l_suppkey order by day) as n7 from (select l_suppkey, l_shipdate::date as day, count(*) as n from lineitem group by 1, 2)")
def _(s, d):
    g = T(s, d, "lineitem").groupBy("l_suppkey", F.to_date("l_shipdate").alias("day")).agg(F.count("*").alias("n"))
    return g.withColumn("n7", F.lag("n", 7).over(Window.partitionBy("l_suppkey").orderBy("day")))


@_register("q_first_last", "select distinct o_custkey, first_value(o_orderkey) over w as a, last_value(o_orderkey) over w as b, count(*) over w as n from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey rows between unbounded preceding and unbounded following)")
def _(s, d):
    at = F.struct("o_orderdate", "o_orderkey")
    return T(s, d, "orders").groupBy("o_custkey").agg(F.min_by("o_orderkey", at).alias("a"), F.max_by("o_orderkey", at).alias("b"), F.count("*").alias("n"))


@_register("q_win_total", "select l_orderkey, l_linenumber, l_partkey, count(*) over (partition by l_orderkey) as n, max(l_quantity) over (partition by l_orderkey) as q from lineitem")
def _(s, d):
    w = Window.partitionBy("l_orderkey")
    return T(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.count("*").over(w).alias("n"), F.max("l_quantity").over(w).alias("q"))


@_register("q_topk", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 100")
def _(s, d):
    return T(s, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(100)


def _placed(s, d) -> DataFrame:
    e = T(s, d, "events").where("event_type in ('purchase', 'click')")
    return e.selectExpr("cast(user_id as string) as user_id", "cast(event_id as string) as order_id", "ts", "'PLACED' as status", "concat(' Street  ', event_id % 3) as address")


_FRAUD = """with o as (select user_id::varchar as user_id, event_id::varchar as order_id, ts, 'street ' || (event_id % 3) as a from events where event_type in ('purchase', 'click')),
w as (select o.user_id, o.order_id, o.ts, string_agg(distinct p.a, ',' order by p.a) as distinct_addresses, count(distinct p.a)::int as address_count, count(*)::int as order_count, min(p.ts) as window_start from o join o p on o.user_id = p.user_id and p.ts between o.ts - interval 5 minutes and o.ts group by 1, 2, 3)
select user_id, order_id, distinct_addresses, address_count, order_count, window_start, ts as window_end, case when address_count >= 4 or order_count >= 6 then 'CRITICAL' when address_count >= 3 or order_count >= 4 then 'HIGH' else 'MEDIUM' end as severity from w where address_count >= 2"""


@_register("q_fraud_batch", _FRAUD)
def _(s, d):
    return cep.multi_address_fraud(_placed(s, d)).drop("order_ids")


@_register("q_rapid_fire", "select event_id, user_id from (select *, lag(ts, 3) over (partition by user_id order by ts, event_id) as t from events) where ts - t <= interval 120 minutes")
def _(s, d):
    return cep.look_back_rule(T(s, d, "events"), ["user_id"], "ts", "event_id", 7200).select("event_id", "user_id")


@_register("q_promo_abuse", "select event_id, user_id from (select *, lag(ts, 3) over (partition by user_id, json_extract_string(props, '$.k')::int % 3 order by ts, event_id) as t from events) where ts - t <= interval 600 minutes")
def _(s, d):
    e = T(s, d, "events").withColumn("promo", F.get_json_object("props", "$.k").cast("int") % 3)
    return cep.look_back_rule(e, ["user_id", "promo"], "ts", "event_id", 36000).select("event_id", "user_id")


@_register("q_high_value", "select event_id, value from events where value > 50")
def _(s, d):
    return cep.high_value(T(s, d, "events"), "value", 50).select("event_id", "value")


@_register("q_haversine", "select event_id, round(2 * 6371.0 * atan2(sqrt(a), sqrt(1 - a)), 6) as km from (select event_id, pow(sin(radians(28.6139 - (12.5 + (event_id % 100) / 100.0)::double) / 2), 2) + cos(radians((12.5 + (event_id % 100) / 100.0)::double)) * cos(radians(28.6139)) * pow(sin(radians(77.209 - (77.25 + (event_id % 50) / 100.0)::double) / 2), 2) as a from events)")
def _(s, d):
    f = streams.flatten_events(B.app_events(s, d))
    return f.select(F.col("event_id").cast("long"), F.round(X.haversine_km(F.col("latitude"), F.col("longitude"), F.lit(28.6139), F.lit(77.209)), 6).alias("km"))


def _counts(s, d) -> DataFrame:
    e = B.app_events(s, d).where("event_type = 'ORDER_CANCELLED'").select(F.try_element_at("location", F.lit("city")).alias("city"), "timestamp")
    return cep.window_counts(e, "city", "timestamp", "6 hours", "1 hour")


_EMA = f""", k as (select {_CITY} as city, ts from events where event_type = 'error'),
w as (select city, h as window_start, count(*) as n from (select city, unnest(generate_series(time_bucket(interval 1 hour, ts) - interval 5 hours, time_bucket(interval 1 hour, ts), interval 1 hour)) as h from k) group by 1, 2),
o as (select *, row_number() over (partition by city order by window_start) as i from w),
r as (select city, i, window_start, n, null::double as base, n::double as ema from o where i = 1 union all select o.city, o.i, o.window_start, o.n, r.ema, 0.3::double * o.n + 0.7::double * r.ema from r join o on o.city = r.city and o.i = r.i + 1)
select city, window_start, n, round(base, 6) as baseline from r where i > 1 and n >= 2 and case when base > 0 then n / base else n end >= 1.5"""


@_register("q_ema_anomaly", "with recursive x as (select 1)" + _EMA)
def _(s, d):
    return cep.ema_anomalies(_counts(s, d), "city", spike=1.5, least=2).select("city", "window_start", "n", F.round("baseline", 6).alias("baseline"))


@_register("q_session_summary", "select user_id, min(ts) as start, max(ts) as end, count(*) as pings from events group by 1")
def _(s, d):
    e = T(s, d, "events").selectExpr("user_id", "ts", "value as latitude", "value as longitude")
    return cep.session_summary(e).select("user_id", "start", "end", "pings")


# --- data quality -------------------------------------------------------------------------------------------------


@_register("q_dq_nulls", "select 'restaurant_id' as column, count(*) - count(restaurant_id) as nulls, count(*) as rows from raw union all select 'coupon_code', count(*) - count(coupon_code), count(*) from raw", _RAW)
def _(s, d):
    return Q.null_ratios(B.raw_orders(s, d), ["restaurant_id", "coupon_code"]).select("column", "nulls", "rows")


@_register("q_dq_duplicates", "select count(*) as rows, count(distinct (user_id, event_type)) as distinct_keys, count(*) - count(distinct (user_id, event_type)) as duplicates from events")
def _(s, d):
    return Q.duplicate_keys(T(s, d, "events"), ["user_id", "event_type"])


@_register("q_dq_freshness", "select 'events' as table, max(ts)::timestamp as newest, max(ts) >= timestamp '2024-01-30' - interval 7 hours as fresh from events union all select 'orders', max(o_orderdate)::timestamp, max(o_orderdate) >= timestamp '2024-01-30' - interval 10 minutes from orders")
def _(s, d):
    return Q.freshness({"events": (T(s, d, "events"), "ts", 420), "orders": (T(s, d, "orders"), "o_orderdate", 10)}, "2024-01-30").select("table", "newest", "fresh")


@_register("q_dq_rowcount", "select 'orders' as table, count(*) as rows, count(*) >= 10000 as passed from orders union all select 'customer', count(*), count(*) >= 100000 from customer")
def _(s, d):
    return Q.row_counts({"orders": (T(s, d, "orders"), 10_000), "customer": (T(s, d, "customer"), 100_000)}).select("table", "rows", "passed")


@_register("q_dq_rules", "select 'total_positive' as rule, count(*) filter (not coalesce(total_amount > 0, false)) as failures, count(*) as rows from raw union all select 'subtotal_below_total', count(*) filter (not coalesce(total_amount - tax_amount - 30 <= total_amount, false)), count(*) from raw union all select 'rating_range', count(*) filter (not coalesce(order_rating between 0 and 5, false)), count(*) from raw union all select 'status_known', 0, count(*) from raw", _RAW)
def _(s, d):
    rules = {"total_positive": F.col("total_amount") > 0, "subtotal_below_total": F.col("subtotal_amount") <= F.col("total_amount"), "rating_range": F.col("order_rating").between(0, 5), "status_known": F.col("order_status").isin("placed", "delivered", "cancelled")}
    return Q.rule_failures(B.raw_orders(s, d), rules)


@_register("q_dq_ref_integrity", "select l_orderkey, l_suppkey from lineitem where l_suppkey is not null and l_suppkey not in (select s_suppkey from supplier where s_nationkey < 20)")
def _(s, d):
    return Q.referential_gaps(T(s, d, "lineitem"), "l_suppkey", T(s, d, "supplier").where("s_nationkey < 20"), "s_suppkey").select("l_orderkey", "l_suppkey")


@_register("q_dq_transitions", "select event_id, previous, event_type from (select *, lag(event_type) over (partition by user_id order by ts, event_id) as previous from events) where previous is not null and previous <> event_type and not (previous = 'signup' and event_type in ('view', 'click') or previous = 'view' and event_type in ('click', 'purchase') or previous = 'click' and event_type in ('purchase', 'error'))")
def _(s, d):
    legal = {"signup": ["view", "click"], "view": ["click", "purchase"], "click": ["purchase", "error"]}
    return Q.illegal_transitions(T(s, d, "events"), "user_id", "event_type", "ts", "event_id", legal).select("event_id", "previous", "event_type")


@_register("q_throughput_drop", "select bucket, n, round(m, 6) as mean_before, coalesce(n < m * 0.5, false) as dropped from (select *, avg(n) over (order by bucket rows between 12 preceding and 1 preceding) as m from (select time_bucket(interval 1 hour, ts) as bucket, count(*) as n from events group by 1))")
def _(s, d):
    return Q.throughput_drops(T(s, d, "events"), "ts", 0.5, "1 hour").withColumn("mean_before", F.round("mean_before", 6))


@_register("q_error_rate", "select bucket, n, errors, round(errors / (n + 0.001), 6) as error_rate, case when errors / (n + 0.001) > 0.2 then 'critical' when errors / (n + 0.001) > 0.05 then 'warning' else 'ok' end as level from (select time_bucket(interval 1 hour, ts) as bucket, count(*) as n, count(*) filter (event_type = 'error') as errors from events group by 1)")
def _(s, d):
    return Q.error_rates(T(s, d, "events"), "ts", F.col("event_type") == "error").withColumn("error_rate", F.round("error_rate", 6))


# --- events and change data -----------------------------------------------------------------------------------------


@_register("q_event_flatten", "select event_id::varchar as event_id, event_type, user_id::varchar as user_id, ts as event_timestamp, city, platform, value as total_amount, strftime(ts, '%Y-%m-%d') as dt, hour(ts)::int as hour from e", _EVENTS)
def _(s, d):
    return streams.flatten_events(B.app_events(s, d)).select("event_id", "event_type", "user_id", "event_timestamp", "city", "platform", "total_amount", "dt", "hour")


@_register("q_olap_feed", "select ts as __time, event_type, user_id::varchar as user_id, 's' || user_id as session_id, city, platform, event_id::varchar as order_id, value as total_amount, 1::int as event_count from e", _EVENTS)
def _(s, d):
    return streams.olap_feed(B.app_events(s, d))


@_register("q_route_topics", "select event_id::varchar as event_id, case event_type when 'ORDER_PLACED' then 'orders' when 'ORDER_CANCELLED' then 'orders' when 'MENU_VIEWED' then 'menu' else 'users' end as topic from e", _EVENTS)
def _(s, d):
    topics = {"ORDER_PLACED": "orders", "ORDER_CANCELLED": "orders", "MENU_VIEWED": "menu", "USER_SIGNUP": "users"}
    return B.app_events(s, d).select("event_id", X.route_topic(F.col("event_type"), topics, "users").alias("topic"))


def _changes(s, d) -> DataFrame:
    e = T(s, d, "events")
    row = F.struct(F.col("user_id").alias("id"), F.col("value").alias("amount"), F.col("event_type").alias("status"), F.lit("x").alias("email"))
    op = F.when(F.col("event_type") == "error", "d").when(F.col("event_type") == "signup", "c").otherwise("u")
    return e.select(F.when(op == "d", row).alias("before"), F.when(op != "d", row).alias("after"), op.alias("op"), F.unix_millis("ts").alias("ts_ms"), "event_id")


@_register("q_cdc_project", "select user_id as id, value as amount, event_type as status, case event_type when 'error' then 'DELETE' when 'signup' then 'INSERT' else 'UPDATE' end as op_type, event_type = 'error' as __deleted from events")
def _(s, d):
    return cdc.unwrap(_changes(s, d), ("email",)).drop("changed_at")


@_register("q_upsert", """with t as (select c_custkey as id, c_acctbal as amount, 'base' as status from customer),
l as (select * from (select user_id as id, value as amount, event_type as status, row_number() over (partition by user_id order by epoch_ms(ts) desc, event_id desc) as rn from events) where rn = 1)
select id, amount, status from l where status <> 'error' union all select id, amount, status from t where id not in (select id from l)""")
def _(s, d):
    base = T(s, d, "customer").selectExpr("c_custkey as id", "c_acctbal as amount", "'base' as status")
    e = _changes(s, d)
    flat = e.select(F.coalesce("after.id", "before.id").alias("id"), F.coalesce("after.amount", "before.amount").alias("amount"), F.coalesce("after.status", "before.status").alias("status"), F.when(F.col("op") == "d", "DELETE").otherwise("UPDATE").alias("op_type"), "ts_ms", "event_id")
    return cdc.apply_changes(base, flat, ["id"], ["ts_ms", "event_id"])


def _records(s, d) -> DataFrame:
    attr = lambda kind, v: F.struct(*((v if k == kind else F.lit(None).cast("boolean" if k in ("BOOL", "NULL") else "string")).alias(k) for k in ("S", "N", "BOOL", "NULL")))
    image = F.create_map(F.lit("id"), attr("N", F.col("user_id").cast("string")), F.lit("kind"), attr("S", F.col("event_type")), F.lit("big"), attr("BOOL", F.col("value") > 50))
    gone = F.col("event_type") == "error"
    dyn = F.struct(F.unix_timestamp("ts").alias("ApproximateCreationDateTime"), F.col("event_id").cast("string").alias("SequenceNumber"), F.when(~gone, image).alias("NewImage"), F.when(gone, image).alias("OldImage"))
    return T(s, d, "events").select(F.col("event_id").cast("string").alias("eventID"), F.when(gone, "REMOVE").otherwise("MODIFY").alias("eventName"), F.lit("arn:x:table/sessions/stream").alias("eventSourceARN"), dyn.alias("dynamodb"))


@_register("q_typed_attr_decode", "select event_id::varchar as event_id, 'sessions' as table_name, user_id::varchar as id, event_type as kind, (value > 50)::varchar as big from events")
def _(s, d):
    f = cdc.flatten_change_records(_records(s, d))
    return f.select("event_id", "table_name", F.col("data")["id"].alias("id"), F.col("data")["kind"].alias("kind"), F.col("data")["big"].alias("big"))


@_register("q_change_project", "select id, kind, dt from (select user_id as id, event_type as kind, strftime(ts, '%Y-%m-%d') as dt, row_number() over (partition by user_id order by epoch(ts)::bigint desc, event_id desc) as rn from (select * replace (date_trunc('second', ts) as ts) from events)) where rn = 1")
def _(s, d):
    f = cdc.latest_records(cdc.flatten_change_records(_records(s, d)), "id")
    return cdc.project_records(f, "sessions", {"id": "long", "kind": "string"}).select("id", "kind", "dt")


# --- streams: run over what the source has, compared with batch SQL ---------------------------------------------------


def _stream(s, d) -> DataFrame:
    """The events table as a file stream of app events."""
    path = f"{d}/events.parquet"
    schema = s.read.parquet(path).schema
    raw = s.readStream.schema(schema).parquet(path + "*")
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def scratch(spark: SparkSession) -> str:
    """The shared folder in spark.checkpoint.dir, or the context's; in local mode, without either, a folder of its own."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if base is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        base = tempfile.mkdtemp(prefix="tiffin-")
        sc.setCheckpointDir(base)
    return base


def _run(df: DataFrame, mode: str = "append") -> DataFrame:
    return streams.run_once(df, f"{scratch(df.sparkSession)}/stream-{uuid.uuid4().hex}", mode)


def _app(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        "cast(event_id as string) as event_id", "case event_type when 'purchase' then 'ORDER_PLACED' when 'error' then 'ORDER_CANCELLED' else 'OTHER' end as event_type", "'app' as source", "cast(user_id as string) as user_id", "concat('s', cast(user_id as string)) as session_id", "ts as timestamp",
        "map('total_amount', cast(value as string), 'order_id', cast(event_id as string)) as properties", "map('platform', 'web') as device", f"map('city', {_CITY}) as location",
    )


_VELOCITY = f"select {_CITY} as city, time_bucket(interval 1 hour, ts) as window_start, count(*) as order_count, round(sum(value), 4) as total_revenue, count(distinct user_id) as unique_users from events where event_type = 'purchase' group by 1, 2"


@_register("stream_city_velocity", _VELOCITY)
def _(s, d):
    out = _run(streams.city_velocity(_app(_stream(s, d)), "1 hour"), "complete")
    return out.select("city", "window_start", "order_count", F.round("total_revenue", 4).alias("total_revenue"), "unique_users")


@_register("stream_spike_alerts", f"select city, window_start, order_count, case when order_count > 1000 then 'CRITICAL' when order_count > 500 then 'WARNING' else 'NORMAL' end as alert_level from ({_VELOCITY}) where order_count > 2")
def _(s, d):
    out = _run(streams.spike_alerts(streams.city_velocity(_app(_stream(s, d)), "1 hour"), 2), "complete")
    return out.select("city", "window_start", "order_count", "alert_level")


@_register("stream_sessions", "select user_id::varchar as user_id, min(ts) as session_start, count(*) as events from (select *, sum(case when ts - prev <= interval 30 minutes then 0 else 1 end) over (partition by user_id order by ts, event_id) as k from (select *, lag(ts) over (partition by user_id order by ts, event_id) as prev from events)) group by user_id, k")
def _(s, d):
    return _run(streams.sessions(_app(_stream(s, d))), "complete").select("user_id", "session_start", "events")


@_register("stream_dedup", "select count(*) as events, count(distinct event_id) as ids from events")
def _(s, d):
    out = _run(streams.dedup(_app(_stream(s, d)), ["event_id"], "timestamp", "60 days"))
    return out.agg(F.count("*").alias("events"), F.count_distinct(F.col("event_id").cast("long")).alias("ids"))


@_register("stream_cancel_counts", f"select city, h as window_start, count(*) as n from (select {_CITY} as city, unnest(generate_series(time_bucket(interval 1 minute, ts) - interval 9 minutes, time_bucket(interval 1 minute, ts), interval 1 minute)) as h from events where event_type = 'error') group by 1, 2")
def _(s, d):
    e = _app(_stream(s, d)).where("event_type = 'ORDER_CANCELLED'").select(F.col("location")["city"].alias("city"), "timestamp")
    return _run(streams.cancellation_counts(e, "city", "timestamp"), "complete").select("city", "window_start", "n")


@_register("stream_fraud", _FRAUD)
def _(s, d):
    o = _stream(s, d).where("event_type in ('purchase', 'click')").selectExpr("cast(user_id as string) as user_id", "cast(event_id as string) as order_id", "ts", "'PLACED' as status", "concat(' Street  ', event_id % 3) as address")
    return _run(stateful.multi_address_fraud(o)).drop("order_ids")


@_register("stream_cancel_anomaly", None)
def _(s, d):
    """Closed windows stream into keyed averages; windows that the watermark has not closed give no alert yet."""
    e = _app(_stream(s, d)).where("event_type = 'ORDER_CANCELLED'").select(F.col("location")["city"].alias("city"), "timestamp")
    counts = streams.cancellation_counts(e, "city", "timestamp", "6 hours", "1 hour")
    s.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return _run(stateful.ema_anomalies(counts, "city", spike=1.5, least=2))

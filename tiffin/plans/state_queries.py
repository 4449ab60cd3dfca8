"""Queries on kept state: versioned tables, exact selection, streams with keyed rules and several sinks, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tiffin.operators import cep, quality, rollup, selection
from tiffin.plans import binding as B
from tiffin.plans.operator_queries import _run, _stream
from tiffin.plans.queries import _register
from tiffin.operators.tables import shared_folder
from tiffin.sources import segments, sinks
from tiffin.streaming import rules, streams

T = B.table
_CLOSED = "timestamp '2024-01-20'"
_DAY = 86400


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _rocksdb(spark) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", rules.ROCKSDB)


# --- versioned tables ----------------------------------------------------------------------------------------------------

_LATEST = "select * from (select user_id as id, value as amount, event_type as status, ts, event_id, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1"


def _order_changes(s, d):
    return T(s, d, "events").selectExpr("user_id as id", "value as amount", "event_type as status", "ts", "event_id", "if(event_type = 'error', 'DELETE', 'UPDATE') as op_type")


@_register("q_upsert_out_of_order", f"select id, amount, status from ({_LATEST}) where status <> 'error'")
def _(s, d):
    """Changes in three batches that are not in order, the first one twice: late older ones lose, deleted keys stay so."""
    path, changes = _folder(s, "versions"), _order_changes(s, d)
    for part in (2, 0, 1, 2):
        sinks.upsert(s, changes.where(f"event_id % 3 = {part}"), path, ["id"], ["ts", "event_id"], buckets=8)
    return sinks.read_upserted(s, path).select("id", "amount", "status")


@_register("q_upsert_horizon", f"select id, amount, status from ({_LATEST}) where status <> 'error' and ts >= timestamp '2024-01-15'")
def _(s, d):
    """After a horizon, changes before it reach only keys of which something is stored, and old graves are forgotten."""
    path, changes = _folder(s, "horizon"), _order_changes(s, d)
    late = changes.where("ts >= timestamp '2024-01-15'")
    sinks.upsert(s, late, path, ["id"], ["ts", "event_id"], buckets=8, horizon="2024-01-15 00:00:00")
    sinks.upsert(s, changes.where("ts < timestamp '2024-01-15'"), path, ["id"], ["ts", "event_id"], buckets=8)
    return sinks.read_upserted(s, path).select("id", "amount", "status")


@_register("stream_upsert", f"select id, amount, status from ({_LATEST}) where status <> 'error'")
def _(s, d):
    """A change stream into a versioned table, one upsert an epoch."""
    path, base = _folder(s, "versions"), _folder(s, "stream")
    changes = _stream(s, d).selectExpr("user_id as id", "value as amount", "event_type as status", "ts", "event_id", "if(event_type = 'error', 'DELETE', 'UPDATE') as op_type")
    write = sinks.fan_out({"table": sinks.UpsertSink(path, ["id"], ["ts", "event_id"], buckets=8)}, sinks.CommitLog(s, f"{base}/log", "upsert"))
    streams.drain(changes, write, f"{base}/checkpoint")
    return sinks.read_upserted(s, path).select("id", "amount", "status")


@_register("stream_fan_out", "select 'files' as sink, event_type, count(*) as n, round(sum(value), 2) as total from events group by 2 union all select 'large', event_type, count(*), round(sum(value), 2) from events where value > 100 group by 2")
def _(s, d):
    """One stream into two tables of files by epoch, each epoch once, read as the log says."""
    base = _folder(s, "fan-out")
    files, large, log = sinks.EpochFiles(f"{base}/files"), sinks.EpochFiles(f"{base}/large", partition_by=("event_type",)), sinks.CommitLog(s, f"{base}/log", "events")
    events = _stream(s, d).select("event_id", "event_type", "value")
    write = sinks.fan_out({"files": files, "large": sinks.Selected(large, "value > 100")}, log)
    streams.drain(events, write, f"{base}/checkpoint")
    count = lambda sink, name: sink.read(s, log, name).groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")).select(F.lit(name).alias("sink"), "event_type", "n", "total")
    return count(files, "files").unionByName(count(large, "large"))


# --- exact percentiles ---------------------------------------------------------------------------------------------------


@_register("q_percentile_select", "select l_linestatus, quantile_cont(l_extendedprice, 0.5) as p50, quantile_cont(l_extendedprice, 0.9) as p90, quantile_cont(l_extendedprice, 0.99) as p99, quantile_cont(l_extendedprice, 0.0) as least, quantile_cont(l_extendedprice, 1.0) as most from lineitem group by 1")
def _(s, d):
    """Exact percentiles of two groups that hold all rows, by selection in passes."""
    return selection.exact_percentiles(T(s, d, "lineitem"), ["l_linestatus"], "l_extendedprice", {"p50": 0.5, "p90": 0.9, "p99": 0.99, "least": 0.0, "most": 1.0})


@_register("q_percentile_many_groups", "select o_custkey, o_orderpriority, quantile_cont(o_totalprice, 0.75) as p75 from orders group by 1, 2")
def _(s, d):
    return selection.exact_percentiles(T(s, d, "orders"), ["o_custkey", "o_orderpriority"], "o_totalprice", {"p75": 0.75})


# --- keyed rules -----------------------------------------------------------------------------------------------------------

_PLACES = "value * 17 % 160 - 80 as latitude, event_id * 37 % 360 - 180 as longitude"
_TRAVEL = f"""with e as (select event_id, user_id, ts, {_PLACES} from events),
p as (select *, lag(ts) over w as last_ts, lag(latitude) over w as a, lag(longitude) over w as b from e window w as (partition by user_id order by ts, event_id)),
h as (select *, pow(sin(radians(latitude - a) / 2), 2) + cos(radians(a)) * cos(radians(latitude)) * pow(sin(radians(longitude - b) / 2), 2) as h from p where ts - last_ts <= interval 90 minutes)
select event_id, user_id, last_ts, round(2 * 6371.0 * atan2(sqrt(h), sqrt(1 - h)), 4) as distance_km from h where 2 * 6371.0 * atan2(sqrt(h), sqrt(1 - h)) > 500"""


@_register("q_impossible_travel", _TRAVEL)
def _(s, d):
    e = T(s, d, "events").selectExpr("event_id", "user_id", "ts", *_PLACES.split(", "))
    return cep.impossible_travel(e, 500, 5400).select("event_id", "user_id", "last_ts", F.round("distance_km", 4).alias("distance_km"))


@_register("stream_impossible_travel", f"{_TRAVEL} and ts < {_CLOSED}")
def _(s, d):
    """The rule over a stream, to a day that the watermark has passed."""
    _rocksdb(s)
    e = _stream(s, d).selectExpr("event_id", "user_id", "ts", *_PLACES.split(", "))
    out = _run(rules.impossible_travel(e, 500, 5400, every=_DAY)).where(f"ts < {_CLOSED}")
    return out.select("event_id", "user_id", "last_ts", F.round("distance_km", 4).alias("distance_km"))


@_register("stream_rapid_fire", f"select event_id, user_id, t as run_start from (select *, lag(ts, 3) over (partition by user_id order by ts, event_id) as t from events) where ts - t <= interval 120 minutes and ts < {_CLOSED}")
def _(s, d):
    _rocksdb(s)
    out = _run(rules.rapid_fire(_stream(s, d).select("event_id", "user_id", "ts"), seconds=7200, every=_DAY)).where(f"ts < {_CLOSED}")
    return out.select("event_id", "user_id", "run_start")


@_register("stream_promo_abuse", f"select event_id, user_id, promo_code from (select *, lag(ts, 3) over (partition by user_id, promo_code order by ts, event_id) as t from (select *, json_extract_string(props, '$.k')::int % 3 as promo_code from events)) where ts - t <= interval 600 minutes and ts < {_CLOSED}")
def _(s, d):
    _rocksdb(s)
    e = _stream(s, d).select("event_id", "user_id", "ts", (F.get_json_object("props", "$.k").cast("int") % 3).alias("promo_code"))
    return _run(rules.promo_abuse(e, seconds=36000, every=_DAY)).where(f"ts < {_CLOSED}").select("event_id", "user_id", "promo_code")


# --- transitions -----------------------------------------------------------------------------------------------------------

_DELIVERY = "case event_id % 4 when 0 then 'ASSIGNED' when 1 then 'PICKED_UP' when 2 then 'DELIVERED' else 'CANCELLED' end"


@_register("q_delivery_transitions", f"""select event_id, user_id, previous, status from (
  select *, lag(status) over (partition by user_id order by ts, event_id) as previous from (select *, {_DELIVERY} as status from events))
where previous is not null and previous <> status
  and not ((previous = 'ASSIGNED' and status in ('PICKED_UP', 'CANCELLED')) or (previous = 'PICKED_UP' and status in ('DELIVERED', 'CANCELLED')))""")
def _(s, d):
    """Delivery events whose status may not follow the one before."""
    e = T(s, d, "events").withColumn("status", F.expr(_DELIVERY))
    return quality.illegal_transitions(e, "user_id", "status", "ts", "event_id", quality.DELIVERY_TRANSITIONS).select("event_id", "user_id", "previous", "status")


# --- roll-ups in epochs and segments ---------------------------------------------------------------------------------------


def _events_rollup(rows):
    made = rollup.rollup(rows, "ts", ["dt", "event_type"], sums={"total": "value"}, lows={"least": "value"}, highs={"most": "value"}, thetas={"users": "user_id"}, hlls={"users_hll": "user_id"}, quantiles={"value_kll": "value"}, bucket="hour")
    return made.withColumn("total", F.col("total").cast("double"))


_MERGE = segments.merge_rollups(["dt", "event_type"], sums=["total"], lows=["least"], highs=["most"], thetas=["users"], hlls=["users_hll"], quantiles=["value_kll"])


@_register("q_rollup_segments", "select date_trunc('hour', ts) as time, strftime(ts, '%Y-%m-%d') as dt, event_type, count(*) as n, round(sum(value), 4) as total, min(value) as least, max(value) as most, count(distinct user_id) as users from events group by 1, 2, 3")
def _(s, d):
    """Partial roll-ups in epochs, one of them run again and one of late events, with compactions in between."""
    events = T(s, d, "events").withColumn("dt", F.date_format("ts", "yyyy-MM-dd"))
    table = segments.SegmentTable(s, _folder(s, "segments"), _MERGE, "dt", ("event_type",), 500)
    for epoch, part in enumerate((3, 0, 1, 2)):
        table.replace(_events_rollup(events.where(f"event_id % 4 = {part}")), epoch)
        if epoch in (1, 2):
            table.replace(_events_rollup(events.where(f"event_id % 4 = {part}")), epoch)
            table.compact()
    out = table.read().withColumn("users", F.theta_sketch_estimate("users"))
    return out.select("time", "dt", "event_type", F.col("count").alias("n"), F.round("total", 4).alias("total"), "least", "most", "users")


@_register("stream_rolled_files", "select strftime(ts, '%Y-%m-%d') as dt, count(*) as n, true as as_planned from events group by 1")
def _(s, d):
    """A stream into epochs of plain rows, rolled into files of a hundred rows at most: rows by day, and whether its files fit."""
    path = _folder(s, "rolled")
    table = segments.SegmentTable(s, path, None, "dt", ("event_id",), 100)
    rows = _stream(s, d).select("event_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd").alias("dt"))
    streams.drain(rows, sinks.fan_out({"rolled": table}), f"{path}-checkpoint")
    table.compact()
    health = sinks.file_health(s, f"{path}/base-{table.base()}", "dt")
    least = F.ceil(F.col("record_count") / 100)
    return health.select(F.col("dt").cast("string").alias("dt"), F.col("record_count").alias("n"), F.col("file_count").between(least, 2 * least).alias("as_planned"))

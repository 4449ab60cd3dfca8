"""Sinks, sources, streams in append mode, quality and plans: behaviour that queries over the tables do not show."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from tiffin.functions import expr as X
from tiffin.operators import cdc, cep
from tiffin.operators import curated as C
from tiffin.operators import gold as G
from tiffin.operators import quality as Q
from tiffin.operators.joins import not_in
from tiffin.plans import binding as B
from tiffin.plans import queries as QS
from tiffin.plans import reports as R
from tiffin.sources import readers, sinks
from tiffin.streaming import stateful, streams

DATA = "/root/testdata/sf0.001"
AT = datetime.datetime(2024, 1, 1, 10)


def minutes(n):
    return AT + datetime.timedelta(minutes=n)


# --- sources ---------------------------------------------------------------------------------------------------------


def test_text_ranges_cover_every_value():
    import sqlite3

    con = sqlite3.connect(":memory:")
    con.execute("create table t (k text)")
    keys = ["", " ", "a", "ord_1", "ORD", "zz", "~~~", "~", "!x", "'q", "0", None, "\x01", "é"]
    con.executemany("insert into t values (?)", [(k,) for k in keys])
    for parts in (1, 2, 3, 8, 32):
        found = [con.execute(f"select count(*) from t where {w}").fetchone()[0] for w in readers.text_ranges("k", parts)]
        assert len(found) == parts and sum(found) == len(keys)


def test_change_and_menu_streams_parse(spark):
    envelope = {"before": None, "after": {"promo_id": "p", "discount_value": 12.5, "is_active": True, "updated_at": "2024-01-01T10:00:00Z"}, "op": "c", "ts_ms": 5}
    menu = {"event_type": "menu_item_availability_changed", "item_id": "i", "price": 110, "previous_price": 100, "is_available": False, "last_updated": 0, "updated_at": 1000}
    rows = spark.createDataFrame([(json.dumps(envelope), json.dumps(menu))], "promo string, menu string")
    out = cdc.unwrap(readers.change_stream(rows, "promo", "promo")).first()
    assert (out["promo_id"], float(out["discount_value"]), out["op_type"]) == ("p", 12.5, "INSERT")
    m = readers.menu_events(rows, "menu").first()
    assert (m["price_changed"], m["price_change_pct"], m["became_unavailable"], m["event_time"]) == (True, 10.0, True, datetime.datetime(1970, 1, 1, 0, 0, 1))
    assert set(readers.CHANGE_SCHEMAS) == {"orders", "users", "menu", "promo"}


def test_bad_rows_go_to_dead_letters(spark, tmp_path):
    src, dead = str(tmp_path / "in"), str(tmp_path / "dead")
    spark.createDataFrame([('{"a": 1}',), ("{bad",), ('{"a": 2}',)], "value string").write.text(src)
    good, bad = readers.read_json(spark, src, "a int")
    assert sorted(r[0] for r in readers.good_rows(good, bad, dead, 1).collect()) == [1, 2]
    assert [r["value"] for r in spark.read.parquet(dead).collect()] == ["{bad"]
    with pytest.raises(ValueError, match="1 rows"):
        readers.good_rows(good, bad, dead, 0)


# --- sinks -----------------------------------------------------------------------------------------------------------


def test_append_or_create_merges_schemas(spark):
    spark.sql("drop table if exists merged")
    one = spark.createDataFrame([(1, "x", "d1")], "id int, a string, dt string")
    two = spark.createDataFrame([(2, 5.0, "d2")], "id int, b double, dt string")
    sinks.append_or_create(one, "merged", ["dt"])
    sinks.append_or_create(two, "merged", ["dt"])
    sinks.append_or_create(one.withColumn("id", F.lit(3)), "merged", ["dt"])
    got = sorted(tuple(r) for r in spark.table("merged").select("id", "a", "b", "dt").collect())
    assert got == [(1, "x", None, "d1"), (2, None, 5.0, "d2"), (3, "x", None, "d1")]
    spark.sql("drop table merged")


def test_partitions_are_registered(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("drop table if exists found")
    spark.createDataFrame([(1, "d1")], "id int, dt string").write.partitionBy("dt").parquet(path)
    spark.sql(f"create table found (id int, dt string) using parquet partitioned by (dt) location '{path}'")
    assert spark.table("found").count() == 0
    sinks.register_partitions(spark, "found")
    assert spark.table("found").count() == 1
    spark.sql("drop table found")


def test_materialise_deals_a_large_day_over_files(spark, tmp_path):
    path = str(tmp_path / "m")
    df = spark.range(1000).select("id", F.lit("2024-01-01").alias("dt")).union(spark.createDataFrame([(1, "2024-01-02"), (2, None)], "id long, dt string"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # it would join such small files again
    for _ in range(2):
        sinks.materialise(df, path, ["dt"], ["id"], rows_per_file=100)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    out = spark.read.parquet(path)
    assert out.count() == 1002 and out.where("dt is null").count() == 1
    health = {str(r["dt"]): r["file_count"] for r in sinks.file_health(spark, path, "dt").collect()}
    assert health["2024-01-01"] > 2 and health["2024-01-02"] == 1


def test_upsert_recovers_what_was_set_aside(spark, tmp_path):
    path = str(tmp_path / "u")
    changes = lambda rows: spark.createDataFrame(rows, "id long, v string, at long, op_type string")
    sinks.upsert(spark, changes([(i, "a", 1, "UPDATE") for i in range(40)]), path, ["id"], ["at"], buckets=4)
    lost = sorted((tmp_path / "u").glob("_bucket=*"))[0]
    lost.rename(lost.parent / lost.name.replace("_bucket", "_old_bucket"))  # a driver that was lost in a swap
    sinks.upsert(spark, changes([(1, "b", 2, "UPDATE"), (2, "", 2, "DELETE")]), path, ["id"], ["at"], buckets=4)
    got = {r["id"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert got == {i: "b" if i == 1 else "a" for i in range(40) if i != 2}
    assert not list((tmp_path / "u").glob("_old*"))


def test_archive_keeps_the_place_in_the_log(spark):
    rows = spark.createDataFrame([('{"id": "a", "updated_at": "2024-01-02T03:04:05Z"}', "orders", 3, 17)], "value string, topic string, partition int, offset long")
    out = sinks.archive_stream(rows, "id string, updated_at timestamp").first().asDict()
    assert (out["id"], out["_partition"], out["_offset"], out["year"], out["month"], out["day"], out["hour"]) == ("a", 3, 17, "2024", "01", "02", "03")


def test_partition_completeness(spark, tmp_path):
    for name, size in (("dt=a/x.json", 10), ("dt=a/y.tmp", 99), ("dt=b/z.json", 3)):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * size)
    files = readers.list_files(spark, str(tmp_path))
    got = {r["partition"]: (r["file_count"], r["total_bytes"], r["passed"]) for r in Q.partition_completeness(files, F.regexp_extract("path", "dt=([^/]+)/", 1), 1, 5, (".json",)).collect()}
    assert got == {"a": (1, 10, True), "b": (1, 3, False)}


# --- expressions and quality -------------------------------------------------------------------------------------------


def test_typed_attributes_of_any_depth(spark):
    cases = {'{"N":"42"}': "42", '{"N":"749.50"}': "749.5", '{"NULL":true}': None, '{"L":[{"S":"a"},{"N":"1"},{"BOOL":true}]}': '["a",1,true]', '{"M":{"x":{"L":[{"M":{"y":{"SS":["b"]}}}]}}}': '{"x":[{"y":["b"]}]}', '{"NS":["1","2.5"]}': "[1,2.5]", '{"B":"Ynl"}': '"Ynl"', "{bad": None, '{"BOOL":false}': "false"}
    rows = spark.createDataFrame([(k,) for k in cases] + [(None,)], "a string")
    got = {r["a"]: r["v"] for r in rows.select("a", X.attribute_json(F.col("a")).alias("v")).collect()}
    assert got == {**cases, None: None}


def test_default_transitions(spark):
    rows = [("o", s, i) for i, s in enumerate(["PLACED", "CONFIRMED", "PREPARING", "CANCELLED", "READY", "PICKED_UP", "DELIVERING", "DELIVERED", "PLACED"])]
    out = Q.illegal_transitions(spark.createDataFrame(rows, "id string, status string, at int"), "id", "status", "at", "at").collect()
    assert {(r["previous"], r["status"]) for r in out} == {("PREPARING", "CANCELLED"), ("CANCELLED", "READY"), ("DELIVERED", "PLACED")}


def test_not_in_is_null_aware(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    other = lambda *v: spark.createDataFrame([(x,) for x in v], "x int")
    rows = lambda df: sorted(r[0] or 0 for r in df.collect())
    assert rows(not_in(a, "k", other(1), "x")) == [2]
    assert rows(not_in(a, "k", other(1, None), "x")) == []
    assert rows(not_in(a, "k", other(), "x")) == [0, 1, 2]


def test_price_change_without_earlier_prices(spark):
    rows = spark.createDataFrame([(1, None, 5.0), (2, 0.0, 5.0), (3, 8.0, None), (4, 8.0, 8.0), (5, 3.0, 4.0)], "i int, a double, b double")
    got = {r["i"]: (r["price_changed"], r["price_change_pct"]) for r in rows.select("i", *(c.alias(n) for n, c in X.price_change(F.col("a"), F.col("b")).items())).collect()}
    assert got == {1: (False, 0.0), 2: (True, 0.0), 3: (False, 0.0), 4: (False, 0.0), 5: (True, pytest.approx(33.33))}


def test_moving_average_over_many_batches(spark):
    """Batches of three rows: averages go on from batch to batch and start anew with each key."""
    rows = [(k, minutes(i), minutes(i + 1), (i * 7 + len(k)) % 11 + 1) for k in ("a", "bb", "ccc") for i in range(10)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    out = cep.ema_anomalies(spark.createDataFrame(rows, "k string, window_start timestamp, window_end timestamp, n long"), "k", spike=0, least=0).collect()
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {}
    for k in ("a", "bb", "ccc"):
        base = None
        for _, t, _, n in [r for r in rows if r[0] == k]:
            if base is not None:
                want[k, t] = base
            base = n if base is None else 0.3 * n + 0.7 * base
    assert {(r["k"], r["window_start"]): round(r["baseline"], 9) for r in out} == {k: round(v, 9) for k, v in want.items()}


# --- plans -------------------------------------------------------------------------------------------------------------


def scans(df, table):
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    plan = df._jdf.queryExecution().executedPlan().toString()
    df.sparkSession.conf.unset("spark.sql.adaptive.enabled")
    return sum(f"/{table}.parquet" in line for line in plan.splitlines() if "Scan parquet" in line or "FileScan" in line)


def test_reports_read_the_order_lines_once(spark):
    for build in (lambda c: G.user_cohorts(c, ["2001-05-31", "2001-06-30"]), lambda c: R.retention_trend(G.user_cohorts(c, ["2001-05-31", "2001-06-30"])), lambda c: G.daily_order_metrics(c)):
        assert scans(build(QS.curated(spark, DATA)), "lineitem") == 1
    events = streams.flatten_events(B.app_events(spark, DATA), {"k": ("properties", "k")})
    assert scans(events.groupBy("k").count(), "events") == 1


def test_daily_metrics_do_not_expand(spark):
    plan = G.daily_order_metrics(QS.curated(spark, DATA))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_curated_orders_take_latest_versions(spark):
    order = "order_id long, customer_id long, restaurant_id long, total_amount decimal(12,2), discount_amount decimal(12,2), subtotal_amount decimal(12,2), item_count int, order_status string, coupon_code string, order_placed_at timestamp, order_accepted_at timestamp, order_delivered_at timestamp, order_cancelled_at timestamp, cancellation_reason string, actual_delivery_min int, estimated_delivery_min int, at long, items array<struct<item_id:string,is_veg:boolean,category:string>>"
    from decimal import Decimal as D

    row = lambda at, status, items: (1, 7, 3, D("90"), D("0"), D("80"), 2, status, None, AT, AT, AT, None, None, 10, 30, at, items)
    orders = spark.createDataFrame([row(1, "placed", []), row(2, "delivered", [("i", True, "thai"), (None, False, "x")])], order)
    rest = spark.createDataFrame([(3, "old", 1, "z", 1, "c", D("0.1"), 1.0, 1), (3, "new", 1, "z", 1, "c", D("0.2"), 5.0, 2)], "restaurant_id long, restaurant_name string, zone_id int, zone_name string, city_id int, city_name string, commission_rate decimal(5,4), restaurant_rating double, at long")
    users = spark.createDataFrame([(7, False, "a", 1), (7, True, "b", 2)], "user_id long, is_pro_member boolean, segment string, at long")
    pay = spark.createDataFrame([(1, "INITIATED", 1), (1, "COMPLETED", 2)], "order_id long, payment_status string, at long")
    out = C.curate_orders(orders, rest, users, payments=pay, versions=["at"], snapshots=["at"]).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["order_status"], r["restaurant_name"], r["is_pro_member"], r["payment_status"], r["unique_item_count"], r["has_veg_items"], r["has_non_veg_items"], r["cuisine_primary"], r["customer_lifetime_orders"]) == ("delivered", "new", True, "COMPLETED", 1, True, True, "thai", 1)


# --- streams in append mode ----------------------------------------------------------------------------------------------


EVENT = ("event_id string, event_type string, source string, user_id string, session_id string, timestamp timestamp, properties map<string,string>, device map<string,string>, location map<string,string>")


def event(i, at, user="u", city="Pune"):
    return (str(i), "ORDER_PLACED", "app", user, "s", at, {"total_amount": "10"}, {"platform": "web"}, {"city": city})


def feed(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def files(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def run(df, folder, keep):
    q = df.writeStream.foreachBatch(keep).outputMode("append").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()


def test_late_rows_are_dropped_and_restarts_lose_nothing(spark, tmp_path):
    src, out = str(tmp_path / "src"), []
    velocity = lambda: streams.city_velocity(files(spark, src, EVENT))
    keep = lambda batch, _: out.extend((r["city"], r["window_start"], r["order_count"], r["unique_users"]) for r in batch.collect())
    feed(spark, src, "1", [event(1, minutes(0)), event(2, minutes(1), "v"), event(3, minutes(1), "v")], EVENT)
    run(velocity(), tmp_path, keep)
    assert out == []  # the window may still grow
    feed(spark, src, "2", [event(4, minutes(20))], EVENT)
    run(velocity(), tmp_path, keep)  # a restart: the state of the first run goes on
    feed(spark, src, "3", [event(5, minutes(2))], EVENT)  # too late for its window
    run(velocity(), tmp_path, keep)
    feed(spark, src, "4", [event(6, minutes(40))], EVENT)
    run(velocity(), tmp_path, keep)
    assert sorted(out) == [("Pune", minutes(0), 3, 2), ("Pune", minutes(20), 1, 1)]


def test_fraud_state_serves_late_orders(spark, tmp_path):
    src, out = str(tmp_path / "src"), []
    schema = "user_id string, order_id string, ts timestamp, status string, address string"
    alerts = lambda: stateful.multi_address_fraud(files(spark, src, schema))
    keep = lambda batch, _: out.extend((r["order_id"], r["distinct_addresses"]) for r in batch.collect())
    feed(spark, src, "1", [("u", "1", minutes(0), "PLACED", "A"), ("u", "2", minutes(5.4), "PLACED", "C")], schema)
    run(alerts(), tmp_path, keep)
    feed(spark, src, "2", [("u", "3", minutes(4.95), "PLACED", "B")], schema)  # 27 seconds late: looks back to the first
    run(alerts(), tmp_path, keep)
    assert ("3", "a,b") in out


def test_fan_out_gives_one_batch_to_all(spark, tmp_path):
    src = str(tmp_path / "src")
    feed(spark, src, "1", [event(1, minutes(0)), event(2, minutes(1))], EVENT)
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    write = sinks.fan_out({"a": lambda df: df.write.mode("append").parquet(a), "b": lambda df: df.groupBy("city").count().write.mode("append").parquet(b)})
    run(streams.flatten_events(files(spark, src, EVENT)), tmp_path, write)
    assert spark.read.parquet(a).count() == 2 and [tuple(r) for r in spark.read.parquet(b).collect()] == [("Pune", 2)]


def test_file_sink_appends_partitions(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    feed(spark, src, "1", [event(1, minutes(0))], EVENT)
    q = streams.file_sink(streams.flatten_events(files(spark, src, EVENT)), out, str(tmp_path / "check"), ["dt", "hour"], trigger="1 second")
    q.processAllAvailable()
    q.stop()
    assert [(str(r["dt"]), r["hour"]) for r in spark.read.orc(out).collect()] == [("2024-01-01", 10)]


def test_velocity_counts_exact_users_on_request(spark):
    rows = spark.createDataFrame([event(i, minutes(0), f"u{i % 3}") for i in range(9)], EVENT)
    assert [r["unique_users"] for r in streams.city_velocity(rows, exact=True).collect()] == [3] == [r["unique_users"] for r in streams.city_velocity(rows).collect()]


# --- means that are rounded --------------------------------------------------------------------------------------------


def test_rounded_means_do_not_depend_on_the_order_of_rows(spark):
    """Means whose exact value is a half: the sum of doubles in one of the orders falls below it."""
    from tiffin.plans import reports

    times = [131 / 3, 136 / 3, 44.75, 143 / 3, 112 / 3, 149 / 3]  # their mean is 44.75, in doubles not in every order
    assert len({sum(p) / 6 for p in itertools.permutations(times)}) > 1
    schema = "metric_date string, city_name string, total_deliveries long, completed_deliveries long, avg_total_delivery_time double, sla_breach_count long, total_delivery_cost double, avg_delivery_rating double"
    rows = [(str(k), "c", 1, 1, t, 0, 1.0, 4.0) for k, p in enumerate(itertools.permutations(times)) for t in p]
    got = reports.delivery_daily(spark.createDataFrame(rows, schema).coalesce(1)).collect()
    assert {r["avg_delivery_min"] for r in got} == {44.8}


def test_hourly_differences_round_as_doubles(spark):
    """43.25 - 44.3 is a half in decimals; in doubles, as in the query's SQL, it lies above -1.05."""
    from tiffin.plans import reports

    schema = "metric_date string, metric_hour int, city_id int, city_name string, zone_name string, total_deliveries long, completed_deliveries long, avg_total_delivery_time double, sla_breach_rate double"
    rows = [("2001-06-28", 1, 1, "c", "z", 8, 5, 43.25, 0.4), *(("2001-06-27", 1, 1, "c", z, 25, 5, t, 0.5) for z, t in (("z", 44.2), ("y", 44.4)))]
    df = spark.createDataFrame(rows, schema).withColumn("metric_date", F.col("metric_date").cast("date"))
    got = [r.asDict() for r in reports.delivery_hourly(df, "2001-06-28").collect()]
    assert [(r["avg_delivery_min"], r["delivery_time_dod_delta"], r["sla_breach_dod_delta_pp"], r["deliveries_dod_pct"]) for r in got] == [(43.3, -1.0, -10.0, -84.0)]


def test_full_curation_moves_orders_once_to_their_number_and_once_to_their_customer(spark):
    from tiffin.plans import extended_queries  # noqa: F401  it registers its queries
    from tiffin.plans import queries as Q

    name = "spark.sql.autoBroadcastJoinThreshold"
    kept = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        plan = Q.QUERIES["q_curated_full"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(name, kept)
    moves = [line for line in plan.split("\n") if "Exchange hashpartitioning(" in line]
    by = lambda key: sum(f"hashpartitioning({key}#" in m for m in moves)
    assert by("order_id") == 2  # the records of payments and of deliveries, each once
    assert by("restaurant_id") == 1 and by("user_id") == 1  # snapshots; orders do not move to their restaurants
    assert by("customer_id") == 2  # orders, and their first times


def test_latest_record_of_a_table_of_keys_alone(spark):
    rows = spark.createDataFrame([(1, 2), (1, 2), (2, 3)], "a long, b long")
    last = C.latest_by_key(rows, ["a", "b"], ["b"])
    assert last.columns == ["a", "b"] and sorted(map(tuple, last.collect())) == [(1, 2), (2, 3)]


def test_cohorts_sort_twice(spark):
    """Behind the shuffle to customers: by restaurant and date, and by cuisine."""
    plan = QS.QUERIES["q_gold_cohorts"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    behind = plan[: plan.index("hashpartitioning(snapshot_date#")]
    assert behind.count("Window [") == 4 and behind.count("Sort [") == 2

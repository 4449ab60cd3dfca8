"""Operators on small literal tables: boundaries of the rules, nulls, ties, empty input, order independence."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.functions import expr as X
from tiffin.operators import cdc, cep, curated, gold, quality, rollup
from tiffin.sources import readers, sinks
from tiffin.streaming import stateful, streams

T0 = dt.datetime(2024, 1, 1, 12)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def test_rapid_fire_includes_two_minutes(spark):
    rows = [("u", at(s), i) for i, s in enumerate([0, 40, 80, 120])] + [("v", at(s), i) for i, s in enumerate([0, 60, 130, 200])] + [("w", at(0), 1)]
    out = cep.rapid_fire(spark.createDataFrame(rows, "user_id string, ts timestamp, event_id int")).collect()
    assert [r["user_id"] for r in out] == ["u"]


def test_promo_abuse_and_high_value(spark):
    rows = [("u", at(s), i, "P") for i, s in enumerate([0, 100, 300, 600])] + [("u", at(10), 9, None)] + [("v", at(s), i, p) for i, (s, p) in enumerate([(0, "A"), (1, "B"), (2, "A"), (3, "A")])]
    df = spark.createDataFrame(rows, "user_id string, ts timestamp, event_id int, promo_code string")
    assert [r["user_id"] for r in cep.promo_abuse(df).collect()] == ["u"]
    amounts = spark.createDataFrame([(50000.0,), (50000.01,), (None,)], "total_amount double")
    assert [r[0] for r in cep.high_value(amounts).collect()] == [50000.01]


ORDERS = [("u", "1", at(0), "PLACED", "12  Main St "), ("u", "2", at(300), "placed", "12 main st"), ("u", "3", at(300), "PLACED", "9 Oak"), ("u", "4", at(601), "PLACED", "12 main st"), ("u", "5", at(602), "CANCELLED", "x"), ("u", "6", at(603), "PLACED", " "), ("v", "7", at(0), "PLACED", "a"), ("v", "8", at(301), "PLACED", "b"), ("w", "9", at(0), "PLACED", None)]
ORDER_SCHEMA = "user_id string, order_id string, ts timestamp, status string, address string"


def test_fraud_batch(spark):
    out = {r["order_id"]: r for r in cep.multi_address_fraud(spark.createDataFrame(ORDERS, ORDER_SCHEMA)).collect()}
    assert set(out) == {"2", "3"}
    assert out["3"]["distinct_addresses"] == "12 main st,9 oak" and out["3"]["order_count"] == 3 and out["3"]["severity"] == "MEDIUM"


def test_fraud_stream_equals_batch(spark, tmp_path):
    df = spark.createDataFrame(ORDERS, ORDER_SCHEMA)
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    out = streams.run_once(stateful.multi_address_fraud(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))), str(tmp_path / "run"))
    columns = ["user_id", "order_id", "order_ids", "distinct_addresses", "severity", "window_start"]
    assert sorted(map(tuple, out.select(columns).collect())) == sorted(map(tuple, cep.multi_address_fraud(df).select(columns).collect()))


def test_ema(spark):
    counts = [2, 6, 5, 30, 4]
    rows = [("r", at(60 * i), at(60 * i + 600), n) for i, n in enumerate(counts)] + [("one", at(0), at(600), 99)]
    out = cep.ema_anomalies(spark.createDataFrame(rows, "k string, window_start timestamp, window_end timestamp, n long"), "k").collect()
    base = [2.0]
    for n in counts[1:]:
        base.append(0.3 * n + 0.7 * base[-1])
    assert [(r["k"], r["n"], round(r["baseline"], 9)) for r in sorted(out, key=lambda r: r["window_start"])] == [("r", 6, round(base[0], 9)), ("r", 30, round(base[2], 9))]


def test_haversine_and_travel(spark):
    d = spark.range(1).select(X.haversine_km(F.lit(19.076), F.lit(72.8777), F.lit(28.7041), F.lit(77.1025))).first()[0]
    assert 1000 < d < 1300
    rows = [("u", at(0), 19.076, 72.8777, 1), ("u", at(200), 28.7041, 77.1025, 2), ("u", at(900), 19.076, 72.8777, 3)]
    assert [r["event_id"] for r in cep.impossible_travel(spark.createDataFrame(rows, "user_id string, ts timestamp, latitude double, longitude double, event_id int")).collect()] == [2]


def test_expressions(spark):
    df = spark.createDataFrame([(None, 10.0, 100.0), ("C", 0.0, 100.0), ("C", 100.0, 100.0), ("C", 150.0, 1000.0), ("C", 600.0, 1000.0), ("C", 150.0, 0.0)], "code string, d double, s double")
    assert [r[0] for r in df.select(X.coupon_type(F.col("code"), F.col("d"), F.col("s"))).collect()] == [None, None, "flat", "percentage", "flat", "flat"]
    assert [r[0] for r in spark.createDataFrame([(" placed ",), ("x",), (None,)], "s string").select(X.parse_enum(F.col("s"), ["PLACED"])).collect()] == ["PLACED", None, None]
    items = spark.createDataFrame([([("a", True, "thai"), (None, False, "x")],), ([],), (None,)], "i array<struct<item_id:string,is_veg:boolean,category:string>>")
    got = [tuple(r) for r in items.select(*(c.alias(n) for n, c in X.item_features(F.col("i")).items())).collect()]
    assert got[0] == (1, True, True, "thai") and got[1] == (0, False, False, "unknown") and got[2][1] is None
    topics = spark.createDataFrame([("A",), ("B",), (None,)], "t string").select(X.route_topic(F.col("t"), {"A": "orders"}, "users"))
    assert [r[0] for r in topics.collect()] == ["orders", "users", "users"]


def test_latest_by_key_is_independent_of_partitioning(spark):
    rows = [("o1", "PLACED", 1), ("o1", "DELIVERED", 3), ("o1", "CONFIRMED", 2), ("o2", "A", 5), ("o2", "B", 5), (None, "N", 1)]
    df = spark.createDataFrame(rows, "order_id string, status string, t int")
    results = {tuple(sorted(map(repr, curated.latest_by_key(d, ["order_id"], ["t"]).collect()))) for d in (df, df.repartition(5), df.orderBy(F.desc("status")).coalesce(1))}
    assert len(results) == 1 and "DELIVERED" in str(results) and curated.latest_by_key(df.limit(0), ["order_id"], ["t"]).collect() == []
    assert curated.nth_latest(df.where("order_id = 'o1'"), ["order_id"], ["t"]).first()["status"] == "DELIVERED"


def test_cdc(spark):
    row = "struct<id:int,v:string,email:string>"
    env = spark.createDataFrame([(None, (1, "a", "m"), "c", 1000), ((1, "a", "m"), (1, "b", "m"), "u", 2000), ((2, "x", "m"), None, "d", 3000), (None, (3, None, "m"), "r", 1)], f"before {row}, after {row}, op string, ts_ms long")
    flat = cdc.unwrap(env, ("email",))
    assert flat.columns == ["id", "v", "op_type", "changed_at", "__deleted"]
    base = spark.createDataFrame([(1, "old"), (2, "old"), (4, "old")], "id int, v string")
    got = cdc.apply_changes(base, flat, ["id"], ["changed_at"])
    assert sorted(map(tuple, got.collect()), key=repr) == [(1, "b"), (3, None), (4, "old")]


def test_change_records(spark):
    attr = "struct<S:string,N:string,BOOL:boolean,NULL:boolean>"
    schema = f"eventID string, eventName string, eventSourceARN string, dynamodb struct<ApproximateCreationDateTime:long,SequenceNumber:string,NewImage:map<string,{attr}>,OldImage:map<string,{attr}>>"
    image = lambda n: {"id": (None, "1", None, None), "n": (None, n, None, None), "b": (None, None, True, None), "z": (None, None, None, True)}
    rows = [("e1", "MODIFY", "arn:t/sessions/s", (1700000000, "99", image("42"), None)), ("e2", "REMOVE", "arn:t/sessions/s", (1700000000, "100", None, image("749.50"))), ("e3", "INSERT", "bad", (1, "1", None, None))]
    flat = cdc.flatten_change_records(spark.createDataFrame(rows, schema))
    assert {r["event_id"]: r["table_name"] for r in flat.collect()} == {"e1": "sessions", "e2": "sessions", "e3": "unknown"}
    latest = cdc.latest_records(flat.where("table_name = 'sessions'"), "id")
    assert [tuple(r) for r in cdc.project_records(latest, "sessions", {"n": "double", "b": "boolean", "z": "string"}).select("n", "b", "z").collect()] == [(749.5, True, None)]


def test_quality(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "id int, v string")
    assert {r["column"]: (r["nulls"], r["passed"]) for r in quality.null_ratios(df, ["id", "v"]).collect()} == {"id": (0, True), "v": (1, False)}
    assert all(r["passed"] for r in quality.null_ratios(df.limit(0), ["id"]).collect())
    assert quality.duplicate_keys(df, ["id"]).first()["duplicates"] == 1
    assert quality.rule_failures(df, {"v": F.col("v") > "a"}).first()["failures"] == 2
    with pytest.raises(quality.QualityError):
        quality.gate(quality.null_ratios(df, ["v"]), fail=True)
    assert quality.gate(quality.null_ratios(df, ["v"]), fail=False) is False and quality.gate(quality.null_ratios(df, ["id"]))
    want = T.StructType.fromDDL("id long, w string")
    assert {(r["column"], r["finding"]) for r in quality.schema_drift(df, want).collect()} == {("id", "type"), ("w", "missing"), ("v", "extra")}
    steps = spark.createDataFrame([("o", s, i) for i, s in enumerate(["PLACED", "CONFIRMED", "PREPARING", "DELIVERED"])], "k string, s string, t int")
    assert [r["s"] for r in quality.illegal_transitions(steps, "k", "s", "t", "t").collect()] == ["DELIVERED"]
    assert quality.row_ratio(df, df.limit(2), 0.99).first()["passed"] is False


def test_rollup_rerolls_exactly(spark):
    rows = [(at(i * 7), f"c{i % 3}", f"u{i % 11}", float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "ts timestamp, city string, u string, v double")
    minute = rollup.rollup(df, "ts", ["city"], sums={"v": "v"}, lows={"lo": "v"}, highs={"hi": "v"}, firsts={"first": "v"}, thetas={"users": "u"})
    hour = rollup.reroll(minute, "hour", ["city"], sums=["v"], lows=["lo"], highs=["hi"], thetas=["users"])
    got = {r["city"]: tuple(r)[1:] for r in hour.groupBy("city").agg(F.sum("count"), F.sum("v"), F.min("lo"), F.max("hi"), rollup.distinct("users")).collect()}
    for c in ("c0", "c1", "c2"):
        own = [r for r in rows if r[1] == c]
        assert got[c] == (len(own), sum(r[3] for r in own), min(r[3] for r in own), max(r[3] for r in own), len({r[2] for r in own}))


def test_period_rollup_gap_has_no_growth(spark):
    names = ["total_orders", "completed_orders", "cancelled_orders", "gross_merchandise_value", "net_revenue", "total_discount_given", "total_delivery_fee", "platform_commission", "unique_customers", "new_customers", "returning_customers", "pro_member_orders", "sla_breach_count", "active_restaurants", "active_riders"]
    rows = [(d, 1, "c", *[float(n)] * len(names), 1.0, 1.0) for d, n in ((dt.date(2024, 1, 1), 2), (dt.date(2024, 1, 9), 4), (dt.date(2024, 1, 24), 8))]
    schema = "metric_date date, city_id int, city_name string, " + ", ".join(f"{n} double" for n in names) + ", avg_delivery_time_min double, p90_delivery_time_min double"
    got = {r["period_start"]: r["order_growth_pct"] for r in gold.period_rollup(spark.createDataFrame(rows, schema), "week").collect()}
    assert got == {dt.date(2024, 1, 1): None, dt.date(2024, 1, 8): 100.0, dt.date(2024, 1, 22): None}


def test_sinks_and_maintenance(spark, tmp_path):
    path = str(tmp_path / "t")
    change = lambda rows: spark.createDataFrame(rows, "id int, v string, op_type string, t int")
    sinks.upsert(spark, change([(1, "a", "INSERT", 1), (2, "b", "INSERT", 1)]), path, ["id"], ["t"])
    sinks.upsert(spark, change([(1, "c", "UPDATE", 2), (2, "b", "DELETE", 2), (3, "d", "INSERT", 1)]), path, ["id"], ["t"])
    assert sorted((r["id"], r["v"]) for r in spark.read.parquet(path).collect()) == [(1, "c"), (3, "d")]
    lake = str(tmp_path / "lake")
    df = spark.range(100).selectExpr("id", "concat('2024-01-0', cast(id % 3 + 1 as string)) as dt")
    for _ in range(2):
        sinks.materialise(df, lake, ["dt"], ["id"])
    assert spark.read.parquet(lake).count() == 100
    df.repartition(10).write.mode("append").partitionBy("dt").parquet(lake + "2")
    health = {str(r["dt"]): (r["file_count"], r["record_count"]) for r in sinks.file_health(spark, lake + "2", "dt").collect()}
    assert sum(n for _, n in health.values()) == 100 and max(f for f, _ in health.values()) > 1
    sinks.compact(spark, lake + "2", lake + "3", "dt")
    after = {str(r["dt"]): (r["file_count"], r["record_count"]) for r in sinks.file_health(spark, lake + "3", "dt").collect()}
    assert {k: (1, n) for k, (_, n) in health.items()} == after
    assert sinks.expire(spark, lake + "3", "2024-01-02") == ["dt=2024-01-01"]
    orc = str(tmp_path / "orc")
    sinks.write_orc(df, orc, ["dt"], ["id"])
    assert spark.read.orc(orc).where("dt = '2024-01-01'").count() == 34
    assert sinks.to_topic(df.limit(1), "x", "id").columns == ["key", "value", "topic"]


def test_readers(spark, tmp_path):
    p = tmp_path / "j.json"
    p.write_text('{"a": 1, "b": "x"}\n{"a": "no"\n{"b": "y"}\n')
    good, bad = readers.read_json(spark, str(p), "a int, b string")
    assert good.count() == 2 and [r[0] for r in bad.collect()] == ['{"a": "no"']
    values = spark.createDataFrame([('{"orderId": "1"}',), ('{"order_id": "2", "orderId": "9"}',), ("junk",)], "value string")
    assert [r[0] for r in readers.parse_events(values, "order_id string", aliases={"order_id": "orderId"}).collect()] == ["1", "2", None]
    cfg = readers.TableConfig("orders", "id", decimal_columns=["amount"])
    df = spark.createDataFrame([(1, "1.005", "2024-01-01"), (2, "2", "2024-02-01")], "id int, amount string, updated_at string")
    out = readers.etl_transform(df, cfg, "2024-03-01")
    assert dict(out.dtypes)["amount"] == "decimal(18,2)" and out.first()["dt"] == "2024-03-01"
    state = str(tmp_path / "state")
    assert readers.last_value(spark, state, "orders") is None
    readers.save_last_value(out, state, cfg)
    readers.save_last_value(out.limit(0), state, cfg)
    assert readers.last_value(spark, state, "orders").startswith("2024-02-01") and readers.last_value(spark, state, "users") is None


def test_jdbc(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = spark.range(100).selectExpr("id as ID", "concat('2024-01-', lpad(cast(id % 28 + 1 as string), 2, '0')) as UPDATED_AT")
    rows.write.option("createTableColumnTypes", "UPDATED_AT VARCHAR(10)").jdbc(url, "orders", properties=props)
    cfg = readers.TableConfig("orders", "ID", num_partitions=4, incremental_column="UPDATED_AT")
    assert readers.jdbc_bounds(spark, url, props, cfg) == (0, 99)
    df = readers.read_table_jdbc(spark, url, props, cfg)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 100
    assert readers.read_table_jdbc(spark, url, props, cfg, "2024-01-28").count() == 3
    assert readers.read_table_jdbc(spark, url, props, cfg, "2025").count() == 0

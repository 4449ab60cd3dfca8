"""Versioned tables, epochs of sinks, balanced text reads, selection, sliced and chunked rules, keyed rules on streams."""

import datetime
import itertools
import random
import sqlite3

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.operators import cep, quality, rollup
from tiffin.operators.selection import exact_percentiles
from tiffin.sources import readers, segments, sinks
from tiffin.streaming import rules, streams

AT = datetime.datetime(2024, 1, 1, 10)
CHANGE = "id long, v string, at long, op_type string"


def change(spark, rows):
    return spark.createDataFrame(rows, CHANGE)


def stored(spark, path):
    return {r["id"]: r["v"] for r in sinks.read_upserted(spark, path).collect()}


# --- versioned tables ------------------------------------------------------------------------------------------------


def test_an_older_change_loses_and_a_deleted_key_stays_deleted(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(spark, change(spark, [(1, "new", 10, "UPDATE"), (2, "b", 10, "DELETE"), (3, "c", 1, "INSERT")]), path, ["id"], ["at"], buckets=2)
    sinks.upsert(spark, change(spark, [(1, "OLD", 5, "UPDATE"), (2, "OLD", 5, "UPDATE")]), path, ["id"], ["at"], buckets=2)
    assert stored(spark, path) == {1: "new", 3: "c"}
    sinks.upsert(spark, change(spark, [(2, "again", 11, "INSERT"), (3, None, 2, "DELETE")]), path, ["id"], ["at"], buckets=2)
    assert stored(spark, path) == {1: "new", 2: "again"}
    assert spark.read.parquet(path).count() == 2  # graves are not rows


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_batches_gives_one_table(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(6), rng.choice("abc"), rng.choice([None, 1, 2, 3, 4]), rng.choice(["UPDATE", "DELETE", "INSERT", None])) for _ in range(40)]
    batches = [rows[i::3] for i in range(3)]
    tables = []
    for n, order in enumerate([(0, 1, 2), (2, 1, 0, 1), (1, 1, 2, 0, 2)]):
        path = str(tmp_path / f"t{n}")
        for i in order:
            sinks.upsert(spark, change(spark, batches[i]), path, ["id"], ["at"], buckets=3)
        tables.append(stored(spark, path))
    best = {}
    for i, _, at, op in rows:
        mark = (at is not None, at or 0, op == "DELETE")
        best[i] = max(best.get(i, mark), mark)
    assert tables[0] == tables[1] == tables[2] and set(tables[0]) == {i for i, mark in best.items() if not mark[2]}


def test_horizon_forgets_graves_but_not_what_they_guard(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(spark, change(spark, [(1, "a", 1, "DELETE"), (2, "b", 1, "INSERT"), (3, "c", 9, "DELETE")]), path, ["id"], ["at"], buckets=1)
    sinks.upsert(spark, change(spark, [(4, "d", 9, "INSERT")]), path, ["id"], ["at"], buckets=1, horizon="5")
    assert [r["id"] for r in spark.read.parquet(f"{path}/_deleted/_bucket=0").collect()] == [3]
    # What comes from before the horizon reaches stored keys alone, and an earlier horizon does not open it again.
    sinks.upsert(spark, change(spark, [(1, "back", 0, "UPDATE"), (2, "b2", 2, "UPDATE"), (3, "back", 8, "UPDATE")]), path, ["id"], ["at"], buckets=1, horizon="0")
    assert stored(spark, path) == {2: "b2", 4: "d"}


def test_a_lost_swap_keeps_the_graves(spark, tmp_path):
    path = tmp_path / "t"
    sinks.upsert(spark, change(spark, [(1, "a", 1, "INSERT"), (2, "b", 7, "DELETE")]), str(path), ["id"], ["at"], buckets=1)
    for folder in (path, path / "_deleted"):
        (folder / "_bucket=0").rename(folder / ".old_bucket=0")
    sinks.upsert(spark, change(spark, [(2, "late", 3, "UPDATE"), (3, "c", 3, "INSERT")]), str(path), ["id"], ["at"], buckets=1)
    assert stored(spark, str(path)) == {1: "a", 3: "c"}


def test_empty_changes_and_repeated_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(spark, change(spark, [(1, "a", 1, "INSERT")] * 3), path, ["id"], ["at"], buckets=2)
    sinks.upsert(spark, change(spark, []), path, ["id"], ["at"], buckets=2)
    assert stored(spark, path) == {1: "a"}


# --- sinks of epochs ---------------------------------------------------------------------------------------------------


def test_a_replayed_epoch_leaves_each_row_once(spark, tmp_path):
    a, log = sinks.EpochFiles(str(tmp_path / "a")), sinks.CommitLog(spark, str(tmp_path / "log"), "q")
    plain = []
    rows = spark.range(5)
    for log_ in (log, sinks.CommitLog(spark, str(tmp_path / "log"), "q")):  # also after a restart
        write = sinks.fan_out({"a": a, "plain": lambda b: plain.append(b.count())}, log_)
        write(rows, 0)
        write(rows, 0)
    assert a.read(spark, log, "a").count() == 5 and plain == [5] and log.taken("a") == [0] == log.taken("plain")
    a.replace(rows, 0)  # a driver lost before its entry: the write comes again
    a.replace(rows, 1)
    assert a.read(spark).count() == 10 and a.read(spark, log, "a").count() == 5


def test_a_loss_between_two_sinks(spark, tmp_path):
    src, fail = str(tmp_path / "src"), [True]
    spark.range(20).write.parquet(src)
    files, log = sinks.EpochFiles(str(tmp_path / "files")), sinks.CommitLog(spark, str(tmp_path / "log"), "q")
    writes = []

    class Counted:
        def replace(self, batch, epoch):
            writes.append(epoch)
            files.replace(batch, epoch)

    second = sinks.EpochFiles(str(tmp_path / "second"))

    class Failing:
        def replace(self, batch, epoch):
            second.replace(batch.limit(3), epoch)  # part of the epoch, then the loss
            if fail.pop() if fail else False:
                raise RuntimeError("lost")
            second.replace(batch, epoch)

    stream = spark.readStream.schema("id long").parquet(src)
    with pytest.raises(Exception, match="lost"):
        streams.drain(stream, sinks.fan_out({"files": Counted(), "second": Failing()}, log), str(tmp_path / "check"))
    assert log.taken("files") == [0] and log.taken("second") == [] and second.read(spark, log, "second").count() == 0
    streams.drain(stream, sinks.fan_out({"files": Counted(), "second": Failing()}, log), str(tmp_path / "check"))
    assert files.read(spark, log, "files").count() == 20 == second.read(spark, log, "second").count()
    assert writes == [0]


def test_log_is_pruned(spark, tmp_path):
    log = sinks.CommitLog(spark, str(tmp_path), "q", keep=10)
    for epoch in range(25):
        log.add("s", epoch)
    have = log.taken("s")
    assert len(have) <= 10 and have[-1] == 24
    assert all(log.has("s", e) for e in range(25)) and not log.has("s", 25) and not log.has("other", 0)


def test_dead_letters_of_a_batch_are_replaced(spark, tmp_path):
    good, bad = spark.range(1), spark.createDataFrame([("{x",), ("{y",)], "value string")
    for batch in ("1", "1", "2"):
        readers.good_rows(good, bad, str(tmp_path), 5, batch)
    assert spark.read.parquet(str(tmp_path)).count() == 4


# --- balanced reads of text keys -----------------------------------------------------------------------------------------


def keys_of(kind):
    rng = random.Random(3)
    if kind == "ord":
        return [f"ord_{i:06d}" for i in range(4000)]
    if kind == "uuid":
        return ["".join(rng.choices("0123456789abcdef", k=32)) for _ in range(4000)]
    words = [rng.choice(["a", "B", "z", "_", "É", "q'", "\\"]) + rng.choice(["x", "X", "", "y "]) for _ in range(500)]
    return [*words, None, None, "", "Ax", "aX"]


@pytest.mark.parametrize("collation", ["BINARY", "NOCASE"])
@pytest.mark.parametrize("kind", ["ord", "uuid", "mixed"])
def test_text_ranges_are_disjoint_and_even(collation, kind):
    con = sqlite3.connect(":memory:")
    con.execute(f"create table t (k text collate {collation})")
    keys = keys_of(kind)
    con.executemany("insert into t values (?)", [(k,) for k in keys])
    for parts in (1, 3, 8, 32):
        cfg = readers.TableConfig("t", "k", num_partitions=parts)
        known = sum(k is not None for k in keys)
        bounds = [k for k, _ in sorted(con.execute(readers.bounds_query(cfg, known)).fetchall(), key=lambda r: r[1])]
        found = [con.execute(f"select count(*) from t where {w}").fetchone()[0] for w in readers.text_ranges("k", parts, bounds)]
        assert sum(found) == len(keys)
        if kind != "mixed":
            assert len(found) == parts and max(found) <= 2 * len(keys) / parts
        # The even division of ASCII reads every row once too, whatever the collation.
        assert sum(con.execute(f"select count(*) from t where {w}").fetchone()[0] for w in readers.text_ranges("k", parts)) == len(keys)


@pytest.mark.parametrize("options", ["", ";territory=en_US;collation=TERRITORY_BASED:PRIMARY"])
def test_text_keys_are_read_once_from_a_database(spark, options):
    url = f"jdbc:derby:memory:keys{len(options)};create=true{options}"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = [(k, i) for i, k in enumerate(["ord_1", "ORD_1", "Ord_2", "ord_2", "a", "A", "it's", "zz", "\\x", None, *(f"ord_{i}" for i in range(60))])]
    database = spark._jvm.java.sql.DriverManager.getConnection(url).createStatement()
    database.execute("create table t (k varchar(40), n int)")
    for k, n in rows:
        database.execute(f"insert into t values ({'null' if k is None else readers._quoted(k)}, {n})")
    for parts in (1, 4, 16):
        df = readers.read_table_jdbc(spark, url, props, readers.TableConfig("t", "K", num_partitions=parts))
        assert sorted(r[1] for r in df.collect()) == list(range(len(rows)))
    sizes = [len(p) for p in df.rdd.glom().collect()]
    assert len(sizes) > 8 and max(sizes) <= 4 * len(rows) / 16


# --- exact percentiles ---------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("options", [{}, {"leaf": 30, "accuracy": 10}, {"leaf": 1, "accuracy": 50}])
def test_percentiles_are_those_of_all_rows(spark, options):
    rng = random.Random(1)
    rows = [("large", rng.gauss(0, 1e6)) for _ in range(3000)] + [("ties", float(rng.choice([1, 2, 2, 2, 9]))) for _ in range(2000)]
    rows += [("step", 0.0)] * 499 + [("step", 1.0)] * 501 + [(None, 1.0), (None, 4.0), ("nulls", None), ("nan", float("nan")), ("nan", 1.0), ("nan", -0.0), ("one", 7.0)]
    rows += [("skew", 10.0 ** rng.randint(-200, 200)) for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    probs = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    want = df.groupBy("k").agg(*(F.expr(f"percentile_cont({p}) within group (order by v)").alias(n) for n, p in probs.items()))
    key = lambda r: str(r[0])
    got, want = sorted(exact_percentiles(df, ["k"], "v", probs, **options).collect(), key=key), sorted(want.collect(), key=key)
    for g, w in zip(got, want, strict=True):
        assert g["k"] == w["k"] and list(g[1:]) == (pytest.approx(list(w[1:]), rel=1e-12, nan_ok=True) if w["p50"] is not None else [None] * 5)


def test_percentiles_without_keys_or_rows(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))
    assert [r["p"] for r in exact_percentiles(df, [], "v", {"p": 0.25}).collect()] == [25.0]
    assert exact_percentiles(df.where("v < 0"), [], "v", {"p": 0.25}).count() == 0


# --- slices and chunks -----------------------------------------------------------------------------------------------------


def test_sliced_look_back_is_the_window_frame(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["busy", "busy", "u1", None]), str(i), AT + datetime.timedelta(seconds=rng.choice([rng.randrange(40_000), 3600 * rng.randrange(9), 300 * rng.randrange(99)])), rng.choice(["PLACED", "placed", "DONE"]), rng.choice([" A st", "a  ST", "b", "c", " ", None])) for i in range(3000)]
    df = spark.createDataFrame(rows, "user_id string, order_id string, ts timestamp, status string, address string").repartition(6)
    got = sorted(map(tuple, cep.multi_address_fraud(df).select("user_id", "order_id", "order_ids", "distinct_addresses", "address_count", "order_count", "window_start", "window_end").collect()), key=str)
    placed = [(u, o, t, " ".join(a.split()).lower()) for u, o, t, s, a in rows if s.upper() == "PLACED" and a and a.strip()]
    want = []
    for u, o, t, _ in placed:
        near = [r for r in placed if r[0] == u and t - datetime.timedelta(minutes=5) <= r[2] <= t]
        places = sorted({r[3] for r in near})
        if len(places) >= 2:
            want.append((u, o, ",".join(sorted(r[1] for r in near)), ",".join(places), len(places), len(near), min(r[2] for r in near), t))
    assert len(want) > 500 and got == sorted(want, key=str)


def test_a_busy_key_is_cut_into_slices(spark):
    rows = spark.range(20_000).selectExpr("'busy' as user_id", "id as order_id", "timestamp_seconds(1704100000 + id * 20) as ts", "'PLACED' as status", "'a' as address")
    sizes = [len(p) for p in cep.sliced(rows, "ts", "5 minutes", "1 hour").repartition(40, "user_id", "_slice").rdd.glom().collect()]
    assert sum(sizes) < 1.1 * 20_000 and sum(n > 0 for n in sizes) > 30 and max(sizes) < 4 * sum(sizes) / 40
    with pytest.raises(ValueError, match="slice"):
        cep.sliced(rows, "ts", "2 hours", "1 hour")


@pytest.mark.parametrize("chunk", ["10 minutes", "7 hours", "1000 days"])
def test_chunked_average_is_the_plain_recursion(spark, chunk):
    rng = random.Random(5)
    rows = []
    for k in ("a", "b", None):
        at = AT
        for _ in range(rng.choice([1, 200, 400])):
            at += datetime.timedelta(minutes=rng.choice([1, 1, 1, 5, 700]))
            rows.append((k, at, at + datetime.timedelta(minutes=10), rng.choice([0, 1, 3, 8, 40])))
    df = spark.createDataFrame(rows, "k string, window_start timestamp, window_end timestamp, n long").repartition(3)
    got = {(r["k"], r["window_start"]): r["baseline"] for r in cep.ema_anomalies(df, "k", spike=0, least=0, chunk=chunk).collect()}
    want, base = {}, {}
    for k, at, _, n in rows:
        if k in base:
            want[k, at] = base[k]
        base[k] = float(n) if k not in base else 0.3 * n + 0.7 * base[k]
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) <= 1e-9 * max(1, want[i]) for i in want)


def test_average_over_small_arrow_batches(spark):
    rows = [("k", AT + datetime.timedelta(minutes=i), AT, (i * 7) % 11) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, window_start timestamp, window_end timestamp, n long")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    want = sorted((r["window_start"], round(r["baseline"], 9)) for r in cep.ema_anomalies(df, "k", spike=0, least=0).collect())
    spark.conf.set(name, "3")
    try:
        assert sorted((r["window_start"], round(r["baseline"], 9)) for r in cep.ema_anomalies(df, "k", spike=0, least=0, chunk="20 minutes").collect()) == want
    finally:
        spark.conf.set(name, before)


# --- keyed rules on streams ------------------------------------------------------------------------------------------------


def test_streamed_rules_are_the_batch_rules_and_leave_no_state(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", rules.ROCKSDB)
    rng = random.Random(7)
    schema = "event_id long, user_id string, ts timestamp, promo_code string, latitude double, longitude double"
    rows = [(i, rng.choice(["u", "v", "w"]), AT + datetime.timedelta(seconds=20 * i + rng.choice([0, 0, 0.25])), rng.choice(["p", "q", None]), rng.uniform(-80, 80), rng.uniform(-170, 170)) for i in range(120)]
    batches = [rows[i : i + 30] for i in range(0, 120, 30)]
    for k in range(3):  # neighbours across batches change places, by less than the delay
        batches[k][-1], batches[k + 1][0] = batches[k + 1][0], batches[k][-1]
    ends = [[(999 + k, "end", AT + datetime.timedelta(days=2 + k), "p", 0.0, 0.0)] for k in range(2)]
    whole = spark.createDataFrame(rows, schema)
    cases = {
        "rapid": (lambda df: rules.rapid_fire(df, delay="2 minutes"), cep.rapid_fire(whole)),
        "promo": (lambda df: rules.promo_abuse(df, delay="2 minutes"), cep.promo_abuse(whole)),
        "travel": (lambda df: rules.impossible_travel(df, delay="2 minutes"), cep.impossible_travel(whole)),
    }
    for name, (rule, batch) in cases.items():
        src, out = str(tmp_path / name), []
        for b in itertools.chain(batches, ends):
            spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(src)
            streams.drain(rule(spark.readStream.schema(schema).parquet(src)), lambda df, _: out.extend(r["event_id"] for r in df.collect()), str(tmp_path / f"check-{name}"))  # noqa: B023
        want = sorted(r["event_id"] for r in batch.collect())
        assert want and sorted(out) == want
        for var in ("waiting", "recent"):
            left = spark.read.format("statestore").option("path", str(tmp_path / f"check-{name}")).option("stateVarName", var).load()
            assert {r["key"][0] for r in left.select("key").collect()} <= {"end"}


def test_rules_by_windows_are_the_batch_rules(spark, tmp_path):
    """Windows of an hour and of the rule's own length, in three batches: runs that cross a window's edge are found once."""
    rng = random.Random(11)
    schema = "event_id long, user_id string, ts timestamp, promo_code string, latitude double, longitude double"
    rows = [(i, rng.choice(["u", "v", None]), AT + datetime.timedelta(seconds=15 * i + rng.choice([0, 0, 0.25])), rng.choice(["p", "q", None]), rng.uniform(-80, 80), rng.uniform(-170, 170)) for i in range(1200)]
    end = [(9999, "end", AT + datetime.timedelta(days=2), "p", 0.0, 0.0)]
    whole = spark.createDataFrame(rows, schema)
    cases = {"rapid": (rules.rapid_fire, cep.rapid_fire(whole)), "promo": (rules.promo_abuse, cep.promo_abuse(whole)), "travel": (rules.impossible_travel, cep.impossible_travel(whole))}
    for (name, (rule, batch)), every in itertools.product(cases.items(), (1, 3600)):
        src, out = str(tmp_path / f"{name}-{every}"), []
        for b in (rows[:500], rows[500:], end):
            spark.createDataFrame(b, schema).repartition(2).write.mode("append").parquet(src)
            stream = rule(spark.readStream.schema(schema).parquet(src), delay="2 minutes", every=every)
            streams.drain(stream, lambda df, _: out.extend(r["event_id"] for r in df.collect()), f"{src}-check")  # noqa: B023
        want = sorted(r["event_id"] for r in batch.collect())
        assert len(want) > 20 and sorted(out) == want


def test_streamed_rule_queries_make_no_call_for_each_key(spark, monkeypatch):
    """The queries' rules are one aggregation in the JVM, whatever the number of users."""
    from tiffin.plans import queries, state_queries

    plans = []

    def kept(df):
        plans.append(df._jdf.queryExecution().analyzed().toString())
        return spark.createDataFrame([], df.schema)

    monkeypatch.setattr(state_queries, "_run", kept)
    for name in ("stream_impossible_travel", "stream_rapid_fire", "stream_promo_abuse"):
        queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert len(plans) == 3 and all("TransformWithState" not in p and "Aggregate" in p for p in plans)


# --- schemas of several versions -------------------------------------------------------------------------------------------


def test_backward_compatibility(spark):
    ddl = T.StructType.fromDDL
    old = ddl("id int not null, price decimal(10,2), at timestamp, gone string, tags array<int>, place struct<city: string, zip: int>, m map<string, float>")
    new = ddl("id bigint not null, price decimal(12,2), at timestamp, tags array<bigint>, place struct<city: string, zip: string, lane: string>, m map<string, double>, note string")
    got = {r["path"]: (r["finding"], r["breaking"]) for r in quality.schema_compatibility(spark, old, new).collect()}
    assert got == {
        "id": ("type", False), "price": ("type", False), "gone": ("removed", False), "tags[]": ("type", False),
        "place.zip": ("type", True), "place.lane": ("added", False), "m{}": ("type", False), "note": ("added", False),
    }
    strict = ddl("id int not null, price decimal(10,2) not null, at timestamp, kind string not null")
    found = lambda **kw: {(r["path"], r["finding"]) for r in quality.schema_compatibility(spark, old, strict, **kw).where("breaking").collect()}
    assert found() == {("price", "nullable"), ("kind", "added")}
    assert found(defaults=frozenset(["kind", "price"])) == set()
    assert quality.schema_compatibility(spark, old, old).count() == 0
    narrower = {r["path"] for r in quality.schema_compatibility(spark, new, old).where("breaking").collect()}
    assert narrower == {"id", "price", "tags[]", "place.zip", "m{}"}


def test_versions_are_held_against_all_before(spark):
    ddl = T.StructType.fromDDL
    versions = [ddl("a int"), ddl("a bigint"), ddl("a int")]
    assert [tuple(r) for r in quality.incompatible_versions(spark, versions).collect()] == [(1, 2, "a", "type")]
    assert quality.incompatible_versions(spark, versions[:1]).count() == 0


# --- epochs and segments -----------------------------------------------------------------------------------------------------


def _partial(rows):
    return rollup.rollup(rows, "ts", ["dt", "city"], sums={"total": "v"}, thetas={"users": "u"}, hlls={"hll": "u"}, quantiles={"kll": "v"})


def test_epochs_and_segments_are_the_roll_up_of_all_rows(spark, tmp_path):
    rows = spark.range(4000).selectExpr("id", "timestamp_seconds(1704067200 + id * 45) as ts", "cast(id % 3 as string) as city", "cast(id % 97 as string) as u", "cast(id % 1000 as double) as v")
    rows = rows.withColumn("dt", F.date_format("ts", "yyyy-MM-dd"))
    merge = segments.merge_rollups(["dt", "city"], sums=["total"], thetas=["users"], hlls=["hll"], quantiles=["kll"])
    table = segments.SegmentTable(spark, str(tmp_path / "t"), merge, "dt", ("city",), 300)
    read = lambda df: sorted(map(tuple, df.select("time", "dt", "city", "count", "total", F.theta_sketch_estimate("users")).collect()), key=str)
    with pytest.raises(ValueError, match="no epoch"):
        table.read()
    table.compact()
    for epoch in range(4):
        table.replace(_partial(rows.where(f"id % 4 = {epoch}")), epoch)
    table.replace(_partial(rows.where("id % 4 = 3")), 3)  # run again
    want = read(_partial(rows))
    assert read(table.read()) == want
    before = table.read()
    table.compact()
    assert table.base() == 3 and table.epochs() == [] and read(table.read()) == want == read(before)
    table.replace(_partial(rows.where("id % 4 = 2")), 2)  # in the base already
    table.compact()
    assert read(table.read()) == want
    table.replace(_partial(rows.where("id < 10")), 4)  # late rows of old minutes
    late = read(_partial(rows.union(rows.where("id < 10"))))
    assert read(table.read()) == late
    table.compact()
    table.replace(_partial(rows.where("id = 0")), 5)
    table.compact()
    assert table.base() == 5 and not (tmp_path / "t" / "base-3").exists() and (tmp_path / "t" / "base-4").exists()
    health = {r["dt"]: (r["file_count"], r["record_count"]) for r in sinks.file_health(spark, str(tmp_path / "t" / "base-5"), "dt").select(F.col("dt").cast("string").alias("dt"), "file_count", "record_count").collect()}
    assert all(-(-n // 300) <= files <= 2 * -(-n // 300) for files, n in health.values()) and max(f for f, _ in health.values()) > 1
    one = table.read().groupBy().agg(rollup.distinct_hll("hll").alias("u"), rollup.quantile("kll", 0.5).alias("p50")).first()
    assert abs(one["u"] - 97) <= 3 and abs(one["p50"] - 500) < 30


def test_plain_rows_are_planned_without_a_copy(spark, tmp_path, monkeypatch):
    table = segments.SegmentTable(spark, str(tmp_path), None, "dt", ("id",), 10)
    table.replace(spark.range(95).selectExpr("id", "cast(id % 2 as string) as dt"), 0)
    made = []
    parquet = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: made.append(path.rpartition("/")[2]) or parquet(self, path, *a, **k))
    table.compact()
    assert made == ["base-0"] and not (tmp_path / "merged-0").exists()
    assert sorted(r.id for r in table.read().collect()) == list(range(95))
    assert len(list(tmp_path.glob("base-0/dt=*/*.parquet"))) >= 10


def test_an_epoch_that_broke_off_is_not_read(spark, tmp_path):
    table = segments.SegmentTable(spark, str(tmp_path), None, "dt")
    rows = spark.range(10).selectExpr("id", "'a' as dt")
    table.replace(rows, 0)
    table.replace(rows, 1)
    (tmp_path / "epochs" / "epoch=1" / "_SUCCESS").unlink()
    assert table.read().count() == 10
    table.replace(rows, 1)
    assert table.read().count() == 20

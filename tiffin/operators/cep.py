"""Fraud and anomaly rules over ordered events, in batch; tiffin.streaming.stateful has them over streams."""

from __future__ import annotations

import math
from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiffin.functions.expr import fraud_severity, haversine_km, ladder, normalise_address
from tiffin.operators.tables import broadcast_if_small, written

#: Fixed values of the rules.
FRAUD_WINDOW, MIN_ADDRESSES = "5 MINUTES", 2
SPIKE, LEAST, ALPHA = 3.0, 5, 0.3


def sliced(events: DataFrame, ts: str, window: str, slice_: str) -> DataFrame:
    """`events` cut by time into slices, as `_slice`, each with the rows that a look-back from it reaches as `_before`.

    A row of the last `window` of a slice is also in the next one, so a look-back of a row that is not `_before` sees
    all it needs inside its slice, and one busy key spreads over as many tasks as it has slices. `slice_` must not be
    shorter than `window`.
    """
    length, reach = _micros(slice_), _micros(window)
    if length < reach:
        raise ValueError("a slice must be as long as the window at least")
    own = F.floor(F.unix_micros(ts) / length)
    late = F.unix_micros(ts) >= (own + 1) * length - reach
    places = F.when(late, F.array(F.struct(own.alias("s"), F.lit(False).alias("b")), F.struct((own + 1).alias("s"), F.lit(True).alias("b"))))
    places = F.coalesce(places, F.array(F.struct(own.alias("s"), F.lit(False).alias("b"))))
    return events.select("*", F.explode(places).alias("_p")).select(*events.columns, F.col("_p.s").alias("_slice"), F.col("_p.b").alias("_before"))


def _micros(interval: str) -> int:
    return int(pd.Timedelta(interval.lower()) / pd.Timedelta(microseconds=1))


def multi_address_fraud(orders: DataFrame, window: str = FRAUD_WINDOW, least: int = MIN_ADDRESSES, slice_: str = "1 hour") -> DataFrame:
    """An alert for each placed order whose user has at least `least` addresses in the window that ends with it.

    `orders` has user_id, order_id, ts, status, address. The look-back includes its far end; blank addresses and
    other statuses do not count. Orders of one user at the same instant see each other.

    Users are cut into time slices that overlap by the window; inside one, rows arrive sorted and two pointers pass over
    them, so a task holds one window of rows, and lists are made for alerts alone.
    """
    rows = orders.where((F.upper("status") == "PLACED") & (F.length(F.trim("address")) > 0) & F.col("ts").isNotNull())
    rows = rows.select("user_id", "order_id", "ts", normalise_address(F.col("address")).alias("place"))
    longest = max(_micros(window), _micros(slice_))
    rows = sliced(rows, "ts", window, f"{longest} us").withColumn("at", F.unix_micros("ts"))
    user, order = (rows.schema[c].dataType.simpleString() for c in ("user_id", "order_id"))
    reach = _micros(window)

    def scan(batches):
        key, near, seen, peers = None, deque(), {}, []  # near: (at, order_id, place) of the window; peers: rows of one instant

        def alerts():
            """The alerts of the rows of one instant, once all of them are in."""
            out = []
            if len(seen) >= least and any(not before for _, _, before in peers):
                places = sorted(seen)
                names = sorted(r[1] for r in near if r[1] is not None)  # as collect_list, which leaves out nulls
                out = [(*row, ",".join(map(str, names)), ",".join(places), len(places), len(names), near[0][0], when) for when, row, before in peers if not before]
            peers.clear()
            return out

        for b in batches:
            out = []
            for u, o, at, place, s, before in zip(*(b[c].tolist() for c in ("user_id", "order_id", "at", "place", "_slice", "_before"))):
                if peers and ((u, s) != key or at != peers[0][0]):
                    out += alerts()
                if (u, s) != key:
                    key = (u, s)
                    near.clear()
                    seen.clear()
                while near and near[0][0] < at - reach:
                    gone = near.popleft()[2]
                    seen[gone] -= 1
                    if not seen[gone]:
                        del seen[gone]
                near.append((at, o, place))
                seen[place] = seen.get(place, 0) + 1
                peers.append((at, (u, o), before))
            yield _frame(out)
        yield _frame(alerts() if peers else [])

    rows = rows.repartition("user_id", "_slice").sortWithinPartitions("user_id", "_slice", "at", "order_id").drop("ts")
    out = rows.mapInPandas(scan, f"user_id {user}, order_id {order}, order_ids string, distinct_addresses string, address_count int, order_count int, window_start long, window_end long")
    at = {c: F.timestamp_micros(c) for c in ("window_start", "window_end")}
    out = out.withColumns(at).withColumn("severity", fraud_severity(F.col("address_count"), F.col("order_count")))
    return out.select("user_id", "order_id", "order_ids", "distinct_addresses", "address_count", "order_count", "severity", "window_start", "window_end")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["user_id", "order_id", "order_ids", "distinct_addresses", "address_count", "order_count", "window_start", "window_end"])


def look_back_rule(events: DataFrame, keys: list[str], ts: str, order: str, seconds: float, threshold: int = 4) -> DataFrame:
    """Events that end a run of `threshold` events of their key within `seconds`, the far end included."""
    w = Window.partitionBy(*keys).orderBy(ts, order)
    first = F.lag(ts, threshold - 1).over(w)
    return events.withColumn("run_start", first).where(F.unix_micros(ts) - F.unix_micros("run_start") <= int(seconds * 1_000_000))


def rapid_fire(events: DataFrame, **columns: str) -> DataFrame:
    return look_back_rule(events, [columns.get("user", "user_id")], columns.get("ts", "ts"), columns.get("order", "event_id"), 120)


def promo_abuse(events: DataFrame, **columns: str) -> DataFrame:
    """Four uses of one promotion by one user within ten minutes."""
    code = columns.get("promo", "promo_code")
    return look_back_rule(events.where(F.col(code).isNotNull()), [columns.get("user", "user_id"), code], columns.get("ts", "ts"), columns.get("order", "event_id"), 600)


def high_value(events: DataFrame, amount: str = "total_amount", threshold: float = 50_000) -> DataFrame:
    return events.where(F.col(amount) > threshold)


def impossible_travel(events: DataFrame, km: float = 500, seconds: float = 300) -> DataFrame:
    """Events (user_id, ts, latitude, longitude, event_id) more than `km` from the user's last one within `seconds`."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    before = {f"last_{c}": F.lag(c).over(w) for c in ("ts", "latitude", "longitude")}
    rows = events.withColumns(before)
    rows = rows.withColumn("distance_km", haversine_km(F.col("last_latitude"), F.col("last_longitude"), F.col("latitude"), F.col("longitude")))
    return rows.where((F.col("distance_km") > km) & (F.unix_micros("ts") - F.unix_micros("last_ts") <= int(seconds * 1e6)))


def window_counts(events: DataFrame, key: str, ts: str, size: str = "10 minutes", slide: str = "1 minute") -> DataFrame:
    """Counts by key and sliding window; windows without events have no row."""
    out = events.groupBy(key, F.window(ts, size, slide).alias("w")).agg(F.count("*").alias("n"))
    return out.select(key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n")


def _severity(rate: Column) -> Column:
    return ladder((rate >= 10, "CRITICAL"), (rate >= 5, "HIGH"), otherwise="MEDIUM")


def _moving_average(n: np.ndarray, begin: np.ndarray, start: np.ndarray, alpha: float) -> np.ndarray:
    """The average after each value: of runs that begin at `begin`, from the average `start` before each (NaN: none).

    The average after i values of a run is that of the run alone plus (1 - alpha) ** i times what the start differs
    from the run's first value, as the recursion is an affine map.
    """
    size = np.diff(np.append(begin, len(n)))
    run = np.repeat(np.arange(len(begin)), size)
    alone = pd.Series(n).groupby(run).ewm(alpha=alpha, adjust=False).mean().to_numpy()
    off = np.nan_to_num(start - n[begin])[run]
    return alone + np.power(1 - alpha, np.arange(1, len(n) + 1) - begin[run]) * off


def _runs(batch: pd.DataFrame) -> tuple[np.ndarray, list]:
    """Where the runs of equal (key, chunk) begin in a batch, and what they are."""
    keys = list(zip(batch["key"].tolist(), batch["chunk"].tolist()))
    return np.array([i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]], np.int64), keys


def ema_anomalies(counts: DataFrame, key: str, alpha: float = ALPHA, spike: float = SPIKE, least: int = LEAST, chunk: str = "1 day") -> DataFrame:
    """Windows whose count is at least `least` and `spike` times the moving average of the key's earlier windows.

    The first window only starts the average, which moves after each test. A key's history is cut into chunks of time,
    so it spreads over the tasks. A chunk maps the average before it to the one after it by x -> a * x + b; a first
    pass makes these maps, their composition in order (one row a chunk) gives the average before each chunk, and a
    second pass goes through the chunks from there. Tasks hold one Arrow batch.
    """
    length = _micros(chunk)
    named = F.when(F.col(key).isNull(), "").otherwise(F.concat(F.lit("="), F.col(key).cast("string")))  # no null, for the joins
    rows = counts.select(named.alias("key"), "window_start", "window_end", F.col("n").cast("double").alias("n"), F.floor(F.unix_micros("window_start") / length).alias("chunk"))
    rows = rows.repartition("key", "chunk").sortWithinPartitions("key", "chunk", "window_start")

    def maps(batches):
        """(key, chunk, size, first, last): number of a chunk's values, the first, and the average after them from none."""
        held = None  # [(key, chunk), size, first, last]
        for b in batches:
            if not len(b):
                continue
            begin, keys = _runs(b)
            size = np.diff(np.append(begin, len(b)))
            goes_on = held is not None and keys[0] == held[0]
            start = np.full(len(begin), np.nan)
            if goes_on:
                start[0] = held[3]
            n = b["n"].to_numpy()
            last = _moving_average(n, begin, start, alpha)[begin + size - 1]
            out = [[keys[i], int(s), float(n[i]), float(x)] for i, s, x in zip(begin, size, last)]
            if goes_on:
                out[0][1:3] = out[0][1] + held[1], held[2]
            elif held is not None:
                out.insert(0, held)
            held = out.pop()
            yield _maps(out)
        yield _maps([held] if held else [])

    def compose(batches):
        """The average before each chunk: `last` of the one before, moved by what that one started from."""
        now, base = None, math.nan
        for b in batches:
            before = []
            for k, size, first, last in zip(b["key"], b["size"], b["first"], b["last"]):
                if k != now:
                    now, base = k, math.nan
                before.append(base)
                base = last if math.isnan(base) else last + (1 - alpha) ** size * (base - first)
            yield b[["key", "chunk"]].assign(base=before)

    def scan(batches):
        now, carried = None, math.nan
        for b in batches:
            if not len(b):
                continue
            begin, keys = _runs(b)
            start = b["base"].to_numpy()[begin].astype(float)
            if keys[0] == now:
                start[0] = carried
            after = _moving_average(b["n"].to_numpy(), begin, start, alpha)
            before = np.concatenate(([np.nan], after[:-1]))
            before[begin] = start
            now, carried = keys[-1], float(after[-1])
            yield b.drop(columns=["chunk", "base"]).assign(baseline=before)

    made = rows.select("key", "chunk", "n").mapInPandas(maps, "key string, chunk long, size long, first double, last double")
    bases = written(made.repartition("key").sortWithinPartitions("key", "chunk").mapInPandas(compose, "key string, chunk long, base double"))
    rows = rows.join(broadcast_if_small(bases), ["key", "chunk"]).select("key", "window_start", "window_end", "n", "chunk", "base")
    rows = rows.repartition("key", "chunk").sortWithinPartitions("key", "chunk", "window_start")
    rows = rows.mapInPandas(scan, "key string, window_start timestamp, window_end timestamp, n double, baseline double").where("baseline is not null and not isnan(baseline)")
    rate = F.when(F.col("baseline") > 0, F.col("n") / F.col("baseline")).otherwise(F.col("n"))
    rows = rows.withColumn("spike_ratio", rate).where((F.col("n") >= least) & (F.col("spike_ratio") >= spike))
    name = F.when(F.col("key") != "", F.substring("key", 2, 1 << 30))
    return rows.select(name.alias(key), "window_start", "window_end", F.col("n").cast("long").alias("n"), "baseline", "spike_ratio", _severity(F.col("spike_ratio")).alias("severity"))


def _maps(rows: list) -> pd.DataFrame:
    return pd.DataFrame([(*name, *values) for name, *values in rows], columns=["key", "chunk", "size", "first", "last"])


def session_summary(pings: DataFrame, gap: str | None = None) -> DataFrame:
    """Of pings (user_id, ts, latitude, longitude): start, end, number and ordered places, by user or session."""
    keys = ["user_id"] if gap is None else ["user_id", F.session_window("ts", gap).alias("s")]
    out = pings.groupBy(*keys).agg(F.min("ts").alias("start"), F.max("ts").alias("end"), F.count("*").alias("pings"), F.array_sort(F.collect_list(F.struct("ts", "latitude", "longitude"))).alias("places"))
    return out.drop("s")

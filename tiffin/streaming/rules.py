"""Keyed rules over streams of events, on transformWithState: rapid fire, promotion abuse, impossible travel.

Events wait in a key's list state until the watermark has passed them; an event-time timer then lets all of those through
in order, so each rule sees the same sequence as its batch form in tiffin.operators.cep, however late or mixed the events
came. A key has one timer for each batch that brings it events, and each call takes a few state operations, whatever the
number of its events. What a rule must still know goes with another timer once nothing can look back to it; then the key
has no state at all. Needs the RocksDB state store.

That takes some calls between Python and the JVM for every key of a batch. With `every`, a number of seconds, the rules
let events through by windows of that length instead, each with what it looks back to, as a windowed aggregation in the
JVM: for many keys, where an alert may wait for its window's end.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tiffin.functions.expr import haversine_km

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _InOrder(StatefulProcessor):
    """Gives each event with the event `lag` places before it, in order of time; state: waiting rows and the last few.

    Rows are (micros, order, columns...). `reach` is how long, in microseconds, a row can be looked back to.
    """

    def __init__(self, names: list[str], schema: T.StructType, lag: int, reach: int, prior: dict[str, str]):
        self.names, self.schema, self.lag, self.reach, self.prior = names, schema, lag, reach, prior

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.schema)
        self.recent = handle.getListState("recent", self.schema)

    def _timer(self, micros: int) -> None:
        self.handle.registerTimer(-(-micros // 1000))  # the first millisecond that is not before it

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803  Spark's names
        fresh = [tuple(r[c] for c in self.names) for r in rows]
        self.waiting.appendList(fresh)
        self._timer(min(r[0] for r in fresh))  # the least of all that wait has a timer, from this batch or from another
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        now = timerValues.getCurrentWatermarkInMs() * 1000  # all rows up to here are in, later ones with them are dropped
        waiting, recent = [tuple(r) for r in self.waiting.get()], [tuple(r) for r in self.recent.get()]
        due, later = sorted((r for r in waiting if r[0] <= now), key=lambda r: r[:2]), [r for r in waiting if r[0] > now]
        before, out, made = [*recent, *due], [], Row(*self.names, *self.prior.values())
        back = [self.names.index(c) for c in self.prior]
        for i, row in enumerate(due, len(recent) - self.lag):
            out.append(made(*row, *(before[i][c] if i >= 0 else None for c in back)))
        kept = [r for r in before[-self.lag :] if r[0] + self.reach >= now]
        if due:
            _put(self.waiting, later)
            if later:
                self._timer(min(r[0] for r in later))
        if due or len(kept) < len(recent):
            _put(self.recent, kept)
            if kept:
                self._timer(kept[-1][0] + self.reach + 1000)
        return iter(out)

    def close(self) -> None:
        pass


def _put(state, rows: list[tuple]) -> None:
    if rows:
        state.put(rows)
    else:
        state.clear()


def with_earlier(events: DataFrame, keys: list[str], ts: str, order: str, columns: list[str], lag: int, seconds: float, delay: str, prior: dict[str, str]) -> DataFrame:
    """A stream of events with `prior` columns of the key's event `lag` places before, null if that is `seconds` away.

    `columns` are taken along. `prior` maps columns, `rule_at` being the time in microseconds, to their names in the result.
    Rows without a time are left out.
    """
    rows = events.where(F.col(ts).isNotNull()).withWatermark(ts, delay)
    rows = rows.select(ts, *(F.col(k).cast("string").alias(f"rule_key{i}") for i, k in enumerate(keys)), F.unix_micros(ts).alias("rule_at"), F.col(order).alias("rule_order"), *columns)
    held = ["rule_at", "rule_order", *columns]
    schema = T.StructType([T.StructField(c, rows.schema[c].dataType) for c in held])
    back = [T.StructField(n, schema[c].dataType) for c, n in prior.items()]
    grouped = rows.groupBy(*(f"rule_key{i}" for i in range(len(keys))))
    rule = _InOrder(held, schema, lag, int(seconds * 1_000_000), prior)
    # The key's columns are among `columns`, so the result need not repeat them.
    return grouped.transformWithState(rule, T.StructType([*schema.fields, *back]), "Append", "EventTime")


def with_earlier_by_window(events: DataFrame, keys: list[str], ts: str, order: str, columns: list[str], lag: int, seconds: float, delay: str, prior: dict[str, str], every: float) -> DataFrame:
    """with_earlier(), by windows of `every` seconds that begin `seconds` early, so that each event's look-back is in its window.

    An event is given once, in the window of which it is not look-back, when the watermark passes the window's end. Columns
    must be of types that can be sorted.
    """
    reach, step = int(seconds * 1_000_000), int(max(every, seconds) * 1_000_000)
    window = F.window(ts, f"{step + reach} microseconds", f"{step} microseconds", f"{-reach % step} microseconds")
    held = [F.unix_micros(ts).alias("rule_at"), F.col(order).alias("rule_order"), *columns]
    rows = events.where(F.col(ts).isNotNull()).withWatermark(ts, delay)
    rows = rows.groupBy(window.alias("rule_window"), *(F.col(k).cast("string").alias(f"rule_key{i}") for i, k in enumerate(keys))).agg(F.sort_array(F.collect_list(F.struct(*held))).alias("rows"))
    rows = rows.select("rows", (F.unix_micros("rule_window.start") + reach).alias("own"))
    rows = rows.select("own", F.explode(F.transform("rows", lambda row, i: F.struct(row.alias("row"), F.get("rows", i - lag).alias("before")))).alias("r"))
    return rows.where("r.row.rule_at >= own").select("r.row.*", *(F.col(f"r.before.{c}").alias(n) for c, n in prior.items()))


def _earlier(events: DataFrame, *rule, every: float | None) -> DataFrame:
    return with_earlier(events, *rule) if every is None else with_earlier_by_window(events, *rule, every)


def look_back_rule(events: DataFrame, keys: list[str], ts: str, order: str, seconds: float, threshold: int = 4, delay: str = "30 seconds", every: float | None = None) -> DataFrame:
    """The batch rule over a stream: events that end a run of `threshold` events of their key within `seconds`."""
    columns = [c for c in events.columns if c not in (ts, order)]
    out = _earlier(events, keys, ts, order, columns, threshold - 1, seconds, delay, {"rule_at": "rule_start"}, every=every)
    out = out.where(F.col("rule_at") - F.col("rule_start") <= int(seconds * 1_000_000))
    return out.select(F.timestamp_micros("rule_at").alias(ts), F.col("rule_order").alias(order), *columns, F.timestamp_micros("rule_start").alias("run_start"))


def rapid_fire(events: DataFrame, user: str = "user_id", ts: str = "ts", order: str = "event_id", seconds: float = 120, delay: str = "30 seconds", every: float | None = None) -> DataFrame:
    return look_back_rule(events, [user], ts, order, seconds, 4, delay, every)


def promo_abuse(events: DataFrame, user: str = "user_id", promo: str = "promo_code", ts: str = "ts", order: str = "event_id", seconds: float = 600, delay: str = "30 seconds", every: float | None = None) -> DataFrame:
    """Four uses of one promotion by one user within ten minutes."""
    return look_back_rule(events.where(F.col(promo).isNotNull()), [user, promo], ts, order, seconds, 4, delay, every)


def impossible_travel(events: DataFrame, km: float = 500, seconds: float = 300, delay: str = "30 seconds", every: float | None = None) -> DataFrame:
    """Events (user_id, ts, latitude, longitude, event_id) more than `km` from the user's last one within `seconds`."""
    prior = {"rule_at": "rule_last", "latitude": "last_latitude", "longitude": "last_longitude"}
    out = _earlier(events, ["user_id"], "ts", "event_id", ["user_id", "latitude", "longitude"], 1, seconds, delay, prior, every=every)
    out = out.withColumn("distance_km", haversine_km(F.col("last_latitude"), F.col("last_longitude"), F.col("latitude"), F.col("longitude")))
    out = out.where((F.col("distance_km") > km) & (F.col("rule_at") - F.col("rule_last") <= int(seconds * 1_000_000)))
    return out.select("user_id", F.timestamp_micros("rule_at").alias("ts"), "latitude", "longitude", F.col("rule_order").alias("event_id"), F.timestamp_micros("rule_last").alias("last_ts"), "last_latitude", "last_longitude", "distance_km")

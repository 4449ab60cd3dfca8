"""Keyed state over streams: the moving-average anomaly rule and the multi-address fraud rule."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tiffin.functions.expr import fraud_severity, normalise_address
from tiffin.operators.cep import ALPHA, LEAST, SPIKE, _severity


class _MovingAverage(StatefulProcessor):
    """A key's moving average over its closed windows, in order; gives the windows that stand out."""

    def __init__(self, alpha: float, spike: float, least: int):
        self.alpha, self.spike, self.least = alpha, spike, least

    def init(self, handle) -> None:
        self.base = handle.getValueState("base", "base double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803  Spark's names
        base = self.base.get()[0] if self.base.exists() else None
        frame = pd.concat(list(rows)).sort_values("window_start")
        out = []
        for start, end, n in zip(frame["window_start"], frame["window_end"], frame["n"]):
            if base is not None:
                rate = n / base if base > 0 else float(n)
                if n >= self.least and rate >= self.spike:
                    out.append((key[0], start, end, n, base, rate))
            base = float(n) if base is None else self.alpha * n + (1 - self.alpha) * base
        self.base.update((base,))
        if out:
            yield pd.DataFrame(out, columns=["key", "window_start", "window_end", "n", "baseline", "spike_ratio"])

    def close(self) -> None:
        pass


def ema_anomalies(counts: DataFrame, key: str, alpha: float = ALPHA, spike: float = SPIKE, least: int = LEAST) -> DataFrame:
    """The batch rule's alerts over a stream of closed windows; needs the RocksDB state store."""
    schema = "key string, window_start timestamp, window_end timestamp, n long, baseline double, spike_ratio double"
    rows = counts.withColumn(key, F.col(key).cast("string"))
    out = rows.groupBy(key).transformWithStateInPandas(_MovingAverage(alpha, spike, least), schema, "Append", "None")
    return out.withColumnRenamed("key", key).withColumn("severity", _severity(F.col("spike_ratio")))


def multi_address_fraud(orders: DataFrame, minutes: int = 5, least: int = 2, delay: str = "30 seconds") -> DataFrame:
    """The batch rule's alerts over a stream of placed orders (user_id, order_id, ts, status, address).

    The state of a user is the orders of the last minutes; it is dropped when the watermark passes them.
    """
    placed = orders.where((F.upper("status") == "PLACED") & (F.length(F.trim("address")) > 0))
    placed = placed.select("user_id", F.col("order_id").cast("string").alias("order_id"), "ts", normalise_address(F.col("address")).alias("place")).withWatermark("ts", delay)
    span = pd.Timedelta(minutes=minutes)

    def step(k, frames: Iterator[pd.DataFrame], state):
        if state.hasTimedOut:
            state.remove()
            return
        times, ids, places = (list(x) for x in state.get) if state.exists else ([], [], [])
        held = [(pd.Timestamp(t, unit="us"), i, p) for t, i, p in zip(times, ids, places)]
        fresh = pd.concat(list(frames)).sort_values(["ts", "order_id"])
        held += list(zip(fresh["ts"], fresh["order_id"], fresh["place"]))
        held.sort(key=lambda r: r[0])
        out, low, high, seen = [], 0, 0, {}  # held[low:high] is the look-back of a row, seen its places
        for t, i in zip(fresh["ts"], fresh["order_id"]):
            while high < len(held) and held[high][0] <= t:
                seen[held[high][2]] = seen.get(held[high][2], 0) + 1
                high += 1
            while held[low][0] < t - span:
                seen[held[low][2]] -= 1
                low += 1
            found = sorted(p for p, n in seen.items() if n)
            if len(found) >= least:
                near = held[low:high]
                out.append((str(k[0]), i, ",".join(sorted(r[1] for r in near)), ",".join(found), len(found), len(near), near[0][0], t))
        # Orders up to the watermark may still come, and look back from there.
        mark = state.getCurrentWatermarkMs()
        floor = pd.Timestamp(mark, unit="ms") - span
        held = [r for r in held if r[0] >= floor]
        if held:
            state.update(([int(r[0].value // 1000) for r in held], [r[1] for r in held], [r[2] for r in held]))
            state.setTimeoutTimestamp(max(int(held[-1][0].value // 1_000_000) + minutes * 60_000, mark + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=["user_id", "order_id", "order_ids", "distinct_addresses", "address_count", "order_count", "window_start", "window_end"])

    schema = "user_id string, order_id string, order_ids string, distinct_addresses string, address_count int, order_count int, window_start timestamp, window_end timestamp"
    out = placed.groupBy("user_id").applyInPandasWithState(step, schema, "times array<long>, ids array<string>, places array<string>", "append", GroupStateTimeout.EventTimeTimeout)
    return out.withColumn("severity", fraud_severity(F.col("address_count"), F.col("order_count")))

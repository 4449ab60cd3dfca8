"""Exact percentiles by selection: passes over the rows narrow down where a rank lies, so no group is held in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiffin.operators.tables import broadcast_if_small, written

#: Different values of a group that one task may order.
LEAF = 100_000
_SPLITS = 64


def exact_percentiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float], leaf: int = LEAF, accuracy: int = 10_000) -> DataFrame:
    """Of each group the percentiles that `probs` names, as percentile_cont gives them: interpolated between ranks.

    A mergeable sketch brackets each rank; one scan counts what lies below and inside the bracket (a bracket that
    misses its rank is opened on that side) and takes along the few rows inside, equal values as one row with their
    number. Where more than `leaf` different values are left, they are split at 64 sketched places and the part with
    the rank goes on. A task thus orders `leaf` values at most, whatever a group's size.

    Nulls do not count, NaN is the largest value, a group of nulls alone has null, null keys are a group.
    """
    group = F.struct(*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys))) if keys else F.struct(F.lit(0).alias("k0"))
    rows = df.select(group.alias("g"), F.col(value).cast("double").alias("v"))
    names, eps = list(probs), 2 / accuracy
    asked = [q for p in probs.values() for q in (max(p - eps, 0.0), min(p + eps, 1.0))]
    sketch = written(rows.groupBy("g").agg(F.count("v").alias("n"), F.percentile_approx("v", asked, accuracy).alias("s")))
    rank = {p: F.lit(p) * (F.col("n") - 1) for p in probs.values()}
    low, high = (lambda i: F.col("s")[2 * i]), (lambda i: F.col("s")[2 * i + 1])

    # What lies below and up to the end of each bracket; then the brackets that hold their ranks.
    near = rows.where("v is not null").join(broadcast_if_small(sketch), "g")
    sums = [c for i in range(len(names)) for c in (F.count_if(F.col("v") < low(i)).alias(f"below{i}"), F.count_if(F.col("v") <= high(i)).alias(f"upto{i}"))]
    counted = near.groupBy("g").agg(F.first("n").alias("n"), F.first("s").alias("s"), *sums)
    marks = []
    for i, p in enumerate(probs.values()):
        first, last = F.floor(rank[p]), F.ceil(rank[p])
        left, right = first < F.col(f"below{i}"), last >= F.col(f"upto{i}")
        base = F.when(left, 0).otherwise(F.col(f"below{i}"))
        marks.append(F.struct(F.lit(i).alias("i"), F.when(~left, low(i)).alias("a"), F.when(~right, high(i)).alias("b"), (first - base).alias("first"), (last - base).alias("last"), (rank[p] - first).alias("share")))
    targets = written(counted.select("g", F.explode(F.array(*marks)).alias("t")).select("g", "t.*"))
    brackets = written(targets.groupBy("g").agg(F.collect_list(F.struct("i", "a", "b")).alias("t")))
    inside = rows.where("v is not null").join(broadcast_if_small(brackets), "g").select("g", "v", F.explode(F.filter("t", lambda t: (t["a"].isNull() | (F.col("v") >= t["a"])) & (t["b"].isNull() | (F.col("v") <= t["b"])))).alias("t"))
    held = written(inside.groupBy("g", F.col("t.i").alias("i"), "v").agg(F.count("*").alias("c")))
    # A rank lies between two values at most, so no split can leave fewer.
    while (held.groupBy("g", "i").count().agg(F.max("count")).first()[0] or 0) > max(leaf, 2):
        held, targets = _narrowed(held, targets)
    w = Window.partitionBy("g", "i").orderBy("v")
    at = held.withColumn("upto", F.sum("c").over(w)).join(broadcast_if_small(targets.select("g", "i", "first", "last", "share")), ["g", "i"])
    picked = at.groupBy("g", "i").agg(F.min(F.when(F.col("upto") > F.col("first"), F.col("v"))).alias("x"), F.min(F.when(F.col("upto") > F.col("last"), F.col("v"))).alias("y"), F.first("share").alias("share"))
    picked = picked.select("g", "i", F.when(F.col("share") == 0, F.col("x")).otherwise(F.col("x") + (F.col("y") - F.col("x")) * F.col("share")).alias("value"))
    one = picked.groupBy("g").agg(*(F.max(F.when(F.col("i") == i, F.col("value"))).alias(n) for i, n in enumerate(names)))
    out = sketch.select("g").join(broadcast_if_small(one), "g", "left")
    return out.select(*(F.col(f"g.k{i}").alias(k) for i, k in enumerate(keys)), *names)


def _narrowed(held: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The part of each group's values that holds its ranks, and the ranks in that part."""
    splits = held.groupBy("g", "i").agg(F.percentile_approx("v", [k / _SPLITS for k in range(1, _SPLITS)], 1000).alias("s"))
    placed = held.join(broadcast_if_small(written(splits)), ["g", "i"]).select("g", "i", "v", "c", F.size(F.filter("s", lambda x: x < F.col("v"))).alias("part"))
    w = Window.partitionBy("g", "i").orderBy("part")  # at most 64 rows a group
    parts = placed.groupBy("g", "i", "part").agg(F.sum("c").alias("c")).withColumn("upto", F.sum("c").over(w))
    parts = parts.withColumn("before", F.col("upto") - F.col("c")).join(broadcast_if_small(targets), ["g", "i"])
    parts = written(parts.where((F.col("before") <= F.col("last")) & (F.col("upto") > F.col("first"))))
    base = parts.groupBy("g", "i").agg(F.min("before").alias("base"))
    moved = targets.join(broadcast_if_small(written(base)), ["g", "i"]).select("g", "i", (F.col("first") - F.col("base")).alias("first"), (F.col("last") - F.col("base")).alias("last"), "share")
    return written(placed.join(broadcast_if_small(parts.select("g", "i", "part")), ["g", "i", "part"], "left_semi").drop("part")), written(moved)

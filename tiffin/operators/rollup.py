"""Time-bucket roll-ups with mergeable sketches, and queries over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of the theta sketch's entries: distinct counts below 2 ** 14 are exact.
THETA_LG, HLL_LG = 14, 12


def rollup(df: DataFrame, ts: str, dims: list[str], *, sums: dict[str, str] = {}, lows: dict[str, str] = {}, highs: dict[str, str] = {}, firsts: dict[str, str] = {}, thetas: dict[str, str] = {}, hlls: dict[str, str] = {}, quantiles: dict[str, str] = {}, bucket: str = "minute") -> DataFrame:  # noqa: B006
    """One row per time bucket and dimensions: count and the named metrics (name -> column), sketches as binary.

    `firsts` keep the value of the earliest event of the bucket.
    """
    made = [F.count("*").alias("count")]
    made += [F.sum(c).alias(n) for n, c in sums.items()] + [F.min(c).alias(n) for n, c in lows.items()] + [F.max(c).alias(n) for n, c in highs.items()]
    made += [F.min_by(c, ts).alias(n) for n, c in firsts.items()]
    made += [F.theta_sketch_agg(c, THETA_LG).alias(n) for n, c in thetas.items()]
    made += [F.hll_sketch_agg(c, HLL_LG).alias(n) for n, c in hlls.items()]
    made += [F.kll_sketch_agg_double(F.col(c).cast("double")).alias(n) for n, c in quantiles.items()]
    return df.groupBy(F.date_trunc(bucket, ts).alias("time"), *dims).agg(*made)


def distinct(sketch: str) -> Column:
    """Distinct estimate of theta sketches over a group."""
    return F.theta_sketch_estimate(F.theta_union_agg(sketch))


def distinct_hll(sketch: str) -> Column:
    return F.hll_sketch_estimate(F.hll_union_agg(sketch))


def quantile(sketch: str, p: float) -> Column:
    return F.kll_sketch_get_quantile_double(F.kll_merge_agg_double(sketch), F.lit(p))


def reroll(df: DataFrame, bucket: str, dims: list[str], *, sums: list[str], lows: list[str] = [], highs: list[str] = [], thetas: list[str] = []) -> DataFrame:  # noqa: B006
    """A coarser roll-up of a roll-up, as a compaction makes it."""
    made = [F.sum(c).alias(c) for c in ["count", *sums]] + [F.min(c).alias(c) for c in lows] + [F.max(c).alias(c) for c in highs] + [F.theta_union_agg(c).alias(c) for c in thetas]
    return df.groupBy(F.date_trunc(bucket, "time").alias("time"), *dims).agg(*made)


def count_if(condition: Column) -> Column:
    """Of a roll-up: the number of its events for which a condition on the dimensions holds."""
    return F.sum(F.when(condition, F.col("count")).otherwise(0))

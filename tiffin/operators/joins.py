"""Joins whose treatment of nulls or order a plain join does not have."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_in(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """Rows of `df` for which SQL's `key NOT IN (SELECT other_key FROM other)` is true.

    A null among the other keys makes that unknown for every row; a null key is kept only if there are no other keys.
    An anti join on the keys and one row of counts do it, so nothing is compared pair by pair.
    """
    stats = other.agg(F.count("*").alias("_all"), F.count_if(F.col(other_key).isNull()).alias("_nulls"))
    rest = df.join(other.where(F.col(other_key).isNotNull()).select(F.col(other_key).alias(key)), key, "left_anti")
    rest = rest.join(F.broadcast(stats), F.lit(True))  # one row
    return rest.where((F.col("_all") == 0) | (F.col(key).isNotNull() & (F.col("_nulls") == 0))).select(*df.columns)

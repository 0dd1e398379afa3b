"""Joins that stay balanced when one key holds a large share of the left rows.

Adaptive execution only splits a hot key when both sides come straight from a shuffle. A right side
that was reduced to one row per key does not, so hot keys are found and salted here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.session import is_small

# A key with this many rows is worth salting.
HOT_ROWS = 2_000_000
# Share of the key column that is counted to find hot keys; it decides placement, never results.
SAMPLE = 0.01
# Beyond this many hot keys each of the others holds less than a thousandth of the rows.
HOT_KEYS = 1_000
SALTS = 64


def hot_keys(df: DataFrame, key: str) -> list:
    """The most frequent keys of a batch table that have very many rows; null can be one."""
    if df.isStreaming:
        return []
    counted = df.select(key).sample(SAMPLE, seed=17).groupBy(key).count()
    frequent = counted.where(F.col("count") >= max(HOT_ROWS * SAMPLE, 1))
    rows = frequent.orderBy(F.desc("count")).limit(HOT_KEYS).collect()
    return [row[key] for row in rows]


def join_unique(
    left: DataFrame, right: DataFrame, key: str, how: str, hot: list | None = None
) -> DataFrame:
    """Join with a right side of one row per key (inner, left, left_semi or left_anti).

    Rows of a hot key are spread by the input split they come from, and the key's one right row is
    copied to each place. All other keys are joined as they are.
    """
    hot = hot_keys(left, key) if hot is None else hot
    if not hot:
        return left.join(right, key, how)
    named = [value for value in hot if value is not None]
    column = F.col(key)
    is_hot = column.isin(named)
    place = F.pmod(F.spark_partition_id(), F.lit(SALTS))
    # A null key matches nothing, so its rows may go anywhere.
    salted = left.withColumn("_salt", F.when(column.isNull() | is_hot, place).otherwise(F.lit(0)))
    places = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copied = right.withColumn("_salt", F.explode_outer(places))
    return salted.join(copied, [key, "_salt"], how).drop("_salt")


def join_dimension(left: DataFrame, dimension: DataFrame, key: str, how: str) -> DataFrame:
    """Join with a dimension of one row per key: broadcast when it is small, else by shuffle."""
    if is_small(dimension):
        return left.join(F.broadcast(dimension), key, how)
    return join_unique(left, dimension, key, how)

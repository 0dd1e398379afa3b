"""Sorting by time, top-n, and one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Groups of input splits that are ranked before a key's rows meet.
MIDDLE_GROUPS = 256


def sort_by_time(
    df: DataFrame, time_col: str = "publish_time", order: str = "desc",
    tie_break: Sequence[str] = ("link",),
) -> DataFrame:
    """Total order by time, nulls last in both directions.

    The row id at the end lets the range partitioner split a group of equal rows over tasks.
    """
    if order not in ("asc", "desc"):
        raise ValueError("order must be 'asc' or 'desc'")
    time = F.col(time_col)
    first = time.asc_nulls_last() if order == "asc" else time.desc_nulls_last()
    ties = [F.col(c).asc_nulls_last() for c in tie_break if c in df.columns]
    return (
        df.withColumn("_row", F.monotonically_increasing_id())
        .orderBy(first, *ties, "_row")
        .drop("_row")
    )


def top_n(
    df: DataFrame, n: int, time_col: str = "publish_time", order: str = "desc",
    tie_break: Sequence[str] = ("link",), feed_order: Sequence[str] = ("feed_source", "pos"),
) -> DataFrame:
    """First n rows by time; without the time column, the first n in feed order."""
    if time_col in df.columns:
        return sort_by_time(df, time_col, order, tie_break).limit(n)
    return df.orderBy(*[c for c in feed_order if c in df.columns]).limit(n)


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1
) -> DataFrame:
    """The first n rows of every key in the given order.

    The rank filter is pushed below the shuffle (``configure`` lifts Spark's limit on n), so every
    map task sends at most n rows of a key. For n > 1 the rows of a key then meet in MIDDLE_GROUPS
    groups of splits first, so the last task of a key that is everywhere gets MIDDLE_GROUPS * n rows.
    """
    def ranked(rows: DataFrame, by: Sequence) -> DataFrame:
        window = Window.partitionBy(*by).orderBy(*order)
        return (
            rows.withColumn("_rank", F.row_number().over(window))
            .where(F.col("_rank") <= n)
            .drop("_rank")
        )

    if n > 1:
        df = df.withColumn("_group", F.spark_partition_id() % MIDDLE_GROUPS)
        df = ranked(df, [*keys, "_group"]).drop("_group")
    return ranked(df, list(keys))


def top_n_per_feed(
    df: DataFrame, n: int, feed_col: str = "feed_source", pos_col: str = "pos"
) -> DataFrame:
    """The first n rows of each feed in feed order."""
    return first_per_key(df, [feed_col], [F.col(pos_col).asc()], n)


def latest_articles(sitemap: DataFrame, n: int) -> DataFrame:
    """The n most recently modified sitemap entries."""
    return top_n(sitemap, n, time_col="lastmod", order="desc", tie_break=("url",))

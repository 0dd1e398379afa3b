"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import counted, few, stored


def lowest(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of each u, a partial aggregate."""
    return edges.groupBy("u").agg(F.min("v").alias("low"))


def large_star(edges: DataFrame, rows: int) -> DataFrame:
    """Larger neighbours of each vertex go to its smallest neighbour, or to itself."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # Written, so that both sides of the join come straight from a shuffle and a hot vertex is split.
    joined = both.join(stored(few(lowest(both), 2 * rows), "lowest"), "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.least("u", "low").alias("v"))


def small_star(edges: DataFrame, rows: int) -> DataFrame:
    """The smaller neighbours of each vertex, and the vertex itself, go to the smallest of them."""
    least = stored(few(lowest(edges), rows), "lowest")
    others = edges.join(least, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return others.union(least.select("u", F.col("low").alias("v")))


def all_stars(edges: DataFrame) -> bool:
    """Whether every u has one v, and no v is a u: then each v is its component's smallest id."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    seen = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where("up > 1 OR (up = 1 AND down = 1)").limit(1).count() == 0


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """`id, component`: the smallest id that each linked id reaches. links: `u long, v long`.

    Both directions are the same link; links of an id to itself or with a null, and repeated links
    count for nothing. An empty table gives no rows; ids without links are not in the result. Every
    round is written to the shared folder, and the number of rounds grows with the logarithm of the
    largest component's width. Smallest neighbours are written and joined back, so that Spark can
    split the task of a vertex with very many links. rows: so many links are given at most, if known.
    """
    edges = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, rows = counted(edges if rows is None else few(edges, rows), "links")
    while not all_stars(edges):
        # A step never has more links than the one before it.
        stars = stored(few(large_star(edges, rows), 2 * rows), "large-stars")
        edges, rows = counted(few(small_star(stars, rows).distinct(), rows), "links")
    roots = edges.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)

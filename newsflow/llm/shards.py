"""Shards of near equal bytes by a k-d tree over document metadata.

A node with several shards is cut along its widest dimension at the weighted quantile that gives
both sides their share of bytes. The quantile comes from byte histograms that Spark adds up; the
driver sees a bounded number of sums per round and narrows the range until the cut is exact enough.
The tree reaches the tasks as arrays by node number, so the plan does not grow with the shards.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.common import stored, utf8

ROW_OVERHEAD = 8
SPREAD_BITS = 31
# Sums of all open nodes that one round brings to the driver.
ROUND_SUMS = 2**18
# Equal rows beyond this many are dealt out in runs of so many.
RUN_ROWS = 10_000
# monotonically_increasing_id has the partition above this many bits.
PARTITION_BITS = 33


def number_coordinate(column: str) -> Column:
    """A number as it is; NaN counts as null, infinite values as the largest finite ones."""
    value = F.col(column).cast("double")
    bounded = F.greatest(F.least(value, F.lit(sys.float_info.max)), F.lit(-sys.float_info.max))
    return F.when(value.isNotNull() & ~F.isnan(value), bounded)


def numbers(values: Sequence[int]) -> Column:
    """An array of any length as one literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>")


def ranked(rows: DataFrame, column: str, rank: str) -> DataFrame:
    """The rows with the rank of a text among the distinct texts of its column, whole texts in byte order.

    The distinct values are sorted in parallel; a value's rank is its place in its partition behind
    the values of all partitions before, of which the driver sees the counts.
    """
    values = rows.select(column).distinct().orderBy(column).withColumn("at", F.monotonically_increasing_id())
    values = stored(values, "shard-values")
    part = F.shiftright("at", PARTITION_BITS)
    sizes = {r["part"]: r["count"] for r in values.groupBy(part.alias("part")).count().collect()}
    starts, total = [], 0
    for p in range(max(sizes, default=0) + 1):
        starts.append(total)
        total += sizes.get(p, 0)
    place = F.get(numbers(starts), part.cast("int")) + F.col("at").bitwiseAND((1 << PARTITION_BITS) - 1)
    ranks = stored(values.select(column, place.cast("double").alias(rank)), "shard-ranks")
    return rows.join(ranks, column).drop(column)


def one_by_one(grouped: DataFrame) -> DataFrame:
    """A row per `number` from 0 to n - 1; runs of very many equal rows are dealt over the tasks."""
    few = grouped.where(F.col("n") <= RUN_ROWS).withColumn("number", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    runs = grouped.where(F.col("n") > RUN_ROWS).withColumn(
        "run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(RUN_ROWS).cast("long"))))
    last = F.least(F.col("n"), F.col("run") + RUN_ROWS) - 1
    return few.union(runs.repartition(F.xxhash64(*runs.columns)).withColumn("number", F.explode(F.sequence("run", last))).drop("run"))


@dataclass
class Node:
    """A box with `shards` shards from `first` on; its halves have twice its number and the one after."""

    number: int
    first: int
    shards: int
    dim: int = -1
    cut: int = 0

    def halves(self) -> list[Node]:
        left = self.shards // 2
        return [Node(2 * self.number, self.first, left), Node(2 * self.number + 1, self.first + left, self.shards - left)]


class Tree:
    """All nodes by number; a node without a dimension is a leaf so far."""

    def __init__(self, shards: int):
        self.nodes = {1: Node(1, 0, shards)}

    def open(self) -> list[Node]:
        return [n for n in self.nodes.values() if n.dim < 0 and n.shards > 1]

    def array(self, value: str, missing: int = -1) -> Column:
        size = max(self.nodes) + 1
        return numbers([getattr(self.nodes[i], value) if i in self.nodes else missing for i in range(size)])

    def leaf(self) -> Column:
        """The number of the leaf that a row with the keys `ks` falls into."""
        depth = max(self.nodes).bit_length() - 1
        root = F.lit(1).cast("long")
        if not depth:
            return root
        dims, cuts = self.array("dim"), self.array("cut")

        def down(node: Column, _: Column) -> Column:
            right = F.get("ks", F.get(dims, node)) > F.get(cuts, node)
            return F.when(F.get(dims, node) < 0, node).otherwise(node * 2 + right.cast("long"))

        return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), root, down)

    def shard(self) -> Column:
        return F.get(self.array("first"), self.leaf()).cast("int")


@dataclass
class Search:
    """Where the cut of a node lies: below it are `under` bytes, wanted are `target`."""

    node: Node
    dim: int
    low: int
    high: int
    target: float
    under: float = 0.0
    done: int | None = None

    def step(self, bins: int) -> int:
        return max(1, -(-(self.high - self.low + 1) // bins))


def narrow(search: Search, found: list, slack: float) -> None:
    """Go on in the bin where the bytes pass the target, or settle on one of its ends."""
    for b in sorted(found, key=lambda r: r.bin):
        if search.under + b.bytes < search.target:
            search.under += b.bytes
            search.low = b.high + 1
            continue
        if b.bytes <= slack or b.low == b.high:
            nearer_with = search.under + b.bytes - search.target <= search.target - search.under
            search.done = b.high if nearer_with else b.low - 1
        else:
            search.low, search.high = b.low, b.high
        return
    search.done = search.high


def split_level(meta: DataFrame, tree: Tree, n_dims: int, bins: int, slack: float) -> None:
    """Cut every open node once."""
    located = meta.withColumn("node", tree.leaf())
    dims = range(n_dims)
    spans = located.groupBy("node").agg(
        F.sum("size").alias("bytes"), *[F.min(F.get("ks", F.lit(d))).alias(f"l{d}") for d in dims],
        *[F.max(F.get("ks", F.lit(d))).alias(f"h{d}") for d in dims],
    )
    of_node = {r["node"]: r for r in spans.collect()}
    searches, opened = [], tree.open()
    for node in opened:
        half, *_ = node.halves()
        if r := of_node.get(node.number):
            dim = max(dims, key=lambda d: (r[f"h{d}"] >> SPREAD_BITS) - (r[f"l{d}"] >> SPREAD_BITS))
            searches.append(Search(node, dim, r[f"l{dim}"], r[f"h{dim}"], r["bytes"] * half.shards / node.shards))
    while waiting := [s for s in searches if s.done is None]:
        fine = max(16, min(bins, ROUND_SUMS // len(waiting)))
        of = {s.node.number: s for s in waiting}
        known = range(max(of) + 1)
        dim, low, high, step = (
            F.get(numbers([value(of[i]) if i in of else -1 for i in known]), F.col("node"))
            for value in (lambda s: s.dim, lambda s: s.low, lambda s: s.high, lambda s: s.step(fine)))
        keyed = located.select("node", "size", F.get("ks", dim).alias("key"), low.alias("low"), high.alias("high"), step.alias("step"))
        sums = keyed.where("key BETWEEN low AND high").groupBy("node", F.floor((F.col("key") - F.col("low")) / F.col("step")).alias("bin"))
        found: dict[int, list] = {i: [] for i in of}
        for r in sums.agg(F.sum("size").alias("bytes"), F.min("key").alias("low"), F.max("key").alias("high")).collect():
            found[r["node"]].append(r)
        for i, s in of.items():
            narrow(s, found[i], slack)
    for s in searches:
        s.node.dim, s.node.cut = s.dim, s.done
    for node in opened:
        node.dim = max(node.dim, 0)
        tree.nodes.update({n.number: n for n in node.halves()})


def assign(
    docs: DataFrame, n_shards: int | None, dims: list[Column], text_dims: Sequence[str] = (), id_col: str = "doc_id",
    text_col: str = "text", target_bytes: int | None = None, bins: int = 1024, slack: float = 0.0005,
) -> DataFrame:
    """Per document its id, size, text_crc32, shard and slot.

    size is the UTF-8 bytes of the text and eight more; null counts as empty. Without n_shards there
    are as many shards as bring each to about target_bytes. dims are numeric coordinates of the
    metadata; null comes before all numbers. text_dims are text columns, placed by the rank of the whole
    value; null counts as empty. slack is the share of a shard's bytes that a cut may
    miss; a bin of less is not narrowed. Documents that agree in a dimension are told apart by a
    hash of their metadata and, where rows are equal, their number, so a cut can go through ties and equal rows.
    Slots are gapless from 0 within a shard. An empty table gives an empty result; fewer documents
    than shards leave shards empty; other columns are not read.
    """
    if n_shards is None and target_bytes is None:
        raise ValueError("give n_shards or target_bytes")
    text = utf8(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), *[d.cast("double").alias(f"c{i}") for i, d in enumerate(dims)],
        *[utf8(c).alias(f"t{i}") for i, c in enumerate(text_dims)],
    )
    # Equal rows are one row with their number until all else is known.
    rows = stored(rows.groupBy(*rows.columns).agg(F.count("*").alias("n")), "shard-metadata")
    for i in range(len(text_dims)):
        rows = ranked(rows, f"t{i}", f"c{len(dims) + i}")
    if text_dims:
        rows = stored(rows, "shard-coordinates")
    count = range(len(dims) + len(text_dims))
    span = rows.agg(
        F.sum(F.col("size") * F.col("n")).alias("bytes"), *[F.min(f"c{i}").alias(f"l{i}") for i in count],
        *[F.max(f"c{i}").alias(f"h{i}") for i in count]).first()
    if span["bytes"] is None:
        return rows.select(
            F.col("id").alias(id_col), "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")).limit(0)
    tie = F.xxhash64("id", "size", "text_crc32", *[f"c{i}" for i in count], "number")
    keys = []
    for i in count:
        # Halves, as the range of very large numbers is no number.
        low, high = ((span[f"{end}{i}"] or 0.0) / 2 for end in "lh")
        place = (F.col(f"c{i}") / 2 - low) / (high - low) if high > low else F.lit(0.0)
        coarse = F.when(F.col(f"c{i}").isNull(), 0).otherwise(F.floor(place * (2**31 - 2)) + 1).cast("long")
        fine = F.pmod(F.xxhash64("tie", F.lit(i)), F.lit(2**SPREAD_BITS))
        keys.append(F.shiftleft(coarse, SPREAD_BITS) + fine)
    meta = one_by_one(rows).withColumn("tie", tie).select("id", "size", "text_crc32", "number", "tie", F.array(*keys).alias("ks"))
    shards = n_shards or max(1, math.ceil(span["bytes"] / target_bytes))
    tree = Tree(shards)
    while tree.open():
        split_level(meta, tree, len(count), bins, slack * span["bytes"] / shards)
    placed = meta.select("id", "size", "text_crc32", "number", "tie", tree.shard().alias("shard"))
    return with_slots(placed).select(F.col("id").alias(id_col), "size", "text_crc32", "shard", "slot")


def with_slots(placed: DataFrame) -> DataFrame:
    """Number the rows of every shard from 0.

    Rows are numbered within buckets of a shard, and each bucket starts where the one before ends,
    so no task holds a whole shard.
    """
    buckets = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.withColumn("bucket", F.pmod("tie", F.lit(buckets)))
    sizes = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket")
    starts = sizes.select("shard", "bucket", (F.sum("n").over(before) - F.col("n")).alias("start"))
    within = Window.partitionBy("shard", "bucket").orderBy("id", "text_crc32", "size", "number", "tie")
    numbered = dealt.withColumn("place", F.row_number().over(within) - 1)
    return numbered.join(starts, ["shard", "bucket"]).withColumn("slot", F.col("start") + F.col("place"))

"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame functions only.

The documents of a source are laid end to end in a shuffled order, once per pass over the source, and
cut into blocks of equally many words. A van der Corput point per slot falls into the interval of one
source, whose length is the source's share; the r-th slot of a source takes the source's r-th block.
Any stretch of slots therefore holds the sources close to their shares.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.common import stored

# Points and the sources' intervals are whole numbers below 2 ** POINT_BITS, so no rounding decides.
POINT_BITS = 40
# Rows that one window task may rank; larger keys are cut into parts of about so many.
PART_ROWS = 50_000
COPIES_A_TASK = 1000


@dataclass(frozen=True)
class Mix:
    """rows: a row per document. sources: their sizes, targets and words to take. schedule: a row per
    stretch of a document in a slot, and one with a null slot for a document that the mix leaves out."""

    rows: DataFrame
    sources: DataFrame
    schedule: DataFrame


def count_words(text: str) -> Column:
    """Runs of characters other than blanks; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def running(rows: DataFrame, keys: Sequence[str], part: str, order: Sequence[Column], value: Column) -> DataFrame:
    """rows with `before long`: the sum of value over the earlier rows of the keys, in the order of (part,
    order). Parts keep a key that holds most rows from being one task; their sums are few."""
    sums = rows.groupBy(*keys, part).agg(F.sum(value).alias("part_sum"))
    earlier = Window.unboundedPreceding, -1
    offset = F.sum("part_sum").over(Window.partitionBy(*keys).orderBy(part).rowsBetween(*earlier))
    offsets = sums.select(*keys, part, F.coalesce(offset, F.lit(0)).alias("offset"))
    inside = F.sum(value).over(Window.partitionBy(*keys, part).orderBy(*order).rowsBetween(*earlier))
    placed = rows.withColumn("inside", F.coalesce(inside, F.lit(0))).join(offsets, [*keys, part])
    return placed.withColumn("before", F.col("inside") + F.col("offset")).drop("inside", "offset")


def numbered(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """`id, source, size, key` per document. The key is a digest of id and text; equal rows get copy
    numbers, so keys differ, and which copy is which makes no difference."""
    text = F.col(text_col).cast("string")
    slim = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), text.alias("text")
    ).select("id", "source", count_words("text").alias("size"), F.md5(F.coalesce("text", F.lit(""))).alias("digest"))
    classes = slim.groupBy("source", "id", "size", "digest").agg(F.count("*").alias("copies"))
    # Many equal rows are dealt out again in portions.
    last = (F.col("copies") - 1).cast("long")
    portions = classes.withColumn("portion", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / COPIES_A_TASK))))
    portions = portions.repartition("id", "digest", "portion")
    first = F.col("portion") * COPIES_A_TASK
    copies = portions.withColumn("copy", F.explode(F.sequence(first, F.least(last, first + COPIES_A_TASK - 1))))
    key = F.md5(F.concat_ws(":", F.col("id").cast("string"), "digest", F.col("copy").cast("string")))
    return copies.select("id", "source", "size", key.alias("key"))


def weighed(rows: DataFrame, weights: Sequence[int], limit: int) -> DataFrame:
    """`source, source_no, weight, source_size, target, words, low, high` per source.

    Sources in code-point order, null last, take the weights in turn and share the size of all rows.
    A target stops at limit times its source's size, and the excess is shared again by weight until
    none is above. words is the target as a whole number, low and high are the source's interval.
    """
    totals = stored(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-totals")
    by_name = F.col("source").asc_nulls_last()
    parts = totals.count() // PART_ROWS + 1
    placed = stored(totals.repartitionByRange(parts, by_name).withColumn("part", F.spark_partition_id()), "mix-placed")
    ranked = running(placed, [], "part", [by_name], F.lit(1)).withColumnRenamed("before", "source_no")
    turn = F.get(F.array(*[F.lit(w) for w in weights]), (F.col("source_no") % len(weights)).cast("int"))
    ranked = stored(ranked.withColumn("weight", turn.cast("long")), "mix-ranked")
    most = F.col("source_size") * limit
    total, weight = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    fixed, fixed_weight = 0, 0
    while True:
        left, shared = F.lit(total - fixed), F.lit(float(max(weight - fixed_weight, 1)))
        share = (F.col("weight") * left).cast("double") / shared
        full = ranked.where(most < share).agg(
            F.coalesce(F.sum(most), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
        if tuple(full) == (fixed, fixed_weight):
            break
        fixed, fixed_weight = full
    target = F.when(most < share, most.cast("double")).otherwise(share)
    aimed = ranked.withColumn("target", target).withColumn("words", F.floor(target + 0.5).cast("long"))
    aimed = stored(running(aimed, [], "part", [F.col("source_no")], F.col("words")), "mix-targets")
    whole = float(max(aimed.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0], 1))
    cut = lambda c: F.floor(c.cast("double") / whole * 2.0**POINT_BITS).cast("long")
    before = F.col("before")
    return aimed.select(
        "source", "source_no", "weight", "source_size", "target", "words",
        cut(before).alias("low"), cut(before + F.col("words")).alias("high"))


def slots_of(sources: DataFrame, block: int) -> DataFrame:
    """`slot, source_no, rank`: the source of each slot, and the slot's number within its source."""
    words, n = sources.agg(F.coalesce(F.sum("words"), F.lit(0)), F.count("*")).first()
    cell_bits = min(POINT_BITS, max(10, (4 * n).bit_length()))
    shift = POINT_BITS - cell_bits
    bits = F.reverse(F.lpad(F.bin(F.col("id")), POINT_BITS, "0"))
    point = F.conv(bits, 2, 10).cast("long")
    points = sources.sparkSession.range(-(-words // block)).select(F.col("id").alias("slot"), point.alias("point"))
    points = points.withColumn("cell", F.shiftright("point", shift))
    # Each source lies in the cells that its interval meets, so points find it by an equal cell.
    cells = sources.where("high > low").select("source_no", "low", "high", F.explode(
        F.sequence(F.shiftright("low", shift), F.shiftright(F.col("high") - 1, shift))).alias("cell"))
    found = points.join(cells, "cell").where("point >= low AND point < high").select(
        "slot", "source_no", F.floor(F.col("slot") / PART_ROWS).alias("part"))
    return running(stored(found, "mix-slots"), ["source_no"], "part", [F.col("slot")], F.lit(1)).select(
        "slot", "source_no", F.col("before").alias("rank"))


def blocks_of(rows: DataFrame, sources: DataFrame, block: int) -> DataFrame:
    """A row per stretch of a document in a block of its source: `block`, `offset` in it, `epoch` (the
    pass over the source), `word_from` in the document and `n_words`; block is null where a document
    is not taken in the first pass."""
    known = rows.join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    passes = F.when(F.col("words") > 0, F.floor((F.col("words") - 1) / F.col("source_size"))).otherwise(F.lit(0))
    laid = known.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), passes.cast("long"))))
    laid = laid.withColumn("at", F.md5(F.concat_ws(":", F.col("epoch").cast("string"), "key")))
    digits, parts = 0, rows.count() // PART_ROWS
    while 16**digits < parts:
        digits += 1
    laid = laid.withColumn("part", F.substring("at", 1, digits))
    laid = running(laid, ["source_no", "epoch"], "part", [F.col("at")], F.col("size"))
    start = F.col("epoch") * F.col("source_size") + F.col("before")
    laid = laid.withColumn("start", start).withColumn("stop", F.least(F.col("start") + F.col("size"), F.col("words")))
    first, last = F.floor(F.col("start") / block), F.floor((F.col("stop") - 1) / block)
    cut = laid.withColumn("block", F.explode_outer(F.when(F.col("stop") > F.col("start"), F.sequence(first, last))))
    cut = cut.where("block IS NOT NULL OR epoch = 0")
    begin = F.greatest(F.col("start"), F.col("block") * block)
    end = F.least(F.col("stop"), (F.col("block") + 1) * block)
    held = lambda c: F.when(F.col("block").isNotNull(), c)
    return cut.select(
        "id", "key", "size", "source", "source_no", "source_size", "target", "epoch", "block",
        (begin - F.col("block") * block).alias("offset"), held(begin - F.col("start")).alias("word_from"),
        held(end - begin).alias("n_words"))


def mix(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), limit: int = 3, block: int = 2048,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> Mix:
    """The schedule that mixes all documents to their sources' weights, in slots of block words.

    A source's words are taken until its target is met, to the word; a document is taken at most limit
    times, each time in another order. The last block of a source may be short. Where the points
    give a source fewer slots than it has blocks, its last blocks come after all slots, in turns; slots
    beyond a source's blocks stay empty, so slot numbers have gaps.

    Null and empty texts have no words and are never taken; a null source is a source of its own, the
    last; null ids are kept. Equal rows are documents of their own. A source without words has the
    target 0. An empty table gives an empty mix. Other columns are not read, so their names can't
    clash. Equal input gives an equal mix, however it is partitioned. Holds up to 2 ** 40 slots; the
    weights are positive whole numbers.
    """
    rows = stored(numbered(docs, id_col, text_col, source_col), "mix-rows")
    sources = stored(weighed(rows, weights, limit), "mix-sources")
    n = sources.count()
    slots = slots_of(sources, block).withColumnRenamed("rank", "block")
    placed = blocks_of(rows, sources, block).join(slots, ["source_no", "block"], "left")
    words = sources.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    late = F.lit(-(-words // block)) + F.col("block") * n + F.col("source_no")
    return Mix(rows, sources, placed.withColumn("slot", F.coalesce("slot", late)).drop("block"))


def taken(mixed: Mix) -> DataFrame:
    """`id, size, source, source_size, target, taken, first_slot` per document: how many words the mix
    takes of it, repeats counted, and the first slot that holds some of it (else null)."""
    return mixed.schedule.groupBy("key", "source_no", "id", "size", "source", "source_size", "target").agg(
        F.coalesce(F.sum("n_words"), F.lit(0)).cast("long").alias("taken"), F.min("slot").alias("first_slot")
    ).drop("key", "source_no")

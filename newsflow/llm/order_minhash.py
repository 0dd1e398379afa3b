"""Near-duplicate documents by Order MinHash, verified by banded alignment.

Every k-mer of words carries its occurrence number in the text. For each of many hash functions the
few k-mers with the smallest values are kept in the order of the text; two documents agree in such a
tuple about as often as their edit similarity is high. Documents that share tuples with the smallest
document of a bucket are candidates, and a banded alignment of their words decides. The other documents
of a bucket are compared with each other where those links leave them in different groups; lengths and
counts of hashed words, which rule out no link, drop most of these pairs before the alignment.

Texts of few words have few k-mers, so they are found exactly: a text of so many blocks of words that the
allowed edits can't touch all of them has one whole in every text that is alike, so short texts share
buckets of all their runs of words of that length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from newsflow.llm.common import counted, few, released, stored, utf8
from newsflow.llm.components import components

EDGE = ".,;:!?\"'()[]{}*_-#$%&|<>"
CACHED_WORDS = 200_000
FAR = np.uint64(2**64 - 1)
# Hashed words are counted in so many bins of a byte each.
BINS = 256
# Texts of at most this many words are found by blocks as well.
SHORT_WORDS = 200
# A bucket's documents are compared with each other in blocks of about this many.
BLOCK_ROWS = 512
# Blocks that hold bags of words have at most about this many words in each half.
BLOCK_WORDS = 1_000_000
# So many pairs of units are looked at together.
PAIRS = 100_000
# A group in more buckets than this carries the first of them only.
GROUP_KEYS = 256
# Texts of so many characters in all are sent to the tasks that compare pairs.
FEW_CHARACTERS = 16_000_000
# A task takes about so many texts, pairs of texts, or rows with bins.
TASK_TEXTS = 1000
TASK_PAIRS = 500
TASK_BINS = 2000
# So many texts are sketched together.
SKETCHED_ROWS = 500


@dataclass(frozen=True)
class Sketch:
    """Words in a k-mer, k-mers in a tuple, and how many tuples a document has. Further tuples are made of
    shorter k-mers: they find texts with an edit in nearly every k-mer."""

    k: int = 5
    kept: int = 2
    tuples: int = 16
    seed: int = 1
    short_k: int = 3
    short_tuples: int = 48


def words_of(text: str) -> list[str]:
    """Lower-cased words without the punctuation around them; a word of nothing else stays."""
    return [w.strip(EDGE) or w for w in text.lower().split()]


SHIFTS = [np.uint64(n) for n in (30, 27, 31)]
FACTORS = [np.uint64(n) for n in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> SHIFTS[0])
    x *= FACTORS[0]
    x ^= x >> SHIFTS[1]
    x *= FACTORS[1]
    x ^= x >> SHIFTS[2]
    return x


class WordHashes(dict):
    """The hash of each word, without the punctuation around it, made when it is first asked for."""

    def __missing__(self, word: str) -> int:
        found = self[word] = xxhash.xxh3_64_intdigest(word.strip(EDGE) or word)
        return found


class Sketcher:
    """Sketches texts; hashes of words seen before are kept, up to a bounded number."""

    def __init__(self, spec: Sketch):
        self.spec = spec
        rng, tuples = np.random.default_rng(spec.seed), spec.tuples + spec.short_tuples
        self.factors = rng.integers(0, 2**63, tuples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.steps = rng.integers(0, 2**63, max(spec.k, spec.kept), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.salts = rng.integers(0, 2**63, tuples, dtype=np.uint64)
        self.known = WordHashes()
        self.lengths: dict[tuple[int, int], set[int]] = {}

    def word_hashes(self, text: str) -> np.ndarray:
        raw = text.lower().split()
        known = self.known
        if len(known) > CACHED_WORDS:
            known.clear()
        return np.fromiter(map(known.__getitem__, raw), np.uint64, len(raw))

    def labelled(self, words: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the k-mers with their occurrence numbers; a short text is one k-mer."""
        k = min(size, len(words))
        n = len(words) - k + 1
        grams = np.full(n, len(words) if k < size else 0, np.uint64)
        for j in range(k):
            grams = mixed(grams + words[j : j + n] * self.steps[j])
        ranked = np.sort(grams)
        repeats = ranked[1:] == ranked[:-1]
        if not repeats.any():
            return grams
        order = np.argsort(grams, kind="stable")
        index = np.arange(n)
        first = np.concatenate(([True], ~repeats))
        number = np.empty(n, np.uint64)
        number[order] = (index - np.maximum.accumulate(np.where(first, index, 0))).astype(np.uint64)
        return np.where(number > 0, mixed(grams + number * self.steps[0]), grams)

    def bins(self, words: np.ndarray) -> bytes:
        """How many words fall into each bin; full bins stay at 255."""
        counts = np.bincount((words >> np.uint64(32)).astype(np.int64) % BINS, minlength=BINS)
        return np.minimum(counts, 255).astype(np.uint8).tobytes()

    def bag(self, words: np.ndarray) -> bytes:
        """The words with their occurrence numbers, as hashes of 32 bits."""
        return (self.labelled(words, 1) >> np.uint64(32)).astype(np.uint32).tobytes() if len(words) else b""

    def runs(self, words: np.ndarray, percent: int) -> np.ndarray:
        """The buckets of a short text's runs of words. Occurrences have no numbers: edits change them."""
        keys = [np.empty(0, np.uint64)]
        if len(words) > SHORT_WORDS:
            return keys[0].view(np.int64)
        about = len(words), percent
        if about not in self.lengths:
            self.lengths[about] = run_lengths(*about)
        for size in self.lengths[about]:
            n = len(words) - size + 1
            grams = np.full(n, size, np.uint64) * self.factors[0]
            for j in range(size):
                grams = mixed(grams * self.steps[0] + words[j : j + n])
            keys.append(np.unique(grams))
        return np.concatenate(keys).view(np.int64)

    def keys(self, text: str) -> np.ndarray | None:
        """The bucket of each tuple; none for a text without words."""
        return self.keys_of(self.word_hashes(text))

    def keys_of(self, words: np.ndarray) -> np.ndarray | None:
        if not len(words):
            return None
        split = self.spec.tuples
        parts = [self.tuples_of(self.labelled(words, self.spec.k), slice(0, split))]
        if self.spec.short_tuples:
            parts.append(self.tuples_of(self.labelled(words, self.spec.short_k), slice(split, None)))
        return np.concatenate(parts)

    def tuples_of(self, labels: np.ndarray, chosen: slice) -> np.ndarray:
        factors, key = self.factors[chosen], self.salts[chosen].copy()
        kept = min(self.spec.kept, len(labels))
        rows = np.arange(len(factors))
        lowest, where = np.empty((0, len(factors)), np.uint64), np.empty((0, len(factors)), np.int64)
        # Long texts are taken in parts, so that the table of values stays small.
        for at in range(0, len(labels), 4096):
            values = labels[None, at : at + 4096] * factors[:, None]
            found, places = [], []
            for _ in range(min(kept, values.shape[1])):
                best = values.argmin(axis=1)
                found.append(values[rows, best])
                places.append(best + at)
                values[rows, best] = FAR
            found, places = np.concatenate((lowest, found)), np.concatenate((where, places))
            if len(found) > kept:
                order = np.argsort(found, axis=0, kind="stable")[:kept]
                found, places = np.take_along_axis(found, order, axis=0), np.take_along_axis(places, order, axis=0)
            lowest, where = found, places
        for j, place in enumerate(np.sort(where, axis=0)):
            key = mixed(key + labels[place] * self.steps[j])
        return key.view(np.int64)


def run_lengths(n: int, percent: int) -> set[int]:
    """The lengths of the blocks of short texts that may be alike to one of n words and no shorter."""
    out = set()
    for longest in range(n, SHORT_WORDS + 1):
        most = longest * (100 - percent) // 100
        if longest - most <= n and 0 < longest // (most + 1) <= n:
            out.add(longest // (most + 1))
    return out


def distance_within(a: list, b: list, most: int) -> int | None:
    """The edit distance of two sequences if it is at most `most`, over a band of that width.

    The columns of the band are bit vectors of differences that slide along the main diagonal.
    """
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return None
    if a == b:
        return 0
    if not b or not most:
        return len(a) if len(a) <= most else None
    most = min(most, len(a))
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    width = 2 * most + 1
    mask = (1 << width) - 1
    up = mask & ~((1 << (width - most - 1)) - 1)
    down = 0
    distance = most
    corner, side = 1 << (width - 1), 1 << (width - 2)
    start = most + 1 - width
    diagonal = max(0, len(a) - most)
    for i, x in enumerate(b):
        bits = places.get(x, 0)
        match = (bits >> start if start >= 0 else bits << -start) & mask
        zero = ((((match & up) + up) ^ up) | match | down) & mask
        plus = (down | ~(zero | up)) & mask
        minus = zero & up
        if i < diagonal:
            distance += not zero & corner
        else:
            distance += bool(plus & side)
            distance -= bool(minus & side)
            side >>= 1
        shifted = zero >> 1
        up = (minus | ~(shifted | plus)) & mask
        down = shifted & plus
        start += 1
        if distance > most + (len(b) - i - 1 if i >= diagonal else most):
            return None
    return distance if distance <= most else None


def alike(a: str, b: str, percent: int) -> bool:
    """Whether the edit similarity of two texts' words is at least percent / 100."""
    x, y = words_of(a), words_of(b)
    longest = max(len(x), len(y))
    most = longest * (100 - percent) // 100
    if not longest or abs(len(x) - len(y)) > most:
        return False
    if sum((Counter(x) & Counter(y)).values()) < longest - most:
        return False
    return distance_within(x, y, most) is not None


def sketched(rows: DataFrame, spec: Sketch, percent: int) -> DataFrame:
    """`digest, id, keys, n_words, bins` per row of `id, digest, text`."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = Sketcher(spec)
        for batch in (b.slice(at, SKETCHED_ROWS) for b in batches for at in range(0, b.num_rows, SKETCHED_ROWS)):
            words = [worker.word_hashes(t) for t in batch.column(2).to_pylist()]
            keys = [np.concatenate((worker.keys_of(w), worker.runs(w, percent))) if len(w) else None for w in words]
            yield pa.record_batch(
                [batch.column(1), batch.column(0), pa.array(keys, pa.list_(pa.int64())),
                 pa.array([len(w) for w in words], pa.int64()), pa.array([worker.bins(w) for w in words], pa.binary())],
                names=["digest", "id", "keys", "n_words", "bins"])

    return rows.mapInArrow(lambda batches: released(run(batches)), "digest binary, id long, keys array<long>, n_words long, bins binary")


def bucket_members(classes: DataFrame, n_keys: int) -> tuple[DataFrame, int]:
    """`key, id, n_words, b`: the documents of buckets of two or more, with the smallest id of the bucket; and how many
    rows these are. n_keys: the keys of all documents together.

    Buckets are written with their smallest id and joined back, so that both sides of the join come straight
    from a shuffle and a hot key is split. Most buckets have one document and end here.
    """
    dealt = classes.select("id", "n_words", F.explode("keys").alias("key"))
    heads = dealt.groupBy("key").agg(F.min("id").alias("b"), F.count("*").alias("n")).where("n > 1").select("key", "b")
    return counted(few(dealt.join(stored(few(heads, n_keys), "bucket-heads"), "key"), n_keys), "bucket-members")


def candidates(members: DataFrame, n_members: int, classes: DataFrame, least_shared: int, percent: int) -> DataFrame:
    """`a, b, n`: documents that share n buckets, at least least_shared, with b, the smallest one in them. members has n_members rows.

    A bucket gives one pair for each of its documents and not all pairs, so very common tuples stay linear.
    """
    pairs = few(members.where("id <> b").groupBy(F.col("id").alias("a"), "n_words", "b").agg(F.count("*").alias("n")), n_members)
    lengths = classes.select(F.col("id").alias("b"), F.col("n_words").alias("b_words"))
    longest = F.greatest("n_words", "b_words")
    fits = F.abs(F.col("n_words") - F.col("b_words")) <= F.floor(longest * (100 - percent) / 100)
    return few(pairs.where(F.col("n") >= least_shared).join(lengths, "b").where(fits).select("a", "b", "n"), n_members)


def first_choice(pairs: DataFrame) -> DataFrame:
    """Of each document's candidates the one with which it shares most buckets; of several the smallest id."""
    best = F.max(F.struct("n", (-F.col("b")).alias("b")))
    return pairs.groupBy("a").agg(best.alias("best")).select("a", (-F.col("best.b")).alias("b"))


def across(pairs: DataFrame, rows: int, reach: DataFrame) -> DataFrame:
    """`a, b` of the pairs, so many rows, whose ends are in different groups of reach."""
    for end in ("a", "b"):
        group = reach.select(F.col("id").alias(end), F.col("component").alias(f"group_{end}"))
        pairs = few(pairs.join(group, end, "left"), rows).withColumn(f"group_{end}", F.coalesce(f"group_{end}", end))
    return pairs.where("group_a <> group_b").select("a", "b")


class Bags:
    """The bags of words of a block, to count the words that two documents share."""

    def __init__(self, bags: list[bytes], width: int = 4):
        sizes = np.array([len(b) // width for b in bags], np.int64)
        self.ends = np.concatenate(([0], np.cumsum(sizes)))
        known, self.words = np.unique(np.frombuffer(b"".join(bags), f"u{width}"), return_inverse=True)
        self.marked = np.zeros(len(known), bool)

    def shared(self, x: int, others: np.ndarray) -> np.ndarray:
        """At least as many words as x has in common with each of the others: equal hashes only add to them."""
        own = self.words[self.ends[x] : self.ends[x + 1]]
        self.marked[own] = True
        found = [np.count_nonzero(self.marked[self.words[self.ends[y] : self.ends[y + 1]]]) for y in others]
        self.marked[own] = False
        return np.array(found, np.int64)


def earlier_keys(keys: pa.ChunkedArray, key: int) -> list[bytes]:
    """Of each unit's buckets those before this one, as bytes."""
    lists = (np.array(k or [], np.int64) for k in keys.to_pylist())
    return [k[k < key].tobytes() for k in lists]


def close_pairs(batch: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of two units of a block whose lengths and bins leave room to be alike, in order of the first."""
    key, cell, i, j, low, high, component, start, part, many, full = (
        batch.column(c).to_numpy(zero_copy_only=False)
        for c in ("key", "cell", "i", "j", "low", "high", "component", "start", "part", "many", "full"))
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, BINS)
    # A full bin counts as one that holds all words.
    room = np.where(many.astype(bool), full.astype(bool), bins.sum(axis=1, dtype=np.int64) < low)
    rows = np.arange(len(key))
    starts = block_starts(batch)
    ends = np.append(starts[1:], len(key))
    sizes = ends - starts
    # Units of a block of one part meet those behind them, those of the first of two parts all of the second.
    at = np.repeat(np.arange(len(starts)), sizes)
    ahead = np.add.reduceat((part == i).astype(np.int64), starts)
    begin = np.where(i == j, rows + 1, np.where(part == i, (starts + ahead)[at], ends[at]))
    total = np.concatenate(([0], np.cumsum(ends[at] - begin)))
    found_x, found_y, done = [], [], 0
    while done < len(rows):
        upto = max(int(np.searchsorted(total, total[done] + PAIRS, "right")) - 1, done + 1)
        x = np.repeat(rows[done:upto], np.diff(total[done : upto + 1]))
        y = np.arange(total[done], total[upto]) - total[x] + begin[x]
        done = upto
        # Units that meet in several cells are compared in the first where one of them begins.
        first_cell = np.maximum(start[y], start[x]) - (start[y] != start[x])
        longest = np.maximum(low[y], low[x])
        least = longest - longest * (100 - percent) // 100
        fits = (component[y] != component[x]) & (first_cell == cell[x]) & (np.minimum(high[y], high[x]) >= least)
        x, y, least = x[fits], y[fits], least[fits]
        close = room[y] | room[x]
        for k in range(0, len(x), 4096):
            shared = np.minimum(bins[y[k : k + 4096]], bins[x[k : k + 4096]]).sum(axis=1, dtype=np.uint16)
            close[k : k + 4096] |= shared >= least[k : k + 4096]
        found_x.append(x[close])
        found_y.append(y[close])
    return np.concatenate(found_x), np.concatenate(found_y)


def block_starts(batch: pa.Table) -> np.ndarray:
    """The places where a block begins."""
    ids = [batch.column(c).to_numpy() for c in ("key", "cell", "i", "j")]
    return np.flatnonzero(np.concatenate(([True], np.any([c[1:] != c[:-1] for c in ids], axis=0))))


def possible(batch: pa.Table, percent: int) -> pa.Table:
    """What the units of whole blocks, in different groups, leave to be alike: `a, b` of two documents, and `host,
    guest` of two groups, one of them with several documents here, which have to be looked at one by one.

    Rows are in order of `key, cell, i, j, part`.
    A unit is a document, or all documents of a group in a bucket, with the range of their lengths and the
    most words that any of its group has in each bin. With a column `bag`, pairs of documents must share enough words too.
    With a column `keys`, the buckets that hold a unit, two units are given in the first that they share only;
    where both are groups in more buckets than they carry, perhaps in further ones.
    """
    name, component, low, many, n = (
        batch.column(c).to_numpy(zero_copy_only=False) for c in ("name", "component", "low", "many", "n"))
    many = many.astype(bool)
    size = np.where(many, n, 0)
    all_x, all_y = close_pairs(batch, percent)
    starts = block_starts(batch)
    ends = np.append(starts[1:], batch.num_rows)
    # Pairs are in order of their blocks.
    cuts = np.searchsorted(all_x, np.append(starts, batch.num_rows))
    found_a, found_b, spread = [], [], set()
    for k in np.flatnonzero(np.diff(cuts)):
        begin, block = starts[k], batch.slice(starts[k], ends[k] - starts[k])
        bags = Bags(block.column("bag").to_pylist()) if "bag" in batch.column_names else None
        places = None
        if "keys" in batch.column_names:
            places = Bags(earlier_keys(block.column("keys"), block.column("key")[0].as_py()), 8)
        pairs_x, pairs_y = all_x[cuts[k] : cuts[k + 1]], all_y[cuts[k] : cuts[k + 1]]
        turns = np.append(np.flatnonzero(np.diff(pairs_x, prepend=-1)), len(pairs_x))
        for u, v in zip(turns[:-1], turns[1:]):
            x, y = pairs_x[u], pairs_y[u:v]
            if places is not None:
                y = y[places.shared(x - begin, y - begin) == 0]
            if bags is not None:
                longest = np.maximum(low[y], low[x])
                y = y[bags.shared(x - begin, y - begin) >= longest - longest * (100 - percent) // 100]
            single = y[~many[y]] if not many[x] else y[:0]
            found_a.append(np.maximum(name[single], name[x]))
            found_b.append(np.minimum(name[single], name[x]))
            open_ = y[many[y] | many[x]]
            larger = (size[open_] > size[x]) | ((size[open_] == size[x]) & (component[open_] < component[x]))
            spread.update(zip(np.where(larger, component[open_], component[x]).tolist(), np.where(larger, component[x], component[open_]).tolist()))
    none = [np.empty(0, np.int64)]
    a, b, groups = np.concatenate(found_a or none), np.concatenate(found_b or none), sorted(spread)
    blank = lambda n: [None] * n
    return pa.table({
        "a": pa.array([*a.tolist(), *blank(len(groups))], pa.int64()), "b": pa.array([*b.tolist(), *blank(len(groups))], pa.int64()),
        "host": pa.array([*blank(len(a)), *[g for g, _ in groups]], pa.int64()),
        "guest": pa.array([*blank(len(a)), *[g for _, g in groups]], pa.int64())})


def possible_in_order(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """``possible`` of the blocks of a task, which follow each other; one may go on in the next batch."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        whole = int(block_starts(held)[-1]) if held.num_rows else 0
        if whole:
            yield from possible(held.slice(0, whole), percent).to_batches()
            held = held.slice(whole)
    if held is not None and held.num_rows:
        yield from possible(held, percent).to_batches()


def compared(units: DataFrame, shapes: DataFrame, percent: int) -> tuple[DataFrame, int]:
    """What ``possible`` finds in all blocks of units, and how many rows this has. units: `key, component, name, many, n, low, high`; shapes:
    `name, many, bins, full`, `bag` where all units are documents, and `keys` where units are in several buckets.

    Units of a bucket meet those of their own and the next class of length, in blocks, so a bucket of
    very many is dealt over many tasks.
    """
    bucket = lambda c: F.floor(F.log(101 / max(percent, 1), F.greatest(c, F.lit(1)))).cast("long")
    placed = units.withColumns({"from": bucket(F.col("low")), "to": bucket(F.col("high"))})
    placed = placed.withColumn("cell", F.explode(F.sequence(F.col("from") - 1, F.col("to"))))
    placed = placed.withColumn("own", F.col("cell") >= F.col("from")).withColumnRenamed("from", "start").drop("to")
    placed, rows = counted(placed, "bucket-cells")
    words = F.sum("high") / BLOCK_WORDS if "bag" in shapes.columns else F.lit(0.0)
    cells = placed.groupBy("key", "cell").agg(F.count("*").alias("size"), F.max("own").alias("any"), words.alias("words"))
    parts = F.ceil(F.greatest(F.col("size") / BLOCK_ROWS, "words")).alias("parts")
    cells = stored(few(cells.where("any AND size > 1").select("key", "cell", parts), rows), "cells")
    dealt = placed.join(cells, ["key", "cell"]).withColumn("part", F.pmod(F.xxhash64("name"), "parts"))
    dealt = stored(few(dealt, rows), "bucket-blocks").join(shapes, ["name", "many"])
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    blocks = dealt.withColumns({"i": F.least("part", "with"), "j": F.greatest("part", "with")}).drop("parts", "with")
    # Most blocks are small, so a task takes them as they follow each other and not one by one.
    block = ["key", "cell", "i", "j"]
    found = blocks.repartition(*block).sortWithinPartitions(*block, "part").mapInArrow(
        lambda batches: released(possible_in_order(batches, percent)), "a long, b long, host long, guest long")
    return counted(found.distinct(), "possible")


def profiles(documents: DataFrame) -> DataFrame:
    """`name, bins, full` per component of `component, n_words, bins`: the most that any of its documents has in each
    bin, and whether one has a full bin. Tasks add up first, so a component of very many is no single task."""
    def top(batch: pa.Table | pa.RecordBatch) -> pa.RecordBatch:
        bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, BINS)
        names, at = np.unique(batch.column("name").to_numpy(), return_inverse=True)
        most, full = np.zeros((len(names), BINS), np.uint8), np.zeros(len(names), bool)
        np.maximum.at(most, at, bins)
        np.logical_or.at(full, at, batch.column("full").to_numpy(zero_copy_only=False).astype(bool))
        return pa.record_batch(
            [pa.array(names, pa.int64()), pa.array([m.tobytes() for m in most], pa.binary()), pa.array(full)],
            names=["name", "bins", "full"])

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, BINS)
            full = bins.sum(axis=1, dtype=np.int64) < batch.column("n_words").to_numpy()
            held.append(top(pa.record_batch([batch.column("component"), batch.column("bins"), pa.array(full)], names=["name", "bins", "full"])))
            if sum(h.num_rows for h in held) > CACHED_WORDS // 10:
                yield top(pa.Table.from_batches(held))
                held = []
        if held:
            yield top(pa.Table.from_batches(held))

    schema = "name long, bins binary, full boolean"
    parts = documents.select("component", "n_words", "bins").mapInArrow(partial, schema)
    return parts.groupBy("name").applyInArrow(lambda t: pa.Table.from_batches([top(t)]), schema)


def bags(texts: DataFrame, spec: Sketch) -> DataFrame:
    """`name, bag` of `id, text`."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = Sketcher(spec)
        for batch in batches:
            found = [worker.bag(worker.word_hashes(t)) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.binary())], names=["name", "bag"])

    return texts.mapInArrow(lambda batches: released(run(batches)), "name long, bag binary")


def others(
    classes: DataFrame, n_classes: int, bucketed: DataFrame, n_bucketed: int, reach: DataFrame,
    texts_of: Callable[[DataFrame, int], DataFrame], spec: Sketch, percent: int,
) -> tuple[DataFrame, int]:
    """`a, b`, and the most rows of it: documents that share a bucket, are in different groups of reach, neither the bucket's smallest.

    bucketed is what ``bucket_members`` gives, texts_of gives `id, text` of at most so many ids. Only pairs whose lengths and bins allow the similarity are given. All
    documents of a group in a bucket are first taken as one unit; they are looked at one by one only where the
    unit leaves room.
    """
    grouped = few(bucketed.select("key", "id", "n_words").join(reach, "id", "left"), n_bucketed)
    dealt = grouped.select("key", "id", "n_words", F.coalesce("component", "id").alias("component"))
    # Buckets with one group need nothing; those of the same documents, such as all of a shared passage, are one.
    mixed_keys = dealt.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.min("id").alias("b"), F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("id")).alias("mark"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("other"))
    mixed_keys = few(mixed_keys.where("low < high AND n > 2"), n_bucketed).groupBy("n", "b", "mark", "other").agg(F.min("key").alias("key"))
    mixed_keys = stored(few(mixed_keys.select("key", "b"), n_bucketed), "mixed-buckets")
    members = few(dealt.join(mixed_keys, "key").where("id <> b"), n_bucketed)
    units = members.groupBy("key", "component").agg(
        F.count("*").alias("n"), F.min("id").alias("id"), F.min("n_words").alias("low"), F.max("n_words").alias("high"))
    many = F.col("n") > 1
    units, n_units = counted(few(units.select(
        "key", "component", "n", "low", "high", many.alias("many"),
        F.when(many, F.col("component")).otherwise(F.col("id")).alias("name")), n_bucketed), "bucket-units")
    # Two units that are alike share many buckets and are given once. So what is asked of a group may not depend
    # on the bucket: its lengths are those of all buckets where it has several documents.
    places = units.groupBy("name", "many").agg(
        F.array_sort(F.collect_list("key")).alias("keys"), F.min("low").alias("low"), F.max("high").alias("high"))
    places = places.withColumn("keys", F.when(F.col("many"), F.slice("keys", 1, GROUP_KEYS)).otherwise(F.col("keys")))
    places = stored(few(places, n_units), "unit-places")
    units = stored(few(units.drop("low", "high").join(places.drop("keys"), ["name", "many"]), n_units), "mixed-units")
    own = classes.select(F.col("id").alias("name"), F.lit(False).alias("many"), "bins", F.lit(False).alias("full"))
    large = stored(few(units.where("many").select("component").distinct(), n_units), "large-groups")
    of_large = few(reach.join(large, "component"), n_classes).join(classes.select("id", "n_words", "bins"), "id")
    wide = profiles(few(of_large, n_classes, TASK_BINS)).select("name", F.lit(True).alias("many"), "bins", "full")
    shapes = own.union(wide).join(places.select("name", "many", "keys"), ["name", "many"])
    found, n_found = compared(units, stored(few(shapes, n_units, TASK_BINS), "unit-shapes"), percent)
    pairs = found.where("host IS NULL").select("a", "b")
    # A group's documents are listed once, beside those of all groups that may be alike to it.
    meetings = stored(few(found.where("host IS NOT NULL").select("host", "guest").distinct(), n_found), "meetings")
    documents = classes.select("id", "n_words").join(reach, "id", "left").select(
        F.coalesce("component", "id").alias("component"), F.col("id").alias("name"), F.col("n_words").alias("low"))
    documents = stored(few(documents, n_classes), "group-documents")
    listed = meetings.select("host", F.col("host").alias("component"), F.lit(0).cast("long").alias("side")).distinct().union(
        meetings.select("host", "guest", F.lit(1).cast("long")))
    listed = stored(few(listed, 2 * n_found), "listed").join(documents, "component")
    listed, n_listed = counted(listed, "listed-documents")
    held = bags(texts_of(listed.select(F.col("name").alias("id")).distinct(), n_listed), spec)
    listed = listed.select(
        F.col("host").alias("key"), F.col("side").alias("component"), "name", F.lit(False).alias("many"), F.lit(1).alias("n"),
        "low", F.col("low").alias("high"))
    one_by_one, n_pairs = compared(listed, own.join(held, "name"), percent)
    return pairs.union(one_by_one.select("a", "b")).distinct(), n_found + n_pairs


def verified(pairs: DataFrame, texts: DataFrame, percent: int, rows: int | None = None) -> DataFrame:
    """The pairs, so many rows, whose texts are alike. texts: `id, text`, for all ids of the pairs. Both are written tables."""
    rows = pairs.count() if rows is None else rows
    if (texts.agg(F.sum(F.length("text"))).first()[0] or 0) <= FEW_CHARACTERS:
        # Few texts may have very many pairs, so these are dealt by number and not by the bytes they hold.
        texts, cores = F.broadcast(texts), pairs.sparkSession.sparkContext.defaultParallelism
        pairs = pairs.repartition(max(1, min(rows // 500, max(2 * cores, rows // 20_000))), "a", "b")
    left = few(pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("x")), "a"), rows, TASK_PAIRS)
    both = left.join(texts.select(F.col("id").alias("b"), F.col("text").alias("y")), "b").select("a", "b", "x", "y")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [alike(x, y, percent) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(good, pa.bool_()))

    return few(both, rows, TASK_PAIRS).mapInArrow(lambda batches: released(run(batches)), "u long, v long")


def near_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spec: Sketch = Sketch(), percent: int = 80,
    least_shared: int = 1,
) -> DataFrame:
    """Per document: id, `group_id long` (the smallest id of its near-duplicates) and `kept boolean`.

    Equal texts are always one group and are compared once. Others link if they share least_shared
    tuples with a bucket's smallest document, or any tuple with each other, and the edit similarity of
    their words, one minus the distance by the longer length, is at least percent; groups are the
    connected documents. Words are
    lower-cased and lose the punctuation around them. Null texts are empty ones; texts without words
    link only with equal texts. With one tuple as the least, no link of two texts of at most SHORT_WORDS
    words is missed; links of longer ones are found with the chance that a tuple agrees. Rows without an id
    are kept and in no group; rows that repeat an id are one document, so all of them are kept or
    none. Only ids and results are returned; an empty table gives an empty result.
    """
    text = utf8(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))
    classes = sketched(rows.where("id IS NOT NULL"), spec, percent)
    classes = classes.groupBy("digest").agg(
        F.min("id").alias("id"), *[F.first(c).alias(c) for c in ("keys", "n_words", "bins")])
    seen = Observation()
    sizes = [F.count(F.lit(1)).alias("rows"), F.sum(F.size("keys")).alias("keys")]
    classes = stored(classes.observe(seen, *sizes), "sketches")
    n_classes, n_keys = seen.get["rows"], seen.get["keys"] or 0

    def texts_of(ids: DataFrame, most: int) -> DataFrame:
        wanted = few(classes.select("id", "digest").join(few(ids, most), "id"), n_classes)
        texts = rows.join(wanted, ["id", "digest"]).dropDuplicates(["id", "digest"])
        return stored(few(texts.select("id", "text"), min(most, n_classes), TASK_TEXTS), "candidate-texts")

    def linked(pairs: DataFrame, most: int) -> tuple[DataFrame, int]:
        pairs, n = counted(few(pairs, most), "candidates")
        wanted = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
        return counted(verified(pairs, texts_of(wanted, 2 * n), percent, n), "near-links")

    # A large group is joined by one link for each of its documents; only what these leave apart is compared further.
    members, n_members = bucket_members(classes, n_keys)
    pairs, n_pairs = counted(candidates(members, n_members, classes, least_shared, percent), "bucket-pairs")
    links, n_links = linked(first_choice(pairs), n_pairs)
    more, n_more = linked(across(pairs, n_pairs, components(links, n_links)), n_pairs)
    links, n_links = links.union(more), n_links + n_more
    rest = others(classes, n_classes, members, n_members, components(links, n_links), texts_of, spec, percent)
    more, n_more = linked(*rest)
    links, n_links = links.union(more), n_links + n_more
    # Rows that repeat an id belong together, whatever their texts.
    own = rows.where("id IS NOT NULL").select("id", "digest")
    named = own.join(classes.select("digest", F.col("id").alias("class")), "digest").select("id", "class")
    named = stored(named.groupBy("id").agg(F.min("class").alias("class"), F.max("class").alias("other"), F.count("*").alias("n")), "named")
    same = named.where("class <> other").select(F.col("class").alias("u"), F.col("other").alias("v"))
    reach = components(links.union(same), n_links + n_classes)
    grouped = named.join(reach.withColumnRenamed("id", "class"), "class", "left")
    grouped = grouped.select("id", F.coalesce("component", "class").alias("group_id"), "n")
    out = grouped.select("id", "group_id", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).drop("col")
    lone = rows.where("id IS NULL").select("id", F.lit(None).cast("long").alias("group_id"))
    return out.union(lone).select(
        F.col("id").alias(id_col), "group_id", F.col("id").eqNullSafe(F.col("group_id")).alias("kept"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", **options: object) -> DataFrame:
    """The rows of docs, with all their columns, that near_documents keeps."""
    kept = near_documents(docs, id_col, **options).where("kept").select(F.col(id_col).alias("__id")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(kept["__id"]), "left_semi")

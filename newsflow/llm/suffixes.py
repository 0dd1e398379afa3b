"""Removal of byte strings that repeat anywhere, by a hash-compared sort of sampled suffixes.

Every window of `length` bytes elects one anchor in it: its gram with the smallest polynomial hash,
the leftmost of equals. Equal windows elect the same place, so it is enough to sort the suffixes at
the anchors, and only among anchors of equal grams. A context is the text that an anchor's windows
cover. Contexts that occur twice are removed whole. The others are sorted in both directions from
the anchor by a mergesort whose comparisons find the common extension by binary search over prefix
hashes; the order is then verified on the bytes, and its extensions give the repeated windows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import freed, stored, utf8

BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
GRAM = 32
# Places within a part fit into this many bits beside the hash.
PLACE_BITS = 20
PART = (1 << PLACE_BITS) - 4096


@lru_cache(maxsize=1)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2 ** 64."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        steps = np.full(n + 1, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps))
    return out[0], out[1]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """H with H[j] - H[i] the hash of data[i:j], times the base to the power i."""
    power, _ = powers(PART + 4096)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=out[1:])
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    done = 1
    out = values
    while 2 * done <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    if done < width:
        out = np.minimum(out[: len(values) - width + 1], out[width - done : len(values) - done + 1])
    return out


def anchors(data: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per part of a text: the anchors' gram hashes and places, and the first and last window of each."""
    for at in range(0, len(data) - length + 1, PART):
        part = data[at : at + PART + length - 1]
        hashes = prefix_hashes(part)
        n = len(part) - GRAM + 1
        grams = mixed((hashes[GRAM:] - hashes[:-GRAM]) * powers(PART + 4096)[1][:n])
        place = np.uint64((1 << PLACE_BITS) - 1)
        best = sliding_min(grams & ~place | np.arange(n, dtype=np.uint64), length - GRAM + 1)
        chosen = (best & place).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
        last = np.concatenate((first[1:], [len(chosen)])) - 1
        spot = chosen[first]
        yield grams[spot].view(np.int64), spot + at, first + at, last + at


PLACES = "doc long, g long, c1 long, c2 long, place long, first int, last int"


def found_anchors(docs: DataFrame, length: int) -> DataFrame:
    """PLACES for every anchor: its gram hash, a digest of its context, and where its windows begin."""
    fields = [("doc", pa.int64()), ("g", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()),
              ("place", pa.int64()), ("first", pa.int32()), ("last", pa.int32())]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list[np.ndarray]] = [[] for _ in fields]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = text.encode()
                if len(raw) < length:
                    continue
                view = memoryview(raw)
                for g, place, first, last in anchors(np.frombuffer(raw, np.uint8), length):
                    digests = b"".join(
                        xxhash.xxh3_128_digest(view[a : b + length], seed=p - a)
                        for a, b, p in zip(first.tolist(), last.tolist(), place.tolist()))
                    c = np.frombuffer(digests, np.int64).reshape(-1, 2)
                    for held, new in zip(columns, (np.full(len(g), doc), g, c[:, 0], c[:, 1], place, first, last)):
                        held.append(new)
            if columns[0]:
                yield pa.record_batch(
                    [pa.array(np.concatenate(held), kind) for held, (_, kind) in zip(columns, fields)],
                    names=[n for n, _ in fields])

    return docs.mapInArrow(run, PLACES)


def merge_sort(items: list[int], compare: Callable[[int, int], int]) -> list[int]:
    """Bottom-up mergesort with as few comparisons as halving allows."""
    runs = [[x] for x in items]
    while len(runs) > 1:
        merged = []
        for left, right in zip(runs[::2], runs[1::2]):
            out, i, j = [], 0, 0
            while i < len(left) and j < len(right):
                if compare(left[i], right[j]) <= 0:
                    out.append(left[i])
                    i += 1
                else:
                    out.append(right[j])
                    j += 1
            merged.append(out + left[i:] + right[j:])
        if len(runs) % 2:
            merged.append(runs[-1])
        runs = merged
    return runs[0] if runs else []


class Sorted:
    """Strings in order, with the common extension of each with the next one.

    Comparisons read prefix hashes only. A wrong order or extension could come from equal hashes of
    different strings alone; every neighbouring pair is therefore compared by its bytes, and if one
    fails the strings are sorted by their bytes.
    """

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.hashes = [self.prefixes(s) for s in strings]
        self.order = merge_sort(list(range(len(strings))), self.compare)
        self.common = [self.extension(a, b) for a, b in zip(self.order, self.order[1:])]
        if not all(map(self.verified, self.order, self.order[1:], self.common)):
            self.order = sorted(range(len(strings)), key=strings.__getitem__)
            self.common = [common_bytes(strings[a], strings[b]) for a, b in zip(self.order, self.order[1:])]
        del self.hashes

    @staticmethod
    def prefixes(string: bytes) -> list[int]:
        return prefix_hashes(np.frombuffer(string, np.uint8)).tolist()

    def extension(self, a: int, b: int) -> int:
        """The longest prefix with equal hashes; equal prefixes stay equal when cut, so it is searched."""
        x, y = self.hashes[a], self.hashes[b]
        low, high = 0, min(len(x), len(y)) - 1
        while low < high:
            middle = (low + high + 1) // 2
            if x[middle] == y[middle]:
                low = middle
            else:
                high = middle - 1
        return low

    def compare(self, a: int, b: int) -> int:
        at = self.extension(a, b)
        x, y = self.strings[a], self.strings[b]
        if at < len(x) and at < len(y):
            return x[at] - y[at]
        return len(x) - len(y)

    def verified(self, a: int, b: int, common: int) -> bool:
        x, y = self.strings[a], self.strings[b]
        return x[:common] == y[:common] and x[common : common + 1] != y[common : common + 1] or x == y and common == len(x)


def common_bytes(x: bytes, y: bytes) -> int:
    n = min(len(x), len(y))
    differ = np.flatnonzero(np.frombuffer(x[:n], np.uint8) != np.frombuffer(y[:n], np.uint8))
    return int(differ[0]) if len(differ) else n


def repeated_windows(contexts: list[bytes], place: list[int], length: int) -> list[list[tuple[int, int]]]:
    """Per context of one gram: runs (first, last) of window starts whose window another context has.

    place is where the anchor lies in the context. Contexts that share l bytes to the left and r bytes
    from the anchor on share the windows that begin l' <= l bytes before it with length - l' <= r. Sorted by
    the reversed left sides, the contexts that share at least l bytes lie together; in every such node
    of the tree of common extensions, the neighbours in the order of the right sides have the largest r.
    """
    m = len(contexts)
    found: list[list[tuple[int, int]]] = [[] for _ in range(m)]
    right = Sorted([c[p:] for c, p in zip(contexts, place)])
    rank = {x: i for i, x in enumerate(right.order)}

    def note(x: int, left: int, r: int) -> None:
        first, last = place[x] - left, min(place[x], place[x] - (length - r))
        first = max(0, first)
        if first <= last:
            found[x].append((first, last))

    def visit(members: list[int], left: int) -> None:
        """members: ranks in order, of contexts that share `left` bytes before the anchor."""
        for i, j in zip(members, members[1:]):
            r = min(right.common[i:j])
            if left + r >= length:
                for k in (i, j):
                    note(right.order[k], left, r)

    left = Sorted([c[:p][::-1] for c, p in zip(contexts, place)])
    # The nodes of the tree, from the longest extensions up; each holds the ranks of its contexts.
    stack: list[tuple[int, list[int]]] = []
    for k, x in enumerate(left.order):
        members = [rank[x]]
        depth = left.common[k] if k < m - 1 else 0
        while stack and stack[-1][0] > depth:
            level, held = stack.pop()
            members = sorted(held + members)
            visit(members, level)
        if stack and stack[-1][0] == depth:
            stack[-1][1].extend(members)
        elif k < m - 1:
            stack.append((depth, members))
        else:
            stack.append((0, members))
    while stack:
        level, held = stack.pop()
        visit(sorted(held), level)
        if stack:
            stack[-1][1].extend(held)
    return [joined(runs) for runs in found]


def joined(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


SPANS = "doc long, first long, last long"


def span_table(rows: list[tuple[int, int, int]]) -> pa.Table:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("doc", "first", "last"), columns)})


def resolve(bucket: pa.Table, length: int) -> pa.Table:
    """Spans (bytes) of the repeated windows of single contexts, for all grams of a bucket."""
    groups: dict[int, list[int]] = {}
    for i, g in enumerate(bucket.column("g").to_pylist()):
        groups.setdefault(g, []).append(i)
    context, n = bucket.column("context").to_pylist(), bucket.column("n").to_pylist()
    doc, place, first = (bucket.column(c).to_pylist() for c in ("doc", "place", "first"))
    out = []
    for rows in groups.values():
        if len(rows) < 2:
            continue
        runs = repeated_windows([context[i] for i in rows], [place[i] - first[i] for i in rows], length)
        for i, found in zip(rows, runs):
            if n[i] == 1:
                out.extend((doc[i], first[i] + a, first[i] + b + length) for a, b in found)
    return span_table(out)


def contexts(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The wanted anchors with the bytes of their contexts; windows of hot grams as digests instead."""
    spots = wanted.groupBy("doc").agg(F.collect_list(F.struct("g", "n", "place", "first", "last", "hot")).alias("spots"))
    joined_rows = texts.join(spots, "doc").select("doc", "text", "spots")
    names = ["doc", "g", "n", "place", "first", "context", "h1", "h2"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 5 + [pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        for batch in batches:
            out: list[tuple] = []
            for doc, text, spots in zip(*(c.to_pylist() for c in batch.columns)):
                raw = text.encode()
                for s in spots:
                    own = raw[s["first"] : s["last"] + length]
                    if s["hot"]:
                        sums = np.frombuffer(b"".join(
                            xxhash.xxh3_128_digest(own[i : i + length]) for i in range(len(own) - length + 1)), np.int64)
                        out.append((doc, s["g"], s["n"], s["place"], s["first"], None, sums[::2], sums[1::2]))
                    else:
                        out.append((doc, s["g"], s["n"], s["place"], s["first"], own, None, None))
            for at in range(0, len(out), 2000):
                columns = zip(*out[at : at + 2000])
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    schema = "doc long, g long, n long, place long, first long, context binary, h1 array<long>, h2 array<long>"
    return joined_rows.mapInArrow(run, schema)


def hot_spans(rows: DataFrame, length: int) -> DataFrame:
    """For grams with very many contexts: the windows that occur twice, counted by their digests.

    Counts are partial aggregates and are joined back, so no task holds a gram.
    """
    windows = rows.select("doc", "n", "first", F.posexplode(F.arrays_zip("h1", "h2")).alias("at", "h"))
    windows = windows.select("doc", "n", (F.col("first") + F.col("at")).alias("first"), "h.h1", "h.h2")
    counts = windows.groupBy("h1", "h2").agg(F.sum("n").alias("times")).where("times > 1")
    hit = windows.where("n = 1").join(counts, ["h1", "h2"], "left_semi")
    return hit.select("doc", "first", (F.col("first") + length).alias("last"))


def repeated_spans(
    texts: DataFrame, length: int, hot_contexts: int = 8192, bucket_contexts: int = 20_000,
) -> DataFrame:
    """`doc, first, last`: byte spans, which may overlap, that cover all repeated windows.

    texts: `doc long, text string`, doc unique. Grams that occur once are dropped after a count.
    Contexts of more than hot_contexts per gram are not brought together; their windows are counted
    instead, with the same result. Others meet in buckets of about bucket_contexts.
    """
    found = found_anchors(texts, length)
    # Written, so that both sides of the join come straight from a shuffle and a hot gram is split.
    twice = stored(found.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g"), "grams")
    shared = stored(found.join(twice, "g", "left_semi"), "anchors")
    freed(texts)
    kinds = ["g", "c1", "c2"]
    classes = shared.groupBy(*kinds).agg(
        F.count("*").alias("n"), F.min(F.struct("doc", "place", "first", "last")).alias("spot"))
    classes = stored(classes.select(*kinds, "n", "spot.*"), "context-classes")
    whole = shared.join(classes.where("n > 1").select(*kinds), kinds, "left_semi")
    whole = stored(whole.select("doc", F.col("first").cast("long"), (F.col("last") + length).cast("long").alias("last")), "spans")
    freed(texts)
    several = classes.groupBy("g").agg(
        F.count("*").alias("classes"), F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("single"))
    several = several.where("classes > 1 AND single > 0").select("g", (F.col("classes") > hot_contexts).alias("hot"))
    wanted = classes.join(several, "g").select("g", "n", "doc", "place", "first", "last", "hot")
    open_rows = stored(contexts(texts, wanted, length), "contexts")
    freed(texts)
    buckets = max(1, open_rows.count() // bucket_contexts)
    cold = open_rows.where("context IS NOT NULL").select(
        "g", "n", "doc", "place", "first", "context", F.pmod(F.xxhash64("g"), F.lit(buckets)).alias("bucket"))
    single = cold.groupBy("bucket").applyInArrow(lambda t: resolve(t, length), SPANS)
    hot = hot_spans(open_rows.where("context IS NULL"), length)
    return whole.union(single).union(hot)


def without_repeats(
    docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", hot_contexts: int = 8192,
    bucket_contexts: int = 20_000, as_text: bool = False,
) -> DataFrame:
    """The rows of docs with `n_bytes`, `n_removed`, `n_spans` (long) and `kept binary`.

    Every byte that a string of `length` bytes covers which also begins anywhere else, in the same text
    or another, is removed; overlaps count, and all is judged on the input. Texts are taken as UTF-8,
    null as empty; matches never cross texts. kept may begin or end within a character; with as_text it
    is a string without the bytes of such cut characters. Ids that are null or
    repeat are allowed: such rows are numbered first, and rows equal in all columns repeat each other.
    Columns of docs with the names of the result are replaced. An empty table gives an empty result.
    """
    made = ["n_bytes", "n_removed", "n_spans", "kept"]
    names = [f"`{c.replace('`', '``')}`" for c in docs.columns if c not in made]
    key = F.col(id_col)
    ids = docs.select(key.alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    odd = dict(docs.schema[id_col].jsonValue())["type"] not in ("long", "integer", "short", "byte")
    if odd or ids.where("id IS NULL OR n > 1").limit(1).count():
        docs = stored(docs.withColumn("__doc", F.monotonically_increasing_id()), "numbered")
    else:
        docs = docs.withColumn("__doc", key.cast("long"))
    rows = docs.select(F.col("__doc").alias("doc"), utf8(text_col).alias("text"))
    spans = stored(repeated_spans(rows, length, hot_contexts, bucket_contexts), "all-spans")
    freed(docs)
    per_doc = spans.groupBy("doc").agg(F.collect_list(F.struct("first", "last")).alias("__spans"))
    joined_rows = docs.join(per_doc.withColumnRenamed("doc", "__doc"), "__doc", "left")
    rest = joined_rows.select(*names, utf8(text_col).alias("__text"), "__spans")
    fields = [f for f in rest.schema.fields if f.name not in ("__text", "__spans")]
    at = len(fields)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [removed(t.encode(), s) for t, s in zip(batch.column(at).to_pylist(), batch.column(at + 1).to_pylist())]
            if as_text:
                out = [(*counts, rest.decode("utf-8", "ignore")) for *counts, rest in out]
            kinds = [pa.int64()] * 3 + [pa.string() if as_text else pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
            yield pa.record_batch([*batch.columns[:at], *columns], names=[*(f.name for f in fields), *made])

    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fields)
    return rest.mapInArrow(cut, f"{schema}, n_bytes long, n_removed long, n_spans long, kept {'string' if as_text else 'binary'}")


def removed(raw: bytes, spans: list[dict] | None) -> tuple[int, int, int, bytes]:
    """Length, bytes removed, maximal removed runs, and the rest."""
    runs = joined([(s["first"], s["last"] - 1) for s in spans or []])
    at, parts = 0, []
    for first, last in runs:
        parts.append(raw[at:first])
        at = last + 1
    parts.append(raw[at:])
    return len(raw), sum(b - a + 1 for a, b in runs), len(runs), b"".join(parts)

"""Packing tokenized documents into sequences by large-item matching and best fit.

Pieces longer than a third of the capacity go at most two to a sequence and are matched greedily,
the longest with the longest that fits. Shorter ones then go, longest first, into the smallest gap
that takes them. Only the lengths matter, and there are at most `capacity` of them: the plan is made
on the counts per length and kept as runs, and every piece finds its place by its rank.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.bpe import byte_alphabet, ragged
from newsflow.llm.common import released, slabs, stored, utf8

SLAB_BYTES = 4 * 2**20
CACHED_CHUNKS = 600_000
LONGEST_CACHED = 64
# Characters that the normaliser only lower-cases and that every Unicode version classes alike.
COMMON = re.compile("[!-~À-ÖØ-öø-ÿ]+")
# Fixed value: the split pattern of the vocabulary's file, over lower-cased common characters.
# One word with no more than a mark behind it.
SIMPLE = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")
WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


class Chunks:
    """Token ids of texts from a `tokenizers` file with word ends, lower case and no white space.

    Texts are cut at blanks and line ends, which no token crosses; ids of chunks seen before are
    kept, up to a bounded number. A new chunk of common characters, on which normalisation is lower
    case alone, is cut into words here and the library's model gives their ids; any other goes
    through the whole library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        marks = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.marked = re.compile("|".join(map(re.escape, marks)) or "(?!)").search
        self.letters = {chr(b): c for b, c in enumerate(byte_alphabet())}
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {"": 0}
        self.words: dict[str, list[int]] = {}
        self.flat = np.empty(0, np.uint32)
        self.starts = np.zeros(1, np.int64)
        self.counts = np.zeros(1, np.int64)

    def word(self, word: str) -> list[int]:
        ids = self.words.get(word)
        if ids is None:
            spelled = word if word.isascii() else "".join(map(self.letters.__getitem__, word.encode().decode("latin-1")))
            ids = [t.id for t in self.model.tokenize(spelled)]
            if len(word) <= LONGEST_CACHED:
                self.words[word] = ids
        return ids

    def ids_of(self, chunk: str) -> list[int]:
        if simple := SIMPLE.fullmatch(chunk):
            word, end = simple.groups()
            return self.word(word.lower()) + self.word(end) if end else self.word(word.lower())
        if COMMON.fullmatch(chunk) and not self.marked(chunk):
            return [i for w in WORDS.findall(chunk.lower()) for i in self.word(w)]
        return self.library.encode(chunk, add_special_tokens=False).ids

    def learn(self, new: list[str]) -> None:
        found = [self.ids_of(chunk) for chunk in new]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(counts)
        self.starts = np.concatenate((self.starts, len(self.flat) + ends - counts))
        self.counts = np.concatenate((self.counts, counts))
        self.flat = np.concatenate((self.flat, np.fromiter(chain.from_iterable(found), np.uint32, int(counts.sum()))))
        at = len(self.counts) - len(new)
        self.index.update(zip(new, range(at, at + len(new))))

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text. Arrow cuts the texts and numbers the distinct chunks of the slab."""
        if max(len(self.counts), len(self.words), len(self.flat) // 8) > CACHED_CHUNKS:
            self.clear()
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        bounds = cut.offsets.to_numpy()
        numbered = cut.flatten().dictionary_encode()
        distinct = numbered.dictionary.to_pylist()
        new = [chunk for chunk in distinct if chunk not in self.index]
        if new:
            self.learn(new)
        known = np.fromiter(map(self.index.__getitem__, distinct), np.int64, len(distinct))
        at = known[numbered.indices.to_numpy()]
        counts = self.counts[at]
        ids = ragged(self.flat, self.starts[at], counts)
        ends = np.concatenate(([0], np.cumsum(counts)))[bounds - bounds[0]]
        for chunk in new:
            if len(chunk) > LONGEST_CACHED:
                del self.index[chunk]
        return [ids[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]


@lru_cache(maxsize=2)
def chunks(path: str) -> Chunks:
    return Chunks(path)


def pieces(
    docs: DataFrame, path: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, and `ids` if asked for.

    A document is the ids of its whole text and end_id; null and empty texts are end_id alone.
    Documents longer than capacity are cut into pieces of capacity, the last one shorter. Repeated
    rows and null ids make pieces like any other; other columns are not read.
    """
    slim = docs.select(F.col(id_col), utf8(text_col).alias("__text"))
    kind = slim.schema[0].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = chunks(path)
        for slab in slabs(batches, SLAB_BYTES):
            owner, piece, start, length, crc, kept = [], [], [], [], [], []
            for i, ids in enumerate(worker.encode(slab.column(1).combine_chunks())):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    owner.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        kept.append(part.astype(np.int32))
            columns = [
                slab.column(0).combine_chunks().take(pa.array(owner, pa.int64())),
                pa.array(piece, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, crc)),
            ]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
            yield pa.record_batch(columns, names=names)

    names = [id_col, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    fields = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    def emptied(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What a task has learnt goes with it: workers wait for further tasks, of other steps as well."""
        try:
            yield from released(run(batches))
        finally:
            chunks(path).clear()

    return slim.mapInArrow(emptied, fields)


class Plan:
    """Where the pieces of each length go, as runs.

    A run says: the pieces of a length with ranks from `rank` on go to the sequences from `first`
    on, `each` to a sequence, from `offset` on.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = {n: c for n, c in counts.items() if c}
        self.used_ranks: dict[int, int] = defaultdict(int)
        self.runs: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
        self.sequences = 0
        # Gap -> groups of sequences with that gap, as (first, how many).
        self.gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.sizes: list[int] = []
        self.match_large()
        self.fit_small()

    def run(self, length: int, first: int, each: int, offset: int, taken: int) -> None:
        self.runs[length].append((self.used_ranks[length], first, each, offset))
        self.used_ranks[length] += taken
        self.left[length] -= taken

    def opened(self, many: int) -> int:
        self.sequences += many
        return self.sequences - many

    def free(self, gap: int, first: int, many: int) -> None:
        if gap and many:
            if gap not in self.gaps:
                bisect.insort(self.sizes, gap)
            self.gaps[gap].append((first, many))

    def match_large(self) -> None:
        large = sorted(n for n in self.left if 3 * n > self.capacity)
        while large:
            longest = large[-1]
            count = self.left[longest]
            at = bisect.bisect_right(large, self.capacity - longest) - 1
            if at < 0 or (large[at] == longest and count == 1):
                first = self.opened(count)
                self.run(longest, first, 1, 0, count)
                self.free(self.capacity - longest, first, count)
            elif large[at] == longest:
                first = self.opened(count // 2)
                self.run(longest, first, 2, 0, count // 2 * 2)
                self.free(self.capacity - 2 * longest, first, count // 2)
            else:
                partner = large[at]
                many = min(count, self.left[partner])
                first = self.opened(many)
                self.run(longest, first, 1, 0, many)
                self.run(partner, first, 1, longest, many)
                self.free(self.capacity - longest - partner, first, many)
            large = [n for n in large if self.left[n]]

    def fit_small(self) -> None:
        for length in sorted((n for n, c in self.left.items() if c), reverse=True):
            while self.left[length]:
                at = bisect.bisect_left(self.sizes, length)
                if at == len(self.sizes):
                    each = self.capacity // length
                    many = -(-self.left[length] // each)
                    self.free(self.capacity, self.opened(many), many)
                    continue
                gap = self.sizes[at]
                self.fill(length, gap)

    def fill(self, length: int, gap: int) -> None:
        """Put pieces into one group of sequences with this gap."""
        first, many = self.gaps[gap].pop()
        if not self.gaps[gap]:
            del self.gaps[gap]
            self.sizes.remove(gap)
        left = self.left[length]
        each = min(gap // length, left)
        full = min(many, left // each)
        self.run(length, first, each, self.capacity - gap, full * each)
        self.free(gap - each * length, first, full)
        self.free(gap, first + full, many - full)

    def arrays(self) -> dict[int, np.ndarray]:
        return {n: np.array(runs, np.int64) for n, runs in self.runs.items()}


def pack(rows: DataFrame, capacity: int, id_col: str = "doc_id", spread_by: list[str] | None = None) -> DataFrame:
    """The pieces with `sequence_id long` and `offset long`, in few sequences of at most capacity.

    rows: id, a `length` from 1 to capacity, and any other columns (columns named sequence_id and
    offset are replaced). The driver gets at most `capacity` counts; the plan that goes to the tasks
    has a size that depends on the capacity alone, not on the number of pieces. Pieces are ranked
    within hash buckets of their length, so a length that very many have is no single task.
    Sequence ids are gapless from 0; an empty table gives an empty result.
    """
    rows = rows.drop("sequence_id", "offset")
    names = rows.columns
    keys = spread_by or [id_col]
    buckets = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(rows.withColumn("__bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets))), "pieces")
    sizes = rows.groupBy("length", "__bucket").agg(F.count("*").alias("__n"))
    counts = rows.groupBy("length").count().collect()
    plan = Plan({r["length"]: r["count"] for r in counts}, capacity).arrays()
    before = Window.partitionBy("length").orderBy("__bucket")
    starts = sizes.select("length", "__bucket", (F.sum("__n").over(before) - F.col("__n")).alias("__start"))
    within = Window.partitionBy("length", "__bucket").orderBy(*keys)
    ranked = rows.withColumn("__rank", F.row_number().over(within) - 1).join(starts, ["length", "__bucket"])
    ranked = ranked.select(*[F.col(f"`{n}`") for n in names], (F.col("__start") + F.col("__rank")).alias("__rank"))
    at_length, at_rank = names.index("length"), len(names)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(at_length).to_numpy()
            rank = batch.column(at_rank).to_numpy()
            sequence = np.empty(len(length), np.int64)
            offset = np.empty(len(length), np.int64)
            for n in np.unique(length).tolist():
                own = np.flatnonzero(length == n)
                runs = plan[n]
                run = runs[np.searchsorted(runs[:, 0], rank[own], side="right") - 1]
                inside = rank[own] - run[:, 0]
                sequence[own] = run[:, 1] + inside // run[:, 2]
                offset[own] = run[:, 3] + inside % run[:, 2] * n
            yield pa.record_batch(
                [*batch.columns[:at_rank], pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in names)
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long")

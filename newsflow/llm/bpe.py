"""Byte-level BPE encoding by a pair occurrence index, and decoding.

The vocabulary is a public tokenizer file (a `tokenizers` JSON); it is read, never trained.
For the new words of a slab of texts, an index maps every adjacent pair that has a merge to all
its positions. Ranks are applied in ascending order; one rank is merged at all its positions at
once, and only the lists of the pairs that this makes are added to.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import slabs, utf8

# Fixed value: the split pattern of the vocabulary's byte-level pre-tokenizer.
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Two white-space characters in a row, or one of the separators on which libraries differ.
UNEVEN_SPACE = re.compile(r"\s\s|[\x1c-\x1f\x85]")
SLAB_BYTES = 2 * 2**20
CACHED_CHUNKS = 100_000
LONGEST_CACHED = 64
LEARN_CHARS = 2**20


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    other = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(other)) for b in range(256)]


def ragged(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs of flat that begin at starts, one after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(starts - (ends - counts), counts)]


class Vocabulary:
    """Ids, merges by rank and added tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids = spec["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        alphabet = byte_alphabet()
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.byte_ids = np.array([ids[c] for c in alphabet], np.int64)
        self.width = max([*ids.values(), *self.added.values()]) + 1
        keys = np.array([ids[a] * self.width + ids[b] for a, b in merges], np.int64)
        self.left = np.array([ids[a] for a, _ in merges], np.int64)
        self.right = np.array([ids[b] for _, b in merges], np.int64)
        self.made = np.array([ids[a + b] for a, b in merges], np.int64)
        first_made = dict(zip(self.made[::-1].tolist(), range(len(merges) - 1, -1, -1)))
        for rank, (a, b) in enumerate(zip(self.left.tolist(), self.right.tolist())):
            if max(first_made.get(a, -1), first_made.get(b, -1)) >= rank:
                raise ValueError("a merge uses a token that only a later merge makes")
        order = np.argsort(keys, kind="stable")
        self.keys, self.key_ranks = keys[order], order
        to_byte = {c: b for b, c in enumerate(alphabet)}
        spelled = [b""] * self.width
        for t, i in [*ids.items(), *self.added.items()]:
            spelled[i] = bytes(to_byte[c] for c in t) if all(c in to_byte for c in t) else t.encode()
        self.token_sizes = np.fromiter(map(len, spelled), np.int64, self.width)
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes
        self.token_bytes = np.frombuffer(b"".join(spelled), np.uint8)

    def decode(self, ids: np.ndarray) -> str:
        if len(ids) and not 0 <= ids.min() <= ids.max() < self.width:
            raise ValueError("an id is not in the vocabulary")
        parts = ragged(self.token_bytes, self.token_starts[ids], self.token_sizes[ids])
        return parts.tobytes().decode("utf-8", "replace")

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where there is no merge."""
        keys = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.key_ranks[at], -1)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class PairIndex:
    """Symbols of many words in a row, and the positions of every pair that has a merge."""

    def __init__(self, words: list[bytes], vocab: Vocabulary):
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        n = len(raw)
        self.vocab = vocab
        # Four bytes each: an unbroken chunk may be very long.
        self.symbols = vocab.byte_ids.astype(np.int32)[raw]
        self.next = np.arange(1, n + 1, dtype=np.int32)
        self.previous = np.arange(-1, n - 1, dtype=np.int32)
        ends = np.cumsum(lengths)[lengths > 0]
        self.next[ends - 1] = -1
        self.previous[np.concatenate(([0], ends[:-1]))[: len(ends)]] = -1
        self.alive = np.ones(n, bool)
        self.word_of = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        self.positions: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self.add(np.flatnonzero(self.next >= 0))

    def add(self, at: np.ndarray) -> None:
        """Enter the pairs that begin at these positions under their ranks."""
        ranks = self.vocab.ranks(self.symbols[at], self.symbols[self.next[at]])
        at, ranks = at[ranks >= 0], ranks[ranks >= 0]
        if not len(at):
            return
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for rank, part in zip(ranks[np.concatenate(([0], cuts))].tolist(), np.split(at, cuts)):
            if rank not in self.positions:
                self.positions[rank] = []
                heapq.heappush(self.active, rank)
            self.positions[rank].append(part)

    def merge_all(self) -> None:
        while self.active:
            rank = heapq.heappop(self.active)
            parts = self.positions.pop(rank)
            at = np.unique(np.concatenate(parts)) if len(parts) > 1 else np.sort(parts[0])
            left, right = self.vocab.left[rank], self.vocab.right[rank]
            at = at[self.alive[at] & (self.symbols[at] == left) & (self.next[at] >= 0)]
            at = at[self.symbols[self.next[at]] == right]
            if left == right and len(at) > 1:
                at = self.apart(at)
            if len(at):
                self.merge(at, self.vocab.made[rank])

    def apart(self, at: np.ndarray) -> np.ndarray:
        """Of overlapping pairs of one symbol, every second, from the left."""
        joined = np.concatenate(([False], self.next[at[:-1]] == at[1:]))
        index = np.arange(len(at))
        start = np.maximum.accumulate(np.where(joined, 0, index))
        return at[(index - start) % 2 == 0]

    def merge(self, at: np.ndarray, made: int) -> None:
        gone = self.next[at]
        after = self.next[gone]
        self.symbols[at] = made
        self.alive[gone] = False
        self.next[at] = after
        followed = after >= 0
        self.previous[after[followed]] = at[followed]
        before = self.previous[at]
        self.add(np.unique(np.concatenate((before[before >= 0], at[followed]))))

    def result(self, n_words: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each word has."""
        return self.symbols[self.alive], np.bincount(self.word_of[self.alive], minlength=n_words)


class Encoder:
    """Encodes texts; ids of chunks seen before are kept, up to a bounded number of chunks."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.split = regex.compile(SPLIT)
        tokens = sorted(vocab.added, key=len, reverse=True)
        self.added = re.compile("(" + "|".join(map(re.escape, tokens)) + ")") if tokens else None
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.empty(0, np.int64)
        self.starts = np.empty(0, np.int64)
        self.counts = np.empty(0, np.int64)

    def chunks(self, text: str) -> list[str]:
        """Parts that can be encoded apart: at single spaces and line ends, else pre-tokens."""
        if not text:
            return []
        if UNEVEN_SPACE.search(text):
            return self.split.findall(text)
        first, *rest = text.replace("\n", " \n ").split(" ")
        chunks = [first] if first else []
        fresh = False
        for part in rest:
            if part == "\n":
                chunks.append(part)
                fresh = True
            elif fresh:
                if part:
                    chunks.append(part)
                fresh = False
            else:
                chunks.append(" " + part)
        return chunks

    def pieces(self, text: str) -> list[str]:
        """Chunks and added tokens of a text in order."""
        if self.added is None or not any(t in text for t in self.vocab.added):
            return self.chunks(text)
        out: list[str] = []
        for i, part in enumerate(self.added.split(text)):
            out.extend([part] if i % 2 else self.chunks(part))
        return out

    def learn(self, new: list[str]) -> None:
        """Encode chunks that have no ids yet, all in one pair index."""
        words, owner, fixed = [], [], {}
        for i, chunk in enumerate(new):
            if chunk in self.vocab.added:
                fixed[i] = self.vocab.added[chunk]
                continue
            for word in self.split.findall(chunk):
                words.append(word.encode())
                owner.append(i)
        index = PairIndex(words, self.vocab)
        index.merge_all()
        ids, per_word = index.result(len(words))
        counts = np.zeros(len(new), np.int64)
        np.add.at(counts, np.array(owner, np.int64), per_word)
        if fixed:
            at = np.concatenate(([0], np.cumsum(counts)))[list(fixed)]
            ids = np.insert(ids, at, list(fixed.values()))
            counts[list(fixed)] = 1
        begin = len(self.flat)
        ends = np.cumsum(counts)
        self.starts = np.concatenate((self.starts, begin + ends - counts))
        self.counts = np.concatenate((self.counts, counts))
        self.flat = np.concatenate((self.flat, ids))
        at = len(self.counts) - len(new)
        self.index.update(zip(new, range(at, at + len(new))))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if max(len(self.counts), len(self.flat) // 8) > CACHED_CHUNKS:
            self.clear()
        cut = [self.pieces(text) for text in texts]
        new = {chunk for chunks in cut for chunk in chunks if chunk not in self.index}
        for part in portions(sorted(new), LEARN_CHARS):
            self.learn(part)
        out = [self.gather(np.fromiter(map(self.index.__getitem__, c), np.int64, len(c))) for c in cut]
        for chunk in new:
            if len(chunk) > LONGEST_CACHED:
                del self.index[chunk]
        return out

    def gather(self, chunks: np.ndarray) -> np.ndarray:
        return ragged(self.flat, self.starts[chunks], self.counts[chunks])


def portions(chunks: list[str], most: int) -> Iterator[list[str]]:
    """The chunks in lists of about most characters: the pair index takes many bytes for each."""
    held, size = [], 0
    for chunk in chunks:
        held.append(chunk)
        size += len(chunk)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(vocabulary(path))


def lists(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and `ids array<int>`, the ids of its whole text.

    path: the vocabulary file, at the same place on every executor. Special tokens in a text
    become their ids. A null or empty text has no ids; repeated rows and null ids are encoded
    like any other; other columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = encoder(path)
        for slab in slabs(batches, SLAB_BYTES):
            ids = worker.encode(slab.column(1).to_pylist())
            for start in range(0, slab.num_rows, 500):
                part = slab.slice(start, 500)
                yield pa.record_batch(
                    [part.column(0).combine_chunks(), lists(ids[start : start + 500])],
                    names=[id_col, "ids"],
                )

    slim = docs.select(F.col(id_col), utf8(text_col).alias("__text"))
    kind = slim.schema[0].dataType.simpleString()
    return slim.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its id, `n_tokens long`, and the SHA-256 of its ids, in decimal with commas, and of the text
    that they decode to.

    Encoded and decoded in one pass, so ids and texts do not leave the task, and a core has one worker
    with one vocabulary. Null and empty texts have no ids; everything else is as in ``encode``.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = encoder(path)
        for slab in slabs(batches, SLAB_BYTES):
            found = worker.encode(slab.column(1).to_pylist())
            spelled = [",".join(map(str, ids.tolist())) for ids in found]
            yield pa.record_batch([
                slab.column(0).combine_chunks(), pa.array([len(ids) for ids in found], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in spelled], pa.string()),
                pa.array([hashlib.sha256(worker.vocab.decode(ids).encode()).hexdigest() for ids in found], pa.string()),
            ], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    slim = docs.select(F.col(id_col), utf8(text_col).alias("__text"))
    kind = slim.schema[0].dataType.simpleString()
    return slim.mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """The same rows with `decoded string`: the text of the ids, special tokens as they are written.

    Bytes that are no UTF-8 become U+FFFD; null ids give a null text, ids out of the vocabulary an
    error. A column named `decoded` is replaced.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoded = vocabulary(path).decode
        for batch in batches:
            texts = [
                decoded(ids.values.to_numpy(zero_copy_only=False)) if ids.is_valid else None
                for ids in batch.column(names.index(ids_col))
            ]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names=[*names, "decoded"])

    rows = encoded.drop("decoded")
    names = rows.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, decoded string")

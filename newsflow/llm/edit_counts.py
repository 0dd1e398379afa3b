"""Token counts that follow edits: a segment tree per document over its parts.

The leaves are runs of pre-tokens, the nodes hold sums of characters and tokens. An edit finds its
leaves by character offset, cuts and encodes the text again from a few parts before it until a
boundary of the new cut meets an old one, and updates the sums on the way to the root. A byte-level
pre-tokenizer looks ahead but never back, so what follows that boundary is as before.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.bpe import SPLIT, UNEVEN_SPACE
from newsflow.llm.common import utf8

SLOT = 16
LARGEST_SLOT = 128
# No rule of the pre-tokenizer reaches over more pre-tokens than this.
CONTEXT = 3
CACHED_PARTS = 100_000
LONGEST_CACHED = 64
EDITS = "array<struct<start:bigint,length:bigint,replacement:string>>"


class Counter:
    """Token counts of parts of text; counts seen before are kept, up to a bounded number."""

    def __init__(self, ranks_path: str):
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.library = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(SPLIT)
        self.known: dict[str, int] = {}

    def count(self, part: str) -> int:
        n = self.known.get(part)
        if n is None:
            n = len(self.library.encode_ordinary(part))
            if len(part) <= LONGEST_CACHED:
                if len(self.known) >= CACHED_PARTS:
                    self.known.clear()
                self.known[part] = n
        return n

    def parts(self, text: str) -> list[str]:
        """Parts that begin and end at pre-token boundaries: cut before blanks, else pre-tokens."""
        if UNEVEN_SPACE.search(text):
            return self.split.findall(text)
        first, *rest = text.split(" ")
        return ([first] if first else []) + [" " + part for part in rest]


class Tree:
    """The parts of one text in slots, with sums of characters and tokens over the slots."""

    def __init__(self, text: str, counter: Counter):
        self.counter = counter
        self.reencoded = 0
        self.build(counter.parts(text))

    def build(self, parts: list[str]) -> None:
        self.slots = [parts[at : at + SLOT] for at in range(0, len(parts), SLOT)] or [[]]
        self.base = 1 << (len(self.slots) - 1).bit_length()
        self.chars = [0] * (2 * self.base)
        self.tokens = [0] * (2 * self.base)
        for i, slot in enumerate(self.slots):
            self.chars[self.base + i] = sum(map(len, slot))
            self.tokens[self.base + i] = sum(map(self.counter.count, slot))
        for node in range(self.base - 1, 0, -1):
            self.add_up(node)

    def add_up(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(part for slot in self.slots for part in slot)

    def locate(self, offset: int) -> tuple[int, int, int]:
        """The slot and part that hold a character offset, and where the part begins."""
        node, at = 1, 0
        while node < self.base:
            node *= 2
            # At the very end of the text, the last characters there are.
            if offset >= at + self.chars[node] and self.chars[node + 1]:
                at += self.chars[node]
                node += 1
        slot = node - self.base
        parts = self.slots[slot] if slot < len(self.slots) else []
        for i, part in enumerate(parts):
            if offset < at + len(part) or i == len(parts) - 1:
                return slot, i, at
            at += len(part)
        return min(slot, len(self.slots) - 1), 0, at

    def before(self, slot: int, part: int, at: int, steps: int) -> tuple[int, int, int]:
        """The place some parts earlier."""
        while steps and (slot or part):
            if part:
                part -= 1
            else:
                slot -= 1
                part = len(self.slots[slot])
                continue
            at -= len(self.slots[slot][part])
            steps -= 1
        return slot, part, at

    def edit(self, start: int, length: int, replacement: str) -> None:
        """Replace `length` characters from `start` on; both are cut to the text."""
        start = min(max(0, start), self.n_chars)
        end = min(self.n_chars, start + max(0, length))
        first_slot, first, begin = self.before(*self.locate(start), CONTEXT)
        old, slot, part, at = [], first_slot, first, begin
        window = CONTEXT
        while True:
            # Take whole parts until some lie behind the edit, or the text ends.
            extra = 0
            while slot < len(self.slots) and extra < window:
                if part == len(self.slots[slot]):
                    slot, part = slot + 1, 0
                    continue
                piece = self.slots[slot][part]
                at += len(piece)
                old.append((piece, at, slot, part + 1))
                extra += at > end
                part += 1
            ended = slot >= len(self.slots) or (extra < window)
            whole = "".join(p for p, *_ in old)
            changed = whole[: start - begin] + replacement + whole[end - begin :]
            shift = len(replacement) - (end - start)
            ends = {after + shift: (s, p) for _, after, s, p in old if after >= end}
            new, place = [], begin
            for match in self.counter.split.finditer(changed):
                new.append(match.group())
                place += len(new[-1])
                # The last part may reach further with what follows it, so it does not count as a meeting.
                if place in ends and place >= start + len(replacement) and (ended or place < begin + len(changed) - 1):
                    last = ends[place]
                    self.replace(first_slot, first, *last, new)
                    return
            if ended:
                self.replace(first_slot, first, len(self.slots) - 1, len(self.slots[-1]), new)
                return
            window *= 2

    def replace(self, slot: int, part: int, last_slot: int, last_part: int, new: list[str]) -> None:
        """Put new parts in place of those from one place up to another, and update the sums."""
        self.reencoded += len(new)
        tail = self.slots[last_slot][last_part:]
        self.slots[slot] = self.slots[slot][:part] + new + (tail if slot == last_slot else [])
        if slot != last_slot:
            for k in range(slot + 1, last_slot):
                self.slots[k] = []
            self.slots[last_slot] = tail
        if any(len(self.slots[k]) > LARGEST_SLOT for k in (slot, last_slot)):
            self.build([p for s in self.slots for p in s])
            return
        for k in range(slot, last_slot + 1):
            self.chars[self.base + k] = sum(map(len, self.slots[k]))
            self.tokens[self.base + k] = sum(map(self.counter.count, self.slots[k]))
        low, high = (self.base + slot) // 2, (self.base + last_slot) // 2
        while low:
            for node in range(low, high + 1):
                self.add_up(node)
            low, high = low // 2, high // 2


@lru_cache(maxsize=1)
def counter(path: str) -> Counter:
    return Counter(path)


def edit_lists(edits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """`id, edits` from rows of `id, seq, start, length, replacement`, in the order of seq.

    The edits of one document depend on each other, so they are one list.
    """
    item = F.struct("seq", "start", "length", "replacement")
    ordered = F.sort_array(F.collect_list(item))
    return edits.groupBy(id_col).agg(F.transform(
        ordered, lambda e: F.struct(e["start"].alias("start"), e["length"].alias("length"), e["replacement"].alias("replacement"))
    ).alias("edits"))


def counted(
    docs: DataFrame, ranks_path: str, edits: Column, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per document: id, `n_tokens`, `n_edits`, `n_tokens_after`, `n_chars_after`, `n_reencoded`.

    edits: the document's edits, EDITS, applied one after the other; start and length count characters
    of the text as it is then, and what lies outside is cut off. A null list is none, null starts,
    lengths and replacements are 0, 0 and empty, a null text is empty. Special tokens are counted as
    ordinary text. n_reencoded is the number of parts that the edits had encoded again. Repeated rows
    and null ids are counted like any other; other columns are not read.
    """
    slim = docs.select(F.col(id_col), utf8(text_col).alias("__text"), edits.cast(EDITS).alias("__edits"))
    names = [id_col, "n_tokens", "n_edits", "n_tokens_after", "n_chars_after", "n_reencoded"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = counter(ranks_path)
        for batch in batches:
            out = []
            for text, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                tree = Tree(text, worker)
                n = tree.n_tokens
                for e in own or []:
                    e = e or {}
                    tree.edit(e.get("start") or 0, e.get("length") or 0, e.get("replacement") or "")
                out.append((n, len(own or []), tree.n_tokens, tree.n_chars, tree.reencoded))
            columns = list(zip(*out)) or [()] * 5
            yield pa.record_batch([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], names=names)

    kind = slim.schema[0].dataType.simpleString()
    return slim.mapInArrow(run, f"`{id_col}` {kind}, " + ", ".join(f"{n} long" for n in names[1:]))

"""The mix against a plain walk over the same shuffled streams, and its laws."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from newsflow.llm import mixing as M

SCHEMA = "doc_id long, text string, source string, size int, slot string, part int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def targets(sizes, weights, limit):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(limit * sizes[s] for s in full)
        shared = sum(weight[s] for s in names if s not in full)
        new = {s for s in names if s not in full and limit * sizes[s] < weight[s] * left / max(shared, 1)}
        if not new:
            return {s: limit * sizes[s] if s in full else weight[s] * left / max(shared, 1) for s in names}
        full |= new


def plain(rows, weights, limit):
    """Per row its taken words: every source's passes over its shuffled rows until the target is met."""
    seen, keyed = Counter(), defaultdict(list)
    for i, text, source in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        parts = ([] if i is None else [str(i)]) + [md5(text or "")]
        copy = seen[(i, text or "", source)]
        seen[(i, text or "", source)] += 1
        keyed[source].append((md5(":".join([*parts, str(copy)])), n, i))
    sizes = {s: sum(n for _, n, _ in own) for s, own in keyed.items()}
    aims, got = targets(sizes, weights, limit), []
    for source, own in keyed.items():
        left, taken, epoch = int(aims[source] + 0.5), Counter(), 0
        while left > 0:
            for key, n, _ in sorted(own, key=lambda r: md5(f"{epoch}:{r[0]}")):
                part = min(n, left)
                taken[key] += part
                left -= part
            epoch += 1
        got += [(str(i), n, sizes[source], round(float(aims[source]), 6), taken[key]) for key, n, i in own]
    return sorted(got)


def made(rng, n, sources):
    rows = [(i, " ".join(rng.choice("abcdef") for _ in range(rng.choice([0, 1, 5, 40, 300]))), rng.choice(sources)) for i in range(n)]
    return rows + [(n, None, "b"), (n, None, "b"), (None, "x y", None), (7, "x\ty z\x0b", "b"), (7, "x\ty z\x0b", "b"), (n + 1, "w " * 5000, "e")]


@pytest.mark.parametrize("seed,block", [(1, 64), (2, 2048), (3, 7)])
def test_against_plain(spark, monkeypatch, seed, block):
    rng = random.Random(seed)
    monkeypatch.setattr(M, "PART_ROWS", [40, 50_000, 7][seed - 1])
    rows = made(rng, 200, ["a", "b", "b", "b", "c", "", "É", "𝄞", "￿", None, "d"])
    mixed = M.mix(frame(spark, rows).repartition(4), block=block)
    got = sorted((str(r.id), r.size, r.source_size, round(r.target, 6), r.taken) for r in M.taken(mixed).collect())
    assert got == plain(rows, (5, 2, 1), 3)
    assert all(r.taken <= 3 * r.size for r in M.taken(mixed).collect())
    parts = mixed.schedule.where("slot IS NOT NULL").collect()
    # Slots hold one source, and no words beyond block; parts of a slot do not overlap.
    by_slot = defaultdict(list)
    for r in parts:
        by_slot[r.slot].append(r)
        assert 0 <= r.word_from and r.word_from + r.n_words <= r.size and r.n_words > 0
    for held in by_slot.values():
        assert len({r.source_no for r in held}) == 1
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.n_words
        assert at <= block


def test_sources_stay_close_to_their_shares(spark):
    rows = [(i, "w " * 50, "abc"[i % 3]) for i in range(3000)]
    mixed = M.mix(frame(spark, rows), block=50)
    slots = mixed.schedule.where("slot IS NOT NULL").groupBy("slot").agg(F.first("source").alias("s")).orderBy("slot").collect()
    share, seen = {"a": 5 / 8, "b": 2 / 8, "c": 1 / 8}, Counter()
    for n, r in enumerate(slots, 1):
        seen[r.s] += 1
        assert all(abs(seen[s] - n * p) < 2 + n.bit_length() for s, p in share.items())


def test_order_of_rows_and_partitions_makes_no_difference(spark):
    rows = made(random.Random(5), 120, ["a", "b", None])
    read = lambda rows, n: sorted(map(str, M.mix(frame(spark, rows).repartition(n), block=16).schedule.collect()))
    assert read(rows, 2) == read(rows[::-1], 7)


def test_many_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(M, "COPIES_A_TASK", 10)
    rows = [(1, "a b c", "s")] * 333 + [(2, "a b c", "t")]
    got = M.taken(M.mix(frame(spark, rows), block=8)).collect()
    assert len(got) == 334
    by_source = Counter()
    for r in got:
        by_source[r.source] += r.taken
    # The small source stops at three times its size.
    assert by_source == {"s": 1002 - 9, "t": 9}


def test_empty_and_wordless(spark):
    assert M.taken(M.mix(frame(spark, []))).collect() == []
    got = M.taken(M.mix(frame(spark, [(1, None, "a"), (2, " ", None)]))).collect()
    assert sorted((r.id, r.size, r.target, r.taken, r.first_slot) for r in got) == [(1, 0, 0.0, 0, None), (2, 0, 0.0, 0, None)]


def test_no_python_in_the_plan(spark):
    docs = frame(spark, [(1, "a b", "a"), (2, "c", "b")])
    plan = M.taken(M.mix(docs))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert "Python" not in M.numbered(docs, "doc_id", "text", "source")._jdf.queryExecution().toString()

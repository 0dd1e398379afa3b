"""Repeated strings against brute force over all windows."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newsflow.llm import suffixes


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = True
        edges = np.diff(np.concatenate(([0], gone.astype(int))))
        out.append((len(r), int(gone.sum()), int((edges == 1).sum()), bytes(b for b, g in zip(r, gone) if not g)))
    return out


def corpus(seed):
    rng = random.Random(seed)
    letters = "ab" if seed % 2 else "abcdefghij é"
    word = lambda n: "".join(rng.choices(letters, k=n))
    passage = [word(rng.choice([40, 50, 64, 80, 130])) for _ in range(5)]
    texts = []
    for _ in range(60):
        parts = [rng.choice(passage) if rng.random() < 0.4 else word(rng.randrange(60)) for _ in range(rng.randrange(8))]
        texts.append("".join(parts))
    for _ in range(40):
        t = list(rng.choice(texts))
        for _ in range(rng.randrange(3)):
            if t:
                t[rng.randrange(len(t))] = rng.choice(letters)
        texts.append("".join(t))
    texts += ["a" * 300, "ab" * 100, "xyz" * 50 + "é" * 60, "", passage[0], passage[0] + "q", "q" + passage[0]]
    return texts


@pytest.mark.parametrize(("seed", "hot", "bucket"), [(1, 10**6, 10), (2, 10**6, 10**6), (3, 1, 10), (4, 3, 50)])
def test_against_brute_force(spark, seed, hot, bucket):
    texts = corpus(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 AS kept", "2 AS doc")
    out = suffixes.without_repeats(docs, 40, hot_contexts=hot, bucket_contexts=bucket)
    assert set(out.columns) == {"doc_id", "text", "doc", "n_bytes", "n_removed", "n_spans", "kept"}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 40)


def test_odd_rows(spark):
    long = "".join(random.Random(0).choices("abcdef", k=500))
    rows = [(1, long), (1, long), (1, "other " + long[:230]), (None, None), (None, long[100:400] + "!"), (5, ""), (5, "x" * 199), (6, "y" * 201)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = suffixes.without_repeats(docs).collect()
    got = sorted(((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out))
    assert got == sorted(brute([t for _, t in rows], 200))
    assert suffixes.without_repeats(docs.limit(0)).count() == 0


@settings(deadline=None, max_examples=150)
@given(st.lists(st.tuples(st.text("ab", max_size=7), st.text("ab", max_size=9)), min_size=2, max_size=12), st.integers(4, 12))
def test_windows_of_one_gram(sides, length):
    contexts = [(a + "XY" + b).encode() for a, b in sides]
    place = [len(a) for a, _ in sides]
    seen = Counter((c[i : i + length], p - i) for c, p in zip(contexts, place) for i in range(len(c) - length + 1))
    got = suffixes.repeated_windows(contexts, place, length)
    for c, p, runs in zip(contexts, place, got):
        marked = {i for a, b in runs for i in range(a, b + 1)}
        for i in range(len(c) - length + 1):
            if i <= p and p + 2 <= i + length:  # the windows that hold the gram
                assert (i in marked) == (seen[c[i : i + length], p - i] > 1)


def test_order_is_verified(monkeypatch):
    # With hashes that tell nothing apart, the bytes decide.
    monkeypatch.setattr(suffixes.Sorted, "prefixes", staticmethod(lambda s: [0] * (len(s) + 1)))
    found = suffixes.Sorted([b"b", b"ab", b"", b"aa", b"ab"])
    assert [found.strings[i] for i in found.order] == [b"", b"aa", b"ab", b"ab", b"b"]
    assert found.common == [0, 1, 2, 0]


def test_anchors_partition_windows():
    rng = np.random.default_rng(0)
    for data in (rng.integers(97, 100, 5000).astype(np.uint8), np.full(400, 97, np.uint8)):
        _, place, first, last = next(suffixes.anchors(data, 200))
        assert first[0] == 0 and last[-1] == len(data) - 200 and (first[1:] == last[:-1] + 1).all()
        assert (place >= last).all() and (place + suffixes.GRAM <= first + 200).all()


def test_long_text_in_parts(monkeypatch):
    monkeypatch.setattr(suffixes, "PART", 300)
    rng = np.random.default_rng(0)
    data = rng.integers(97, 100, 2000).astype(np.uint8)
    parts = list(suffixes.anchors(data, 200))
    first, last = (np.concatenate([p[i] for p in parts]) for i in (2, 3))
    assert first[0] == 0 and last[-1] == 1800 and (first[1:] == last[:-1] + 1).all()

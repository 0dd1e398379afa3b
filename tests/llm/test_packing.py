"""Packing: pieces as the library makes them, sequences without holes, few of them."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from newsflow.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
HARD = [
    "", " ", "Hello, World!  don't\tSTOP\n\n it's", "a<|endoftext|>b <|startoftext|> c", "é é ÀÉ ́x",
    "日本語 テキスト 😀👍🏽", "x\x1cy\x85z q　w", "İstanbul ΣΑΣ ς", "12345 6", "=" * 400, "aaaa" * 100,
    "<|startoftext|>", "end ", "\n", "ﬁ ﬀ Ⅷ ½",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids(library):
    worker = packing.Chunks(PATH)
    rng = random.Random(2)
    parts = ["the", "The", " ", "\n", "'s", "9", "é", "!", "<|endoftext|>", "\t", "thing", "'", "ll", "́"]
    texts = HARD + ["".join(rng.choices(parts, k=rng.randrange(25))) for _ in range(1500)]
    for _ in range(2):
        for text, ids in zip(texts, worker.encode(pa.array(texts))):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def placed(counts, capacity):
    plan = packing.Plan(dict(counts), capacity)
    bins = defaultdict(list)
    for n, c in counts.items():
        runs = plan.arrays()[n]
        for rank in range(c):
            run = runs[np.searchsorted(runs[:, 0], rank, side="right") - 1]
            inside = rank - run[0]
            bins[int(run[1] + inside // run[2])].append((int(run[3] + inside % run[2] * n), n))
    return bins, plan


def gapless(content, capacity):
    at = 0
    for offset, n in sorted(content):
        assert offset == at
        at += n
    assert at <= capacity


@settings(deadline=None, max_examples=150)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 25), min_size=1), st.integers(40, 60))
def test_plan(counts, capacity):
    bins, plan = placed(counts, capacity)
    assert sorted(bins) == list(range(plan.sequences))
    for content in bins.values():
        gapless(content, capacity)
        assert sum(3 * n > capacity for _, n in content) <= 2
    assert Counter(n for c in bins.values() for _, n in c) == Counter(counts)
    total = sum(n * c for n, c in counts.items())
    least = max(-(-total // capacity), sum(c for n, c in counts.items() if 2 * n > capacity))
    assert least <= plan.sequences <= 1.5 * least + 1


def test_large_pairs_are_most():
    # 20 of 30 with 20 of 18 fit pairwise, and the best single matching pairs all of them.
    bins, _ = placed({30: 20, 18: 20, 25: 3}, 50)
    assert len(bins) == 22


def test_operator(spark, library):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(["thing", "of", "Überall", "x."], k=rng.choice([1, 9, 30, 200])))) for i in range(300)]
    rows += [(None, "a"), (900, None), (7, ""), (7, ""), (901, "deep " * 700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "5 AS length", "6 AS offset")
    out = packing.pack(packing.pieces(docs, PATH, 64, 0, with_ids=True), 64).collect()
    expected = Counter()
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 64):
            part = ids[k : k + 64]
            crc = zlib.crc32(np.array(part, "<u4").tobytes())
            expected[(i, k // 64, k, len(part), crc, tuple(part))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in out) == expected
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for content in bins.values():
        gapless(content, 64)
    assert len(bins) <= 1.02 * sum(r.length for r in out) / 64 + 1
    assert packing.pack(packing.pieces(docs.limit(0), PATH, 64, 0), 64).count() == 0


def test_query(spark, sf_dir):
    from newsflow.llm.queries import op4_best_fit_packing

    out = op4_best_fit_packing(spark, sf_dir).collect()
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for content in bins.values():
        gapless(content, 2048)
    assert len(bins) <= 1.01 * sum(r.length for r in out) / 2048 + 1


def test_a_worker_keeps_nothing_of_a_task(spark):
    """What packing has learnt of its texts is gone from the worker when the task ends."""
    import os

    def left(batches):
        for batch in batches:
            held = packing.chunks(PATH)
            yield pa.record_batch([pa.array([os.getpid()]), pa.array([len(held.index) + len(held.words)])], names=["pid", "n"])

    docs = spark.createDataFrame([(i, f"first{i} second{i}") for i in range(200)], "doc_id long, text string")
    assert packing.pieces(docs.repartition(4), PATH, 2048, 0).count() >= 200
    one = spark.range(16).repartition(16).mapInArrow(left, "pid long, n long").collect()
    assert one and {r.n for r in one} == {1}

"""Counts after edits against encoding the edited text from scratch."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from newsflow.llm import edit_counts as ec

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PARTS = ["the", "The", " ", "  ", "\n", "'", "'s", "r", "e", "l", "9", "42", "é", "!", "...", "<|endoftext|>", "\t", "日", " thing", "'ll"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def apply(text, start, length, new):
    start = min(max(0, start or 0), len(text))
    return text[:start] + (new or "") + text[start + max(0, length or 0):]


@pytest.mark.parametrize("seed", range(3))
def test_random_edits(library, seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(ec, "LARGEST_SLOT", rng.choice([20, 128]))
    worker = ec.Counter(PATH)
    for _ in range(250):
        kind = PARTS if rng.random() < 0.7 else [" a", " thing", " of", ".\n", "x"]
        text = "".join(rng.choices(kind, k=rng.choice([0, 1, 5, 40, 400])))
        tree = ec.Tree(text, worker)
        assert tree.n_tokens == library(text) and tree.text() == text
        for _ in range(8):
            start, length = rng.randrange(len(text) + 2), rng.choice([0, 0, 1, 3, 30, 2000])
            new = "".join(rng.choices(PARTS, k=rng.choice([0, 1, 1, 4, 60])))
            tree.edit(start, length, new)
            text = apply(text, start, length, new)
            assert tree.text() == text, (start, length, new)
            assert tree.n_tokens == library(text), (text, start, length, new)
            assert tree.n_chars == len(text)


def test_only_the_region_is_encoded():
    tree = ec.Tree(" word" * 50_000, ec.Counter(PATH))
    tree.edit(100_000, 3, "new words")
    assert tree.reencoded < 15
    for k in range(2000):
        tree.edit(k * 100, 2, "x")
    assert tree.reencoded < 2001 * 15


def test_operator(spark, library):
    rows = [(1, "a b c", [(0, 1, "xy"), (2, 0, None)]), (None, None, None), (2, "", [(5, 5, "it's")]), (2, "", [(5, 5, "it's")]),
            (3, "one two", [None, (None, None, "z"), (-4, 2, "")])]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, edits {ec.EDITS}").selectExpr("*", "1 AS n_tokens")
    out = ec.counted(docs, PATH, F.col("edits")).collect()
    assert len(out) == len(rows)
    for r, (i, text, edits) in zip(out, rows):
        before = library(text or "")
        for e in edits or []:
            text = apply(text or "", *(e or (0, 0, "")))
        assert (r.doc_id, r.n_tokens, r.n_tokens_after, r.n_edits) == (i, before, library(text or ""), len(edits or []))
    assert ec.counted(docs.limit(0), PATH, F.col("edits")).count() == 0


def test_lists(spark):
    rows = [(1, 2, 5, 0, "b"), (1, 1, 0, 1, "a"), (2, 1, 0, 0, None)]
    edits = spark.createDataFrame(rows, "doc_id long, seq int, start long, length long, replacement string")
    out = {r.doc_id: [tuple(e) for e in r.edits] for r in ec.edit_lists(edits).collect()}
    assert out == {1: [(0, 1, "a"), (5, 0, "b")], 2: [(0, 0, None)]}


def test_query(spark, sf_dir, library):
    from newsflow.llm.queries import op8_edit_counts

    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    rows = op8_edit_counts(spark, sf_dir).collect()
    assert len(rows) == len(texts) and all(r.n_tokens == library(texts[r.doc_id]) for r in rows)

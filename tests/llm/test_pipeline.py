"""The pipeline, stage by stage, against plain Python on a small corpus."""

import random
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from newsflow.llm import order_minhash as om
from newsflow.llm import queries, rules
from newsflow.llm.common import stored

from tests_llm_helpers import brute_repeats, plain_measures  # isort: skip

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randrange(3, 9))) for _ in range(3000)]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    passage = text(60)
    rows, labels = [], []
    for i in range(400):
        kind = i % 10
        if kind == 0:
            body = " ".join(w + "***" for w in text(60).split())
        elif kind == 1:
            body = text(40) + " stupid idiot " + text(30)
        elif kind == 2:
            body = text(30) + "\n" + passage + "\n" + text(30)
        elif kind == 3 and rows:
            words = rows[-10][1].split() if len(rows) > 10 else text(50).split()
            words[rng.randrange(len(words))] = "changed"
            body = " ".join(words)
        else:
            body = text(rng.choice([12, 80, 400]))
        rows.append((i, body, "en", f"src{i % 3}", len(body)))
        if i % 2 < 2:
            labels.append((i, int(kind != 0), int(kind == 1)))
    rows += [(500, rows[5][1], "en", "src1", 0), (501, None, None, None, None), (502, "", "fr", "src1", 0)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stored(stage(spark, docs, corpus), name)
        rows = docs.collect()
        seen[name] = before, rows
        if name != "packing":
            assert docs.columns == COLUMNS and len({r.doc_id for r in rows}) == len(rows)
    before, rows = seen["quality_classifier"]
    kept = {r.doc_id for r in rows}
    bad = {i for i, r in before.items() if i < 400 and i % 10 in (0, 1)}
    assert not kept & bad and {i for i in before if i not in bad and i % 10 != 3} <= kept
    before, rows = seen["quality_rules"]
    for i, r in before.items():
        n_words, _, _, _, n_repeat = plain_measures(r.text)
        if n_words < 10 or 100 * n_repeat > 20 * n_words:
            assert i not in {x.doc_id for x in rows}
    assert {r.doc_id for r in rows} == {
        r.doc_id for r in rules.ledger(spark.createDataFrame(list(before.values()), "doc_id long, text string, lang string, source string, n_chars long")).where(rules.passes("v1")).collect()}
    before, rows = seen["near_copies"]
    kept = {r.doc_id for r in rows}
    for i, r in before.items():
        near = [j for j, o in before.items() if j < i and (o.text == r.text or om.alike(o.text, r.text, 80))]
        assert (i in kept) == (not near)
    before, rows = seen["repeated_passages"]
    order = sorted(before)
    expected = [x[3].decode("utf-8", "ignore") for x in brute_repeats([before[i].text for i in order], 200)]
    assert {r.doc_id: (r.text, r.n_chars) for r in rows} == {i: (t, len(t)) for i, t in zip(order, expected)}
    assert any(len(t) < len(before[i].text) for i, t in zip(order, expected))
    before, rows = seen["packing"]
    assert Counter(r.doc_id for r in rows if r.piece == 0) == Counter(list(before))
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for content in bins.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= queries.CAPACITY


def test_run_and_empty(spark, corpus, tmp_path):
    assert corpus_pipeline.run(spark, corpus).count() > 0
    for name in ("documents", "labels"):
        spark.read.parquet(f"{corpus}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_extra_columns(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").selectExpr("*", "1 AS kept", "'x' AS n_words", "3 AS id", "4 AS row", "5 AS failures")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, corpus), name)
        assert docs.columns == [*COLUMNS, "kept", "n_words", "id", "row", "failures"]
        assert {r.n_words for r in docs.collect()} == {"x"}

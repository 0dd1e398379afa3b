"""The pair index against the tokenizers library."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from newsflow.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
HARD = [
    "", " ", "\n", "  ", "a  b", "a \tb", "a\t \tb", "x\n\n\ny", "\n a", " a\n", "don't 'll''s",
    "aaaaaaaaaaaaaaaaaaaaaaaa", "ab" * 50, "1234 5 67", "é ü ß Straße", "日本語 テキスト", "😀👍🏽",
    "a<|endoftext|>b <|endoftext|><|endoftext|> c", "  <|endoftext|>  ", "a b", "a\x85b c",
    "a\x1cb\x1d c", "　x  y", "é ́", "tab\tend\t", "end \n", "\r\n a\r\n",
    "==== ---- ####", "=" * 3000, " x" * 2000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_hard_texts(library):
    worker = bpe.Encoder(bpe.vocabulary(PATH))
    for texts in (HARD, HARD):
        for text, ids in zip(texts, worker.encode(texts)):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_random_texts(library):
    rng = random.Random(5)
    parts = ["the", "The", " ", "  ", "\n", "'s", "9", "42", "é", "ß", "!", "...", "<|endoftext|>", "\t",
             "aaaa", "日", "thing", " ", "ing", "(", "é"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(2000)]
    worker = bpe.Encoder(bpe.vocabulary(PATH))
    for text, ids in zip(texts, worker.encode(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_operator(spark, library):
    rows = [(i, t) for i, t in enumerate(HARD)] + [(None, "a b"), (900, None), (3, "again"), (3, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS decoded")
    out = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    expected = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((i, ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted(map(tuple, out), key=key) == sorted(expected, key=key)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(docs, PATH), PATH).count() == 0


def test_query(spark, sf_dir, library):
    from newsflow.llm.queries import op10_bpe

    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    rows = op10_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(text))

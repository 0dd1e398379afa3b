"""Shards: every document once, bytes near equal, slots gapless."""

import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from newsflow.llm import shards


def dims():
    return [F.log2(F.coalesce(F.octet_length("text"), F.lit(0)) + 8), shards.number_coordinate("doc_id")]


def check(rows, out, n_shards, most_off):
    assert sorted((i or -1, zlib.crc32((t or "").encode()), len((t or "").encode()) + 8) for i, t in rows) == sorted(
        (r.doc_id or -1, r.text_crc32, r.size) for r in out)
    slots, sizes = defaultdict(list), dict.fromkeys(range(n_shards), 0)
    for r in out:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert set(slots) <= set(range(n_shards))
    assert max(sizes.values()) - min(sizes.values()) <= most_off, sizes


@pytest.mark.parametrize("n_shards", [1, 5, 24])
def test_near_equal(spark, n_shards):
    rng = random.Random(1)
    rows = [(i, "x" * int(rng.paretovariate(1.2) * 40), rng.choice(["s0", "s0", "s0", "a", "bé"])) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = shards.assign(docs, n_shards, dims(), ["source"]).collect()
    longest = max(len(t) for _, t, _ in rows) + 8
    check([r[:2] for r in rows], out, n_shards, 2 * longest + sum(len(t) + 8 for _, t, _ in rows) * 0.005 / n_shards)


def test_all_alike(spark):
    rows = [(i, "same", "s") for i in range(480)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check([r[:2] for r in rows], shards.assign(docs, 24, dims(), ["source"]).collect(), 24, 24)


def test_edges(spark):
    rows = [(1, None, None), (1, None, None), (None, "", "a"), (2, "é" * 4000, "a"), (3, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr(
        "*", "1 AS size", "2 AS shard", "3 AS slot", "4 AS k0")
    out = shards.assign(docs, 24, dims(), ["source"])
    assert out.columns == ["doc_id", "size", "text_crc32", "shard", "slot"]
    check([r[:2] for r in rows], out.collect(), 24, 10**6)
    assert shards.assign(docs.limit(0), 24, dims(), ["source"]).count() == 0


def test_equal_rows_are_dealt_out(spark):
    rows = [(7, "again", "s")] * 2400 + [(i, "other", "s") for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check([r[:2] for r in rows], shards.assign(docs, 24, dims(), ["source"]).collect(), 24, 3 * 13)


def test_more_equal_rows_than_a_run(spark, monkeypatch):
    monkeypatch.setattr(shards, "RUN_ROWS", 7)
    rows = [(7, "again", "s")] * 100 + [(8, "other", "s")] * 14
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check([r[:2] for r in rows], shards.assign(docs, 4, dims(), ["source"]).collect(), 4, 3 * 13)


def test_texts_with_a_common_start_are_apart(spark):
    """The only dimension is a host: each shard is a range of hosts."""
    hosts = [f"https://{chr(97 + i % 26)}{i:03}.example/ü" for i in range(240)]
    rows = [(i * 10 + j, "x" * 92, h) for i, h in enumerate(hosts) for j in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = shards.assign(docs, 8, [], ["source"], slack=0.0)
    of = defaultdict(set)
    for r in out.collect():
        of[r.shard].add(hosts[r.doc_id // 10])
    order = sorted(hosts, key=lambda h: h.encode())
    assert [sorted(of[s]) for s in range(8)] == [sorted(order[30 * s : 30 * s + 30]) for s in range(8)]


def test_numbers_in_order_with_null_first(spark):
    inf = float("inf")
    rows = [(i, "x", n) for i, n in enumerate([3.0, None, -inf, -5.0, float("nan"), inf, 0.0, 9.0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n double")
    two = {r.doc_id: r.shard for r in shards.assign(docs, 2, [shards.number_coordinate("n")]).collect()}
    assert {two[1], two[4], two[2]} == {0} and two[5] == 1
    finite = docs.where("n IS NULL OR abs(n) < 100 OR isnan(n)")
    out = {r.doc_id: r.shard for r in shards.assign(finite, 3, [shards.number_coordinate("n")]).collect()}
    assert [out[i] for i in (3, 6)] == [1, 1] and [out[i] for i in (0, 7)] == [2, 2] and {out[1], out[4]} == {0}


def split(rows, first, n):
    """Plain recursion over (key, bytes) in order: shard of each key."""
    if n == 1 or not rows:
        return dict.fromkeys((k for k, _ in rows), first)
    target, under, at = sum(b for _, b in rows) * (n // 2) / n, 0, 0
    while under + rows[at][1] < target:
        under, at = under + rows[at][1], at + 1
    if under + rows[at][1] - target <= target - under:
        at += 1
    return {**split(rows[:at], first, n // 2), **split(rows[at:], first + n // 2, n - n // 2)}


@pytest.mark.parametrize("n_shards", [2, 7, 33])
def test_against_plain_recursion(spark, n_shards):
    rng = random.Random(n_shards)
    rows = [(i, "x" * int(rng.paretovariate(1.1) * 20)) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = shards.assign(docs, n_shards, [shards.number_coordinate("doc_id")], slack=0.0)
    assert {r.doc_id: r.shard for r in out.collect()} == split([(i, len(t) + 8) for i, t in rows], 0, n_shards)


def test_target_bytes(spark):
    rows = [(i, "x" * 92, "s") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = shards.assign(docs, None, dims(), ["source"], target_bytes=10_000).collect()
    check([r[:2] for r in rows], out, 10, 400)
    with pytest.raises(ValueError, match="n_shards or target_bytes"):
        shards.assign(docs, None, dims())


def test_query(spark, sf_dir):
    from newsflow.llm.queries import op3_kd_shards

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    out = op3_kd_shards(spark, sf_dir).collect()
    check(rows, out, 24, 3 * max(len(t.encode()) + 8 for _, t in rows))
    assert {r.law for r in out} == {"bytes"} and {r.grown_shard for r in out} == {None}

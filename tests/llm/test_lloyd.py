"""Dimension-sharded Lloyd against plain Python."""

import hashlib
import math
import random

import pytest

from newsflow.llm import lloyd as L

SCHEMA = "vec_id long, embedding array<double>, cluster string, id int"


def plain(rows, k, rounds, dims):
    ok = lambda v: v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)
    kept = [(i, [math.floor(64 * c) for c in v]) for i, v in rows if ok(v)]
    digest = lambda i: (i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "")
    centres = [x for _, x in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    far = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    assign = lambda: [min((far(x, c), j) for j, c in enumerate(centres)) for _, x in kept]
    for _ in range(rounds):
        found = assign()
        for j in range(len(centres)):
            own = [x for (_, x), (_, near) in zip(kept, found) if near == j]
            if own:
                centres[j] = [sum(column) // len(own) for column in zip(*own)]
    found = assign()
    return sorted((-1 if i is None else i, j, d) for (i, _), (d, j) in zip(kept, found)), centres


def result(found):
    return sorted((-1 if r.id is None else r.id, r.cluster, r.distance) for r in found.collect())


@pytest.mark.parametrize("dims,shards,k,n", [(8, 3, 5, 300), (5, 9, 4, 40), (1, 1, 16, 7), (12, 4, 16, 5000)])
def test_against_plain(spark, dims, shards, k, n):
    rng = random.Random(dims)
    rows = [(i, [rng.gauss(rng.choice([-1, 0, 2]), 0.3) for _ in range(dims)]) for i in range(n)]
    rows += [(3, rows[0][1]), (3, rows[0][1]), (None, rows[1][1]), (n + 1, None), (n + 2, [1.0] * (dims + 1)), (n + 3, []),
             (n + 4, [math.nan] * dims), (n + 5, [None] * dims), (n + 6, [-math.inf] * dims)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    found, clusters = L.lloyd(frame, k, 3, dims, shards)
    expected, centres = plain(rows, k, 3, dims)
    assert result(found) == expected
    table = sorted(clusters.collect())
    assert [list(r.centroid) for r in table] == centres
    for j, r in enumerate(table):
        assert r.cluster_inertia == sum(d for _, near, d in expected if near == j)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest()


def test_ties_and_empty_clusters(spark):
    rows = [(i, [0.0, 0.0]) for i in range(30)]
    found, clusters = L.lloyd(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), 4, 3, 2, 2)
    assert {(r.cluster, r.distance) for r in found.collect()} == {(0, 0)}
    assert [(list(r.centroid), r.cluster_inertia) for r in sorted(clusters.collect())] == [([0, 0], 0)] * 4


def test_no_rows_and_large_components(spark):
    empty = spark.createDataFrame([(1, None, "x", 1)], SCHEMA)
    found, clusters = L.lloyd(empty, dims=2)
    assert found.collect() == [] and clusters.collect() == []
    with pytest.raises(Exception, match="64 bits"):
        L.lloyd(spark.createDataFrame([(1, [1e30, 0.0], "x", 1)], SCHEMA), dims=2)[0].collect()


def test_rounds_leave_the_tiles_in_place(spark):
    tiled = L.bucketed(spark.range(100).selectExpr("id AS chunk", "0 AS shard"), "chunk", "tiles_test")
    # Too large to broadcast here, as it is at scale.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        side = spark.range(50).withColumnRenamed("id", "chunk")
        plan = tiled.join(side, "chunk")._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    physical = plan[plan.index("== Physical Plan =="):]
    assert physical.count("Exchange hashpartitioning") <= 1


@pytest.mark.parametrize("query", ["op13_dimension_lloyd"])
def test_query(spark, sf_dir, query):
    from newsflow.llm.registry import QUERIES
    import newsflow.llm.queries  # noqa: F401

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    expected, centres = plain(rows, 16, 3, 64)
    got = QUERIES[query](spark, sf_dir).collect()
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got) == expected
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    assert all(r.centroid_sha256 == digests[r.cluster] and r.inertia == sum(d for _, _, d in expected) for r in got)

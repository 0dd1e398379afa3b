"""The classifier: held-out accuracy, shrinkage against plain Python, and odd inputs."""

import math

from pyspark.sql import functions as F

from newsflow.llm import classifier

BAD = "quality = 0 OR toxic = 1"


def test_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2)))
    model = classifier.fit(docs, labels.where("half = 0"), F.expr(BAD))
    held = labels.where("half = 1").select("doc_id", F.expr(BAD).alias("bad"))
    rows = docs.join(F.broadcast(held), "doc_id")
    out = classifier.judge(rows, model, F.col("source"), F.col("lang"), keep=["doc_id", "bad"])
    counts = {(r["bad"], r["__kept"]): r["count"] for r in out.groupBy("bad", "__kept").count().collect()}
    good_lost = counts.get((False, False), 0) / (counts.get((False, False), 0) + counts[(False, True)])
    bad_kept = counts.get((True, True), 0) / (counts.get((True, True), 0) + counts[(True, False)])
    assert good_lost <= 0.005 and bad_kept <= 0.06, counts


def test_shrinkage(spark):
    model = classifier.Model({"bad": 6.0, "fine": -6.0}, -1.0, 0.3)
    rows = [(i, "bad" if i % (k + 2) == 0 else "fine", f"h{k}", f"p{i % 2}") for k in range(5) for i in range(4 * k + 1)]
    rows += [(900, None, None, None), (901, "", "h0", None), (902, "other words", "h1", "p0"), (902, "other words", "h1", "p0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, path string").selectExpr("*", "1 AS n", "2 AS own")
    out = classifier.judge(docs, model, F.col("host"), F.col("path")).collect()
    assert len(out) == len(rows) and set(docs.columns) <= set(out[0].asDict())
    logit = lambda x: math.log(x / (1 - x))
    own = {id(r): 1 / (1 + math.exp(-(r["__evidence"] + logit(0.3)))) for r in out}
    whole = sum(own.values()) / len(out)

    def moments(groups):
        n = sum(len(g) for g, _ in groups)
        rate = lambda g: sum(own[id(r)] for r in g) / len(g)
        chance = whole * (1 - whole)
        between = sum(len(g) * (rate(g) - above) ** 2 for g, above in groups) / n - chance * len(groups) / n
        return min(1e4, max(1.0, chance / between - 1)) if between > 0 else 1e4

    hosts, paths = {}, {}
    for r in out:
        hosts.setdefault(r.host, []).append(r)
        paths.setdefault((r.host, r.path), []).append(r)
    mean = lambda g: sum(own[id(r)] for r in g) / len(g)
    k_host = moments([(g, whole) for g in hosts.values()])
    k_path = moments([(g, mean(hosts[k[0]])) for k, g in paths.items()])
    for r in out:
        h, p, mine = hosts[r.host], paths[(r.host, r.path)], own[id(r)]
        host = (sum(own[id(x)] for x in h) - mine + k_host * whole) / (len(h) - 1 + k_host)
        path = (sum(own[id(x)] for x in p) - mine + k_path * host) / (len(p) - 1 + k_path)
        assert math.isclose(r["__host_rate"], host, rel_tol=1e-9) and math.isclose(r["__path_rate"], path, rel_tol=1e-9)
        path = min(0.999, max(0.001, path))
        assert math.isclose(r["__posterior"], 1 / (1 + math.exp(-(r["__evidence"] + logit(path)))), rel_tol=1e-9)
        assert r["__kept"] == (r["__posterior"] < 0.5)


def test_no_labels_and_empty(spark):
    docs = spark.createDataFrame([(1, "a", "h"), (None, None, None)], "doc_id long, text string, host string")
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (2, None, None)], "doc_id long, quality int, toxic int")
    model = classifier.fit(docs, labels, F.expr(BAD))
    assert model == classifier.Model()
    assert [r["__kept"] for r in classifier.judge(docs, model, F.col("host"), F.lit("x")).collect()] == [True, True]
    assert classifier.judge(docs.limit(0), model, F.col("host"), F.lit("x")).count() == 0


def test_features():
    assert {"stupid", "stup~", "stupi~"} <= classifier.features_of("A STUPID, thing!")
    model = classifier.Model({"stup~": 2.0, "thing": 1.0, "\x00marks>2": 0.5}, 0.0, 0.5)
    assert math.isclose(model.evidence("A STUPID, thing!"), 3.5)
    assert classifier.Model().evidence("x") == 0.0

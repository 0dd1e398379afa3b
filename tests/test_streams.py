from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from newsflow import streaming as M
from newsflow.operators.articles import new_articles
from newsflow.operators.trending import top_trends, trending
from newsflow.sinks import read_store
from newsflow.sources import default_site_catalog

NOW = datetime(2024, 1, 20)


def land(df, path, parts, order="doc_id"):
    """Write the rows as that many files, so that one file is one micro-batch."""
    for part in range(parts):
        df.where(F.col(order) % parts == part).coalesce(1).write.mode("append").parquet(path)


def read_stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", F.sha2("text", 256).alias("url"), F.col("source").alias("site_name"),
        F.col("source").alias("title"), F.col("text").alias("short_description"),
        F.lit("2024-01-19").cast("timestamp").alias("collected_at"),
    )


def keep(batches):
    def sink(batch, batch_id):
        batches.append((batch_id, batch.collect()))

    return sink


def test_dedup_equals_batch_and_splits_hot_keys(spark, documents, tmp_path):
    hot = documents.unionByName(
        spark.range(500, 900).select(
            F.col("id").alias("doc_id"), F.lit("hot").alias("url"), F.lit("s").alias("site_name"),
            F.lit("t").alias("title"), F.lit("d").alias("short_description"),
            F.lit("2024-01-19").cast("timestamp").alias("collected_at"),
        )
    ).unionByName(documents.withColumn("url", F.lit("")))
    land(hot, str(tmp_path / "in"), 3)
    M.use_rocksdb_state(spark)
    stream = M.stream_new_articles(read_stream(spark, str(tmp_path / "in"), hot.schema))
    assert stream.columns == hot.columns
    batches = []
    M.monitor(stream, keep(batches), str(tmp_path / "cp"), available_now=True).awaitTermination()
    got = [r["url"] for _, rows in batches for r in rows]
    expected = new_articles(hot, hot.limit(0), [F.col("doc_id")]).select("url").collect()
    assert sorted(got) == sorted(r["url"] for r in expected)


def test_trending_keeps_the_exact_top_and_survives_a_restart(spark, documents, tmp_path):
    source, top = str(tmp_path / "in"), str(tmp_path / "top")
    M.use_rocksdb_state(spark)
    for part in range(3):
        documents.where(F.col("doc_id") % 3 == part).coalesce(1).write.mode("append").parquet(source)
        counts = M.stream_trending(
            read_stream(spark, source, documents.schema), ["title", "short_description"], (2, 3)
        )
        query = M.monitor(
            counts, M.top_trends_sink(top, 7), str(tmp_path / "cp"), available_now=True,
            output_mode="update",
        )
        query.awaitTermination()
        so_far = documents.where(F.col("doc_id") % 3 <= part)
        full = top_trends(trending(so_far, ["title", "short_description"], (2, 3)), 7)
        newest = spark.read.parquet(f"{top}/batch_id={part}").orderBy(F.desc("cnt"), "phrase")
        assert newest.collect() == full.collect()


def test_running_counter_keeps_little_on_disk(spark, tmp_path, monkeypatch):
    """State files and changelogs are packed well, and each batch lets the shuffle files of those before it go."""
    from newsflow.streaming import loop

    M.use_rocksdb_state(spark)
    prefix = "spark.sql.streaming.stateStore"
    assert [spark.conf.get(f"{prefix}.{c}") for c in ("rocksdb.compression", "compression.codec")] == ["zstd", "zstd"]
    freed = []
    monkeypatch.setattr(loop, "free_shuffles", freed.append)
    sink = M.top_trends_sink(str(tmp_path), 2)
    for batch_id in range(2):
        sink(spark.createDataFrame([("a b", 9)], "phrase string, cnt bigint"), batch_id)
    assert freed == [spark, spark]


def test_unchanged_leader_stays_on_top(spark, tmp_path):
    sink = M.top_trends_sink(str(tmp_path), 2)
    schema = "phrase string, cnt bigint"
    sink(spark.createDataFrame([("a b", 9), ("c d", 3), ("e f", 1)], schema), 0)
    sink(spark.createDataFrame([("e f", 4), ("g h", 1)], schema), 1)
    # A repeated batch gives the same list again.
    sink(spark.createDataFrame([("e f", 4), ("g h", 1)], schema), 1)
    rows = spark.read.parquet(f"{tmp_path}/batch_id=1").orderBy(F.desc("cnt")).collect()
    assert [tuple(r) for r in rows] == [("a b", 9), ("e f", 4)]


def test_site_counts_equal_batch(spark, documents, tmp_path):
    land(documents, str(tmp_path / "in"), 3)
    stream = M.stream_site_counts(read_stream(spark, str(tmp_path / "in"), documents.schema))
    batches = []
    query = M.monitor(
        stream, keep(batches), str(tmp_path / "cp"), available_now=True, output_mode="update"
    )
    query.awaitTermination()
    got = {}
    for _, rows in sorted(batches):
        got.update({r["site_name"]: r["new_articles"] for r in rows})
    assert got == {r["site_name"]: r["count"] for r in documents.groupBy("site_name").count().collect()}


def test_window_counts(spark):
    df = spark.createDataFrame(
        [("a", datetime(2024, 1, 5, 10)), ("a", datetime(2024, 1, 6))], "phrase string, ts timestamp"
    )
    rows = M.stream_trending_window(df, "ts", length="2 days").collect()
    assert {(r["window_start"], r["cnt"]) for r in rows} == {
        (datetime(2024, 1, 4), 1), (datetime(2024, 1, 5), 2), (datetime(2024, 1, 6), 1),
    }


def test_late_rows_are_not_admitted(spark):
    df = spark.createDataFrame(
        [(1, NOW - timedelta(hours=12)), (2, NOW - timedelta(hours=13)), (3, None)],
        "id int, publish_time timestamp",
    )
    assert [r["id"] for r in M.admit_in_time(df, NOW).collect()] == [1]


def monitor_state(spark, root):
    schema = "url string, site_name string, collected_at timestamp"
    store = sorted(r["url"] for r in read_store(spark, f"{root}/store", schema=schema).collect())
    counters = spark.read.parquet(f"{root}/counters").groupBy().sum("fetched", "new_articles").first()
    return store, tuple(counters)


def test_monitor_sink_over_batches_restart_and_replay(spark, documents, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    articles = documents.drop("collected_at").withColumn(
        "error", F.when(F.col("doc_id") % 10 == 0, "broken")
    )
    sink = M.monitor_sink(root, default_site_catalog(spark), [F.col("doc_id")], as_of=NOW)
    for part in range(3):
        articles.where(F.col("doc_id") % 3 == part).coalesce(1).write.mode("append").parquet(source)
        # A new query on the same checkpoint: the restart after each batch.
        stream = read_stream(spark, source, articles.schema)
        M.monitor(stream, sink, checkpoint, available_now=True).awaitTermination()
    good = articles.where("error is null")
    store, counters = monitor_state(spark, root)
    assert store == sorted(r["url"] for r in good.select("url").distinct().collect())
    assert counters == (articles.count(), len(store))
    report = spark.read.json(f"{root}/report/batch_id=2").first()
    assert report["statistics"]["total_collected"] == articles.count()
    assert report["statistics"]["collected_last_24h"] == len(store)
    new_last = spark.read.parquet(f"{root}/store/batch_id=2").count()
    assert report["latest_run"]["new_articles"] == new_last

    # Replaying the last batch after a failure changes nothing.
    sink(articles.where(F.col("doc_id") % 3 == 2), 2)
    assert monitor_state(spark, root) == (store, counters)


def test_report_reads_a_maintained_top_list(spark, documents, tmp_path):
    top, root = str(tmp_path / "top"), str(tmp_path / "out")
    lists = M.top_trends_sink(top, 2)
    lists(spark.createDataFrame([("a b", 5), ("c d", 4), ("e f", 3)], "phrase string, cnt bigint"), 0)
    lists(spark.createDataFrame([("e f", 9)], "phrase string, cnt bigint"), 1)
    sink = M.monitor_sink(
        root, default_site_catalog(spark), [F.col("doc_id")], as_of=NOW, top_path=top
    )
    sink(documents.limit(20), 0)
    report = spark.read.json(f"{root}/report/batch_id=0").first()
    assert [(t["phrase"], t["count"]) for t in report["trending_topics"]] == [("e f", 9), ("a b", 5)]


def test_monitor_by_interval(spark, documents, tmp_path):
    land(documents, str(tmp_path / "in"), 1)
    batches = []
    stream = read_stream(spark, str(tmp_path / "in"), documents.schema)
    query = M.monitor(stream, keep(batches), str(tmp_path / "cp"), interval="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert len(batches[0][1]) == documents.count()

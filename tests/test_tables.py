from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from newsflow.operators import articles as A
from newsflow.operators import filters as L
from newsflow.operators import joins as J
from newsflow.operators import quality as Q
from newsflow.operators import ranking as R
from newsflow.operators.aggregates import (
    count_articles, monitor_report, run_totals, site_catalog_summary, site_counts,
)
from newsflow.sinks import read_store, append_to_store, write_archive, write_latest
from newsflow.sources import default_site_catalog, read_prior_results

NOW = datetime(2024, 1, 10, 12)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def timed(spark):
    return spark.createDataFrame(
        [("edge", NOW - timedelta(hours=12)), ("old", NOW - timedelta(hours=12, seconds=1)),
         ("future", NOW + timedelta(days=1)), ("null", None)],
        "link string, publish_time timestamp",
    )


def names(df, column="link"):
    return [r[column] for r in df.collect()]


def test_within(spark):
    assert sorted(names(L.within(timed(spark), "publish_time", "12h", NOW))) == ["edge", "future"]
    assert L.within(timed(spark), "absent", "12h", NOW).count() == 4


def test_within_reaches_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts")
    assert "GreaterThanOrEqual(ts" in plan(L.within(events, "ts", "12h", NOW))


def test_recent_counts_missing_as_2000(spark):
    df = timed(spark).withColumnRenamed("publish_time", "collected_at")
    assert "null" not in names(L.recent(df, "collected_at", 24, NOW))
    assert "null" in names(L.recent(df, "collected_at", 24 * 365 * 30, NOW))


def test_retain_is_inclusive(spark):
    df = timed(spark).withColumnRenamed("publish_time", "collected_at")
    assert sorted(names(A.retain(df, NOW, "12h"))) == ["edge", "future"]


def test_date_range(spark):
    df = timed(spark).select(F.col("link").alias("url"), F.col("publish_time").alias("lastmod"))
    assert L.date_range(df).count() == 4
    out = L.date_range(df, NOW - timedelta(hours=12), NOW)
    assert out.columns == ["url", "lastmod"] and names(out, "url") == ["edge"]


@pytest.mark.parametrize(
    ("order", "expected"),
    [("asc", ["old", "edge", "future", "null"]), ("desc", ["future", "edge", "old", "null"])],
)
def test_sort_by_time_nulls_last(spark, order, expected):
    assert names(R.sort_by_time(timed(spark), order=order)) == expected
    assert names(R.top_n(timed(spark), 2, order=order)) == expected[:2]


def test_top_n_without_time_is_feed_order(spark):
    df = spark.createDataFrame([("a", 2), ("a", 0), ("a", 1)], "feed_source string, pos int")
    assert names(R.top_n(df, 2), "pos") == [0, 1]


def test_equal_rows_are_spread_over_range_partitions(spark):
    same = spark.range(40_000).select(
        F.lit("k").alias("link"), F.lit(NOW).cast("timestamp").alias("publish_time")
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = R.sort_by_time(same).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 30_000


@pytest.mark.parametrize("n", [1, 3, 1500])
def test_first_per_key(spark, n):
    rows = [("hot", i) for i in range(3000)] + [("cold", i) for i in range(2)]
    df = spark.createDataFrame(rows, "feed_source string, pos int").repartition(4)
    out = R.top_n_per_feed(df, n)
    got = sorted((r["feed_source"], r["pos"]) for r in out.collect())
    assert got == sorted([("hot", i) for i in range(n)] + [("cold", i) for i in range(min(n, 2))])


def test_hot_keys_are_cut_in_the_map_tasks(spark):
    df = spark.range(100_000).select((F.col("id") % 2).alias("feed_source"), F.col("id").alias("pos"))
    once = [(True, False, False), (False, True, False), (False, False, True)]
    # Any n is cut in the map task; the rows left meet in groups of splits, then per key.
    for n in (5, 5000):
        text = plan(R.top_n_per_feed(df, n))
        limits = [line for line in text.splitlines() if "WindowGroupLimit" in line or "Exchange" in line]
        assert [("Final" in x, "Exchange" in x, "Partial" in x) for x in limits] == once * 2


def test_new_articles_is_idempotent(spark):
    batch = spark.createDataFrame(
        [("a", 2, "late"), ("a", 1, "first"), (None, 0, "none"), ("", 0, "blank"), ("b", 3, "b"),
         ("c", 4, "c")],
        "url string, pos int, title string",
    )
    store = spark.createDataFrame([("c", 0, "old")], batch.schema)
    fresh = A.new_articles(batch, store, [F.col("pos")])
    assert sorted((r["url"], r["title"]) for r in fresh.collect()) == [("a", "first"), ("b", "b")]
    again = A.new_articles(batch, store.unionByName(fresh), [F.col("pos")])
    assert again.count() == 0


def test_upsert_last_write_wins(spark):
    store = spark.createDataFrame(
        [("a", "old", NOW), ("b", "kept", NOW)], "url string, title string, collected_at timestamp"
    )
    batch = spark.createDataFrame([("a", "new"), ("c", "c"), (None, "x")], "url string, title string")
    later = NOW + timedelta(hours=1)
    out = A.upsert_articles(store, batch, later, [F.col("title")])
    assert sorted(tuple(r) for r in out.collect()) == [
        ("a", "new", later), ("b", "kept", NOW), ("c", "c", later),
    ]


def test_skip_and_reuse(spark):
    feed = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "link string")
    prior = spark.createDataFrame([("a", 2), ("a", 1), ("z", 3)], "link string, n int")
    assert sorted(map(str, names(J.skip_known(feed, prior)))) == ["None", "b"]
    cached, new = J.reuse_known(feed, prior)
    assert [tuple(r) for r in cached.collect()] == [("a", 1), ("a", 1)]
    assert sorted(map(str, names(new))) == ["None", "b"]


def test_overrides_and_sources(spark):
    sites = default_site_catalog(spark)
    overrides = spark.createDataFrame(
        [("plo", "https://new/1", NOW), ("plo", "https://new/2", NOW + timedelta(1)), ("nobody", "x", NOW)],
        "site string, sitemap_url string, updated_at timestamp",
    )
    changed = J.apply_overrides(sites, overrides)
    assert changed.columns == sites.columns and changed.count() == 10
    sources = J.resolve_sources(changed).collect()
    by_site = {}
    for row in sources:
        by_site.setdefault(row["site"], []).append(row["source_url"])
    assert by_site["plo"] == ["https://new/2"]
    assert len(by_site["cafebiz"]) == 5 and all(u.endswith(".rss") for u in by_site["cafebiz"])


def test_attach_selectors(spark):
    pages = spark.createDataFrame(
        [("https://www.plo.vn/a",), ("https://none.example/b",), ("no url",)], "url string"
    )
    out = J.attach_selectors(pages, J.site_hosts(default_site_catalog(spark))).collect()
    by_url = {r["url"]: r for r in out}
    assert by_url["https://www.plo.vn/a"]["site_name"] == "plo"
    assert by_url["https://www.plo.vn/a"]["selectors"]["content_selector"]["class"] == "article__body"
    assert by_url["https://none.example/b"]["error"] == "unknown site: none.example"
    assert by_url["no url"]["error"] == "unknown site: no host"


def test_only_a_small_dimension_is_broadcast(spark, monkeypatch):
    from newsflow.operators import skew
    from newsflow.session import is_small

    big = spark.range(1000).withColumnRenamed("id", "k")
    assert is_small(big, 1000) and not is_small(big, 999)
    left = spark.range(10).withColumnRenamed("id", "k")
    assert "ResolvedHint" in skew.join_dimension(left, big, "k", "inner")._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(skew, "is_small", lambda df: False)
    out = skew.join_dimension(left, big, "k", "inner")
    assert "ResolvedHint" not in out._jdf.queryExecution().analyzed().toString() and out.count() == 10


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, monkeypatch, how):
    from newsflow.operators import skew

    monkeypatch.setattr(skew, "HOT_ROWS", 20)
    monkeypatch.setattr(skew, "SAMPLE", 1.0)
    rows = [("hot", i) for i in range(60)] + [(None, i) for i in range(30)] + [("gone", i) for i in range(25)]
    rows += [(f"k{i}", i) for i in range(15)]
    left = spark.createDataFrame(rows, "url string, n int").repartition(8)
    right = spark.createDataFrame([("hot", "h"), ("k1", "a"), ("k2", "b"), ("z", "c")], "url string, v string")
    assert set(skew.hot_keys(left, "url")) == {"hot", None, "gone"}
    out = skew.join_unique(left, right, "url", how)
    plain = left.join(right, "url", how)
    assert out.columns == plain.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))


def test_hot_key_is_spread_over_tasks(spark, monkeypatch):
    from newsflow.operators import skew

    left = spark.range(0, 4000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("url")
    )
    right = spark.createDataFrame([("hot",)], "url string")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        tasks = {}
        for name, hot in (("plain", []), ("salted", ["hot"])):
            joined = skew.join_unique(left, right, "url", "left_semi", hot)
            tasks[name] = joined.groupBy(F.spark_partition_id().alias("p")).count().count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert tasks["plain"] == 1 and tasks["salted"] > 1


def test_validate_rows_reports_every_failure(spark):
    df = spark.createDataFrame(
        [(1, "ftp://a/b", "0", None), (2, "a/b", "x", {"k": "v"}), (3, " https://x.y/z ", "3", {"t": "", "k": ""})],
        "id int, url string, n string, config map<string,string>",
    )
    rules = [Q.valid_url("url"), Q.positive_int("n"), Q.required_keys("config", ["k", "t"])]
    found = {(r["row_key"], r["field"]): r["message"] for r in Q.validate_rows(df, "id", rules).collect()}
    assert found == {
        ("1", "url"): "URL must use HTTP or HTTPS", ("1", "n"): "n must be positive",
        ("1", "config"): "config is required", ("2", "url"): "invalid URL format",
        ("2", "n"): "n must be an integer", ("2", "config"): "missing keys: t",
    }
    assert [r["id"] for r in Q.clean_rows(df, rules).collect()] == [3]
    assert "Exchange" not in plan(Q.validate_rows(df, "id", rules))


def test_optional_rules(spark):
    df = spark.createDataFrame([(None, None)], "url string, n string")
    assert Q.clean_rows(df, [Q.valid_url("url", False), Q.positive_int("n", False)]).count() == 1
    assert Q.clean_rows(df, [Q.valid_url("url")]).count() == 0


def test_required_columns(spark):
    df = spark.range(1)
    assert Q.require_columns(df, ["id"]) is df
    with pytest.raises(ValueError, match="missing required columns: a"):
        Q.require_columns(df, ["id", "a"])
    with pytest.raises(ValueError, match="empty"):
        Q.require_columns(df.where("id > 5"), ["id"])


def test_known_sites(spark):
    df = spark.createDataFrame([(" PLO ",), ("x",)], "s string")
    sites = default_site_catalog(spark)
    assert names(Q.in_dimension(df, "s", sites, "site"), "s") == [" PLO "]
    assert names(Q.in_dimension(df, "s", sites, "site", known=False), "s") == ["x"]


def test_counts_and_report(spark):
    articles = spark.createDataFrame(
        [("plo", True), ("plo", False), ("cafef", True), ("other", True)], "site_name string, is_new boolean"
    )
    sites = default_site_catalog(spark)
    counts = {r["site_name"]: r["new_articles"] for r in site_counts(articles, sites).collect()}
    assert counts["plo"] == 1 and counts["dddn"] == 0 and len(counts) == 10
    assert tuple(run_totals(articles).first()) == (4, 3)
    trends = spark.createDataFrame([("b c", 2), ("a b", 2), ("z z", 9), ("x", 1)], "phrase string, cnt bigint")
    store = spark.createDataFrame([(NOW,), (NOW - timedelta(hours=25),), (None,)], "collected_at timestamp")
    report = monitor_report(count_articles(articles), store, trends, sites, NOW, top=3).first()
    assert report["statistics"]["total_collected"] == 4
    assert report["statistics"]["collected_last_24h"] == 1
    assert report["statistics"]["by_site"]["cafef"] == 1
    assert [(t["phrase"], t["count"]) for t in report["trending_topics"]] == [
        ("z z", 9), ("a b", 2), ("b c", 2),
    ]
    assert report["latest_run"]["new_articles"] == 3
    empty = monitor_report(
        count_articles(articles.limit(0)), store.limit(0), trends.limit(0), sites, NOW
    ).first()
    assert empty["statistics"]["total_collected"] == 0 and empty["trending_topics"] == []


def test_catalog_summary(spark):
    rows = {r["name"]: r for r in site_catalog_summary(default_site_catalog(spark)).collect()}
    assert rows["cafebiz"]["rss_count"] == 5 and rows["cafebiz"]["has_rss"]
    assert not rows["plo"]["has_rss"] and rows["plo"]["rss_count"] == 0
    assert len(rows["plo"]["selectors"]) == 5


def test_csv_latest_and_archive(spark, tmp_path):
    schema = "url string, markdown_content string, site_name string"
    first = spark.createDataFrame([("1", 'a "q"\n\nb,\\', "x"), ("2", None, "y"), ("3", "", "y")], schema)
    path = str(tmp_path / "latest")
    write_latest(first, path)
    write_latest(spark.createDataFrame([("4", "new", "x")], schema), path)
    write_latest(first.limit(0), path)
    got = {r["url"]: r["markdown_content"] for r in read_prior_results(spark, path, schema).collect()}
    assert got["4"] == "new" and got["2"] is None and set(got) == {"2", "3", "4"}
    archive = str(tmp_path / "archive")
    write_archive(first, archive, NOW, batch_id=7)
    write_archive(first, archive, NOW, batch_id=7)
    rows = read_prior_results(spark, archive, schema + ", archive_date string, run_hhmm string")
    assert rows.count() == 3
    again = {r["url"]: r["markdown_content"] for r in rows.collect()}
    assert again["1"] == 'a "q"\n\nb,\\'
    assert {(r["archive_date"], r["run_hhmm"]) for r in rows.collect()} == {("20240110", "1200")}


def test_store_batches_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "store")
    schema = "url string, title string, collected_at timestamp"
    assert read_store(spark, path, schema=schema).count() == 0
    for title in ("x", "y"):
        append_to_store(spark.createDataFrame([("a", title, NOW)], schema), path, 0)
    append_to_store(spark.createDataFrame([("b", "z", NOW)], schema), path, 1)
    assert sorted(r["title"] for r in read_store(spark, path, schema=schema).collect()) == ["y", "z"]
    assert read_store(spark, path, 1, schema).count() == 1


@pytest.mark.parametrize(
    ("fmt", "good", "bad"),
    [
        (None, ["2024-01-05", " 2024-1-5 ", "2024-02-29"], ["2023-02-29", "05/01/2024", "24-1-5", "2024-1-5 x"]),
        ("dd/MM/yyyy HH:mm", ["05/01/2024 07:30"], ["5/1/2024 07:30", "05/13/2024 07:30"]),
        ("d MMM yyyy", ["5 Jan 2024"], ["5 Foo 2024"]),
    ],
)
def test_date_format(spark, fmt, good, bad):
    df = spark.createDataFrame([(v,) for v in good + bad], "d string")
    rule = Q.date_format("d", fmt) if fmt else Q.date_format("d")
    assert names(Q.clean_rows(df, [rule]), "d") == good


def test_configure_sizes_shuffles(spark):
    from newsflow.session import configure

    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    configure(spark, shuffle_bytes=10 * 2**40)
    try:
        assert spark.conf.get(key) == str(10 * 2**40 // 2**28)
        configure(spark, shuffle_bytes=1)
        assert spark.conf.get(key) == spark.conf.get("spark.sql.shuffle.partitions")
    finally:
        spark.conf.unset(key)


def test_work_dir_is_below_the_checkpoint_folder(spark):
    from newsflow.session import work_dir

    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = work_dir(spark, "a"), work_dir(spark, "a")
    assert first != second
    assert base is None or first.startswith(base)


def site_table(spark, rows):
    from newsflow.schemas import SITES

    return spark.createDataFrame(
        [(n, m, False, {"title_selector": (n, None)}, (r, None) if r else None) for n, m, r in rows], SITES)


def test_sites_by_suffix_and_path(spark):
    sites = site_table(spark, [
        ("root", "https://www.a.example/sitemap.xml", []), ("deep", "https://x.a.example/s.xml", []),
        ("sport", "https://shared.example/sport/map.xml", []), ("football", "https://shared.example/sport/football/map.xml", []),
        ("rss only", "", ["https://r.example/feed/all.rss"]), ("twin b", "https://t.example/1.xml", []),
        ("twin a", "https://t.example/2.xml", []), ("none", "", []),
    ])
    urls = {
        "https://a.example/1": "root", "https://m.a.example/1": "root", "https://y.x.a.example/1": "deep", "https://x.a.example/": "deep",
        "https://shared.example/sport/1": "sport", "https://shared.example/sport/football/2024/1": "football",
        "https://shared.example/sports/1": "football", "https://m.shared.example/sport/1": "sport",
        "https://r.example/1": "rss only", "https://amp.r.example/feed/x": "rss only", "https://t.example/1": "twin a",
        "https://ba.example/1": None, "https://example/1": None, "no url": None, None: None,
    }
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    out = {r["url"]: r for r in J.attach_selectors(pages, J.site_places(sites)).collect()}
    # Of two folders that both miss, the host's first site by name is taken.
    assert {u: r["site_name"] for u, r in out.items()} == urls
    assert out["https://m.a.example/1"]["selectors"]["title_selector"]["tag"] == "root"
    assert out["https://ba.example/1"]["error"] == "unknown site: ba.example"


def test_rows_carry_their_site(spark):
    sites = site_table(spark, [
        ("a", "https://a.example/s.xml", ["https://feeds.example/a.rss"]), ("b", "https://b.example/s.xml", []),
    ])
    rows = [
        ("https://b.example/1", "https://feeds.example/a.rss", None), ("https://b.example/2", "other", None),
        ("https://b.example/3", "other", "a"), ("https://b.example/4", "https://a.example/s.xml", "unheard of"),
        ("https://c.example/5", None, None), (None, "https://a.example/s.xml", None),
    ]
    feed = spark.createDataFrame(rows, "link string, feed_source string, site_name string")
    found = {r.link and r.link[-1]: r.site_name for r in J.carry_site(feed, sites).collect()}
    assert found == {"1": "a", "2": "b", "3": "a", "4": "a", "5": None, None: "a"}
    assert J.carry_site(feed, sites.drop("rss")).count() == len(rows)


def test_the_pages_are_joined_once_for_many_sites(spark):
    from newsflow.plans import fetch_many_sites

    sites = site_table(spark, [(n, f"https://{n}.example/s.xml", []) for n in "abc"])
    schema = "link string, publish_time timestamp, feed_source string, feed_time timestamp, pos int"
    feeds = {n: spark.createDataFrame([(f"https://{n}.example/{i}", NOW - timedelta(hours=i), n, NOW, i) for i in range(4)], schema) for n in "abc"}
    pages = spark.createDataFrame(
        [(f"https://{n}.example/{i}", f"<a>{n}{i}</a><b>x</b><c>y</c>") for n in "abc" for i in range(4)], "url string, html string")
    out = fetch_many_sites(feeds, pages, sites, NOW, max_articles=2, time_frame=None, clean_content=False)
    assert sorted((r.url[-1], r.site_name, r.title) for r in out.collect()) == sorted(
        (str(i), n, {"a": f"a{i}".replace("a", "a", 1), "b": "x", "c": "y"}[n]) for n in "abc" for i in range(2))
    scans = out._jdf.queryExecution().optimizedPlan().toString().count("html#")
    assert scans and out._jdf.queryExecution().analyzed().toString().count("Generate") < 20

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from newsflow import sources as S
from newsflow.functions import month_shard_url, parse_publish_time, parse_time_frame
from newsflow.operators.articles import union_feeds
from newsflow.operators.normalize import normalize_feed, standardize_columns
from newsflow.plans import (
    feed_table, fetch_articles, fetch_many_sites, refresh_sitemaps, top_per_site,
)

RSS = (
    "<rss><channel><title>f</title>"
    "<item><title> A &amp; B </title><link>https://n.example/1</link><link>second</link>"
    "<description><![CDATA[<p>x</p> y]]></description>"
    "<pubDate>Mon, 01 Jan 2024 10:00:00 +0700</pubDate></item>"
    "<item><title>C</title><pubDate>soon</pubDate></item></channel></rss>"
)
SITEMAP = (
    "<urlset><url><loc>https://n.example/2</loc><lastmod>2024-01-01T08:00:00Z</lastmod></url>"
    "<url><loc>https://n.example/3</loc><lastmod>bad</lastmod></url></urlset>"
)


def payloads(spark, **by_source):
    return spark.createDataFrame(
        [(k.replace("_", "."), v) for k, v in by_source.items()],
        "feed_source string, payload string",
    )


def test_rss_items(spark):
    rows = S.read_rss_items(payloads(spark, a_rss=RSS, b_rss="<rss><bad")).orderBy("pos").collect()
    assert [r.asDict() for r in rows] == [
        {
            "feed_source": "a.rss", "pos": 0, "link": "https://n.example/1", "title": "A & B",
            "description": "x y", "publish_time": datetime(2024, 1, 1, 3),
        },
        {"feed_source": "a.rss", "pos": 1, "link": None, "title": "C", "description": None,
         "publish_time": None},
    ]
    html = S.read_rss_items(payloads(spark, a_rss=RSS), {"body": "description", "t": "title"})
    assert html.columns == ["feed_source", "pos", "body", "t"]


def test_rdf_items_beside_the_channel(spark):
    rdf = "<rdf><channel><title>f</title></channel><item><title>x</title></item></rdf>"
    assert S.read_rss_items(payloads(spark, a_rss=rdf)).first()["title"] == "x"


def test_empty_feed_keeps_the_schema(spark):
    items = S.read_rss_items(payloads(spark, a_rss="<rss><channel/></rss>"))
    assert items.columns == ["feed_source", "pos", "link", "title", "description", "publish_time"]
    assert items.count() == 0


def test_sitemap_urls(spark):
    rows = S.read_sitemap_urls(payloads(spark, s_xml=SITEMAP)).orderBy("pos").collect()
    assert [(r["url"], r["lastmod"]) for r in rows] == [
        ("https://n.example/2", datetime(2024, 1, 1, 8)), ("https://n.example/3", None),
    ]


def test_classify_and_errors(spark):
    df = spark.createDataFrame(
        [("/a.xml", "<rss>"), ("/a.rss", "<urlset>"), ("/f", " <channel>"), ("/s", "<urlset x>"),
         ("/n", "<html>"), ("/e", None)],
        "feed_source string, payload string",
    )
    kinds = S.classify_sources(df)
    assert [r["kind"] for r in kinds.collect()] == [
        "sitemap", "rss", "rss", "sitemap", "error", "error",
    ]
    errors = {r["feed_source"]: r["error"] for r in S.feed_errors(kinds).collect()}
    assert errors["/n"] == "unknown source format" and errors["/e"] == "empty payload"
    good = S.classify_sources(payloads(spark, a_rss=RSS, s_xml=SITEMAP))
    assert S.feed_errors(good).count() == 0


def test_latest_shard_is_numeric(spark):
    index = "<sitemapindex>{}</sitemapindex>".format(
        "".join(f"<sitemap><loc>https://n/post-sitemap{n}.xml</loc></sitemap>" for n in (9, 152, 20))
    )
    df = payloads(spark, i_xml=index, j_xml="<broken").withColumn("configured", F.lit("kept"))
    rows = S.latest_sitemap_shard(df, default_col="configured").collect()
    assert {r["feed_source"]: r["latest_url"] for r in rows} == {
        "i.xml": "https://n/post-sitemap152.xml", "j.xml": "kept",
    }


@pytest.mark.parametrize(
    ("text", "utc", "wallclock"),
    [
        ("Mon, 01 Jan 2024 10:00:00 +0700", (2024, 1, 1, 3), (2024, 1, 1, 10)),
        ("1 Jan 2024 10:00:00 GMT", (2024, 1, 1, 10), (2024, 1, 1, 10)),
        ("2024-01-01T10:00:00.5-02:30", (2024, 1, 1, 12, 30), (2024, 1, 1, 10)),
        ("2024-01-01T10:00:00Z", (2024, 1, 1, 10), (2024, 1, 1, 10)),
        ("2024-01-01", (2024, 1, 1), (2024, 1, 1)),
        ("2024-01-01 10:20", (2024, 1, 1, 10, 20), (2024, 1, 1, 10, 20)),
        ("31/01/2024 10:20", (2024, 1, 31, 10, 20), (2024, 1, 31, 10, 20)),
        ("2024-13-01", None, None), ("tomorrow", None, None), ("", None, None), (None, None, None),
    ],
)
def test_parse_publish_time(spark, text, utc, wallclock):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(
        parse_publish_time(F.col("t")), parse_publish_time(F.col("t"), "wallclock")
    ).first()
    assert tuple(row) == tuple(None if v is None else datetime(*v) for v in (utc, wallclock))


@pytest.mark.parametrize(("text", "seconds"), [("30m", 1800), (" 2D ", 172800), ("12h", 43200)])
def test_parse_time_frame(text, seconds):
    assert parse_time_frame(text).total_seconds() == seconds


@pytest.mark.parametrize("text", ["0h", "5w", "", None, "h", "-1d", "1.5h"])
def test_parse_time_frame_errors(text):
    with pytest.raises(ValueError):
        parse_time_frame(text)


@pytest.mark.parametrize(
    ("url", "as_of", "padded", "expected"),
    [
        ("news-2025-04.xml", datetime(2026, 12, 1), True, "news-2026-12.xml"),
        ("news-2025-4.xml", datetime(2026, 3, 1), False, "news-2026-3.xml"),
        ("sitemaps-2025-12.xml", datetime(2026, 3, 1), True, "sitemaps-2026-03.xml"),
        ("post-sitemap12.xml", datetime(2026, 3, 1), True, "post-sitemap12.xml"),
    ],
)
def test_month_shard_url(spark, url, as_of, padded, expected):
    got = spark.range(1).select(month_shard_url(F.lit(url), as_of, F.lit(padded))).first()[0]
    assert got == expected


def test_standardize_coalesces_aliases(spark):
    df = spark.createDataFrame([("a", None, 1), (None, "b", 2)], "url string, loc string, n int")
    out = normalize_feed(df)
    assert out.columns == ["link", "n"] and [r["link"] for r in out.collect()] == ["a", "b"]
    both = standardize_columns(df, {"url": ["loc"]})
    assert [r["url"] for r in both.collect()] == ["a", "b"]


def test_union_feeds_has_one_set_of_columns(spark):
    rss = S.read_rss_items(payloads(spark, a_rss=RSS))
    sitemap = S.read_sitemap_urls(payloads(spark, s_xml=SITEMAP))
    out = union_feeds(rss, sitemap)
    assert sorted(out.columns) == sorted(
        ["feed_source", "pos", "link", "title", "description", "publish_time"]
    )
    assert out.count() == 4


def test_stopwords(spark, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_text("# comment\n The \nthe\n\n #kept\nhai ba\nvà\n", encoding="utf-8")
    words = lambda file: sorted(r.word for r in S.read_stopwords(spark, str(file)).collect())
    assert words(path) == ["the", "và"]
    assert words(tmp_path / "absent.txt") == []


def test_catalog(spark, tmp_path):
    sites = S.default_site_catalog(spark)
    assert sites.count() == 10
    sites.write.json(str(tmp_path / "sites"))
    again = S.read_site_catalog(spark, str(tmp_path / "sites"))
    assert sorted(r["site"] for r in again.collect()) == sorted(r["site"] for r in sites.collect())


def test_rss_files(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<?xml version="1.0"?>' + RSS)
    rows = S.read_rss_files(spark, str(tmp_path)).orderBy("title").collect()
    assert [r["link"] for r in rows] == ["https://n.example/1", None]
    assert rows[0]["feed_source"].endswith("a.xml")


def test_prior_results_absent(spark, tmp_path):
    prior = S.read_prior_results(spark, str(tmp_path / "none"))
    assert prior.count() == 0 and "url" in prior.columns


@pytest.fixture
def corpus(spark):
    from newsflow.schemas import PAGES, SITES

    selector = {
        "title_selector": ("h1", None), "short_desc_selector": (None, "sapo"),
        "content_selector": ("div", "body"),
    }
    sites = spark.createDataFrame(
        [("example", "https://www.n.example/sitemap.xml", False, selector, None)], SITES
    )
    html = '<h1>news {0} | S</h1><p class="sapo">s{0}</p><div class="body">b{0}</div>'
    pages = spark.createDataFrame(
        [(f"https://n.example/{i}", html.format(i)) for i in (1, 2, 2, 3)]
        + [("https://other.example/9", "<h1>x</h1>")],
        PAGES,
    )
    feed = feed_table(payloads(spark, a_rss=RSS, s_xml=SITEMAP), datetime(2024, 1, 1, 9))
    return feed, pages, sites


def test_fetch_articles(spark, corpus):
    feed, pages, sites = corpus
    extra = spark.createDataFrame(
        [("https://other.example/9", datetime(2024, 1, 1, 7)), ("https://n.example/7", datetime(2024, 1, 1, 6))],
        "link string, publish_time timestamp",
    )
    feed = feed.unionByName(extra, allowMissingColumns=True)
    rows = fetch_articles(feed, pages, sites, datetime(2024, 1, 1, 12), time_frame="12h").collect()
    by_url = {r["url"]: r for r in rows}
    assert len(rows) == 4
    assert by_url["https://n.example/1"]["title"] == "News 1"
    assert by_url["https://n.example/2"]["markdown_content"] == "b2"
    assert by_url["https://n.example/2"]["feed_source"] == "s.xml"
    assert by_url["https://other.example/9"]["error"] == "unknown site: other.example"
    assert by_url["https://n.example/7"]["error"] == "page not landed"


def test_fetch_articles_with_earlier_results(spark, corpus):
    feed, pages, sites = corpus
    prior = spark.createDataFrame(
        [("https://n.example/1", "Old")], "url string, title string"
    )
    options = dict(as_of=datetime(2024, 1, 1, 12), time_frame="12h", prior=prior)
    skipped = fetch_articles(feed, pages, sites, **options).collect()
    assert [r["url"] for r in skipped] == ["https://n.example/2"]
    reused = fetch_articles(feed, pages, sites, reuse_prior=True, **options).collect()
    assert sorted((r["url"], r["title"]) for r in reused) == [
        ("https://n.example/1", "Old"), ("https://n.example/2", "News 2"),
    ]


def test_fetch_top_and_many_sites(spark, corpus):
    feed, pages, sites = corpus
    out = fetch_many_sites(
        {"example": feed}, pages, sites, datetime(2024, 1, 1, 12), max_articles=1, time_frame=None
    ).collect()
    assert [(r["url"], r["site_name"]) for r in out] == [("https://n.example/2", "example")]


def test_refresh_sitemaps(spark):
    sites = S.default_site_catalog(spark)
    index = payloads(spark, ktsg="<i><sitemap><loc>https://t/post-sitemap160.xml</loc></sitemap></i>")
    rows = refresh_sitemaps(sites, datetime(2026, 3, 2), index).collect()
    assert {r["site"]: r["sitemap_url"] for r in rows} == {
        "plo": "https://plo.vn/sitemaps/news-2026-03.xml",
        "tuoitre": "https://tuoitre.vn/StaticSitemaps/sitemaps-2026-03.xml",
        "baodautu": "https://baodautu.vn/sitemaps/news-2026-3.xml",
        "ktsg": "https://t/post-sitemap160.xml",
    }
    assert refresh_sitemaps(sites, datetime(2025, 4, 2)).count() == 0


def test_top_per_site(spark):
    rows = [(f"https://{h}/{i}", datetime(2024, 1, 1, i)) for h in ("www.a.x", "b.x") for i in range(5)]
    rows.append(("https://a.x/none", None))
    feed = spark.createDataFrame(rows, "link string, publish_time timestamp")
    got = sorted(r["link"] for r in top_per_site(feed, 2).collect())
    assert got == ["https://b.x/3", "https://b.x/4", "https://www.a.x/3", "https://www.a.x/4"]


def test_collection_run(spark, corpus, tmp_path):
    from newsflow.sinks import read_store
    from newsflow.streaming import collection_sink

    _, pages, sites = corpus
    sink = collection_sink(str(tmp_path), pages, sites, as_of=datetime(2024, 1, 1, 12))
    schema = "url string, title string, collected_at timestamp"
    sink(payloads(spark, a_rss=RSS), 0)
    assert [r["url"] for r in read_store(spark, f"{tmp_path}/store", schema=schema).collect()] == [
        "https://n.example/1"
    ]
    for _ in range(2):  # the second time is the replay of the same batch
        sink(payloads(spark, a_rss=RSS, s_xml=SITEMAP, bad_rss="<rss"), 1)
        rows = read_store(spark, f"{tmp_path}/store", schema=schema).orderBy("url").collect()
        assert [(r["url"], r["title"]) for r in rows] == [
            ("https://n.example/1", "News 1"), ("https://n.example/2", "News 2"),
        ]
    report = spark.read.json(f"{tmp_path}/report/batch_id=1").first()
    assert report["latest_run"]["new_articles"] == 1
    assert report["statistics"]["by_site"]["example"] == 2


def test_html_names_do_not_lose_a_feed(spark):
    payload = ("<rss><channel><item><title>A&nbsp;B &eacute; &amp; &nosuch</title><link>u</link>"
               "<description><![CDATA[x&nbsp;<b>y</b>]]></description></item></channel></rss>")
    df = spark.createDataFrame([("f", payload.replace(" &nosuch", ""))], "feed_source string, payload string")
    row = S.read_rss_items(df, description_format="html").first()
    assert row["title"] == "A\u00a0B é &" and row["description"] == "x&nbsp;<b>y</b>"


def test_newest_page_of_a_folder(spark, tmp_path):
    """By the time a page landed, else by the time its file was written."""
    from newsflow.plans.articles import landed_pages

    path = str(tmp_path / "pages")
    timed = "url string, html string, landed_at timestamp, other int"
    old, new = datetime(2024, 1, 1), datetime(2024, 1, 2)
    spark.createDataFrame([("a", "newer", new, 1), ("b", "old", old, 1)], timed).write.mode("append").parquet(path)
    spark.createDataFrame([("a", "older", old, 1)], timed).write.mode("append").parquet(path)
    spark.createDataFrame([("b", "file time", None, 1)], timed).write.mode("append").parquet(path)
    spark.createDataFrame([("c", "untimed")], "url string, html string").write.mode("append").parquet(path)
    feed = spark.createDataFrame([("a",), ("b",), ("c",), ("a",), (None,)], "link string")
    got = {r.url: r.html for r in landed_pages(feed, S.read_pages(spark, path)).collect()}
    assert got == {"a": "newer", "b": "file time", "c": "untimed"}


def titles_and_links(spark, payload):
    items = S.read_rss_items(payloads(spark, a_rss=payload), {"title": "title", "link": "link"})
    return [(r["title"], r["link"]) for r in items.orderBy("pos").collect()]


@pytest.mark.parametrize("payload, expected", [
    # Well-formed: below an extra element, tags and CDATA inside a title, a tag below another.
    ("<rss><channel><part><item><title>a</title></item></part><item><title>b</title></item></channel></rss>",
     [("a", None), ("b", None)]),
    ("<rss><channel><item><title>A <b>bold</b> c</title><link>l</link></item></channel></rss>", [("A bold c", "l")]),
    ("<rss><channel><item><title><![CDATA[x <i>y</i>]]> <b>z</b></title></item></channel></rss>", [("x <i>y</i> z", None)]),
    ("<rss><channel><item><image><title>i</title></image><title>t</title></item></channel></rss>", [("i", None)]),
    ("<feed><item n='>'><title>a<!-- <b>no</b> --> b</title></item></feed>", [("a b", None)]),
    # Damaged: bare ampersand, element left open, item left open, payload cut off, end tag too many.
    ("<rss><channel><item><title>a & b &nbsp;&#233;</title></item></channel></rss>", [("a & b \xa0é", None)]),
    ("<rss><channel><item><title>a <i>b</title><link>l</link></item></channel></rss>", [("a b", "l")]),
    ("<rss><channel><item><title>a</title><item><title>b</title><link>l</link></item></channel></rss>",
     [("a", None), ("b", "l")]),
    ("<rss><channel><item><title>a</title></item><item><title>b", [("a", None), ("b", None)]),
    ("<rss><channel><item><title>a</b> < c</title><link>l</link></item></channel></rss>", [("a < c", "l")]),
    ("<rss><channel><item><title>a</title><link/></item><item/></channel>", [("a", ""), (None, None)]),
    ("no feed", []), ("", []), ("<item", []),
])
def test_tolerant_items(spark, payload, expected):
    assert titles_and_links(spark, payload) == expected


def test_scanner_reads_good_feeds_as_the_parser_does(spark):
    """Everything that well-formed feeds of plain items hold comes out alike, and only misread feeds are scanned."""
    from newsflow.sources import feeds
    from newsflow.sources.rss_scan import scan_items

    good = RSS.replace("C</title>", "&lt;C&#x41; <![CDATA[d&amp;]]></title><guid a=\"/\">g</guid>")
    rows = feeds._with_rss_items(payloads(spark, a_rss=good), F.col("payload"), feeds.RSS_MAPPING).first()["__items"]
    plain = [{k: v[:1] for k, v in r.asDict().items() if v} for r in rows]
    own = [{k: [v[0].strip()] for k, v in item.items()} for item in scan_items(good, list(feeds.RSS_MAPPING.values()))]
    assert [{k: [v[0].strip()] for k, v in item.items()} for item in plain] == own
    assert len(rows[0]["link"]) == 2  # parsed, not scanned


def test_scanner_time_is_linear():
    from time import perf_counter

    from newsflow.sources.rss_scan import scan_items

    for part in ("<item><title>", "<title a=\"", "</b>", "<b>", "& <", "<item>x</item>", "<![CDATA["):
        began = perf_counter()
        scan_items("<item>" + part * 50_000, ["title", "link"])
        assert perf_counter() - began < 10


def test_errors_name_damaged_feeds_and_those_without_items(spark):
    df = payloads(
        spark, a_rss="<rss><channel><item><title>a & b</title>", b_rss="<rss><channel></channel></rss>",
        c_rss="<rss><channel><part><item><title>a</title></item></part></channel></rss>")
    errors = S.feed_errors(S.classify_sources(df))
    assert errors.columns == ["feed_source", "payload", "kind", "error"]
    assert sorted(r["feed_source"] for r in errors.collect()) == ["a.rss", "b.rss"]

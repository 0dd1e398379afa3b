"""Joins, the article table, counters and summaries."""

from datetime import datetime

from pyspark.sql import functions as F

from checks.phrases import SQL_TOP
from checks.registry import check, table, texts
from newsflow.operators.aggregates import (
    count_articles,
    monitor_report,
    run_totals,
    site_catalog_summary,
    site_counts,
)
from newsflow.operators.articles import new_articles, retain, upsert_articles
from newsflow.operators.joins import (
    apply_overrides,
    attach_selectors,
    carry_site,
    lookup,
    resolve_sources,
    reuse_known,
    site_hosts,
    skip_known,
    url_host,
)
from newsflow.operators.trending import trending
from newsflow.plans import top_per_site
from newsflow.schemas import SELECTOR_MAP
from newsflow.session import work_dir
from newsflow.sinks import write_archive, write_latest, write_report
from newsflow.sources import read_prior_results


def _text_key(c):
    return c.cast("string")


def _feed(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        _text_key(F.col("doc_id")).alias("link"), "source", "n_chars"
    )


@check("skip_known", """
    SELECT CAST(doc_id AS VARCHAR) AS link, source, n_chars FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def q_skip_known(spark, sf_dir):
    prior = table(spark, sf_dir, "labels").select(_text_key(F.col("doc_id")).alias("link"))
    return skip_known(_feed(spark, sf_dir), prior)


@check("reuse_known", """
    SELECT CAST(d.doc_id AS VARCHAR) AS link, l.quality, 'cached' AS origin
    FROM documents d JOIN labels l USING (doc_id) UNION ALL
    SELECT CAST(doc_id AS VARCHAR), NULL, 'new' FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def q_reuse_known(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select(
        _text_key(F.col("doc_id")).alias("link"), "quality", F.lit(1).alias("seen")
    )
    # Earlier results may hold a key twice; the first one counts.
    prior = labels.unionByName(labels.withColumns({"quality": F.lit(9), "seen": F.lit(2)}))
    cached, new = reuse_known(_feed(spark, sf_dir), prior, prior_order=["seen"])
    return cached.select("link", "quality", F.lit("cached").alias("origin")).unionByName(
        new.select("link", F.lit("new").alias("origin")), allowMissingColumns=True
    )


def nation_sites(spark, sf_dir):
    """Nations as sites: a third with RSS, a third with a sitemap only, a third with neither."""
    key = F.col("n_nationkey") % 3
    base = F.concat(F.lit("https://"), F.lower(F.regexp_replace("n_name", " ", "-")), F.lit(".example/"))
    selector = F.create_map(
        F.lit("title_selector"),
        F.struct(F.lit("title").alias("tag"), F.lit(None).cast("string").alias("class")),
        F.lit("content_selector"), F.struct(F.lit("div").alias("tag"), F.lit("ad").alias("class")),
    ).cast(SELECTOR_MAP)
    rss = F.struct(
        F.when(key == 0, F.array(F.concat(base, F.lit("a.rss")), F.concat(base, F.lit("b.rss"))))
        .otherwise(F.array().cast("array<string>")).alias("urls"),
        F.lit(None).cast("map<string,string>").alias("mapping"),
    )
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("site"),
        F.when(key < 2, F.concat(base, F.lit("sitemap.xml"))).otherwise("").alias("sitemap_url"),
        F.lit(False).alias("zero_pad"),
        selector.alias("config"),
        F.when(key != 1, rss).alias("rss"),
    )


SQL_SITES = """
    SELECT n_name AS site, n_nationkey % 3 AS k,
      'https://' || lower(replace(n_name, ' ', '-')) || '.example/' AS base FROM nation"""


@check("apply_overrides", f"""
    SELECT s.site, CASE WHEN o.s_nationkey IS NOT NULL THEN 'https://new.example/' || o.last
        WHEN k < 2 THEN base || 'sitemap.xml' ELSE '' END AS sitemap_url
    FROM ({SQL_SITES}) s JOIN nation n ON n.n_name = s.site LEFT JOIN
      (SELECT s_nationkey, max(s_suppkey) AS last FROM supplier
       GROUP BY s_nationkey) o ON o.s_nationkey = n.n_nationkey AND n.n_nationkey % 2 = 0""")
def q_apply_overrides(spark, sf_dir):
    key = F.col("s_suppkey")
    names = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    overrides = (
        table(spark, sf_dir, "supplier")
        .join(names, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            # Every second site's overrides name a site that the catalogue does not have.
            F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name"))
            .otherwise(F.concat(F.lit("other "), "n_name")).alias("site"),
            F.concat(F.lit("https://new.example/"), key.cast("string")).alias("sitemap_url"),
            F.timestamp_seconds(key).alias("updated_at"),
        )
    )
    unknown = overrides.withColumn("site", F.concat(F.lit("not "), "site"))
    sites = apply_overrides(nation_sites(spark, sf_dir), overrides.unionByName(unknown))
    return sites.select("site", "sitemap_url")


@check("resolve_sources", f"""
    SELECT site, base || 'a.rss' AS source_url FROM ({SQL_SITES}) WHERE k = 0 UNION ALL
    SELECT site, base || 'b.rss' FROM ({SQL_SITES}) WHERE k = 0 UNION ALL
    SELECT site, base || 'sitemap.xml' FROM ({SQL_SITES}) WHERE k = 1""")
def q_resolve_sources(spark, sf_dir):
    return resolve_sources(nation_sites(spark, sf_dir))


@check("site_catalog_summary", f"""
    SELECT site AS name, k < 2 AS has_sitemap, k = 0 AS has_rss,
      CASE WHEN k = 0 THEN 2 ELSE 0 END AS rss_count, 'title_selector,content_selector' AS selectors
    FROM ({SQL_SITES})""")
def q_site_catalog_summary(spark, sf_dir):
    summary = site_catalog_summary(nation_sites(spark, sf_dir))
    return summary.withColumn("selectors", F.array_join("selectors", ","))


SQL_HOST = "regexp_replace(regexp_extract(url, '^https?://([^/?#:]+)', 1), '^www\\.', '')"


def page_sites(spark, sf_dir):
    """A site per host that ends in .com, with selectors for the parts every page has."""
    hosts = (
        table(spark, sf_dir, "pages").select(url_host(F.col("url")).alias("host")).distinct()
        .where(F.col("host").endswith(".com"))
    )

    def selector(tag, cls=None):
        return F.struct(F.lit(tag).alias("tag"), F.lit(cls).cast("string").alias("class"))

    config = F.create_map(
        F.lit("title_selector"), selector("title"), F.lit("short_desc_selector"), selector("h1"),
        F.lit("author_selector"), selector("article"),
        F.lit("content_selector"), selector("div", "ad"),
    ).cast(SELECTOR_MAP)
    return hosts.select(
        F.concat(F.lit("site "), "host").alias("site"),
        F.concat(F.lit("https://www."), "host", F.lit("/sitemap.xml")).alias("sitemap_url"),
        config.alias("config"),
    )


@check("attach_selectors", f"""
    SELECT url, CASE WHEN {SQL_HOST} LIKE '%.com' THEN 'site ' || {SQL_HOST} END AS site_name,
      CASE WHEN {SQL_HOST} LIKE '%.com' THEN 4 END AS n_selectors,
      CASE WHEN {SQL_HOST} NOT LIKE '%.com' THEN 'unknown site: ' || {SQL_HOST} END AS error
    FROM pages""")
def q_attach_selectors(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("url")
    attached = attach_selectors(pages, site_hosts(page_sites(spark, sf_dir)))
    return attached.select(
        "url", "site_name", F.size("selectors").cast("int").alias("n_selectors"), "error"
    )


def placed_sites(spark, sf_dir):
    """Nations as sites: a third has RSS alone, a third shares a host and has a folder each, a third has a
    subdomain."""
    key, name = F.col("n_nationkey") % 3, F.lower(F.regexp_replace("n_name", "[ _]", "-"))
    sitemap = (
        F.when(key == 1, F.concat(F.lit("https://www.shared.example/"), name, F.lit("/sitemap.xml")))
        .when(key == 2, F.concat(F.lit("https://news."), name, F.lit(".example/sitemap.xml"))).otherwise("")
    )
    rss = F.struct(
        F.when(key == 0, F.array(F.concat(F.lit("https://"), name, F.lit(".example/feeds/a.rss"))))
        .otherwise(F.array().cast("array<string>")).alias("urls"),
        F.lit(None).cast("map<string,string>").alias("mapping"))
    return nation_sites(spark, sf_dir).select("site", "config").join(
        table(spark, sf_dir, "nation").select(F.col("n_name").alias("site"), sitemap.alias("sitemap_url"), rss.alias("rss")),
        "site")


def supplier_feed(spark, sf_dir):
    """A feed row per supplier; every fifth comes from the RSS of its site and links elsewhere."""
    key, name = F.col("n_nationkey") % 3, F.lower(F.regexp_replace("n_name", "[ _]", "-"))
    number = F.col("s_suppkey")
    url = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    link = (
        F.when(number % 5 == 0, url("https://elsewhere.test/", number))
        .when(key == 0, url("https://m.", name, ".example/s/", number))
        .when(key == 1, url("https://shared.example/", name, "/2024/", number, ".html"))
        .when(number % 2 == 0, url("https://live.news.", name, ".example/", number))
        .otherwise(url("https://", name, ".example/", number)))
    source = F.when(number % 5 == 0, url("https://", name, ".example/feeds/a.rss")).otherwise("https://other.test/a.rss")
    return table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).select(link.alias("link"), source.alias("feed_source"), number.alias("pos"),
             F.timestamp_seconds(number).alias("publish_time"))


SQL_SUPPLIER_FEED = """
    SELECT s_suppkey AS pos, CASE WHEN s_suppkey % 5 = 0 THEN 'https://elsewhere.test/' || s_suppkey
        WHEN k = 0 THEN 'https://m.' || nm || '.example/s/' || s_suppkey
        WHEN k = 1 THEN 'https://shared.example/' || nm || '/2024/' || s_suppkey || '.html'
        WHEN s_suppkey % 2 = 0 THEN 'https://live.news.' || nm || '.example/' || s_suppkey
        ELSE 'https://' || nm || '.example/' || s_suppkey END AS link,
      CASE WHEN s_suppkey % 5 = 0 THEN CASE WHEN k = 0 THEN n_name END
        WHEN k < 2 OR s_suppkey % 2 = 0 THEN n_name END AS site_name
    FROM supplier JOIN (SELECT *, n_nationkey % 3 AS k, lower(replace(replace(n_name, ' ', '-'), '_', '-')) AS nm FROM nation)
      ON s_nationkey = n_nationkey"""


@check("site_feeds", SQL_SUPPLIER_FEED)
def q_site_feeds(spark, sf_dir):
    """Feed rows with their site: by the source of the feed, by host suffix, by folder on a shared host."""
    feed = carry_site(supplier_feed(spark, sf_dir), placed_sites(spark, sf_dir))
    return feed.select("pos", "link", "site_name")


@check("top_per_site", f"""
    SELECT pos, site_name FROM ({SQL_SUPPLIER_FEED}) QUALIFY row_number() OVER (PARTITION BY
      coalesce(site_name, regexp_extract(link, '^https://([^/]+)', 1)) ORDER BY pos DESC) <= 2""")
def q_top_per_site(spark, sf_dir):
    feed = carry_site(supplier_feed(spark, sf_dir), placed_sites(spark, sf_dir))
    return top_per_site(feed, 2).select("pos", "site_name")


@check("lookup", """
    SELECT 'd/' || doc_id AS url, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
    UNION ALL SELECT 'd/7', source FROM documents WHERE doc_id = 7""")
def q_lookup(spark, sf_dir):
    url = F.concat(F.lit("d/"), F.col("doc_id").cast("string")).alias("url")
    store = table(spark, sf_dir, "documents").select(url, "source")
    many = lookup(store, table(spark, sf_dir, "labels").select(url))
    return many.unionByName(lookup(store, ["d/7", "d/none"]))


def content_articles(spark, sf_dir, *columns):
    """Documents keyed by content, so that exact copies share a URL."""
    docs = texts(spark, sf_dir, "documents", "doc_id", "text", "source", "n_chars")
    url = F.concat(F.lit("https://n.example/"), F.sha2("text", 256)).alias("url")
    return docs.select("doc_id", url, *columns)


SQL_CONTENT = "SELECT *, 'https://n.example/' || sha256(text) AS url FROM documents"


@check("new_articles", f"""
    SELECT url, min(doc_id) AS doc_id FROM ({SQL_CONTENT}) GROUP BY url
    HAVING url NOT IN (SELECT url FROM ({SQL_CONTENT}) WHERE doc_id IN (SELECT doc_id FROM labels))""")
def q_new_articles(spark, sf_dir):
    articles = content_articles(spark, sf_dir)
    store = articles.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    blank = articles.withColumn("url", F.lit(""))
    return new_articles(articles.unionByName(blank), store, [F.col("doc_id")]).select("url", "doc_id")


@check("upsert_articles", f"""
    WITH c AS ({SQL_CONTENT}), batch AS (
      SELECT url, max(doc_id) AS doc_id, '2024-02-01 00:00:00' AS collected_at FROM c
      WHERE doc_id % 3 = 0 GROUP BY url),
    store AS (SELECT url, min(doc_id) AS doc_id, '2024-01-01 00:00:00' AS collected_at FROM c
      WHERE doc_id % 3 <> 0 GROUP BY url)
    SELECT * FROM batch UNION ALL SELECT * FROM store WHERE url NOT IN (SELECT url FROM batch)""")
def q_upsert_articles(spark, sf_dir):
    articles = content_articles(spark, sf_dir)
    store = (
        articles.where("doc_id % 3 <> 0").groupBy("url").agg(F.min("doc_id").alias("doc_id"))
        .withColumn("collected_at", F.lit("2024-01-01").cast("timestamp"))
    )
    batch = articles.where("doc_id % 3 = 0")
    merged = upsert_articles(store, batch, datetime(2024, 2, 1), [F.col("doc_id").desc()])
    return merged.select(
        "url", "doc_id", F.date_format("collected_at", "yyyy-MM-dd HH:mm:ss").alias("collected_at")
    )


@check("retain", """
    SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-02-20' - INTERVAL 30 DAY""")
def q_retain(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("collected_at"))
    return retain(events, datetime(2024, 2, 20)).select("event_id")


def flagged_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("site_name"), (F.col("n_chars") > 1000).alias("is_new")
    )


def source_sites(spark, sf_dir):
    """One site per nation key; the sources of the documents are some of them."""
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("src"), F.col("n_nationkey").cast("string")).alias("site")
    )


SQL_SITE_COUNTS = """
    SELECT 'src' || n_nationkey AS site_name,
      CAST(coalesce(sum(CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END), 0) AS BIGINT) AS new_articles
    FROM nation LEFT JOIN documents ON source = 'src' || n_nationkey GROUP BY n_nationkey"""


@check("site_counts", SQL_SITE_COUNTS)
def q_site_counts(spark, sf_dir):
    return site_counts(flagged_documents(spark, sf_dir), source_sites(spark, sf_dir))


@check("run_totals", """
    SELECT count(*) AS total_collected,
      CAST(sum(CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END) AS BIGINT) AS new_articles
    FROM documents""")
def q_run_totals(spark, sf_dir):
    return run_totals(flagged_documents(spark, sf_dir))


SQL_REPORT = f"""
    SELECT '2024-01-25 00:00:00' AS generated_at,
      (SELECT count(*) FROM documents) AS total_collected,
      (SELECT count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-24') AS collected_last_24h,
      (SELECT CAST(sum(CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END) AS BIGINT) FROM documents)
        AS new_articles,
      (SELECT string_agg(site_name || '=' || new_articles, ',' ORDER BY site_name)
       FROM ({SQL_SITE_COUNTS})) AS by_site,
      (SELECT string_agg(phrase || ':' || cnt, ',' ORDER BY cnt DESC, phrase) FROM ({SQL_TOP}))
        AS trending_topics"""


@check("monitor_report", SQL_REPORT)
def q_monitor_report(spark, sf_dir):
    store = table(spark, sf_dir, "events").select(F.col("ts").alias("collected_at"))
    report = monitor_report(
        count_articles(flagged_documents(spark, sf_dir)), store,
        trending(texts(spark, sf_dir, "documents", "text"), ["text"]),
        source_sites(spark, sf_dir), datetime(2024, 1, 25),
    )
    path = work_dir(spark, "report")
    write_report(report, path)
    written = spark.read.schema(report.schema).json(path)
    sites = F.array_sort(F.map_entries("statistics.by_site"))
    return written.select(
        F.date_format("generated_at", "yyyy-MM-dd HH:mm:ss").alias("generated_at"),
        "statistics.total_collected", "statistics.collected_last_24h", "latest_run.new_articles",
        F.array_join(
            F.transform(sites, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))),
            ",",
        ).alias("by_site"),
        F.array_join(
            F.transform(
                "trending_topics",
                lambda e: F.concat(e["phrase"], F.lit(":"), e["count"].cast("string")),
            ),
            ",",
        ).alias("trending_topics"),
    )


def csv_articles(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id", "text", "source")
    return docs.select(
        F.col("doc_id").cast("string").alias("url"),
        F.when(F.col("doc_id") % 4 > 0, F.concat(F.lit('say "hi", \\'), "source")).alias("title"),
        F.col("text").alias("markdown_content"),
        F.col("source").alias("site_name"),
    )


SQL_CSV = """
    SELECT CAST(doc_id AS VARCHAR) AS url,
      CASE WHEN doc_id % 4 > 0 THEN 'say "hi", \\' || source END AS title,
      text AS markdown_content, source AS site_name FROM documents"""


@check("csv_roundtrip", SQL_CSV)
def q_csv_roundtrip(spark, sf_dir):
    path = work_dir(spark, "latest")
    articles = csv_articles(spark, sf_dir)
    write_latest(articles, path)
    # A second run of some sites replaces these sites only.
    write_latest(articles.where("site_name < 'src5'"), path)
    return read_prior_results(
        spark, path, "url string, title string, markdown_content string, site_name string"
    )


@check("archive_partitions", f"""
    SELECT '20240131' AS archive_date, h AS run_hhmm, url, title, markdown_content, site_name
    FROM ({SQL_CSV}), (VALUES ('0915'), ('0930')) AS runs(h)""")
def q_archive(spark, sf_dir):
    path = work_dir(spark, "archive")
    articles = csv_articles(spark, sf_dir)
    for minute in (15, 30):
        write_archive(articles, path, datetime(2024, 1, 31, 9, minute))
    return read_prior_results(
        spark, path,
        "url string, title string, markdown_content string, archive_date string, "
        "site_name string, run_hhmm string",
    )

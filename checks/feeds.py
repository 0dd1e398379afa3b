"""Feeds and sitemaps as XML payloads built from documents, pages and events."""

from datetime import datetime

from pyspark.sql import functions as F

from checks.registry import check, table, texts
from newsflow.fixed_values import RSS_MAPPING
from newsflow.functions import month_shard_url, parse_publish_time, time_frame_seconds
from newsflow.operators.articles import union_feeds, union_sites
from newsflow.operators.extract import rss_description
from newsflow.operators.normalize import normalize_feed, standardize_columns, with_provenance
from newsflow.session import work_dir
from newsflow.sources import (
    classify_sources,
    feed_errors,
    latest_sitemap_shard,
    read_rss_files,
    read_rss_items,
    read_sitemap_files,
    read_sitemap_urls,
)


def xml_escape(c):
    for old, new in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def rss_payloads(spark, sf_dir):
    """One feed per document: a full item, one with markup in CDATA, one without most tags."""
    docs = texts(spark, sf_dir, "documents", "doc_id", "text", "source")
    key = F.col("doc_id").cast("string")
    items = F.concat(
        F.lit("<item><title> T"), key, F.lit(" &lt;&amp; </title><link>https://n.example/"), key,
        F.lit("</link><link>https://other.example/</link><description>"), xml_escape(F.col("text")),
        F.lit("</description><pubDate>Mon, 01 Jan 2024 10:00:00 +0700</pubDate></item>"),
        F.lit("<item><title>B</title><description><![CDATA[<p>hi <b>"), key,
        F.lit("</b></p>]]></description><pubDate>2024-02-03T04:05:06Z</pubDate></item>"),
        F.lit("<item><link>https://n.example/c</link><pubDate>soon</pubDate></item>"),
    )
    return docs.select(
        F.concat("source", F.lit("/"), key, F.lit(".rss")).alias("feed_source"),
        F.concat(
            F.lit('<?xml version="1.0"?><rss version="2.0"><channel><title>feed</title>'), items,
            F.lit("</channel></rss>"),
        ).alias("payload"),
    )


def sitemap_payloads(spark, sf_dir):
    pages = texts(spark, sf_dir, "pages", "page_id", "url")
    day = F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0")
    return pages.select(
        F.concat(F.lit("s"), F.col("page_id").cast("string"), F.lit(".xml")).alias("feed_source"),
        F.concat(
            F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>'),
            xml_escape(F.col("url")), F.lit("</loc><lastmod>2024-03-"), day,
            F.lit("T08:00:00+07:00</lastmod></url><url><loc> https://n.example/x </loc><lastmod>bad"),
            F.lit("</lastmod></url><url><loc>https://n.example/y</loc></url></urlset>"),
        ).alias("payload"),
    )


def stamp(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


SQL_RSS = """
    SELECT source || '/' || doc_id || '.rss' AS feed_source, pos,
      CASE pos WHEN 0 THEN 'T' || doc_id || ' <&' WHEN 1 THEN 'B' END AS title,
      CASE pos WHEN 0 THEN 'https://n.example/' || doc_id WHEN 2 THEN 'https://n.example/c' END
        AS link,
      CASE pos WHEN 0 THEN regexp_replace(text, '^\\s+|\\s+$', '', 'g')
               WHEN 1 THEN 'hi ' || doc_id END AS description,
      CASE pos WHEN 0 THEN '2024-01-01 03:00:00' WHEN 1 THEN '2024-02-03 04:05:06' END
        AS publish_time
    FROM documents, (VALUES (0), (1), (2)) AS p(pos)"""


@check("rss_items", SQL_RSS)
def q_rss_items(spark, sf_dir):
    items = read_rss_items(rss_payloads(spark, sf_dir))
    return items.withColumn("publish_time", stamp("publish_time"))


@check("rss_damaged", """
    SELECT source || '/' || doc_id || '.rss' AS feed_source, pos,
      CASE pos WHEN 0 THEN 'A ' || doc_id || ' c' WHEN 1 THEN 'B & ' || doc_id WHEN 2 THEN 'C'
               WHEN 3 THEN 'D' || doc_id ELSE 'F' END AS title,
      CASE pos WHEN 0 THEN 'https://n.example/' || doc_id WHEN 2 THEN 'https://n.example/c' END AS link,
      CASE pos WHEN 1 THEN regexp_replace(text, '^\\s+|\\s+$', '', 'g') END AS description,
      CASE pos WHEN 4 THEN '2024-02-03 04:05:06' END AS publish_time
    FROM documents, (VALUES (0), (1), (2), (3), (4)) AS p(pos)""")
def q_rss_damaged(spark, sf_dir):
    """One broken feed per document: an item below an extra element with tags in its title, a bare ampersand and
    an element left open, an item left open, a title below another element, a payload that is cut off."""
    docs = texts(spark, sf_dir, "documents", "doc_id", "text", "source")
    key = F.col("doc_id").cast("string")
    payload = F.concat(
        F.lit("<rss><channel><title>feed</title><part><item><title>A <b>"), key, F.lit("</b> c</title><link>https://n.example/"),
        key, F.lit("</link></item></part><item><title>B & <i>"), key, F.lit("</title><description>"), xml_escape(F.col("text")),
        F.lit("</description></item><item><title>C</title><link>https://n.example/c</link><item><image><title>D"), key,
        F.lit("</title></image><title>E</title></item><item><title>F</title><pubDate>2024-02-03T04:05:06Z"),
    )
    items = read_rss_items(docs.select(F.concat("source", F.lit("/"), key, F.lit(".rss")).alias("feed_source"), payload.alias("payload")))
    return items.withColumn("publish_time", stamp("publish_time"))


@check("rss_files", SQL_RSS.replace(
    "source || '/' || doc_id || '.rss' AS feed_source, pos,", "doc_id, ").replace(
    "(VALUES (0), (1), (2))", "(VALUES (0), (1))").replace("WHEN 2 THEN 'https://n.example/c'", ""))
def q_rss_files(spark, sf_dir):
    """Feeds landed as XML files: two items per document, the second without a link."""
    path = work_dir(spark, "rss")
    docs = texts(spark, sf_dir, "documents", "doc_id", "text")
    key = F.col("doc_id").cast("string")
    full = docs.select(
        "doc_id", F.concat(F.lit(" T"), key, F.lit(" <& ")).alias("title"),
        F.array(F.concat(F.lit("https://n.example/"), key), F.lit("https://other.example/"))
        .alias("link"),
        xml_escape(F.col("text")).alias("description"),
        F.lit("Mon, 01 Jan 2024 10:00:00 +0700").alias("pubDate"),
    )
    short = docs.select(
        "doc_id", F.lit("B").alias("title"), F.lit(None).cast("array<string>").alias("link"),
        F.concat(F.lit("<p>hi <b>"), key, F.lit("</b></p>")).alias("description"),
        F.lit("2024-02-03T04:05:06Z").alias("pubDate"),
    )
    full.unionByName(short).write.format("xml").option("rootTag", "channel").option(
        "rowTag", "item").save(path)
    items = read_rss_files(spark, path, {**RSS_MAPPING, "doc_id": "doc_id"}).drop("feed_source")
    return items.withColumns(
        {"publish_time": stamp("publish_time"), "doc_id": F.col("doc_id").cast("bigint")}
    )


SQL_SITEMAP = """
    SELECT 's' || page_id || '.xml' AS feed_source, pos,
      CASE pos WHEN 0 THEN url WHEN 1 THEN 'https://n.example/x' ELSE 'https://n.example/y' END
        AS url,
      CASE WHEN pos = 0 THEN '2024-03-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0')
        || ' 01:00:00' END AS lastmod
    FROM pages, (VALUES (0), (1), (2)) AS p(pos)"""


@check("sitemap_urls", SQL_SITEMAP)
def q_sitemap_urls(spark, sf_dir):
    urls = read_sitemap_urls(sitemap_payloads(spark, sf_dir))
    return urls.withColumn("lastmod", stamp("lastmod"))


@check("sitemap_files", """
    SELECT url, CASE WHEN page_id % 2 = 0 THEN '2024-03-' ||
      lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') || ' 00:00:00' END AS lastmod FROM pages""")
def q_sitemap_files(spark, sf_dir):
    path = work_dir(spark, "sitemap")
    day = F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0")
    entries = texts(spark, sf_dir, "pages", "page_id", "url").select(
        F.col("url").alias("loc"),
        F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("2024-03-"), day)).otherwise("soon")
        .alias("lastmod"),
    )
    entries.write.format("xml").option("rootTag", "urlset").option("rowTag", "url").save(path)
    urls = read_sitemap_files(spark, path).drop("feed_source")
    return urls.withColumn("lastmod", stamp("lastmod"))


@check("latest_shard", """
    SELECT url AS feed_source,
      CASE WHEN page_id % 5 = 4 THEN 'https://n.example/post-sitemap1.xml'
           ELSE 'https://n.example/post-sitemap' || (152 + page_id) || '.xml' END AS latest_url
    FROM pages""")
def q_latest_shard(spark, sf_dir):
    pages = texts(spark, sf_dir, "pages", "page_id", "url")

    def loc(name):
        return F.concat(F.lit("<sitemap><loc>https://n.example/"), name, F.lit("</loc></sitemap>"))

    shards = F.concat(
        loc(F.lit("post-sitemap99.xml")),
        loc(F.concat(F.lit("post-sitemap"), (F.col("page_id") + 152).cast("string"), F.lit(".xml"))),
        loc(F.lit("post-sitemap20.xml")), loc(F.lit("page-sitemap9999.xml")),
        loc(F.lit("post-sitemap-tags.xml")),
    )
    none = loc(F.lit("page-sitemap1.xml"))
    payload = F.concat(
        F.lit("<sitemapindex>"), F.when(F.col("page_id") % 5 == 4, none).otherwise(shards),
        F.lit("</sitemapindex>"),
    )
    index = pages.select(
        F.col("url").alias("feed_source"), payload.alias("payload"),
        F.lit("https://n.example/post-sitemap1.xml").alias("configured"),
    )
    return latest_sitemap_shard(index, default_col="configured")


SQL_CASES = """
    SELECT url || CASE page_id % 6 WHEN 0 THEN '.rss' WHEN 1 THEN '.xml' ELSE '' END AS source,
      CASE page_id % 6 WHEN 1 THEN '<rss/>' || html WHEN 2 THEN '<rss version="2.0"/>'
        WHEN 3 THEN html || '<channel>' WHEN 4 THEN html || '<urlset xmlns="u">' ELSE html END
        AS payload
    FROM pages"""


def _source_cases(spark, sf_dir):
    pages = texts(spark, sf_dir, "pages", "page_id", "url", "html")
    case = F.col("page_id") % 6
    suffix = F.when(case == 0, ".rss").when(case == 1, ".xml").otherwise("")
    payload = (
        F.when(case == 1, F.concat(F.lit("<rss/>"), "html"))
        .when(case == 2, F.lit('<rss version="2.0"/>'))
        .when(case == 3, F.concat("html", F.lit("<channel>")))
        .when(case == 4, F.concat("html", F.lit('<urlset xmlns="u">')))
        .otherwise(F.col("html"))
    )
    return pages.select(F.concat("url", suffix).alias("feed_source"), payload.alias("payload"))


@check("classify_sources", f"""
    SELECT source AS feed_source, CASE WHEN source LIKE '%.rss' THEN 'rss'
      WHEN source LIKE '%.xml' THEN 'sitemap'
      WHEN contains(payload, '<rss') OR contains(payload, '<channel>') THEN 'rss'
      WHEN contains(payload, '<urlset') THEN 'sitemap' ELSE 'error' END AS kind
    FROM ({SQL_CASES})""")
def q_classify_sources(spark, sf_dir):
    return classify_sources(_source_cases(spark, sf_dir)).select("feed_source", "kind")


@check("feed_errors", """
    SELECT source || '/' || doc_id || '.rss' AS feed_source,
      CASE doc_id % 4 WHEN 1 THEN 'no readable rss items' ELSE 'empty payload' END AS error
    FROM documents WHERE doc_id % 4 IN (1, 2)""")
def q_feed_errors(spark, sf_dir):
    payloads = rss_payloads(spark, sf_dir)
    case = F.regexp_extract("feed_source", r"/(\d+)\.rss", 1).cast("bigint") % 4
    damaged = (
        F.when(case == 1, F.regexp_replace("payload", "</item>", "</broken>"))
        .when(case == 2, " \n").otherwise(F.col("payload"))
    )
    kinds = classify_sources(payloads.withColumn("payload", damaged))
    return feed_errors(kinds).select("feed_source", "error")


SQL_ESCAPED = "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


@check("rss_description", f"""
    SELECT doc_id, text || ' & more' AS text,
      trim(regexp_replace(text, '[\\s\\x0b\\p{{Z}}\\x1c-\\x1f\\x{{85}}]+', ' ', 'g'))
        || chr(10) || chr(10) || '**more** [a](/b)' AS markdown,
      '<p>' || {SQL_ESCAPED} || '</p>' AS html
    FROM documents""")
def q_rss_description(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id", "text")
    body = F.concat(F.lit("<p>"), xml_escape(F.col("text")), F.lit("</p>"))
    return docs.select(
        "doc_id",
        rss_description(F.concat(body, F.lit(" &amp; <i>more</i>"))).alias("text"),
        rss_description(F.concat(body, F.lit('<b>more</b> <a href="/b">a</a>')), "markdown")
        .alias("markdown"),
        rss_description(body, "html").alias("html"),
    )


@check("standardize_columns", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'u' || o_orderkey
      WHEN o_orderkey % 3 = 0 THEN 'l' || o_orderkey END AS link, o_orderstatus AS status
    FROM orders""")
def q_standardize_columns(spark, sf_dir):
    key = F.col("o_orderkey").cast("string")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("u"), key)).alias("url"),
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("l"), key)).alias("loc"),
        F.col("o_orderstatus").alias("state"),
    )
    return standardize_columns(orders, {"link": ["url", "loc"], "status": ["state", "absent"]})


@check("normalize_feed", """
    SELECT url AS link, strftime(TIMESTAMP '2024-01-01' + to_hours(page_id), '%Y-%m-%d %H:%M:%S')
      AS publish_time, length(html) AS size FROM pages""")
def q_normalize_feed(spark, sf_dir):
    start = F.to_timestamp(F.lit("2024-01-01"))
    pages = table(spark, sf_dir, "pages").select(
        F.col("url").alias("LOC"),
        stamp(start + F.make_dt_interval(hours=F.col("page_id").cast("int"))).alias("PubDate"),
        F.length("html").cast("bigint").alias("Size"),
    )
    return normalize_feed(pages)


@check("with_provenance", """
    SELECT event_id, event_type || '.xml' AS feed_source, '2024-02-01 06:07:08' AS feed_time
    FROM events""")
def q_with_provenance(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    run_ts = datetime(2024, 2, 1, 6, 7, 8)
    tagged = with_provenance(events, F.concat("event_type", F.lit(".xml")), run_ts)
    return tagged.select("event_id", "feed_source", stamp("feed_time").alias("feed_time"))


SQL_SECOND = "strftime(date_trunc('second', ts) {}, '%Y-%m-%d %H:%M:%S')"


SQL_MINUTE = "strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S')"
SQL_DAY = "strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S')"


@check("parse_publish_time", f"""
    SELECT event_id, CASE
        WHEN event_id % 16 IN (0, 9, 15) THEN {SQL_SECOND.format('- INTERVAL 7 HOUR')}
        WHEN event_id % 16 IN (1, 4, 6, 11, 13) THEN {SQL_SECOND.format('')}
        WHEN event_id % 16 IN (2, 12, 14) THEN {SQL_MINUTE}
        WHEN event_id % 16 = 3 THEN {SQL_SECOND.format('+ INTERVAL 210 MINUTE')}
        WHEN event_id % 16 = 8 THEN {SQL_SECOND.format('+ INTERVAL 5 HOUR')}
        WHEN event_id % 16 IN (5, 10) THEN {SQL_DAY} END AS utc,
      CASE WHEN event_id % 16 IN (2, 12, 14) THEN {SQL_MINUTE}
        WHEN event_id % 16 IN (5, 10) THEN {SQL_DAY}
        WHEN event_id % 16 = 7 THEN NULL ELSE {SQL_SECOND.format('')} END AS wallclock
    FROM events""")
def q_parse_publish_time(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    forms = [
        F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss '+0700'"),
        F.date_format(ts, "dd MMM yyyy HH:mm:ss 'GMT'"),
        F.date_format(ts, "dd/MM/yyyy HH:mm"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'-03:30'"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        F.date_format(ts, "yyyy-MM-dd"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.concat(F.lit("posted "), F.date_format(ts, "dd MMM")),
        F.date_format(ts, "EEEE, d MMM yy H:mm:ss 'EST'"),
        F.date_format(ts, "dd MMM yyyy HH:mm:ss 'GMT+7'"),
        F.date_format(ts, "d MMMM yyyy"),
        F.date_format(ts, "yyyy/MM/dd H:mm:ss"),
        F.date_format(ts, "MMMM d, yyyy HH:mm"),
        F.date_format(ts, "d/M/yyyy h:mm:ss a"),
        F.date_format(ts, "dd-MM-yyyy HH:mm"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+07'"),
    ]
    text = F.coalesce(*[F.when(F.col("event_id") % 16 == i, f) for i, f in enumerate(forms)])
    return texts(spark, sf_dir, "events", "event_id", "ts").select(
        "event_id",
        stamp(parse_publish_time(text)).alias("utc"),
        stamp(parse_publish_time(text, "wallclock")).alias("wallclock"),
    )


@check("month_shard_url", """
    SELECT page_id, CASE page_id % 4
      WHEN 0 THEN 'https://n.example/sitemaps-2026-' || CASE WHEN page_id % 3 = 0 THEN '03' ELSE '3' END
      WHEN 1 THEN 'https://n.example/news-2026-' || CASE WHEN page_id % 3 = 0 THEN '03' ELSE '3' END
      WHEN 2 THEN 'https://n.example/sitemaps-2025-4'
      ELSE 'https://n.example/archive-2025-04' END || '.xml' AS url
    FROM pages""")
def q_month_shard_url(spark, sf_dir):
    names = ["sitemaps-2025-12", "news-2025-4", "sitemaps-2025-4", "archive-2025-04"]
    url = F.coalesce(*[
        F.when(F.col("page_id") % 4 == i, f"https://n.example/{name}.xml")
        for i, name in enumerate(names)
    ])
    return table(spark, sf_dir, "pages").select(
        "page_id",
        month_shard_url(url, datetime(2026, 3, 9), F.col("page_id") % 3 == 0).alias("url"),
    )


@check("parse_time_frame", """
    SELECT event_id, CASE WHEN event_id % 50 = 0 OR event_id % 5 = 4 THEN NULL
      ELSE (event_id % 50) * CASE event_id % 5 WHEN 0 THEN 3600 WHEN 1 THEN 86400 WHEN 2 THEN 60
        WHEN 3 THEN 3600 END END AS seconds
    FROM events""")
def q_parse_time_frame(spark, sf_dir):
    amount = (F.col("event_id") % 50).cast("string")
    units = ["h", "D ", "m", "H", "w"]
    frame = F.coalesce(*[
        F.when(F.col("event_id") % 5 == i, F.concat(F.lit(" "), amount, F.lit(u)))
        for i, u in enumerate(units)
    ])
    return table(spark, sf_dir, "events").select(
        "event_id", time_frame_seconds(frame).alias("seconds")
    )


@check("union_feeds", """
    SELECT url AS link, CAST(NULL AS VARCHAR) AS title, '2024-01-05 00:00:00' AS publish_time
    FROM pages UNION ALL
    SELECT 'd/' || doc_id, source, CAST(NULL AS VARCHAR) FROM documents""")
def q_union_feeds(spark, sf_dir):
    sitemap = table(spark, sf_dir, "pages").select(
        F.col("url").alias("loc"), F.lit("2024-01-05 00:00:00").alias("lastmod")
    )
    rss = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("d/"), F.col("doc_id").cast("string")).alias("Link"),
        F.col("source").alias("Title"),
    )
    return union_feeds(sitemap, rss).select("link", "title", "publish_time")


@check("union_sites", """
    SELECT url, length(html) AS n_chars, 'web' AS site_name FROM pages UNION ALL
    SELECT 'd/' || doc_id, n_chars, 'docs' FROM documents UNION ALL
    SELECT 'e/' || event_id, NULL, 'events' FROM events""")
def q_union_sites(spark, sf_dir):
    def keyed(name, prefix, key, *more):
        url = F.concat(F.lit(prefix), F.col(key).cast("string")).alias("url")
        return table(spark, sf_dir, name).select(url, *more)

    pages = table(spark, sf_dir, "pages").select(
        "url", F.length("html").cast("bigint").alias("n_chars")
    )
    return union_sites({
        "web": pages,
        "docs": keyed("documents", "d/", "doc_id", "n_chars"),
        "events": keyed("events", "e/", "event_id"),
    })

"""Filters, sorting, top-n and row rules."""

from datetime import datetime

from pyspark.sql import functions as F

from checks.registry import check, table, texts
from newsflow.operators import quality as Q
from newsflow.operators.filters import date_range, ok_rows, quarantine, recent, within
from newsflow.operators.ranking import latest_articles, sort_by_time, top_n, top_n_per_feed


def stamp(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


SQL_STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S')"


@check("within_time_frame", """
    SELECT event_id, event_type FROM events
    WHERE ts >= TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 36 HOUR""")
def q_within(spark, sf_dir):
    events = within(table(spark, sf_dir, "events"), "ts", "36h", datetime(2024, 1, 20, 12))
    return events.select("event_id", "event_type")


@check("within_volume", """
    SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1998-06-01' - INTERVAL 90 DAY""")
def q_within_volume(spark, sf_dir):
    lines = within(table(spark, sf_dir, "lineitem"), "l_shipdate", "90d", datetime(1998, 6, 1))
    return lines.select("l_orderkey", "l_linenumber")


@check("date_range", f"""
    SELECT o_orderkey AS url, {SQL_STAMP.format('o_orderdate')} AS lastmod FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1995-03-01' AND TIMESTAMP '1996-03-01'""")
def q_date_range(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("url"), F.col("o_orderdate").alias("lastmod")
    )
    kept = date_range(orders, datetime(1995, 3, 1), datetime(1996, 3, 1))
    return kept.withColumn("lastmod", stamp("lastmod"))


@check("recent_articles", """
    SELECT event_id FROM events
    WHERE event_id % 10 > 0 AND ts >= TIMESTAMP '2024-01-25' - INTERVAL 48 HOUR""")
def q_recent(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 10 > 0, F.col("ts")).alias("collected_at")
    )
    return recent(events, "collected_at", 48, datetime(2024, 1, 25)).select("event_id")


SQL_URL_CASES = """
    SELECT page_id, CASE page_id % 7 WHEN 0 THEN 'ftp' || substr(url, strpos(url, ':'))
      WHEN 1 THEN regexp_replace(url, '^https?://', '') WHEN 2 THEN '  ' || url || ' '
      WHEN 3 THEN '' WHEN 4 THEN 'https:///path' ELSE url END AS url FROM pages"""


def _url_cases(spark, sf_dir):
    url, case = F.col("url"), F.col("page_id") % 7
    changed = (
        F.when(case == 0, F.regexp_replace(url, "^https?", "ftp"))
        .when(case == 1, F.regexp_replace(url, "^https?://", ""))
        .when(case == 2, F.concat(F.lit("  "), url, F.lit(" ")))
        .when(case == 3, "").when(case == 4, "https:///path").otherwise(url)
    )
    return table(spark, sf_dir, "pages").select("page_id", changed.alias("url"))


@check("valid_urls", f"""
    SELECT page_id, url FROM ({SQL_URL_CASES})
    WHERE regexp_matches(trim(url), '^https?://[^/?#]+')""")
def q_valid_urls(spark, sf_dir):
    return Q.clean_rows(_url_cases(spark, sf_dir), [Q.valid_url("url")])


@check("validate_urls", f"""
    SELECT CAST(page_id AS VARCHAR) AS row_key, 'urls' AS field, 'urls' AS rule,
      CASE WHEN page_id % 7 = 5 THEN 'at least one URL is required'
        ELSE 'URL at index 1: ' || CASE page_id % 7 WHEN 0 THEN 'URL must use HTTP or HTTPS'
          WHEN 3 THEN 'URL is required' ELSE 'invalid URL format' END END AS message
    FROM ({SQL_URL_CASES}) WHERE page_id % 7 NOT IN (2, 6)""")
def q_validate_urls(spark, sf_dir):
    lists = _url_cases(spark, sf_dir).withColumn(
        "urls",
        F.when(F.col("page_id") % 7 == 5, F.array().cast("array<string>")).otherwise(
            F.array(F.lit("https://ok.example/"), "url")
        ),
    )
    return Q.validate_rows(lists, "page_id", [Q.valid_url_list("urls")])


@check("validate_rows", """
    WITH e AS (SELECT event_id,
        CASE event_id % 5 WHEN 0 THEN 'http://x.example/' || event_id WHEN 1 THEN 'x/' || event_id
          WHEN 2 THEN 'gopher://x/y' WHEN 3 THEN '' END AS url,
        CASE event_id % 4 WHEN 0 THEN '2024-1-15' WHEN 1 THEN '15/01/2024' WHEN 2 THEN ' 2024-02-30'
          END AS day,
        CASE event_id % 3 WHEN 0 THEN '12' WHEN 1 THEN '-4' ELSE 'many' END AS amount,
        CASE event_id % 6 WHEN 0 THEN ' DESC ' WHEN 1 THEN 'up' ELSE 'asc' END AS sort_order,
        event_type, CASE event_id % 2 WHEN 0 THEN '30m' ELSE '0h' END AS frame FROM events),
    v AS (
      SELECT event_id, 'url' AS field, 'url' AS rule, CASE event_id % 5
          WHEN 1 THEN 'invalid URL format' WHEN 2 THEN 'URL must use HTTP or HTTPS'
          WHEN 3 THEN 'URL is required' WHEN 4 THEN 'URL is required' END AS message FROM e
      UNION ALL SELECT event_id, 'day', 'date_format', CASE event_id % 4
          WHEN 1 THEN 'no date of format yyyy-M-d' WHEN 2 THEN 'no date of format yyyy-M-d'
          WHEN 3 THEN 'day is required' END FROM e
      UNION ALL SELECT event_id, 'amount', 'positive_int', CASE event_id % 3
          WHEN 1 THEN 'amount must be positive' WHEN 2 THEN 'amount must be an integer' END FROM e
      UNION ALL SELECT event_id, 'sort_order', 'choice',
          CASE WHEN event_id % 6 = 1 THEN 'sort_order must be one of: asc, desc' END FROM e
      UNION ALL SELECT event_id, 'event_type', 'choice', CASE WHEN event_type NOT IN ('view', 'click')
          THEN 'event_type must be one of: view, click' END FROM e
      UNION ALL SELECT event_id, 'frame', 'time_frame', CASE WHEN frame = '0h'
          THEN 'time frame must look like 12h, 2d or 30m' END FROM e)
    SELECT CAST(event_id AS VARCHAR) AS row_key, field, rule, message FROM v
    WHERE message IS NOT NULL""")
def q_validate_rows(spark, sf_dir):
    key = F.col("event_id")
    events = texts(spark, sf_dir, "events", "event_id", "event_type").select(
        "event_id", "event_type",
        F.when(key % 5 == 0, F.concat(F.lit("http://x.example/"), key.cast("string")))
        .when(key % 5 == 1, F.concat(F.lit("x/"), key.cast("string")))
        .when(key % 5 == 2, "gopher://x/y").when(key % 5 == 3, "").alias("url"),
        F.when(key % 4 == 0, "2024-1-15").when(key % 4 == 1, "15/01/2024")
        .when(key % 4 == 2, " 2024-02-30").alias("day"),
        F.when(key % 3 == 0, "12").when(key % 3 == 1, "-4").otherwise("many").alias("amount"),
        F.when(key % 6 == 0, " DESC ").when(key % 6 == 1, "up").otherwise("asc").alias("sort_order"),
        F.when(key % 2 == 0, "30m").otherwise("0h").alias("frame"),
    )
    rules = [
        Q.valid_url("url"), Q.date_format("day"), Q.positive_int("amount"),
        Q.sort_order("sort_order"), Q.choice("event_type", ["view", "click"]), Q.time_frame("frame"),
    ]
    return Q.validate_rows(events, "event_id", rules)


@check("known_sites", """
    SELECT doc_id, upper(source) || ' ' AS site FROM documents
    WHERE source IN (SELECT CASE WHEN n_regionkey < 3 THEN 'src' ELSE 'other' END || n_nationkey FROM nation)""")
def q_known_sites(spark, sf_dir):
    prefix = F.when(F.col("n_regionkey") < 3, "src").otherwise("other")
    sites = table(spark, sf_dir, "nation").select(
        F.concat(prefix, F.col("n_nationkey").cast("string")).alias("site")
    )
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.upper("source"), F.lit(" ")).alias("site")
    )
    return Q.in_dimension(docs, "site", sites.withColumnRenamed("site", "known"), "known")


@check("required_columns", "SELECT doc_id, lang FROM documents")
def q_required_columns(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return Q.require_columns(docs, ["doc_id", "lang"])


@check("required_keys", """
    SELECT CAST(c_custkey AS VARCHAR) AS row_key, 'config' AS field, 'required_keys' AS rule,
      CASE WHEN c_custkey % 3 = 0 THEN 'missing keys: author'
        ELSE 'missing keys: title, author' END AS message
    FROM customer WHERE c_custkey % 3 <> 2""")
def q_required_keys(spark, sf_dir):
    key = F.col("c_custkey") % 3
    name = F.when(key == 0, "title").when(key == 1, "text").otherwise("title")
    config = F.when(
        key == 2, F.create_map(F.lit("title"), F.col("c_name"), F.lit("author"), F.col("c_name"))
    ).otherwise(F.create_map(name, F.col("c_name")))
    customers = table(spark, sf_dir, "customer").select("c_custkey", config.alias("config"))
    return Q.validate_rows(customers, "c_custkey", [Q.required_keys("config", ["title", "author"])])


@check("defaults", """
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 10 ELSE event_id END AS max_articles FROM events""")
def q_defaults(spark, sf_dir):
    value = F.when(F.col("event_id") % 3 > 0, F.col("event_id"))
    events = table(spark, sf_dir, "events").select("event_id", value.alias("max_articles"))
    checked = Q.clean_rows(events, [Q.positive_int("max_articles", required=False)])
    return checked.withColumn(
        "max_articles", Q.with_default(F.col("max_articles"), 10).cast("bigint")
    )


@check("quarantine_split", """
    SELECT doc_id, CASE WHEN n_chars < 500 THEN 'bad' ELSE 'ok' END AS part FROM documents""")
def q_quarantine(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("n_chars") < 500, "too short").alias("error")
    )
    good = ok_rows(docs).select("doc_id", F.lit("ok").alias("part"))
    return good.unionByName(quarantine(docs).select("doc_id", F.lit("bad").alias("part")))


@check("sort_by_time", f"""
    SELECT event_id, CASE WHEN event_id % 7 > 0 THEN {SQL_STAMP.format('ts')} END AS publish_time
    FROM events ORDER BY publish_time DESC NULLS LAST, event_id""")
def q_sort_by_time(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 7 > 0, F.col("ts")).alias("publish_time")
    )
    ordered = sort_by_time(events, "publish_time", "desc", tie_break=("event_id",))
    return ordered.withColumn("publish_time", stamp("publish_time"))


@check("top_n", """
    SELECT event_id, event_type FROM events WHERE event_id % 7 > 0
    ORDER BY ts DESC, event_id LIMIT 200""")
def q_top_n(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.when(F.col("event_id") % 7 > 0, F.col("ts")).alias("publish_time")
    )
    return top_n(events, 200, tie_break=("event_id",)).select("event_id", "event_type")


SQL_PER_FEED = """
    SELECT o_orderpriority AS feed_source, o_orderkey AS pos FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) <= {}"""


def _order_feed(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("feed_source"), F.col("o_orderkey").alias("pos")
    )


@check("top_n_per_feed", SQL_PER_FEED.format(50))
def q_top_n_per_feed(spark, sf_dir):
    return top_n_per_feed(_order_feed(spark, sf_dir), 50)


@check("top_many_per_feed", SQL_PER_FEED.format(2500))
def q_top_many_per_feed(spark, sf_dir):
    return top_n_per_feed(_order_feed(spark, sf_dir), 2500)


@check("latest_articles", f"""
    SELECT o_orderkey AS url, {SQL_STAMP.format('o_orderdate')} AS lastmod FROM orders
    ORDER BY o_orderdate DESC, o_orderkey LIMIT 25""")
def q_latest_articles(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("url"), F.col("o_orderdate").alias("lastmod")
    )
    return latest_articles(orders, 25).withColumn("lastmod", stamp("lastmod"))

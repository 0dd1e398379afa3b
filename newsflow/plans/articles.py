"""From landed feed payloads and pages to clean articles.

Filters, top-n and the check against earlier results come before the page join, and pages are
parsed last and once per URL: extraction is the dear step and nothing moves below it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.fixed_values import RSS_MAPPING, SITEMAP_SHARD_PREFIX
from newsflow.functions.text import clean_article
from newsflow.functions.times import month_shard_url
from newsflow.operators.articles import union_feeds, union_sites
from newsflow.operators.extract import extract_articles
from newsflow.operators.filters import within
from newsflow.operators.joins import (
    carry_site,
    reuse_known,
    site_places,
    skip_known,
    url_host,
    with_selectors,
)
from newsflow.operators.normalize import with_provenance
from newsflow.operators.ranking import first_per_key, top_n, top_n_per_feed
from newsflow.operators.skew import hot_keys, join_unique
from newsflow.session import work_dir
from newsflow.sinks import write_table
from newsflow.sources.feeds import (
    classify_sources,
    latest_sitemap_shard,
    read_rss_items,
    read_sitemap_urls,
)

# The error of a wanted row whose page has not landed yet.
NOT_LANDED = "page not landed"


def feed_table(
    payloads: DataFrame,
    run_ts: datetime,
    per_feed: int | None = None,
    mapping: Mapping[str, str] = RSS_MAPPING,
    description_format: str = "text",
) -> DataFrame:
    """Items of all payloads, RSS and sitemap alike, under one set of columns."""
    kinds = classify_sources(payloads)
    rss = read_rss_items(kinds.where(F.col("kind") == "rss"), mapping, description_format)
    sitemap = read_sitemap_urls(kinds.where(F.col("kind") == "sitemap"))
    feed = with_provenance(union_feeds(rss, sitemap), F.col("feed_source"), run_ts)
    return feed if per_feed is None else top_n_per_feed(feed, per_feed)


def landed_pages(feed: DataFrame, pages: DataFrame) -> DataFrame:
    """One page per distinct link of the feed: of a URL landed twice the newest by ``landed_at``, where
    pages have that column. Spark broadcasts the links where they are few."""
    wanted = feed.select(F.col("link").alias("url")).where(F.col("url").isNotNull()).distinct()
    matched = pages.join(wanted, "url", "left_semi")
    newest = [F.col("landed_at").desc_nulls_last()] if "landed_at" in pages.columns else []
    first = first_per_key(matched, ["url"], [*newest, F.xxhash64("html"), F.length("html")])
    return first.select("url", "html")


def fetch_articles(
    feed: DataFrame,
    pages: DataFrame,
    sites: DataFrame,
    as_of: datetime,
    max_articles: int | None = 10,
    time_frame: str | None = "1d",
    sort_order: str = "desc",
    prior: DataFrame | None = None,
    reuse_prior: bool = False,
    prior_order: Sequence[str] | None = None,
    clean_content: bool = True,
    sited: bool = False,
) -> DataFrame:
    """Articles for the wanted feed rows: extracted, cleaned, with an error where a page failed.

    A row's site is the one it carries, else the one whose source its feed is, else the one that the host
    and path of its link belong to; with sited, ``carry_site`` was applied already. ``prior`` holds earlier articles by url: their rows are left out, or with reuse_prior put in
    front of the newly extracted ones.
    """
    wanted = feed if time_frame is None else within(feed, "publish_time", time_frame, as_of)
    if max_articles is not None:
        wanted = top_n(wanted, max_articles, "publish_time", sort_order)
    # Every later step reads the wanted rows again; payloads are parsed once for all of them.
    wanted = write_table(wanted, work_dir(feed.sparkSession, "wanted"))
    if not sited:
        wanted = write_table(carry_site(wanted, sites), work_dir(feed.sparkSession, "wanted-sites"))
    known, hot = None, hot_keys(wanted, "link")
    if prior is not None:
        earlier = prior.withColumn("link", F.col("url"))
        if reuse_prior:
            known, wanted = reuse_known(wanted, earlier, prior_order=prior_order, hot=hot)
        else:
            wanted = skip_known(wanted, earlier, hot=hot)
    # A page is parsed once per site that wants it, which is nearly always one.
    pairs = wanted.select(F.col("link").alias("url"), "site_name").where("url IS NOT NULL").distinct()
    chosen = with_selectors(pairs.join(landed_pages(wanted, pages), "url"), site_places(sites))
    unsited = chosen.select("url", "site_name", F.col("error").alias("site_error"), "selectors", "html")
    extracted = extract_articles(unsited).select(
        "*", F.concat_ws("\n", "url", F.coalesce("site_name", F.lit(""))).alias("_page"), F.lit(True).alias("_landed"))
    extracted = extracted.withColumn("error", F.coalesce("site_error", "error")).drop("site_error", "site_name", "url")
    carried = [c for c in ("pos", "_asked", "_tries") if c in wanted.columns]
    page = F.when(F.col("link").isNotNull(), F.concat_ws("\n", "link", F.coalesce("site_name", F.lit(""))))
    requests = wanted.select(
        F.col("link").alias("url"), "feed_source", "feed_time", "site_name", *carried, page.alias("_page"))
    articles = join_unique(requests, extracted, "_page", "left", None if hot else []).withColumn(
        "error",
        F.when(F.col("url").isNull(), F.lit("no link"))
        .when(F.col("_landed").isNull(), F.lit(NOT_LANDED))
        .otherwise(F.col("error")),
    ).drop("_page", "_landed")
    if clean_content:
        articles = clean_article(articles)
    if known is not None:
        articles = known.drop("link").unionByName(articles, allowMissingColumns=True)
    return articles


def refresh_sitemaps(
    sites: DataFrame, as_of: datetime, index_payloads: DataFrame | None = None
) -> DataFrame:
    """Overrides ``(site, sitemap_url, updated_at)`` for sites whose sitemap URL moves with time.

    Month-sharded URLs get the month of as_of. Numbered ones get the newest shard of the site's
    sitemap index, given as payloads whose ``feed_source`` is the site name.
    """
    url = month_shard_url(F.col("sitemap_url"), as_of, F.coalesce("zero_pad", F.lit(False)))
    moved = sites.select("site", "sitemap_url", url.alias("new_url"))
    if index_payloads is not None:
        newest = latest_sitemap_shard(index_payloads).withColumnRenamed("feed_source", "site")
        numbered = F.col("sitemap_url").rlike(SITEMAP_SHARD_PREFIX + r"\d+\.xml")
        moved = moved.join(newest, "site", "left").withColumn(
            "new_url", F.when(numbered, F.coalesce("latest_url", "new_url")).otherwise(F.col("new_url"))
        )
    stamp = F.lit(as_of.isoformat(sep=" ")).cast("timestamp")
    return moved.where(F.col("new_url") != F.col("sitemap_url")).select(
        "site", F.col("new_url").alias("sitemap_url"), stamp.alias("updated_at")
    )


def top_per_site(feed: DataFrame, n: int, order: str = "desc") -> DataFrame:
    """The n newest (or oldest) feed rows of each site; rows without a site are told apart by host."""
    time = F.col("publish_time")
    first = time.desc_nulls_last() if order == "desc" else time.asc_nulls_last()
    host = F.concat(F.lit("//"), url_host(F.col("link")))
    place = F.coalesce("site_name", host) if "site_name" in feed.columns else host
    sited = feed.withColumn("_place", place)
    return first_per_key(sited, ["_place"], [first, F.col("link").asc_nulls_last()], n).drop("_place")


def fetch_many_sites(
    feeds: Mapping[str, DataFrame], pages: DataFrame, sites: DataFrame, as_of: datetime,
    max_articles: int | None = 10, time_frame: str | None = "1d", sort_order: str = "desc", **options,
) -> DataFrame:
    """Articles of several sites, tagged with the site: the newest of each, fetched together, so that the
    pages are read once."""
    wanted = union_sites(feeds)
    if time_frame is not None:
        wanted = within(wanted, "publish_time", time_frame, as_of)
    if max_articles is not None:
        wanted = top_per_site(wanted, max_articles, sort_order)
    return fetch_articles(wanted, pages, sites, as_of, max_articles=None, time_frame=None, **options)

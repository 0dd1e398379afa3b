"""Joins against earlier results, the site catalogue and the store.

The right side is reduced to one row per key first, so no join can multiply rows. Hot keys of the
left side are salted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.operators.ranking import first_per_key
from newsflow.operators.skew import hot_keys, join_dimension, join_unique
from newsflow.session import work_dir
from newsflow.sinks import write_table


def skip_known(
    feed: DataFrame, prior: DataFrame, key: str = "link", hot: list | None = None
) -> DataFrame:
    """Feed rows whose key has no earlier result; rows without a key stay.

    ``hot`` are the feed's hot keys when the caller knows them already.
    """
    return join_unique(feed, prior.select(key).distinct(), key, "left_anti", hot)


def reuse_known(
    feed: DataFrame, prior: DataFrame, key: str = "link",
    prior_order: Sequence[str] | None = None, hot: list | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Split a feed into rows answered by an earlier result and rows still to be fetched.

    The first branch holds the earlier result row (the first one by prior_order) once per feed
    row, the second the remaining feed rows.
    """
    order = [F.col(c).asc_nulls_last() for c in prior_order or _sortable(prior, key)]
    earlier = first_per_key(prior.where(F.col(key).isNotNull()), [key], order or [F.col(key)])
    hot = hot_keys(feed, key) if hot is None else hot
    cached = join_unique(feed.select(key), earlier, key, "inner", hot)
    new = join_unique(feed, earlier.select(key), key, "left_anti", hot)
    return cached.select(*prior.columns), new


def _sortable(df: DataFrame, key: str) -> list[str]:
    return [f.name for f in df.schema if f.name != key and f.dataType.typeName() != "map"]


def apply_overrides(sites: DataFrame, overrides: DataFrame) -> DataFrame:
    """Site rows with overridden values; overrides of unknown sites have no effect."""
    changed = [c for c in overrides.columns if c in sites.columns and c != "site"]
    latest = first_per_key(
        overrides, ["site"],
        [F.col("updated_at").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in changed]],
    )
    o = latest.select("site", *[F.col(c).alias(f"_new_{c}") for c in changed])
    joined = join_dimension(sites, o, "site", "left")
    return joined.select(
        *[
            F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in changed else F.col(c)
            for c in sites.columns
        ]
    )


def resolve_sources(sites: DataFrame) -> DataFrame:
    """One row per source URL of each site: its RSS URLs, else its sitemap, else none."""
    urls = F.when(F.size("rss.urls") > 0, F.col("rss.urls")).when(
        F.col("sitemap_url") != "", F.array("sitemap_url")
    )
    return sites.select("site", F.explode(urls).alias("source_url"))


def site_places(sites: DataFrame) -> DataFrame:
    """Where sites live: host (without ``www.``), path of folders, site name and selectors.

    Every sitemap and RSS URL of a site gives a place. Each host also has a place without a path, for
    pages that no path tells apart; two sites in one place give it to the first by name.
    """
    urls = F.array("sitemap_url")
    if "rss" in sites.columns:
        urls = F.concat(urls, F.coalesce(F.col("rss.urls"), F.array().cast("array<string>")))
    places = sites.select("site", "config", F.explode(urls).alias("_url")).select(
        F.col("site").alias("site_name"), url_host(F.col("_url")).alias("host"),
        F.array_join(url_folders(F.col("_url")), "/").alias("path"), F.col("config").alias("selectors"))
    places = places.where(F.col("host").isNotNull())
    whole = places.withColumn("path", F.lit("")).withColumn("_own", F.lit(False))
    own = places.withColumn("_own", F.lit(True))
    first = first_per_key(own.unionByName(whole), ["host", "path"], [F.col("_own").desc(), F.col("site_name")])
    return first.drop("_own")


site_hosts = site_places


def url_folders(url: Column) -> Column:
    """The folders of a URL's path, without its last part."""
    path = F.coalesce(F.try_parse_url(F.trim(url), F.lit("PATH")), F.lit(""))
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    return F.when(path.endswith("/"), parts).otherwise(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))))


def host_suffixes(host: Column) -> Column:
    """The host and the hosts above it: ``a.b.c`` gives ``a.b.c``, ``b.c`` and ``c``."""
    labels = F.split(host, r"\.")
    return F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))


def resolve_sites(rows: DataFrame, places: DataFrame, url_col: str) -> DataFrame:
    """The rows with ``_place_site``: the site of the longest host suffix that any site has, and there
    the one with the longest path above the row's.

    Only distinct hosts, with as many folders as the places' paths have, are expanded and matched.
    """
    depth = places.agg(F.coalesce(F.max(F.size(F.filter(F.split("path", "/"), lambda x: x != ""))), F.lit(0))).first()[0]
    folders = F.slice(url_folders(F.col(url_col)), 1, F.lit(depth)) if depth else F.array().cast("array<string>")
    keyed = rows.withColumn("_key", F.concat_ws("/", url_host(F.col(url_col)), F.array_join(folders, "/")))
    keys = keyed.select("_key").distinct().where(F.col("_key") != "")
    parts = F.split("_key", "/")
    above = F.filter(F.slice(parts, 2, F.size(parts)), lambda x: x != "")
    tried = keys.withColumn("host", F.explode(host_suffixes(parts[0]))).withColumn(
        "path", F.explode(F.transform(F.sequence(F.lit(0), F.size(above)), lambda n: F.array_join(F.slice(above, 1, n), "/"))))
    found = tried.join(places.select("host", "path", "site_name"), ["host", "path"]).groupBy("_key").agg(
        F.max_by("site_name", F.struct(F.length("host"), F.length("path"))).alias("_place_site"))
    # Written, as it is counted before it is joined.
    found = write_table(found, work_dir(rows.sparkSession, "site-keys"))
    return join_dimension(keyed, found, "_key", "left").drop("_key")


def carry_site(feed: DataFrame, sites: DataFrame) -> DataFrame:
    """The feed with ``site_name``: the site it came with, if the catalogue has it, else the one whose
    source the feed is, else the one found by the link's host and path, else null."""
    places = site_places(sites)
    urls = F.array("sitemap_url")
    if "rss" in sites.columns:
        urls = F.concat(urls, F.coalesce(F.col("rss.urls"), F.array().cast("array<string>")))
    sources = sites.select(F.col("site").alias("_source_site"), F.explode(urls).alias("feed_source"))
    sources = sources.where("feed_source <> ''").groupBy("feed_source").agg(F.min("_source_site").alias("_source_site"))
    found = join_dimension(resolve_sites(feed, places, "link"), sources, "feed_source", "left")
    site = F.coalesce("_source_site", "_place_site")
    if "site_name" in feed.columns:
        names = sites.select(F.col("site").alias("site_name"), F.col("site").alias("_known")).distinct()
        found = join_dimension(found, names, "site_name", "left")
        site = F.coalesce("_known", site)
    rest = [c for c in feed.columns if c != "site_name"]
    return found.select(*rest, site.alias("site_name"))


def url_host(url: Column) -> Column:
    """Lower-cased host without ``www.``; null when the text is no URL."""
    host = F.lower(F.try_parse_url(F.trim(url), F.lit("HOST")))
    return F.regexp_replace(host, r"^www\.", "")


def attach_selectors(pages: DataFrame, places: DataFrame, url_col: str = "url") -> DataFrame:
    """Add the selectors and the name of a page's site: the one in ``site_name`` where pages carry it, else
    the one found by host and path.

    A page of an unknown site gets an ``error``, so that ``quarantine`` can split it off.
    """
    sited = resolve_sites(pages, places, url_col)
    site = F.coalesce("site_name", "_place_site") if "site_name" in pages.columns else F.col("_place_site")
    return with_selectors(sited.withColumn("site_name", site).drop("_place_site"), places, url_col)


def with_selectors(pages: DataFrame, places: DataFrame, url_col: str = "url") -> DataFrame:
    """Add the selectors of the site in ``site_name``, and an ``error`` where there is none."""
    selectors = first_per_key(places.select("site_name", "selectors"), ["site_name"], [F.col("site_name")])
    joined = join_dimension(pages, selectors, "site_name", "left")
    unknown = F.concat(F.lit("unknown site: "), F.coalesce(url_host(F.col(url_col)), F.lit("no host")))
    return joined.withColumn("error", F.when(F.col("site_name").isNull(), unknown))


def lookup(store: DataFrame, urls: DataFrame | Sequence[str], key: str = "url") -> DataFrame:
    """Store rows of the given URLs. A list becomes a filter that reaches the scan."""
    if isinstance(urls, DataFrame):
        # The store holds one row per URL, so it has no hot key.
        return join_unique(store, urls.select(key).distinct(), key, "left_semi", hot=[])
    return store.where(F.col(key).isin(list(urls)))

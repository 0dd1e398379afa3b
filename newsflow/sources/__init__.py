"""Sources: landed feed payloads, pages, the site catalogue, stop words and earlier results."""

from newsflow.sources.catalog import (
    default_site_catalog,
    read_pages,
    read_prior_results,
    read_site_catalog,
    read_site_overrides,
    read_stopwords,
)
from newsflow.sources.feeds import (
    classify_sources,
    feed_errors,
    latest_sitemap_shard,
    read_feed_payloads,
    read_rss_files,
    read_rss_items,
    read_sitemap_files,
    read_sitemap_urls,
)

__all__ = [
    "classify_sources", "default_site_catalog", "feed_errors", "latest_sitemap_shard",
    "read_feed_payloads", "read_pages", "read_prior_results", "read_rss_files",
    "read_rss_items", "read_site_catalog", "read_site_overrides", "read_sitemap_files",
    "read_sitemap_urls", "read_stopwords",
]

"""Compositions: from feeds and pages to clean articles."""

from newsflow.plans.articles import (
    NOT_LANDED,
    feed_table,
    fetch_articles,
    fetch_many_sites,
    refresh_sitemaps,
    top_per_site,
)

__all__ = [
    "NOT_LANDED", "feed_table", "fetch_articles", "fetch_many_sites", "refresh_sitemaps", "top_per_site",
]

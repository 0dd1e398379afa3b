"""Column functions: text cleaning, tokens, times and URLs."""

from newsflow.functions.sql import register_sql_functions
from newsflow.functions.text import (
    cap_newlines,
    clean_article,
    clean_text,
    collapse_whitespace,
    normalize_title,
    normalize_unicode,
    remove_boilerplate,
    strip_boilerplate,
    strip_byline,
    strip_emails,
    strip_phones,
    strip_pubinfo,
    strip_tags,
    strip_urls,
    unescape_html,
)
from newsflow.functions.times import (
    month_shard_url,
    parse_publish_time,
    parse_time_frame,
    time_frame_seconds,
)
from newsflow.functions.tokens import filter_tokens, ngrams, tokenize

__all__ = [
    "cap_newlines", "clean_article", "clean_text", "collapse_whitespace", "filter_tokens",
    "month_shard_url", "ngrams", "normalize_title", "normalize_unicode", "parse_publish_time",
    "parse_time_frame", "register_sql_functions", "remove_boilerplate", "strip_boilerplate", "strip_byline",
    "strip_emails", "strip_phones", "strip_pubinfo", "strip_tags", "strip_urls",
    "time_frame_seconds", "tokenize", "unescape_html",
]

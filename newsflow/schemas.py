"""Declared schemas; no source infers one."""

SELECTOR_MAP = "map<string,struct<tag:string,class:string>>"

PAYLOADS = "feed_source string, payload string"
PAGES = "url string, html string"
FEED = (
    "link string, publish_time timestamp, title string, description string, "
    "feed_source string, feed_time timestamp, pos int"
)
ARTICLES = (
    "url string, title string, short_description string, publish_time string, author string, "
    "markdown_content string, feed_source string, feed_time timestamp, site_name string, error string"
)
STORE = ARTICLES + ", content_error string, collected_at timestamp"
SITES = (
    "site string, sitemap_url string, zero_pad boolean, "
    f"config {SELECTOR_MAP}, rss struct<urls:array<string>,mapping:map<string,string>>"
)
SITE_OVERRIDES = "site string, sitemap_url string, updated_at timestamp"
TRENDS = "phrase string, cnt bigint"
VIOLATION = "struct<field:string,rule:string,message:string>"

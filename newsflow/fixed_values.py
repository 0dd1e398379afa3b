"""Lists, patterns and lookup tables that results depend on, stated as text."""

# --- Text patterns (matched without regard to case) ------------------------------------------
EMAIL_PATTERN = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
PHONE_PATTERN = (
    r"\b(\+?[0-9]{1,3}[-.\s]?)?(\([0-9]{1,4}\)|[0-9]{1,4})[-.\s]?[0-9]{1,4}[-.\s]?[0-9]{1,9}\b"
)
URL_PATTERN = r"https?://[^\s]+"
TAG_PATTERN = r"<[^>]*>"

# --- Literal replacements applied before Unicode normalisation, in this order ----------------
CHARACTER_REPLACEMENTS = [
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&apos;", "'"),
    (" ", " "),
    ("‘", "'"),
    ("’", "'"),
    ("“", '"'),
    ("”", '"'),
    ("–", "-"),
    ("—", "--"),
    ("…", "..."),
]

# --- Boilerplate: everything from the phrase to the end of its line goes ----------------------
BOILERPLATE_PHRASES = [
    "Share this article",
    "Follow us on",
    "Read more:",
    "Click here to",
    "Sign up for our newsletter",
    "Related articles:",
    "Source:",
    "Credit:",
    "Image credit:",
    "Photo credit:",
    "For more information",
    "All rights reserved",
    "Copyright ©",
]

# --- Bracketed markers removed from titles ----------------------------------------------------
TITLE_MARKERS = ["sponsored", "exclusive", "update", "video", "photos", "opinion"]

# --- HTML cleaning defaults -------------------------------------------------------------------
REMOVED_TAGS = [
    "script", "style", "iframe", "noscript", "meta", "link",
    "button", "form", "input", "textarea", "select", "option",
]
REMOVED_ATTRIBUTES = [
    "onclick", "onload", "onerror", "onmouseover", "onmouseout", "style", "data-", "aria-",
]
MAIN_CONTENT_SELECTORS = [
    {"tag": "article"},
    {"class": "content"},
    {"class": "article-content"},
    {"class": "post-content"},
    {"class": "entry-content"},
    {"id": "content"},
    {"id": "main-content"},
    {"id": "article-content"},
    {"id": "post-content"},
]

# --- Trending defaults ------------------------------------------------------------------------
NGRAM_SIZES = (2, 3, 4, 5)
MIN_TOKEN_LENGTH = 3
TOP_TRENDS = 20

# --- Feeds ------------------------------------------------------------------------------------
RSS_MAPPING = {
    "link": "link",
    "title": "title",
    "description": "description",
    "publish_time": "pubDate",
}
FEED_COLUMN_ALIASES = {
    "link": ["url", "loc"],
    "publish_time": ["pubdate", "lastmod"],
}
SITEMAP_SHARD_PREFIX = "post-sitemap"
ARTICLE_RETENTION = "30d"
MONITOR_INTERVAL = "15 minutes"
MONITOR_WINDOW = "12h"
ARTICLES_PER_SITE = 500

# --- Site catalogue ---------------------------------------------------------------------------
# site, sitemap_url, zero_pad, selectors as (tag, class), RSS urls
SELECTOR_NAMES = (
    "title_selector",
    "content_selector",
    "short_desc_selector",
    "publish_time_selector",
    "author_selector",
)
SITE_CATALOGUE = [
    (
        "cafef", "https://cafef.vn/latest-news-sitemap.xml", False,
        [(None, "title"), ("div", "contentdetail"), (None, "sapo"), (None, "pdate"), (None, "author")],
        [],
    ),
    (
        "cafebiz", "https://cafebiz.vn/latestnews-sitemap.xml", False,
        [(None, "title"), ("div", "detail-content"), (None, "sapo"), (None, "time"), (None, "detail-author")],
        [
            "https://cafebiz.vn/rss/home.rss",
            "https://cafebiz.vn/rss/cau-chuyen-kinh-doanh.rss",
            "https://cafebiz.vn/rss/vi-mo.rss",
            "https://cafebiz.vn/rss/cong-nghe.rss",
            "https://cafebiz.vn/rss/xa-hoi.rss",
        ],
    ),
    (
        "vietstock", "https://vietstock.vn/sitemap.xml", False,
        [(None, "article-title"), ("div", "single_post_heading"), (None, "pHead"), (None, "date"), (None, "pAuthor")],
        [],
    ),
    (
        "vneconomy", "https://vneconomy.vn/sitemap/latest-news.xml", False,
        [
            (None, "detail__title"), ("div", "detail__content"), (None, "detail__summary"),
            (None, "detail__meta"), (None, "detail__author"),
        ],
        [],
    ),
    (
        "plo", "https://plo.vn/sitemaps/news-2025-04.xml", True,
        [(None, "article__title"), ("div", "article__body"), (None, "article__sapo"), (None, "time"), (None, "author")],
        [],
    ),
    (
        "vnexpress", "https://vnexpress.net/sitemap.xml", False,
        [(None, "title-detail"), ("article", "fck_detail"), (None, "description"), (None, "date"), (None, "author")],
        ["https://vnexpress.net/rss/tin-moi-nhat.rss"],
    ),
    (
        "tuoitre", "https://tuoitre.vn/StaticSitemaps/sitemaps-2025-04.xml", True,
        [
            (None, "detail-title article-title"), ("div", "detail-cmain"), (None, "detail-sapo"),
            (None, "detail-time"), (None, "author-info"),
        ],
        ["https://tuoitre.vn/sitemaps/latest-news.rss"],
    ),
    (
        "ktsg", "https://thesaigontimes.vn/post-sitemap152.xml", False,
        [
            (None, "tdb-title-text"), ("div", "td-post-content"), ("p", None),
            (None, "entry-date updated td-module-date"),
            (None, "wpb_wrapper td_block_wrap td_block_creative content-tacgia"),
        ],
        [],
    ),
    (
        "dddn", "https://diendandoanhnghiep.vn/sitemap-news.xml", False,
        [
            (None, "sc-longform-header-title"), ("div", "b-maincontent"), (None, "sc-longform-header-sapo"),
            (None, "sc-longform-header-date"), (None, "sc-longform-header-author"),
        ],
        [],
    ),
    (
        "baodautu", "https://baodautu.vn/sitemaps/news-2025-4.xml", False,
        [(None, "title-detail"), ("div", "content"), (None, "sapo_detail"), (None, "post-time"), (None, "author")],
        [],
    ),
]

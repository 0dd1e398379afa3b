"""Text cleaning as column functions.

Patterns spell out their character classes, because ``\\s``, ``\\w`` and ``\\b`` differ between
regex dialects. Only entity decoding and NFKC leave the JVM; rows that neither can change are
handed to Python as nulls, so they cost nothing there.
"""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Sequence
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from newsflow.fixed_values import (
    BOILERPLATE_PHRASES,
    CHARACTER_REPLACEMENTS,
    EMAIL_PATTERN,
    PHONE_PATTERN,
    TAG_PATTERN,
    TITLE_MARKERS,
    URL_PATTERN,
)
from newsflow.functions.tokens import bind

SPACES = r"\s\p{Z}\x1c-\x1f\x85"
SPACE = f"[{SPACES}]"
SPACE_CHARACTERS = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
WORD = r"[\p{L}\p{N}_]"
# The only characters a phone match can start with.
PHONE_START = r"(?=[+(0-9])"
_EDGE = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"
_NAMES = rf"[A-Z][a-z]+(?:{SPACE}+[A-Z][a-z]+)*"
_DATELINE = (
    rf"(?:Published|Updated|Posted)(?:{SPACE}+on)?{SPACE}+{WORD}+,{SPACE}+{WORD}+"
    rf"{SPACE}+\p{{Nd}}{{1,2}},{SPACE}+\p{{Nd}}{{4}}[^\n]*"
)


def unicode_pattern(pattern: str) -> str:
    """Spell out whitespace and word edges of a case-insensitive pattern."""
    return "(?iu)" + pattern.replace(r"\s", SPACES).replace(r"\b", _EDGE)


def _literal(text: str) -> str:
    return r"\Q" + text + r"\E"


def _to_arrow_strings(values: pa.Array, change) -> pa.Array:
    return pa.array([None if v is None else change(v) for v in values.to_pylist()], pa.string())


def _replace_characters(text: str) -> str:
    for old, new in CHARACTER_REPLACEMENTS:
        text = text.replace(old, new)
    return unicodedata.normalize("NFKC", text)


@F.arrow_udf(StringType())
def decode_udf(values: pa.Array) -> pa.Array:
    return _to_arrow_strings(values, html.unescape)


@F.arrow_udf(StringType())
def normalize_udf(values: pa.Array) -> pa.Array:
    return _to_arrow_strings(values, _replace_characters)


@F.arrow_udf(StringType())
def decode_normalize_udf(values: pa.Array) -> pa.Array:
    return _to_arrow_strings(values, lambda v: _replace_characters(html.unescape(v)))


def _where_needed(udf, c: Column, needed: Column) -> Column:
    return F.coalesce(udf(F.when(needed, c)), c)


def _has_entity(c: Column) -> Column:
    return c.contains("&")


def _has_non_ascii(c: Column) -> Column:
    return F.octet_length(c) != F.length(c)


def unescape_html(c: Column) -> Column:
    """Decode HTML5 character references."""
    return _where_needed(decode_udf, c, _has_entity(c))


def normalize_unicode(c: Column) -> Column:
    """Straighten quotes, dashes, ellipses and basic entities, then NFKC."""
    return _where_needed(normalize_udf, c, _has_entity(c) | _has_non_ascii(c))


def strip_urls(c: Column) -> Column:
    return F.regexp_replace(c, unicode_pattern(URL_PATTERN), " ")


def strip_emails(c: Column) -> Column:
    pattern = unicode_pattern(EMAIL_PATTERN)
    return bind(
        c, lambda v: F.when(v.contains("@"), F.regexp_replace(v, pattern, " ")).otherwise(v)
    )


def strip_phones(c: Column) -> Column:
    """Blank out phone-like digit runs. Separators are optional in the pattern, so years and
    prices of three or more digits go as well."""
    return F.regexp_replace(c, PHONE_START + unicode_pattern(PHONE_PATTERN), " ")


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, TAG_PATTERN, " ")


def collapse_whitespace(c: Column) -> Column:
    """Every run of whitespace becomes one space; single spaces are not touched at all."""
    return F.regexp_replace(c, rf"[{SPACES}&&[^ ]]{SPACE}*| {SPACE}+", " ")


def cap_newlines(c: Column) -> Column:
    return F.regexp_replace(c, r"\n{3,}", "\n\n")


def strip_edges(c: Column) -> Column:
    """Remove leading and trailing whitespace of any kind."""
    return F.trim(c, F.lit(SPACE_CHARACTERS))


def clean_text(
    c: Column,
    remove_urls: bool = True,
    remove_emails: bool = True,
    remove_phones: bool = True,
    normalize_spaces: bool = True,
    normalize_characters: bool = True,
    decode_entities: bool = True,
    remove_tags: bool = True,
    limit_newlines: bool = True,
) -> Column:
    """The cleaning steps in fixed order, each behind its flag; null becomes ''."""
    if decode_entities and normalize_characters:
        c = _where_needed(decode_normalize_udf, c, _has_entity(c) | _has_non_ascii(c))
    elif decode_entities:
        c = unescape_html(c)
    elif normalize_characters:
        c = normalize_unicode(c)
    steps = [
        (remove_urls, strip_urls),
        (remove_emails, strip_emails),
        (remove_phones, strip_phones),
        (remove_tags, strip_tags),
        (normalize_spaces, collapse_whitespace),
        (limit_newlines, cap_newlines),
    ]
    for wanted, step in steps:
        if wanted:
            c = step(c)
    c = F.trim(c) if normalize_spaces else strip_edges(c)
    return F.coalesce(c, F.lit(""))


def strip_boilerplate(c: Column, phrases: Sequence[str] | None = None) -> Column:
    """Replace each phrase and the rest of its line by a newline, phrase after phrase."""
    wanted = BOILERPLATE_PHRASES if phrases is None else list(phrases)
    if not wanted:
        return c

    def strip(text: Column) -> Column:
        stripped = text
        for phrase in wanted:
            stripped = F.regexp_replace(
                stripped, rf"(?iu){_literal(phrase)}[^\n]*(?:\n|\z)", "\n"
            )
        return F.when(_holds_phrase(text, wanted), stripped).otherwise(text)

    return bind(c, strip)


def _holds_phrase(c: Column, phrases: Sequence[str]) -> Column:
    """Whether any phrase may occur, so that texts without one skip the chain.

    Phrases whose letters are all ASCII are looked up in a case-folded copy; ``İ`` is the one
    letter that matches ``i`` without folding to it. Other phrases are searched as patterns.
    """
    plain = [p for p in phrases if all(x.isascii() or x.lower() == x.upper() for x in p)]
    other = [_literal(p) for p in phrases if p not in plain]

    def any_plain(folded: Column) -> Column:
        return reduce(or_, [folded.contains(p.lower()) for p in plain], F.lit(False))

    found = bind(F.lower(F.upper(F.replace(c, F.lit("İ"), F.lit("I")))), any_plain)
    return found | c.rlike("(?iu)" + "|".join(other)) if other else found


def strip_byline(c: Column) -> Column:
    """Remove a ``By First Last`` line at the start or the end."""
    c = F.regexp_replace(c, rf"^By{SPACE}+{_NAMES}{SPACE}*\n", "")
    return F.regexp_replace(c, rf"\n[Bb]y{SPACE}+{_NAMES}{SPACE}*\z", "")


def strip_pubinfo(c: Column) -> Column:
    """Remove a ``Published on Monday, May 5, 2025`` line at the start or the end."""
    c = F.regexp_replace(c, rf"^{_DATELINE}\n", "")
    return F.regexp_replace(c, rf"\n{_DATELINE}(\n?)\z", "$1")


def remove_boilerplate(
    c: Column,
    phrases: Sequence[str] | None = None,
    remove_author_line: bool = True,
    remove_publication_info: bool = True,
) -> Column:
    c = strip_boilerplate(c, phrases)
    if remove_author_line:
        c = strip_byline(c)
    if remove_publication_info:
        c = strip_pubinfo(c)
    return F.coalesce(strip_edges(c), F.lit(""))


def normalize_title(c: Column) -> Column:
    """Plain one-line title without markers and site suffix, first character upper-cased."""
    c = F.regexp_replace(unescape_html(c), "<[^>]+>", "")
    c = F.trim(collapse_whitespace(c))
    for marker in TITLE_MARKERS:
        c = F.regexp_replace(c, rf"(?iu)\[{marker}\]", "")
    c = F.regexp_replace(c, r"\|[^\n]*\z", "")
    c = F.regexp_replace(c, rf"-{SPACE}*{WORD}+\.{WORD}+\z", "")
    # Upper-casing comes before the last trim: a title that lost a leading marker keeps its case.
    c = F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 2**31 - 1))
    return F.coalesce(F.trim(c), F.lit(""))


def clean_article(articles: DataFrame) -> DataFrame:
    """Clean the article columns that are present, cell by cell; others pass unchanged."""
    from newsflow.operators.extract import clean_html, extract_main_content

    present = set(articles.columns)
    changes = {}
    if "title" in present:
        changes["title"] = normalize_title(F.col("title"))
    if "short_description" in present:
        changes["short_description"] = clean_text(F.col("short_description"))
    if "markdown_content" in present:
        # A projection of its own: the text is computed once, before and not again after Python.
        articles = articles.withColumn(
            "markdown_content", remove_boilerplate(F.col("markdown_content"))
        )
        changes["markdown_content"] = clean_text(
            F.col("markdown_content"), remove_urls=False, remove_tags=False
        )
    if "publish_time" in present:
        changes["publish_time"] = F.col("publish_time").cast("string")
    if "author" in present:
        changes["author"] = F.when(F.col("author").isNotNull(), clean_text(F.col("author")))
    cleaned = articles.withColumns(changes) if changes else articles
    if "html_content" in present:
        cleaned = clean_html(
            extract_main_content(cleaned, html_col="html_content", out_col="html_content"),
            html_col="html_content",
            out_col="html_content",
        )
    return cleaned

"""The text and token functions as SQL functions of the session.

Each body is SQL over the same patterns, so the optimiser inlines it and it stays in generated
code. Only entity decoding and Unicode normalisation call the registered Arrow functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from newsflow.fixed_values import (
    BOILERPLATE_PHRASES,
    EMAIL_PATTERN,
    MIN_TOKEN_LENGTH,
    PHONE_PATTERN,
    TAG_PATTERN,
    TITLE_MARKERS,
    URL_PATTERN,
)
from newsflow.functions import text as T
from newsflow.functions.tokens import NON_WORD_RUN


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    return f"'{escaped}'"


def _replace(expr: str, *steps: tuple[str, str]) -> str:
    for pattern, new in steps:
        expr = f"regexp_replace({expr}, {_quoted(pattern)}, {_quoted(new)})"
    return expr


def _chain(expr: str, *functions: str) -> str:
    for function in functions:
        expr = f"{function}({expr})"
    return expr


def _where(needed: str, change: str) -> str:
    """The change where c can hold what it looks for; other texts skip the pattern."""
    return f"CASE WHEN {needed} THEN {change} ELSE c END"


def _holds_phrase(phrases: Sequence[str]) -> str:
    """``text._holds_phrase`` in SQL, for phrases of ASCII letters: folds the text once."""
    folded = "lower(upper(replace(c, 'İ', 'I')))"
    found = " OR ".join(f"contains(f, {_quoted(p.lower())})" for p in phrases)
    return f"get(transform(array({folded}), f -> {found}), 0)"


def _bodies() -> dict[str, tuple[str, str]]:
    """name -> (return type, body over the parameter c)."""
    phrases = _replace("c", *[
        (rf"(?iu)\Q{phrase}\E[^\n]*(?:\n|\z)", "\n") for phrase in BOILERPLATE_PHRASES
    ])
    markers = [(rf"(?iu)\[{marker}\]", "") for marker in TITLE_MARKERS]
    title_tail = [(r"\|[^\n]*\z", ""), (rf"-{T.SPACE}*{T.WORD}+\.{T.WORD}+\z", "")]
    title = _replace(
        f"trim(collapse_whitespace({_replace('unescape_html(c)', ('<[^>]+>', ''))}))",
        *markers, *title_tail,
    )
    non_ascii = "octet_length(c) <> length(c)"
    strings = {
        "unescape_html": "coalesce(decode_entities(CASE WHEN contains(c, '&') THEN c END), c)",
        "normalize_unicode": (
            "coalesce(normalize_characters("
            f"CASE WHEN contains(c, '&') OR {non_ascii} THEN c END), c)"
        ),
        "strip_urls": _where("contains(c, '://')", _replace("c", (T.unicode_pattern(URL_PATTERN), " "))),
        "strip_emails": _where("contains(c, '@')", _replace("c", (T.unicode_pattern(EMAIL_PATTERN), " "))),
        "strip_phones": _replace("c", (T.PHONE_START + T.unicode_pattern(PHONE_PATTERN), " ")),
        "strip_tags": _where("contains(c, '<')", _replace("c", (TAG_PATTERN, " "))),
        # Single spaces are not touched at all.
        "collapse_whitespace": _replace("c", (rf"[{T.SPACES}&&[^ ]]{T.SPACE}*| {T.SPACE}+", " ")),
        "cap_newlines": _where(r"contains(c, '\n\n\n')", _replace("c", (r"\n{3,}", "\n\n"))),
        "clean_text": "coalesce(trim(" + _chain(
            f"coalesce(decode_normalize(CASE WHEN contains(c, '&') OR {non_ascii} THEN c END), c)",
            "strip_urls", "strip_emails",
            "strip_phones", "strip_tags", "collapse_whitespace", "cap_newlines",
        ) + "), '')",
        "strip_boilerplate": _where(_holds_phrase(BOILERPLATE_PHRASES), phrases),
        "normalize_title": (
            "coalesce(trim(get(transform(array(" + title + "), "
            "t -> concat(upper(substring(t, 1, 1)), substring(t, 2))), 0)), '')"
        ),
    }
    tokens = {
        "tokenize": f"array_remove(split(lower(c), {_quoted(NON_WORD_RUN)}), '')",
        "trend_tokens": f"filter(tokenize(c), t -> length(t) >= {MIN_TOKEN_LENGTH})",
    }
    return {
        **{name: ("STRING", body) for name, body in strings.items()},
        **{name: ("ARRAY<STRING>", body) for name, body in tokens.items()},
    }


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Make the functions usable in ``spark.sql`` and return their names."""
    spark.udf.register("decode_entities", T.decode_udf)
    spark.udf.register("normalize_characters", T.normalize_udf)
    spark.udf.register("decode_normalize", T.decode_normalize_udf)
    bodies = _bodies()
    for name, (result, body) in bodies.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(c STRING) RETURNS {result} RETURN {body}"
        )
    return list(bodies)

"""Tokens and n-grams as array columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsflow.fixed_values import MIN_TOKEN_LENGTH

# Letters, numbers and underscore of any script; combining marks separate tokens.
NON_WORD_RUN = r"[^\p{L}\p{N}_]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body applied to a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tokenize(text: Column | str) -> Column:
    """Lower-cased word tokens in order, without empty ones; null text gives null."""
    return F.array_remove(F.split(F.lower(_col(text)), NON_WORD_RUN), "")


def filter_tokens(
    tokens: Column | str,
    stop: Column | Sequence[str] | None = None,
    min_len: int = MIN_TOKEN_LENGTH,
) -> Column:
    """Tokens of at least min_len characters that are no stop words; repeats are kept."""
    if stop is None:
        return F.filter(_col(tokens), lambda t: F.length(t) >= min_len)
    if isinstance(stop, Column):
        return F.filter(
            _col(tokens), lambda t: (F.length(t) >= min_len) & ~F.array_contains(stop, t)
        )
    words = list(stop)
    if not words:
        return filter_tokens(tokens, None, min_len)
    return F.filter(_col(tokens), lambda t: (F.length(t) >= min_len) & ~t.isin(words))


def ngrams(tokens: Column | str, n: int) -> Column:
    """All runs of n consecutive tokens, joined by a space; empty when there are fewer than n."""
    def grams(t: Column) -> Column:
        count = F.size(t) - (n - 1)
        runs = F.transform(
            F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
            lambda i: F.array_join(F.slice(t, i, n), " "),
        )
        return F.when(count >= 1, runs).otherwise(F.array().cast("array<string>"))

    return bind(_col(tokens), grams)

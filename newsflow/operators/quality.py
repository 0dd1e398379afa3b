"""Row rules: every failure of every row, in one pass and without a shuffle."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions.text import strip_edges
from newsflow.functions.times import time_frame_seconds
from newsflow.operators.skew import join_dimension
from newsflow.schemas import VIOLATION


@dataclass(frozen=True)
class Rule:
    """A named check of one field; ``message`` is null for a good value."""

    field: str
    name: str
    message: Column


def _missing(value: Column) -> Column:
    return value.isNull() | (value == "")


def _first_failure(required: bool, missing: Column, label: str, message: Column) -> Column:
    absent = F.lit(f"{label} is required") if required else F.lit(None).cast("string")
    return F.when(missing, absent).otherwise(message)


def url_message(url: Column, required: bool = True) -> Column:
    trimmed = strip_edges(url)
    scheme = F.lower(F.regexp_extract(trimmed, r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1))
    authority = F.regexp_extract(trimmed, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    message = F.when((scheme == "") | (authority == ""), "invalid URL format").when(
        ~scheme.isin("http", "https"), "URL must use HTTP or HTTPS"
    )
    return _first_failure(required, _missing(url), "URL", message)


def valid_url(field: str, required: bool = True) -> Rule:
    return Rule(field, "url", url_message(F.col(field), required))


def valid_url_list(field: str) -> Rule:
    """Array of URLs: not empty, and the index of the first bad one is reported."""
    messages = F.transform(
        F.col(field),
        lambda u, i: F.concat(F.lit("URL at index "), i.cast("string"), F.lit(": "), url_message(u)),
    )
    first = F.get(F.filter(messages, lambda m: m.isNotNull()), F.lit(0))
    empty = F.col(field).isNull() | (F.size(field) == 0)
    return Rule(field, "urls", F.when(empty, "at least one URL is required").otherwise(first))


def time_frame(field: str) -> Rule:
    value = F.col(field)
    message = F.when(time_frame_seconds(value).isNull(), "time frame must look like 12h, 2d or 30m")
    return Rule(field, "time_frame", _first_failure(True, _missing(value), field, message))


def _date_shape(fmt: str) -> str:
    """Pattern of the digits a numeric format asks for; any text for other formats."""
    shape = ""
    for letters, other in re.findall(r"([A-Za-z]+)|([^A-Za-z]+)", fmt):
        if other:
            shape += re.escape(other)
        elif letters == "yyyy":
            shape += r"\d{4}"
        elif letters in ("MM", "dd", "HH", "mm", "ss"):
            shape += r"\d{2}"
        elif letters in ("M", "d", "H", "m", "s"):
            shape += r"\d{1,2}"
        else:
            return "(?s).*"
    return shape


def date_format(field: str, fmt: str = "yyyy-M-d") -> Rule:
    """A text that parses with the format. The shape is tested first, as a failed parse is slow."""
    value = strip_edges(F.col(field))
    parsed = F.when(
        value.rlike(rf"^{_date_shape(fmt)}\z"), F.try_to_timestamp(value, F.lit(fmt))
    )
    message = F.when(parsed.isNull(), f"no date of format {fmt}")
    return Rule(
        field, "date_format", _first_failure(True, _missing(F.col(field)), field, message)
    )


def positive_int(field: str, required: bool = True) -> Rule:
    number = F.col(field).try_cast("bigint")
    message = F.when(number.isNull(), f"{field} must be an integer").when(
        number <= 0, f"{field} must be positive"
    )
    return Rule(
        field, "positive_int", _first_failure(required, F.col(field).isNull(), field, message)
    )


def choice(
    field: str, choices: Sequence, required: bool = True, fold_case: bool = False
) -> Rule:
    value = F.col(field)
    compared = F.lower(strip_edges(value)) if fold_case else value
    options = ", ".join(str(c) for c in choices)
    message = F.when(~compared.isin(list(choices)), f"{field} must be one of: {options}")
    return Rule(field, "choice", _first_failure(required, value.isNull(), field, message))


def sort_order(field: str) -> Rule:
    return choice(field, ["asc", "desc"], fold_case=True)


def required_keys(field: str, keys: Sequence[str]) -> Rule:
    """Map column that has to hold all keys."""
    value = F.col(field)
    absent = F.filter(
        F.array(*[F.when(~F.map_contains_key(value, k), F.lit(k)) for k in keys]),
        lambda k: k.isNotNull(),
    )
    message = F.when(
        F.size(absent) > 0, F.concat(F.lit("missing keys: "), F.array_join(absent, ", "))
    )
    empty = value.isNull() | (F.size(value) == 0)
    return Rule(field, "required_keys", _first_failure(True, empty, field, message))


def with_default(value: Column, default) -> Column:
    """Default for a missing optional value."""
    return F.coalesce(value, F.lit(default))


def _checks(rules: Sequence[Rule]) -> Column:
    """One entry per rule; the message is null where the row meets it."""
    return F.array(
        *[
            F.struct(
                F.lit(r.field).alias("field"), F.lit(r.name).alias("rule"),
                r.message.alias("message"),
            ).cast(VIOLATION)
            for r in rules
        ]
    )


def with_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``violations``: an array with one entry per failed rule."""
    failed = F.filter(_checks(rules), lambda v: v["message"].isNotNull())
    return df.withColumn("violations", failed)


def validate_rows(df: DataFrame, row_key: str, rules: Sequence[Rule]) -> DataFrame:
    """All failures as ``(row_key, field, rule, message)``."""
    checked = df.select(
        F.col(row_key).cast("string").alias("row_key"), F.explode(_checks(rules)).alias("v")
    )
    return checked.select("row_key", "v.*").where(F.col("message").isNotNull())


def clean_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break no rule; a filter on the same scan instead of a join back."""
    broken = [r.message.isNotNull() for r in rules]
    return df.where(~reduce(or_, broken)) if broken else df


def in_dimension(
    df: DataFrame, name_col: str, dimension: DataFrame, key_col: str, known: bool = True
) -> DataFrame:
    """Rows whose trimmed, lower-cased name is (or is not) in the dimension."""
    keys = dimension.select(F.col(key_col).alias("_known")).distinct()
    named = df.withColumn("_known", F.lower(strip_edges(F.col(name_col))))
    matched = join_dimension(named, keys, "_known", "left_semi" if known else "left_anti")
    return matched.select(*df.columns)


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The table itself when it has the columns and at least one row; an error otherwise."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    if not df.isStreaming and df.isEmpty():
        raise ValueError("table must not be empty")
    return df



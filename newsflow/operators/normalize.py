"""Bring feed tables to one set of columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.fixed_values import FEED_COLUMN_ALIASES


def standardize_columns(df: DataFrame, mapping: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rename every present alias to its canonical name; several aliases are coalesced in order."""
    canonical_of = {alias: name for name, aliases in mapping.items() for alias in aliases}
    columns, done = [], set()
    for column in df.columns:
        name = canonical_of.get(column, column)
        if name in done:
            continue
        done.add(name)
        if name in mapping:
            sources = [c for c in [name, *mapping[name]] if c in df.columns]
            columns.append(F.coalesce(*[F.col(f"`{c}`") for c in sources]).alias(name))
        else:
            columns.append(F.col(f"`{column}`"))
    return df.select(*columns)


def normalize_feed(df: DataFrame) -> DataFrame:
    """Lower-case column names, then link and publish_time under one name each."""
    lowered = df.select(*[F.col(f"`{c}`").alias(c.lower()) for c in df.columns])
    return standardize_columns(lowered, FEED_COLUMN_ALIASES)


def with_provenance(df: DataFrame, source: Column, run_ts: datetime) -> DataFrame:
    """Add where a row came from and the UTC time of the run that read it."""
    return df.withColumns(
        {
            "feed_source": source,
            "feed_time": F.lit(run_ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp"),
        }
    )


def with_site(df: DataFrame, site: str) -> DataFrame:
    return df.withColumn("site_name", F.lit(site))

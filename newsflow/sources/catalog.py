"""Dimension tables and landed files: sites, overrides, stop words, pages, earlier results."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.fixed_values import RSS_MAPPING, SELECTOR_NAMES, SITE_CATALOGUE
from newsflow.functions.text import strip_edges
from newsflow.functions.tokens import NON_WORD_RUN
from newsflow.schemas import ARTICLES, PAGES, SITE_OVERRIDES, SITES


def default_site_catalog(spark: SparkSession) -> DataFrame:
    """The built-in sites as a table of the declared schema."""
    rows = [
        (
            site,
            sitemap_url,
            zero_pad,
            {name: pair for name, pair in zip(SELECTOR_NAMES, selectors, strict=True)},
            (rss_urls, RSS_MAPPING) if rss_urls else None,
        )
        for site, sitemap_url, zero_pad, selectors, rss_urls in SITE_CATALOGUE
    ]
    return spark.createDataFrame(rows, SITES)


def read_site_catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SITES).json(path)


def read_site_overrides(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SITE_OVERRIDES).json(path)


def _is_missing(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def stopword_table(spark: SparkSession, path: str) -> DataFrame:
    """Distinct lower-cased stop words ``(word, multi_word)``; a missing file gives none.

    Comment lines are those whose first character is ``#``. A word that tokenises into several
    tokens can never match one and is flagged.
    """
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if not _is_missing(error):
            raise
        lines = spark.createDataFrame([], "value string")
    word = F.lower(strip_edges(F.col("value")))
    return (
        lines.where(~F.col("value").startswith("#"))
        .select(word.alias("word"))
        .where(F.col("word") != "")
        .distinct()
        .withColumn("multi_word", F.col("word").rlike(NON_WORD_RUN))
    )


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """The single-token stop words ``(word)``, for ``without_stopwords``."""
    return stopword_table(spark, path).where(~F.col("multi_word")).select("word")


def read_pages(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Landed pages ``(url, html, landed_at)``; other columns are not read.

    Where the files have no ``landed_at``, or a row has none, it is the time its file was written.
    """
    reader = spark.readStream if stream else spark.read
    rows = reader.schema(f"{PAGES}, landed_at timestamp").parquet(path)
    landed = F.coalesce("landed_at", F.col("_metadata.file_modification_time"))
    return rows.select("url", "html", landed.alias("landed_at"))


def read_prior_results(spark: SparkSession, path: str, schema: str = ARTICLES) -> DataFrame:
    """Articles of earlier CSV output; an empty table when there is none."""
    try:
        return (
            spark.read.schema(schema)
            .option("header", True).option("multiLine", True).option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .csv(path)
        )
    except AnalysisException as error:
        if not _is_missing(error):
            raise
        return spark.createDataFrame([], schema)

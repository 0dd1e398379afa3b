"""RSS and sitemap payloads as tables; works on batch and streaming DataFrames.

A feed that is no well-formed XML, or has items or tags that the parser does not see, is scanned for items.
Damaged payloads and those without rows of their kind show up in ``feed_errors``; other feeds are not affected.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.fixed_values import RSS_MAPPING, SITEMAP_SHARD_PREFIX
from newsflow.functions.text import strip_edges
from newsflow.functions.times import parse_publish_time
from newsflow.schemas import PAYLOADS
from newsflow.sources.rss_scan import scan_items

_SITEMAP_TYPE = "url array<struct<loc:array<string>,lastmod:array<string>>>"
# A named character reference other than the five of XML.
_HTML_NAME = r"&(?!amp;|lt;|gt;|quot;|apos;)([A-Za-z][A-Za-z0-9]*);"
_OUTSIDE_CDATA = re.compile(r"<!\[CDATA\[.*?\]\]>|" + _HTML_NAME, re.DOTALL)
_INDEX_TYPE = "sitemap array<struct<loc:array<string>>>"


def read_feed_payloads(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Landed payload table ``(feed_source, payload)`` from Parquet files."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(PAYLOADS).parquet(path)


def _tag_list(mapping: Mapping[str, str]) -> str:
    # A repeated tag is read as a list so that its first occurrence counts.
    return ",".join(f"`{tag}`:array<string>" for tag in dict.fromkeys(mapping.values()))


@F.arrow_udf(T.StringType())
def _spelled_out(payloads: pa.Array) -> pa.Array:
    """References to characters that XML does not know by name, as the characters themselves."""
    def character(match: re.Match) -> str:
        return match[0] if match[1] is None else html5.get(f"{match[1]};", match[0])

    return pa.array(
        [None if p is None else _OUTSIDE_CDATA.sub(character, p) for p in payloads.to_pylist()], pa.string())


def _readable(payload: Column) -> Column:
    """The payload without HTML names that XML parsers refuse; only payloads with one go to Python."""
    named = payload.rlike(_HTML_NAME)
    return F.coalesce(_spelled_out(F.when(named, payload)), payload)


def _misread(payload: Column, items: Column, tags: list[str]) -> Column:
    """Whether a payload has other items or tags than were parsed, or tags inside of tags."""
    tag = "|".join(map(re.escape, tags))
    # CDATA sections and comments may stand before the inner tag.
    inner = rf"<(?:{tag})(?:\s[^<>]*+)?>[^<]*+(?:<!(?:\[CDATA\[(?s:.*?)\]\]>|--(?s:.*?)-->)[^<]*+)*+<[A-Za-z_]"
    values = F.flatten(F.transform(items, lambda it: F.concat(*[F.coalesce(it[t], F.array()) for t in tags])))
    of_items = F.substring(payload, F.locate("<item", payload), F.length(payload))
    return (
        (F.regexp_count(payload, F.lit(r"<item[\s/>]")) != F.size(items))
        | ((F.size(items) > 0) & (F.regexp_count(of_items, F.lit(rf"<(?:{tag})[\s/>]")) != F.size(values)))
        | payload.rlike(inner)
    )


def _with_rss_items(payloads: DataFrame, payload: Column, mapping: Mapping[str, str]) -> DataFrame:
    """Add `__items`, an array with a struct of the mapped tags per item, and `__damaged`, whether the XML parser
    refuses the payload. Only payloads that ``from_xml`` reads differently go to Python."""
    tags = list(dict.fromkeys(mapping.values()))
    item = f"array<struct<{_tag_list(mapping)}>>"
    kind = pa.list_(pa.struct([(tag, pa.list_(pa.string())) for tag in tags]))

    @F.arrow_udf(item)
    def scanned(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else scan_items(t, tags) for t in texts.to_pylist()], kind)

    # RSS 2.0 keeps items inside the channel, RSS 1.0 beside it.
    schema = f"channel struct<item:{item}>, item {item}, _corrupt_record string"
    doc = payloads.withColumn("__doc", F.from_xml(_readable(payload), schema))
    doc = doc.withColumn("__damaged", F.col("__doc._corrupt_record").isNotNull())
    parsed = doc.withColumn("__items", F.concat(
        F.coalesce("__doc.channel.item", F.array()), F.coalesce("__doc.item", F.array()))).drop("__doc")
    again = scanned(F.when(_misread(payload, F.col("__items"), tags), payload))
    return parsed.withColumn("__items", F.coalesce(again, "__items"))


def _first_text(tag: Column) -> Column:
    return strip_edges(F.get(tag, F.lit(0)))


def _rss_fields(item: str, mapping: Mapping[str, str], description_format: str, tz_mode: str):
    from newsflow.operators.extract import rss_description

    fields = []
    for name, tag in mapping.items():
        value = _first_text(F.col(f"{item}.`{tag}`"))
        if name == "description":
            value = rss_description(value, description_format)
        elif name == "publish_time":
            value = parse_publish_time(value, tz_mode)
        fields.append(value.alias(name))
    return fields


def read_rss_items(
    payloads: DataFrame,
    mapping: Mapping[str, str] = RSS_MAPPING,
    description_format: str = "text",
    tz_mode: str = "utc",
) -> DataFrame:
    """One row per ``<item>``, at any depth, with its position in the feed; mapping is field -> tag.

    A field is the text of the first element of its tag, with the text of tags inside it. Damaged feeds give
    the items that ``scan_items`` finds."""
    rows = _with_rss_items(payloads, F.col("payload"), mapping).select("feed_source", F.posexplode("__items").alias("pos", "it"))
    return rows.select(
        "feed_source", "pos", *_rss_fields("it", mapping, description_format, tz_mode)
    )


def read_rss_files(
    spark: SparkSession,
    path: str,
    mapping: Mapping[str, str] = RSS_MAPPING,
    description_format: str = "text",
    tz_mode: str = "utc",
    stream: bool = False,
) -> DataFrame:
    """Items of RSS files; the file is the feed source. A file has to be one XML document: of
    several documents put together in a file, only items of the first are read."""
    reader = spark.readStream if stream else spark.read
    schema = ",".join(f"`{tag}` array<string>" for tag in dict.fromkeys(mapping.values()))
    rows = (
        reader.format("xml").option("rowTag", "item").schema(schema).load(path)
        .select(F.struct("*").alias("it"), F.col("_metadata.file_path").alias("feed_source"))
    )
    return rows.select("feed_source", *_rss_fields("it", mapping, description_format, tz_mode))


def _sitemap_fields(entry: str):
    return [
        _first_text(F.col(f"{entry}.loc")).alias("url"),
        parse_publish_time(_first_text(F.col(f"{entry}.lastmod"))).alias("lastmod"),
    ]


def read_sitemap_urls(payloads: DataFrame) -> DataFrame:
    """One row per ``<url>`` of a url set; an unreadable lastmod becomes null."""
    doc = payloads.withColumn("doc", F.from_xml(F.col("payload"), _SITEMAP_TYPE))
    rows = doc.select("feed_source", F.posexplode("doc.url").alias("pos", "entry"))
    return rows.select("feed_source", "pos", *_sitemap_fields("entry"))


def read_sitemap_files(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Entries of sitemap files, one XML document per file."""
    reader = spark.readStream if stream else spark.read
    rows = (
        reader.format("xml").option("rowTag", "url")
        .schema("loc array<string>, lastmod array<string>").load(path)
        .select(F.struct("*").alias("entry"), F.col("_metadata.file_path").alias("feed_source"))
    )
    return rows.select("feed_source", *_sitemap_fields("entry"))


def feed_errors(payloads: DataFrame, kind_col: str = "kind") -> DataFrame:
    """Payloads that cannot be read as their kind, with the reason. A feed that is no well-formed XML is one
    of them, whatever items are found in it."""
    sitemap = F.from_xml(F.col("payload"), _SITEMAP_TYPE)
    kind = F.col(kind_col)
    reason = (
        F.when(F.coalesce(strip_edges(F.col("payload")), F.lit("")) == "", "empty payload")
        .when(kind == "error", "unknown source format")
        .when((kind == "rss") & ((F.size("__items") == 0) | F.col("__damaged")), "no readable rss items")
        .when((kind == "sitemap") & sitemap["url"].isNull(), "no readable sitemap entries")
    )
    read = _with_rss_items(payloads, F.when(kind == "rss", F.col("payload")), RSS_MAPPING)
    return read.withColumn("error", reason).drop("__items", "__damaged").where(F.col("error").isNotNull())


def classify_sources(
    df: DataFrame, url_col: str = "feed_source", payload_col: str = "payload"
) -> DataFrame:
    """Add ``kind``: rss, sitemap or error. The URL suffix decides before the payload does."""
    url, payload = F.col(url_col), F.col(payload_col)
    kind = (
        F.when(url.endswith(".rss"), "rss")
        .when(url.endswith(".xml"), "sitemap")
        .when(payload.contains("<rss") | payload.contains("<channel>"), "rss")
        .when(payload.contains("<urlset"), "sitemap")
        .otherwise("error")
    )
    return df.withColumn("kind", kind)


def latest_sitemap_shard(
    index_payloads: DataFrame, prefix: str = SITEMAP_SHARD_PREFIX, default_col: str | None = None
) -> DataFrame:
    """Per sitemap index the shard URL with the largest number; the configured URL if none."""
    number = F.regexp_extract("loc", rf"{prefix}(\d+)\.xml", 1).try_cast("bigint")
    default = F.col(default_col) if default_col else F.lit(None).cast("string")
    shards = (
        index_payloads.select(
            "feed_source",
            default.alias("default_url"),
            F.explode_outer(
                F.from_xml(F.col("payload"), _INDEX_TYPE)["sitemap"]
            ).alias("entry"),
        )
        .withColumn("loc", _first_text(F.col("entry.loc")))
        .withColumn("number", number)
    )
    return shards.groupBy("feed_source").agg(
        F.coalesce(F.max_by("loc", "number"), F.first("default_url")).alias("latest_url")
    )

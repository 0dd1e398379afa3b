"""Streams over landed feeds and articles, and the sinks of a monitoring run."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import UTC, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newsflow.fixed_values import (
    ARTICLES_PER_SITE,
    MIN_TOKEN_LENGTH,
    MONITOR_INTERVAL,
    MONITOR_WINDOW,
    NGRAM_SIZES,
    TOP_TRENDS,
)
from newsflow.operators.aggregates import monitor_report, site_report
from newsflow.keyed_store import KeyedStore
from newsflow.operators.articles import new_articles, with_key_only
from newsflow.operators.filters import ok_rows, quarantine, within
from newsflow.operators.joins import carry_site
from newsflow.operators.ranking import first_per_key
from newsflow.operators.trending import top_trends, trending
from newsflow.plans import NOT_LANDED, feed_table, fetch_articles, top_per_site
from newsflow.schemas import TRENDS
from newsflow.session import free_shuffles
from newsflow.sinks import (
    append_to_store,
    read_store,
    write_archive,
    write_latest,
    write_report,
    write_table,
)
from newsflow.sources.catalog import read_pages
from newsflow.streaming.trends import add_counts, top_of_runs

BatchSink = Callable[[DataFrame, int], None]

DEDUP_SALTS = 16
LAST_BATCH = 2**62


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep state on executor disks with changelog checkpoints; phrase state outgrows the heap."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    prefix = "spark.sql.streaming.stateStore.rocksdb"
    spark.conf.set(f"{prefix}.changelogCheckpointing.enabled", "true")
    # Counting keys costs a lookup per write and serves the progress report only.
    spark.conf.set(f"{prefix}.trackTotalNumberOfRows", "false")
    # Keys are texts that much resemble each other; files and changelogs are several times the input.
    spark.conf.set(f"{prefix}.compression", "zstd")
    spark.conf.set("spark.sql.streaming.stateStore.compression.codec", "zstd")


def monitor(
    stream: DataFrame,
    sink: BatchSink,
    checkpoint: str,
    interval: str = MONITOR_INTERVAL,
    available_now: bool = False,
    output_mode: str = "append",
) -> StreamingQuery:
    """Run the sink at the start and then every interval, or once over everything landed.

    Progress lives in the checkpoint: a restarted query goes on after the last finished batch.
    """
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (
        stream.writeStream.foreachBatch(sink)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def stream_new_articles(
    stream: DataFrame, key: str = "url", time_col: str = "collected_at", ttl: str = "30 days"
) -> DataFrame:
    """First arrival of each key within the retention time.

    A first, salted round spreads the repeats of a hot key over several tasks; the second round
    then sees at most one row per key and salt.
    """
    other = [F.col(f.name) for f in stream.schema if f.dataType.typeName() != "map"]
    return (
        with_key_only(stream, key)
        .withColumn("_salt", F.pmod(F.xxhash64(*other), F.lit(DEDUP_SALTS)))
        .withWatermark(time_col, ttl)
        .dropDuplicatesWithinWatermark([key, "_salt"])
        .dropDuplicatesWithinWatermark([key])
        .drop("_salt")
    )


def stream_trending(
    stream: DataFrame,
    text_cols: Sequence[str],
    ngram_range: Sequence[int] = NGRAM_SIZES,
    stop: Column | Sequence[str] | None = None,
    min_len: int = MIN_TOKEN_LENGTH,
) -> DataFrame:
    """Running phrase counter; write it in update mode, so a run emits only changed phrases."""
    return trending(stream, text_cols, ngram_range, stop, min_len)


def _batch_before(spark: SparkSession, path: str, batch_id: int, schema: str) -> DataFrame:
    """Rows that the batch just before this one wrote below path."""
    try:
        return spark.read.schema(schema).parquet(f"{path}/batch_id={batch_id - 1}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _latest_before(spark: SparkSession, path: str, batch_id: int, schema: str) -> DataFrame:
    """Rows of the newest earlier batch below path, none if there is no earlier one."""
    try:
        rows = spark.read.schema(f"{schema}, batch_id bigint").option("basePath", path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    earlier = rows.where(F.col("batch_id") < batch_id)
    newest = earlier.agg(F.max("batch_id")).first()[0]
    return earlier.where(F.col("batch_id") == F.lit(newest).cast("bigint")).drop("batch_id")


def top_trends_sink(path: str, n: int = TOP_TRENDS) -> BatchSink:
    """Keep the exact top n of a running counter, from changed phrases alone.

    Counts only grow. So a phrase that did not change can be in the new list only if it was in
    the old one, and a changed phrase that misses the n best changed ones is outranked by n others
    even with its old count. One pass over the changed phrases and the n rows before is enough.
    """

    def sink(changed: DataFrame, batch_id: int) -> None:
        free_shuffles(changed.sparkSession)
        before = _latest_before(changed.sparkSession, path, batch_id, TRENDS)
        candidates = top_trends(changed.select("phrase", "cnt"), n).unionByName(before)
        newest = candidates.groupBy("phrase").agg(F.max("cnt").alias("cnt"))
        write_table(top_trends(newest, n), f"{path}/batch_id={batch_id}")

    return sink


def stream_trending_window(
    stream: DataFrame,
    time_col: str,
    phrase_col: str = "phrase",
    length: str = "7 days",
    slide: str = "1 day",
    lateness: str = "1 day",
) -> DataFrame:
    """Counts per phrase and sliding window; the watermark bounds the state."""
    timed = stream.withColumn(time_col, F.col(time_col).cast("timestamp"))
    if stream.isStreaming:
        timed = timed.withWatermark(time_col, lateness)
    counted = timed.groupBy(F.window(time_col, length, slide).alias("w"), phrase_col).agg(
        F.count(F.lit(1)).alias("cnt")
    )
    return counted.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        phrase_col, "cnt",
    )


def stream_site_counts(stream: DataFrame, site_col: str = "site_name") -> DataFrame:
    """Running number of articles per site."""
    return stream.groupBy(site_col).agg(F.count(F.lit(1)).alias("new_articles"))


def admit_in_time(
    batch: DataFrame, as_of: datetime, time_col: str = "publish_time", frame: str = MONITOR_WINDOW
) -> DataFrame:
    """Rows that are not too late. A watermark only bounds state; this filter decides."""
    return within(batch, time_col, frame, as_of)


def monitor_sink(
    root: str,
    sites: DataFrame,
    arrival: Sequence[Column],
    as_of: datetime | None = None,
    stop: Sequence[str] | None = None,
    top_path: str | None = None,
    keep_for: timedelta | None = None,
    buckets: int = 16,
) -> BatchSink:
    """Sink of one monitoring run: article table, latest and archive CSV, trends and report.

    Every part is written below a folder of its batch, so a repeated batch replaces itself. Rows with
    an error go to the table ``quarantine`` alone, so the CSVs hold articles only. Whether a URL was
    stored before is asked of the keyed table ``seen``, of which only the batch's buckets are read. Phrase
    counts are merged in generations; with ``top_path``, the folder a ``top_trends_sink`` keeps
    current, the report reads that list instead. Totals per site are those of the run before plus
    this one's. After ``keep_for``, a URL may be stored anew.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        free_shuffles(batch.sparkSession)
        now = as_of or datetime.now(UTC).replace(tzinfo=None, microsecond=0)
        run = write_table(batch, f"{root}/runs/batch_id={batch_id}")
        _record(run, batch_id, root, sites, arrival, now, stop, top_path, keep_for, buckets)

    return sink


def seen_urls(spark: SparkSession, root: str, buckets: int = 16) -> KeyedStore:
    """Every URL that a run has settled, and whether its article was stored."""
    return KeyedStore(spark, f"{root}/seen", "url string, stored boolean, collected_at timestamp", buckets=buckets)


def _record(
    run: DataFrame, batch_id: int, root: str, sites: DataFrame, arrival: Sequence[Column], now: datetime,
    stop: Sequence[str] | None, top_path: str | None, keep_for: timedelta | None, buckets: int,
) -> None:
    """Everything that a run leaves behind; ``run`` is a written table."""
    spark, good, stamp = run.sparkSession, run, _stamp(now)
    seen = seen_urls(spark, root, buckets)
    failed = run.select("url").limit(0)
    if "error" in run.columns:
        good, failed = ok_rows(run), quarantine(run).select("url")
        write_table(quarantine(run), f"{root}/quarantine/batch_id={batch_id}")

    stamped = good.withColumn("collected_at", stamp)
    known = seen.near(run, batch_id)
    if keep_for is not None:
        known = known.where(F.col("collected_at") >= _stamp(now - keep_for))
    known = known.where("stored").select("url")
    fresh = append_to_store(new_articles(stamped, known, arrival), f"{root}/store", batch_id)
    write_latest(good, f"{root}/latest")
    write_archive(good, f"{root}/archive", now, batch_id)

    # A URL that failed and was stored in the same run is stored; what is stored is not marked as failed.
    urls = fresh.select("url", F.lit(True).alias("stored")).unionByName(
        with_key_only(failed, "url").join(known, "url", "left_anti").withColumn("stored", F.lit(False)))
    urls = urls.groupBy("url").agg(F.max("stored").alias("stored")).withColumn("collected_at", stamp)
    since = None if keep_for is None else now - keep_for
    seen.merge(write_table(urls, f"{root}/settled/batch_id={batch_id}"), batch_id, since=since)

    if top_path is None:
        # The batch itself has been dealt out and written several times by now.
        free_shuffles(spark)
        add_counts(trending(fresh, ["title", "short_description"], stop=stop), f"{root}/trends", batch_id)
        trends = top_of_runs(spark, f"{root}/trends", batch_id)
    else:
        trends = _latest_before(spark, top_path, LAST_BATCH, TRENDS)
    # Counters need no row match: all fetched rows, and the rows that were stored as new.
    fetched = run.select("site_name", F.lit(1).alias("fetched"), F.lit(0).alias("new_articles"))
    stored = fresh.select("site_name", F.lit(0).alias("fetched"), F.lit(1).alias("new_articles"))
    sums = [F.sum(c).alias(c) for c in ("fetched", "new_articles")]
    latest = write_table(
        fetched.unionByName(stored).groupBy("site_name").agg(*sums), f"{root}/counters/batch_id={batch_id}")
    before = _batch_before(spark, f"{root}/totals", batch_id, _ddl(latest))
    totals = write_table(
        before.unionByName(latest).groupBy("site_name").agg(*sums), f"{root}/totals/batch_id={batch_id}")
    # Only rows of the last day are asked for, and dates are partitions.
    stored_rows = read_store(spark, f"{root}/store", batch_id + 1, _ddl(fresh))
    write_report(monitor_report(totals, stored_rows, trends, sites, now, latest), f"{root}/report/batch_id={batch_id}")
    write_table(site_report(totals, sites), f"{root}/report_sites/batch_id={batch_id}")


def collection_sink(
    root: str,
    pages: Callable[[SparkSession], DataFrame] | str | DataFrame,
    sites: DataFrame,
    as_of: datetime | None = None,
    time_frame: str = MONITOR_WINDOW,
    per_site: int | None = ARTICLES_PER_SITE,
    stop: Sequence[str] | None = None,
    top_path: str | None = None,
    retry_for: timedelta = timedelta(days=1),
    keep_for: timedelta | None = None,
    buckets: int = 16,
) -> BatchSink:
    """A whole run on a batch of feed payloads: items in time, the newest per site (None: all), their
    pages, then the sinks of ``monitor_sink``.

    ``pages`` is a folder or a function that reads it, asked anew in every run, so pages that land
    after the start are seen; a DataFrame stands for the files it was made from.

    Items are known by their link. However many polls and feeds list one, it is fetched, counted and
    archived once: links that a run has settled are skipped. A link whose page has not landed has one
    row in the table ``retry``, with the times it was first and last asked for and how often; the next runs ask
    again, whether it is listed or not, until ``retry_for`` after the first, and then it goes to
    quarantine. Items without a link go there at once.
    """

    def sink(payloads: DataFrame, batch_id: int) -> None:
        now = as_of or datetime.now(UTC).replace(tzinfo=None, microsecond=0)
        spark = payloads.sparkSession
        landed = pages
        if not isinstance(pages, DataFrame):
            landed = read_pages(spark, pages) if isinstance(pages, str) else pages(spark)
        # Payloads are parsed once; every later step reads the items again.
        items = admit_in_time(feed_table(payloads, now), now, frame=time_frame)
        items = carry_site(write_table(items, f"{root}/items/batch_id={batch_id}"), sites)
        if per_site is not None:
            items = top_per_site(items, per_site)
        # Read several times below.
        listed = write_table(items, f"{root}/listed/batch_id={batch_id}")
        seen = seen_urls(spark, root, buckets).near(listed.select(F.col("link").alias("url")), batch_id)
        if keep_for is not None:
            seen = seen.where(F.col("collected_at") >= _stamp(now - keep_for))
        unsettled = listed.join(seen.select(F.col("url").alias("link")), "link", "left_anti")
        asked = unsettled.withColumns(
            {"_asked": _stamp(now), "_tries": F.lit(0).cast("bigint")})
        state = f"{_ddl(listed)}, _asked timestamp, _last timestamp, _tries bigint"
        waited = _batch_before(spark, f"{root}/retry", batch_id, state)
        merged = one_per_link(waited.drop("_last").unionByName(asked))
        wanted = write_table(merged, f"{root}/feeds/batch_id={batch_id}")
        fetched = write_table(
            fetch_articles(wanted, landed, sites, now, max_articles=None, time_frame=None, sited=True),
            f"{root}/fetched/batch_id={batch_id}",
        )
        waiting = F.coalesce(F.col("error") == NOT_LANDED, F.lit(False)) & (
            F.col("_asked") > _stamp(now - retry_for))
        missing = fetched.where(waiting).select(F.col("url").alias("link"))
        again = wanted.join(missing, "link", "left_semi").withColumns(
            {"_last": _stamp(now), "_tries": F.col("_tries") + 1})
        write_table(again, f"{root}/retry/batch_id={batch_id}")
        arrival = [F.col(c) for c in ("feed_time", "feed_source", "pos", "title")]
        articles = fetched.where(~waiting).drop("_asked", "_tries")
        _record(articles, batch_id, root, sites, arrival, now, stop, top_path, keep_for, buckets)

    return sink


def one_per_link(items: DataFrame) -> DataFrame:
    """One row per link: the one asked for first, then the first in the feeds. Rows without a link stay."""
    order = [F.col("_asked").asc_nulls_last(), F.col("_tries").desc_nulls_last()]
    order += [F.col(c).asc_nulls_last() for c in ("feed_time", "feed_source", "pos")]
    order += [F.xxhash64(*[c for c in items.columns if items.schema[c].dataType.typeName() != "map"])]
    linked = first_per_key(items.where("link IS NOT NULL"), ["link"], order)
    return linked.unionByName(items.where("link IS NULL"))


def _stamp(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

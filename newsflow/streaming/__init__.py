"""The monitoring loop as Structured Streaming queries."""

from newsflow.streaming.loop import (
    admit_in_time,
    collection_sink,
    monitor,
    monitor_sink,
    stream_new_articles,
    stream_site_counts,
    stream_trending,
    seen_urls,
    stream_trending_window,
    top_trends_sink,
    use_rocksdb_state,
)
from newsflow.streaming.trends import add_counts, running_trends_sink, top_of_runs

__all__ = [
    "add_counts", "admit_in_time", "collection_sink", "monitor", "monitor_sink", "running_trends_sink", "seen_urls", "stream_new_articles", "stream_site_counts",
    "stream_trending", "stream_trending_window", "top_of_runs", "top_trends_sink", "use_rocksdb_state",
]

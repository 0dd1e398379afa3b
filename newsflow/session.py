"""Session settings and the shared folder used for written intermediate tables."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Applied to any session the library is handed; all can be changed at run time.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Ranks of any size are cut inside the map tasks.
    "spark.sql.optimizer.windowGroupLimitThreshold": str(2**31 - 1),
    # Page rows are large: a batch of the default 10,000 rows could hold a gigabyte of HTML.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # Written tables hold texts and phrases, which it packs to about two thirds of the default.
    "spark.sql.parquet.compression.codec": "zstd",
}

# Largest dimension that is broadcast; beyond it the join runs by shuffle.
BROADCAST_ROW_LIMIT = 20_000


# Bytes per shuffle partition when the volume is known.
SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024


def configure(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Apply the settings; shuffle_bytes is the largest expected shuffle volume of a batch job.

    Adaptive execution starts from that many partitions and merges those that stay small.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    if shuffle_bytes is not None:
        wanted = -(-shuffle_bytes // SHUFFLE_PARTITION_BYTES)
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
        spark.conf.set(key, str(max(wanted, least)))
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    Only a local session without that setting (tests) falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="newsflow-")
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def spread(scan: DataFrame) -> DataFrame:
    """Redistribute a scan that has fewer splits than the cluster has cores.

    Files with a single row group cannot be split, which leaves CPU-heavy text work on a few
    tasks. A table with enough splits is returned as it is, so large inputs never pay a shuffle.
    Call it on a scan, not on a plan that already shuffles. Streams are left alone.
    """
    if scan.isStreaming:
        return scan
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores)


def is_small(dimension: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT) -> bool:
    """Whether a batch table has at most max_rows rows; only broadcast what passes."""
    return not dimension.isStreaming and dimension.limit(max_rows + 1).count() <= max_rows


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of earlier batches: it does when the driver collects garbage, which
    it puts off while the files of all batches fill the executors' disks."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()

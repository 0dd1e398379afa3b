"""The session settings, shared folders and small helpers of the training-data operators."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A batch is held in a Python worker beside its results; texts may be long.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}

# A task takes about so many rows of a few numbers.
TASK_ROWS = 100_000


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. A local session without it (tests) gets a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="newsflow-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read again: computed once, with short lineage."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """The table ``stored``, and how many rows were written."""
    seen = Observation()
    out = stored(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return out, seen.get["rows"]


def few(df: DataFrame, rows: int, each: int = TASK_ROWS) -> DataFrame:
    """df in no more partitions than tasks of `each` of so many rows, and one for each core: where the number of
    shuffle partitions is set high, a small step would write a file of a few rows in each of very many tasks."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // each)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal a scan of fewer splits than cores out by rows, so that text work uses all cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def utf8(column: str) -> F.Column:
    """The text with null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def released(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task; then what Arrow holds for later goes back. Workers live on when their task has ended."""
    try:
        yield from batches
    finally:
        pa.default_memory_pool().release_unused()


def slabs(batches: Iterable[pa.RecordBatch], max_bytes: int) -> Iterator[pa.Table]:
    """Batches of a task joined into tables of about max_bytes, so memory stays bounded."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= max_bytes:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def freed(df: DataFrame) -> None:
    """Let Spark delete the shuffle files of written steps: it does when the driver collects garbage,
    which a driver with little to do puts off while the files fill the executors' disks."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()

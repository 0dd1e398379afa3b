"""Dimension-sharded Lloyd: k-means on whole numbers, exact, with vectors cut into column blocks.

Vectors are kept as tiles: the integers of a chunk of rows and one shard of the dimensions. A task
computes the squared distances of a tile to the shard's slices of the centroids; the shards' parts of a
chunk are added and the nearest centroid is taken; each shard then sums its own columns per
cluster. All numbers are integers, so the order of the sums makes no difference.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import new_folder, stored

SCALE = 64
TILE_ROWS = 2048
TILE = "chunk long, shard int, n int, tile binary"


def whole(vector: str) -> Column:
    """The vector's components as integers: floor(64 * x)."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))


def usable(vector: str, dims: int) -> Column:
    """Whether the vector has dims components, none null, none infinite or not a number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == dims) & finite, F.lit(False))


def tiles(kept: DataFrame, dims: int, shards: int) -> DataFrame:
    """The tiles of `id long, vector`: shards 0 .. shards-1 hold columns, one more holds the ids."""
    bounds = np.linspace(0, dims, shards + 1).astype(int)
    most = int(np.sqrt(2.0**63 / max(dims, 1)) / 2)

    def cut(ids: pa.Array, rows: np.ndarray, chunk: int) -> pa.RecordBatch:
        if len(rows) and np.abs(rows).max() >= most:
            raise OverflowError(f"a component is {most / SCALE:.0f} or more: squared distances would leave 64 bits")
        whole_rows = rows.astype(np.int64)
        parts = [whole_rows[:, a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
        known = ids.is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
        names = np.stack([ids.fill_null(0).to_numpy().astype(np.int64), known], axis=1)
        return pa.record_batch([
            pa.array([chunk] * (shards + 1), pa.int64()), pa.array(range(shards + 1), pa.int32()),
            pa.array([len(rows)] * (shards + 1), pa.int32()), pa.array([*parts, names.tobytes()], pa.binary()),
        ], names=["chunk", "shard", "n", "tile"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The number of the task and a count in it; a repeated task writes the same chunks again.
        chunk, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_ROWS):
                part = batch.slice(at, TILE_ROWS)
                flat = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                held.append((part.column(0), np.floor(SCALE * flat).reshape(part.num_rows, dims)))
                size += part.num_rows
                while size >= TILE_ROWS:
                    ids, rows = pa.concat_arrays([i for i, _ in held]), np.concatenate([r for _, r in held])
                    yield cut(ids[:TILE_ROWS], rows[:TILE_ROWS], chunk)
                    held, size, chunk = [(ids[TILE_ROWS:], rows[TILE_ROWS:])], size - TILE_ROWS, chunk + 1
        if size:
            yield cut(pa.concat_arrays([i for i, _ in held]), np.concatenate([r for _, r in held]), chunk)

    return kept.mapInArrow(run, TILE)


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """The table in the shared folder, in buckets of the key, so that joins on it leave it in place."""
    spark = df.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex}"
    writer = df.repartition(count, key).write.bucketBy(count, key).sortBy(key)
    writer.option("path", new_folder(spark, name)).saveAsTable(table)
    return spark.table(table)


def distances(centroids: np.ndarray, bounds: np.ndarray):
    """Per tile, the squared distances of its rows to the centroids' slices of its shard."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, shard, n, tile in zip(*(c.to_pylist() for c in batch.columns)):
                if shard < len(bounds) - 1:
                    own = centroids[:, bounds[shard]:bounds[shard + 1]]
                    rows = np.frombuffer(tile, np.int64).reshape(n, own.shape[1])
                    part = np.empty((n, len(own)), np.int64)
                    for k, centre in enumerate(own):
                        gap = rows - centre
                        part[:, k] = np.einsum("ij,ij->i", gap, gap)
                    tile = part.tobytes()
                yield pa.record_batch([
                    pa.array([chunk], pa.int64()), pa.array([shard], pa.int32()), pa.array([n], pa.int32()),
                    pa.array([tile], pa.binary())], names=["chunk", "shard", "n", "tile"])

    return run


def nearest(group: pa.Table, k: int, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """The nearest centroid of each row of a chunk (of equals the first), its distance, and the ids."""
    n, total, ids = group.column("n")[0].as_py(), 0, None
    for shard, tile in zip(group.column("shard").to_pylist(), group.column("tile").to_pylist()):
        if shard == shards:
            ids = np.frombuffer(tile, np.int64).reshape(n, 2)
        else:
            total = total + np.frombuffer(tile, np.int64).reshape(n, k)
    cluster = total.argmin(axis=1)
    return cluster, total[np.arange(n), cluster], ids


def moved(tiled: DataFrame, centroids: np.ndarray, shards: int) -> np.ndarray:
    """The centroids after one round: floor(sum / count) of their vectors; empty ones stay."""
    k, dims = centroids.shape
    bounds = np.linspace(0, dims, shards + 1).astype(int)

    def assign(group: pa.Table) -> pa.Table:
        cluster, _, _ = nearest(group, k, shards)
        return pa.table({"chunk": group.column("chunk").slice(0, 1),
                         "clusters": pa.array([cluster.astype(np.int32).tobytes()], pa.binary())})

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dims), np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            for shard, n, tile, clusters in zip(*(c.to_pylist() for c in batch.columns)):
                at = np.frombuffer(clusters, np.int32)
                a, b = bounds[shard], bounds[shard + 1]
                np.add.at(total[:, a:b], at, np.frombuffer(tile, np.int64).reshape(n, b - a))
                count[:, a:b] += np.bincount(at, minlength=k)[:, None]
        cluster, dim = np.nonzero(count)
        yield pa.record_batch([
            pa.array(cluster, pa.int32()), pa.array(dim, pa.int32()), pa.array(total[cluster, dim], pa.int64()),
            pa.array(count[cluster, dim], pa.int64())], names=["cluster", "dim", "total", "count"])

    columns = tiled.where(F.col("shard") < shards)
    parts = columns.mapInArrow(distances(centroids, bounds), TILE)
    assigned = stored(parts.groupBy("chunk").applyInArrow(assign, "chunk long, clusters binary"), "lloyd-assigned")
    own = columns.join(assigned, "chunk").select("shard", "n", "tile", "clusters")
    added = own.mapInArrow(sums, "cluster int, dim int, total long, count long").groupBy("cluster", "dim").agg(
        F.sum("total").alias("total"), F.sum("count").alias("count"))
    mean = F.expr("(total - pmod(total, count)) div count")
    after = centroids.copy()
    # At most k * dims numbers.
    for row in added.select("cluster", "dim", mean.alias("mean")).collect():
        after[row.cluster, row.dim] = row.mean
    return after


def lloyd(
    rows: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, shards: int = 4,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> tuple[DataFrame, DataFrame]:
    """Clusters of the vectors, and the centroids.

    The first table has `id, cluster int, distance long` per kept vector, the second `cluster,
    centroid array<long>, centroid_sha256, cluster_inertia`, where the inertia is the sum of the
    squared distances, 0 for an empty cluster.

    Kept are vectors of exactly dims components, none null, infinite or not a number; the others have
    no row. Components become floor(64 * x). The first centroids are the k kept vectors with the
    smallest SHA-256 of `1:<id>`, ids that repeat by their components; vectors with a null id come
    last there, and are assigned like the others. Fewer kept vectors give fewer centroids, an empty
    table empty results. Equal distances go to the smaller number. Repeated rows count each. A
    component so large that a squared distance could leave 64 bits (dims = 64: two millions) is an
    error. Other columns are not read. The centroids, k * dims integers, are on the driver.
    """
    shards = max(1, min(shards, dims))
    spark = rows.sparkSession
    kept = rows.where(usable(vector_col, dims)).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    order = F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")), 256).asc_nulls_last()
    start = kept.select("id", whole("v").alias("x")).orderBy(order, "x").limit(k).collect()
    schema = "cluster int, centroid array<bigint>, centroid_sha256 string"
    if not start:
        none = spark.createDataFrame([], f"id long, cluster int, distance long")
        return none, spark.createDataFrame([], f"{schema}, cluster_inertia long")
    centroids = np.array([r.x for r in start], np.int64)
    tiled = bucketed(tiles(kept, dims, shards), "chunk", "lloyd_tiles")
    for _ in range(rounds):
        centroids = moved(tiled, centroids, shards)
    bounds, count = np.linspace(0, dims, shards + 1).astype(int), len(centroids)

    def final(group: pa.Table) -> pa.Table:
        cluster, distance, ids = nearest(group, count, shards)
        return pa.table({
            "id": pa.array(ids[:, 0], pa.int64(), mask=ids[:, 1] == 0),
            "cluster": pa.array(cluster, pa.int32()), "distance": pa.array(distance, pa.int64())})

    parts = tiled.mapInArrow(distances(centroids, bounds), TILE).groupBy("chunk")
    out = stored(parts.applyInArrow(final, "id long, cluster int, distance long"), "lloyd-clusters")
    named = [(j, row, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for j, row in enumerate(centroids.tolist())]
    inertia = out.groupBy("cluster").agg(F.sum("distance").alias("sum"))
    clusters = spark.createDataFrame(named, schema).join(inertia, "cluster", "left").select(
        "cluster", "centroid", "centroid_sha256", F.coalesce("sum", F.lit(0)).cast("long").alias("cluster_inertia"))
    return out, clusters

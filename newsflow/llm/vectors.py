"""Near-duplicate vectors: spherical k-means cells and blocked cosines within the cells.

Cells alone would lose links across their borders. A vector therefore also visits, as a guest, every
cell that can hold a partner: where y in cell c has cosine >= t with x of cell a, the distance of the
unit vectors is at most sqrt(2 - 2t), hence x.(a - c) <= sqrt(2 - 2t) * |a - c|. All links of a vector
are then found in its home cell, each direction once, and the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import stored
from newsflow.llm.components import components

SLACK = 1e-9


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(flat):
        return np.empty((0, 0))
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def fit(sample: np.ndarray, cells: int, rounds: int = 10, seed: int = 1) -> np.ndarray:
    """Spherical k-means on unit rows: the centroids, as unit vectors."""
    order = np.random.default_rng(seed).permutation(len(sample))
    centroids = sample[order[:cells]]
    for _ in range(rounds):
        nearest = np.argmax(sample @ centroids.T, axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(size > 0, sums / np.where(size > 0, size, 1), centroids)
    return centroids


def cells_of(rows: np.ndarray, centroids: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The home cell of each unit row, and a mask of the cells that it takes part in."""
    score = rows @ centroids.T
    home = np.argmax(score, axis=1)
    gap = score[np.arange(len(rows)), home][:, None] - score
    apart = np.sqrt(np.maximum(0, 2 - 2 * centroids @ centroids.T))
    return home, gap <= np.sqrt(2 - 2 * threshold) * apart[home] + SLACK


def dealt(classes: DataFrame, centroids: np.ndarray, threshold: float) -> DataFrame:
    """A row per class and cell that it takes part in."""
    names = ["label", "vertex", "weight", "embedding"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                for rows, index in by_width(part.column(3)):
                    here = centroids if rows.shape[1] == centroids.shape[1] else np.ones((1, rows.shape[1]))
                    home, mask = cells_of(unit(rows), unit(here), threshold)
                    at, cell = np.nonzero(mask)
                    taken = part.take(pa.array(index[at]))
                    yield pa.record_batch(
                        [*taken.columns, pa.array(cell, pa.int32()), pa.array(home[at] == cell)],
                        names=[*names, "cell", "home"],
                    )

    kind = classes.schema["embedding"].dataType.simpleString()
    label = classes.schema["label"].dataType.simpleString()
    schema = f"label {label}, vertex long, weight long, embedding {kind}, cell int, home boolean"
    return classes.select(*names).mapInArrow(run, schema)


def by_width(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of equal length as matrices, with their indexes."""
    widths = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
    for width in np.unique(widths):
        index = np.flatnonzero(widths == width)
        yield matrix(column.take(pa.array(index))), index


def reached(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest name that each side's rows reach over the links of a block."""
    far = np.iinfo(np.int64).max
    while True:
        before = left.sum(dtype=object), right.sum(dtype=object)
        for at in range(0, len(left), 256):
            rows = slice(at, at + 256)
            left[rows] = np.minimum(left[rows], np.where(linked[rows], right, far).min(axis=1))
            right = np.minimum(right, np.where(linked[rows], left[rows, None], far).min(axis=0))
        if (left.sum(dtype=object), right.sum(dtype=object)) == before:
            return left, right


def compare(group: pa.Table, threshold: float) -> pa.Table:
    """Links of the host rows of a block with the others: how many rows each host links to, and for
    every row with links the smallest name that it reaches, which connects what the links connect."""
    vertex = group.column("vertex").to_numpy()
    host = group.column("host").to_numpy(zero_copy_only=False).astype(bool)
    left, right = np.flatnonzero(host), np.flatnonzero(~host)
    if not len(left) or not len(right):
        return pa.table({k: pa.array([], pa.int64()) for k in ("vertex", "n", "low")})
    a = matrix(group.column("embedding").take(pa.array(left)))
    b = matrix(group.column("embedding").take(pa.array(right)))
    cosine = a @ b.T / (np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1))
    linked = (cosine >= threshold) & (vertex[left][:, None] != vertex[right])
    counts = linked @ group.column("weight").to_numpy()[right]
    some_left, some_right = linked.any(axis=1), linked.any(axis=0)
    low_left, low_right = reached(
        linked[some_left][:, some_right], vertex[left][some_left], vertex[right][some_right])
    return pa.table({
        "vertex": np.concatenate((vertex[left][some_left], vertex[right][some_right])),
        "n": np.concatenate((counts[some_left], np.zeros(some_right.sum(), np.int64))).astype(np.int64),
        "low": np.concatenate((low_left, low_right)),
    })


def usable(vector: str) -> F.Column:
    """Whether a vector can be compared: not null, no null or non-finite component, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(
    rows: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str = "label", cell_rows: int = 4000, block_rows: int = 2048, sample_rows: int = 20_000,
    max_cells: int = 1024,
) -> DataFrame:
    """Per row: id, `n_links long`, `component_id`, `kept boolean`.

    Vectors link when their labels are equal and not null and their cosine is at least threshold.
    n_links counts the other rows linked directly, component_id is the smallest id reached, kept says
    whether that is the row's own. Null, zero and non-finite vectors link with nothing; nor do rows
    without an id, whose component is null and which are kept. Vectors of different length do not
    link. Rows equal in label and vector are one class that is compared once; rows that repeat an id
    count each. The cells are fitted on at most sample_rows classes, chosen by hash; every class is
    compared, and the result does not depend on the cells. Blocks of at most about block_rows rows a
    side bound a task's memory. An empty table gives an empty result; other columns are not read.
    """
    slim = rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("embedding")
    )
    good = F.col("id").isNotNull() & F.col("label").isNotNull() & usable("embedding")
    # Adding zero makes -0.0 and 0.0 one value.
    same = F.transform("embedding", lambda x: x + F.lit(0).cast("float"))
    keyed = slim.select("id", "label", same.alias("embedding"), good.alias("good"))
    keyed = keyed.withColumn("key", F.when(F.col("good"), F.sha2(F.concat_ws(",", F.col("label").cast("string"), F.to_json("embedding")), 256)))
    classes = keyed.where("good").groupBy("key").agg(
        F.min("id").alias("vertex"), F.count("*").alias("weight"),
        F.first("label").alias("label"), F.first("embedding").alias("embedding"),
    )
    # A class is known by its key; ids may repeat, so the vertex is made from both.
    classes = stored(classes.select("key", "vertex", F.xxhash64("key").alias("name"), "weight", "label", "embedding"), "vector-classes")
    n = classes.count()
    found = linked_classes(
        classes.select("label", F.col("name").alias("vertex"), "weight", "embedding"), n, threshold,
        cell_rows, block_rows, sample_rows, max_cells,
    )
    counts = found.groupBy("vertex").agg(F.sum("n").alias("n"))
    reach = components(found.select(F.col("vertex").alias("u"), F.col("low").alias("v")))
    named = classes.select("key", "name", "vertex", "weight").join(
        counts.withColumnRenamed("vertex", "name"), "name", "left").join(
        reach.withColumnRenamed("id", "name"), "name", "left")
    named = named.withColumn("component", F.coalesce("component", "name"))
    smallest = named.groupBy("component").agg(F.min("vertex").alias("component_id"))
    facts = named.join(smallest, "component").select(
        "key", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    # Rows without a class get keys of their own, so that they are dealt evenly.
    spare = F.concat(F.lit("-"), F.xxhash64("id", "label").cast("string"))
    out = keyed.select("id", F.coalesce("key", spare).alias("key")).join(facts, "key", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"),
    )


def linked_classes(
    classes: DataFrame, n: int, threshold: float, cell_rows: int, block_rows: int, sample_rows: int, max_cells: int
) -> DataFrame:
    """`vertex, n, low`: per block, how many rows a class links to, and the smallest name it reaches."""
    sample = classes.select("vertex", "embedding").orderBy(F.xxhash64("vertex")).limit(sample_rows).toPandas()
    widths = sample["embedding"].map(len)
    common = widths[widths == widths.mode().max()].index if len(sample) else []
    points = unit(np.array([np.asarray(v, np.float64) for v in sample["embedding"].loc[common]])) if len(common) else np.ones((1, 1))
    centroids = fit(points, max(1, min(max_cells, -(-n // cell_rows), len(points))))
    parts = dealt(classes, centroids, threshold)
    width = F.size("embedding").alias("width")
    parts = stored(parts.select("*", width), "vector-cells")
    keys = ["label", "width", "cell"]
    sizes = parts.groupBy(*keys).agg(
        F.ceil(F.sum(F.col("home").cast("long")) / block_rows).alias("hosts"),
        F.ceil(F.count("*") / block_rows).alias("others"),
    )
    sized = parts.join(sizes, keys)
    spot = lambda count: F.pmod(F.xxhash64("vertex"), F.greatest(F.col(count), F.lit(1)))
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col(count), F.lit(1)) - 1))
    hosts = sized.where("home").select(
        *keys, spot("hosts").alias("i"), every("others").alias("j"), F.lit(True).alias("host"), "vertex", "weight", "embedding")
    others = sized.where("hosts > 0").select(
        *keys, every("hosts").alias("i"), spot("others").alias("j"), F.lit(False).alias("host"), "vertex", "weight", "embedding")
    blocks = hosts.union(others).groupBy(*keys, "i", "j")
    found = blocks.applyInArrow(lambda t: compare(t, threshold), "vertex long, n long, low long")
    return stored(found, "vector-links")

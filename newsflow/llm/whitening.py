"""Embedding whitening by spectrum slicing of the covariance.

The covariance is added up in integers over all rows. Its leading eigenvalues are then isolated by inertia counts:
the number of positive pivots of V - s I = L D L' is the number of eigenvalues above s. Inside an isolating interval
Rayleigh quotient iteration converges cubically, and two more counts certify which eigenvalue was found. The matrix has
the size of the dimensions, however many rows there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import stored

SCALE, SHIFT = 64, 1_000_000
EPS = np.finfo(np.float64).eps
# Eigenvalues closer than this share of the matrix are found together, as one group.
GROUP_GAP = 1e-12
# A direction whose variance is below this share of the trace is rounding, not variance.
LEAST_SHARE = 1e-13
BATCH = 2048


def positive(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are above shift: the positive pivots of matrix - shift I = L D L'.

    Complete pivoting with blocks of one or two rows (Bunch and Parlett) keeps the factors small.
    """
    a = matrix - shift * np.eye(len(matrix))
    bound, above = (1 + math.sqrt(17)) / 8, 0
    while len(a):
        size = np.abs(a)
        r, c = np.unravel_index(size.argmax(), size.shape)
        largest = size[r, c]
        if largest == 0:
            return above
        d = np.diagonal(size).argmax()
        block = [d] if size[d, d] >= bound * largest else [r, c]
        rest = np.delete(np.arange(len(a)), block)
        pivot, side = a[np.ix_(block, block)], a[np.ix_(rest, block)]
        # A block of two has one eigenvalue of either sign, as its product is negative.
        above += 1 if len(block) == 2 or pivot[0, 0] > 0 else 0
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(pivot, side.T)
        a = (a + a.T) / 2
    return above


def slices(matrix: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """Intervals with the leading eigenvalues, the largest first: low, high, how many are inside.

    Each holds one eigenvalue, or several that lie closer together than GROUP_GAP.
    """
    radius = np.abs(matrix).sum(axis=1).max()
    top, bottom = radius * (1 + 1e-12) + np.finfo(float).tiny, -radius * (1 + 1e-12) - np.finfo(float).tiny
    found, open_ = [], [(bottom, top, len(matrix), 0)]
    while open_:
        low, high, below, above = open_.pop()
        inside = below - above
        if not inside or above >= wanted:
            continue
        if inside == 1 or high - low <= GROUP_GAP * radius:
            found.append((low, high, inside))
            continue
        middle = (low + high) / 2
        n = positive(matrix, middle)
        open_.append((low, middle, below, n))
        # The upper half is looked at first, as the lower one may not be needed.
        open_.append((middle, high, n, above))
    return sorted(found, reverse=True)


def certified(matrix: np.ndarray, first: float, last: float, before: int, count: int, room: float) -> bool:
    """Whether the counts just above and just below say that these are eigenvalues before+1 to before+count."""
    return positive(matrix, first + room) <= before and positive(matrix, last - room) >= before + count


def vectors_in(
    matrix: np.ndarray, low: float, high: float, count: int, known: np.ndarray, room: float
) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvalues of an interval, falling, and their unit vectors, orthogonal to the known columns."""
    d = len(matrix)

    def pure(columns: np.ndarray) -> np.ndarray:
        for _ in range(2):
            columns = np.linalg.qr(columns - known @ (known.T @ columns))[0]
        return columns

    def solved(shift: float, right: np.ndarray) -> np.ndarray:
        for nudge in (0.0, room / 16, -room / 4):
            try:
                out = np.linalg.solve(matrix - (shift + nudge) * np.eye(d), right)
            except np.linalg.LinAlgError:
                continue
            if np.isfinite(out).all():
                return out
        return right

    block = pure(np.random.default_rng(d + known.shape[1]).standard_normal((d, count)))
    while count == 1 and high - low > GROUP_GAP * np.abs(matrix).sum(axis=1).max():
        # One step of inverse iteration at the middle, then Rayleigh quotients.
        x = pure(solved((low + high) / 2, block))
        for _ in range(10):
            value = float(x[:, 0] @ matrix @ x[:, 0])
            if np.abs(matrix @ x - value * x).max() <= room / 64:
                break
            x = pure(solved(value, x))
        if np.abs(matrix @ x - value * x).max() <= room and certified(matrix, value, value, known.shape[1], 1, room):
            return np.array([value]), x
        # It went to a neighbour: halve the interval and start again.
        middle = (low + high) / 2
        low, high = (middle, high) if positive(matrix, middle) > known.shape[1] else (low, middle)
    for _ in range(8):
        block = pure(solved((low + high) / 2, block))
    values, turn = np.linalg.eigh(block.T @ matrix @ block)
    order = np.argsort(-values)
    return values[order], block @ turn[:, order]


@dataclass(frozen=True)
class Spectrum:
    values: np.ndarray
    vectors: np.ndarray


def leading(matrix: np.ndarray, wanted: int) -> Spectrum:
    """The wanted largest eigenvalues that are more than rounding, falling, with unit vectors as columns.

    Every group's number is certified: the counts just above and just below it are as they should be.
    """
    values, vectors = [], np.zeros((len(matrix), 0))
    radius, trace = np.abs(matrix).sum(axis=1).max(initial=0), float(np.trace(matrix))
    room = 64 * len(matrix) * EPS * radius
    for low, high, count in slices(matrix, wanted) if trace > 0 else []:
        found, columns = vectors_in(matrix, low, high, count, vectors, room)
        if not certified(matrix, found[0], found[-1], len(values), count, room):
            raise ArithmeticError(f"eigenvalues {len(values) + 1} to {len(values) + count} could not be certified")
        values.extend(found)
        vectors = np.hstack([vectors, columns])
    good = [j for j, e in enumerate(values[:wanted]) if e > LEAST_SHARE * trace]
    return Spectrum(np.array(values)[good] if good else np.zeros(0), vectors[:, good])


def finite(vector: str) -> Column:
    """Whether the vector is not null and no component is null, infinite or not a number."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def integers(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of floor(64 * component) + 1000000."""
    scaled = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if np.abs(scaled).max(initial=0) >= 2.0**53:
        raise OverflowError("a component times 64 leaves 53 bits")
    return scaled.astype(np.int64).reshape(-1, dims) + SHIFT


@dataclass(frozen=True)
class Fit:
    """n rows with sums per dimension, the covariance and the leading part of its spectrum."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    spectrum: Spectrum

    @property
    def explained(self) -> np.ndarray:
        return self.spectrum.values / max(np.trace(self.covariance), np.finfo(float).tiny)

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The integers nearest to the means, and what is left of the means."""
        near = [round(Fraction(s, self.n)) for s in self.sums]
        rest = [float(Fraction(s, self.n) - c) for s, c in zip(self.sums, near)]
        return np.array(near, np.int64), np.array(rest)

    def whitened(self, rows: np.ndarray) -> np.ndarray:
        near, rest = self.centre()
        return ((rows - near).astype(np.float64) - rest) @ self.spectrum.vectors / np.sqrt(self.spectrum.values)

    def deviations(self, rows: np.ndarray) -> list[int | None]:
        """Per row the sum of (n * x - S) ** 2, exact; null where it leaves 64 bits."""
        sums = np.array(self.sums, object)
        most = int(np.abs(rows).max(initial=0)) * self.n + max(map(abs, self.sums), default=0)
        if most**2 * max(len(self.sums), 1) < 2**63:
            gap = rows * self.n - sums.astype(np.int64)
            return (gap * gap).sum(axis=1).tolist()
        gap = rows.astype(object) * self.n - sums
        return [v if v < 2**63 else None for v in (gap * gap).sum(axis=1).tolist()]


def covariance(kept: DataFrame, dims: int) -> tuple[int, list[int], np.ndarray]:
    """n, the sums, and the covariance with divisor n.

    Rows are centred on the integers nearest to the means and multiplied as integers; what is left of
    the means, at most a half, is taken off exactly. So no rounding enters before the last division.
    """
    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dims, object), 0
        for batch in batches:
            rows = integers(batch.column(0), dims)
            total, n = total + exact_sum(rows), n + len(rows)
        yield decimals([(j, 0, v) for j, v in enumerate(total)] + [(-1, 0, n)])

    at = {r.i: int(r.v) for r in reduced(kept.select("v").mapInArrow(sums, TRIPLES)).collect()}
    n = at.pop(-1, 0)
    if not n:
        return 0, [0] * dims, np.zeros((dims, dims))
    total = [at[j] for j in range(dims)]
    near = np.array([round(Fraction(s, n)) for s in total], np.int64)

    def products(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((dims, dims), object)
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                held = held + exact_product(integers(batch.column(0).slice(start, BATCH), dims) - near)
        yield decimals([(i, j, held[i, j]) for i in range(dims) for j in range(i, dims)])

    # At most dims * (dims + 1) / 2 numbers.
    cells = reduced(kept.select("v").mapInArrow(products, TRIPLES)).collect()
    rest = [s - n * int(c) for s, c in zip(total, near)]
    matrix = np.zeros((dims, dims))
    for cell in cells:
        value = float(Fraction(n * int(cell.v) - rest[cell.i] * rest[cell.j], n * n))
        matrix[cell.i, cell.j] = matrix[cell.j, cell.i] = value
    return n, total, matrix


TRIPLES = "i int, j int, v decimal(38,0)"


def decimals(cells: list[tuple[int, int, int]]) -> pa.RecordBatch:
    i, j, v = zip(*cells)
    return pa.record_batch([
        pa.array(i, pa.int32()), pa.array(j, pa.int32()),
        pa.array([Decimal(int(x)) for x in v], pa.decimal128(38, 0))], names=["i", "j", "v"])


def reduced(cells: DataFrame) -> DataFrame:
    return cells.groupBy("i", "j").agg(F.sum("v").alias("v"))


def exact_sum(rows: np.ndarray) -> np.ndarray:
    if int(np.abs(rows).max(initial=0)) * len(rows) < 2**62:
        return rows.sum(axis=0).astype(object)
    return rows.astype(object).sum(axis=0)


def exact_product(rows: np.ndarray) -> np.ndarray:
    """rows' rows as integers: in doubles where all sums stay below 2 ** 53, else in Python's integers."""
    if int(np.abs(rows).max(initial=0)) ** 2 * max(len(rows), 1) < 2**53:
        wide = rows.astype(np.float64)
        return (wide.T @ wide).astype(np.int64).astype(object)
    wide = rows.astype(object)
    return wide.T @ wide


def fit(kept: DataFrame, dims: int, components: int = 32) -> Fit:
    n, sums, matrix = covariance(kept, dims)
    return Fit(n, sums, matrix, leading(matrix, min(components, dims)))


def identity_error(kept: DataFrame, fitted: Fit) -> float:
    """The largest absolute entry of the covariance of the whitened rows, as added up over all of them, minus I."""
    k, dims = len(fitted.spectrum.values), len(fitted.sums)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, one = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            if not batch.num_rows:
                continue
            w = fitted.whitened(integers(batch.column(0), dims))
            total, one = total + w.T @ w, one + w.sum(axis=0)
        i, j = np.triu_indices(k)
        yield pa.record_batch([
            pa.array(np.concatenate([i, np.full(k, -1)]), pa.int32()), pa.array(np.concatenate([j, np.arange(k)]), pa.int32()),
            pa.array(np.concatenate([total[i, j], one]), pa.float64())], names=["i", "j", "v"])

    cells = {(r.i, r.j): r.v for r in reduced(kept.select("v").mapInArrow(run, "i int, j int, v double")).collect()}
    mean = [cells[-1, j] / fitted.n for j in range(k)]
    # Whitened rows are centred already; their means are rounding, and are taken off all the same.
    entry = lambda i, j: cells[i, j] / fitted.n - mean[i] * mean[j] - (i == j)
    return max((abs(entry(i, j)) for i in range(k) for j in range(i, k)), default=0.0)


def whiten(
    rows: DataFrame, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """`id, component int, n, deviation, whitened, explained, identity_error` per kept row and component.

    Vectors that are null, or hold a null, an infinite component or one that is no number, are left out. So
    are vectors whose length is not the most frequent one (of equally frequent ones the largest), and
    empty ones. Components become integers, floor(64 * c) + 1000000; a component that leaves 53 bits
    is an error.

    component is numbered from 1 by falling eigenvalue; a direction without variance has no component,
    so rows that are all equal give an empty result, as does an empty table. Equal eigenvalues get
    some orthonormal vectors of their space. deviation is exact, and null where it leaves 64 bits. Null ids
    and repeated rows are kept. Other columns are not read. The driver holds the covariance,
    a square of the dimensions.
    """
    good = rows.where(finite(vector_col)).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    widths = good.groupBy(F.size("v").alias("width")).count().where("width > 0")
    common = widths.orderBy(F.desc("count"), F.desc("width")).first()
    dims = common.width if common else 1
    kept = stored(good.where(F.size("v") == dims), "whitening-rows")
    fitted = fit(kept, dims, components)
    error, explained, k = identity_error(kept, fitted), fitted.explained, len(fitted.spectrum.values)
    schema = ("id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows if k else 0, BATCH):
                part = batch.slice(start, BATCH)
                x = integers(part.column(1), dims)
                at, size = np.repeat(np.arange(len(x)), k), len(x) * k
                yield pa.record_batch([
                    part.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                    pa.array(np.full(size, fitted.n), pa.int64()),
                    pa.array(fitted.deviations(x), pa.int64()).take(pa.array(at)),
                    pa.array(fitted.whitened(x).ravel()), pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(size, error)),
                ], names=names)

    return kept.mapInArrow(run, schema)

"""Whitening of vectors: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its triangular factor."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
#: Columns that are orthogonal to so many parts of their lengths end the rotations.
_CONVERGED = 1e-15
_SWEEPS = 60
_LOW = (1 << 31) - 1


def scaled(table: DataFrame) -> DataFrame:
    """``vec_id``, ``x``: entries c of ``embedding`` as longs floor(1024 c) + 100000.

    Rows whose vector is null or holds null or non-finite entries are left out, and so are those with an entry whose x no
    long can hold.
    """
    vector = F.col("embedding").cast("array<double>")
    good = F.forall(vector, lambda c: F.coalesce(F.abs(c) * SCALE < 2.0 ** 62, F.lit(False)) & ~F.isnan(c))
    rows = table.where(vector.isNotNull() & good)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(vector, lambda c: F.floor(c * SCALE).cast("long") + SHIFT).alias("x"))


def _vectors(batch: pa.RecordBatch, dimension: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _sums(rows: DataFrame, dimension: int) -> tuple[int, list[int]]:
    """Number of rows and the exact sum of each dimension: one row a dimension from each task, added up on Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(dimension, np.int64), np.zeros(dimension, np.int64)
        for batch in batches:
            x = _vectors(batch, dimension)
            n, high, low = n + len(x), high + (x >> 31).sum(axis=0), low + (x & _LOW).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dimension), pa.int32()), pa.array([n] * dimension, pa.int64()), pa.array(high), pa.array(low)], ["i", "n", "high", "low"])

    parts = rows.mapInArrow(run, "i int, n long, high long, low long")
    total = lambda name: F.sum(F.col(name).cast("decimal(38, 0)")).alias(name)
    got = sorted(parts.groupBy("i").agg(total("n"), total("high"), total("low")).collect(), key=lambda r: r["i"])
    return int(got[0]["n"]), [(int(r["high"]) << 31) + int(r["low"]) for r in got]


def _products(rows: DataFrame, dimension: int, centred, width: int) -> np.ndarray:
    """Sum of outer products of ``centred(x)`` over all rows: a matrix from each task, added up entry by entry on Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = np.zeros((width, width))
        for batch in batches:
            y = centred(_vectors(batch, dimension))
            matrix += y.T @ y
        i, j = np.indices(matrix.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(matrix.ravel())], ["i", "j", "value"])

    matrix = np.zeros((width, width))
    for r in rows.mapInArrow(run, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        matrix[r["i"], r["j"]] = r["value"]
    return (matrix + matrix.T) / 2


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """G with G Gᵀ = ``matrix`` (symmetric, no negative eigenvalue): a triangular factor whose rows are in pivot order.

    It has one column per step; steps end when what is left on the diagonal is rounding error, so that a singular matrix
    has fewer columns than rows.
    """
    rest, size = matrix.astype(float).copy(), len(matrix)
    factor = np.zeros((size, size))
    smallest = size * np.finfo(float).eps * max(rest.diagonal().max(initial=0.0), 0.0)
    for step in range(size):
        pivot = int(rest.diagonal().argmax())
        if not rest[pivot, pivot] > smallest:
            return factor[:, :step]
        column = rest[:, pivot] / np.sqrt(rest[pivot, pivot])
        factor[:, step] = column
        rest -= np.outer(column, column)
        rest[pivot, :] = rest[:, pivot] = 0.0
    return factor


def _rounds(size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of columns as rounds of disjoint pairs, as in a tournament."""
    players, rounds = list(range(size + size % 2)), []
    for _ in range(len(players) - 1):
        half = len(players) // 2
        pairs = [(a, b) for a, b in zip(players[:half], reversed(players[half:])) if max(a, b) < size]
        rounds.append(tuple(np.array(pairs, int).reshape(-1, 2).T))
        players = [players[0], players[-1], *players[1:-1]]
    return rounds


def rotated(factor: np.ndarray) -> np.ndarray:
    """``factor`` with its columns turned in pairs until all are orthogonal (one-sided Jacobi)."""
    columns = factor.copy()
    rounds = _rounds(columns.shape[1])
    for _ in range(_SWEEPS):
        worst = 0.0
        for p, q in rounds:
            a, b = columns[:, p], columns[:, q]
            aa, bb, ab = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            size = np.sqrt(aa * bb)
            turn = np.abs(ab) > _CONVERGED * size
            worst = max(worst, float(np.divide(np.abs(ab), size, out=np.zeros_like(size), where=size > 0).max(initial=0.0)))
            with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
                angle = (bb - aa) / (2 * ab)
                tangent = np.where(angle >= 0, 1.0, -1.0) / (np.abs(angle) + np.hypot(1.0, angle))
            tangent = np.where(turn, tangent, 0.0)
            cosine = 1 / np.hypot(1.0, tangent)
            sine = cosine * tangent
            columns[:, p], columns[:, q] = cosine * a - sine * b, sine * a + cosine * b
        if worst <= 4 * _CONVERGED:
            break
    return columns


@dataclass
class Whitening:
    """What all rows share. ``directions`` has one column per component, ``values`` its eigenvalue, largest first."""

    n: int
    sums: list[int]
    mean: np.ndarray
    directions: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x.astype(float) - self.mean) @ self.directions / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - sum)² per row, exactly; None where no long can hold it."""
        bound = np.abs(self.n * (x.astype(float) - self.mean)).max(initial=0.0) * 1.01 + 1
        largest = max(float(np.abs(x.astype(float)).max(initial=0.0)) * self.n, *(abs(float(s)) for s in self.sums))
        if largest < 2.0 ** 62 and bound ** 2 * x.shape[1] < 2.0 ** 62:
            away = self.n * x - np.array(self.sums, np.int64)
            return (away * away).sum(axis=1).tolist()
        exact = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist()]
        return [e if e < 1 << 63 else None for e in exact]


def fit(rows: DataFrame, dimension: int, components: int = COMPONENTS) -> Whitening:
    """The components of ``rows`` (``x``), all of length ``dimension``.

    Two passes, one for the sums and one for the scatter about the mean; the driver gets a row per dimension and an entry
    per pair of dimensions. There are fewer than ``components`` if the vectors span less.
    """
    n, sums = _sums(rows, dimension)
    mean = np.array([float(Fraction(s, n)) for s in sums])
    scatter = _products(rows, dimension, lambda x: x.astype(float) - mean, dimension)
    columns = rotated(pivoted_cholesky(scatter))
    norms = np.sqrt((columns ** 2).sum(axis=0))
    order = np.argsort(-norms, kind="stable")[:components]
    values = norms[order] ** 2 / n
    trace = float(scatter.trace()) / n
    return Whitening(n, sums, mean, columns[:, order] / norms[order], values, values / trace if trace else values)


def whitened(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error`` of ``table`` (``vec_id``, ``embedding``).

    One row per vector and component, also for repeated rows and null ids. Vectors are those of :func:`scaled` that have the
    commonest length, of equally common ones the greatest. ``deviation`` is exact, null beyond a long. ``identity_error``
    is measured on all rows of the result. Extra columns are left behind. Without vectors, or if all are equal, there
    is no component and so no row.
    """
    every = scaled(table)
    length = every.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    nothing = table.sparkSession.createDataFrame([], SCHEMA)
    if length is None or length["length"] == 0:
        return nothing
    dimension = length["length"]
    rows = every.where(F.size("x") == dimension)
    model = fit(rows, dimension, components)
    width = len(model.values)
    if width == 0:
        return nothing
    # A column of ones beside the coordinates gives their sums in the same pass.
    products = _products(rows, dimension, lambda x: np.c_[model.project(x), np.ones(len(x))], width + 1) / model.n
    middle = products[width, :width]
    error = float(np.abs(products[:width, :width] - np.outer(middle, middle) - np.eye(width)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _vectors(batch, dimension)
            count = len(x)
            place = np.repeat(np.arange(count), width)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(place)), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), count)),
                 pa.array(np.full(count * width, model.n, np.int64)), pa.array(model.deviations(x), pa.int64()).take(pa.array(place)),
                 pa.array(model.project(x).ravel()), pa.array(np.tile(model.explained, count)), pa.array(np.full(count * width, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, SCHEMA)

"""Operator 11: whitening of embeddings by their leading principal components.

Every entry c of a vector becomes the integer x = floor(1024 c) + 100000.

1. One pass adds up count and sums per dimension, as exact integers.
2. A second pass centres every vector on the nearest integers to the means and
   adds up the products of all pairs of dimensions, per task as one matrix
   product, over tasks as one sum per pair. The rest of the mean, at most a
   half, is taken off at the end; no digits cancel.
3. The covariance, as wide as a vector and never as long as the input, is made
   tridiagonal by Householder reflections; Sturm counts tell how many
   eigenvalues lie below a number, so bisection finds the leading ones; inverse
   iteration finds their vectors, orthogonalised anew within a cluster of close
   eigenvalues, and the reflections turn them back.
4. Tasks project the centred vectors on these components, which are sent to
   them; a pass over the projections measures how far their covariance is from
   the identity, and the last pass returns them.

Products are added in double precision: exact up to 2^53, rounded beyond.

Defined results: vectors that are null or hold a null, NaN or infinite entry
are left out. The dimension is that of most vectors, of the larger of two as
frequent; empty vectors and those of another length are left out. Entries
beyond 2^61 / 1024 count as that. Rows that share a ``vec_id``, also a null one,
are returned one by one; equal vectors get equal results. A component without
variance (fewer independent vectors than components) has a null ``whitened``,
its ``explained`` is 0, and ``identity_error`` does not see it; it is null if no
component has any. ``deviation`` is null where it has more than 38 digits (in
the query: where it does not fit a long). An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackledger.session import materialize

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LARGEST = 1 << 61
ENTRIES = 1 << 20
CLUSTER = 1e-3
_EPS = float(np.finfo(np.float64).eps)


def _integers(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, their integers as a matrix) of the usable vectors, by length."""
    length = np.asarray(pc.fill_null(pc.list_value_length(column), 0)).astype(np.int64)
    ends = np.cumsum(length)
    flat = pc.fill_null(column.flatten().cast(pa.float64()), np.nan)
    values = flat.to_numpy(zero_copy_only=False)
    odd = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    usable = (length > 0) & (odd[ends] == odd[ends - length])
    for size in np.unique(length[usable]).tolist():
        rows = np.flatnonzero(usable & (length == size))
        step = max(1, ENTRIES // size)
        for k in range(0, len(rows), step):
            own = rows[k : k + step]
            with np.errstate(over="ignore"):
                scaled = np.floor(values[(ends[own] - size)[:, None] + np.arange(size)] * SCALE)
            yield own, np.clip(scaled, -LARGEST, LARGEST).astype(np.int64) + SHIFT


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count and sums per dimension, for each length; sums as upper and lower 31 bits."""
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        for _, x in _integers(batch.column(0)):
            own = found.setdefault(x.shape[1], np.zeros((3, x.shape[1]), dtype=np.int64))
            own[0] += len(x)
            own[1] += (x >> 31).sum(axis=0)
            own[2] += (x & 0x7FFFFFFF).sum(axis=0)
    for size, own in found.items():
        columns = [np.full(size, size), np.arange(size), *own]
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["size", "at", "n", "high", "low"])


@dataclass(frozen=True)
class Centre:
    """Exact sums of n vectors: n * nearest + rest, with a rest of n / 2 at most."""

    n: int
    nearest: np.ndarray  # integers
    rest: list[int]

    @property
    def size(self) -> int:
        return len(self.rest)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.nearest) - np.array([r / self.n for r in self.rest])

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2, exact."""
        y = x - self.nearest
        largest = self.n * (int(np.abs(y).max(initial=0)) + 1)
        kind = np.int64 if largest * largest * self.size < 1 << 63 else object  # Python's integers have no limit
        d = y.astype(kind) * self.n - np.array(self.rest, dtype=kind)
        return [int(v) for v in (d * d).sum(axis=1)]


def _centre(vectors: DataFrame) -> Centre | None:
    sums = materialize(vectors.mapInArrow(_sums, "size long, at long, n long, high long, low long"))
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    sums = sums.groupBy("size", "at").agg(F.sum("n").alias("n"), *exact)
    most = sums.where("at = 0").orderBy(F.desc("n"), F.desc("size")).select("size", "n").head()
    if most is None:
        return None
    rows = sums.where(F.col("size") == most["size"]).orderBy("at").collect()  # one row a dimension
    n, total = most["n"], [(int(r["high"]) << 31) + int(r["low"]) for r in rows]
    nearest = [(2 * s + n) // (2 * n) for s in total]
    return Centre(n, np.array(nearest, dtype=np.int64), [s - n * c for s, c in zip(total, nearest)])


def _added(matrices: DataFrame, size: int) -> np.ndarray:
    """Sum of all tasks' matrices (row, numbers), of ``size`` rows; added up where they are."""
    cells = matrices.select("row", F.posexplode("numbers").alias("at", "number"))
    cells = cells.groupBy("row", "at").agg(F.sum("number").alias("number"))
    numbers = F.array_sort(F.collect_list(F.struct("at", "number"))).getField("number")
    found = cells.groupBy("row").agg(numbers.alias("numbers")).orderBy("row").collect()
    assert len(found) == size
    return np.array([r["numbers"] for r in found])


def _as_rows(matrix: np.ndarray) -> pa.RecordBatch:
    rows, width = matrix.shape
    numbers = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * width, pa.int32()), pa.array(matrix.ravel()))
    return pa.record_batch([pa.array(np.arange(rows), pa.int32()), numbers], names=["row", "numbers"])


def _products(centre: Centre):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = np.zeros((centre.size, centre.size)), False
        for batch in batches:
            for _, x in _integers(batch.column(0)):
                if x.shape[1] == centre.size:
                    y = (x - centre.nearest).astype(np.float64)
                    total += y.T @ y
                    any_rows = True
        if any_rows:
            yield _as_rows(total)

    return rows


def covariance(vectors: DataFrame, centre: Centre) -> np.ndarray:
    """Covariance, divisor n, of the vectors that ``centre`` was taken of."""
    products = _added(vectors.mapInArrow(_products(centre), "row int, numbers array<double>"), centre.size)
    rest = np.array([r / centre.n for r in centre.rest])
    return products / centre.n - np.outer(rest, rest)


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, next to it, reflections) of a symmetric matrix, by Householder's method."""
    a = (matrix + matrix.T) / 2
    size, beside, mirrors = len(a), np.zeros(max(0, len(a) - 1)), []
    for k in range(size - 2):
        column = a[k + 1 :, k].copy()
        norm = np.linalg.norm(column)
        beside[k] = -np.copysign(norm, column[0])
        mirror = column
        mirror[0] -= beside[k]
        length = np.linalg.norm(mirror)
        mirror = mirror / length if length else mirror
        mirrors.append(mirror)
        rest = a[k + 1 :, k + 1 :]
        image = rest @ mirror
        image = 2 * (image - (mirror @ image) * mirror)
        rest -= np.outer(mirror, image) + np.outer(image, mirror)
    if size > 1:
        beside[-1] = a[-1, -2]
    return np.diag(a).copy(), beside, mirrors


def leading_eigenvalues(diagonal: np.ndarray, beside: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, by bisection with Sturm counts."""
    size = len(diagonal)
    reach = np.abs(np.append(beside, 0)) + np.abs(np.append(0, beside))
    low = np.full(count, (diagonal - reach).min())
    high = np.full(count, (diagonal + reach).max())
    span = max(abs(float(low[0])), abs(float(high[0])))
    low, high = low - 2 * _EPS * span, high + 2 * _EPS * span
    least = max(span * span, 1.0) * np.finfo(np.float64).tiny / _EPS
    wanted = size - np.arange(count)  # so many eigenvalues lie below a number above the one in search
    squares = beside * beside
    for _ in range(2048):
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high) | (high - low <= 2 * _EPS * np.maximum(np.abs(low), np.abs(high)))).all():
            break
        below, pivot = np.zeros(count, dtype=np.int64), diagonal[0] - middle
        for k in range(size):
            pivot = np.where(np.abs(pivot) < least, -least, pivot)
            below += pivot < 0
            if k + 1 < size:
                pivot = diagonal[k + 1] - middle - squares[k] / pivot
        high = np.where(below >= wanted, middle, high)
        low = np.where(below >= wanted, low, middle)
    return low + (high - low) / 2


def _solver(diagonal: np.ndarray, beside: np.ndarray, value: float, least: float):
    """Solves (T - value) y = b by elimination with row exchanges."""
    size = len(diagonal)
    d, up = (diagonal - value).tolist(), [*beside.tolist(), 0.0]
    low, far = beside.tolist(), [0.0] * size
    factor, swap = [0.0] * size, [False] * size
    for k in range(size - 1):
        if abs(low[k]) > abs(d[k]):
            swap[k] = True
            factor[k] = d[k] / low[k]
            d[k], d[k + 1], up[k] = low[k], up[k] - factor[k] * d[k + 1], d[k + 1]
            far[k], up[k + 1] = up[k + 1], -factor[k] * up[k + 1]
        else:
            d[k] = d[k] if abs(d[k]) > least else least
            factor[k] = low[k] / d[k]
            d[k + 1] -= factor[k] * up[k]
    d = [x if abs(x) > least else least for x in d]

    def solve(b: np.ndarray) -> np.ndarray:
        y = b.tolist()
        for k in range(size - 1):
            if swap[k]:
                y[k], y[k + 1] = y[k + 1], y[k] - factor[k] * y[k + 1]
            else:
                y[k + 1] -= factor[k] * y[k]
        for k in range(size - 1, -1, -1):
            if k + 1 < size:
                y[k] -= up[k] * y[k + 1]
            if k + 2 < size:
                y[k] -= far[k] * y[k + 2]
            y[k] /= d[k]
        return np.array(y)

    return solve


def eigenvectors(diagonal: np.ndarray, beside: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors, as rows, for falling ``values``, by inverse iteration.

    Vectors whose values follow each other within ``CLUSTER`` of the norm are
    kept orthogonal to each other in every step.
    """
    size = len(diagonal)
    norm = float(np.abs(diagonal).max(initial=0) + 2 * np.abs(beside).max(initial=0)) or 1.0
    start, found, first = np.random.default_rng(1), np.zeros((len(values), size)), 0
    for j, value in enumerate(values.tolist()):
        if j and values[j - 1] - value > CLUSTER * norm:
            first = j
        solve, own = _solver(diagonal, beside, value, _EPS * norm), found[first:j]
        y = start.uniform(-1, 1, size)
        for _ in range(6):
            for _ in range(2):
                y = y - own.T @ (own @ y)
            y = solve(y / np.linalg.norm(y))
            y /= np.abs(y).max()
        for _ in range(2):
            y = y - own.T @ (own @ y)
        found[j] = y / np.linalg.norm(y)
    return found


def principal(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as rows) of the ``count`` largest eigenvalues, falling."""
    diagonal, beside, mirrors = tridiagonal(matrix)
    values = leading_eigenvalues(diagonal, beside, min(count, len(matrix)))
    vectors = eigenvectors(diagonal, beside, values)
    for k in range(len(mirrors) - 1, -1, -1):
        part = vectors[:, k + 1 :]
        part -= 2 * np.outer(part @ mirrors[k], mirrors[k])
    return values, vectors


@dataclass(frozen=True)
class Whitening:
    centre: Centre
    values: np.ndarray
    explained: np.ndarray
    components: np.ndarray  # as rows
    live: np.ndarray  # components with variance

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates, one column a component; NaN where it has no variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(self.live, 1 / np.sqrt(np.maximum(self.values, 0)), np.nan)
        return (self.centre.centred(x) @ self.components.T) * scale


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Components of all usable vectors in the one column of ``vectors``; None without any."""
    centre = _centre(vectors)
    if centre is None:
        return None
    matrix = covariance(vectors, centre)
    values, rows = principal(matrix, components)
    trace = float(np.trace(matrix))
    live = values > 16 * _EPS * centre.size * max(trace, 0)  # below, rounding is all there is
    explained = np.where(live, values, 0) / trace if trace > 0 else np.zeros(len(values))
    return Whitening(centre, values, explained, rows, live)


def identity_error(vectors: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    live = np.flatnonzero(model.live)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = np.zeros((len(live) + 1, len(live))), False
        for batch in batches:
            for _, x in _integers(batch.column(0)):
                if x.shape[1] == model.centre.size:
                    y = model.project(x)[:, live]
                    total += np.vstack([y.T @ y, y.sum(axis=0)])
                    any_rows = True
        if any_rows:
            yield _as_rows(total)

    if not len(live):
        return None
    added = _added(vectors.mapInArrow(rows, "row int, numbers array<double>"), len(live) + 1) / model.centre.n
    return float(np.abs(added[:-1] - np.outer(added[-1], added[-1]) - np.eye(len(live))).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS, id: str = "vec_id", column: str = "embedding") -> DataFrame:
    """One row per usable vector and component.

    ``id``, component, n, deviation, whitened, explained, identity_error.
    """
    lists = vectors.select(F.col(column).cast("array<double>").alias("vector"))
    schema = T.StructType([T.StructField(id, vectors.schema[id].dataType)]).add("component", T.IntegerType())
    schema = schema.add("n", T.LongType()).add("deviation", T.DecimalType(38, 0)).add("whitened", T.DoubleType())
    schema = schema.add("explained", T.DoubleType()).add("identity_error", T.DoubleType())
    model = fit(lists, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    error, most = identity_error(lists, model), 10**38

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = len(model.values)
        for batch in batches:
            for own, x in _integers(batch.column(1)):
                if x.shape[1] != model.centre.size:
                    continue
                deviation = [Decimal(v) if v < most else None for v in model.centre.deviations(x)]
                total, each = len(own) * count, pa.array(np.repeat(np.arange(len(own)), count))
                whitened = pa.array(model.project(x).ravel(), from_pandas=True)
                yield pa.record_batch(
                    [
                        batch.column(0).take(pa.array(np.repeat(own, count))),
                        pa.array(np.tile(np.arange(1, count + 1), len(own)), pa.int32()),
                        pa.array(np.full(total, model.centre.n), pa.int64()),
                        pa.array(deviation, pa.decimal128(38, 0)).take(each),
                        whitened,
                        pa.array(np.tile(model.explained, len(own))),
                        pa.array([error] * total, pa.float64()),
                    ],
                    names=schema.names,
                )

    return vectors.select(F.col(id), F.col(column).cast("array<double>").alias("_vector")).mapInArrow(rows, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: leading whitened coordinates of every embedding."""
    found = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))

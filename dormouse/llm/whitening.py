"""Embeddings whitened by their leading principal components.

Sums, then products of centred vectors, are added up in the tasks that read them, and the tasks'
matrices by rounds of a few at a time. What comes to the driver is one matrix, whose size is that of
a vector, squared, however many vectors there are. Its eigenvalues are found there: Householder
reflections make it tridiagonal, bisection counts eigenvalues below a bound by the signs of a
Sturm sequence, inverse iteration gives vectors, made orthogonal within clusters of near equal
values. The components then go out with the tasks that project the vectors on them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dormouse.llm.spread import in_tasks, kept, named, quoted, undotted

COMPONENTS = 32
# An entry c counts as the whole number floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
# Entries from here on have no such number of 64 bits.
LARGEST = float(1 << 56)
# Matrices that are added up in one go.
FAN = 32
# A component has at least this share of all variance; less is what rounding leaves of none.
LEAST_SHARE = 1e-13
# Eigenvalues closer than this share of the largest are a cluster.
CLUSTER = 1e-3
_SAFE = 1 << 62


@dataclass(frozen=True)
class Model:
    """``sums`` of whole numbers over ``n`` vectors; ``components`` are rows, ``values`` their variances."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.values]


def usable(vector: Column) -> Column:
    """Vectors that are not null or empty and hold only finite entries, all below ``LARGEST``."""
    fine = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & fine, F.lit(False))


def whole_numbers(column: pa.Array, size: int) -> np.ndarray:
    """The vectors of a column as rows of 64-bit whole numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    entries = pc.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    return (np.floor(SCALE * entries).astype(np.int64) + SHIFT).reshape(-1, size)


def _largest(numbers: np.ndarray) -> int:
    return int(max(abs(int(numbers.max())), abs(int(numbers.min())))) if numbers.size else 0


def _total(x: np.ndarray) -> list[int]:
    """Exact sums of the columns."""
    if _largest(x) * max(1, len(x)) >= _SAFE:
        x = x.astype(object)
    return [int(s) for s in x.sum(axis=0)]


def _from_mean(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n * x - sums, exact: 64-bit numbers, or Python's where those do not do."""
    most = max(map(abs, sums), default=0)
    if n * _largest(x) + most < _SAFE:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    return (_from_mean(x, n, sums) / n).astype(np.float64)


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sums of squares of n * x - sums, exact; None where they have more than 63 bits."""
    y = _from_mean(x, n, sums)
    if _largest(y) ** 2 * max(1, y.shape[1]) >= _SAFE:
        y = y.astype(object)
    return [int(s) if int(s) < 1 << 63 else None for s in (y * y).sum(axis=1)]


def _sums(rows: DataFrame, vector: str) -> tuple[int, tuple[int, ...]]:
    """How many vectors there are of the most frequent length (the least of such), and the sums of their entries."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            column = batch.column(0)
            lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
            for size in np.unique(lengths).tolist():
                own = column.filter(pa.array(lengths == size))
                sums = _total(whole_numbers(own, size))
                n, before = found.get(size, (0, [0] * size))
                found[size] = (n + len(own), [a + b for a, b in zip(before, sums)])
        rows = [(size, i, n, str(s)) for size, (n, sums) in found.items() for i, s in enumerate(sums)]
        arrays = [pa.array(v, t) for v, t in zip(zip(*rows) if rows else [()] * 4, (pa.int32(), pa.int32(), pa.int64(), pa.string()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["size", "i", "n", "sum"])

    parts = in_tasks(rows.select(vector), work, "size int, i int, n long, sum string")
    exact = F.sum(F.col("sum").cast("decimal(28,0)"))
    totals = kept(parts.groupBy("size", "i").agg(F.sum("n").alias("n"), exact.alias("sum")))
    first = totals.where("i = 0").orderBy(F.desc("n"), "size").first()
    if first is None:
        return 0, ()
    own = totals.where(F.col("size") == first["size"]).orderBy("i").collect()
    return first["n"], tuple(int(r["sum"]) for r in own)


def _products(rows: DataFrame, vector: str, size: int, centred) -> np.ndarray:
    """The sum of centred' * centred over all rows, where ``centred`` makes rows of numbers of a batch's vectors.

    Every task adds up its own; then up to ``FAN`` matrices are added in one go, until one is left.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = centred(whole_numbers(batch.column(0), size))
            total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            yield _matrices([TaskContext.get().partitionId()], [total])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                matrix = np.frombuffer(data.as_buffer(), np.float64)
                totals[part] = totals[part] + matrix if part in totals else matrix
        if totals:
            yield _matrices(list(totals), list(totals.values()))

    schema = "part long, matrix binary"
    sums = kept(in_tasks(rows.select(vector), work, schema))
    left = sums.agg(F.max("part")).first()[0]
    while left:
        dealt = sums.select(F.expr(f"part div {FAN}").alias("part"), "matrix").repartition("part")
        sums, left = kept(in_tasks(dealt.sortWithinPartitions("part"), added, schema)), left // FAN
    found = sums.first()
    width = 0 if found is None else round((len(found["matrix"]) // 8) ** 0.5)
    return np.frombuffer(found["matrix"], np.float64).reshape(width, width) if width else np.zeros((0, 0))


def _matrices(parts: list[int], matrices: list[np.ndarray]) -> pa.RecordBatch:
    data = pa.array([m.tobytes() for m in matrices], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), data], names=["part", "matrix"])


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the reflections that make a symmetric matrix tridiagonal."""
    a, reflections = matrix.copy(), []
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        length = np.linalg.norm(v)
        v[0] += np.copysign(length, v[0])
        length = np.linalg.norm(v)
        if length > 0:
            v /= length
            rest = a[k + 1 :, k + 1 :]
            p = 2 * (rest @ v)
            w = p - (v @ p) * v
            rest -= np.outer(v, w) + np.outer(w, v)
            column = a[k + 1 :, k] - 2 * (v @ a[k + 1 :, k]) * v
            a[k + 1 :, k] = a[k, k + 1 :] = column
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflections


def reflected_back(vector: np.ndarray, reflections: list[np.ndarray]) -> np.ndarray:
    """A vector of the tridiagonal matrix's space in that of the matrix it was made from."""
    x = vector.copy()
    for v in reversed(reflections):
        tail = x[len(x) - len(v) :]
        tail -= 2 * (v @ tail) * v
    return x


def below(diagonal: np.ndarray, off: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many eigenvalues of a tridiagonal matrix lie below each bound: negative terms of the Sturm sequence."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    count = np.zeros(len(bounds), np.int64)
    q = np.ones(len(bounds))
    for i, d in enumerate(diagonal):
        q = d - bounds - (off[i - 1] ** 2 / q if i else 0)
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The largest eigenvalues of a tridiagonal matrix, falling, each by halving an interval that holds it."""
    size = len(diagonal)
    radius = np.zeros(size)
    radius[1:] += np.abs(off)
    radius[:-1] += np.abs(off)
    number = np.arange(size - 1, size - 1 - count, -1)
    low = np.full(count, (diagonal - radius).min())
    high = np.full(count, (diagonal + radius).max())
    while True:
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            return middle
        beyond = below(diagonal, off, middle) > number
        high, low = np.where(beyond, middle, high), np.where(beyond, low, middle)


def _factored(diagonal: np.ndarray, off: np.ndarray, value: float) -> tuple[list, list, list, list, list]:
    """The tridiagonal matrix less ``value`` as triangles, by elimination with exchange of neighbouring rows."""
    size = len(diagonal)
    small = np.finfo(float).eps * max(np.abs(diagonal).max(), np.abs(off).max(initial=0.0), np.finfo(float).tiny)
    first, second, third = [0.0] * size, [0.0] * size, [0.0] * size
    factors, exchanged = [0.0] * size, [False] * size
    a, b = float(diagonal[0] - value), float(off[0]) if size > 1 else 0.0
    for i in range(size - 1):
        low, d = float(off[i]), float(diagonal[i + 1] - value)
        after = float(off[i + 1]) if i + 2 < size else 0.0
        if abs(low) > abs(a):
            exchanged[i], factors[i] = True, a / low
            first[i], second[i], third[i] = low, d, after
            a, b = b - factors[i] * d, -factors[i] * after
        else:
            a = a if abs(a) > small else (small if a >= 0 else -small)
            factors[i] = low / a
            first[i], second[i], third[i] = a, b, 0.0
            a, b = d - factors[i] * b, after
    first[-1] = a if abs(a) > small else (small if a >= 0 else -small)
    return first, second, third, factors, exchanged


def _solved(factored: tuple[list, list, list, list, list], right: np.ndarray) -> np.ndarray:
    first, second, third, factors, exchanged = factored
    x = right.tolist()
    size = len(x)
    for i in range(size - 1):
        if exchanged[i]:
            x[i], x[i + 1] = x[i + 1], x[i] - factors[i] * x[i + 1]
        else:
            x[i + 1] -= factors[i] * x[i]
    for i in range(size - 1, -1, -1):
        beyond = second[i] * x[i + 1] if i + 1 < size else 0.0
        beyond += third[i] * x[i + 2] if i + 2 < size else 0.0
        x[i] = (x[i] - beyond) / first[i]
    return np.array(x)


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors, as rows, of falling eigenvalues of a tridiagonal matrix.

    Within a cluster, each vector is made orthogonal to those before it after every step. Values that
    are equal are moved apart by a rounding error, so that the steps do not all end in one vector.
    """
    size, norm = len(diagonal), max(np.abs(values).max(initial=0.0), np.finfo(float).tiny)
    choose = np.random.default_rng(13)
    vectors, cluster, shifted = np.zeros((len(values), size)), 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * norm:
            cluster = j
        shifted = min(value, shifted - 2 * np.finfo(float).eps * norm) if j > cluster else value
        factored, x = _factored(diagonal, off, shifted), choose.standard_normal(size)
        for _ in range(6):
            x = _solved(factored, x / np.abs(x).max())
            for _ in range(2):
                x = x / np.abs(x).max()
                x -= vectors[cluster:j].T @ (vectors[cluster:j] @ x)
            x /= np.linalg.norm(x)
        vectors[j] = x
    return vectors


def leading_components(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a covariance matrix, falling, and their eigenvectors as rows.

    Values that are no more than rounding errors, and their vectors, are left out.
    """
    largest = np.abs(matrix).max(initial=0.0)
    if largest == 0:
        return np.zeros(0), np.zeros((0, len(matrix)))
    scaled = matrix / largest
    diagonal, off, reflections = tridiagonal(scaled)
    values = leading_values(diagonal, off, min(count, len(matrix)))
    values = values[values > LEAST_SHARE * np.trace(scaled)]
    vectors = inverse_iteration(diagonal, off, values)
    return values * largest, np.array([reflected_back(v, reflections) for v in vectors])


def fit(vectors: DataFrame, vector: str, components: int = COMPONENTS) -> Model:
    """Mean and leading components of all usable vectors of the most frequent length.

    Vectors that are null or empty or hold a null, NaN or infinite entry count nowhere, nor do those
    of another length, which have no place in the space. Repeated rows count each time. Without
    vectors, or where all are equal, there are no components. Other columns are not looked at.
    """
    rows = vectors.select(F.col(quoted(vector)).alias("vector")).where(usable(F.col("vector")))
    n, sums = _sums(rows, "vector")
    size = len(sums)
    rows = rows.where(F.size("vector") == size)
    products = _products(rows, "vector", size, lambda x: _centred(x, n, sums)) if n else np.zeros((0, 0))
    covariance = products / max(1, n)
    values, found = leading_components(covariance, components)
    return Model(n, sums, values, found, float(np.trace(covariance)))


def _projected(x: np.ndarray, model: Model) -> np.ndarray:
    return _centred(x, model.n, model.sums) @ (model.components.T / np.sqrt(model.values))


def of_space(vectors: DataFrame, vector: str, model: Model) -> DataFrame:
    """The rows whose vectors the model can project."""
    column = F.col(quoted(vector))
    return vectors.where(usable(column) & (F.size(column) == len(model.sums)))


def whitened(vectors: DataFrame, vector: str, model: Model, result: str) -> DataFrame:
    """The usable rows with all columns, and ``result``: a struct of ``deviation`` and ``whitened``.

    ``whitened`` has a number for each component, ``deviation`` is null where it has more than 63
    bits. Rows are projected by themselves, repeated ones alike. A column named like ``result`` is
    replaced. No usable row, no result; without components ``whitened`` is empty.
    """
    rows, plain = undotted(of_space(vectors, vector, model).drop(result))
    name = plain[vector]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole_numbers(batch.column(name), len(model.sums))
            found = _projected(x, model)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * found.shape[1], pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))
            deviations = pa.array(_deviations(x, model.n, model.sums), pa.int64())
            both = pa.StructArray.from_arrays([deviations, lists], names=["deviation", "whitened"])
            yield pa.RecordBatch.from_arrays([*batch.columns, both], names=[*batch.schema.names, result])

    schema = f"{named(rows)}, {quoted(result)} struct<deviation:bigint,whitened:array<double>>"
    return in_tasks(rows, work, schema).toDF(*plain, result)


def identity_error(vectors: DataFrame, vector: str, model: Model) -> float:
    """How far the whitened vectors' covariance is from the identity: the largest entry of the difference.

    It is measured on all vectors, about their own mean. Without components it is 0.
    """
    if not len(model.values):
        return 0.0
    rows = of_space(vectors, vector, model).select(quoted(vector))

    def with_one(x: np.ndarray) -> np.ndarray:
        return np.hstack([_projected(x, model), np.ones((len(x), 1))])

    products = _products(rows.toDF("vector"), "vector", len(model.sums), with_one) / model.n
    mean = products[-1, :-1]
    covariance = products[:-1, :-1] - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(len(mean))).max())

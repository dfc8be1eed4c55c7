"""Embedding whitening: exact integer centring, a distributed covariance, an eigensolver of its own, a projection.

1. Entries become integers ``floor(64 c) + 1000000``. One pass sums them per dimension without rounding.
2. A second pass sums the products of the centred vectors ``(n x - S) / n``: each task sends one triangle of
   numbers, added up by position. What reaches the driver is a matrix of dims x dims, whatever the number of rows.
3. Householder reflections bring that matrix to tridiagonal form, bisection with Sturm counts finds its leading
   eigenvalues, inverse iteration their vectors, orthogonalised again within clusters of close eigenvalues.
4. A third pass measures the covariance of the whitened vectors, a fourth one writes them. The projection that is sent
   to the tasks has at most ``MOST_DIMS`` x 32 numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.llm.common import ship, struct_of

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Longer vectors are refused: the covariance is held in one worker and on the driver.
MOST_DIMS = 4096
#: Entries beyond are cut to it, so that every quantised entry is an exact double and long.
LARGEST = 1 << 52
_EPS = np.finfo(float).eps
#: Rows of one numpy pass.
ROWS = 2048


def quantised(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(values * SCALE), -LARGEST, LARGEST).astype(np.int64) + OFFSET


def exact_sums(x: np.ndarray) -> np.ndarray:
    """Sums of the columns as Python integers."""
    return (x >> 26).sum(axis=0).astype(object) * (1 << 26) + (x & ((1 << 26) - 1)).sum(axis=0).astype(object)


def vectors_of(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, vectors) of the batch's vectors without null or non-finite entries, by their length."""
    lists = batch.column(column)
    lengths = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False)
    entries = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    starts = np.cumsum(np.maximum(lengths, 0)) - np.maximum(lengths, 0)
    for dims in np.unique(lengths[lengths > 0]).tolist():
        found = np.flatnonzero(lengths == dims)
        for k in range(0, len(found), ROWS):
            rows = found[k:k + ROWS]
            values = entries[starts[rows][:, None] + np.arange(dims)]
            good = np.isfinite(values).all(axis=1)
            if good.any():
                yield rows[good], values[good]


@dataclass(frozen=True)
class Centre:
    """The fit list's length, dimensions and exact sums."""

    n: int
    dims: int
    sums: tuple[int, ...]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: longs where they suffice, else Python integers."""
        if max(self.n * (LARGEST + OFFSET) if self.n * int(np.abs(x).max()) >= 1 << 62 else 0, *map(abs, self.sums)) < 1 << 62:
            return self.n * x - np.array(self.sums, dtype=np.int64)
        return self.n * x.astype(object) - np.array(self.sums, dtype=object)


def squares(deviations: np.ndarray) -> list[int | None]:
    """Exact sums of squares per row; null beyond the longs."""
    about = (deviations.astype(np.float64) ** 2).sum(axis=1)
    out: list[int | None] = [None] * len(about)
    if deviations.dtype != object:
        safe = np.flatnonzero(about < 4e18)
        for k, value in zip(safe.tolist(), (deviations[safe] ** 2).sum(axis=1).tolist(), strict=True):
            out[k] = value
    for k in np.flatnonzero((about < 1e19) & (about >= (0 if deviations.dtype == object else 4e18))).tolist():
        value = sum(int(v) ** 2 for v in deviations[k])
        out[k] = value if value < 1 << 63 else None
    return out


def centre_of(vectors: DataFrame, column: str) -> Centre | None:
    """The centre of the commonest length of vectors (of several, the longest); none without a vector."""
    schema = struct_of(("dims", T.IntegerType()), ("place", T.IntegerType()), ("n", T.LongType()), ("total", T.DecimalType(38, 0)))
    kinds = pa.schema([("dims", pa.int32()), ("place", pa.int32()), ("n", pa.int64()), ("total", pa.decimal128(38, 0))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[int, int] = {}
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for rows, values in vectors_of(batch, column):
                dims = values.shape[1]
                n[dims] = n.get(dims, 0) + len(rows)
                sums[dims] = sums.get(dims, 0) + exact_sums(quantised(values))
        for dims, count in n.items():
            yield pa.RecordBatch.from_arrays([
                pa.array([dims] * dims, pa.int32()), pa.array(range(dims), pa.int32()), pa.array([count] * dims, pa.int64()),
                pa.array([Decimal(int(s)) for s in sums[dims]], pa.decimal128(38, 0))], schema=kinds)

    parts = vectors.mapInArrow(run, schema).groupBy("dims", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    found = parts.groupBy("dims").agg(F.max("n").alias("n"), F.max("place").alias("last"),
                                      F.sort_array(F.collect_list(F.struct("place", "total"))).alias("sums"))
    first = found.orderBy(F.desc("n"), F.desc("dims")).first()
    if first is None:
        return None
    if first["dims"] > MOST_DIMS:
        raise ValueError(f"vectors of {first['dims']} dimensions; at most {MOST_DIMS} are whitened")
    return Centre(first["n"], first["dims"], tuple(int(s["total"]) for s in first["sums"]))


def summed_products(vectors: DataFrame, column: str, centre: Centre, onto: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sums over the fit list of the centred vectors' products and of the vectors, projected by ``onto`` if given.

    Every task adds up its own rows and sends one triangle.
    """
    schema = struct_of(("i", T.IntegerType()), ("j", T.IntegerType()), ("value", T.DoubleType()))
    size = centre.dims if onto is None else onto.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, sums, seen = np.zeros((size, size)), np.zeros(size), False
        for batch in batches:
            for _, values in vectors_of(batch, column):
                if values.shape[1] == centre.dims:
                    y = centre.deviations(quantised(values)).astype(np.float64) / centre.n
                    y = y if onto is None else y @ onto
                    products += y.T @ y
                    sums += y.sum(axis=0)
                    seen = True
        if seen:
            i, j = np.triu_indices(size)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate((i, np.arange(size))), pa.int32()), pa.array(np.concatenate((j, np.full(size, -1))), pa.int32()),
                pa.array(np.concatenate((products[i, j], sums)), pa.float64())], names=["i", "j", "value"])

    products, sums = np.zeros((size, size)), np.zeros(size)
    # at most size * (size + 3) / 2 rows, however many tasks there were
    for i, j, value in vectors.mapInArrow(run, schema).groupBy("i", "j").agg(F.sum("value")).collect():
        if j < 0:
            sums[i] = value
        else:
            products[i, j] = products[j, i] = value
    return products, sums


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """Diagonal, side diagonal and reflectors of a symmetric matrix's Householder reduction."""
    a, n = matrix.copy(), len(matrix)
    reflectors: list[np.ndarray | None] = []
    for k in range(n - 2):
        v = a[k + 1:, k].copy()
        if not v[1:].any():
            reflectors.append(None)
            continue
        side = -np.copysign(np.linalg.norm(v), v[0])
        v[0] -= side
        v /= np.linalg.norm(v)
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        w = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        a[k + 1, k] = side
        reflectors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def eigenvalues_below(diagonal: np.ndarray, side: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues of the tridiagonal matrix lie below each point."""
    tiny = np.finfo(float).tiny / _EPS
    q = diagonal[0] - at
    count = (q < 0).astype(np.int64)
    for k in range(1, len(diagonal)):
        q = diagonal[k] - at - side[k - 1] ** 2 / np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, side: np.ndarray, most: int) -> np.ndarray:
    """The largest ``most`` eigenvalues, falling, by bisection to the last bits."""
    n = len(diagonal)
    reach = np.concatenate(([0.0], np.abs(side))) + np.concatenate((np.abs(side), [0.0]))
    wanted = n - 1 - np.arange(min(most, n))  # the wanted ones' numbers from below
    size = np.abs(diagonal).max() + reach.max()
    low = np.full(len(wanted), (diagonal - reach).min() - _EPS * size)
    high = np.full(len(wanted), (diagonal + reach).max() + _EPS * size)
    for _ in range(200):
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        above = eigenvalues_below(diagonal, side, middle) > wanted
        high, low = np.where(above, middle, high), np.where(above, low, middle)
    return low + (high - low) / 2


def solved(diagonal: np.ndarray, side: np.ndarray, values: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Solutions of ``(T - value) x = right`` for all values at once, by elimination with row exchanges."""
    n, m = right.shape
    tiny = _EPS * max(np.abs(diagonal).max(), np.abs(side).max(initial=0.0), np.finfo(float).tiny)
    upper = np.zeros((3, n, m))
    b = right.copy()
    here, after = diagonal[0] - values, np.full(m, side[0] if n > 1 else 0.0)
    for k in range(n - 1):
        below, centre, last = np.full(m, side[k]), diagonal[k + 1] - values, np.full(m, side[k + 1] if k + 2 < n else 0.0)
        swap = np.abs(below) > np.abs(here)
        pivot = np.where(swap, below, here)
        pivot = np.where(np.abs(pivot) < tiny, tiny, pivot)
        factor = np.where(swap, here, below) / pivot
        upper[0, k], upper[1, k], upper[2, k] = pivot, np.where(swap, centre, after), np.where(swap, last, 0.0)
        here = np.where(swap, after - factor * centre, centre - factor * after)
        after = np.where(swap, -factor * last, last)
        first, second = b[k].copy(), b[k + 1].copy()
        b[k], b[k + 1] = np.where(swap, second, first), np.where(swap, first - factor * second, second - factor * first)
    upper[0, n - 1] = np.where(np.abs(here) < tiny, tiny, here)
    x = np.zeros_like(b)
    for k in range(n - 1, -1, -1):
        total = b[k]
        if k + 1 < n:
            total = total - upper[1, k] * x[k + 1]
        if k + 2 < n:
            total = total - upper[2, k] * x[k + 2]
        x[k] = total / upper[0, k]
        big = np.abs(x[k:]).max(axis=0)
        if (big > 1e200).any():
            shrink = np.where(big > 1e200, 1e-200, 1.0)
            x[k:] *= shrink
            b[:k] *= shrink
    return x


def eigenvectors(diagonal: np.ndarray, side: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit vectors (columns) by inverse iteration; within a cluster each is kept orthogonal to those before it."""
    n, m = len(diagonal), len(values)
    size = max(np.abs(diagonal).max(), np.abs(side).max(initial=0.0))
    apart = values.copy()
    for j in range(1, m):  # equal eigenvalues are moved apart by a few bits
        apart[j] = min(apart[j], apart[j - 1] - 4 * _EPS * size)
    start = np.zeros(m, dtype=np.int64)
    for j in range(1, m):
        start[j] = start[j - 1] if values[j - 1] - values[j] < 1e-3 * size else j
    x = np.random.default_rng(7).uniform(-1, 1, (n, m))
    x /= np.linalg.norm(x, axis=0)
    for _ in range(5):
        x = solved(diagonal, side, apart, x)
        x /= np.abs(x).max(axis=0)
        for j in range(m):
            for _ in range(2):
                before = x[:, start[j]:j]
                x[:, j] -= before @ (before.T @ x[:, j])
            x[:, j] /= np.linalg.norm(x[:, j])
    return x


def principal(matrix: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The leading eigenvalues (falling) and unit eigenvectors (columns) of a covariance.

    Eigenvalues that are zero to double precision are left out: nothing can be divided by their root.
    """
    size = np.abs(matrix).max(initial=0.0)
    if not size > 0:
        return np.zeros(0), np.zeros((len(matrix), 0))
    diagonal, side, reflectors = tridiagonal(matrix / size)
    values = leading_eigenvalues(diagonal, side, most)
    values = values[values > 16 * len(matrix) * _EPS * values[0]]
    x = eigenvectors(diagonal, side, values)
    for k in range(len(reflectors) - 1, -1, -1):
        v = reflectors[k]
        if v is not None:
            x[k + 1:] -= 2 * np.outer(v, v @ x[k + 1:])
    return values * size, x


def whiten(table: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): a row per vector and component.

    Vectors that are null, empty, or hold null or non-finite entries are dropped, and so are those of another
    length than the commonest one (of equally common ones the longest). Rows with a null key and repeated
    rows are rows like others. Components with variance zero to double precision are left out, so equal vectors, a
    single one or an empty table give no rows. ``deviation`` is null where it passes the longs. Entries whose
    64-fold passes 2^52 count as that. Other columns are not read.
    """
    spark = table.sparkSession
    ship(spark)
    kind = table.schema[key].dataType
    rows = table.select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v"))
    schema = struct_of((key, kind), ("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()),
                       ("whitened", T.DoubleType()), ("explained", T.DoubleType()), ("identity_error", T.DoubleType()))
    vectors = rows.select("v")
    centre = centre_of(vectors, "v")
    if centre is None:
        return spark.createDataFrame([], schema)
    covariance = summed_products(vectors, "v", centre)[0] / centre.n
    values, axes = principal(covariance, components)
    if not len(values):
        return spark.createDataFrame([], schema)
    onto = axes / np.sqrt(values)
    explained = values / np.trace(covariance)
    products, sums = summed_products(vectors, "v", centre, onto)
    mean = sums / centre.n
    error = float(np.abs(products / centre.n - np.outer(mean, mean) - np.eye(len(values))).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = len(values)
        for batch in batches:
            keys = batch.column("k")
            for numbers, x in vectors_of(batch, "v"):
                if x.shape[1] != centre.dims:
                    continue
                deviations = centre.deviations(quantised(x))
                white = (deviations.astype(np.float64) / centre.n) @ onto
                n = len(numbers)
                yield pa.RecordBatch.from_arrays([
                    keys.take(pa.array(np.repeat(numbers, m))), pa.array(np.tile(np.arange(1, m + 1), n), pa.int32()),
                    pa.array(np.full(n * m, centre.n), pa.int64()),
                    pa.array(squares(deviations), pa.int64()).take(pa.array(np.repeat(np.arange(n), m))), pa.array(white.ravel(), pa.float64()),
                    pa.array(np.tile(explained, n), pa.float64()), pa.array(np.full(n * m, error), pa.float64())],
                    names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)

"""Whitening of embeddings by FEAST: eigenvectors of an interval by contour integration.

1. Spark makes the vectors whole numbers, takes each distinct one once, and adds up
   counts, sums and centred products: a matrix of the dimension squared, however many
   vectors there are.
2. Inertia: the covariance is brought to tridiagonal form once; the signs of the pivots
   of its shifted factorisation count the eigenvalues above a shift. Bisection finds an
   interval whose lower end lies in a gap below the components asked for.
3. FEAST: the spectral projector of the interval is a contour integral of (z I - V)^-1.
   Each node of the quadrature is a complex shifted solve with a block of vectors, and
   each solve is a task. Rayleigh-Ritz in the projected block gives eigenvalues and
   vectors; the two steps repeat until the residuals are at the level of rounding.
4. The number of eigenvalues found in the interval must be the one that inertia counts;
   else, or without convergence, the block of vectors grows, up to the whole space.
5. Spark projects every row, and the covariance of the whitened vectors is checked.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

COMPONENTS = 4
SCALE = 256
NODES = 8
MOST_STEPS = 20
# Of the trace: eigenvalues below are zero but for rounding; residuals below are settled.
NO_VARIANCE = 1e-13
SETTLED = 1e-14
SAME = 1e-9
# Candidates for the gap below the components.
LOOK_AHEAD = 6
SUM_GROUPS = 32


# --- statistics ---------------------------------------------------------------------


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * c) of each entry as a long; null where the vector is null or holds a null or no finite number."""
    values = F.transform(vector, lambda c: c.cast("double"))
    odd = F.exists(values, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return F.when(~odd, F.transform(values, lambda c: F.floor(c * F.lit(float(scale))).cast("long")))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py() : column.offsets[-1].as_py()].reshape(len(column), -1)


def _sum_rows(dim: int):
    """Per task: count, and sums of the high and the low halves of the numbers, which do not overflow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(2 * dim, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                n += len(x)
                sums += np.concatenate([(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([sums.tolist()], pa.list_(pa.int64()))], names=["n", "sums"])

    return run


def sums_of(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sum of each dimension."""
    parts = fit.mapInArrow(_sum_rows(dim), "n long, sums array<long>")
    spread = parts.select("n", F.posexplode("sums").alias("i", "s")).withColumn("s", F.col("s").cast("decimal(38,0)"))
    rows = spread.groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
    at = {r["i"]: int(r["s"]) for r in rows}
    return int(rows[0]["n"]), [(at[i] << 32) + at[dim + i] for i in range(dim)]


def _product_rows(mean: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(mean), len(mean)))
        for batch in batches:
            if batch.num_rows:
                y = _matrix(batch.column(0)).astype(np.float64) - mean
                total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["m"])

    return run


def _add(rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(m, dtype=np.float64) for m in rows["m"].to_pylist())
    return pa.table({"m": pa.array([total.tobytes()], pa.binary())})


def covariance(fit: DataFrame, mean: np.ndarray, n: int) -> np.ndarray:
    """Centred products over ``n``: added per task, then in ``SUM_GROUPS`` groups, then here."""
    parts = fit.mapInArrow(_product_rows(mean), "m binary").withColumn("g", F.pmod(F.spark_partition_id(), F.lit(SUM_GROUPS)))
    rows = parts.groupBy("g").applyInArrow(lambda t: _add(t.select(["m"])), "m binary").collect()
    total = sum(np.frombuffer(r["m"], dtype=np.float64) for r in rows).reshape(len(mean), len(mean))
    return (total + total.T) / (2.0 * n)


# --- inertia ------------------------------------------------------------------------


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a similar tridiagonal matrix, by Householder reflections."""
    a = v.astype(np.float64).copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k]
        norm = np.sqrt(x @ x)
        if norm == 0.0 or not x[1:].any():
            continue
        u = x.copy()
        u[0] += norm if x[0] >= 0 else -norm
        u /= np.sqrt(u @ u)
        sub = a[k + 1 :, k + 1 :]
        p = sub @ u
        w = 2.0 * (p - (u @ p) * u)
        sub -= np.outer(u, w) + np.outer(w, u)
        a[k + 1 :, k] -= 2.0 * u * (u @ a[k + 1 :, k])
        a[k, k + 1 :] = a[k + 1 :, k]
    return np.diag(a).copy(), np.diag(a, -1).copy()


class Inertia:
    """How many eigenvalues of a symmetric matrix lie above a shift."""

    def __init__(self, v: np.ndarray):
        self.diagonal, self.beside = tridiagonal(v)
        spread = np.abs(np.append(self.beside, 0.0)) + np.abs(np.append(0.0, self.beside))
        self.low, self.high = float((self.diagonal - spread).min()), float((self.diagonal + spread).max())

    def above(self, shift: float) -> int:
        """Positive pivots of the factorisation of the matrix less the shift (Sylvester's law)."""
        tiny = np.finfo(float).eps * max(abs(self.low), abs(self.high), 1e-300)
        count, pivot = 0, 1.0
        for d, e in zip(self.diagonal.tolist(), [0.0, *self.beside.tolist()]):
            pivot = d - shift - e * e / pivot
            if abs(pivot) < tiny:
                pivot = -tiny
            count += pivot > 0
        return count

    def eigenvalue(self, rank: int) -> float:
        """The ``rank``-th largest, by bisection on the count."""
        low, high = self.low, self.high
        for _ in range(100):
            middle = (low + high) / 2
            if not low < middle < high:
                break
            low, high = (middle, high) if self.above(middle) >= rank else (low, middle)
        return (low + high) / 2


def interval(inertia: Inertia, wanted: int, zero: float) -> tuple[float, float, int]:
    """(low, high, count): the ``wanted`` largest eigenvalues above ``zero``, and those after them down to the widest of the next gaps.

    Eigenvalues that agree but for rounding have no gap between them.
    """
    have, dim = min(wanted, inertia.above(zero)), len(inertia.diagonal)
    if not have:
        return zero, zero, 0
    value, best = inertia.eigenvalue(have), (-1.0, zero)
    for _ in range(LOOK_AHEAD):
        count = inertia.above(value * (1 - SAME))
        after = max(inertia.eigenvalue(count + 1), zero) if count < dim else zero
        best = max(best, (value - after, (value + after) / 2))
        value = after
        if value <= zero:
            break
    low = best[1]
    high = inertia.high + 0.01 * (inertia.high - low)
    return low, high, inertia.above(low)


# --- contour integration --------------------------------------------------------------


def contour(low: float, high: float, nodes: int = NODES) -> list[tuple[complex, complex]]:
    """Gauss-Legendre nodes and weights on the upper half of the circle around the interval."""
    points, weights = np.polynomial.legendre.leggauss(nodes)
    centre, radius = (low + high) / 2, (high - low) / 2
    angles = -np.pi / 2 * (points - 1)
    return [(centre + radius * np.exp(1j * t), w * radius * np.exp(1j * t) / 2) for t, w in zip(angles, weights)]


def _solves(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, block = shared.value
        for batch in batches:
            for zr, zi, wr, wi in zip(*(c.to_pylist() for c in batch.columns)):
                shifted = complex(zr, zi) * np.eye(len(v)) - v
                part = (complex(wr, wi) * np.linalg.solve(shifted, block.astype(complex))).real
                yield pa.RecordBatch.from_arrays([pa.array([part.tobytes()], pa.binary())], names=["m"])

    return run


def project(spark: SparkSession, v: np.ndarray, block: np.ndarray, points: list[tuple[complex, complex]]) -> np.ndarray:
    """The block through the spectral projector of the contour's interval; one task per solve."""
    shared = spark.sparkContext.broadcast((v, block))
    rows = spark.createDataFrame([tuple(map(float, (z.real, z.imag, w.real, w.imag))) for z, w in points], "zr double, zi double, wr double, wi double")
    parts = rows.repartition(len(points)).mapInArrow(_solves(shared), "m binary").collect()
    shared.unpersist()
    return sum(np.frombuffer(r["m"], dtype=np.float64) for r in parts).reshape(block.shape)


@dataclass
class Eigen:
    """Eigenvalues, falling, their unit vectors in columns, and how they were found."""

    values: np.ndarray
    vectors: np.ndarray
    counted: int
    steps: int


def feast(spark: SparkSession, v: np.ndarray, wanted: int, seed: int = 42) -> Eigen:
    """The ``wanted`` largest eigenpairs of a covariance; fewer where there is no more variance."""
    dim, trace = len(v), float(np.trace(v))
    empty = Eigen(np.zeros(0), np.zeros((dim, 0)), 0, 0)
    if not trace > 0:
        return empty
    scaled = v / trace
    inertia = Inertia(scaled)
    low, high, count = interval(inertia, wanted, NO_VARIANCE)
    if not count:
        return empty
    points, size, steps = contour(low, high), min(dim, 2 * count + 4), 0
    rng = np.random.default_rng(seed)
    while True:
        block = rng.standard_normal((dim, size))
        for _ in range(MOST_STEPS):
            steps += 1
            basis = np.linalg.qr(block if size == dim else project(spark, scaled, block, points))[0]
            small = basis.T @ (scaled @ basis)
            values, turn = np.linalg.eigh((small + small.T) / 2)
            values, block = values[::-1], basis @ turn[:, ::-1]
            inside = values > low
            found = block[:, inside]
            residual = np.abs(scaled @ found - found * values[inside]).max(initial=0.0)
            if inside.sum() == count and (residual <= SETTLED or size == dim):
                keep = min(wanted, count)
                return Eigen(values[:keep] * trace, block[:, :keep], count, steps)
            if size == dim:
                raise RuntimeError(f"{int(inside.sum())} eigenvalues where inertia counts {count}")
        size = min(dim, 2 * size)


# --- whitening ------------------------------------------------------------------------


@dataclass
class Whitening:
    """What is needed to whiten a row: the list's size and sums, eigenpairs and trace."""

    n: int
    sums: list[int]
    eigen: Eigen
    trace: float

    def projection(self) -> tuple[np.ndarray, np.ndarray]:
        mean = np.array([s / self.n for s in self.sums])
        return mean, self.eigen.vectors / np.sqrt(self.eigen.values)


def fit_whitening(fit: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening:
    """From a stored table of distinct vectors in its only column."""
    n, sums = sums_of(fit, dim)
    v = covariance(fit, np.array([s / n for s in sums]), n)
    return Whitening(n, sums, feast(fit.sparkSession, v, min(components, dim)), float(np.trace(v)))


def whitened(model: Whitening, x: Column) -> Column:
    """UDF: the row's components, ``array<double>``."""
    mean, onto = model.projection()

    @F.arrow_udf("array<double>")
    def apply(batch: pa.Array) -> pa.Array:
        if not len(batch):
            return pa.array([], pa.list_(pa.float64()))
        out = (_matrix(batch).astype(np.float64) - mean) @ onto
        return pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), onto.shape[1]).cast(pa.list_(pa.float64())) if onto.shape[1] else pa.array([[]] * len(batch), pa.list_(pa.float64()))

    return apply(x)


def identity_error(model: Whitening, fit: DataFrame) -> float | None:
    """Largest entry of |covariance of the whitened list - identity|; None without components."""
    k = len(model.eigen.values)
    if not k:
        return None
    w = fit.select(whitened(model, F.col(fit.columns[0])).alias("w")).select(*[F.col("w")[i].alias(f"w{i}") for i in range(k)])
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = w.agg(*[F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def deviation(x: Column, n: int, sums: list[int]) -> Column:
    """Sum over dimensions of (n x - S)^2, exact; null beyond a long."""
    total = F.lit(0).cast("long")
    if any(abs(s) >= 1 << 62 for s in sums):
        return F.lit(None).cast("long")
    gaps = F.zip_with(x, F.lit(np.array(sums, dtype=np.int64)), lambda a, s: F.try_subtract(F.try_multiply(a, F.lit(n).cast("long")), s))
    return F.aggregate(gaps, total, lambda acc, g: F.try_add(acc, F.try_multiply(g, g)))


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """Per usable row and component: key, component, n, deviation, whitened, explained, identity_error.

    Usable rows hold a vector without nulls and with finite numbers only, of the most
    frequent length above zero (of two, the greater). The statistics are those of the
    distinct vectors, so a vector that a third of the rows share counts once. A
    component without variance (all vectors the same, or in a smaller space) has no
    whitened value: null, with ``explained`` 0 (null where nothing varies at all). Null
    keys and repeated rows each keep their rows; without usable rows there are none.
    Further columns are ignored, whatever their names.
    """
    x = whole_numbers(F.col(f"`{vector}`"), scale)
    slim = written(rows.select(F.col(f"`{key}`").alias("key"), x.alias("x")).filter("x is not null and size(x) > 0"))
    sizes = slim.groupBy(F.size("x").alias("d")).count().collect()
    if not sizes:
        none = {"component": "int", "n": "long", "deviation": "long", "whitened": "double", "explained": "double", "identity_error": "double"}
        return slim.select(F.col("key").alias(key), *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
    dim = max(((r["count"], r["d"]) for r in sizes))[1]
    slim = slim.filter(F.size("x") == dim)
    fit = written(slim.select("x").distinct())
    model = fit_whitening(fit, dim, components)
    error, shown = identity_error(model, fit), min(components, dim)
    shares = [float(e) / model.trace for e in model.eigen.values] + [0.0] * shown if model.trace > 0 else [None] * shown
    share = F.array(*[F.lit(s).cast("double") for s in shares[:shown]])
    out = slim.select("key", deviation(F.col("x"), model.n, model.sums).alias("deviation"), whitened(model, F.col("x")).alias("w"))
    return out.select("key", "deviation", "w", F.posexplode(share).alias("i", "explained")).select(
        F.col("key").alias(key),
        (F.col("i") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.get("w", F.col("i")).alias("whitened"),
        "explained",
        F.lit(error).cast("double").alias("identity_error"),
    )

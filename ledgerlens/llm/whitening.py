"""Whitening of embeddings from an exact distributed covariance.

Vectors become integers (``floor(scale * c) + offset``), so that sums are exact
and the same whatever the tasks and their order: the first pass sums the
entries; the second centres each entry at its rounded mean and sums products.
Products of whole numbers are taken by blocks of rows small enough for float64
to hold them exactly, and summed as whole numbers in two halves. What the
rounding of the means leaves is subtracted on the driver, which sees one number
a pair of dimensions, never rows. Eigenvectors come from ``eigen``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, store
from .eigen import symmetric_eigen

SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
#: Entries of this magnitude are no embeddings: their squares would not fit a float64.
MOST = 1 << 15
#: An eigenvalue of at most this share of the largest is no variance at all.
NO_VARIANCE = 1e-14
_HALF = 32


@dataclass
class Fit:
    """n vectors with sums ``sums``; covariance eigenvalues, falling, the unit
    eigenvectors as columns, and the covariance's trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def whole_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int, offset: int) -> DataFrame:
    """``id`` and ``x``: the vectors without a null or non-finite entry, in
    whole numbers. Only the two columns are read."""
    vec = F.col(vec_col)

    def odd(c: Column) -> Column:
        v = c.cast("double")
        return c.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))

    far = 4.0 * MOST * scale  # refused later, but no overflow here

    def whole(c: Column) -> Column:
        scaled = c.cast("double") * F.lit(float(scale))
        held = F.greatest(F.lit(-far), F.least(F.lit(far), scaled))
        return F.floor(held).cast("long") + F.lit(offset).cast("long")

    clean = df.where(vec.isNotNull() & ~F.exists(vec, odd))
    return clean.select(F.col(id_col).alias("id"), F.transform(vec, whole).alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _sums(x: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and the sum of each dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, np.int64)
        for batch in batches:
            m = _matrix(batch.column(0), d)
            n, total = n + len(m), total + m.sum(axis=0)
        if n:
            yield pa.record_batch([pa.array([n]), pa.array([total.tolist()], pa.list_(pa.int64()))],
                                  ["n", "s"])

    parts = map_batches(x.select("x"), run, "n long, s array<long>")
    rows = parts.select("n", F.posexplode("s").alias("i", "s")).groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()  # one a dimension
    rows.sort(key=lambda r: r["i"])
    return rows[0]["n"], [int(r["s"]) for r in rows]


def _products(x: DataFrame, pivot: list[int]) -> np.ndarray:
    """Exact sums of (x_i - pivot_i) * (x_j - pivot_j), as Python integers."""
    d, centre = len(pivot), np.array(pivot, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros((d, d), np.int64), np.zeros((d, d), np.int64)
        for batch in batches:
            y = (_matrix(batch.column(0), d) - centre).astype(np.float64)
            step = max(1, int(2 ** 53 // max(1.0, float(np.abs(y).max(initial=0)) ** 2)))
            for at in range(0, len(y), step):
                block = y[at:at + step]
                part = (block.T @ block).astype(np.int64)  # exact: all sums are below 2^53
                high += part >> _HALF
                low += part & ((1 << _HALF) - 1)
        yield pa.record_batch([pa.array(np.arange(d, dtype=np.int32)),
                               pa.array(high.tolist(), pa.list_(pa.int64())),
                               pa.array(low.tolist(), pa.list_(pa.int64()))], ["i", "high", "low"])

    parts = map_batches(x.select("x"), run, "i int, high array<long>, low array<long>")
    rows = (parts.select("i", F.posexplode(F.arrays_zip("high", "low")).alias("j", "p"))
            .groupBy("i", "j").agg(F.sum("p.high").alias("high"), F.sum("p.low").alias("low"))
            .collect())  # one a pair of dimensions
    out = np.zeros((d, d), dtype=object)
    for r in rows:
        out[r["i"], r["j"]] = (r["high"] << _HALF) + r["low"]
    return out


def fit_whitening(x: DataFrame, d: int) -> Fit:
    """Covariance (divisor n) of the vectors ``x`` of ``d`` whole numbers, and
    its eigenvectors. Extended precision holds the exact quotients."""
    n, sums = _sums(x, d)
    pivot = [s // n for s in sums]
    rest = [s - n * a for s, a in zip(sums, pivot)]
    products = _products(x, pivot)
    cov = np.zeros((d, d), np.longdouble)
    for i in range(d):
        for j in range(d):
            whole, part = divmod(n * products[i, j] - rest[i] * rest[j], n * n)
            cov[i, j] = np.longdouble(whole) + np.longdouble(part / (n * n))
    values, vectors = symmetric_eigen(cov)
    return Fit(n, sums, values, vectors, float(np.trace(cov)))


def project(x: DataFrame, fit: Fit, components: int) -> DataFrame:
    """``id``, ``deviation`` and ``w``: the whitened coordinates, null for a
    component without variance."""
    d, n = len(fit.sums), fit.n
    pivot = np.array([s // n for s in fit.sums], np.int64)
    rest = np.array([s - n * int(a) for s, a in zip(fit.sums, pivot)], np.int64)
    k = min(components, d)
    live = np.array([e > NO_VARIANCE * fit.values[0] for e in fit.values[:k]])
    scaled = np.where(live, fit.vectors[:, :k] / np.sqrt(np.where(live, fit.values[:k], 1)),
                      np.nan).astype(np.float64)
    kind = x.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _matrix(batch.column(1), d) - pivot
            far = y * n - rest
            most = int(np.abs(far).max(initial=0))
            if d * most * most < 1 << 63:
                deviation = (far * far).sum(axis=1).tolist()
            else:
                found = [sum(int(v) ** 2 for v in row) for row in far]
                deviation = [v if v < 1 << 63 else None for v in found]
            w = (y - rest / n) @ scaled
            flat = pa.array(w.ravel(), pa.float64(), mask=np.isnan(w.ravel()))
            yield pa.record_batch([
                batch.column(0), pa.array(deviation, pa.int64()),
                pa.ListArray.from_arrays(np.arange(0, w.size + 1, k, dtype=np.int32), flat)],
                ["id", "deviation", "w"])

    return map_batches(x.select("id", "x"), run, f"id {kind}, deviation long, w array<double>")


def _identity_error(whitened: DataFrame, fit: Fit, k: int) -> float:
    """Largest absolute entry of the whitened coordinates' covariance (divisor
    n, centred first) minus the identity, over components with variance."""
    live = [i for i in range(k) if fit.values[i] > NO_VARIANCE * fit.values[0]]
    if not live:
        return 0.0
    means = whitened.agg(*(F.avg(F.get("w", F.lit(i))).alias(f"m{i}") for i in live)).first()

    def off(i: int) -> Column:
        return F.get("w", F.lit(i)) - F.lit(means[f"m{i}"])

    pairs = [(i, j) for i in live for j in live if i <= j]
    found = whitened.agg(*(F.avg(off(i) * off(j)).alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
           components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """Whitened coordinates of every vector of ``df`` (an id and an array of
    numbers; other columns are ignored).

    Returns a row for each vector and each of the first ``components``
    components: the id under its name, component (from 1, by falling
    eigenvalue), n (vectors of the fit, which is all that remain), deviation
    (sum over the dimensions of (n * x - S)^2, exact; null if it does not fit a
    long), whitened, explained (share of the variance) and identity_error (one
    value for all rows).

    A vector that is null or holds a null or non-finite entry gives no row.
    The dimension is that of most vectors (of the larger dimension on a tie);
    vectors of another length are in another space and give no row. No vectors,
    or empty ones, give no rows. Repeated rows and ids count as often as they
    occur. A component without variance has whitened null, explained 0, and no
    part in identity_error. Components of equal variance are any orthonormal
    basis of their space, one for all rows. An entry of 2^15 or more in
    magnitude raises a ValueError.
    """
    spark = df.sparkSession
    x = whole_vectors(df, id_col, vec_col, scale, offset)
    most = F.max(F.array_max(F.transform("x", lambda v: F.abs(v - F.lit(offset)))))
    sizes = (x.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"), most.alias("most"))
             .orderBy(F.desc("n"), F.desc("d")).limit(1).collect())
    out_type = f"`{id_col}` {x.schema['id'].dataType.simpleString()}, component int, n long, " \
               "deviation long, whitened double, explained double, identity_error double"
    if not sizes or not sizes[0]["d"]:
        return spark.createDataFrame([], out_type)
    d = sizes[0]["d"]
    if sizes[0]["most"] >= MOST * scale:
        raise ValueError(f"an entry of the vectors has a magnitude of {MOST} or more")
    x = x.where(F.size("x") == F.lit(d))
    fit = fit_whitening(x, d)
    k = min(components, d)
    whitened = store(project(x, fit, k), "whitened")
    error = _identity_error(whitened, fit, k)
    share = F.array(*(F.lit(float(e) / fit.trace if e > NO_VARIANCE * fit.values[0] else 0.0)
                      for e in fit.values[:k]))
    return whitened.select("id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        F.col("id").alias(id_col), (F.col("at") + 1).alias("component"),
        F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened",
        share[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"))

"""Whitening embeddings by polarisation.

Entries become whole numbers x. The covariance is fitted on every distinct x vector once, without
products of two dimensions: tasks add up the exact squares of the centred value of every
dimension and of the sum of every two dimensions, and

    cov(i, j) = (var(i + j) - var(i) - var(j)) / 2.

Values are centred by the whole number m next to the mean before they are squared, so the
squares are exact; what the mean is off m is put right on the driver in whole numbers of
any size. Squares are added up as limbs of 32 bits, which cannot overflow. So the
covariance matrix is the exact one, rounded once; ``eigh`` of it gives the components.

A driver or task holds dimensions ** 2 numbers, never rows beyond a batch.

Defined cases: rows whose vector is null, or holds a null or non-finite entry or one that 64 times is
beyond 2 ** 52, are dropped, and so are vectors of another length than the most frequent one (ties: the longer);
repeated rows are returned each and count once in the fit; a null id stays null; other
columns are not read; an empty table, or empty vectors, give no rows. A component without variance has a null
``whitened`` (and ``explained`` is null if none has any); a ``deviation`` beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import small_batches, staged
from martforge.llm.vectors import of_common_length, scaled, usable

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
SMALL = 1 << 20  # values whose squares a batch can add up in 64 bits
LIMBS = 4  # of 32 bits
LEAST = 1e-13  # of the trace: an eigenvalue below is no variance


def quantised(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and x (array of long) of the rows that take part."""
    v = F.col(column)
    return vectors.filter(usable(v, SCALE)).select("vec_id", scaled(v, SCALE, OFFSET).alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (dimension -1) and the sum of each dimension."""
    n, total = 0, None
    for batch in batches:
        if batch.num_rows:
            sums = _matrix(batch).sum(axis=0)
            n, total = n + batch.num_rows, sums if total is None else total + sums
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, len(total), dtype=np.int32)), pa.array(np.concatenate([[n], total]))], ["i", "s"])


def pair_squares(y: np.ndarray) -> np.ndarray:
    """Limbs (LIMBS, pairs) of the sums over rows of y_i ** 2 (i = j) and (y_i + y_j) ** 2 (i < j)."""
    large = np.abs(y).max(axis=1, initial=0) >= SMALL
    limbs = np.zeros((LIMBS, y.shape[1] * (y.shape[1] + 1) // 2), np.int64)
    for part in (y[~large], y[large].astype(object)):
        at = 0
        for i in range(part.shape[1] if len(part) else 0):
            both = part[:, i:] + part[:, i, None]
            both[:, 0] = part[:, i]
            sums = (both * both).sum(axis=0)
            for k in range(LIMBS):
                limbs[k, at:at + len(sums)] += ((sums >> 32 * k) & 0xFFFFFFFF).astype(np.int64) if (
                    sums.dtype == object or k < 2) else 0
            at += len(sums)
    return limbs


def _squares(centre: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                limbs = pair_squares(_matrix(batch) - centre)
                total = limbs if total is None else total + limbs
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(total.shape[1], dtype=np.int32)), *map(pa.array, total)],
                ["pair", *(f"l{k}" for k in range(LIMBS))])
    return run


@dataclass(frozen=True)
class Whitening:
    """n vectors of the fit; centre + rest / n is their mean; covariance; components (dimensions, k),
    their eigenvalues, and whether each has variance."""

    n: int
    centre: np.ndarray
    rest: np.ndarray
    covariance: np.ndarray
    components: np.ndarray
    values: np.ndarray

    @property
    def trace(self) -> float:
        return float(np.trace(self.covariance))

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened x vectors; nan where a component has no variance."""
        flat = self.values <= LEAST * self.trace
        scale = np.where(flat, np.nan, 1 / np.sqrt(np.where(flat, 1, self.values)))
        return ((x - self.centre) - self.rest / self.n) @ self.components * scale

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S) ** 2, exactly; None beyond a long."""
        y = x - self.centre
        rough = ((self.n * y.astype(np.float64) - self.rest) ** 2).sum(axis=1)
        fits = rough < 2.0 ** 62
        found = np.empty(len(x), object)
        near = self.n * np.where(fits[:, None], y, 0) - np.where(fits[:, None], self.rest, 0)
        found[fits] = (near * near).sum(axis=1)[fits]
        for r in np.flatnonzero(~fits):
            exact = sum((self.n * int(v) - int(s)) ** 2 for v, s in zip(y[r], self.rest, strict=True))
            found[r] = exact if exact < 1 << 63 else None
        return found.tolist()


def solve(n: int, sums: list[int], squares: list[int], components: int = COMPONENTS) -> Whitening:
    """From the sums of whole numbers to the components. ``squares``: by pair_squares, of values less
    the whole number next to their mean."""
    d = len(sums)
    centre = [nearest(s, n) for s in sums]
    rest = [s - n * m for s, m in zip(sums, centre, strict=True)]
    of = dict(zip(((i, j) for i in range(d) for j in range(i, d)), squares, strict=True))
    var = {(i, j): n * q - (rest[i] + (rest[j] if i != j else 0)) ** 2 for (i, j), q in of.items()}  # times n ** 2
    cov = np.empty((d, d))
    for i, j in of:
        twice = 2 * var[i, i] if i == j else var[i, j] - var[i, i] - var[j, j]
        cov[i, j] = cov[j, i] = twice / (2 * n * n)  # whole numbers: rounded once
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:components]
    vectors = vectors[:, order]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    return Whitening(n, np.array(centre, np.int64), np.array(rest, np.int64), cov, vectors * sign, values[order])


def nearest(s: int, n: int) -> int:
    return (2 * s + n) // (2 * n)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of distinct vectors (column x); None without any."""
    sums = {r["i"]: r["s"] for r in rows.select("x").mapInArrow(_sums, "i int, s long").groupBy("i").agg(F.sum("s").alias("s")).collect()}
    n = sums.pop(-1, 0)
    if not n or not sums:
        return None
    sums = [sums[i] for i in range(len(sums))]
    names = [f"l{k}" for k in range(LIMBS)]
    centre = np.array([nearest(s, n) for s in sums], np.int64)
    found = (rows.select("x").mapInArrow(_squares(centre), "pair int, " + ", ".join(f"{c} long" for c in names))
             .groupBy("pair").agg(*[F.sum(c).alias(c) for c in names]).orderBy("pair").collect())
    return solve(n, sums, [sum(r[c] << 32 * k for k, c in enumerate(names)) for r in found], components)


def _products(whitening: Whitening):
    """Sums of the whitened values, and of their products with each other, by place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            z = whitening.project(_matrix(batch))
            total = total + np.vstack([z.sum(axis=0), z.T @ z])
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], ["at", "s"])
    return run


def identity_error(rows: DataFrame, whitening: Whitening) -> float:
    """Largest absolute entry of the whitened fit rows' covariance, over the components with variance, less the identity."""
    k = len(whitening.values)
    sums = np.zeros((k + 1) * k)
    for r in rows.select("x").mapInArrow(_products(whitening), "at int, s double").groupBy("at").agg(F.sum("s").alias("s")).collect():
        sums[r["at"]] = r["s"]
    mean, square = np.split(sums.reshape(k + 1, k) / whitening.n, [1])
    off = np.abs(square - mean.T @ mean - np.eye(k))
    return float(off[np.isfinite(off)].max(initial=0.0))


def _whitened(whitening: Whitening, error: float):
    k, trace = len(whitening.values), whitening.trace
    explained = pa.array((whitening.values / trace).tolist() if trace else [None] * k, pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, m = _matrix(batch), batch.num_rows
            row, part = np.repeat(np.arange(m), k), np.tile(np.arange(k), m)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(row)), pa.array((part + 1).astype(np.int32)),
                pa.array(np.full(m * k, whitening.n)), pa.array(whitening.deviation(x), pa.int64()).take(pa.array(row)),
                pa.array(whitening.project(x).ravel(), from_pandas=True), explained.take(pa.array(part)),
                pa.array(np.full(m * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whiten(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error: a row for each remaining
    row and component."""
    spark = vectors.sparkSession
    small_batches(spark)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    rows, _ = of_common_length(staged(spark, quantised(vectors, column), "whitening-rows"), "x")
    distinct = staged(spark, rows.select("x").distinct(), "whitening-fit")
    whitening = fit(distinct, components)
    if whitening is None:
        return spark.createDataFrame([], schema)
    return rows.mapInArrow(_whitened(whitening, identity_error(distinct, whitening)), schema)

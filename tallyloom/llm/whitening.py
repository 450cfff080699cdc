"""Whitening of embeddings: FEAST eigenpairs of the exact covariance.

Every entry c becomes the integer x = floor(64 c) + 1000000. The fit list, each distinct
x vector once, is found by a grouping with map-side combining and stored; its sums are
exact integers, and its covariance is summed from centred vectors, a small matrix a task
and then by matrix rows. Only the matrix, dimension squared numbers, comes to the driver,
where ``feast`` finds the eigenpairs. All rows are then projected in place, without a
shuffle. How far the whitened fit list is from unit covariance is measured by one more
pass over it, not assumed.

Rows drop out where the vector is null or empty, or has a null or non-finite entry or one
of 2^57 and more, whose x is no long. Vectors of different lengths are different
tables: each length has its fit, with as many fits as lengths. Components of eigenvalue zero
(within rounding) have no whitened value and are left out, so a fit list of one vector, or of
constant ones, gives no rows. Repeated rows and ids are kept, null ids too. An empty table
gives no rows. Only the id and the vector column are read, so other columns cannot clash.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import feast
from .frames import shuffle_width, stored

SCALE, SHIFT = 64.0, 1_000_000
COMPONENTS = 16
LIMIT = float(2**57 - 2**15)  # an entry of this size has no x that is a long
SLICE = 4096  # vectors handled at once


def integer_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, x) of the rows that take part; x as longs."""
    v = F.col(vector)
    whole = F.forall(v, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < F.lit(LIMIT)))
    # a comparison with a NaN is true for greater only, so NaN and infinities fail here as well
    rows = df.select(F.col(key).alias("id"), v.alias("v"), whole.alias("ok"), F.size(v).alias("d"))
    ok = F.col("ok") & (F.col("d") > 0)
    x = F.when(ok, F.transform("v", lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT))
    return rows.select("id", "d", x.alias("x")).filter("x is not null")


def _matrix(col, d: int):
    """Slices of an array column as integer matrices."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    for i in range(0, len(flat), SLICE):
        yield i, flat[i:i + SLICE]


def _sums(d: int):
    """One row a task: the number of vectors and exact sums, in two halves so that none overflows."""

    def run(batches):
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in batches:
            for _, x in _matrix(batch.column(0), d):
                n += len(x)
                high += (x >> 31).sum(axis=0)
                low += (x & (2**31 - 1)).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([high.tolist()]), pa.array([low.tolist()])],
                                             names=["n", "high", "low"])

    return run


Mean = tuple[np.ndarray, np.ndarray]  # whole part, rest below one


def _centred(x: np.ndarray, mean: Mean) -> np.ndarray:
    far = int(np.abs(x).max(initial=0)) + int(np.abs(mean[0]).max()) >= 2**63
    return (x.astype(float) if far else x) - mean[0] - mean[1]


def _products(d: int, mean: Mean, to: np.ndarray | None):
    """Rows of the sum of outer products of centred (and projected) vectors, one matrix a task."""
    size = d if to is None else to.shape[1]

    def run(batches):
        total = np.zeros((size, size))
        for batch in batches:
            for _, x in _matrix(batch.column(0), d):
                z = _centred(x, mean) if to is None else _centred(x, mean) @ to
                total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(list(total))], names=["i", "row"])

    return run


def _added(size: int):
    def run(batches):
        rows: dict = {}
        for batch in batches:
            for i, row in zip(batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False), strict=True):
                rows[i] = row + rows[i] if i in rows else row
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(rows), pa.int64()), pa.array(list(rows.values()), pa.list_(pa.float64()))], names=["i", "row"])

    return run


def covariance(fit: DataFrame, n: int, d: int, mean: Mean, to: np.ndarray | None = None) -> np.ndarray:
    """Covariance, divisor n, of the fit list's x vectors, or of their projections."""
    size, kind = (d if to is None else to.shape[1]), "i long, row array<double>"
    parts = fit.select("x").mapInArrow(_products(d, mean, to), kind)
    rows = parts.repartition(min(size, shuffle_width(fit)), "i").mapInArrow(_added(size), kind).collect()
    out = np.array([row for _, row in sorted((r.i, r.row) for r in rows)]).reshape(size, size)
    return (out + out.T) / (2 * n)


def exact_deviation(x: np.ndarray, n: int, sums: list[int]) -> list[Decimal | None]:
    """Sum over dimensions of (n x - S)^2, in integers of any size; null beyond 38 digits."""
    reach = n * max(int(np.abs(x).max(initial=0)), 1) + max(map(abs, sums))
    if reach < 2**62:
        off = n * x - np.array(sums, np.int64)
        if int(np.abs(off).max(initial=0)) ** 2 * x.shape[1] < 2**63:
            return [Decimal(int(v)) for v in (off * off).sum(axis=1)]
    off = n * x.astype(object) - np.array(sums, object)
    return [Decimal(v) if v < 10**38 else None for v in (off * off).sum(axis=1)]


_FIELDS = (("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.decimal128(38, 0)), ("whitened", pa.float64()),
           ("explained", pa.float64()), ("identity_error", pa.float64()))


def _project(d: int, n: int, sums: list[int], mean: Mean, to: np.ndarray, explained: np.ndarray, error: float):
    k = to.shape[1]

    def run(batches):
        for batch in batches:
            for at, x in _matrix(batch.column(1), d):
                white = _centred(x, mean) @ to
                ids = batch.column(0).slice(at, len(x)).take(pa.array(np.repeat(np.arange(len(x)), k)))
                deviation = pa.array(exact_deviation(x, n, sums), pa.decimal128(38, 0))
                rows = len(x) * k
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()), pa.array(np.full(rows, n)),
                     deviation.take(pa.array(np.repeat(np.arange(len(x)), k))), pa.array(white.ravel()),
                     pa.array(np.tile(explained, len(x))), pa.array(np.full(rows, error))],
                    names=["id", *(f for f, _ in _FIELDS)])

    return run


def fit(vectors: DataFrame, d: int, components: int = COMPONENTS) -> dict | None:
    """The fit of the stored distinct vectors (x) of one length: n, sums, mean, covariance,
    values, directions, and the projection (x - mean) @ to onto whitened components; None where nothing varies."""
    parts = vectors.select("x").mapInArrow(_sums(d), "n long, high array<long>, low array<long>")
    wide = parts.select(F.col("n").cast("decimal(38,0)").alias("n"), F.posexplode(F.arrays_zip("high", "low")).alias("j", "s"))
    total = wide.groupBy("j").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(a)
                                    for c, a in (("n", "n"), ("s.high", "high"), ("s.low", "low"))]).orderBy("j").collect()
    n, sums = int(total[0].n), [(int(r.high) << 31) + int(r.low) for r in total]
    mean = np.array([s // n for s in sums], np.int64), np.array([s % n / n for s in sums])
    v = covariance(vectors, n, d, mean)
    if not v.any():
        return None
    values, directions = feast.largest(v, min(components, d), 8 * d * np.finfo(float).eps * np.abs(v).sum(axis=1).max())
    if not len(values):
        return None
    to = directions / np.sqrt(values)
    error = np.abs(covariance(vectors, n, d, mean, to) - np.eye(len(values))).max()
    return {"n": n, "sums": sums, "mean": mean, "covariance": v, "values": values, "directions": directions, "to": to,
            "explained": values / np.trace(v), "identity_error": float(error)}


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each vector and component: key, component, n, deviation (decimal), whitened, explained, identity_error."""
    rows = integer_vectors(df, key, vector)
    distinct = stored(rows.select("d", "x").distinct(), "vectors")
    lengths = sorted(r.d for r in distinct.select("d").distinct().collect())
    kind = rows.schema["id"].dataType.simpleString()
    ddl = f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    out = rows.sparkSession.createDataFrame([], ddl)
    for d in lengths:
        f = fit(distinct.filter(F.col("d") == d), d, components)
        if f:
            task = _project(d, f["n"], f["sums"], f["mean"], f["to"], f["explained"], f["identity_error"])
            out = out.unionByName(rows.filter(F.col("d") == d).select("id", "x").mapInArrow(task, ddl))
    return out.withColumnRenamed("id", key)

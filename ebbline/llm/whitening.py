"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows X (each distinct vector once) stay where they are, packed in blocks. The driver holds right vectors v and,
for each left vector u = X c, its coefficients c: u itself is never stored, a task builds its part from its rows. A step is one
job with both products: u = X v without its parts along all earlier u, then Xᵀ u and the inner products of u with all earlier
u, with which what rounding left is taken off; the right side is orthogonalised against all earlier v, twice. The singular values of the small bidiagonal matrix give the deviations,
its right singular vectors the components. Where a product vanishes, a new direction orthogonal to all v goes on.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm.common import docs_column, stage

OFFSET = 1_000_000
LIMIT = 1 << 48
BLOCK_BYTES = 4 << 20
SEED = 20_240_501
SUMS = "pos int, value double"


def cells_of(vectors: DataFrame) -> DataFrame:
    """``vec_id, x``: ``floor(64 * c) + 1000000`` as longs for each vector without null or non-finite entries.

    Entries whose ``floor(64 * c)`` is beyond 2^48 on either side count as 2^48.
    """
    raw = vectors.select(docs_column("vec_id").alias("vec_id"), docs_column("embedding").cast("array<double>").alias("raw"))
    fine = F.forall("raw", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    held = lambda v: F.greatest(F.least(v * 64, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))
    return raw.where((F.size("raw") > 0) & fine).select(
        "vec_id", F.transform("raw", lambda v: F.floor(held(v)) + F.lit(OFFSET)).alias("x"))


def packed(spark: SparkSession, distinct: DataFrame, dim: int) -> DataFrame:
    """``n, cells``: blocks of a bounded number of bytes, row by row, as 64-bit integers."""
    per = max(1, BLOCK_BYTES // (8 * dim))

    def pack(batches):
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            cut = [np.ascontiguousarray(flat[i:i + per], "<i8") for i in range(0, len(flat), per)]
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(c) for c in cut], pa.int32()), "cells": pa.array([c.tobytes() for c in cut], pa.binary())})

    return stage(spark, distinct.select("x").mapInArrow(pack, "n int, cells binary"), "blocks")


@dataclass
class Rows:
    """The fit list: blocks, number of rows, exact sums per dimension, and products with the centred rows."""

    blocks: DataFrame
    dim: int
    n: int
    sums: list[int]

    def summed(self, block_sums) -> np.ndarray:
        """Sum over all blocks of the vector ``block_sums(centred rows)``; one vector for each task is shuffled."""
        dim, n, sums = self.dim, self.n, self.sums

        def add(batches):
            total = None
            for batch in batches:
                for cells in batch.cells:
                    part = np.asarray(block_sums(centred(np.frombuffer(cells, "<i8").reshape(-1, dim), n, sums)), np.float64).ravel()
                    total = part if total is None else total + part
            if total is not None:
                yield pd.DataFrame({"pos": np.arange(len(total), dtype=np.int32), "value": total})

        rows = self.blocks.mapInPandas(add, SUMS).groupBy("pos").agg(F.sum("value").alias("value")).collect()
        out = np.zeros(len(rows))
        for r in rows:
            out[r.pos] = r.value
        return out


def times(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S`` exactly: 64-bit integers where they hold it, else Python integers."""
    if n * (int(np.abs(x).max(initial=0))) < 1 << 61:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return times(x, n, sums).astype(np.float64) / n


def exact_squares(d: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, exact; None where it does not fit a long."""
    if d.dtype == np.int64 and int(np.abs(d).max(initial=0)) ** 2 * d.shape[1] < 1 << 63:
        return (d * d).sum(1).tolist()
    found = [sum(int(v) ** 2 for v in row) for row in d]
    return [v if v < 1 << 63 else None for v in found]


@dataclass(frozen=True)
class Whitening:
    """Components as columns, falling eigenvalues, and the trace of the covariance."""

    components: np.ndarray
    values: np.ndarray
    trace: float


def orthogonal(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for b in basis:
            v = v - (b @ v) * b
    return v


def bidiagonalise(rows: Rows, k: int, tolerance: float = 1e-13) -> Whitening:
    """Right singular vectors and values of the centred rows; stops when the first ``k`` are settled or all dimensions are used.

    A direction with no spread gives no component.
    """
    draw = np.random.default_rng(SEED)
    scale2 = float(rows.summed(lambda x: [(x * x).sum()])[0]) if rows.n else 0.0
    if not scale2 > 0:
        return Whitening(np.zeros((rows.dim, 0)), np.zeros(0), 0.0)
    tiny = np.sqrt(scale2) * 1e-14
    vs: list[np.ndarray] = []  # right vectors
    cs: list[np.ndarray] = []  # coefficients of the left vectors
    zs: list[np.ndarray] = []  # X^T u of each left vector
    alphas, betas = [], []
    v = draw.normal(size=rows.dim)
    v /= np.linalg.norm(v)
    while True:
        vs.append(v)
        known, back = (np.array(m).reshape(-1, rows.dim).T for m in (cs, zs))
        c = v - known @ (back.T @ v)  # u' X v = (X' u) v: X c is X v without its parts along the earlier u

        def products(x, c=c, known=known):
            u = x @ c
            return np.concatenate([x.T @ u, [u @ u], (x @ known).T @ u])

        found = rows.summed(products)
        z, square, inner = found[:rows.dim], found[rows.dim], found[rows.dim + 1:]
        c, z, alpha = c - known @ inner, z - back @ inner, float(np.sqrt(max(square - inner @ inner, 0)))  # what rounding left along them
        if alpha > tiny:
            c, z = c / alpha, z / alpha
            w = orthogonal(z, vs)
        else:
            alpha, c, z, w = 0.0, np.zeros(rows.dim), np.zeros(rows.dim), np.zeros(rows.dim)
        cs.append(c)
        zs.append(z)
        alphas.append(alpha)
        beta = float(np.linalg.norm(w))
        if len(vs) == rows.dim:
            break
        if beta <= tiny:
            beta, w = 0.0, orthogonal(draw.normal(size=rows.dim), vs)
        if beta and len(vs) >= 2 * k and len(vs) % 8 == 0 and all(betas):
            left, sigma, _ = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
            if np.all(beta * np.abs(left[-1, :k]) <= tolerance * sigma[0]):
                break
        v = w / np.linalg.norm(w)
        v = orthogonal(v, vs)
        v /= np.linalg.norm(v)
        betas.append(beta)
    _, sigma, right = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
    keep = [i for i in range(min(k, len(sigma))) if sigma[i] > 1e-7 * sigma[0]]
    return Whitening(np.array(vs).T @ right[keep].T, sigma[keep] ** 2 / rows.n, scale2 / rows.n)


def identity_error(rows: Rows, found: Whitening) -> float:
    """Largest absolute entry of the whitened covariance minus the identity, over the fit list, means taken off first."""
    scaled, k = found.components / np.sqrt(found.values), len(found.values)
    mean = rows.summed(lambda x: (x @ scaled).sum(0)) / rows.n
    second = rows.summed(lambda x: (y := x @ scaled - mean).T @ y).reshape(k, k) / rows.n
    return float(np.abs(second - np.eye(k)).max())


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(spark: SparkSession, vectors: DataFrame, k: int = 16) -> DataFrame:
    """Rows of ``RESULT``: each usable row of ``vectors`` on up to ``k`` components.

    Fitted on each distinct vector once; repeated rows are whitened each. Rows whose vector is null, empty or holds a null or
    non-finite entry give none; null ids stay. Vectors of different lengths are fitted apart. Directions without spread
    (below 1e-7 of the largest deviation) are no components, so a table of equal vectors, one vector or none gives no rows. Very
    large entries are bounded (see ``cells_of``); ``deviation`` is null where it does not fit a long. Long vectors: the driver
    holds two square matrices of the length. Extra columns are ignored.
    """
    cells = stage(spark, cells_of(vectors), "cells")
    lengths = [r[0] for r in cells.select(F.size("x").alias("d")).distinct().orderBy("d").collect()]
    out = None
    for dim in lengths:
        own = cells.where(F.size("x") == dim)
        blocks = packed(spark, own.select("x").distinct(), dim)

        def add(batches, dim=dim):
            for batch in batches:
                for n, part in zip(batch.n, batch.cells):
                    yield pd.DataFrame({"pos": np.arange(-1, dim, dtype=np.int32), "value": [int(n), *np.frombuffer(part, "<i8").reshape(-1, dim).sum(0).tolist()]})

        sums = {r.pos: int(r.value) for r in blocks.mapInPandas(add, "pos int, value long").groupBy("pos").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()}
        rows = Rows(blocks, dim, sums[-1], [sums[i] for i in range(dim)])
        fit = bidiagonalise(rows, k)
        if not len(fit.values):
            continue
        part = _projected(own, rows, fit, identity_error(rows, fit))
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], RESULT) if out is None else out


def _projected(own: DataFrame, rows: Rows, fit: Whitening, error: float) -> DataFrame:
    dim, n, sums, k = rows.dim, rows.n, rows.sums, len(fit.values)
    scaled, explained = fit.components / np.sqrt(fit.values), fit.values / fit.trace

    def project(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            d = times(x, n, sums)
            y = (d.astype(np.float64) / n) @ scaled
            at = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column(0).take(pa.array(at)).cast(pa.int64()), "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                "n": pa.array(np.full(len(at), n, np.int64)), "deviation": pa.array(exact_squares(d), pa.int64()).take(pa.array(at)),
                "whitened": pa.array(y.ravel()), "explained": pa.array(np.tile(explained, len(x))), "identity_error": pa.array(np.full(len(at), error))})

    return own.select("vec_id", "x").mapInArrow(project, RESULT)

"""Exact top-k search by inner product: columnar branch-and-bound in vertical layout.

Vectors are stored in blocks, dimension by dimension. Scores grow one block of dimensions at a time;
after each, a candidate stays only if its partial score plus the most its remaining mass can add
reaches what k candidates are sure to have. The survivors are compacted before the next block.
Vectors with components so large that a score may not fit a long are kept apart inside a block and
scored with whole numbers of any length.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbline.llm.common import numbered, stage

DIMENSIONS = 16
BLOCK_ROWS = 32_768
BLOCK_BYTES = 8 << 20
QUERY_ROWS = 4_096
QUERY_BYTES = 32 << 20
# Doubles reach 2 ** 1024, so no score of such vectors passes this.
WIDEST = 1 << 2200
LONGS = (-(1 << 63), (1 << 63) - 1)
PACKED = "dim int, n int, ids binary, cells binary"


def _pack(ids: list, rows: list, dim: int) -> tuple:
    return dim, len(ids), np.array(ids, "<i8").tobytes(), np.ascontiguousarray(np.array(rows, "<f8").reshape(len(ids), dim).T).tobytes()


def blocks_of(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """``block, dim, n, ids, cells``: blocks of vectors of one length, ``cells`` dimension by dimension as double.

    Vectors that are null or hold a null or non-finite component take no part, nor do rows without id. Vectors
    without components are vectors of length 0. A block is bounded in rows and in bytes.
    """
    x = F.col("x")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x")).where(
        F.col("vec_id").isNotNull() & x.isNotNull() & fine)
    n = usable.count()
    per_block = min(BLOCK_ROWS, max(512, math.ceil(n / (2 * spark.sparkContext.defaultParallelism))))

    def pack(batches):
        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for vec_id, values in zip(batch.vec_id, batch.x):
                ids, rows = held.setdefault(len(values), ([], []))
                ids.append(vec_id)
                rows.append(values)
                if len(ids) >= min(per_block, max(1, BLOCK_BYTES // (8 * max(1, len(values))))):
                    yield pd.DataFrame([_pack(ids, rows, len(values))], columns=["dim", "n", "ids", "cells"])
                    del held[len(values)]
        for dim, (ids, rows) in held.items():
            yield pd.DataFrame([_pack(ids, rows, dim)], columns=["dim", "n", "ids", "cells"])

    spread = usable.repartition(max(1, math.ceil(n / per_block)))
    return numbered(spark, spread.mapInPandas(pack, PACKED), "blocks", "block")


def unit_best(ids: np.ndarray, cells: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """``(query, id, score)`` of the ``k`` best candidates of each query in one block; ties to the smaller id.

    ``cells`` is (dimensions, candidates), ``queries`` (queries, dimensions), ``own`` the candidate to leave out or -1.
    No score may pass a long.
    """
    dim, n = cells.shape
    most = max(int(np.abs(cells).max(initial=0)), int(np.abs(queries).max(initial=0)))
    exact = np.float64 if most * most * dim < 1 << 52 else np.int64  # doubles hold every partial sum exactly
    cells, queries = cells.astype(exact), queries.astype(exact)
    cuts = list(range(0, max(dim, 1), DIMENSIONS)) + [dim]
    mass = lambda m: np.sqrt(np.maximum(np.cumsum((m.astype(np.float64) ** 2)[::-1], axis=0)[::-1], 0))
    rest_c = np.vstack([mass(cells), np.zeros(n)])
    rest_q = np.vstack([mass(queries.T), np.zeros(len(queries))])
    out = []
    for at in range(0, len(queries), 64):
        first = queries[at:at + 64, :cuts[1]] @ cells[:cuts[1]]
        for i, partial in enumerate(first, at):
            alive = np.arange(n)
            if own[i] >= 0:
                alive = np.delete(alive, own[i])
                partial = np.delete(partial, own[i])
            for b in range(1, len(cuts)):
                if b > 1:
                    partial = partial + queries[i, cuts[b - 1]:cuts[b]] @ cells[cuts[b - 1]:cuts[b], alive]
                if len(alive) > k:
                    left = rest_q[cuts[b], i] * rest_c[cuts[b], alive]
                    left = left * (1 + 1e-9) + (1e-3 + 1e-15 * np.abs(partial) if b < len(cuts) - 1 else 0)
                    sure = np.partition(partial - left, len(alive) - k)[len(alive) - k]
                    stay = partial + left >= sure
                    alive, partial = alive[stay], partial[stay]
            order = np.lexsort((ids[alive], -partial))[:k]
            out += [(i, int(ids[alive[j]]), int(partial[j])) for j in order]
    return out


def scaled(x: np.ndarray) -> np.ndarray:
    """``floor(256 * x)``; components beyond the doubles become infinite and so count as large."""
    with np.errstate(over="ignore"):
        return np.floor(256.0 * x)


# The same as whole numbers of any length; doubles of this size are whole already.
whole = np.frompyfunc(lambda v: int(v) * 256 if abs(v) > 1 << 60 else math.floor(256.0 * v), 1, 1)


def block_best(ids: np.ndarray, cells: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """``unit_best`` of vectors given as doubles; pairs that may pass a long are scored in whole numbers of any length."""
    c, q = scaled(cells), scaled(queries)
    bound = math.isqrt(((1 << 62) - 1) // max(1, len(cells)))
    wide, wide_query = np.abs(c).max(axis=0, initial=0) > bound, np.abs(q).max(axis=1, initial=0) > bound
    some, easy = np.flatnonzero(~wide), np.flatnonzero(~wide_query)
    place = np.full(len(wide) + 1, -1)  # the last one stands for "not in this block"
    place[some] = np.arange(len(some))
    out = [(int(easy[i]), v, s) for i, v, s in unit_best(ids[some], c[:, some].astype(np.int64), q[easy].astype(np.int64), place[own[easy]], k)]
    if not (wide.any() or wide_query.any()):
        return out
    large = np.flatnonzero(wide)
    large_cells = whole(cells[:, large])
    all_cells = whole(cells) if wide_query.any() else None
    for i in range(len(queries)):
        at, held = (np.arange(len(ids)), all_cells) if wide_query[i] else (large, large_cells)
        scores = whole(queries[i]) @ held if len(at) else []
        out += sorted(((i, int(ids[j]), int(s)) for j, s in zip(at, scores) if j != own[i]), key=lambda r: (-r[2], r[1]))[:k]
    return out


def top_k(spark: SparkSession, vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best rows for each row whose id is divisible by ``every``.

    A query is compared with every other row of its length, also with rows that repeat its id. Work is cut into
    units of one block of candidates and one block of queries. An empty table gives no rows; extra columns are ignored.
    Components may be any finite double: ranks are exact, and ``score`` is null where it does not fit a long.
    """
    blocks = blocks_of(spark, vectors)

    def take(batches):
        for batch in batches:
            for block, dim, n, ids, cells in zip(batch.block, batch.dim, batch.n, batch.ids, batch.cells):
                ids = np.frombuffer(ids, "<i8")
                at = np.flatnonzero(ids % every == 0)
                rows = np.frombuffer(cells, "<f8").reshape(dim, n)[:, at].T
                yield pd.DataFrame([(block, int(p), dim, int(ids[p]), row.tobytes()) for p, row in zip(at, rows)],
                                   columns=["own_block", "own", "dim", "query_id", "row"])

    taken = numbered(spark, blocks.mapInPandas(take, "own_block long, own int, dim int, query_id long, row binary"), "queries", "query")
    held = taken.agg(F.count("*").alias("n"), F.coalesce(F.sum(8 * F.col("dim").cast("long")), F.lit(0)).alias("size")).first()
    groups = max(1, math.ceil(held.n / QUERY_ROWS), math.ceil(held.size / QUERY_BYTES))
    grouped = taken.withColumn("q", F.pmod(F.xxhash64("query"), F.lit(groups)).cast("int"))
    targets = blocks.select(F.col("block").alias("target"), F.col("dim").alias("target_dim"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("target_q"))
    queries = grouped.join(targets, (F.col("dim") == F.col("target_dim")) & (F.col("q") == F.col("target_q"))).select(
        "target", "target_q", "own_block", "own", "query", "query_id", "row")
    candidates = blocks.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    found = {"query": "int64", "query_id": "int64", "vec_id": "int64", "score": "int64", "beyond": "object", "fits": "bool"}

    def unit(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame([], columns=list(found)).astype(found)
        block, dim, n = int(left.block[0]), int(left.dim[0]), int(left.n[0])
        ids, cells = np.frombuffer(left.ids[0], "<i8"), np.frombuffer(left.cells[0], "<f8").reshape(dim, n)
        rows = np.frombuffer(b"".join(right.row), "<f8").reshape(len(right), dim)
        own = np.where(right.own_block.to_numpy() == block, right.own.to_numpy(), -1)
        number, name = right["query"].to_numpy(), right.query_id.to_numpy()
        # What passes a long is ordered by text of one width; the limits themselves get it too, so that all compare alike.
        text = lambda v: f"{v + WIDEST:0551x}" if not LONGS[0] < v < LONGS[1] else None
        rows = [(number[i], name[i], v, min(max(s, LONGS[0]), LONGS[1]), text(s), LONGS[0] <= s <= LONGS[1]) for i, v, s in block_best(ids, cells, rows, own, k)]
        return pd.DataFrame(rows, columns=list(found)).astype(found)

    scored = candidates.groupBy("block", "q").cogroup(queries.groupBy("target", "target_q")).applyInPandas(
        unit, "query long, query_id long, vec_id long, score long, beyond string, fits boolean")
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("beyond").desc_nulls_last(), F.col("vec_id").asc())
    return stage(spark, scored, "units").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", F.when(F.col("fits"), F.col("score")).alias("score"))

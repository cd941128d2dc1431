"""Mixing sources to target weights by subset-sum budget fitting.

For each source the documents are counted by exact length. The budget of a source is whole passes over
all its documents plus a rest; the rest is met by taking a number of documents of each length: a
seeded share of each count first, then a bounded knapsack over the counts that are left for the last
words, which may end on either side of the budget: the nearer one is taken. Which documents of a length are taken follows from a seeded hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbline.llm.common import WHITE, hash_share, numbered, stage

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
KNAPSACK_WORDS = 4096
EXCHANGED_PARTS = 28
HASH_BUCKETS = 1024
DRAWS = 24


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(f"[^{WHITE}]+")), F.lit(0)).cast("long")


def source_targets(spark: SparkSession, sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """``source, source_size, target`` for ``sizes(source, size)``.

    Sources in order of code points, null last, take the weights in turn and share the sum of all sizes; a
    target above ``most`` times its source's size stops there and the excess is shared again by weight.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Running number without a window over all sources: number inside ranges, ranges added up.
    ranged = numbered(spark, totals.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last()), "sources", "place")
    part = F.shiftright("place", 33)
    counts = ranged.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # one row for each partition
    before = counts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    number = (F.col("before") + F.col("place") - F.shiftleft(F.col("part"), 33)).cast("long")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (number % len(weights) + 1).cast("int"))
    held = stage(spark, ranged.withColumn("part", part).join(before, "part").select("source", "source_size", weight.alias("weight")), "weights")
    cap = most * F.col("source_size")
    total = float(held.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    level = 0.0
    while True:  # each turn only raises the level, and stops when no further source reaches its cap
        sums = held.agg(F.coalesce(F.sum(F.when(level * F.col("weight") >= cap, cap)), F.lit(0)).alias("full"),
                        F.coalesce(F.sum(F.when(level * F.col("weight") < cap, F.col("weight"))), F.lit(0.0)).alias("open")).first()
        if not sums.open:
            break
        following = (total - float(sums.full)) / sums.open
        if following <= level * (1 + 1e-12):
            break
        level = following
    return held.select("source", "source_size", F.least(cap.cast("double"), level * F.col("weight")).alias("target"))


def fit_counts(lengths: np.ndarray, counts: np.ndarray, budget: float, seed: int) -> np.ndarray:
    """How many documents of each length to take so that their words come as near to ``budget``, from either side, as the search finds.

    A share of every count, rounded by a seeded draw; then whole counts in seeded order until at most
    ``KNAPSACK_WORDS`` are open; then a bounded knapsack over lengths and counts left, exact for what is open.
    Where the budget is not met (few documents), further draws are tried, counts are exchanged (``exchange``),
    and the nearest is taken; of two that are equally near the smaller one.
    """
    total, whole = int((lengths * counts).sum()), round(budget)
    take = np.zeros(len(lengths), np.int64)
    if whole <= 0 or total <= 0:
        return take
    if whole >= total:
        return counts.astype(np.int64)
    draw = np.random.Generator(np.random.PCG64(seed))
    best, words = take, 0
    for _ in range(DRAWS):
        order = draw.permutation(len(lengths))
        take = np.minimum(counts, np.floor(counts * (budget / total) + draw.random(len(lengths))).astype(np.int64))
        left = whole - int((lengths * take).sum())
        for i in order:
            size = int(lengths[i])
            if left < 0 and size:
                back = min(int(take[i]), -(left // size))
                take[i] -= back
                left += back * size
        for i in order:
            size = int(lengths[i])
            if left > KNAPSACK_WORDS and size:
                more = min(int(counts[i] - take[i]), left // size)
                take[i] += more
                left -= more * size
        for more in (knapsack(lengths, counts - take, left), overshoot(lengths, counts - take, left)):
            best, words = nearer(lengths, best, words, take + more, budget)
        if words == whole:
            return best
    return nearer(lengths, best, words, exchange(lengths, counts, best, budget, draw.permutation(len(lengths))), budget)[0]


def nearer(lengths: np.ndarray, best: np.ndarray, words: int, take: np.ndarray, budget: float) -> tuple[np.ndarray, int]:
    """``best`` with its words, or ``take`` with its own where these are nearer to the budget, or as near and fewer."""
    found = int((lengths * take).sum())
    return (take, found) if (abs(found - budget), found) < (abs(words - budget), words) else (best, words)


def overshoot(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Numbers of each length whose sum is the smallest one above ``budget`` that can be nearer than taking nothing.

    Up to ``KNAPSACK_WORDS`` by the knapsack; above that every length left is longer than the budget, so that
    one document of the shortest length is the nearest. No numbers where no such sum is reachable.
    """
    if budget <= KNAPSACK_WORDS:
        return knapsack(lengths, counts, budget, over=True)
    take = np.zeros(len(lengths), np.int64)
    held = np.flatnonzero((lengths > 0) & (counts > 0))
    if len(held):
        take[held[np.argmin(lengths[held])]] = 1
    return take


def exchange(lengths: np.ndarray, counts: np.ndarray, take: np.ndarray, budget: float, order: np.ndarray) -> np.ndarray:
    """``take`` with the counts of some lengths chosen anew, so that the sum is the nearest one these can give.

    Counts are split in powers of two, and lengths are opened in the given order up to ``EXCHANGED_PARTS``
    parts: all lengths where documents are few. The sums of one half of the parts are looked up among the
    sorted sums of the other half, so documents may have any length.
    """
    parts: list[tuple[int, int]] = []
    fixed = take.copy()
    for i in order:
        powers, count = [], int(counts[i]) if lengths[i] > 0 else 0
        while count:
            powers.append(min(1 << len(powers), count))
            count -= powers[-1]
        if len(parts) + len(powers) > EXCHANGED_PARTS:
            continue
        if powers:
            fixed[i] = 0
        parts += [(int(i), n) for n in powers]
    goal = budget - int((lengths * fixed).sum())

    def sums(some: list[tuple[int, int]]) -> np.ndarray:
        every = np.zeros(1, np.int64)  # bit k of a place tells whether part k is in the sum
        for i, n in some:
            every = np.concatenate([every, every + n * int(lengths[i])])
        return every

    halves = parts[::2], parts[1::2]
    left, right = sums(halves[0]), sums(halves[1])
    by = np.argsort(right, kind="stable")
    at = np.searchsorted(right[by], goal - left, side="right")
    best = None
    for other in (np.maximum(at - 1, 0), np.minimum(at, len(by) - 1)):
        gap = np.abs(left + right[by[other]] - goal)
        near = int(np.argmin(gap))
        if best is None or gap[near] < best[0]:
            best = gap[near], near, int(by[other[near]])
    for some, place in zip(halves, best[1:]):
        for k, (i, n) in enumerate(some):
            fixed[i] += n * (place >> k & 1)
    return fixed


def knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int, over: bool = False) -> np.ndarray:
    """Bounded knapsack: numbers of each length whose sum is the largest one reachable within ``budget``.

    ``over`` gives the smallest sum above the budget and below twice the budget instead, or no numbers. Counts
    are split in powers of two; ``by[s]`` is the first part that reached the sum ``s``, so going back
    from any sum uses each part once at most.
    """
    take = np.zeros(len(lengths), np.int64)
    within = min(budget, KNAPSACK_WORDS)
    budget = 2 * within if over else within  # a sum above twice the budget is farther away than none
    by = np.full(budget + 1, -1, np.int64)
    reached = np.zeros(budget + 1, bool)
    reached[0] = True
    parts: list[tuple[int, int]] = []
    for i in np.flatnonzero((lengths > 0) & (lengths <= budget) & (counts > 0)):
        size, count, power = int(lengths[i]), min(int(counts[i]), budget // int(lengths[i])), 1
        while count:
            n = min(power, count)
            step = n * size
            fresh = np.zeros(budget + 1, bool)
            if step <= budget:
                fresh[step:] = reached[:budget + 1 - step]
                fresh &= ~reached
            by[fresh] = len(parts)
            reached |= fresh
            parts.append((i, n))
            count, power = count - n, power * 2
        if reached[within + 1 if over and within else budget]:
            break
    above = np.flatnonzero(reached[within + 1:])
    at = int(np.flatnonzero(reached)[-1]) if not over else within + 1 + int(above[0]) if len(above) else 0
    while at:
        i, n = parts[by[at]]
        take[i] += n
        at -= n * int(lengths[i])
    return take


def mix(spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: int = 11) -> DataFrame:
    """``doc_id, text_key, source, size, source_size, target, copies``: how often the mix takes each document.

    Null texts have size zero, a null source is a source, repeated rows are documents of their own, and other
    columns are ignored. The words taken from a source are the nearest to its target that the search finds, below
    or above it: a source of one document has it as often as the target, rounded. Documents without words are taken as often as the whole passes over their source.
    An empty table gives no rows. The same input gives the same mix.
    """
    rows = numbered(spark, docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "source", word_count().alias("size")), "sizes")
    targets = source_targets(spark, rows, weights, most)
    rest = F.when(F.col("passes") < most, F.col("target") - F.col("passes") * F.col("source_size")).otherwise(0.0)
    passes = F.when(F.col("source_size") > 0, F.least(F.lit(most), F.floor(F.col("target") / F.col("source_size")))).otherwise(0).cast("int")
    plan = stage(spark, targets.withColumn("passes", passes).withColumn("budget", rest.cast("double")), "targets")

    # Lengths of a source: bounded by the longest document, not by the number of documents.
    lengths = rows.groupBy("source", "size").agg(F.count("*").alias("n"))
    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    counted = lengths.alias("l").join(plan.alias("p"), same("l", "p")).select("l.source", "l.size", "l.n", "p.budget")

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size").reset_index(drop=True)
        mark = int(pd.util.hash_pandas_object(group["source"].iloc[:1].astype(str), index=False).iloc[0] % (1 << 32))
        take = fit_counts(group["size"].to_numpy(), group["n"].to_numpy(), float(group["budget"].iloc[0]), seed + mark)
        return pd.DataFrame({"source": group["source"], "size": group["size"], "n": group["n"], "take": take})

    chosen = stage(spark, counted.groupBy("source").applyInPandas(choose, "source string, size long, n long, take long"), "take")

    # The ``take`` documents of a length with the smallest hashes: whole buckets of the hash first, and
    # only the bucket on the border is ordered.
    draw = hash_share(F.struct("doc_id", "text_key"), seed)
    open_rows = rows.alias("r").join(chosen.where("take > 0 and take < n").alias("c"), same("r", "c") & (F.col("r.size") == F.col("c.size"))).select(
        "r.row_id", "r.source", "r.size", "take", F.col("r.doc_id").alias("doc_id"), F.col("r.text_key").alias("text_key")).withColumn("draw", draw).withColumn(
        "bucket", (F.col("draw") * HASH_BUCKETS).cast("int"))
    buckets = open_rows.groupBy("source", "size", "take", "bucket").agg(F.count("*").alias("m"))
    running = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    border = buckets.withColumn("upto", F.sum("m").over(running)).withColumn("short", F.col("take") - F.col("upto") + F.col("m")).where("short > 0")
    near = open_rows.alias("r").join(border.alias("b"), same("r", "b") & (F.col("r.size") == F.col("b.size")) & (F.col("r.bucket") == F.col("b.bucket"))).select(
        "r.row_id", "r.source", "r.size", "r.bucket", "draw", "short", "m")
    ranked = near.where("short < m").withColumn("rank", F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("draw", "row_id")))
    picked = near.where("short >= m").select("row_id").union(ranked.where("rank <= short").select("row_id")).withColumn("extra", F.lit(1))

    whole = chosen.where("take >= n and take > 0").select("source", "size", F.lit(1).alias("whole"))
    joined = rows.alias("r").join(plan.alias("p"), same("r", "p")).join(
        whole.alias("w"), same("r", "w") & (F.col("r.size") == F.col("w.size")), "left").select(
        "row_id", "doc_id", "text_key", "r.source", "r.size", "p.source_size", "p.target", "p.passes", "whole")
    extra = F.greatest(F.coalesce("whole", F.lit(0)), F.coalesce("extra", F.lit(0)))
    return joined.join(picked, "row_id", "left").select("doc_id", "text_key", "source", "size", "source_size", "target", (F.col("passes") + extra).alias("copies"))

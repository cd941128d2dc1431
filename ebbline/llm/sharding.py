"""Shards of near equal bytes: minimax contiguous partition of ordered atomic groups.

Equal texts are one atomic group. Groups above the average of what is left get a shard of their own; the others are
ordered by the 64-bit hash of their text and cut into contiguous runs. The smallest shard capacity for which a greedy
fill needs no more than the remaining shards is found by binary search, and the cuts keep to it.

The driver holds sums over ranges of the hash ("cells"), never groups: a few thousand ranges at first, and each range
in which the search has looked for a cut is divided until it holds a single group there. When no look-up ends inside a
range of several groups, every step was exact. A document finds its shard by comparing its hash with at most as many
cuts as there are shards, without a join.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm.common import docs_column, stage

ROW_BYTES = 16
FIRST_BITS = 12
CELLS_PER_ROUND = 1 << 17
SLOTS_PER_BUCKET = 65_536


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, h, size, text_crc32, copies``: distinct pairs of id and text with the number of their rows. Null texts count as empty."""
    text = F.coalesce(docs_column("text"), F.lit(""))
    rows = docs.select(docs_column("doc_id").alias("doc_id"), F.xxhash64(text).alias("h"), (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    return rows.groupBy("doc_id", "h", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))


@dataclass
class Cell:
    """Groups whose hash, as an unsigned number, begins with ``prefix`` of ``bits`` bits: the bytes, the least hash, and whether it is one group."""

    prefix: int
    bits: int
    bytes: int
    first: int
    single: bool

    @property
    def start(self) -> int:
        return self.prefix << (64 - self.bits)


class Histogram:
    """Bytes of the groups in hash order, known by cells."""

    def __init__(self, groups: DataFrame):
        self.groups = groups.withColumn("u", F.col("h").bitwiseXOR(F.lit(-(1 << 63))))  # unsigned order of u is the order of h
        self.cells = [self._cell(r, FIRST_BITS) for r in self._sums(self.groups.withColumn("bits", F.lit(FIRST_BITS)))]
        self._index()

    @staticmethod
    def _sums(tagged: DataFrame) -> list:
        prefix = F.expr("shiftrightunsigned(u, 64 - bits)")
        return tagged.groupBy("bits", prefix.alias("prefix")).agg(
            F.sum("bytes").alias("bytes"), F.min("h").alias("first"), F.min("h").eqNullSafe(F.max("h")).alias("single")).collect()

    @staticmethod
    def _cell(row, bits: int) -> Cell:
        return Cell(row.prefix % (1 << bits), bits, row.bytes, row.first, row.single)

    def _index(self) -> None:
        self.cells.sort(key=lambda c: c.start)
        self.ends = list(accumulate(c.bytes for c in self.cells))
        self.touched: set[int] = set()

    @property
    def total(self) -> int:
        return self.ends[-1] if self.ends else 0

    def _start(self, i: int) -> int:
        return self.ends[i - 1] if i else 0

    def _look(self, i: int, value: int) -> None:
        """Note that a cut was looked for inside cell ``i``."""
        if i < len(self.cells) and not self.cells[i].single and self._start(i) < value < self.ends[i]:
            self.touched.add(i)

    def floor(self, value: int) -> int:
        """The greatest sum of a run of leading groups that is no more than ``value``; of leading cells where the groups are not known yet."""
        i = bisect_right(self.ends, value)
        self._look(i, value)
        return self._start(i)

    def ceil(self, value: int) -> int:
        """The least such sum that is no less than ``value``."""
        i = bisect_left(self.ends, value)
        self._look(i, value)
        return self.ends[i] if value > 0 and self.ends else 0

    def first_hash_after(self, cut: int) -> int | None:
        """Hash of the first group behind ``cut``; None behind the last."""
        i = bisect_right(self.ends, cut)
        return self.cells[i].first if i < len(self.cells) else None

    def refine(self) -> None:
        """Divide the touched cells, with one pass over the groups they hold."""
        parts = sorted(self.touched)[:CELLS_PER_ROUND // 2]
        more = max(1, int(math.log2(CELLS_PER_ROUND / len(parts))))
        olds = {(self.cells[i].bits, self.cells[i].prefix): min(64, self.cells[i].bits + more) for i in parts}
        found = []
        for bits in sorted({b for b, _ in olds}):
            # one literal string of a bounded number of prefixes: a table that is part of the plan
            listed = ",".join(str(p if p < 1 << 63 else p - (1 << 64)) for b, p in olds if b == bits)
            wanted = self.groups.sparkSession.range(1).select(F.explode(F.split(F.lit(listed), ",")).alias("old")).select(F.col("old").cast("long").alias("old"))
            inside = self.groups.withColumn("old", F.expr(f"shiftrightunsigned(u, {64 - bits})")).join(F.broadcast(wanted), "old", "left_semi")
            new_bits = min(64, bits + more)
            found += [self._cell(r, new_bits) for r in self._sums(inside.withColumn("bits", F.lit(new_bits)))]
        self.cells = [c for i, c in enumerate(self.cells) if i not in set(parts)] + found
        self._index()


def fits(hist: Histogram, capacity: int, shards: int) -> bool:
    """Whether a greedy fill with ``capacity`` ends within ``shards``."""
    at = 0
    for _ in range(shards):
        at = hist.floor(at + capacity)
        if at >= hist.total:
            return True
    return False


def cuts_of(hist: Histogram, shards: int, largest: int) -> tuple[int, list[int]]:
    """The smallest feasible capacity, and the ends of the shards under it, each as near to its even share as the capacity allows."""
    low, high = max(largest, -(-hist.total // shards)), largest + -(-hist.total // shards)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(hist, middle, shards) else (middle + 1, high)
    least = [hist.total]  # from the right: the earliest end of each shard from which the rest still fits
    for _ in range(shards - 1):
        least.append(hist.ceil(max(0, least[-1] - low)))
    least.reverse()
    ends, at = [], 0
    for j in range(shards):
        even = hist.total * (j + 1) // shards
        down, up = hist.floor(even), hist.ceil(even)
        near = up if up - even < even - down else down
        if near > at + low:
            near = hist.floor(at + low)
        at = max(near, least[j], at)
        ends.append(at)
    return low, ends


@dataclass(frozen=True)
class Plan:
    """``alone``: hashes with a shard of their own, from shard 0 on; ``cuts``: the first hash of each later shard of the others."""

    shards: int
    alone: list[int]
    cuts: list[int]
    capacity: int

    def shard(self, h: str = "h") -> Column:
        own = F.lit(None).cast("int")
        for i, value in enumerate(self.alone):
            own = F.when(F.col(h) == F.lit(value), F.lit(i)).otherwise(own)
        passed = F.lit(len(self.alone))
        for value in self.cuts:
            passed = passed + (F.col(h) >= F.lit(value)).cast("int")
        return F.coalesce(own, passed).cast("int")


def plan_shards(groups: DataFrame, shards: int) -> Plan:
    """Plan from ``groups(h, bytes)``. At most ``shards`` of the largest groups and the bounded cells reach the driver."""
    total = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("n")).first().n
    top = groups.orderBy(F.col("bytes").desc(), "h").limit(shards).collect()
    alone, rest = [], total
    while len(alone) < min(len(top), shards - 1) and top[len(alone)].bytes * (shards - len(alone)) > rest:
        rest -= top[len(alone)].bytes
        alone.append(top[len(alone)].h)
    if rest == 0:
        return Plan(shards, alone, [], 0)
    hist = Histogram(groups.where(~F.col("h").isin(alone)) if alone else groups)
    largest = top[len(alone)].bytes
    while True:
        capacity, ends = cuts_of(hist, shards - len(alone), largest)
        firsts = [hist.first_hash_after(e) for e in ends[:-1]]
        if not hist.touched:
            return Plan(shards, alone, [h for h in firsts if h is not None], capacity)
        hist.refine()


def shard_documents(spark: SparkSession, docs: DataFrame, shards: int = 40) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``: every row of ``docs`` in one of ``shards`` shards of near equal bytes.

    ``size`` is the UTF-8 length of the text plus 16. Null and empty texts count 16 and are one group. Repeated rows
    get slots of their own in the same shard; null ids are ids. Very long texts are summed like others: a text above the
    average gets its own shard. With fewer groups than shards some shards stay empty. An empty table gives no rows, extra
    columns are ignored. Slots run from 0 in each shard, in buckets of ids: no shard is numbered in one task, and a row
    that is repeated very often is one row with a count until the last step. ``grown_shard`` is null: the law is ``bytes``.
    """
    rows = stage(spark, sized(docs), "sizes")
    groups = stage(spark, rows.groupBy("h").agg(F.sum(F.col("size") * F.col("copies")).alias("bytes")), "groups")
    plan = plan_shards(groups, shards)
    counted = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max("copies"), F.lit(0)).alias("most")).first()
    buckets = max(1, -(-counted.n // SLOTS_PER_BUCKET))
    placed = rows.withColumn("shard", plan.shard()).withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)))
    before = placed.groupBy("shard", "bucket").agg(F.sum("copies").alias("held"))
    carry = before.select("shard", "bucket", F.expr("coalesce(sum(held) OVER (PARTITION BY shard ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("carry"))
    inside = F.expr("coalesce(sum(copies) OVER (PARTITION BY shard, bucket ORDER BY doc_id, h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    numbered = placed.withColumn("inside", inside).join(carry, ["shard", "bucket"]).withColumn("first", F.col("carry") + F.col("inside"))
    out = numbered.withColumn("part", F.explode(F.expr(f"sequence(0L, (copies - 1) div {SLOTS_PER_BUCKET})")))
    if counted.most > SLOTS_PER_BUCKET:  # the parts of a row that is repeated very often go to different tasks
        out = out.repartition("h", "doc_id", "part")
    begin = F.col("first") + F.col("part") * SLOTS_PER_BUCKET
    last = F.col("first") + F.least(F.col("copies"), (F.col("part") + 1) * SLOTS_PER_BUCKET) - 1
    return out.withColumn("slot", F.explode(F.sequence(begin, last))).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))

"""Line dedup that can be taken back: sharded cuckoo filters over exact reference-count tables.

The state is three tables: ``references(digest, doc_id)``, one row for each document and distinct line
key; ``counts(digest, n, top, shard)``, how many documents hold a key and the largest id among them;
``filters(shard, filter)``, a cuckoo filter of each shard's repeated keys. Inserting documents adds
references and raises counts; deleting documents removes theirs and lowers counts; keys that cross the
limit enter or leave the filters. A document's lines are tested against the filters, and only lines
that hit are looked up in the exact table.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm.common import small, stage

MIN_CHARS = 20
MIN_DOCS = 3
SHARD_KEYS = 1_000_000
FILTER_BYTES = 64_000_000
BLANK = b" \t\n\x0b\x0c\r"
SLOTS = 4
KICKS = 500


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """128-bit digest of a line's key (stripped, A-Z lower-cased); None if the key is too short to count."""
    key = line.strip(BLANK).lower()
    if len(key) < min_chars or (not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; each key has two buckets, each told from the other and the fingerprint."""

    def __init__(self, buckets: int, table: np.ndarray | None = None):
        self.mask = buckets - 1
        self.table = np.zeros((buckets, SLOTS), "<u2") if table is None else table

    @classmethod
    def of(cls, digests: list[bytes]) -> CuckooFilter:
        buckets = 1 << max(4, math.ceil(math.log2(max(1, len(digests)) / (0.85 * SLOTS))))
        while True:
            made = cls(buckets)
            if all(made.insert(d) for d in digests):
                return made
            buckets *= 2

    @classmethod
    def read(cls, raw: bytes) -> CuckooFilter:
        table = np.frombuffer(raw, "<u2").reshape(-1, SLOTS).copy()
        return cls(len(table), table)

    def bytes(self) -> bytes:
        return self.table.tobytes()

    def _other(self, bucket, mark):
        return (bucket ^ (mark.astype(np.int64) * 0x5BD1E995)) & self.mask

    def places(self, digests: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words = np.frombuffer(b"".join(digests), "<u4").reshape(-1, 4)
        mark = (words[:, 0] % 65535 + 1).astype("<u2")
        first = words[:, 1].astype(np.int64) & self.mask
        return mark, first, self._other(first, mark)

    def has(self, digests: list[bytes]) -> np.ndarray:
        if not digests:
            return np.zeros(0, bool)
        mark, first, second = self.places(digests)
        return (self.table[first] == mark[:, None]).any(axis=1) | (self.table[second] == mark[:, None]).any(axis=1)

    def insert(self, digest: bytes) -> bool:
        mark, first, second = (x[0] for x in self.places([digest]))
        for bucket in (first, second):
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = mark
                return True
        bucket = first
        for kick in range(KICKS):
            slot = (kick * 7 + int(mark)) % SLOTS
            self.table[bucket, slot], mark = mark, self.table[bucket, slot].copy()
            bucket = self._other(bucket, mark)
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = mark
                return True
        return False

    def delete(self, digest: bytes) -> bool:
        mark, first, second = (x[0] for x in self.places([digest]))
        for bucket in (first, second):
            held = np.flatnonzero(self.table[bucket] == mark)
            if len(held):
                self.table[bucket, held[0]] = 0
                return True
        return False


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("raw"), F.xxhash64("text").alias("text_key"))


def references_of(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``digest, doc_id``: each row's distinct line keys."""
    def scan(batches):
        for batch in batches:
            found = [list({k for k in (line_key(x, min_chars) for x in raw.split(b"\n") if len(x) >= min_chars) if k}) for raw in batch.raw]
            yield pd.DataFrame({"doc_id": batch.doc_id.astype("Int64"), "digests": found})

    return _texts(docs).mapInPandas(scan, "doc_id long, digests array<binary>").select(F.explode("digests").alias("digest"), "doc_id")


def shard_of(shards: int):
    return (F.conv(F.hex(F.substring("digest", 13, 4)), 16, 10).cast("long") % shards).cast("int")


def shard_number(digest: bytes, shards: int) -> int:
    return int.from_bytes(digest[12:16], "big") % shards


def _filled(rows: DataFrame) -> DataFrame:
    """A filter for each shard; a shard is bounded by the choice of their number."""
    def make(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": [group.shard.iloc[0]], "filter": [CuckooFilter.of(sorted(group.digest)).bytes()]})

    return rows.groupBy("shard").applyInPandas(make, "shard int, filter binary")


@dataclass(frozen=True)
class LineIndex:
    """State over some documents; ``insert`` and ``delete`` give a new one, and a delete undoes an insert.

    Every row is a document; rows that repeat an id are documents of their own and go together. A null or
    empty text is one empty line. Null ids rank below all others and cannot be deleted by id. Other
    columns are ignored; empty tables give empty states and results.
    """

    spark: SparkSession
    references: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int = MIN_DOCS
    min_chars: int = MIN_CHARS

    @classmethod
    def build(cls, spark: SparkSession, docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> LineIndex:
        references = stage(spark, references_of(docs, min_chars), "references")
        counted = stage(spark, _counted(references), "counts")
        shards = max(1, math.ceil(counted.where(F.col("n") >= min_docs).count() / SHARD_KEYS))
        counts = counted.withColumn("shard", shard_of(shards))
        filters = stage(spark, _filled(counts.where(F.col("n") >= min_docs)), "filters")
        return cls(spark, references, counts, filters, shards, min_docs, min_chars)

    def insert(self, docs: DataFrame) -> LineIndex:
        fresh = stage(self.spark, references_of(docs, self.min_chars), "references")
        added = _counted(fresh).withColumn("shard", shard_of(self.shards))
        counts = stage(self.spark, self.counts.unionByName(added).groupBy("digest", "shard").agg(F.sum("n").alias("n"), F.max("top").alias("top")), "counts")
        return self._crossed(self.references.unionByName(fresh), counts)

    def delete(self, ids: DataFrame) -> LineIndex:
        """Without the documents whose ids are in ``ids(doc_id)``."""
        gone = ids.select("doc_id").where("doc_id is not null").distinct()
        references = stage(self.spark, self.references.join(gone, "doc_id", "left_anti").select("digest", "doc_id"), "references")
        touched = stage(self.spark, self.references.join(gone, "doc_id", "left_semi").select("digest").distinct(), "touched")
        again = _counted(references.join(touched, "digest", "left_semi")).withColumn("shard", shard_of(self.shards))
        kept = self.counts.join(touched, "digest", "left_anti").select("digest", "n", "top", "shard")
        return self._crossed(references, stage(self.spark, kept.unionByName(again), "counts"))

    def _crossed(self, references: DataFrame, counts: DataFrame) -> LineIndex:
        """Filters after the keys whose counts crossed the limit entered or left."""
        was = self.counts.where(F.col("n") >= self.min_docs).select("digest", "shard", F.lit(-1).alias("step"))
        now = counts.where(F.col("n") >= self.min_docs).select("digest", "shard", F.lit(1).alias("step"))
        steps = was.unionByName(now).groupBy("digest", "shard").agg(F.sum("step").cast("int").alias("step")).where("step <> 0")

        def move(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            shard = (left if len(left) else right).shard.iloc[0]
            held = CuckooFilter.read(left["filter"].iloc[0]) if len(left) else CuckooFilter.of([])
            for digest in right.digest[right.step < 0]:
                held.delete(digest)
            full = [d for d in right.digest[right.step > 0] if not held.insert(d)]
            return pd.DataFrame({"shard": [shard], "filter": [None if full else held.bytes()]})

        moved = stage(self.spark, self.filters.groupBy("shard").cogroup(steps.groupBy("shard")).applyInPandas(move, "shard int, filter binary"), "filters")
        if moved.where("filter is null").count():  # a full filter is made anew, larger, from the exact table
            full = moved.where("filter is null").select("shard")
            moved = stage(self.spark, moved.where("filter is not null").unionByName(
                _filled(counts.where(F.col("n") >= self.min_docs).join(full, "shard", "left_semi").select("digest", "shard"))), "filters")
        return replace(self, references=references, counts=counts, filters=moved)

    def dedup(self, docs: DataFrame) -> DataFrame:
        """``doc_id, n_lines, n_dropped, kept`` for each row of ``docs``.

        A line goes if its key is held by ``min_docs`` documents or more and this is not the largest id that holds it;
        keys that only documents without id hold stay.
        """
        size = self.filters.agg(F.coalesce(F.sum(F.length("filter")), F.lit(0))).first()[0]
        probe = None
        if size <= FILTER_BYTES:  # else every long line is looked up in the exact table
            probe = self.spark.sparkContext.broadcast({r.shard: bytes(r.filter) for r in self.filters.collect()})
        min_chars, shards = self.min_chars, self.shards

        def scan(batches):
            held = {s: CuckooFilter.read(raw) for s, raw in probe.value.items()} if probe is not None else None
            for batch in batches:
                keys = [{k for k in (line_key(x, min_chars) for x in raw.split(b"\n") if len(x) >= min_chars) if k} for raw in batch.raw]
                known = set().union(*keys)
                if held is not None:
                    by_shard: dict[int, list[bytes]] = {}
                    for k in known:
                        by_shard.setdefault(shard_number(k, shards), []).append(k)
                    known = {k for s, some in by_shard.items() if s in held for k, hit in zip(some, held[s].has(some)) if hit}
                hits = [list(k & known) for k in keys]
                at = [i for i, h in enumerate(hits) if h]
                yield pd.DataFrame({"doc_id": batch.doc_id.iloc[at].astype("Int64"), "text_key": batch.text_key.iloc[at], "hits": [hits[i] for i in at]})

        asked = _texts(docs).mapInPandas(scan, "doc_id long, text_key long, hits array<binary>").select("doc_id", "text_key", F.explode("hits").alias("digest"))
        exact = stage(self.spark, self.counts.where((F.col("n") >= self.min_docs) & F.col("top").isNotNull()).select("digest", "top"), "repeated")
        gone = asked.join(small(exact, exact.count(), 200_000), "digest").where(~F.col("top").eqNullSafe(F.col("doc_id")))
        drops = stage(self.spark, gone.groupBy("doc_id", "text_key").agg(F.collect_set("digest").alias("drops")).select(
            F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "drops"), "drops")

        def cut(batches):
            for batch in batches:
                rows = []
                for doc_id, raw, gone in zip(batch.doc_id, batch.raw, batch.drops):
                    lines, gone = raw.split(b"\n"), {bytes(g) for g in gone}
                    kept = [x for x in lines if len(x) < min_chars or line_key(x, min_chars) not in gone]
                    rows.append((doc_id, len(lines), len(lines) - len(kept), b"\n".join(kept).decode("utf-8", "replace")))
                yield pd.DataFrame(rows, columns=["doc_id", "n_lines", "n_dropped", "kept"]).astype({"doc_id": "Int64"})

        total = drops.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size("drops")), F.lit(0)).alias("keys")).first()
        side = small(drops, total.rows + total.keys, 1_000_000)  # at most about 40 MB
        joined = _texts(docs).join(side, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key")), "left")
        whole = joined.where("drops is null").select("doc_id", F.size(F.split(F.col("raw").cast("string"), "\n", -1)).cast("long").alias("n_lines"),
                                                     F.lit(0).cast("long").alias("n_dropped"), F.col("raw").cast("string").alias("kept"))
        edited = joined.where("drops is not null").select("doc_id", "raw", "drops").mapInPandas(cut, "doc_id long, n_lines long, n_dropped long, kept string")
        return whole.unionByName(edited)


def _counted(references: DataFrame) -> DataFrame:
    return references.groupBy("digest").agg(F.count("*").alias("n"), F.max("doc_id").alias("top"))

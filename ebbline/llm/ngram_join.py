"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence.

Documents with equal n-gram sets form one class, a row of the incidence. Its columns are ordered by
rarity (fixed-size tables of column and word counts, taken over all documents), so two rows that reach the
similarity must meet in the first, rarest, columns of both: only these enter the postings. Rows that
meet are first compared by a few bits for each column, which bound their overlap from above. Pairs that may
still reach it are checked by the product itself: overlap counts grow block of columns by block of columns,
and a pair is dropped as soon as what is left cannot reach the bound its sizes imply.

Within a posting list not all pairs are formed. First every row is compared with the list's most
central row; the links found give components. Only rows of different components are compared after
that, so a large group of near copies costs a number of pairs linear in its size, and no link
between components is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm.common import batches_of, components, discard, numbered, small, stage

COUNT_BITS = 18
BLOCKS = 8
LOW_BLOCKS = 1
BATCH_ROWS = 512
BLOCK_SHIFT = np.uint64(61)
MIX = np.uint64(0x9E3779B97F4A7C15)
COLUMN = np.uint64((1 << COUNT_BITS) - 1)


class WordHashes(dict):
    """64-bit hash of each word, kept while the table is small."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


def word_hashes(text: bytes | None, table: WordHashes) -> np.ndarray:
    """Hashes of the words; A-Z are lower-cased, and bytes.split() cuts at exactly the ASCII white space."""
    words = text.lower().split() if text else []
    return np.fromiter(map(table.__getitem__, words), np.uint64, len(words))


def rolled(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each ``n``-word shingle in order; one of the whole sequence if it has fewer words."""
    width = min(n, len(h))
    if not width:
        return np.empty(0, np.uint64)
    out = np.full(len(h) - width + 1, np.uint64(width))
    for i in range(width):
        out = (out ^ h[i:len(h) - width + 1 + i]) * MIX
        out ^= out >> np.uint64(29)
    return out


def shingles(text: bytes | None, n: int, table: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a whole text."""
    return np.unique(rolled(word_hashes(text, table), n))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("raw"), F.xxhash64("text").alias("text_key"))


def needed(t: int, a, b):
    """Least overlap of sets of sizes ``a`` and ``b`` at ``t`` hundredths: ceil(t (a + b) / (100 + t)), exact in integers."""
    return -((-t * (a + b)) // (100 + t))


def column_counts(docs: DataFrame, n: int) -> np.ndarray:
    """How many shingles, and how many words, fall on each of ``2 ** COUNT_BITS`` columns, over all documents.

    The size is fixed, so the result may be broadcast. Tasks send the counts of their own rows.
    """
    size = 1 << COUNT_BITS

    def count(batches):
        table, total = WordHashes(), np.zeros(2 * size, np.int64)
        for batch in batches:
            for raw in batch.raw:
                h = word_hashes(raw, table)
                np.add.at(total, (np.unique(rolled(h, n)) & COLUMN).astype(np.int64), 1)
                np.add.at(total, (h & COLUMN).astype(np.int64) + size, 1)
        held = np.flatnonzero(total)
        for at in range(0, len(held), 1 << 16):
            some = held[at:at + (1 << 16)]
            yield pd.DataFrame({"place": some, "n": total[some]})

    counts = np.zeros(2 * size, np.int64)
    with batches_of(docs.sparkSession, BATCH_ROWS):
        table = _texts(docs).select("raw").mapInPandas(count, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    counts[table["place"].to_numpy()] = table["n"].to_numpy()
    return counts.reshape(2, size)


def rarity(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each column its level (0, or how far its count stands out) and for each word its weight: made once for a task."""
    usual = 2 * counts[0].mean() + 16
    return np.log2(np.maximum(counts[0] / usual, 1)).astype(np.int64), np.log2(np.maximum(counts[1], 1)).round(3)


def rarest(h: np.ndarray, n: int, order: tuple[np.ndarray, np.ndarray], t: int) -> tuple[np.ndarray, np.ndarray]:
    """The set of a document, and its first columns in one order that all documents share, rarest first.

    Columns whose count stands out come last, by how far; among the others those of the rarest words come first.
    Any shared order gives all links; this one keeps the postings that documents share few. Only the columns
    that are kept are sorted.
    """
    levels, weights = order
    every = rolled(h, n)
    s, at = np.unique(every, return_index=True)
    m = len(s)
    if not m:
        return s, s
    # Words only: the estimate is the same in every document, as a shingle holds the same words.
    weight = weights[(h & COLUMN).astype(np.int64)]
    width = min(n, len(h))
    estimate = sum(weight[i:len(h) - width + 1 + i] for i in range(width))[at]
    key = (levels[(s & COLUMN).astype(np.int64)] << 40) + np.rint(estimate * 100).astype(np.int64)
    wanted = m + (-t * m) // 100 + 1
    if wanted < m:
        near = np.flatnonzero(key <= np.partition(key, wanted - 1)[wanted - 1])
        return s, s[near[np.lexsort((s[near], key[near]))[:wanted]]]
    return s, s[np.lexsort((s, key))]


def signature(s: np.ndarray) -> bytes:
    """One bit for each remainder of the columns of a set modulo a power of two, which is twice their number or more."""
    bits = np.zeros(max(64, 1 << (2 * len(s) - 1).bit_length()), bool)
    bits[(s & np.uint64(len(bits) - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def can_reach(xs: np.ndarray, ys: np.ndarray, sx: np.ndarray, sy: np.ndarray, t: int) -> np.ndarray:
    """False only for pairs whose sets, of sizes ``sx`` and ``sy``, cannot reach the similarity.

    A bit that only one signature of a pair has stands for at least one column that the other set lacks. A longer
    signature is folded to the length of the shorter one.
    """
    reach = np.empty(len(xs), bool)
    wx, wy = np.array([len(x) for x in xs]), np.array([len(y) for y in ys])

    def folded(some: np.ndarray, width: int) -> np.ndarray:
        bits = np.frombuffer(b"".join(some), np.uint8).reshape(len(some), -1)
        while bits.shape[1] > width:
            bits = bits[:, :bits.shape[1] // 2] | bits[:, bits.shape[1] // 2:]
        return bits

    for a, b in set(zip(wx.tolist(), wy.tolist())):
        at = np.flatnonzero((wx == a) & (wy == b))
        x, y = folded(xs[at], min(a, b)), folded(ys[at], min(a, b))
        most = np.minimum(sx[at] - np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64), sy[at] - np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64))
        reach[at] = most >= needed(t, sx[at], sy[at])
    return reach


def incidence(spark: SparkSession, docs: DataFrame, n: int, t: int) -> DataFrame:
    """One row for each document: id, text key, class (128-bit digest of its set), size, rarest columns and signature.

    ``head`` holds the columns that the prefix bound asks for, rarest first.
    """
    shared = spark.sparkContext.broadcast(column_counts(docs, n))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, order = WordHashes(), rarity(shared.value)
        for batch in batches:
            out = []
            for doc_id, raw, key in zip(batch.doc_id, batch.raw, batch.text_key):
                s, first = rarest(word_hashes(raw, table), n, order, t)
                out.append((doc_id, key, hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None, len(s), first.view(np.int64), signature(s) if len(s) else None))
            yield pd.DataFrame(out, columns=["doc_id", "text_key", "cls", "m", "head", "bits"]).astype({"doc_id": "Int64"})

    with batches_of(spark, BATCH_ROWS):
        return stage(spark, _texts(docs).mapInPandas(rows, "doc_id long, text_key long, cls string, m int, head array<long>, bits binary"), "incidence")


def class_sets(docs: DataFrame, n: int, classes: DataFrame, rows: int) -> DataFrame:
    """``cls, size, low, high`` of the classes asked for: their whole sets, made again from the texts, in two parts of blocks."""
    def rows_of(batches):
        table = WordHashes()
        for batch in batches:
            out = []
            for c, raw in zip(batch.cls, batch.raw):
                s = shingles(raw, n, table)
                cut = int(np.searchsorted(s, np.uint64(LOW_BLOCKS) << BLOCK_SHIFT))
                out.append((c, len(s), s[:cut].view(np.int64), s[cut:].view(np.int64)))
            yield pd.DataFrame(out, columns=["cls", "size", "low", "high"])

    keys = small(classes.select("cls", F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "repeated"), rows, 200_000)
    held = _texts(docs).join(keys, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key")))
    # Only rows that share id and text need a shuffle to leave one of them.
    texts = held.where("not repeated").select("cls", "raw")
    if classes.where("repeated").limit(1).count():
        texts = texts.union(held.where("repeated").select("cls", "raw").dropDuplicates(["cls"]))
    return texts.mapInPandas(rows_of, "cls long, size int, low array<long>, high array<long>")


def accumulate(xs: list[np.ndarray], ys: list[np.ndarray], count: np.ndarray, need: np.ndarray, left_x: np.ndarray, left_y: np.ndarray,
               first: int = 0, last: int = BLOCKS) -> tuple[np.ndarray, np.ndarray]:
    """Overlap counts after blocks ``first`` to ``last`` of the columns, and which pairs can still reach ``need``.

    ``xs`` and ``ys`` are the sorted columns of these blocks, ``left_x`` and ``left_y`` what the sets hold from
    here on. The product of all pairs is taken block by block; pairs that cannot reach the bound leave at once.
    """
    count, alive = count.astype(np.int64), np.arange(len(xs))
    edges = np.arange(first + 1, last, dtype=np.uint64) << BLOCK_SHIFT
    cut = lambda v: np.concatenate(([0], np.searchsorted(v.view(np.uint64), edges), [len(v)])).astype(np.int64)
    cx, cy = [cut(x) for x in xs], [cut(y) for y in ys]
    for k in range(last - first):
        px = [xs[i][cx[i][k]:cx[i][k + 1]] for i in alive]
        py = [ys[i][cy[i][k]:cy[i][k + 1]] for i in alive]
        values = np.concatenate(px + py)
        pair = np.repeat(np.tile(np.arange(len(alive)), 2), [len(v) for v in px + py])
        order = np.lexsort((values, pair))
        values, pair = values[order], pair[order]
        same = (values[1:] == values[:-1]) & (pair[1:] == pair[:-1])
        count[alive] += np.bincount(pair[1:][same], minlength=len(alive))
        left = np.array([min(left_x[i] - cx[i][k + 1], left_y[i] - cy[i][k + 1]) for i in alive])
        alive = alive[count[alive] + left >= need[alive]]
        if not len(alive):
            break
    reach = np.zeros(len(xs), bool)
    reach[alive] = True
    return count, reach


def overlaps(xs: list[np.ndarray], ys: list[np.ndarray], t: int) -> np.ndarray:
    """True for the pairs of whole sets that reach the similarity."""
    a, b = np.array([len(x) for x in xs]), np.array([len(y) for y in ys])
    return accumulate(xs, ys, np.zeros(len(xs)), needed(t, a, b), a, b)[1]


def reachable(spark: SparkSession, marks: DataFrame, pairs: DataFrame, t: int) -> DataFrame:
    """The pairs ``(a, b)`` of classes whose signatures in ``marks(cls, m, bits)`` leave a link possible."""
    def check(batches):
        for batch in batches:
            reach = can_reach(batch.x.to_numpy(), batch.y.to_numpy(), batch.sx.to_numpy(np.int64), batch.sy.to_numpy(np.int64), t)
            yield batch.loc[reach, ["a", "b"]]

    def side(key: str, size: str, bits: str) -> DataFrame:
        return marks.select(F.col("cls").alias(key), F.col("m").alias(size), F.col("bits").alias(bits))

    with batches_of(spark, 8 * BATCH_ROWS):
        return stage(spark, pairs.join(side("a", "sx", "x"), "a").join(side("b", "sy", "y"), "b").mapInPandas(check, "a long, b long"), "reachable")


def verified(spark: SparkSession, docs: DataFrame, classes: DataFrame, marks: DataFrame, pairs: DataFrame, n: int, t: int) -> DataFrame:
    """The pairs ``(a, b)`` of classes that link.

    Only pairs whose signatures leave a link possible get whole sets: all of these the first blocks of both,
    and those that can still reach their bound the others.
    """
    pairs = reachable(spark, marks, pairs, t)
    if not pairs.limit(1).count():
        return pairs
    asked = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
    asked = stage(spark, classes.join(asked, "cls", "left_semi"), "asked")
    with batches_of(spark, BATCH_ROWS):
        sets = stage(spark, class_sets(docs, n, asked, asked.count()), "sets")

    def part(name: str, first: int, last: int):
        def check(batches):
            for batch in batches:
                for at in range(0, len(batch), 256):
                    some = batch.iloc[at:at + 256]
                    sx, sy, count = some.sx.to_numpy(), some.sy.to_numpy(), some["count"].to_numpy()
                    count, reach = accumulate([np.asarray(v, np.int64) for v in some.x], [np.asarray(v, np.int64) for v in some.y], count,
                                              needed(t, sx, sy), sx - some.past_x.to_numpy(), sy - some.past_y.to_numpy(), first, last)
                    past_x, past_y = some.past_x + some.x.map(len), some.past_y + some.y.map(len)
                    yield some.assign(count=count, past_x=past_x, past_y=past_y).loc[reach, ["a", "b", "count", "past_x", "past_y"]]

        def side(key: str, size: str, cols: str) -> DataFrame:
            return sets.select(F.col("cls").alias(key), F.col("size").alias(size), F.col(name).alias(cols))

        def run(some: DataFrame) -> DataFrame:
            both = some.join(side("a", "sx", "x"), "a").join(side("b", "sy", "y"), "b")
            with batches_of(spark, BATCH_ROWS):
                return stage(spark, both.mapInPandas(check, "a long, b long, count long, past_x long, past_y long"), f"pairs_{name}")

        return run

    begun = pairs.select("a", "b", *[F.lit(0).cast("long").alias(c) for c in ("count", "past_x", "past_y")])
    found = part("high", LOW_BLOCKS, BLOCKS)(part("low", 0, LOW_BLOCKS)(begun)).select("a", "b")
    discard(spark, asked, sets)
    return found


def _bounded(x: str, y: str, t: int) -> F.Column:
    """Size bound and position bound for two postings of one list: can these rows still reach the overlap?"""
    mx, my = F.col(f"{x}.m"), F.col(f"{y}.m")
    left = 1 + F.least(mx - F.col(f"{x}.place") - 1, my - F.col(f"{y}.place") - 1)
    return (100 * F.least(mx, my) >= t * F.greatest(mx, my)) & ((100 + t) * left >= t * (mx + my))


def ngram_join(spark: SparkSession, docs: DataFrame, n: int = 5, t: int = 80) -> DataFrame:
    """Components of documents whose ``n``-word shingle sets have a Jaccard similarity of ``t`` hundredths or more.

    Returns one row for each document: ``doc_id, text_key, n_shingles, cls, grp, component``. ``component``
    is the smallest id in reach by links, ``grp`` a label that also tells groups with repeated ids apart. Null or empty texts have no set (``cls`` null) and stand alone.
    Repeated rows and equal texts are one class. A null id stays null and is passed over as smallest id,
    unless nothing else is in reach. Other columns are ignored; an empty table gives no rows.
    """
    whole = incidence(spark, docs, n, t)
    heads = numbered(spark, whole.where("cls is not null").groupBy("cls").agg(
        F.min(F.struct(F.col("doc_id"), F.col("text_key"))).alias("one"), F.min("doc_id").alias("least_id"), F.first("m").alias("m"), F.first("head").alias("head"), F.first("bits").alias("bits"),
    ).select(F.col("cls").alias("digest"), "one.*", "least_id", "m", "head", "bits"), "classes", "cls")
    # The columns are read from the classes only, and once: what stays on disk is narrow.
    rows = stage(spark, whole.drop("head", "bits"), "rows")
    discard(spark, whole)
    again = rows.groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.lit(True).alias("repeated"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key"))
    classes = stage(spark, heads.drop("head", "bits").join(again, same, "left").drop("__id", "__key").withColumn("repeated", F.col("repeated").isNotNull()), "keys")
    marks = stage(spark, heads.select("cls", "m", "bits"), "signatures")
    posted = heads.select("cls", "m", F.posexplode("head").alias("place", "col"))
    # Columns are counted alone first, so that the many that one class holds travel as two numbers and no further.
    shared = stage(spark, posted.groupBy("col").agg(F.count("*").alias("n")).where("n > 1").select("col"), "shared_columns")
    posted = stage(spark, posted.join(shared, "col"), "postings")
    discard(spark, heads)
    hubs = posted.groupBy("col").agg(F.min(F.struct("place", "m", "cls")).alias("hub"))
    lists = stage(spark, posted.join(hubs, "col"), "lists")
    keys = classes.select("cls", "doc_id", "text_key", "repeated")

    first = lists.select("col", F.struct("cls", "m", "place").alias("x"), F.col("hub").alias("y")).where(
        (F.col("x.cls") != F.col("y.cls")) & _bounded("x", "y", t))
    discard(spark, shared, posted)
    pairs = stage(spark, first.select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b")).distinct(), "pairs")
    links = verified(spark, docs, keys, marks, pairs, n, t)
    labels = components(spark, links)
    named = stage(spark, lists.join(labels.withColumnRenamed("node", "cls"), "cls", "left").join(
        labels.select(F.col("node").alias("__hub"), F.col("component").alias("hub_component")), F.col("hub.cls") == F.col("__hub"), "left").select(
        "col", "cls", "m", "place", F.coalesce("component", "cls").alias("component"), F.coalesce("hub_component", "hub.cls").alias("hub_component")), "named")

    discard(spark, lists)
    x, y = named.where("component <> hub_component").alias("x"), named.alias("y")
    apart = (F.col("x.component") != F.col("y.component")) & ((F.col("y.component") == F.col("y.hub_component")) | (F.col("x.cls") < F.col("y.cls")))
    crossed = x.join(y, (F.col("x.col") == F.col("y.col")) & apart & _bounded("x", "y", t))
    more = crossed.select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b")).distinct().join(pairs, ["a", "b"], "left_anti")
    more = stage(spark, more, "pairs")
    discard(spark, named, pairs)
    more = verified(spark, docs, keys, marks, more, n, t)
    discard(spark, marks)
    # The labels are links enough for what is joined already.
    if more.limit(1).count():
        labels = components(spark, labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))

    reached = classes.select("digest", "cls", "least_id").join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    least = reached.groupBy("component").agg(F.min("least_id").alias("least"))
    ids = reached.join(least, "component").select(F.col("digest").alias("cls"), F.col("component").alias("grp"), F.col("least").alias("component_id"))
    return rows.select("doc_id", "text_key", "cls", F.col("m").cast("long").alias("n_shingles")).join(ids, "cls", "left").select(
        "doc_id", "text_key", "n_shingles", "cls", "grp", F.coalesce("component_id", "doc_id").alias("component"))

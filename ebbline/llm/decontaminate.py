"""Benchmark decontamination over a distributed positional inverted index.

Every window of a benchmark item (``width`` consecutive words, or the whole of a shorter item) is
looked up by its rarest words. The index stores, for these words only, the positions in all
documents. A posting at position ``p`` of a word that an item has at position ``i`` lies on the
diagonal ``p - i``; intersecting the offset-adjusted lists of the two rarest words of a window
leaves the diagonals on which the window can occur. What is left is compared word by word with the
neighbourhood kept in the posting of the rarest word, which gives the exact occurrences; the same
lists with a tolerance give proximity matches.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbline.llm.common import numbered, small, stage

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
WIDTH = 13
TERMS_BOUND = 2_000_000


def words_of(raw: bytes | None) -> list[bytes]:
    """ASCII letters and digits, and all that is not ASCII, in runs; A-Z lower-cased."""
    return WORD.findall(raw.lower()) if raw else []


def item_words(benchmark: DataFrame) -> DataFrame:
    """``item_id, pos, term, n`` of the benchmark; items without words give no row.

    Inside this module an item is known by its id and its text's digest, so two texts under one id stay two items.
    A text without an id is an item of its own, named ``null:`` and its digest.
    """
    def split(batches):
        for batch in batches:
            rows = []
            for item, raw in zip(batch.item_id, batch.raw):
                words = words_of(raw)
                rows += [(item, i, w.decode("utf-8", "replace"), len(words)) for i, w in enumerate(words)]
            yield pd.DataFrame(rows, columns=["item_id", "pos", "term", "n"])

    named = F.coalesce(F.col("item_id").cast("string"), F.concat(F.lit("null:"), F.md5("text")))
    return benchmark.select(F.concat_ws("\x01", named, F.md5("text")).alias("item_id"), F.col("text").cast("binary").alias("raw")).where(
        "raw is not null").distinct().mapInPandas(split, "item_id string, pos int, term string, n int")


def _terms(spark: SparkSession, df: DataFrame, bound: int):
    """The distinct terms for the tasks' look-up, if their number is within the bound; else None."""
    n = df.count()
    if n > bound:
        return None
    return spark.sparkContext.broadcast({r[0].encode(): tuple(r[1:]) for r in df.toLocalIterator()})


def term_frequencies(spark: SparkSession, docs: DataFrame, terms: DataFrame, bound: int = TERMS_BOUND) -> DataFrame:
    """``term, n``: how often each benchmark term occurs in all documents (terms that never occur: 0).

    Counts are summed in the tasks first. Above ``bound`` terms all words are counted and joined instead.
    """
    wanted = _terms(spark, terms.select("term"), bound)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = wanted.value if wanted is not None else None
        total: Counter = Counter()
        for batch in batches:
            for raw in batch.raw:
                seen = Counter(words_of(raw))
                for w in (seen.keys() & held.keys()) if held is not None else seen:
                    total[w] += seen[w]
            if len(total) > 500_000:
                yield _counted(total)
                total = Counter()
        yield _counted(total)

    counted = docs.select(F.col("text").cast("binary").alias("raw")).mapInPandas(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return terms.select("term").join(counted, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def _counted(total: Counter) -> pd.DataFrame:
    return pd.DataFrame([(k.decode("utf-8", "replace"), v) for k, v in total.items()], columns=["term", "n"])


def anchors(words: DataFrame, frequencies: DataFrame, width: int = WIDTH) -> DataFrame:
    """Rarest words of every window: ``item_id, start, size, first_pos, second_pos`` (the same for one-word windows)."""
    ranked = words.join(frequencies.withColumnRenamed("n", "df"), "term")
    size = F.least(F.col("n"), F.lit(width))
    spread = ranked.select("item_id", "pos", "df", size.alias("size"), F.explode(F.sequence(
        F.greatest(F.lit(0), F.col("pos") - size + 1), F.least(F.col("pos"), F.col("n") - size))).alias("start"))
    window = spread.groupBy("item_id", "start", "size").agg(F.sort_array(F.collect_list(F.struct("df", "pos"))).alias("by"))
    return window.select("item_id", "start", "size", F.col("by")[0]["pos"].alias("first_pos"),
                         F.try_element_at("by", F.lit(2))["pos"].alias("second_pos")).withColumn("second_pos", F.coalesce("second_pos", "first_pos"))


def build_index(spark: SparkSession, docs: DataFrame, terms: DataFrame, bound: int = TERMS_BOUND) -> tuple[DataFrame, DataFrame]:
    """Positional index for ``terms(term, before, after)``: the documents and their postings.

    ``documents(row_id, doc_id, text_key, n_words)`` has one row for each input row;
    ``postings(row_id, term, pos, around, offset)`` one for each occurrence of a term, with up to ``before`` and
    ``after`` words around it (``around[offset]`` is the term; null where both are below zero).
    Above ``bound`` terms every word is posted and the join leaves those asked for.
    """
    wanted = _terms(spark, terms, bound)
    widest = None if wanted is not None else terms.agg(F.coalesce(F.max("before"), F.lit(0)), F.coalesce(F.max("after"), F.lit(0))).first()

    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = wanted.value if wanted is not None else None
        for batch in batches:
            rows = []
            for doc_id, key, raw in zip(batch.doc_id, batch.text_key, batch.raw):
                words, found = words_of(raw), []
                hits = [i for i, w in enumerate(words) if w in held] if held is not None else range(len(words))
                for i in hits:
                    before, after = held[words[i]] if held is not None else widest
                    low = max(0, i - before)
                    around = None if before < 0 and after < 0 else [w.decode("utf-8", "replace") for w in words[low:i + after + 1]]
                    found.append({"term": words[i].decode("utf-8", "replace"), "pos": i, "offset": i - low, "around": around})
                rows.append((doc_id, key, len(words), found))
            yield pd.DataFrame(rows, columns=["doc_id", "text_key", "n_words", "found"]).astype({"doc_id": "Int64"})

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text").cast("binary").alias("raw"))
    scanned = numbered(spark, texts.mapInPandas(
        post, "doc_id long, text_key long, n_words long, found array<struct<term: string, pos: int, offset: int, around: array<string>>>"), "positions")
    postings = scanned.select("row_id", F.explode("found").alias("f")).select("row_id", "f.*")
    if wanted is None:
        postings = postings.join(terms.select("term"), "term", "left_semi")
    return scanned.select("row_id", "doc_id", "text_key", "n_words"), postings


class Matcher:
    """Index of ``docs`` for the windows of ``benchmark``, and the matches it yields.

    Null and empty texts have no words. Repeated documents are matched row by row; items with the same id
    and text count once. A text under a null item id is an item of its own, listed as ``null:`` and its md5. Extra columns are ignored; empty tables give no
    matches.
    """

    def __init__(self, spark: SparkSession, docs: DataFrame, benchmark: DataFrame, width: int = WIDTH):
        self.spark, self.width = spark, width
        self.words = stage(spark, item_words(benchmark), "item_words")
        terms = self.words.select("term").distinct()
        self.frequencies = stage(spark, term_frequencies(spark, docs, terms), "frequencies")
        self.windows = stage(spark, anchors(self.words, self.frequencies, width), "anchors")
        first = self.windows.groupBy("item_id", F.col("first_pos").alias("pos")).agg(
            (F.col("pos") - F.min("start")).cast("int").alias("before"), (F.max(F.col("start") + F.col("size")) - 1 - F.col("pos")).cast("int").alias("after"))
        second = self.windows.select("item_id", F.col("second_pos").alias("pos"), F.lit(-1).alias("before"), F.lit(-1).alias("after")).distinct()
        self.places = stage(spark, first.union(second).groupBy("item_id", "pos").agg(F.max("before").alias("before"), F.max("after").alias("after")).join(
            self.words.select("item_id", "pos", "term"), ["item_id", "pos"]), "places")
        asked = self.places.groupBy("term").agg(F.max("before").alias("before"), F.max("after").alias("after"))
        self.documents, self.postings = build_index(spark, docs, asked)

    def _on_diagonals(self) -> DataFrame:
        places = self.places.select("item_id", F.col("pos").alias("i"), "term")
        return self.postings.join(places, "term").select("row_id", "item_id", "i", (F.col("pos") - F.col("i")).alias("diagonal"), "pos", "offset", "around")

    def phrases(self) -> DataFrame:
        """Exact occurrences of whole windows: ``row_id, item_id, low, high`` (words, end exclusive)."""
        hits = self._on_diagonals()
        # Offset-adjusted intersection: both rarest words of a window on the same diagonal.
        pairs = self.windows.select("item_id", F.col("first_pos").alias("i"), F.col("second_pos").alias("j"), "start", "size")
        lists = hits.groupBy("row_id", "item_id", "diagonal").agg(F.collect_set("i").alias("seen"))
        windows = pairs.groupBy("item_id", "i").agg(F.collect_list(F.struct("j", "start", "size")).alias("windows"))
        texts = self.words.groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("pos", "term"))).alias("w")).select(
            "item_id", F.col("w.term").alias("words"))
        windows = windows.join(texts, "item_id")
        found = hits.where("around is not null").join(lists, ["row_id", "item_id", "diagonal"]).join(windows, ["item_id", "i"])

        around_start = F.col("pos") - F.col("offset") - F.col("diagonal")
        def occurs(w):
            same = F.slice("around", w["start"] - around_start + 1, w["size"]) == F.slice("words", w["start"] + 1, w["size"])
            inside = (w["start"] >= around_start) & (w["start"] + w["size"] <= around_start + F.size("around"))
            return F.array_contains("seen", w["j"]) & inside & F.when(inside, same).otherwise(False)

        exact = found.select("row_id", "item_id", "diagonal", F.explode(F.filter("windows", occurs)).alias("w"))
        return exact.select("row_id", "item_id", (F.col("diagonal") + F.col("w.start")).alias("low"),
                            (F.col("diagonal") + F.col("w.start") + F.col("w.size")).alias("high"))

    def proximity(self, slack: int = 4) -> DataFrame:
        """``row_id, item_id``: both rarest words of a window, each at most ``slack`` words off one common diagonal."""
        hits = self._on_diagonals().select("row_id", "item_id", "i", F.explode(F.array(
            F.floor(F.col("diagonal") / (2 * slack + 1)) * 2, F.floor((F.col("diagonal") + slack) / (2 * slack + 1)) * 2 + 1)).alias("band"))
        bands = hits.groupBy("row_id", "item_id", "band").agg(F.collect_set("i").alias("seen"))
        pairs = self.windows.where("first_pos <> second_pos").groupBy("item_id").agg(F.collect_set(F.struct("first_pos", "second_pos")).alias("pairs"))
        near = bands.where(F.size("seen") > 1).join(pairs, "item_id").where(F.exists(
            "pairs", lambda p: F.array_contains("seen", p["first_pos"]) & F.array_contains("seen", p["second_pos"])))
        return near.select("row_id", "item_id").distinct()

    def judged(self) -> DataFrame:
        """One row for each document: ``row_id, doc_id, text_key, n_words, n_hit, n_items, items, contaminated``."""
        phrases = stage(self.spark, self.phrases().distinct(), "phrases")
        items = phrases.groupBy("row_id").agg(F.sort_array(F.collect_set(F.substring_index("item_id", "\x01", 1))).alias("items"))
        # Length of the union of the occurrences of each document.
        w = Window.partitionBy("row_id").orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
        spans = phrases.select("row_id", "low", "high").distinct().withColumn("reach", F.coalesce(F.max("high").over(w), F.col("low")))
        hit = spans.groupBy("row_id").agg(F.sum(F.greatest(F.lit(0), F.col("high") - F.greatest("low", "reach"))).alias("n_hit"))
        found = stage(self.spark, hit.join(items, "row_id"), "found")
        held = self.documents.join(small(found, found.count(), 100_000), "row_id", "left")
        n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
        return held.select("row_id", "doc_id", "text_key", "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                           F.coalesce("items", F.array().cast("array<string>")).alias("items"), ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))

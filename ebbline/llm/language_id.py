"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of hashed n-grams are summed by language; the matrix of log-probabilities has a fixed number of
rows, one column for each language, and is broadcast; more than ``MAX_LANGUAGES`` languages stay a table of
counts and are broadcast and scored one block of columns after the other. Texts are scored in batches: the n-grams of a
batch form a sparse matrix in row order, multiplied with the log-probabilities by gathering and
summing over each document's stretch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm.common import hash_share, held_out, numbered, stage

BITS = 16
ORDERS = (1, 2, 3)
MAX_ROWS = 20_000
MAX_LANGUAGES = 256
BATCH_CHARS = 1 << 18
UNKNOWN = "und"


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")


def of_order(points: np.ndarray, order: int) -> np.ndarray:
    """Matrix rows of the n-grams of one order, by position; n-grams over a gap (code point 0) go to the empty row."""
    n = max(0, len(points) - order + 1)
    h, gap = np.full(n, order, np.uint32), np.zeros(n, bool)
    for j in range(order):
        part = points[j:j + n]
        h = (h ^ part) * np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
        gap |= part == 0
    rows = ((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int64)
    rows[gap] = 1 << BITS
    return rows


def hashed(points: np.ndarray) -> np.ndarray:
    return np.concatenate([of_order(points, order) for order in ORDERS])


def pieces(points: np.ndarray):
    """A long text in stretches, each with its start; they overlap, so that no n-gram is cut."""
    for at in range(0, max(1, len(points)), BATCH_CHARS):
        yield points[at:at + BATCH_CHARS + max(ORDERS) - 1], at


def counts_of(text: str) -> np.ndarray:
    """Number of n-grams on each row, over the whole text."""
    total = np.zeros((1 << BITS) + 1, np.int64)
    points = code_points(text)
    for part, at in pieces(points):
        total += np.bincount(hashed(part), minlength=len(total))
        if at:  # the seam's shorter n-grams were counted with the stretch before
            seam = points[at:at + max(ORDERS) - 1]
            total -= np.bincount(hashed(seam), minlength=len(total))
    return total[:-1]


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    log_probability: np.ndarray  # (2 ** BITS + 1, languages), the last row is zero
    log_prior: np.ndarray


@dataclass(frozen=True)
class Blocks:
    """A model of more languages than one matrix holds."""

    languages: tuple[tuple[str, int], ...]  # in order of names, with their rows
    counts: DataFrame  # (lang, row, n)
    smoothing: float

    def models(self) -> Iterator[Model]:
        for start in range(0, len(self.languages), MAX_LANGUAGES):
            part = [lang for lang, _ in self.languages[start:start + MAX_LANGUAGES]]
            yield matrix_of(self.languages, part, self.counts.where(F.col("lang").isin(part)), self.smoothing)


def matrix_of(sizes: tuple[tuple[str, int], ...], languages: list[str], counts: DataFrame, smoothing: float) -> Model:
    """Matrix of some languages; the priors are those among all of ``sizes``."""
    summed = counts.toArrow().to_pandas()
    matrix = np.full((1 << BITS, len(languages)), smoothing)
    column = {lang: i for i, lang in enumerate(languages)}
    matrix[summed["row"].to_numpy(np.int64), summed["lang"].map(column).to_numpy(np.int64)] += summed["n"].to_numpy()
    table = np.vstack([np.log(matrix / matrix.sum(axis=0)), np.zeros(len(languages))]).astype(np.float32)
    weight = dict(sizes)
    every = np.logaddexp.reduce(np.log(np.array([n for _, n in sizes], float)))
    return Model(tuple(languages), table, np.log(np.array([weight[x] for x in languages], float)) - every)


def fit(spark: SparkSession, docs: DataFrame, max_rows: int = MAX_ROWS, smoothing: float = 0.5, seed: int = 5) -> Model | Blocks:
    """Fit on ``docs(doc_id, text, lang)`` outside the held-out third, at most about ``max_rows`` rows of each language.

    The rows of a language are drawn by a hash of the id. Null ids count as not held out; null texts and languages are
    passed over. More than ``MAX_LANGUAGES`` languages give ``Blocks``; only their names and numbers of rows come to the driver.
    """
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), "text").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    by_lang = rows.groupBy("lang").count()
    sizes = by_lang.collect()
    if not sizes:
        return Model((), np.zeros(((1 << BITS) + 1, 0), np.float32), np.zeros(0))
    if len(sizes) > MAX_LANGUAGES:
        sample = rows.join(by_lang, "lang").where(hash_share("doc_id", seed) < max_rows / F.col("count"))
    else:
        share = F.create_map(*[x for r in sizes for x in (F.lit(r.lang), F.lit(max_rows / r["count"]))])
        sample = rows.where(hash_share("doc_id", seed) < share[F.col("lang")])

    def listed(total):
        for lang, held in total.items():
            at = np.flatnonzero(held)
            yield pd.DataFrame({"lang": lang, "row": at, "n": held[at]})

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.lang, batch.text):
                if lang not in total and len(total) >= MAX_LANGUAGES:
                    yield from listed(total)
                    total = {}
                held = total.setdefault(lang, np.zeros(1 << BITS, np.int64))
                held += counts_of(text)
        yield from listed(total)

    summed = sample.select("lang", "text").mapInPandas(count, "lang string, row int, n long").groupBy("lang", "row").agg(F.sum("n").alias("n"))
    counted = tuple(sorted((r.lang, r["count"]) for r in sizes))
    if len(counted) > MAX_LANGUAGES:
        return Blocks(counted, stage(spark, summed, "language_counts"), smoothing)
    return matrix_of(counted, [lang for lang, _ in counted], summed, smoothing)


def score_batch(model: Model, texts: list[str]) -> np.ndarray:
    """Joint log-probability of each text and language, over whole texts."""
    out = np.tile(model.log_prior, (len(texts), 1))
    stretch, owner, held = [], [], 0
    gap = np.zeros(max(ORDERS), "<u4")

    def flush():
        nonlocal stretch, owner, held
        if stretch:
            points = np.concatenate([x for part in stretch for x in (part, gap)])
            ends = np.cumsum([len(part) + len(gap) for part in stretch])
            starts = np.append(0, ends[:-1])
            for order in ORDERS:
                rows = of_order(points, order)
                out_part = np.add.reduceat(model.log_probability[rows], np.minimum(starts, len(rows) - 1), axis=0, dtype=np.float64)
                np.add.at(out, owner, out_part)
        stretch, owner, held = [], [], 0

    for i, text in enumerate(texts):
        points = code_points(text)
        for part, at in pieces(points):
            if at:
                seam = hashed(points[at:at + max(ORDERS) - 1])
                out[i] -= model.log_probability[seam].sum(axis=0, dtype=np.float64)
            stretch.append(part)
            owner.append(i)
            held += len(part)
            if held >= BATCH_CHARS:
                flush()
    flush()
    return out


def identify_by_blocks(spark: SparkSession, docs: DataFrame, model: Blocks) -> DataFrame:
    """``identify`` with one pass for each block: its best language and the sum of its probabilities, then the best of all."""
    usable = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = numbered(spark, docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(usable, F.col("text")).alias("text")), "language_texts")
    parts = []
    for block, held in enumerate(model.models()):
        shared = spark.sparkContext.broadcast(held)

        def score(batches, shared=shared):
            for batch in batches:
                joint = score_batch(shared.value, batch.text.tolist())
                best = joint.argmax(axis=1)
                yield pd.DataFrame({"row_id": batch.row_id, "lang": [shared.value.languages[i] for i in best], "joint": joint.max(axis=1),
                                    "total": np.logaddexp.reduce(joint, axis=1)})

        scored = rows.where("text is not null").select("row_id", "text").mapInPandas(score, "row_id long, lang string, joint double, total double")
        parts.append(stage(spark, scored.withColumn("place", F.lit(-block)), "language_block"))
        shared.destroy()
    best = reduce(DataFrame.unionByName, parts).groupBy("row_id").agg(
        F.max(F.struct("joint", "place", "lang")).alias("best"), F.collect_list("total").alias("totals"))
    share = 1 / F.aggregate("totals", F.lit(0.0), lambda sum_, x: sum_ + F.exp(x - F.col("best.joint")))
    return rows.select("row_id", "doc_id").join(best, "row_id", "left").select(
        "doc_id", F.coalesce("best.lang", F.lit(UNKNOWN)).alias("lang_pred"), F.coalesce(share, F.lit(0.0)).alias("score"))


def identify(spark: SparkSession, docs: DataFrame, model: Model | Blocks) -> DataFrame:
    """``doc_id, lang_pred, score``: the likeliest language of each text and its posterior probability.

    Null texts, texts without a letter, and all texts when nothing was learned are ``und`` with score 0. Rows repeat as given;
    other columns are ignored.
    """
    if isinstance(model, Blocks):
        return identify_by_blocks(spark, docs, model)
    shared = spark.sparkContext.broadcast(model)

    def score(batches):
        held = shared.value
        for batch in batches:
            ids, langs, scores = batch.doc_id.tolist(), [UNKNOWN] * len(batch), [0.0] * len(batch)
            at = [i for i, ok in enumerate(batch.usable) if ok and held.languages]
            if at:
                joint = score_batch(held, [batch.text.iloc[i] for i in at])
                joint -= joint.max(axis=1, keepdims=True)
                share = np.exp(joint)
                share /= share.sum(axis=1, keepdims=True)
                for i, best, p in zip(at, share.argmax(axis=1), share.max(axis=1)):
                    langs[i], scores[i] = held.languages[best], float(p)
            yield pd.DataFrame({"doc_id": pd.array([None if pd.isna(i) else int(i) for i in ids], dtype="Int64"), "lang_pred": langs, "score": scores})

    usable = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", usable.alias("usable")).mapInPandas(score, "doc_id long, lang_pred string, score double")

"""Source divergence audit: which sources of a language differ from each other and from the language.

Each task sorts pointers to the word starts of its Arrow buffers. The sort is a multikey quicksort with keys of eight bytes:
pointers are ordered by the key at the present depth, and only runs of equal keys whose words go on are ordered again by the
next eight bytes. A run of equal words gives their count for each source and the documents that hold them. Only these
counts are shuffled. Term weights are exact integers; pairs of sources are compared in blocks of terms.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm.common import docs_column, stage

SLICE_BYTES = 8 << 20
BLOCK_CELLS = 1 << 15
TILE = 256
LEAST_DOCS = 30
TOP_TERMS = 50
COUNTS = "lang string, source string, term string, n long, df long"

# fixed values: bytes of a word in UTF-8 (letters A-Z, a-z and everything above 7F), and A-Z lower-cased
WORD = np.zeros(256, bool)
WORD[0x41:0x5B] = WORD[0x61:0x7B] = WORD[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def word_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and length of every word; a word ends with its document."""
    inside = WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] |= inside[edges]
    last[edges - 1] |= inside[edges - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1 - starts


def keys_at(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, depth: int) -> np.ndarray:
    """Eight bytes of each word from ``depth`` on as one number, zeros behind its end. ``data`` has eight bytes to spare."""
    windows = np.lib.stride_tricks.sliding_window_view(data, 8)
    keys = windows[starts + depth].view(">u8").astype(np.uint64).ravel()
    spare = (8 - np.clip(lengths - depth, 0, 8)).astype(np.uint64) * np.uint64(8)
    return np.where(spare == 64, np.uint64(0), (keys >> np.minimum(spare, np.uint64(63))) << np.minimum(spare, np.uint64(63)))


def sort_pointers(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the words, and for each place in it the number of its run of equal words."""
    n = len(starts)
    order, run = np.arange(n), np.zeros(n, np.int64)
    active, depth = np.arange(n), 0  # places whose run may still hold different words
    while len(active):
        at = order[active]
        keys = keys_at(data, starts[at], lengths[at], depth)
        by = np.lexsort((keys, run[active])) if depth else np.argsort(keys, kind="quicksort")
        order[active] = at[by]
        keys, runs = keys[by], run[active]
        differs = np.zeros(n, np.int64)
        differs[active[1:]] = (keys[1:] != keys[:-1]) & (runs[1:] == runs[:-1])
        run = run + np.cumsum(differs)
        depth += 8
        longer = np.bincount(run[active], lengths[order[active]] > depth, int(run[-1]) + 1) > 0  # words that end here stay with those that go on
        active = active[longer[run[active]] & (np.bincount(run)[run[active]] > 1)]
    return order, run


def slice_counts(texts: pa.Array, groups: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of a slice, and for each word and group of documents: word, group, count, documents."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32 if texts.type == pa.string() else np.int64)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    held = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    data, offsets = LOWER[held], offsets - offsets[0]
    starts, lengths = word_starts(data, offsets)
    none = np.zeros(0, np.int64)
    if not len(starts):
        return [], none, none, none, none
    data = np.concatenate([data, np.zeros(int(lengths.max()) + 16, np.uint8)])
    order, run = sort_pointers(data, starts, lengths)
    firsts = order[np.flatnonzero(np.diff(run, prepend=-1))]
    text = data.tobytes()
    words = [text[starts[i]:starts[i] + lengths[i]].decode("utf-8", "replace") for i in firsts]
    doc = np.searchsorted(offsets, starts[order], "right") - 1
    many = int(groups.max()) + 1
    cell = run * many + groups[doc]
    cells, counts = np.unique(cell, return_counts=True)
    held_in = np.unique(run * len(texts) + doc)  # one for each word and document
    docs = np.bincount(np.searchsorted(cells, held_in // len(texts) * many + groups[held_in % len(texts)]), minlength=len(cells))
    return words, cells // many, cells % many, counts, docs


def term_counts(docs: DataFrame) -> DataFrame:
    """``COUNTS``: occurrences and documents of each term in each source of a language.

    Each occurring pair of language and source also has a row with a null term. Null text, lang and source read as ''.
    """
    part = [F.coalesce(docs_column(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]

    limit = SLICE_BYTES

    def count(batches):
        for batch in batches:
            lang, source = batch.column(1), batch.column(2)
            codes: dict[tuple, int] = {}
            groups = np.array([codes.setdefault(p, len(codes)) for p in zip(lang.to_pylist(), source.to_pylist())], np.int64)
            names = list(codes)
            ends = np.cumsum(pa.compute.binary_length(batch.column(0)).to_numpy(zero_copy_only=False))
            at = 0
            while at < len(groups):  # slices of whole documents, of a bounded number of bytes unless one document is longer
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
                words, word, group, n, df = slice_counts(batch.column(0).slice(at, to - at), groups[at:to])
                yield _rows(names, words, word, group, n, df)
                at = to
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([p[0] for p in names], pa.string()), "source": pa.array([p[1] for p in names], pa.string()), "term": pa.nulls(len(names), pa.string()),
                "n": pa.array([0] * len(names), pa.int64()), "df": pa.array([0] * len(names), pa.int64())})

    raw = docs.select(*part).mapInArrow(count, COUNTS)
    return raw.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def _rows(names: list[tuple], words: list[str], word, group, n, df) -> pa.RecordBatch:
    lang, source = (pa.array([p[i] for p in names], pa.string()).take(pa.array(group)) for i in (0, 1))
    return pa.RecordBatch.from_pydict({"lang": lang, "source": source, "term": pa.array(words, pa.string()).take(pa.array(word)),
                                       "n": pa.array(n, pa.int64()), "df": pa.array(df, pa.int64())})


def weight(count: str, total: str, terms: str):
    """``1 + floor(1000000000 * (count + 5) / (total + 5 * terms))`` in exact integers."""
    over = f"(cast({count} as decimal(20,0)) + 5) * 1000000000BD"
    return F.expr(f"1L + ({over}) div (cast({total} as decimal(20,0)) + 5 * cast({terms} as decimal(18,0)))")


def audit(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank``; see ``kept_terms``, ``pairs`` and ``top_terms``.

    Each row is a document, repeated rows too. Null and empty texts hold no term but their source takes part; very long texts
    are one slice of their own. Ties are ranked by item. An empty table gives no rows; extra columns are ignored. Numbers
    of terms and of sources of a language are not bounded.
    """
    counts = stage(spark, term_counts(docs), "term_counts")
    kept, roster = kept_terms(spark, counts)
    return pairs(kept, roster).unionByName(top_terms(kept, roster))


def kept_terms(spark: SparkSession, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Terms in at least 30 documents of their language, by source, with ``q``; and the sources with their totals.

    ``kept(lang, term, source, n, lang_n)``; ``roster(lang, source, place, sources, total, lang_total, terms)``.
    """
    of_term = "OVER (PARTITION BY lang, term)"
    kept = stage(spark, counts.where("term is not null").select(
        "*", F.expr(f"sum(df) {of_term}").alias("lang_df"), F.expr(f"sum(n) {of_term}").alias("lang_n"),
        F.expr(f"min(source) {of_term}").alias("_least")).where(F.col("lang_df") >= LEAST_DOCS), "kept_terms")
    by_source = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_lang = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if(F.col("source") == F.col("_least")).alias("terms"))
    every = counts.where("term is null").select("lang", "source")
    roster = every.join(by_source, ["lang", "source"], "left").join(by_lang, "lang", "left").na.fill(0, ["total", "lang_total", "terms"])
    placed = roster.select("*", F.expr("row_number() OVER (PARTITION BY lang ORDER BY source) - 1").alias("place"), F.expr("count(*) OVER (PARTITION BY lang)").alias("sources"))
    return kept.drop("_least", "lang_df", "df"), stage(spark, placed, "sources")


def pairs(kept: DataFrame, roster: DataFrame) -> DataFrame:
    """Part ``pair``: the summed difference of term weights of each two sources of a language, all ranks.

    Terms of a language are dealt to blocks and sources to tiles of 256, so a task holds the weights of two tiles for one
    block of terms; a term that a source lacks has that source's least weight.
    """
    wide = F.least("sources", F.lit(TILE))  # a block gives a row for each two sources, so it is to hold some times as many weights
    blocks = F.greatest(F.lit(1), F.ceil(F.col("terms") * wide / F.greatest(F.lit(BLOCK_CELLS), 4 * wide * wide))).cast("int")
    tiles = F.ceil(F.col("sources") / F.lit(TILE)).cast("int")
    known = roster.where("sources > 1").select(
        "lang", "source", "place", "total", "terms", blocks.alias("blocks"), tiles.alias("tiles"), F.floor(F.col("place") / TILE).cast("int").alias("tile"),
        F.when(F.col("terms") > 0, weight("0", "total", "terms")).otherwise(F.lit(0)).alias("least"))
    each = F.explode(F.expr("transform(sequence(0, tiles - 1), t -> struct(least(t, tile) as low, greatest(t, tile) as high))")).alias("pair")
    rows = kept.join(known, ["lang", "source"]).select(
        "lang", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), each, "place", "term", weight("n", "total", "terms").alias("p"))
    names = known.select("lang", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), "tiles", "tile", "place", "least", "terms").select("lang", "block", each, "place", "least", "terms")

    width = TILE

    def unit(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        place = np.sort(right.place.to_numpy(np.int64))
        low, high = right["low"].iloc[0], right["high"].iloc[0]
        least = right.set_index("place")["least"].reindex(place).to_numpy(np.int64)
        number, terms = pd.factorize(left.term)
        cells = np.repeat(least[:, None], len(terms), axis=1)
        cells[np.searchsorted(place, left["at"].to_numpy(np.int64)), number] = left.p.to_numpy(np.int64)
        tile = place // width
        # terms that no source of the two tiles holds: all terms, added by the first block, less those seen here
        unseen = (int(right.terms.iloc[0]) if right.block.iloc[0] == 0 else 0) - len(terms)
        a, b = np.flatnonzero(tile == low), np.flatnonzero(tile == high)
        out = []
        for i in a:
            other = b[b > i]
            value = np.abs(cells[other] - cells[i]).sum(1) + unseen * np.abs(least[other] - least[i])
            out.append(pd.DataFrame({"lang": right.lang.iloc[0], "a": place[i], "b": place[other], "value": value}))
        return pd.concat(out) if out else pd.DataFrame({"lang": [], "a": [], "b": [], "value": []})

    left = rows.select("lang", "block", "pair.low", "pair.high", F.col("place").cast("long").alias("at"), "term", "p").groupBy("lang", "block", "low", "high")
    right = names.select("lang", "block", "pair.low", "pair.high", "place", "least", "terms").groupBy("lang", "block", "low", "high")
    found = left.cogroup(right).applyInPandas(unit, "lang string, a long, b long, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = found.union(found.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    name = lambda place, alias: roster.select("lang", F.col("place").cast("long").alias(place), F.col("source").alias(alias))
    named = both.join(name("a", "source"), ["lang", "a"]).join(name("b", "item"), ["lang", "b"])
    return named.select("lang", "source", F.lit("pair").alias("part"), "item", "value",
                        F.expr("row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)").alias("rank"))


def top_terms(kept: DataFrame, roster: DataFrame) -> DataFrame:
    """Part ``term``: the terms that a source uses more than its language does, by the difference of the weights; the first 50."""
    rows = kept.join(roster, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), weight("n", "total", "terms").alias("p"), weight("lang_n", "lang_total", "terms").alias("q"))
    ranked = rows.where("p > q").select("lang", "source", F.lit("term").alias("part"), "item", (F.col("p") - F.col("q")).alias("value")).select(
        "*", F.expr("row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)").alias("rank"))
    return ranked.where(F.col("rank") <= TOP_TERMS)


def oracle() -> str:
    """The contract as DuckDB SQL."""
    return r"""
    WITH d AS (SELECT row_number() OVER () AS r, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t,
                      coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
    w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    k AS (SELECT lang, term, CAST(COUNT(*) AS HUGEINT) AS ln FROM w GROUP BY ALL HAVING COUNT(DISTINCT r) >= 30),
    c AS (SELECT w.lang, w.source, w.term, CAST(COUNT(*) AS HUGEINT) AS n FROM w JOIN k ON k.lang = w.lang AND k.term = w.term GROUP BY ALL),
    v AS (SELECT lang, CAST(COUNT(*) AS HUGEINT) AS v, SUM(ln) AS lt FROM k GROUP BY lang),
    g AS (SELECT DISTINCT lang, source FROM d),
    tot AS (SELECT g.lang, g.source, CAST(coalesce(SUM(c.n), 0) AS HUGEINT) AS total FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
    full_ AS (SELECT tot.lang, tot.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (tot.total + 5 * v.v) AS p,
                    1 + (1000000000 * (k.ln + 5)) // (v.lt + 5 * v.v) AS q
             FROM tot JOIN v ON v.lang = tot.lang JOIN k ON k.lang = tot.lang LEFT JOIN c ON c.lang = tot.lang AND c.source = tot.source AND c.term = k.term),
    pv AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
           LEFT JOIN (SELECT x.lang, x.source, y.source AS item, SUM(abs(x.p - y.p)) AS value FROM full_ x JOIN full_ y ON x.lang = y.lang AND x.term = y.term
                      AND x.source <> y.source GROUP BY ALL) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
    tv AS (SELECT lang, source, term AS item, p - q AS value, row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term) AS rank FROM full_ WHERE n > 0 AND p > q)
    SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INT) AS rank FROM pv
    UNION ALL SELECT lang, source, 'term', item, CAST(value AS BIGINT), CAST(rank AS INT) FROM tv WHERE rank <= 50"""

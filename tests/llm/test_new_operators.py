"""Operators 11 to 13 against plain versions, over odd small tables and over empty ones."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from check import compare, duck
from ebbline.llm import divergence, queries, sharding, whitening
from tests.llm import brute


def rows(spark, name, folder):
    return queries.QUERIES[name](spark, folder).collect()


# ---- op11 ------------------------------------------------------------------------------------
def test_pointer_sort_orders_words_as_bytes_and_numbers_runs_of_equal_words():
    draw = random.Random(1)
    words = ["".join(draw.choice("ab") for _ in range(draw.randint(1, 30))) for _ in range(400)] + ["abcdefgh", "abcdefghij", "abcdefgh", "é" * 9, "é" * 4]
    draw.shuffle(words)
    data = np.frombuffer(" ".join(words).encode() + b"\0" * 40, np.uint8)
    starts, lengths = divergence.word_starts(data[:-40], np.array([0, len(data) - 40]))
    assert len(starts) == len(words)
    order, run = divergence.sort_pointers(data, starts, lengths)
    got = [words[i] for i in order]
    assert got == sorted(words, key=str.encode)
    assert all((run[i] == run[i + 1]) == (got[i] == got[i + 1]) for i in range(len(got) - 1))


def test_words_end_with_their_document():
    texts = pa.array(["ab", "cd", "", "ef ab"])
    words, word, group, n, df = divergence.slice_counts(texts, np.array([0, 1, 1, 0]))
    assert {(words[w], g): (c, d) for w, g, c, d in zip(word, group, n, df)} == {("ab", 0): (2, 2), ("cd", 1): (1, 1), ("ef", 0): (1, 1)}


def test_op11_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    ok, n, message = compare(spark, duck(folder), folder, "op11", queries.QUERIES["op11_source_divergence"], queries.ORACLES["op11_source_divergence"])
    assert ok and n, message


def test_op11_edge(spark, edge):
    got = Counter(tuple(r) for r in rows(spark, "op11_source_divergence", edge["dir"]))
    assert got == Counter(brute.divergence([d[1:] for d in edge["docs"]]))


def test_op11_many_slices_tiles_and_blocks(spark, edge, monkeypatch):
    for name, value in (("SLICE_BYTES", 300), ("BLOCK_CELLS", 7), ("TILE", 2), ("LEAST_DOCS", 3)):
        monkeypatch.setattr(divergence, name, value)
    monkeypatch.setattr(brute, "LEAST_DOCS", 3)
    got = Counter(tuple(r) for r in rows(spark, "op11_source_divergence", edge["dir"]))
    assert got == Counter(brute.divergence([d[1:] for d in edge["docs"]]))
    assert any(r[2] == "term" for r in got)


# ---- op12 ------------------------------------------------------------------------------------
def test_op12(spark, edge):
    usable = [(i, v) for i, v in edge["vectors"] if v and all(x is not None and np.isfinite(x) for x in v)]
    got = defaultdict(list)
    for r in rows(spark, "op12_whitening", edge["dir"]):
        got[r.vec_id, r.n].append(r)
    for dim in {len(v) for _, v in usable}:
        own = [(i, [int(np.floor(64 * np.float64(np.float32(x)))) + 10**6 for x in v]) for i, v in usable if len(v) == dim]
        fit = sorted({tuple(x) for _, x in own})
        n, sums = len(fit), [sum(c) for c in zip(*fit)]
        if n == 1:
            assert not [k for k in got if k[1] == 1]
            continue
        centred = np.array([[n * c - s for c, s in zip(x, sums)] for x in fit], np.float64) / n
        values, vectors = np.linalg.eigh(centred.T @ centred / n)
        values, vectors = values[::-1], vectors[:, ::-1]
        for (i, x), copies in Counter((i, tuple(x)) for i, x in own).items():
            mine = [r for r in got[i, n] if r.deviation == sum((n * c - s) ** 2 for c, s in zip(x, sums))]
            assert len(mine) == 16 * copies
            y = (np.array([n * c - s for c, s in zip(x, sums)], np.float64) / n) @ vectors / np.sqrt(np.maximum(values, 1e-300))
            for r in mine:
                assert abs(abs(r.whitened) - abs(y[r.component - 1])) < 1e-9 * (1 + abs(y[r.component - 1]))
                assert abs(r.explained - values[r.component - 1] / values.sum()) < 1e-10 and r.identity_error < 1e-9


def vectors_of(spark, table):
    return spark.createDataFrame(table, "vec_id long, embedding array<double>, n int, x string")


@pytest.mark.parametrize("case", ["repeated eigenvalues", "low rank", "wide spread", "one row", "equal rows"])
def test_op12_hard_spectra(spark, case):
    draw = np.random.default_rng(4)
    if case == "repeated eigenvalues":  # every axis alike: one start direction alone finds one component
        x = np.vstack([np.eye(20) * 8, -np.eye(20) * 8])
    elif case == "low rank":
        x = np.round(draw.normal(size=(200, 3)) * 50) @ np.round(draw.normal(size=(3, 20)) * 3)
    elif case == "wide spread":
        x = draw.normal(size=(300, 20)) * np.logspace(0, 5, 20)
    else:
        x = np.ones((1 if case == "one row" else 5, 20))
    got = whitening.whiten(spark, vectors_of(spark, [(i, v.tolist(), 1, "a") for i, v in enumerate(x)])).collect()
    rank = {"repeated eigenvalues": 16, "low rank": 3, "wide spread": 16}.get(case, 0)
    assert len(got) == len(x) * rank
    if rank:
        cells = np.floor(64 * x)
        cells = cells - cells.mean(0)
        values = np.sort(np.linalg.eigvalsh(cells.T @ cells / len(x)))[::-1]
        share = {r.component: r.explained for r in got}
        assert all(abs(share[i + 1] / (values[i] / values.sum()) - 1) < 1e-7 for i in range(rank))
        assert {r.identity_error < 1e-6 for r in got} == {True}


def test_op12_large_entries_are_bounded(spark):
    got = whitening.whiten(spark, vectors_of(spark, [(1, [1e30, 0.0], 1, "a"), (2, [-1e300, 1.0], 1, "a"), (3, [0.0, 2.0], 1, "a")])).collect()
    assert len(got) == 3 and {r.deviation for r in got if r.vec_id < 3} == {None}


# ---- op13 ------------------------------------------------------------------------------------
def groups_of(texts):
    held = Counter()
    for t in texts:
        data = (t or "").encode()
        h = xxhash.xxh64_intdigest(data, 42)
        held[h - (1 << 64) if h >= 1 << 63 else h] += len(data) + 16
    return held


def least_capacity(sizes, shards):
    """The smallest feasible capacity, by trying the sum of every run of groups."""
    def shards_for(c):
        n, left = 0, 0
        for s in sizes:
            if s > left:
                n, left = n + 1, c
            left -= s
        return n
    ends = np.concatenate([[0], np.cumsum(sizes)])
    sums = np.unique((ends[:, None] - ends[None, :])[np.tril_indices(len(ends), -1)])
    return next(int(c) for c in sums if c >= max(sizes) and shards_for(c) <= shards)


def check_shards(got, docs, shards):
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in docs)
    slots, held = defaultdict(list), Counter()
    for r in got:
        slots[r.shard].append(r.slot)
        held[r.shard] += r["size"]
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    place, texts = defaultdict(set), defaultdict(set)
    for d, t in docs:
        texts[d].add((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())))
    for r in got:
        place[r["size"], r.text_crc32].add(r.shard)
    assert all(len(p) == 1 for p in place.values())
    return held


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_op13(spark, edge, shards):
    docs = [(d, t) for d, t, _, _ in edge["docs"]]
    got = sharding.shard_documents(spark, queries.table(spark, edge["dir"], "documents"), shards).collect()
    check_shards(got, docs, shards)


def plain(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_op13_capacity_is_the_least(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST_BITS", 2)  # several rounds of refinement
    monkeypatch.setattr(sharding, "CELLS_PER_ROUND", 64)
    draw = random.Random(2)
    texts = ["".join(draw.choice("abc") for _ in range(draw.randint(0, 300))) for _ in range(900)]
    held = groups_of(texts)
    rows = sharding.sized(plain(spark, texts))
    from pyspark.sql import functions as F
    groups = rows.groupBy("h").agg(F.sum(F.col("size") * F.col("copies")).alias("bytes"))
    assert {r.h: r.bytes for r in groups.collect()} == held
    plan = sharding.plan_shards(groups, 7)
    assert plan.alone == [] and plan.capacity == least_capacity([held[h] for h in sorted(held)], 7)
    got = check_shards(sharding.shard_documents(spark, plain(spark, texts), 7).collect(), list(enumerate(texts)), 7)
    assert max(got.values()) <= plan.capacity and min(got.values()) > 0.98 * max(got.values())


def test_op13_hot_group_and_hot_row(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOTS_PER_BUCKET", 50)
    texts = ["hot text " * 4] * 700 + [f"text {i}" for i in range(1400)]
    docs = [(None if i < 350 else i, t) for i, t in enumerate(texts)]
    got = sharding.shard_documents(spark, spark.createDataFrame(docs, "doc_id long, text string"), 8).collect()
    held = check_shards(got, docs, 8)
    assert held[0] == 700 * 52 and len(held) == 8
    others = [held[i] for i in range(1, 8)]
    assert max(others) - min(others) < 0.02 * max(others)


def test_empty_tables(spark, empty):
    for name in ("op11_source_divergence", "op12_whitening", "op13_sharding"):
        assert rows(spark, name, empty) == []


def test_op13_is_native(spark, edge):
    plan = queries.QUERIES["op13_sharding"](spark, edge["dir"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan

"""What the queries do not show: undoing, random access, proximity, discovered patterns, long inputs."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline.llm import common, decontaminate, language_id, line_dedup, mixing, ngram_join, pii, queries, rule_ensemble, token_files, topk, url_filters
from tests.llm import brute


def test_cuckoo_filter_inserts_and_deletes():
    keys = [hashlib.blake2b(str(i).encode(), digest_size=16).digest() for i in range(3000)]
    held = line_dedup.CuckooFilter.of(keys[:2000])
    assert held.has(keys[:2000]).all() and held.has(keys[2000:]).mean() < 0.01
    assert all(held.delete(k) for k in keys[:1000])
    again = line_dedup.CuckooFilter.read(held.bytes())
    assert again.has(keys[1000:2000]).all() and again.has(keys[:1000]).mean() < 0.02


def state(index):
    counts = Counter((bytes(r.digest), r.n, r.top) for r in index.counts.collect())
    repeated = [k for k, n, _ in counts if n >= index.min_docs]
    held = {r.shard: line_dedup.CuckooFilter.read(bytes(r.filter)) for r in index.filters.collect()}
    assert all(held[line_dedup.shard_number(k, index.shards)].has([k])[0] for k in repeated)
    marks = sum(int((f.table > 0).sum()) for f in held.values())
    assert marks == len(repeated)
    return counts, Counter(tuple(r) for r in index.references.collect())


def test_line_dedup_is_reversible(spark, edge):
    docs = queries.table(spark, edge["dir"], "documents").where("doc_id is not null")
    some, rest = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")
    first = line_dedup.LineIndex.build(spark, some)
    both = first.insert(rest)
    whole = line_dedup.LineIndex.build(spark, docs)
    assert state(both) == state(whole)
    assert Counter(map(tuple, both.dedup(docs).collect())) == Counter(map(tuple, whole.dedup(docs).collect()))
    assert state(both.delete(rest.select("doc_id"))) == state(first)


def test_token_files_give_single_documents(spark, edge):
    docs = queries.table(spark, edge["dir"], "documents").dropDuplicates(["doc_id"])
    manifest = token_files.write_tokens(spark, docs, queries.tokenizer_path(), frame_tokens=500)
    assert manifest.agg(F.sum("n_frames")).first()[0] > 5
    from tokenizers import Tokenizer

    model, texts = Tokenizer.from_file(queries.tokenizer_path()), {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    ids = [i for i in texts if i is not None][:4]
    got = {r.doc_id: r.tokens for r in token_files.fetch_documents(spark, manifest, ids + [10**9]).collect()}
    assert got == {i: model.encode(texts[i] or "", add_special_tokens=False).ids + [1] for i in ids}


def test_a_damaged_frame_is_refused(tmp_path):
    path = tmp_path / "x.zst"
    writer = token_files.ShardWriter(open(path, "wb"), 10, 3)
    for i in range(9):
        writer.add(i, np.arange(i, dtype="<u4").tobytes())
    writer.close()
    reader = token_files.ShardReader(f"file://{path}")
    assert [reader.frame(k)[1] for k in range(len(reader.entries))][0][0] == 0
    reader.entries[0, 2] ^= 1
    with pytest.raises(ValueError):
        reader.frame(0)


def test_proximity_finds_what_phrases_do_not(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu nu xi"
    docs = spark.createDataFrame([(1, "x " + item), (2, item.replace("gamma", "gamma one two")), (3, "alpha nu")], "doc_id long, text string")
    matcher = decontaminate.Matcher(spark, docs, spark.createDataFrame([(7, item)], "item_id long, text string"))
    ids = {r.row_id: r.doc_id for r in matcher.documents.collect()}
    assert {ids[r.row_id] for r in matcher.phrases().collect()} == {1}
    assert {ids[r.row_id] for r in matcher.proximity(4).collect()} >= {1, 2}


def test_items_without_an_id_contaminate(spark):
    items = ["alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu nu xi", "one two three"]
    docs = [(1, items[0]), (2, items[1]), (3, f"{items[0]} {items[1]}"), (4, "nothing of it")]
    benchmark = [(None, items[0]), (None, items[1]), (None, items[1]), (None, None), (7, items[1])]
    judged = decontaminate.Matcher(spark, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(benchmark, "item_id long, text string")).judged()
    named = ["null:" + hashlib.md5(t.encode()).hexdigest() for t in items]
    got = {r.doc_id: (r.n_hit, r.n_items, list(r["items"]), r.contaminated) for r in judged.collect()}
    assert got == {1: (14, 1, [named[0]], True), 2: (3, 2, sorted(["7", named[1]]), True),
                   3: (17, 3, sorted(["7", *named]), True), 4: (0, 0, [], False)}


def test_patterns_discover_identifiers_that_seeds_miss(spark):
    rows = [(i, f"some words write to address user{i}@mail{i}.example.org today") for i in range(12)]
    rows += [(100, "please write to address joe@localhost soon"), (101, "year 2024x nothing joe@nowhere")]
    found = {r.doc_id: r for r in pii.find_pii(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = rows[12][1]
    assert [(s.kind, text[s.start:s.end]) for s in found[100].spans] == [("email", "joe@localhost")] and not found[100].base
    assert not found[101].spans and all(len(found[i].spans) == 1 for i in range(12))


def test_knapsack_is_exact():
    draw = random.Random(1)
    for _ in range(60):
        lengths = np.array(sorted(draw.sample(range(1, 30), 4)))
        counts = np.array([draw.randint(0, 3) for _ in lengths])
        budget = draw.randint(0, 60)
        take = mixing.knapsack(lengths, counts, budget)
        best = max(s for c in itertools.product(*[range(n + 1) for n in counts]) if (s := int((np.array(c) * lengths).sum())) <= budget)
        assert (take <= counts).all() and int((take * lengths).sum()) == best


def test_large_budgets_are_met():
    lengths, counts = np.arange(3, 900), np.full(897, 50)
    take = mixing.fit_counts(lengths, counts, 7_654_321, 3)
    assert (take >= 0).all() and (take <= counts).all() and int((lengths * take).sum()) == 7_654_321


def test_budgets_are_met_from_the_nearer_side():
    draw = random.Random(7)
    for turn in range(80):
        lengths = np.array(sorted(draw.sample(range(1, 40) if turn % 2 else range(3000, 90_000), draw.randint(1, 5))))
        counts = np.array([draw.randint(1, 3) for _ in lengths])
        budget = draw.uniform(0, float((lengths * counts).sum()))
        take = mixing.fit_counts(lengths, counts, budget, turn)
        nearest = min(abs(int((np.array(c) * lengths).sum()) - budget) for c in itertools.product(*[range(n + 1) for n in counts]))
        assert (take >= 0).all() and (take <= counts).all() and abs(int((take * lengths).sum()) - budget) == nearest


def test_sources_of_one_document_are_taken_as_often_as_is_nearest(spark):
    rows = [(i, " ".join(["w"] * 40), f"s{i:03d}") for i in range(30)]
    mixed = mixing.mix(spark, spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert [r.copies for r in sorted(mixed, key=lambda r: r.doc_id)] == [2, 1, 0] * 10


def test_components(spark):
    draw = random.Random(2)
    edges = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(220)] + [(1000, i) for i in range(1001, 1100)] + [(i, i + 1) for i in range(2000, 2060)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.node: r.component for r in common.components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if sum(find(x) == find(y) for y in root) > 1}


def test_blocked_product_equals_sets():
    draw = np.random.default_rng(4)
    xs = [np.unique(draw.integers(0, 2**63, 80).astype(np.uint64) * np.uint64(2)) for _ in range(40)]
    ys = [np.unique(np.concatenate([x[draw.random(len(x)) > 0.08], draw.integers(0, 2**63, 3).astype(np.uint64)])) for x in xs]
    got = ngram_join.overlaps([x.view(np.int64) for x in xs], [y.view(np.int64) for y in ys], 90)
    assert got.tolist() == [100 * len(np.intersect1d(x, y)) >= 90 * len(np.union1d(x, y)) for x, y in zip(xs, ys)]
    assert got.any() and not got.all()


def test_candidate_rules_are_tried_outside_the_plan(spark):
    low = float("-inf")
    rules = [rule_ensemble.Rule(b) for b in (((0, 2.0, 4.0),), ((0, low, 2.0), (1, 3.0, float("inf"))), ((14, low, 0.5),), ())]
    texts = [(t,) for t in (None, "", "a b", "a bb ccc", "long words here only", "x\ny\nz", "one two three four five")]
    sample = spark.createDataFrame(texts, "text string").select(rule_ensemble.statistics().alias("s"))
    rows = sample.select(rule_ensemble.hits_of(rules, "s").alias("got"), F.array(*[r.column("s") for r in rules]).alias("want")).collect()
    assert len(rows) == len(texts) and all(r.got == r.want for r in rows) and 0 < sum(sum(r.got[:3]) for r in rows) < 3 * len(rows)


def test_signatures_never_rule_out_a_link():
    draw = np.random.default_rng(8)
    for t in (80, 90):
        xs = [np.unique(draw.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 2, 31, 32, 33, 64, 65, 257, 1000, 5000) for _ in range(20)]
        ys = [np.unique(np.concatenate([x[draw.random(len(x)) > draw.choice([0.0, 0.05, 0.15, 0.6])], draw.integers(0, 2**63, draw.integers(0, 1 + len(x) // 8)).astype(np.uint64)])) for x in xs]
        ys[::20] = [np.unique(draw.integers(0, 2**63, max(1, len(y))).astype(np.uint64)) for y in ys[::20]]
        xs, ys = zip(*[(x, y) for x, y in zip(xs, ys) if len(y)])
        signs = [np.array([ngram_join.signature(v) for v in side], object) for side in (xs, ys)]
        got = ngram_join.can_reach(*signs, np.array([len(x) for x in xs]), np.array([len(y) for y in ys]), t)
        linked = np.array([100 * len(np.intersect1d(x, y)) >= t * len(np.union1d(x, y)) for x, y in zip(xs, ys)])
        assert got[linked].all() and linked.any() and got[~linked].mean() < 0.5


def test_rows_that_share_a_passage_only_need_no_whole_sets(spark, monkeypatch):
    draw = random.Random(12)
    words = ["".join(draw.choice("abcdefghil") for _ in range(5)) for _ in range(12)]
    texts = [" ".join(["one rare passage found in all of these texts", *(draw.choice(words) for _ in range(40))]) for _ in range(12)]
    texts += [f"{texts[3]} end", f"{texts[3]} other"]
    asked, whole = [], ngram_join.class_sets
    monkeypatch.setattr(ngram_join, "class_sets", lambda s, n, classes, rows: asked.append(rows) or whole(s, n, classes, rows))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component for r in ngram_join.ngram_join(spark, docs, 5, 80).collect()}
    assert got == {i: 3 if i >= 12 else i for i in range(14)}
    assert 0 < sum(asked) < 10


def test_long_texts_are_counted_once(monkeypatch):
    text = "".join(random.Random(6).choice("abcdé ") for _ in range(5000))
    whole = language_id.counts_of(text)
    model = language_id.Model(("a", "b"), np.vstack([np.random.default_rng(1).normal(size=(1 << 16, 2)), np.zeros((1, 2))]).astype(np.float32), np.zeros(2))
    scores = language_id.score_batch(model, [text, "ab", text[:700]])
    monkeypatch.setattr(language_id, "BATCH_CHARS", 64)
    assert (language_id.counts_of(text) == whole).all()
    assert np.allclose(language_id.score_batch(model, [text, "ab", text[:700]]), scores, rtol=1e-5)


def test_more_languages_than_one_matrix_holds(spark, edge, monkeypatch):
    docs = queries.table(spark, edge["dir"], "documents").withColumn("lang", F.concat(F.lit("l"), F.floor(F.col("doc_id") / 3) % 7))
    found = lambda: sorted(((r.doc_id is None, r.doc_id or 0, r.lang_pred, r.score) for r in language_id.identify(spark, docs, language_id.fit(spark, docs)).collect()))
    whole = found()
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 2)
    blocks = found()
    assert [r[:3] for r in blocks] == [r[:3] for r in whole] and len({r[2] for r in whole}) > 3
    assert np.allclose([r[3] for r in blocks], [r[3] for r in whole], rtol=1e-5)


def test_top_k_beyond_doubles():
    draw = np.random.default_rng(5)
    cells = draw.integers(-(2**29), 2**29, (20, 300))
    best = topk.unit_best(np.arange(300), cells, cells[:, :3].T.copy(), np.array([0, 1, 2]), 5)
    for q in range(3):
        scores = cells.T @ cells[:, q]
        order = [i for i in np.lexsort((np.arange(300), -scores)) if i != q][:5]
        assert [b[1:] for b in best if b[0] == q] == [(i, scores[i]) for i in order]


def large_vectors():
    draw = random.Random(11)
    wide = [1e30, -1e30, 1.7e308, -1.7e308, 1e16, 2.0**55, 2.0**54 - 1, -(2.0**55)]
    rows = [(i, [draw.choice(wide) if draw.random() < 0.3 else draw.gauss(0, 1), draw.gauss(0, 1)]) for i in range(60)]
    at_bound = math.isqrt((1 << 62) // 2) / 256
    rows += [(100 + i, [sign * (at_bound + step), at_bound]) for i, (sign, step) in enumerate(itertools.product((1, -1), (-1.0, 0.0, 1.0)))]
    # Scores of exactly the least and the largest long, and one beyond either.
    rows += [(200, [2.0**23, 2.0**-8, 0.0]), (201, [-(2.0**24), 0.0, 0.0]), (202, [-(2.0**24), -(2.0**-8), 0.0]), (203, [2.0**24, -(2.0**-8), 0.0]), (204, [2.0**24, 0.0, 0.0])]
    rows += [(250 + i, [x * 2.0**8 for x in v]) for i, (_, v) in enumerate(rows[-5:])]
    return rows + [(300, []), (301, []), (350, []), (352, None)]


def test_top_k_of_components_of_any_size(spark):
    rows = large_vectors()
    got = topk.top_k(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=5, every=5)
    want = Counter(brute.top_k(rows, 5, 5))
    assert Counter(map(tuple, got.collect())) == want and any(r[3] is None for r in want) and (300, 1, 301, 0) in want


def test_top_k_of_long_vectors(spark):
    draw = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(draw.normal(size=(120, 1024)))]
    got = topk.top_k(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=3, every=40)
    assert Counter(map(tuple, got.collect())) == Counter(brute.top_k(rows, 3, 40))


def test_rules_are_read_from_trees():
    tree = "T\n  If (feature 2 <= 0.5)\n   If (feature 1 > 3.0)\n    Predict: 1.0\n   Else (feature 1 <= 3.0)\n    Predict: 0.0\n  Else (feature 2 > 0.5)\n   Predict: 0.0\n"
    inf = float("inf")
    assert {r.bounds for r in rule_ensemble.rules_of(tree)} == {((2, -inf, 0.5),), ((2, 0.5, inf),), ((1, 3.0, inf), (2, -inf, 0.5)), ((1, -inf, 3.0), (2, -inf, 0.5))}


def test_scores_beside_clashing_columns_and_repeated_labels(spark):
    docs = spark.createDataFrame([(i, "good words " * (i + 1), "kept", "kept", 9.0) for i in range(12)], "doc_id long, text string, __statistics string, `a.b` string, Score double")
    labels = spark.createDataFrame([(i % 4, i % 2) for i in range(40)], "doc_id long, quality int")
    assert rule_ensemble.training_rows(spark, docs, labels).count() == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(4))
    got = rule_ensemble.scored(docs, rule_ensemble.fit(spark, docs, labels))
    assert got.columns == ["doc_id", "text", "__statistics", "a.b", "score"]
    assert all(r["__statistics"] == r["a.b"] == "kept" and 0 <= r.score <= 1 for r in got.collect())


def test_rules_are_filed_under_their_rarest_token(spark):
    tokens = spark.createDataFrame([("net",)] * 5 + [("example",)] * 9 + [("en",)] * 2, "token string")
    filed = {r.name: r.token for r in url_filters.indexed(spark, tokens, url_filters.RULES[:2]).collect()}
    assert filed == {"net/": "net", "example.net/en/": "en"}

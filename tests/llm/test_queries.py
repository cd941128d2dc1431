"""Every query of the package against a plain version, over odd small tables and over empty ones."""

from collections import Counter

import pytest

from check import compare, duck
from ebbline.llm import queries
from tests.llm import brute


def rows(spark, name, folder, *columns):
    return Counter(tuple(r) for r in queries.QUERIES[name](spark, folder).select(*columns).collect())


def two(edge):
    return [(d, t) for d, t, _, _ in edge["docs"]]


def test_op1(spark, edge):
    got = rows(spark, "op1_pii", edge["dir"], "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    assert got == Counter(brute.pii(two(edge)))


def test_op2_equals_sql(spark, edge):
    con = duck("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{edge['dir']}/pages.parquet'")
    ok, n, message = compare(spark, con, edge["dir"], "op2", queries.QUERIES["op2_url_filters"], queries.ORACLES["op2_url_filters"])
    assert ok and n == 29, message


def test_op3(spark, edge):
    got = rows(spark, "op3_line_dedup", edge["dir"], "doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert got == Counter(brute.lines(two(edge)))
    assert sum(k[2] for k in got)


def test_op4(spark, edge):
    docs = [(d, t, s) for d, t, _, s in edge["docs"]]
    wanted, taken = brute.targets(docs), Counter()
    found = queries.mixing.mix(spark, queries.table(spark, edge["dir"], "documents")).collect()
    assert len(found) == len(docs)
    for r in found:
        size, target = wanted[r.source]
        assert r.source_size == size and abs(r.target - target) < 1e-6 * (1 + target) and 0 <= r.copies <= 3
        taken[r.source] += r.copies * r["size"]
    assert all(abs(taken[s] - target) <= 40 for s, (_, target) in wanted.items() if s != None)  # noqa: E711
    again = queries.mixing.mix(spark, queries.table(spark, edge["dir"], "documents")).collect()
    assert Counter(found) == Counter(again)


def test_op5_and_op7_shapes(spark, edge):
    docs = edge["docs"]
    five = queries.QUERIES["op5_language_id"](spark, edge["dir"]).collect()
    assert Counter(r.doc_id for r in five) == Counter(d[0] for d in docs)
    texts = Counter((d, bool(t) and any(c.isalpha() for c in t)) for d, t, _, _ in docs)
    assert Counter((r.doc_id, r.lang_pred != "und") for r in five) == texts
    seven = queries.QUERIES["op7_quality"](spark, edge["dir"]).collect()
    assert len(seven) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in seven)


def test_op6(spark, edge):
    got = rows(spark, "op6_decontamination", edge["dir"], "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == Counter(brute.contamination(two(edge), edge["items"]))
    assert sum(k[5] for k in got) > 5


@pytest.mark.parametrize("n,t", [(3, 90), (5, 80)])
def test_op8(spark, edge, n, t):
    docs = queries.table(spark, edge["dir"], "documents")
    got = Counter(tuple(r) for r in queries.ngram_join.ngram_join(spark, docs, n, t).select("doc_id", "n_shingles", "component").collect())
    assert got == Counter(brute.groups(two(edge), n, t)[0])


def test_op9(spark, edge):
    got = rows(spark, "op9_token_files", edge["dir"], "doc_id", "start", "n_tokens", "ids_crc32")
    want = Counter(brute.tokens(two(edge), queries.tokenizer_path()))
    once = [k for k, v in Counter(d for d, _ in two(edge)).items() if v == 1]
    assert {k for k in got if k[0] in once} == {k for k in want if k[0] in once}
    assert Counter((k[0], k[2], k[3]) for k in got.elements()) == Counter((k[0], k[2], k[3]) for k in want.elements())


def test_op10(spark, edge):
    got = rows(spark, "op10_top_k", edge["dir"], "query_id", "rank", "vec_id", "score")
    assert got == Counter(brute.top_k(edge["vectors"]))


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_empty_tables(spark, empty, name):
    assert queries.QUERIES[name](spark, empty).count() == 0


def test_language_and_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs = queries.table(spark, folder, "documents")
    held = queries.QUERIES["op5_language_id"](spark, folder).where("held_out").join(docs, "doc_id")
    assert held.where("lang_pred = lang").count() > 0.97 * held.count()
    scored = queries.QUERIES["op7_quality"](spark, folder).where("held_out").join(queries.table(spark, folder, "labels"), "doc_id")
    assert scored.where("predicted = quality").count() > 0.95 * scored.count()

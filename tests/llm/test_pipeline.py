"""Every stage of the pipeline on its own input, and the whole of it."""

from collections import Counter

import corpus_pipeline
from ebbline.llm import queries
from tests.llm import brute


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages(spark, edge):
    docs = queries.table(spark, edge["dir"], "documents")
    given = pairs(docs)
    kept = corpus_pipeline.quality(spark, docs, edge["dir"])
    assert kept.columns == docs.columns and not Counter(pairs(kept)) - Counter(given) and kept.count()

    near = corpus_pipeline.near_duplicates(spark, docs, edge["dir"])
    group = dict(zip(range(len(given)), brute.groups(given, 5, 80)[1]))
    sets = [brute.shingles(t, 5) for _, t in given]
    left = Counter(pairs(near))
    assert near.columns == docs.columns and not left - Counter(given)
    stays = Counter(group[i] for i in range(len(given)) if sets[i])
    firsts = {g: min((given[i][0] for i in group if group[i] == g and given[i][0] is not None), default=None) for g in stays}
    assert sum(left.values()) == len(stays) + sum(not s for s in sets)
    assert Counter(d for d, t in left.elements() if brute.shingles(t, 5)) == Counter(firsts.values())

    clean = corpus_pipeline.decontamination(spark, docs, edge["dir"])
    want = Counter(g for g, j in zip(given, brute.contamination(given, edge["items"])) if not j[5])
    assert clean.columns == docs.columns and Counter(pairs(clean)) == want

    mixed = corpus_pipeline.mix(spark, docs, edge["dir"])
    copies = Counter(pairs(mixed))
    assert mixed.columns == docs.columns and all(n <= 3 * Counter(given)[k] for k, n in copies.items())


def test_run(spark, edge, empty):
    out = corpus_pipeline.run(spark, edge["dir"])
    rows = sorted(out.collect(), key=lambda r: r.start)
    assert rows and rows[0].start == 0 and all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))
    assert [s[0] for s in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mix", "tokens"]
    assert corpus_pipeline.run(spark, empty).count() == 0

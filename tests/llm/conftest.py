import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

CLASHING = ("row_id", "kind", "score", "n", "cls", "m", "raw", "start", "shard", "bucket", "component", "text_key")


def sentence(draw, words, n):
    return " ".join(draw.choice(words) for _ in range(n))


def corpus():
    """Documents with nulls, empty and very long texts, repeated rows, copies, planted cases."""
    draw = random.Random(3)
    words = ["".join(draw.choice("abcdefghilmnoprstu") for _ in range(draw.randint(2, 9))) for _ in range(600)]
    texts = [None, "", " \t\n ", "a", "Ünïcode ÄÖ ß", "a" * 3000, "1" * 2000, "x@" * 500, "\n".join(["1.2.3"] * 50)]
    shared = [sentence(draw, words, 12).capitalize() + "." for _ in range(4)]
    items = [sentence(draw, words, n) for n in (30, 40, 13, 5, 1, 60)]
    for i in range(60):
        body = [sentence(draw, words, draw.randint(4, 40)) for _ in range(draw.randint(1, 5))]
        if i % 3 == 0:
            body.insert(draw.randint(0, len(body)), shared[i % 4] if i % 2 else "  " + shared[i % 4].upper() + "\t")
        if i % 7 == 0:
            body.append(items[i % 3])
        if i % 11 == 0:
            body.append(" ".join(items[5].split()[10:23 + i % 5]))
        texts.append("\n".join(body))
    base = sentence(draw, words, 200).split()
    for i in range(25):
        copy = list(base)
        for _ in range(i % 6):
            copy[draw.randrange(len(copy))] = draw.choice(words)
        texts.append(" ".join(copy))
    texts += [texts[20], texts[20].upper(), texts[20] + " ", " ".join(draw.choice(words) for _ in range(40_000))]
    marks = ["mail me: joe.b+x@a-b.example.org, or", "ip 10.0.0.256 10.0.0.25.7 1.2.3.4.5.6.7.8", "card 4111 1111 1111 1111 and 4111-1111-1111-1112", "5500000000000004 x",
             "+1 (988) 555-2485 or +49 30 1234 or +1-2", "a@b@c.d.e _x@y.z_w@q.r", "99999999999999999999999 0000000000000000", "é+1 234 567 890é x@é.com"]
    texts += [f"{sentence(draw, words, 5)} {m} {sentence(draw, words, 3)}" for m in marks]
    texts += [" ".join(["same same"] * 30), " | ".join(words[:30]), sentence(draw, words, 30).upper() + "!!! ### ***"]
    ids = list(range(len(texts)))
    draw.shuffle(ids)
    ids = [None if t == "a" else i * 3 for i, t in zip(ids, texts)]
    rows = [(d, t, (None, "en", "fr", "de")[(d or 0) % 4], (None, "s1", "s2", "s3", "é")[len(t or "") % 5]) for d, t in zip(ids, texts)]
    return rows + [rows[30], rows[30], (rows[12][0], "another text under an id that is there", "en", "s1")], items


def write(folder, docs, items, pages, vectors, labels):
    extra = {c: pa.array(["x"] * len(docs)) for c in CLASHING}
    columns = list(zip(*docs)) if docs else [[]] * 4
    kinds = (("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()))
    tables = {
        "documents": pa.table({**{n: pa.array(c, t) for (n, t), c in zip(kinds, columns)}, "n_chars": pa.array([len(d[1] or "") for d in docs], pa.int64()), **extra}),
        "benchmark": pa.table({"item_id": pa.array([*range(len(items)), *([None] * bool(items))], pa.int64()), "text": pa.array(items + [None] * bool(items), pa.string()),
                               "term": pa.array(["x"] * (len(items) + bool(items)))}),
        "pages": pa.table({"page_id": pa.array(range(len(pages)), pa.int64()), "url": pa.array(pages, pa.string()), "html": pa.array([""] * len(pages)), "token": pa.array(["x"] * len(pages))}),
        "embeddings": pa.table({"vec_id": pa.array([v[0] for v in vectors], pa.int64()), "embedding": pa.array([v[1] for v in vectors], pa.list_(pa.float32())),
                                "label": pa.array([0] * len(vectors), pa.int32()), "block": pa.array(["x"] * len(vectors))}),
        "labels": pa.table({"doc_id": pa.array([x[0] for x in labels], pa.int64()), "quality": pa.array([x[1] for x in labels], pa.int32()), "toxic": pa.array([0] * len(labels), pa.int32())}),
    }
    for name, table in tables.items():
        pq.write_table(table, f"{folder}/{name}.parquet")


URLS = ["http://a.example.net/en/1?x#y", "https://Example.NET/en", "https://example.net/en/", "http://net/", "http://net", "http://internet/", "http://x.org/fr/é?q", "http://example.com/de/1",
        "http://b.Example.com/de", "x://a.org/EN/", "", None, "no scheme", "://", "http://u:p@h.net:80/p?a/b", "a://b://c.net/z", "http://t.com/ads/1", "http://ads.t.com/click?x", "http://t.com/?utm_source=a",
        "http://t.com/?b=1&utm_source=a", "http://t.com/a.exe", "http://t.com/a.exempt", "http://tracker.t.com", "http://T.com/robots.txt", "http://t.com/login?a=b&session=1\n", "http://\u212a.net/en/"]


@pytest.fixture(scope="session")
def edge(tmp_path_factory):
    """Folder of small odd tables, and their rows."""
    folder = tmp_path_factory.mktemp("edge")
    docs, items = corpus()
    draw = random.Random(5)
    vectors = [(i, [draw.gauss(0, 1) for _ in range(40)]) for i in range(300)] + [(300, None), (350, []), (None, [1.0] * 40), (400, [float("nan")] * 40), (450, [None] + [1.0] * 39), (500, [1.0, 2.0])]
    vectors += [vectors[7], vectors[50], (601, vectors[50][1])]
    labels = [(d, int(not (t or "").isupper())) for d, t, _, _ in docs if d is not None and d % 2 == 0] + [(None, 1), (6, None)]
    write(folder, docs, items, URLS + URLS[:3], vectors, labels)
    return {"dir": str(folder), "docs": docs, "items": list(enumerate(items)), "vectors": vectors}


@pytest.fixture(scope="session")
def empty(tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    write(folder, [], [], [], [], [])
    return str(folder)

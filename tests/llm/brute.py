"""Plain-Python versions of the contracts, for small tables."""

import hashlib
import math
import operator
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np

SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(re.sub("[^0-9]", "", s)) <= 19 and luhn(re.sub("[^0-9]", "", s))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(re.sub("[^0-9]", "", s)) <= 15),
}


def pii(docs):
    for doc_id, text in docs:
        spans = [(k, m.start(), m.end()) for k, (p, ok) in PII.items() for m in re.finditer(p, text or "") if ok(m[0])]
        yield (doc_id, *[sum(s[0] == k for s in spans) for k in PII], sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans)))


def lines(docs):
    """Every row is a document; null ids rank below all others."""
    keyed = lambda t: [(x, low(x.strip(SPACE))) for x in (t or "").split("\n")]
    held = defaultdict(list)
    for doc_id, text in docs:
        for key in {k for _, k in keyed(text) if len(k) >= 20}:
            held[key].append(doc_id)
    top = {k: max((i for i in v if i is not None), default=None) for k, v in held.items()}
    for doc_id, text in docs:
        every = keyed(text)
        kept = [x for x, k in every if len(k) < 20 or len(held[k]) < 3 or top[k] is None or top[k] == doc_id]
        yield doc_id, len(every), len(every) - len(kept), sha("\n".join(kept))


def targets(docs):
    """source -> (size, target) of rows (doc_id, text, source)."""
    size = Counter()
    for _, text, source in docs:
        size[source] += len(re.findall(WORD, text or ""))
    names = sorted(k for k in size if k is not None) + ([None] if None in size else [])
    weight = {k: (5, 2, 1)[i % 3] for i, k in enumerate(names)}
    left, still, out = sum(size.values()), set(names), {}
    while still:
        total = sum(weight[k] for k in still)
        over = [k for k in still if left * weight[k] / total > 3 * size[k]]
        for k in over or still:
            out[k] = 3 * size[k] if over else left * weight[k] / total
        left -= sum(3 * size[k] for k in over)
        still -= set(over or still)
    return {k: (size[k], float(out[k])) for k in names}


def contamination(docs, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t or ""))
    windows = defaultdict(set)
    for item, text in items:
        words = split(text)
        for k in range(max(1, len(words) - 12)) if words and item is not None else []:
            windows[tuple(words[k:k + 13])].add(str(item))
    sizes = {len(w) for w in windows}
    for doc_id, text in docs:
        words, hit, found = split(text), set(), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                if tuple(words[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(words[k:k + n])]
        yield doc_id, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(words)


def shingles(text, n):
    words = re.findall(WORD, low(text or ""))
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def groups(docs, n, t):
    """(doc_id, set size, smallest id in reach) and the group number of each row."""
    sets = [shingles(text, n) for _, text in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= t * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        least[find(i)] = min((x for x in (least.get(find(i)), doc_id) if x is not None), default=None)
    return [(d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(docs, sets))], [find(i) for i in range(len(docs))]


def tokens(docs, path):
    from tokenizers import Tokenizer

    model, at = Tokenizer.from_file(path), 0
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = np.array(model.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        yield doc_id, at, len(ids), zlib.crc32(ids.tobytes())
        at += len(ids)


def top_k(rows, k=5, every=50):
    def usable(i, v):
        return i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)

    fine = [(i, [math.floor(Fraction(float(x)) * 256) for x in v]) for i, v in rows if usable(i, v)]
    for a, (query, v) in enumerate(fine):
        if query % every == 0:
            scored = sorted(((-sum(map(operator.mul, v, w)), i) for b, (i, w) in enumerate(fine) if b != a and len(w) == len(v)))
            yield from ((query, r + 1, i, -s if -(1 << 63) <= -s < 1 << 63 else None) for r, (s, i) in enumerate(scored[:k]))



LEAST_DOCS = 30
LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def divergence(docs):
    """``lang, source, part, item, value, rank`` from ``(text, lang, source)``, term by term."""
    words = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LETTERS)), lang or "", source or "") for t, lang, source in docs]
    out = []
    for lang in {x[1] for x in words}:
        own = [(w, s) for w, x, s in words if x == lang]
        df = Counter(t for w, _ in own for t in set(w))
        kept = {t for t, n in df.items() if n >= LEAST_DOCS}
        count = {s: Counter() for _, s in own}
        for w, s in own:
            count[s].update(t for t in w if t in kept)
        every = sum(count.values(), Counter())

        def weights(c):
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}

        p, q = {s: weights(c) for s, c in count.items()}, weights(every)
        for s in p:
            pair = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in p if o != s))
            out += [(lang, s, "pair", o, -v, i) for i, (v, _, o) in enumerate(pair, 1)]
            term = sorted((q[t] - p[s][t], t.encode(), t) for t in kept if count[s][t] and p[s][t] > q[t])
            out += [(lang, s, "term", t, -v, i) for i, (v, _, t) in enumerate(term[:50], 1)]
    return out

import math
import random
import re
from collections import Counter

from skuflow.llm import search as S
from tests.llm.conftest import MESSY


def words(t):
    return [w for w in re.split("[\x20\x09-\x0d]+", "".join(c.lower() if c.isascii() else c for c in t or "")) if w]


def brute(docs, queries, k):
    bags = [Counter(words(t)) for _, t in docs]
    n, average = len(docs), sum(sum(b.values()) for b in bags) / len(docs)
    df = Counter(w for b in bags for w in b)
    out = []
    for q, text in queries:
        scores = []
        for (i, _), bag in zip(docs, bags):
            share = S.K1 * (1 - S.B + S.B * sum(bag.values()) / average)
            hits = [c * math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * bag[w] * (S.K1 + 1) / (bag[w] + share) for w, c in Counter(words(text)).items() if bag[w]]
            if hits:
                scores.append((-round(sum(hits), S.DIGITS), i is None, i or 0))
        out += [(q, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def got(df):
    return sorted(((r.query, r.rank, r.doc_id, round(r.score, S.DIGITS)) for r in df.collect()), key=str)


def corpus(n=400):
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 120)))) for i in range(n)]
    docs += [(1000 + i, docs[7][1]) for i in range(15)]                     # ties
    return docs, [(q, " ".join(rng.choices(vocabulary, k=rng.randint(1, 25)) + ["W0"] * 2)) for q in range(20)]


def test_same_as_brute_force(spark, docs_of, monkeypatch):
    docs, queries = corpus()
    monkeypatch.setattr(S, "QUERY_BLOCK", 6)
    out = S.search(S.build(docs_of(docs).repartition(3)), docs_of(queries), k=7, id_col="doc_id").cache()
    assert got(out) == brute(docs, queries, 7)


def test_pruning_skips_documents_and_keeps_the_result():
    rng = random.Random(3)
    n = 3000
    length = [rng.randint(5, 60) for _ in range(n)]
    average = sum(length) / n

    def cursor(place, weight, share):
        docs = [d for d in range(n) if rng.random() < share]
        tfs = [1 + (rng.random() < 0.2) for _ in docs]
        blocks = [(S.np.array(docs[a:a + 64]), S.np.array(tfs[a:a + 64]), max(tfs[a:a + 64]), min(length[d] for d in docs[a:a + 64])) for a in range(0, len(docs), 64)]
        return S.Cursor(place, weight, blocks, lambda tf, short: tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * short / average)))

    cursors = [cursor(0, 0.1, 0.9), cursor(1, 5.0, 0.01), cursor(2, 0.3, 0.5)]
    want = Counter()
    for c in cursors:
        for d, tf in zip(c.docs, c.tfs):
            want[d] += c.weight * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length[d] / average))
    best, scored = S.block_max_wand(cursors, length, list(range(n)), 5, average)
    assert sorted(best, key=lambda x: (-x[0], x[1])) == sorted(((round(s, 6), d) for d, s in want.items()), key=lambda x: (-x[0], x[1]))[:5]
    assert scored < n / 4


def test_messy_rows(spark, messy, docs_of):
    queries = [(1, None), (2, ""), (None, "text"), (3, "A b 漢字 c zzz"), (3 + 4, "nowhere")]
    assert got(S.search(S.build(messy), docs_of(queries), 3, "doc_id")) == brute(MESSY, queries, 3)
    assert got(S.search(S.build(docs_of([])), docs_of(queries), 3, "doc_id")) == []
    assert got(S.search(S.build(messy), docs_of([]), 3, "doc_id")) == []

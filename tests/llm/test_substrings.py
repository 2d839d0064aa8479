import hashlib
import random

import numpy as np
from skuflow.llm import substrings as S
from tests.llm.conftest import MESSY


def brute(rows, length):
    data = [(t or "").encode() for _, t in rows]
    seen = {}
    for d in data:
        for p in range(len(d) - length + 1):
            w = d[p:p + length]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for (i, _), d in zip(rows, data):
        gone = np.zeros(len(d), bool)
        for p in range(len(d) - length + 1):
            if seen[d[p:p + length]] > 1:
                gone[p:p + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((i, len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def test_same_as_brute_force(spark, docs_of):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice(["ab", "é", "the", "or", "x"]) for _ in range(rng.randint(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(40) for _ in range(4)]
    rows = []
    for i in range(60):
        kind = rng.random()
        if kind < 0.4 and rows:                       # a near copy
            words = rng.choice(rows)[1].split(" ")
            for _ in range(rng.randint(1, 4)):
                words[rng.randrange(len(words))] = word()
            rows.append((i, " ".join(words)))
        elif kind < 0.7:
            rows.append((i, text(rng.randint(0, 40)) + rng.choice(passages) + text(rng.randint(0, 40))))
        else:
            rows.append((i, text(rng.randint(1, 150))))
    rows += [(100, "ab" * 300), (101, "-" * 900), (102, "x" + "-" * 250), (103, rows[3][1]), (104, "abc" * 100 + "ab" * 130)]
    for length in (80, 200):
        assert got(S.remove_repeats(docs_of(rows).repartition(5), length)) == brute(rows, length)


def test_messy_rows(messy, docs_of):
    assert got(S.remove_repeats(messy)) == brute(MESSY, 200)
    assert S.remove_repeats(docs_of([])).count() == 0


def test_long_texts_are_cut_into_overlapping_pieces(monkeypatch):
    rng = np.random.default_rng(3)
    t = rng.integers(97, 100, 5000).astype(np.uint8).tobytes()
    monkeypatch.setattr(S, "BLOCK", 150)
    pieces = [p for block in S._blocks([t], 200) for p in block]
    windows = set()
    for _, shift, piece in pieces:
        h, at, p0, p1 = S.runs_of(np.frombuffer(piece, np.uint8), np.array([len(piece)]), 200)
        windows |= {w + shift for a, b in zip(p0, p1) for w in range(a, b + 1)}
    assert windows == set(range(5000 - 200 + 1))


def test_deep_shallow_order():
    rng = random.Random(5)
    strings, group = [], []
    for g in range(30):
        base = bytes(rng.choice(b"ab\0") for _ in range(120))
        for _ in range(rng.randint(1, 12)):
            s = bytearray(base[:rng.randint(0, 120)])
            if s and rng.random() < 0.6:
                s[rng.randrange(len(s))] = rng.choice(b"ab\0")
            strings.append(bytes(s))
            group.append(g)
    for shallow in (0, 8, 64, 200):
        order, common = S.deep_shallow(np.array(group), strings, 120, shallow)
        assert [(group[i], strings[i]) for i in order] == sorted(zip(group, strings))
        for a, b, c in zip(order, order[1:], common[1:]):
            x, y = strings[a], strings[b]
            same = next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))
            assert c == (same if group[a] == group[b] else -1)

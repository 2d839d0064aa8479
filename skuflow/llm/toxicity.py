"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities and counts of lexicon words, distance between a
lexicon word and the nearest second-person pronoun, share of capitals, rates of
punctuation, exclamation, digits and obfuscation (digits or signs that stand for
letters inside a word).  The lexicon is learnt too: whole words and word
beginnings that labelled toxic texts hold far more often than others, matched
after obfuscation is undone.  While the trees are fitted, a text's features come
from a lexicon learnt without it (two folds).  Scores are calibrated by isotonic
regression on a fifth of the sample that the trees have not seen.

The fit runs in one task on at most ``max_rows`` labelled training rows; scoring
is map-only over every whole text, nothing is shuffled.

Cases: null and empty texts have all features 0; without labels of both classes
the score is the smoothed share of label 1; null and repeated ids, further
columns and empty tables need no special care.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from skuflow.llm.common import range_hash
from skuflow.llm.learning import fit, labelled_sample, score

MAX_ROWS = 20_000
#: Lengths in bytes of the word beginnings that the lexicon may hold; a word is one more candidate.
BEGINNINGS = (4, 5, 6, 7)
# Second-person pronouns of English, German, French and Spanish.
SECOND_PERSON = ("you your yours yourself u du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos "
                 "tú ti tuyo usted ustedes vosotros").split()
# Signs that stand for letters.
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

_PLAIN = np.zeros(256, np.uint8)
for _b in range(256):
    _PLAIN[_b] = _b + 32 if 65 <= _b <= 90 else _b if 97 <= _b <= 122 or _b >= 128 else 0
for _a, _c in STANDS_FOR.items():
    _PLAIN[ord(_a)] = ord(_c)
_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
N_FEATURES = 16


class Tokens:
    """Runs of letters and of signs standing for letters, with at least one letter, obfuscation undone."""

    def __init__(self, texts: list[bytes]):
        self.raw = raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.plain = _PLAIN[raw]
        edge = np.flatnonzero(np.diff(np.concatenate([[0], self.plain > 0]).astype(np.int8)))
        start, end = edge[0::2], edge[1::2]
        letters = np.concatenate([[0], np.cumsum(_LETTER[raw])])
        # signs at the end of a word ("!!", "100") are no letters
        n_letters = letters[end] - letters[start]
        while len(tail := np.flatnonzero((n_letters > 0) & ~_LETTER[raw[end - 1]])):
            end[tail] -= 1
        keep = n_letters > 0
        self.start, self.end = start[keep], end[keep]
        self.odd = (self.end - self.start) > n_letters[keep]
        self.stops = np.cumsum([len(t) + 1 for t in texts])
        self.doc = np.searchsorted(self.stops, self.start, side="right")
        self.code = range_hash(self.plain, self.start, self.end)

    def beginnings(self, n: int) -> np.ndarray:
        """Code of each token's first ``n`` bytes; 0 for tokens that are not longer."""
        out, long = np.zeros(len(self.start), np.uint64), self.end - self.start > n
        out[long] = range_hash(self.plain, self.start[long], self.start[long] + n) + np.uint64(n)
        return out


PRONOUNS = np.unique(Tokens([" ".join(SECOND_PERSON).encode()]).code)


def _among(sorted_codes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    if not len(sorted_codes):
        return np.zeros(len(codes), bool)
    at = np.minimum(np.searchsorted(sorted_codes, codes), len(sorted_codes) - 1)
    return sorted_codes[at] == codes


def learn_lexicon(tokens: list[Tokens], toxic: list[np.ndarray]) -> dict[str, np.ndarray]:
    """Words and beginnings whose share of toxic texts is far above that of others, in two strengths."""
    n1, n0 = sum(int(t.sum()) for t in toxic), sum(int((~t).sum()) for t in toxic)
    least = max(2, n1 // 150)
    out = {}
    for name, codes in [("word", lambda t: t.code), *((str(n), lambda t, n=n: t.beginnings(n)) for n in BEGINNINGS)]:
        hit: list[list[np.ndarray]] = [[], []]
        for t, y in zip(tokens, toxic):
            c = codes(t)
            c, doc = c[c != 0], t.doc[c != 0]
            order = np.lexsort((doc, c))
            c, doc = c[order], doc[order]
            first = np.ones(len(c), bool)                  # each word once per text
            first[1:] = (c[1:] != c[:-1]) | (doc[1:] != doc[:-1])
            for label in (0, 1):
                hit[label].append(c[first & (y[doc] == bool(label))])
        ones, n_ones = np.unique(np.concatenate(hit[1]), return_counts=True)
        ones, n_ones = ones[n_ones >= least], n_ones[n_ones >= least]
        zeros, n_zeros = np.unique(np.concatenate(hit[0]), return_counts=True)
        n_other = np.zeros(len(ones))
        if len(zeros) and len(ones):
            at = np.minimum(np.searchsorted(zeros, ones), len(zeros) - 1)
            n_other = np.where(zeros[at] == ones, n_zeros[at], 0)
        odds = np.log((n_ones + 0.5) / (n1 + 1)) - np.log((n_other + 0.5) / (n0 + 1))
        out[name], out[name + "+"] = ones[odds > 1.5], ones[odds > 3.5]
    return out


def features(t: Tokens, n: int, lexicon: dict[str, np.ndarray]) -> np.ndarray:
    """(n texts, N_FEATURES)."""
    per = lambda m, doc: np.bincount(doc[m], minlength=n).astype(float)
    strong, weak = _among(lexicon["word+"], t.code), _among(lexicon["word"], t.code)
    strong_b, weak_b = np.zeros(len(t.code), bool), np.zeros(len(t.code), bool)
    for k in BEGINNINGS:
        c = t.beginnings(k)
        strong_b |= (c != 0) & _among(lexicon[f"{k}+"], c)
        weak_b |= (c != 0) & _among(lexicon[str(k)], c)
    hit, you = strong | strong_b, _among(PRONOUNS, t.code)
    words = np.bincount(t.doc, minlength=n).astype(float)
    # words between a lexicon word and the nearest second-person pronoun
    near = np.full(n, 50.0)
    place, pron = np.flatnonzero(hit), np.flatnonzero(you)
    if len(place) and len(pron):
        at = np.searchsorted(pron, place)
        for side in (np.maximum(at - 1, 0), np.minimum(at, len(pron) - 1)):
            ok = t.doc[pron[side]] == t.doc[place]
            np.minimum.at(near, t.doc[place][ok], np.abs(pron[side] - place)[ok].astype(float))
    begin = np.concatenate([[0], t.stops[:-1]]) if n else np.zeros(0, np.int64)
    share = lambda m: np.add.reduceat(m.astype(np.float64), begin) if n else np.zeros(0)
    raw = t.raw
    size = np.maximum(t.stops - begin - 1, 1)
    upper = (raw >= 65) & (raw <= 90)
    digit = (raw >= 48) & (raw <= 57)
    mark = (raw > 32) & (raw < 128) & ~upper & ~digit & ~((raw >= 97) & (raw <= 122))
    w = np.maximum(words, 1)
    return np.stack([
        per(strong, t.doc), per(strong, t.doc) / w, per(weak, t.doc) / w,
        per(strong_b, t.doc), per(strong_b, t.doc) / w, per(weak_b, t.doc) / w,
        per(hit, t.doc), per(hit, t.doc) / w, np.log1p(words),
        per(you, t.doc) / w, near, per(hit & t.odd, t.doc) + per(t.odd, t.doc) / w,
        share(upper) / size, share(mark) / size, share(raw == 33) / size, share(digit) / size], 1)


# --- boosted trees -----------------------------------------------------------

def _bins(x: np.ndarray, n_bins: int = 48) -> list[np.ndarray]:
    return [np.unique(np.quantile(c, np.linspace(0, 1, n_bins + 1)[1:-1])) if len(c) else np.zeros(0) for c in x.T]


def _tree(b: np.ndarray, g: np.ndarray, h: np.ndarray, n_bins: int, depth: int, reg: float, least: float) -> list:
    """One regression tree on binned features: (feature, bin, left, right) or a leaf's value."""
    nodes: list = []

    def grow(rows: np.ndarray, level: int) -> int:
        at = len(nodes)
        nodes.append(float(-g[rows].sum() / (h[rows].sum() + reg)))
        if level == depth or len(rows) < 4:
            return at
        gs, hs, best = g[rows].sum(), h[rows].sum(), (1e-6, None)
        for f in range(b.shape[1]):
            gl = np.cumsum(np.bincount(b[rows, f], g[rows], n_bins))[:-1]
            hl = np.cumsum(np.bincount(b[rows, f], h[rows], n_bins))[:-1]
            gain = gl ** 2 / (hl + reg) + (gs - gl) ** 2 / (hs - hl + reg) - gs ** 2 / (hs + reg)
            gain[(hl < least) | (hs - hl < least)] = -1
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), (f, int(gain.argmax())))
        if best[1]:
            f, cut = best[1]
            left = b[rows, f] <= cut
            nodes[at] = (f, cut, grow(rows[left], level + 1), grow(rows[~left], level + 1))
        return at

    grow(np.arange(len(g)), 0)
    return nodes


def _leaf(tree: list, b: np.ndarray) -> np.ndarray:
    out, todo = np.zeros(len(b)), [(0, np.arange(len(b)))]
    while todo:
        at, rows = todo.pop()
        if isinstance(tree[at], float):
            out[rows] = tree[at]
        elif len(rows):
            f, cut, left, right = tree[at]
            low = b[rows, f] <= cut
            todo += [(left, rows[low]), (right, rows[~low])]
    return out


class Trees:
    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 60, rate: float = 0.15, depth: int = 3):
        self.edges = _bins(x)
        self.base = float(np.log((y.sum() + 1) / ((1 - y).sum() + 1)))
        b, m = self.binned(x), np.full(len(y), self.base)
        n_bins, self.trees, self.rate = max((len(e) for e in self.edges), default=0) + 1, [], rate
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-m))
            tree = _tree(b, p - y, np.maximum(p * (1 - p), 1e-6), n_bins, depth, 1.0, 0.3)
            m += rate * _leaf(tree, b)
            self.trees.append(tree)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T)], 1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        b = self.binned(x)
        return self.base + self.rate * sum((_leaf(t, b) for t in self.trees), np.zeros(len(x)))


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing least-squares fit of y on x (pool adjacent violators);
    pools are smoothed towards one half by one row."""
    values, place = np.unique(x, return_inverse=True)
    total, size = np.bincount(place, y), np.bincount(place).astype(float)
    pools: list[list[float]] = []
    for v, s, n in zip(values, total, size):
        pools.append([v, v, s, n])
        while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
            last = pools.pop()
            pools[-1] = [pools[-1][0], last[1], pools[-1][2] + last[2], pools[-1][3] + last[3]]
    px = np.array([k for p in pools for k in (p[0], p[1])])
    py = np.array([(p[2] + 0.5) / (p[3] + 1) for p in pools for _ in (0, 1)])
    return px, np.maximum.accumulate(py)


def learn(texts: list[bytes], y: np.ndarray) -> dict:
    n, ones = len(y), int((y == 1).sum())
    model: dict = {"prior": (ones + 1) / (n + 2), "trees": None}
    if ones < 2 or n - ones < 2:
        return model
    y = (y == 1).astype(float)
    tokens = [Tokens(texts[k::2]) for k in (0, 1)]
    truth = [y[k::2] == 1 for k in (0, 1)]
    x = np.zeros((n, N_FEATURES))
    for k in (0, 1):
        x[k::2] = features(tokens[k], len(truth[k]), learn_lexicon([tokens[1 - k]], [truth[1 - k]]))
    model["lexicon"] = learn_lexicon(tokens, truth)
    seen = np.arange(n) % 5 != 4
    if len(set(y[seen])) < 2 or len(set(y[~seen])) < 2:
        seen[:] = True
    model["trees"] = Trees(x[seen], y[seen])
    rest = ~seen if not seen.all() else seen
    model["knots"] = isotonic(model["trees"].margin(x[rest]), y[rest])
    return model


def predict(model: dict, texts: list[bytes]) -> np.ndarray:
    if model["trees"] is None:
        return np.full(len(texts), model["prior"])
    margin = model["trees"].margin(features(Tokens(texts), len(texts), model["lexicon"]))
    # within a pool the order of the margins is kept by a share too small to matter
    return np.interp(margin, *model["knots"]) * (1 - 1e-6) + 1e-6 / (1 + np.exp(-margin))


def classify(docs: DataFrame, labels: DataFrame, train, label_col: str = "toxic", max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, score) of every row of ``docs``; ``train(id column)`` says which labelled rows may be learnt from."""
    model = fit(labelled_sample(docs, labels, label_col, train, max_rows), learn)
    return score(docs, lambda texts: predict(model, texts))

"""Quality classifier: naive Bayes support vectors (Wang and Manning, 2012).

Binary n-gram indicators (words; runs of one to three word shapes) are scaled by
the log ratio of their smoothed class counts, and a linear model is fitted on
them with hinge loss by dual coordinate descent.  The final weights interpolate
between the mean weight (naive Bayes) and the fitted ones.  Margins become
probabilities by a logistic curve fitted on a quarter of the sample that the
weights have not seen.

The fit runs in one task on at most ``max_rows`` labelled training rows; scoring
is map-only over every whole text, nothing is shuffled.

Cases: null and empty texts have no n-grams and score as the intercept says;
without labels of both classes the score is the smoothed share of label 1; null
and repeated ids, further columns and empty tables need no special care.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from skuflow.llm.common import Words, mix
from skuflow.llm.learning import fit, labelled_sample, logistic_curve, score

#: Hash buckets of the n-grams.
BITS = 18
MAX_ROWS = 20_000


def shapes(w: Words) -> np.ndarray:
    """A small code for the look of each word: case, length class, digits, its last two marks,
    and whether it repeats one of the two words before it."""
    n = w.end - w.start
    if not len(n):
        return np.zeros(0, np.uint64)
    raw = w.raw
    upper, digit = (raw >= 65) & (raw <= 90), (raw >= 48) & (raw <= 57)
    lower = ((raw >= 97) & (raw <= 122)) | (raw >= 128)
    mark = (raw > 32) & (raw < 128) & ~upper & ~digit & ~((raw >= 97) & (raw <= 122))
    count = lambda m: np.add.reduceat(m.astype(np.int32), np.stack([w.start, w.end - 1], 1).ravel())[::2] + m[w.end - 1] * (n > 1)
    last, prior = raw[w.end - 1], raw[np.maximum(w.end - 2, w.start)]
    marks = np.where(mark[w.end - 1], last, 0).astype(np.uint64) << np.uint64(8) | np.where(mark[w.end - 1] & mark[np.maximum(w.end - 2, w.start)], prior, 0).astype(np.uint64)
    n_upper = count(upper)
    case = np.where(upper[w.start], 1, 0) + np.where((n_upper > 1), np.where(count(lower) == 0, 2, 4), 0)
    same = np.zeros(len(n), np.int64)
    same[2:] |= 2 * ((w.code[2:] == w.code[:-2]) & (w.doc[2:] == w.doc[:-2]))
    same[1:] |= (w.code[1:] == w.code[:-1]) & (w.doc[1:] == w.doc[:-1])
    length = np.searchsorted([2, 4, 7, 12, 25, 60], n, side="right")
    code = case + 8 * length + 64 * np.minimum(count(digit), 2) + 256 * same
    return (code.astype(np.uint64) << np.uint64(16)) | marks


def indicators(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text index, bucket) of the distinct n-grams of each text, ascending."""
    w = Words(texts)
    shape, size = shapes(w), np.uint64(1 << BITS)
    with np.errstate(over="ignore"):
        grams = [(w.doc, mix(w.code + np.uint64(1))), (w.doc, mix(shape + np.uint64(2)))]
        run = mix(shape + np.uint64(3))
        for k in (1, 2):
            run = run[:-1] * np.uint64(0x9E3779B97F4A7C15) + mix(shape[k:] + np.uint64(3 + k))
            ok = w.doc[k:] == w.doc[:-k] if len(w.doc) > k else np.zeros(len(run), bool)
            grams.append((w.doc[k:][ok] if len(w.doc) > k else w.doc[:0], mix(run)[ok]))
    keys = np.concatenate([d.astype(np.uint64) * size + (h >> np.uint64(64 - BITS)) for d, h in grams])
    keys = np.unique(keys)
    return (keys // size).astype(np.int32), (keys % size).astype(np.int32)


def _row_sums(doc: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sum of ``values`` for each of ``n`` rows; ``doc`` ascends."""
    out = np.zeros(n)
    if len(doc):
        first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        out[doc[first]] = np.add.reduceat(values, first, dtype=np.float64)
    return out


def dual_coordinate_descent(doc: np.ndarray, col: np.ndarray, val: np.ndarray, y: np.ndarray, rows: np.ndarray | None = None,
                            c: float = 1.0, epochs: int = 12, seed: int = 7) -> np.ndarray:
    """Weights of the L1-loss linear SVM (Hsieh et al., 2008) on ``rows`` (all when None); the last
    weight is the intercept.  Rows are given as ascending (doc, col, val); labels are -1 and 1."""
    at = np.searchsorted(doc, np.arange(len(y) + 1))
    return _descend(lambda i: (col[at[i]:at[i + 1]], val[at[i]:at[i + 1]]), _row_sums(doc, val * val, len(y)) + 1, y, rows, c, epochs, seed)


def _descend(row, norm: np.ndarray, y: np.ndarray, rows: np.ndarray | None = None, c: float = 1.0, epochs: int = 12, seed: int = 7) -> np.ndarray:
    """:func:`dual_coordinate_descent` with ``row(i)`` giving a row's (columns, values), so that the
    values need not be held; ``norm``: the rows' squared lengths plus one."""
    n = len(y)
    w, alpha = np.zeros((1 << BITS) + 1), np.zeros(n)
    # the rarer class weighs more, so that both sides count alike
    rows = np.arange(n) if rows is None else rows
    share = np.clip(np.array([(y[rows] < 0).mean(), (y[rows] > 0).mean()]), 1e-3, 1)
    upper = np.where(y > 0, c * 0.5 / share[1], c * 0.5 / share[0])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(rows):
            cols, vals = row(i)
            g = y[i] * (w[cols] @ vals + w[-1]) - 1
            new = min(max(alpha[i] - g / norm[i], 0.0), upper[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[cols] += step * vals
                w[-1] += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


def _scaled(doc: np.ndarray, col: np.ndarray, ratio: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keep = ratio[col] != 0
    if not keep.all():
        doc, col = doc[keep], col[keep]
    val = ratio[col].astype(np.float32)
    val /= np.maximum(np.sqrt(_row_sums(doc, val * val, n)), 1e-12).astype(np.float32)[doc]
    return doc, col, val


def learn(texts: list[bytes], y: np.ndarray, beta: float = 0.75, min_texts: int = 4) -> dict:
    n, ones = len(y), int((y == 1).sum())
    prior = (ones + 1) / (n + 2)
    if ones < 2 or n - ones < 2:
        return {"prior": prior, "weights": None}
    seen = np.arange(n) % 4 != 3                       # the rest is for the curve
    if len(set(y[~seen])) < 2:
        seen[:] = True
    size, step = 1 << BITS, 200
    cols, counts, pos, neg = [], [], np.zeros(size, np.int64), np.zeros(size, np.int64)
    for a in range(0, n, step):
        doc, col = indicators(texts[a:a + step])
        texts[a:a + step] = [b""] * len(texts[a:a + step])     # not needed any more
        rows = a + doc
        pos += np.bincount(col[seen[rows] & (y[rows] == 1)], minlength=size)
        neg += np.bincount(col[seen[rows] & (y[rows] != 1)], minlength=size)
        cols.append(col)
        counts.append(np.bincount(doc, minlength=min(step, n - a)))
    ratio = np.log((pos + 1) / (pos.sum() + size)) - np.log((neg + 1) / (neg.sum() + size))
    ratio -= np.log(neg.sum() + size) - np.log(pos.sum() + size)
    ratio -= np.log((seen & (y == 1)).sum() / (seen & (y != 1)).sum())
    ratio[pos + neg < min(min_texts, 1 + n // 100)] = 0
    # held are the rows' columns alone: a value is the column's ratio over the row's length
    used, ratio32 = ratio != 0, ratio.astype(np.float32)
    length, norm, blocks = np.zeros(n, np.float32), np.zeros(n), []
    for k, a in enumerate(range(0, n, step)):
        col, rows = cols[k], np.repeat(np.arange(len(counts[k])), counts[k])
        col, rows = col[used[col]], rows[used[col]]
        cols[k] = None
        own = slice(a, a + len(counts[k]))
        val = ratio32[col]
        length[own] = np.maximum(np.sqrt(_row_sums(rows, val * val, len(counts[k]))), 1e-12).astype(np.float32)
        val /= length[own][rows]
        norm[own] = _row_sums(rows, val * val, len(counts[k])) + 1
        blocks.append((col, np.searchsorted(rows, np.arange(len(counts[k]) + 1))))

    def row(i: int) -> tuple[np.ndarray, np.ndarray]:
        col, at = blocks[i // step]
        own = col[at[i % step]:at[i % step + 1]]
        return own, ratio32[own] / length[i]

    w = _descend(row, norm, np.where(y == 1, 1.0, -1.0), np.flatnonzero(seen))
    mean = np.abs(w[:-1]).sum() / max(1, (w[:-1] != 0).sum())
    w[:-1] = (1 - beta) * mean + beta * w[:-1]
    w32 = w.astype(np.float32)
    margin = np.array([float((vals * w32[own]).sum(dtype=np.float64)) for own, vals in map(row, range(n))]) + w[-1]
    a, b = logistic_curve(margin[~seen] if not seen.all() else margin, y[~seen] if not seen.all() else y)
    return {"prior": prior, "weights": (w[:-1] * a).astype(np.float32), "bias": float(w[-1] * a + b), "ratio": ratio.astype(np.float32)}


def predict(model: dict, texts: list[bytes]) -> np.ndarray:
    if model["weights"] is None:
        return np.full(len(texts), model["prior"])
    doc, col = indicators(texts)
    doc, col, val = _scaled(doc, col, model["ratio"].astype(float), len(texts))
    margin = _row_sums(doc, val * model["weights"][col], len(texts)) + model["bias"]
    return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))


def learn_from(docs: DataFrame, labels: DataFrame, train, label_col: str = "quality", max_rows: int = MAX_ROWS) -> dict:
    """The model; ``train(id column)`` says which labelled rows may be learnt from.  Runs now."""
    return fit(labelled_sample(docs, labels, label_col, train, max_rows), learn)


def classify(docs: DataFrame, labels: DataFrame, train, label_col: str = "quality", max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, score) of every row of ``docs``; the model is fitted now, the scores when they are read."""
    model = learn_from(docs, labels, train, label_col, max_rows)
    return score(docs, lambda texts: predict(model, texts))

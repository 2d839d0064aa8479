import random

import numpy as np
from pyspark.sql import functions as F
from skuflow.llm import learning, toxicity
from tests.llm.test_quality import LABELS


def corpus(n=500, seed=4):
    rng = random.Random(seed)
    words, bad = ["tion", "and", "ther", "ing", "of", "ndre", "leath", "on"], ["gribbler", "snorkfaced", "plomp"]
    rows, labels = [], []
    for i in range(n):
        body = ["".join(rng.choices(words, k=rng.randint(1, 3))) for _ in range(rng.randint(20, 60))]
        toxic = rng.random() < 0.3
        for _ in range(rng.randint(2, 4) * toxic):
            w = rng.choice(bad)
            body.insert(rng.randint(0, len(body)), w.replace("o", "0") if rng.random() < 0.3 else w + ",")
        rows.append((i, " ".join(body)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_rows_are_told_apart(spark, docs_of):
    rows, labels = corpus()
    truth = {i: t for i, _, t in labels}
    docs = docs_of(rows + [(900, None), (901, ""), (None, "and ther"), (902, "x" * 60_000), rows[7]])
    labels += [(None, 1, 0), (3, 1, None), (10_000, 1, 1), labels[5]]
    out = learning.decisions(toxicity.classify(docs, spark.createDataFrame(labels, LABELS), lambda i: learning.bucket(i, 4) != 2), 4, 2).collect()
    held = [(truth[r.doc_id], r.predicted) for r in out if r.held_out and r.doc_id in truth]
    assert len(held) > 80 and np.mean([a == b for a, b in held]) > 0.95
    assert len(out) == 505 and all(0 <= r.score <= 1 for r in out)


def test_empty_tables_and_one_class(spark, docs_of):
    none = spark.createDataFrame([], LABELS)
    assert [r.score for r in toxicity.classify(docs_of([(1, "a b"), (2, None)]), none, lambda i: F.lit(True)).collect()] == [0.5, 0.5]
    assert toxicity.classify(docs_of([]), none, lambda i: F.lit(True)).count() == 0


def test_isotonic_is_the_least_squares_fit():
    rng = np.random.default_rng(1)
    x, y = rng.random(60), (rng.random(60) < 0.5).astype(float)
    px, py = toxicity.isotonic(x, y)
    order = np.argsort(x)
    want = [max(min(y[order][a:b].mean() for b in range(i + 1, 61)) for a in range(i + 1)) for i in range(60)]
    got = np.interp(x[order], px, py)
    sizes = {round(w, 9): sum(abs(w - v) < 1e-9 for v in want) for w in want}
    assert np.allclose(got, np.maximum.accumulate([(w * sizes[round(w, 9)] + 0.5) / (sizes[round(w, 9)] + 1) for w in want]))


def test_obfuscation_is_undone_and_signs_at_the_end_are_not_letters():
    t = toxicity.Tokens([b"pl0mp! 100 plomp!!", b"", b"PLOMP"])
    assert len(set(t.code.tolist())) == 1 and t.odd.tolist() == [True, False, False] and t.doc.tolist() == [0, 0, 2]

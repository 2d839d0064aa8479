import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from skuflow.llm import learning, quality


def corpus(n=400, seed=2):
    rng = random.Random(seed)
    words = ["tion", "and", "ther", "ing", "of", "ndre", "leath", "on"]
    rows, labels = [], []
    for i in range(n):
        body = ["".join(rng.choices(words, k=rng.randint(1, 3))) for _ in range(rng.randint(8, 60))]
        good = rng.random() < 0.7
        if not good:
            body = [w.upper() + "!!" for w in body] if rng.random() < 0.5 else [w for w in body for _ in range(6)]
        rows.append((i, " ".join(body)))
        labels.append((i, int(good), 0))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def scored(spark, docs_of):
    rows, labels = corpus()
    labels += [(None, 1, 0), (3, None, 0), (10_000, 1, 1), labels[5]]
    docs = docs_of(rows + [(900, None), (901, ""), (None, "and ther"), (902, "x" * 60_000), rows[7]])
    out = learning.decisions(quality.classify(docs, spark.createDataFrame(labels, LABELS), lambda i: learning.bucket(i, 5) != 0), 5, 0)
    return out.collect(), dict((i, q) for i, q, _ in labels[:400])


def test_held_out_rows_are_told_apart(scored):
    out, truth = scored
    held = [(truth[r.doc_id], r.predicted) for r in out if r.held_out and r.doc_id in truth]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.95


def test_every_row_has_a_score(scored):
    out, _ = scored
    assert len(out) == 405 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)


def test_empty_tables_and_one_class(spark, docs_of):
    docs = docs_of([(1, "a b"), (2, None)])
    none = spark.createDataFrame([], LABELS)
    assert [r.score for r in quality.classify(docs, none, lambda i: F.lit(True)).collect()] == [0.5, 0.5]
    assert quality.classify(docs_of([]), none, lambda i: F.lit(True)).count() == 0


def test_dual_descent_reaches_the_primal_optimum():
    rng = np.random.default_rng(0)
    n, d = 120, 6
    x = rng.normal(size=(n, d))
    y = np.where(x[:, 0] + 0.4 * rng.normal(size=n) > 0, 1.0, -1.0)
    doc, col = np.repeat(np.arange(n), d), np.tile(np.arange(d), n)
    w = quality.dual_coordinate_descent(doc, col, x.ravel(), y, epochs=400)
    share = np.where(y > 0, (y > 0).mean(), (y < 0).mean())

    def primal(v):
        return 0.5 * v @ v + (0.5 / share * np.maximum(0, 1 - y * (x @ v[:d] + v[d]))).sum()

    own = np.append(w[:d], w[-1])
    best = primal(own)
    for _ in range(300):
        assert primal(own + rng.normal(size=d + 1) * 0.02) >= best - 1e-3

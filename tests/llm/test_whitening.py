import numpy as np
import pytest
from skuflow.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, n long, dim int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], SCHEMA)


def integers(vectors):
    return np.floor(1024 * np.asarray(vectors, np.float32).astype(np.float64)).astype(np.int64) + 100000


def check(out, rows, components=8, tol=1e-7):
    """Against numpy's eigh, sign by sign."""
    x = integers([v for _, v in rows])
    n, s = len(x), x.sum(0)
    y = (n * x - s) / n
    cov = y.T @ y / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    want = y @ u / np.sqrt(e)
    order = {i: k for k, (i, _) in enumerate(rows)}
    have = np.full_like(want, np.nan)
    for r in out:
        k = order[r["vec_id"]]
        have[k, r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["deviation"] == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[k], s))
        assert abs(r["explained"] / (e[r["component"] - 1] / np.trace(cov)) - 1) < 1e-9
        assert r["identity_error"] < 1e-7
    assert len(out) == n * want.shape[1]
    sign = np.sign((have * want).sum(0))
    assert np.abs(have * sign - want).max() < tol
    return have


def data(n=400, dim=24, seed=2):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim)) * np.linspace(2, 0.05, dim) @ np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    return [(i, r.astype(np.float32).tolist()) for i, r in enumerate(v + 0.3)]


def test_same_as_eigh(spark):
    rows = data()
    check(W.digest_columns(W.whiten(frame(spark, rows).repartition(3))).collect(), rows)
    rows = data(50, 5, 3)
    check(W.digest_columns(W.whiten(frame(spark, rows))).collect(), rows)


def test_messy_rows(spark):
    rows = data(60, 6, 4)
    bad = [(900, None), (901, []), (902, [None] + [1.0] * 5), (903, [float("nan")] * 6), (904, [float("inf")] + [0.0] * 5), (905, [3e38] * 6), (None, None)]
    check(W.digest_columns(W.whiten(frame(spark, rows + bad).repartition(4))).collect(), rows)
    assert W.digest_columns(W.whiten(frame(spark, bad))).collect() == []
    assert W.digest_columns(W.whiten(frame(spark, []))).collect() == []


def test_repeats_null_ids_other_lengths(spark):
    rows = data(40, 4, 5)
    out = W.digest_columns(W.whiten(frame(spark, rows + [(None, rows[0][1]), (0, rows[0][1]), (7, [1.0, 2.0]), (8, [3.0, -1.0]), (9, [1.0, 1.0])]))).collect()
    assert len(out) == 42 * 4 + 3 * 2
    assert {r["n"] for r in out} == {42, 3} and sum(r["vec_id"] is None for r in out) == 4


def test_no_variance(spark):
    out = W.digest_columns(W.whiten(frame(spark, [(1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 4.0])]))).collect()
    by = {(r["vec_id"], r["component"]): r for r in out}
    assert len(out) == 6 and abs(abs(by[1, 1]["whitened"]) - 1) < 1e-12 and by[1, 1]["explained"] == 1
    assert by[1, 2]["whitened"] is None and by[2, 3]["whitened"] is None and by[2, 3]["explained"] == 0
    out = W.digest_columns(W.whiten(frame(spark, [(1, [5.0, 5.0])] * 3))).collect()
    assert len(out) == 6 and all(r["whitened"] is None and r["deviation"] == 0 for r in out)


def test_inertia_counts():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 8, 30):
        for _ in range(20):
            a = rng.normal(size=(n, n)).round(int(rng.integers(0, 3)))
            a = a + a.T
            e = np.linalg.eigvalsh(a)
            if np.abs(e).min() > 1e-9:
                assert W.negatives(a) == (e < 0).sum()


@pytest.mark.parametrize("values", [[5, 4, 3, 2, 1], [9, 9, 9, 1, 1, 0, 0], [1] * 6, [0] * 4, [1, 1 - 1e-7, 1 - 1e-12, 0.5, 1e-9, 0], list(np.geomspace(1e6, 1e-6, 40))])
def test_spectrum(values):
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0]
    m = (q * np.array(values, float)) @ q.T
    m = (m + m.T) / 2
    e, u = W.Spectrum(m).leading(8)
    scale = max(values) or 1
    assert np.abs(e - np.linalg.eigvalsh(m)[::-1][:8]).max() <= 1e-12 * scale
    assert np.abs(m @ u - u * e).max() <= 1e-12 * scale
    assert np.abs(u.T @ u - np.eye(len(e))).max() <= 1e-6


def test_squares_are_exact():
    big = np.array([[2 ** 40, -2 ** 40, 3], [1, 2, 3]], np.int64)
    assert W.squares(big) == [2 * 2 ** 80 + 9, 14]
    assert W.squares(W._scaled(np.array([[1, 2 ** 41]]), 1 << 30, [5, 7])) == [(2 ** 30 - 5) ** 2 + (2 ** 71 - 7) ** 2]

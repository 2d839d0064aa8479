import numpy as np
from skuflow.llm import vector_join as V

SCHEMA = "vec_id long, embedding array<float>, label int, rep long, unit string"


def brute(rows, cosine=0.9):
    def fine(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    ok = [k for k, (_, v) in enumerate(rows) if fine(v)]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    links = [0] * len(rows)
    unit = {k: np.asarray(rows[k][1], np.float64) / np.linalg.norm(np.asarray(rows[k][1], np.float64)) for k in ok}
    for a in ok:
        for b in ok:
            if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine:
                links[a] += 1
                links[b] += 1
                group[find(b)] = find(a)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return sorted(((i, links[k], low.get(find(k)), i is not None and i == low.get(find(k))) for k, (i, _) in enumerate(rows)), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x") for i, v in rows], SCHEMA)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def data(seed=3, n=300, dim=24):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    rows = []
    for i in range(n):
        v = centres[rng.integers(12)] + rng.normal(size=dim) * rng.choice([0.05, 0.25, 0.4, 2.0])
        rows.append((i, v.astype(np.float32).tolist()))
    return rows


def test_same_as_brute_force(spark):
    rows = data()
    rows += [(900 + k, rows[k][1]) for k in range(6)] + [(950, [2 * x for x in rows[0][1]])]
    assert got(V.link(frame(spark, rows).repartition(3))) == brute(rows)


def test_large_cells_go_chunk_by_chunk(spark, monkeypatch):
    monkeypatch.setattr(V, "CHUNK", 16)
    rows = data(5, 160, 10)
    assert got(V.link(frame(spark, rows))) == brute(rows)


def test_messy_rows(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, [float("inf"), 1.0]), (7, [1.0, -0.0]),
            (8, [1.0, 0.0]), (None, [1.0, 0.01]), (9, [1.0]), (9, [1.0]), (10, [3e38, 3e38]), (11, [1e-30, 1e-30]), (12, [1.0, 1.0, 0.0]), (None, None)]
    assert got(V.link(frame(spark, rows))) == brute(rows)
    assert got(V.link(frame(spark, []))) == []

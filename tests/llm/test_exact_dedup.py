import hashlib
from collections import Counter

import pytest
from skuflow.llm import exact_dedup as E

from .conftest import MESSY


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is not None, i or 0), reverse=True)
        out += [(i, ids[0], len(ids), k == 0, hashlib.sha256(t.encode()).hexdigest()) for k, i in enumerate(ids)]
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, E.digest_columns(df).collect()), key=str)


def skewed():
    """A third of all rows one text, some texts frequent, many rare."""
    rows = [(i, "hot") for i in range(0, 400)] + [(400 + i, f"warm {i % 7}") for i in range(210)]
    return rows + [(700 + i, f"cold {i % 350}") for i in range(600)] + [(5, "hot"), (None, "hot"), (None, None)]


@pytest.mark.parametrize("share", [1.0, 0.2, 0.02, 1 / 1024])
def test_same_as_brute_force(spark, docs_of, share):
    rows = skewed()
    assert got(E.mark_copies(docs_of(rows).repartition(5), share)) == brute(rows)


def test_messy_rows(docs_of):
    rows = MESSY + [(None, ""), (7, " a"), (8, "a"), (9, "A"), (10, "y" * 2_000_000), (11, "y" * 2_000_000)]
    assert got(E.mark_copies(docs_of(rows))) == brute(rows)
    assert got(E.mark_copies(docs_of([]))) == []
    assert got(E.mark_copies(docs_of([(None, "a"), (None, "a")]))) == brute([(None, "a"), (None, "a")])


def test_all_frequent_values_are_found_and_they_are_few(spark, docs_of):
    rows = E.texts_of(docs_of(skewed()).repartition(6)).selectExpr("cast(text as binary) as digest")
    counts = Counter((t or "").encode() for _, t in skewed())
    n = sum(counts.values())
    for share in (0.3, 0.1, 0.02):
        found = {bytes(r[0]) for r in E.frequent(rows, share).collect()}
        assert {k for k, c in counts.items() if c >= share * n} <= found
        assert len(found) <= 2 / share


def test_counters_bound_the_true_counts():
    kept, off = {}, 0
    values = [b"a"] * 50 + [bytes([k]) for k in range(200)] + [b"b"] * 30
    for at in range(0, len(values), 9):
        off += E.merge_counts(kept, Counter(values[at:at + 9]), 4)
    assert len(kept) <= 4 and off <= len(values) / 5
    true = Counter(values)
    for k, c in true.items():
        assert kept.get(k, 0) <= c <= kept.get(k, 0) + off

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F
from skuflow.llm import learning
from skuflow.llm import merkle as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g string, pos long, path string, `a b` int"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(i, text, lang, source, n):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)])


def levels(nodes):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [H(*nodes[k:k + 2]) for k in range(0, len(nodes), 2)]
        out.append(nodes)
    return out


def proof(tree, at):
    """(position in the run, sibling or None) per level."""
    out = []
    for nodes in tree[:-1]:
        out.append((at & 1, nodes[at ^ 1] if (at ^ 1) < len(nodes) else None))
        at >>= 1
    return out


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    groups = [sorted((r for r in rows if r[2] == v), key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r))) for v in langs]
    trees = [levels([leaf(*r) for r in own]) for own in groups]
    top = levels([t[-1][0] for t in trees])
    out = []
    for k, own in enumerate(groups):
        for at, (i, text, lang, source, n) in enumerate(own):
            path = proof(trees[k], at) + proof(top, k)
            first = leaf(i, text, lang, source, n)
            hit = i is not None and zlib.crc32(str(i).encode()) % 7 == 0
            value = leaf(i, text, lang, source, None if n is None else n + 1) if hit else first
            for right, other in path:
                value = H(value) if other is None else H(other, value) if right else H(value, other)
            out.append((i, first, trees[k][-1][0], top[-1][0], H(*[o for _, o in path if o]), value, value == top[-1][0]))
    return sorted(out, key=str)


def got(spark, rows, **args):
    docs = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA).repartition(3)
    df = M.digest_columns(M.manifest(docs, learning.bucket(F.col("doc_id"), 7) == 0, **args))
    return sorted(map(tuple, df.collect()), key=str)


def table(n, langs=("en", "de", None, "zh")):
    return [(k * 3, f"text {k}" if k % 11 else None, langs[k * k % len(langs)], "s" if k % 5 else None, k if k % 3 else None) for k in range(n)]


@pytest.mark.parametrize("n, block_levels", [(1, 12), (2, 1), (7, 1), (45, 1), (45, 2), (130, 2), (130, 3), (130, 12)])
def test_same_as_brute_force(spark, n, block_levels):
    rows = table(n)
    out = got(spark, rows, block_levels=block_levels)
    assert out == brute(rows)
    assert n < 45 or {r[-1] for r in out} == {True, False}


def test_messy_rows(spark):
    rows = [(None, None, None, None, None), (None, "", "", "", 0), (1, "x" * 1_500_000, "en", "s", 1), (1, "b", "en", "s", 1), (1, "b", "en", "s", 1),
            (2, "é 漢\x00", "é", "-", -5), (9, "1:a", "=", "", 2), (21, "t", "z", "s", 9), (2 ** 62, "big", "en", "s", 2 ** 62)]
    assert got(spark, rows, block_levels=1) == brute(rows)
    assert got(spark, rows[:1]) == brute(rows[:1])
    assert got(spark, []) == []


def test_every_group_of_one_row(spark):
    rows = [(k, "t", f"lang {k}", "s", 1) for k in range(20)]
    assert got(spark, rows, block_levels=2) == brute(rows)


def test_a_version_copies_only_ancestors():
    store = M.Store()
    leaves = [H(str(k)) for k in range(13)]
    first = store.build(leaves, 4)
    before = list(store.nodes)
    second = store.with_leaf(first, 5, H("x"), 4)
    assert store.nodes[:len(before)] == before and len(store.nodes) == len(before) + 5
    changed = leaves[:5] + [H("x")] + leaves[6:]
    assert store.nodes[second][0] == levels(changed)[-1][0] and store.nodes[first][0] == levels(leaves)[-1][0]
    assert store.siblings(first, 5, 4) == store.siblings(second, 5, 4)
    third = store.with_leaf(second, 12, H("y"), 4)                  # a version of a version
    assert store.nodes[third][0] == levels(changed[:12] + [H("y")])[-1][0]


def test_proof_has_sides(spark):
    docs = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in table(30, ("en",))], SCHEMA)
    for r in M.manifest(docs, block_levels=2).collect():
        assert M.fold(r["leaf"], r["proof"].split()) == r["root"] == r["version_root"] == r["subroot"]

"""The pipeline's stages against brute force, on the smallest documents table and on messy rows."""

import re

import corpus_pipeline as P
import numpy as np
import pytest
from pyspark.sql import functions as F
from skuflow.llm import common
from tests.llm.test_packing import check, library_ids
from tests.llm.test_pii import PLAIN
from tests.llm.test_shingle_join import brute as near_brute

SF = "/root/testdata/sf0.001"
STAGES = dict(P.STAGES)


@pytest.fixture(scope="module")
def staged(spark):
    """The documents before and after each stage."""
    out = [common.read_table(spark, SF, "documents")]
    for _, stage in P.STAGES:
        out.append(common.written(stage(spark, out[-1], SF), "test-stage"))
    return out


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_columns_stay_until_the_last_stage(staged):
    for df in staged[:-1]:
        assert sorted(df.columns) == sorted(P.COLUMNS)
    assert all(r.n_chars == len(r.text) for df in staged[3:5] for r in df.collect())


def test_quality_keeps_clean_documents(spark, staged):
    labels = {r.doc_id: r.quality for r in common.read_table(spark, SF, "labels").collect()}
    before, kept = dict(rows(staged[0])), dict(rows(staged[1]))
    assert all(before[i] == t for i, t in kept.items())
    good = [i in kept for i, q in labels.items() if q == 1]
    assert np.mean(good) > 0.95


def test_near_keeps_one_of_each_group(staged):
    before = rows(staged[1])
    want = {i for i, _, component in near_brute(before, 5, 80) if i == component or not component}
    empty = {i for i, t in before if not re.search(r"[^\x20\x09-\x0D]", t or "")}
    assert {i for i, _ in rows(staged[2])} == want | empty


def test_repeats_are_cut(staged):
    from tests.llm.test_substrings import brute

    before = rows(staged[2])
    want = {i: n - gone for i, n, gone, _, _ in brute(before, 200)}
    got = {i: len((t or "").encode()) for i, t in rows(staged[3])}
    assert set(got) == set(want) and all(want[i] - 6 <= got[i] <= want[i] for i in got)   # cut characters go as a whole


def test_no_personal_data_is_left(staged):
    before, after = dict(rows(staged[3])), dict(rows(staged[4]))
    assert set(before) == set(after)
    for i, t in after.items():
        assert not re.search(PLAIN["email"], t)
        if not any(re.search(p, before[i]) for p in PLAIN.values()):
            assert t == before[i]


def test_packed_pieces_hold_all_texts(staged):
    expected = {i: library_ids(t) for i, t in rows(staged[4])}
    check(staged[5].collect(), expected, 2048)


def test_run_gives_the_last_stage(spark, staged):
    a = P.run(spark, SF).agg(F.count("*"), F.sum("length")).first()
    b = staged[5].agg(F.count("*"), F.sum("length")).first()
    assert tuple(a) == tuple(b)


MESSY = [(1, None), (1, None), (2, ""), (None, "the same five words here now"), (3, "the same five words here now"), (3, "the same five words here now"),
         (None, "alone among the rows that have no id"), (4, "mail bob@mail.example.com\x00 é"), (5, "x" * 3000), (6, "y" + "x" * 3000)]


def test_messy_rows_pass_every_stage(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, t1 long, spans string, row string, base int"
    docs = spark.createDataFrame([(i, t, None, None, None, 1, "x", "y", 2) for i, t in MESSY], schema)
    out = {name: common.written(stage(spark, docs, SF), "messy") for name, stage in P.STAGES}
    near = rows(out["near"])
    assert sorted(near, key=str) == sorted([(1, None), (2, ""), (3, "the same five words here now"), (None, "alone among the rows that have no id"),
                                            (4, "mail bob@mail.example.com\x00 é"), (5, "x" * 3000), (6, "y" + "x" * 3000)], key=str)
    assert out["repeats"].count() == out["pii"].count() == len(MESSY)
    assert dict(rows(out["pii"]))[4] == "mail [EMAIL]\x00 é"
    assert dict(rows(out["repeats"]))[5] == "" and dict(rows(out["repeats"]))[6] == "y"
    empty = docs.limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, empty, SF).count() == 0


def near_kept(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return sorted(((r.doc_id, r.text) for r in STAGES["near"](spark, docs.repartition(3), SF).collect()), key=str)


def sentence(k, words=60, changed=()):
    return " ".join(f"x{k}" if j in changed else f"w{k}-{j}" for j in range(words))


def test_near_loses_no_group_when_an_id_stands_on_unrelated_texts(spark):
    a, b, b2 = sentence(1), sentence(2), sentence(2, changed=(59,))
    assert near_kept(spark, [(1, a), (1, b), (2, b2)]) == sorted([(1, a), (1, b)], key=str)
    # the group's smallest id is not the one that clashes
    c, c2 = sentence(3), sentence(3, changed=(0,))
    assert near_kept(spark, [(5, a), (5, c), (4, c2), (6, b)]) == sorted([(5, a), (4, c2), (6, b)], key=str)


def test_near_rows_without_an_id(spark):
    a, a2, b = sentence(1), sentence(1, changed=(59,)), sentence(2)
    out = near_kept(spark, [(None, a), (None, a2), (None, b), (None, b), (7, None), (7, ""), (None, " ")])
    assert len([t for _, t in out if t in (a, a2)]) == 1 and (None, b) in out and len(out) == 4
    assert near_kept(spark, [(None, a), (9, a2), (None, a)]) == [(9, a2)]


def test_near_many_copies(spark):
    a, near = sentence(1), [sentence(1, changed=(k,)) for k in (0, 59)]
    rows = [(100 + k, a) for k in range(200)] + [(400 + k, near[k % 2]) for k in range(100)] + [(3, sentence(2))]
    assert near_kept(spark, rows) == sorted([(100, a), (3, sentence(2))], key=str)

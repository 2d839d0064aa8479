import random
import re
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from skuflow.llm import common as C
from skuflow.llm import shingle_join as J
from tests.llm.conftest import MESSY


def brute(rows, words, percent):
    sets = []
    for _, t in rows:
        w = [x for x in re.split("[\x20\x09-\x0d]+", "".join(c.lower() if c.isascii() else c for c in t or "")) if x]
        sets.append(frozenset(tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1))) if w else frozenset())
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                group[find(i)] = find(j)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return sorted(((i, len(sets[k]), low.get(find(k))) for k, (i, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def near_copies(rng, n):
    words = ["a", "the", "nd", "er", "ing", "On", "It", "é", "x,", "thin", "ou"]
    text = lambda k: [rng.choice(words) + rng.choice(words) for _ in range(k)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            w = rng.choice(rows)[1].split()
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = rng.choice(words) * 2
            if rng.random() < 0.3:
                w += text(rng.randint(1, 6))
            rows.append((i, "\t ".join(w).upper() if rng.random() < 0.2 else " ".join(w)))
        else:
            rows.append((i, " ".join(text(rng.choice([1, 2, 3, 4, 5, 8, 13, 30, 60, 200])))))
    return rows


def test_same_components_as_brute_force(docs_of):
    rows = near_copies(random.Random(8), 220)
    for words, percent in ((4, 85), (5, 80)):
        assert got(J.link(docs_of(rows).repartition(4), words, percent)) == brute(rows, words, percent)


def test_large_parts_go_block_by_block(docs_of, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 4)
    rows = near_copies(random.Random(9), 90)
    assert got(J.link(docs_of(rows), 4, 85)) == brute(rows, 4, 85)


def test_copies_give_their_parts_once_a_task(spark):
    C.ship(spark)
    text = " ".join(f"w{k}" for k in range(60))
    own = spark.range(0, 12_000, 1, 1).select(F.col("id").alias("doc_id"), F.lit(7).cast("long").alias("text_hash"), F.lit(text).alias("text"))

    def parts(n):
        rows = J._signed(own.limit(n), 5, 80)
        return rows.where("sketch is null").count(), rows.where("sketch is not null").count()

    (one, _), (many, rows) = parts(1), parts(12_000)         # more than a batch
    assert one == many > 0 and rows == 12_000


def test_messy_rows(messy, docs_of):
    assert got(J.link(messy, 4, 85)) == brute(MESSY, 4, 85)
    assert got(J.link(docs_of([]))) == []


def test_every_linked_pair_shares_a_part():
    rng = np.random.default_rng(4)
    bands = J.Bands(85, 3000)
    for _ in range(400):
        b = int(rng.integers(1, 400))
        codes = np.unique(rng.integers(0, 2 ** 63, b, dtype=np.uint64))
        most = len(codes) * 15 // 100
        gone = int(rng.integers(0, most + 1))
        other = rng.permutation(codes)[gone:]
        add = 0
        while 100 * (len(codes) - gone) >= 85 * (len(codes) + add + 1) and rng.random() < 0.8:
            add += 1
        other = np.unique(np.concatenate([other, rng.integers(0, 2 ** 63, add, dtype=np.uint64)]))
        both = len(np.intersect1d(codes, other))
        if 100 * both < 85 * len(np.union1d(codes, other)):
            continue
        found = []
        for s in (codes, other):
            _, keys = J.part_keys(np.zeros(len(s), np.int64), s, np.array([len(s)]), bands)
            found.append(set(keys.tolist()))
        assert found[0] & found[1]


class Members:
    """Stands for the members' frame: keeps the function that its tasks run."""

    def __getattr__(self, name):
        return lambda *args, **_: setattr(self, "run", args[0]) or self if name == "mapInArrow" else self


def compared(rows, percent):
    """What a task tells of ``rows`` (key, side_a, side_b, own, node, class, n, sketch): pairs, keys with more."""
    frame = Members()
    J._unlinked_pairs(frame, percent, None)
    names = ["key", "side_a", "side_b", "own", "node", "class", "n", "sketch"]
    batch = pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.int64()) if n == "sketch" else pa.int64()) for n, x in zip(names, zip(*rows))], names)
    out = pa.Table.from_batches(list(frame.run(iter([batch.slice(k, 500) for k in range(0, len(rows), 500)]))))
    return {(a, b) for a, b in zip(out["a"].to_pylist(), out["b"].to_pylist()) if a is not None}


def sketched(sets):
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    return J.sketches(owner, np.concatenate(sets), np.array([len(s) for s in sets])).to_pylist()


def test_sketches_of_all_lengths_are_compared_as_one_by_one():
    """Parts of few and of many members, one block or two, lengths that differ by a fold, near copies in between."""
    rng, rows, want, node = np.random.default_rng(5), [], set(), 0
    for key, (size, sides) in enumerate([(2, (0, 0)), (3, (0, 0)), (9, (0, 1)), (70, (0, 0)), (90, (1, 2)), (1, (0, 0))]):
        sets = []
        for _ in range(size):
            if sets and rng.random() < 0.5:
                s = sets[rng.integers(len(sets))]
                s = np.unique(np.concatenate([s[rng.integers(0, 1 + len(s) // 8):], rng.integers(0, 2 ** 63, rng.integers(0, 1 + len(s) // 8), dtype=np.uint64)]))
            else:
                s = np.unique(rng.integers(0, 2 ** 63, rng.choice([3, 300, 500, 530, 900, 1100, 2500]), dtype=np.uint64))
            sets.append(s)
        told = [(key, *sides, int(rng.choice(sides)), node + k, int(rng.integers(node, node + size // 2 + 1)), len(s), sk)
                for k, (s, sk) in enumerate(zip(sets, sketched(sets)))]
        node += size
        rows += told
        for x in told:
            for y in told:
                if x[4] <= y[4] or x[5] == y[5] or (sides[0] != sides[1] and x[3] == y[3]) or 100 * min(x[6], y[6]) < 80 * max(x[6], y[6]):
                    continue
                short, long = sorted((x[7], y[7]), key=len)
                if len(long) > len(short):
                    long = [p ^ q for p, q in zip(long[:len(short)], long[len(short):])]
                apart = sum(((p ^ q) & (2 ** 64 - 1)).bit_count() for p, q in zip(short, long))
                if apart * 180 <= (x[6] + y[6]) * 20:
                    want.add((x[4], y[4]))
    assert compared(rows, 80) == want and want


def test_a_large_mixed_part_is_compared_many_pairs_at_a_time():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 2 ** 63, 480, dtype=np.uint64)) for _ in range(3000)]
    rows = [(1, 0, 0, 0, k, k, len(s), sk) for k, (s, sk) in enumerate(zip(sets, sketched(sets)))]
    began = time.process_time()
    assert compared(rows, 80) == set()
    assert time.process_time() - began < 1.2              # 4.5 million pairs


def with_a_passage(rng, n, copies):
    """``n`` texts that have a passage in common and are otherwise their own, then near copies of some."""
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    passage = [word() for _ in range(60)]
    rows = [(i, " ".join([word() for _ in range(30)] + passage + [word() for _ in range(30)])) for i in range(n)]
    for i in range(copies):
        w = rng.choice(rows[:n])[1].split()
        w[rng.randrange(len(w))] = word()
        rows.append((n + i, " ".join(w)))
    return rows


def test_a_common_passage_does_not_bring_its_texts_together(docs_of, monkeypatch):
    """Parts that only common shingles fill are left out: what is compared does not grow with the passage's texts."""
    sizes = {}
    keep = J.written

    def counted(df, label):
        out = keep(df, label)
        sizes.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(J, "written", counted)
    rows = with_a_passage(random.Random(11), 250, 25)
    assert got(J.link(docs_of(rows).repartition(3), 5, 80)) == brute(rows, 5, 80)
    assert sizes["shingle-members"][0] < 500          # 275 texts; with those parts it is thousands


def test_every_linked_pair_shares_a_part_whatever_is_common():
    """Also where most or all shingles of a set are common, or what is counted as common is far off."""
    rng = np.random.default_rng(7)
    linked = 0
    for k in range(400):
        pool = np.unique(rng.integers(0, 2 ** 63, 300, dtype=np.uint64))
        common = J.Common(pool, rng.integers(1, 1 << int(rng.integers(1, 30)), len(pool)))
        percent = int(rng.choice([60, 80, 85, 100]))
        bands = J.Bands(percent, 3000)
        held = rng.permutation(pool)[:int(rng.integers(0, 300))]
        codes = np.unique(np.concatenate([held, rng.integers(0, 2 ** 63, int(rng.integers(1, 200)) if k % 3 else 1, dtype=np.uint64)]))
        most = len(codes) * (100 - percent) // 100
        gone = int(rng.integers(0, most + 1))
        other = np.unique(np.concatenate([rng.permutation(codes)[gone:], rng.integers(0, 2 ** 63, int(rng.integers(0, most - gone + 1)), dtype=np.uint64)]))
        if 100 * len(np.intersect1d(codes, other)) < percent * len(np.union1d(codes, other)):
            continue
        linked += 1
        owner, both = np.repeat([0, 1], [len(codes), len(other)]), np.concatenate([codes, other])
        sets, keys = J.part_keys(owner, both, np.bincount(owner), bands, common)
        assert set(keys[sets == 0].tolist()) & set(keys[sets == 1].tolist())
    assert linked > 200


def test_common_shingles_are_counted_once_a_set(docs_of, monkeypatch):
    rows = with_a_passage(random.Random(12), 40, 0) + [(100 + k, "one two three four five six seven") for k in range(9)]
    own = C.texts_of(docs_of(rows).repartition(1)).withColumn("text_hash", F.xxhash64("text"))
    assert sorted(J._common(own, 5).times.tolist()) == [40] * 56
    monkeypatch.setattr(J, "COMMON", 10)
    assert len(J._common(own, 5).times) == 0                  # all are as common: none can be chosen
    assert len(J._common(C.texts_of(docs_of([])).withColumn("text_hash", F.xxhash64("text")), 5).times) == 0


def test_a_large_class_is_not_compared_with_itself():
    """A part of one large class and a few others, in one block and in two."""
    rng = np.random.default_rng(8)
    base = np.unique(rng.integers(0, 2 ** 63, 480, dtype=np.uint64))
    sets = [np.unique(np.concatenate([base[1:], rng.integers(0, 2 ** 63, 1, dtype=np.uint64)])) for _ in range(3000)]
    sk = sketched(sets)
    label = [1] * 2990 + [2] * 5 + list(range(3, 8))
    near = lambda x, y: {(max(a, b), min(a, b)) for a in x for b in y if label[a] != label[b]}
    began = time.process_time()
    assert compared([(1, 0, 0, 0, k, label[k], len(s), sk[k]) for k, s in enumerate(sets)], 80) == near(range(3000), range(2990, 3000))
    left, right = range(0, 3000, 2), range(1, 3000, 2)
    assert compared([(1, 0, 1, k % 2, k, label[k], len(s), sk[k]) for k, s in enumerate(sets)], 80) == near(left, right)
    assert time.process_time() - began < 5

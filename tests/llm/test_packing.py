import functools
import random
import zlib
from collections import defaultdict

import numpy as np
from tests.llm.conftest import MESSY
from skuflow.llm import packing
from skuflow.llm.queries import tokenizer_path

JSON, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


@functools.cache
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(JSON))


def library_ids(text):
    return [*library().encode(text or "", add_special_tokens=False).ids, 1]


def check(pieces, expected, size):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append((p.offset, p.length))
    assert sorted(by_doc) == sorted(expected)
    for doc, ps in by_doc.items():
        ids = np.concatenate([np.frombuffer(p.ids, "<u4") for p in sorted(ps, key=lambda p: p.start)]).tolist()
        assert ids == expected[doc] and all(p.doc_tokens == len(ids) for p in ps)
        assert [p.start for p in sorted(ps, key=lambda p: p.start)] == list(np.cumsum([0] + [p.length for p in sorted(ps, key=lambda p: p.start)])[:-1])
    fills = []
    for spans in by_seq.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= size
        fills.append(at)
    return fills


def test_pieces_hold_every_id_once(spark, docs_of):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["the", "worthless", "ñjaosñ", "42", "über."]) for _ in range(rng.randint(0, 400)))) for i in range(300)]
    expected = {i: library_ids(t) for i, t in rows}
    out = packing.pack(docs_of(rows).repartition(3), tokenizer_path(JSON), tokenizer_path(RANKS), size=256).collect()
    fills = check(out, expected, 256)
    assert sum(f < 256 for f in fills) <= 3          # one window for each task at most


def test_messy_rows_and_digest(spark, messy, docs_of):
    keep = [(i, t) for i, t in MESSY if i not in (None, 4)]
    out = packing.pack(docs_of(keep), tokenizer_path(JSON), tokenizer_path(RANKS), size=64)
    check(out.collect(), {i: library_ids(t) for i, t in keep}, 64)
    for a, b in zip(out.orderBy("sequence_id", "offset").collect(), packing.pieces_digest(out).orderBy("sequence_id", "offset").collect()):
        assert b.ids_crc32 == zlib.crc32(a.ids) and b.length * 4 == len(a.ids)
    n = packing.pack(messy, tokenizer_path(JSON), size=64).groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] for r in n}[4] == 2 * len(library_ids("a b c d e f")) and None in {r[0] for r in n}
    assert packing.pack(docs_of([]), tokenizer_path(JSON)).count() == 0


def test_level_is_the_one_of_least_squares():
    rng = random.Random(1)
    packer = packing.LevelPacker(16)
    for k in range(500):
        n = rng.randint(1, 15)
        before = packer.open.copy()

        def squares(level):
            after = before.copy()
            after[level] -= level > 0
            if level + n < 16:
                after[level + n] += 1
            return int((after[:16] ** 2).sum())

        options = [lv for lv in range(0, 17 - n) if lv == 0 or before[lv]]
        list(packer.put(k, np.zeros(n, "<u4")))
        assert int((packer.open[:16] ** 2).sum()) == min(map(squares, options))
    assert all(len(w) == n for w, n in zip(packer.windows, packer.open))

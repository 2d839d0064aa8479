import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from skuflow.llm import common as C


def test_components(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(220)] + [(500 + k, 501 + k) for k in range(40)]
    pairs += [(700, 700 + k) for k in range(60)] + [(3, 3), (None, 5), (6, None)]
    out = dict(map(tuple, C.components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    low = {n: n for p in pairs for n in p if n is not None}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if a is not None and b is not None and low[a] != low[b]:
                low[a] = low[b] = min(low[a], low[b])
                changed = True
    linked = {n for a, b in pairs if a is not None and b is not None and a != b for n in (a, b)}
    assert out == {n: low[n] for n in linked}
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words():
    texts = ["", " a\tB  c\x0b", "É é", "x" * 200_000 + " y", "\n", "end"]
    w = C.Words([t.encode() for t in texts])
    lower = lambda s: bytes(b + 32 if 65 <= b <= 90 else b for b in s)
    want = [(i, lower(p)) for i, t in enumerate(texts) for p in t.encode().split()]
    got = [(int(d), w.data[s:e].tobytes()) for d, s, e in zip(w.doc, w.start, w.end)]
    assert got == want
    code = {}
    for (_, word), c in zip(want, w.code.tolist()):
        assert code.setdefault(word, c) == c
    assert len(set(code.values())) == len(code)
    assert C.range_hash(np.frombuffer(b"abcabc", np.uint8), np.array([0, 3]), np.array([3, 6])).tolist()[0] == \
        C.range_hash(np.frombuffer(b"xxabc", np.uint8), np.array([2]), np.array([5])).tolist()[0]


def test_python_gets_batches_of_few_bytes(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["rows", "bytes"])

    texts = spark.range(3000).select(F.repeat(F.lit("x"), 8000).alias("text")).coalesce(1)
    before = spark.conf.get(C.BATCH_CONF)
    rows, most = C.written(texts.mapInArrow(sizes, "rows long, bytes long"), "sizes").agg(F.sum("rows"), F.max("bytes")).first()
    assert rows == 3000 and most < 2 * C.BATCH_BYTES
    assert spark.conf.get(C.BATCH_CONF) == before


def test_memory_let_go_is_handed_back():
    def resident():
        return int(open("/proc/self/statm").read().split()[1]) * 4096

    held = [np.ones(1 << 12) for _ in range(8000)]        # 32 KB each
    kept = held[::100]
    del held
    before = resident()
    C.give_back()
    assert before - resident() > 100 << 20 and len(kept) == 80

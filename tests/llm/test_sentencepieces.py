import functools
import hashlib
import random

from skuflow.llm import sentencepieces as S
from skuflow.llm.queries import tokenizer_path
from tests.llm.conftest import MESSY

MODEL = tokenizer_path("piece_bpe_32k.model")


@functools.cache
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_same_ids_and_text_as_the_library(spark, docs_of):
    rng = random.Random(3)
    alphabet = ["a", "th", "in", " ", "  ", "\t", "\n", "▁", "é", "ß", "漢", "\U0001f600", "<s>", "<0x41>", "1", ".", "’", "\x00", "　", "ﬁ"]
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))) for i in range(600)]
    rows += [(1000, " " * 41), (1001, "a" * 3000), (1002, "ab" * 500 + " " * 33 + "ab"), (1003, None)]
    out = {r.doc_id: r for r in S.encode(docs_of(rows), MODEL).collect()}
    for i, t in rows:
        ids = library().encode(t or "")
        assert out[i].ids == ids, t
        assert out[i].decoded == library().decode(ids)


def test_digest_and_messy_rows(messy, docs_of):
    got = sorted(map(tuple, S.digest(S.encode(messy, MODEL)).collect()), key=str)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in MESSY:
        ids = library().encode(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library().decode(ids))))
    assert got == sorted(want, key=str)
    assert S.encode(docs_of([]), MODEL).count() == 0

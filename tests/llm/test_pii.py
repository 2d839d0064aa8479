import hashlib
import random
import re

from pyspark.sql import functions as F
from skuflow.llm import pii
from tests.llm.conftest import MESSY

# the base as its contract states it
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def base_of(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or "", re.ASCII):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                  "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def said(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)


def want(i, t):
    b = base_of(t)
    return (i, *(sum(x[3] == k for x in b) for k in PLAIN), hashlib.sha256(said(b).encode()).hexdigest(), said(b))


def rows(seed=6, n=500):
    rng = random.Random(seed)
    bits = ["a", "é", "\U0001f600", ".", "@", "-", "+1", "0", "25", "192.168.0.1", "1.2.3", " ", " ", "\n", "x@y.z", "%", "_", "(", ")", "256",
            "4111 1111 1111 1111", "378282246310005", "00004111-1111-1111-1111", "+44 (20) 7946-0958", "bob.b@mail8.example.com", "..", "999.1.1.1", "007.000.1.01"]
    return [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for i in range(n)]


def test_base_spans_are_those_of_the_plain_patterns(docs_of):
    data = rows() + [(9000, None), (9001, "a@b" + ".c" * 20_000), (9002, "1" * 50_000), (9003, "a" * 60_000 + "@"), (9004, "1.1.1.1 " * 3000),
                     (9005, "+1" + "(" * 40_000), (9006, "1-" * 30_000)]
    got = sorted(map(tuple, pii.digest(pii.find(docs_of(data))).collect()))
    assert got == sorted(want(i, t) for i, t in data)


def test_messy_rows(messy, docs_of):
    got = sorted(map(tuple, pii.digest(pii.find(messy)).collect()), key=str)
    assert got == sorted((want(i, t) for i, t in MESSY), key=str)
    assert pii.find(docs_of([])).count() == 0


def corpus():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("bdfglmnprst") + rng.choice("aeiou") for _ in range(3))
    common = [word() for _ in range(40)]
    fill = lambda k: " ".join(rng.choice(common) for _ in range(k))
    data = [(i, fill(30)) for i in range(150)]
    # 'zorblax' stands next to one address only, in different contexts; the copies of 'quintle' are one context
    data += [(200 + i, f"{fill(6)} Zorblax wrote to ann@mail.example.com {fill(6)}") for i in range(5)]
    data += [(300 + i, f"{common[0]} quintle is bob@mail.example.com {common[1]}") for i in range(9)]
    return data


def test_terms_that_disclose_an_entity(spark, docs_of):
    data = corpus()
    docs = docs_of(data)
    out = {r.doc_id: r.spans for r in pii.find(docs, min_contexts=3).collect()}
    text = dict(data)
    found = {text[i][s.start:s.end].lower() for i, spans in out.items() for s in spans if s.rank == 4}
    # brute force over the same definition
    n = len(data)
    df = lambda f: sum(bool(f(t)) for _, t in data)
    words = {w for _, t in data for w in re.findall(r"[a-z]{4,}", t.lower())}
    assert "zorblax" in found and "quintle" not in found
    for w in found:
        import math

        e, et, t = df(lambda x: "ann@" in x), df(lambda x: "ann@" in x and w in x.lower()), df(lambda x: re.search(rf"\b{w}\b", x.lower()))
        assert w in words and math.log2(n * et / (e * t)) / math.log2(n / e) >= 0.7
    assert not any(s.rank == 4 for i, spans in out.items() if i < 200 for s in spans)


def test_sanitised_text(spark, docs_of):
    data = corpus()
    docs = docs_of(data)
    joined = docs.select("doc_id", "text").join(pii.find(docs), "doc_id")
    out = {r[0]: r[1] for r in joined.select("doc_id", pii.sanitised(F.col("text"), F.col("spans"))).collect()}
    assert all(out[i] == t for i, t in data if i < 200)
    assert all("[EMAIL]" in out[i] and "@" not in out[i] for i, _ in data if i >= 200)
    assert all("orblax" not in out[i] for i, _ in data if 200 <= i < 300)
    over = spark.sql("select 'abcdef' t, array(named_struct('start', 1L, 'rank', 0, 'end', 4L, 'action', 'replace'), "
                     "named_struct('start', 2L, 'rank', 2, 'end', 5L, 'action', 'replace')) s")
    assert over.select(pii.sanitised(F.col("t"), F.col("s"))).first()[0] == "a[EMAIL]f"


def test_terms_far_away_short_and_in_two_texts(docs_of):
    rng = random.Random(8)
    fill = lambda k: " ".join(rng.choice(["bado", "fide", "gulo", "mare", "nipo"]) for _ in range(k))
    data = [(1000 + i, fill(30)) for i in range(600)]
    data += [(200 + i, f"Ann {fill(30)} {fill(3)} x7@mail.example.com {fill(30 + i)} 李明") for i in range(2)]
    data += [(300 + i, f"Bea {fill(1)} y8@mail.example.com") for i in range(1)] * 6         # copies of one text
    out = [(r.doc_id, r.spans) for r in pii.find(docs_of(data)).collect()]
    text = dict(data)
    found = {(i, text[i][s.start:s.end]) for i, spans in out for s in spans if s.rank == 4}
    assert found == {(i, w) for i in (200, 201) for w in ("Ann", "李明")}


def test_counts_are_of_whole_documents(spark, docs_of):
    rng = random.Random(5)
    words = ["ka", "lo", "mi", "nu", "pe", "ro", "su", "ta", "vi", "wex"]
    data = [(i, " ".join(rng.sample(words, 3)) + rng.choice([" ", " a@ka.de ", " b@lo.de ", " a@ka.de b@lo.de "]) + rng.choice(words)) for i in range(60)]
    data += data[:7]
    own = docs_of(data)
    slim = pii._annotated(own, "doc_id", "text").where("size(base) > 0").groupBy("t1", "t2").agg(
        F.first("text").alias("text"), F.first("base").alias("base"), F.count("*").alias("copies"))
    texts = slim.withColumn("blank", pii._blanked(F.col("text"), F.col("base")))
    got = {(r.entity, r.term): r.share for r in pii.disclosures(texts, own, max_chance=1e9, generalise_at=-100.0).collect()}
    import math

    outside = [(t, set(re.sub(r"\S+@\S+", " ", t).split())) for _, t in data]
    want = {}
    for e in ("a@ka.de", "b@lo.de"):
        for w in words:
            both, df_e, df_t = (sum(x) for x in zip(*((e in t and w in ws, e in t, w in ws) for t, ws in outside)))
            if len({t for t, ws in outside if e in t and w in ws}) >= 2:
                want["0:" + e, w] = math.log2(len(data) * both / (df_e * df_t)) / math.log2(len(data) / df_e)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_pairs_are_counted_without_collecting_the_corpus(docs_of, monkeypatch):
    plans = {}
    put = pii.written
    monkeypatch.setattr(pii, "written", lambda df, label: (plans.setdefault(label, df._jdf.queryExecution().optimizedPlan().toString()), put(df, label))[1])
    assert pii.find(docs_of(corpus())).count() == len(corpus())
    assert "collect_set" not in "".join(plans.values())
    assert "sum(copies" in plans["pii-pairs"] and "count(1)" in plans["pii-pairs"]


def test_parts_of_values_are_entities(docs_of):
    rng = random.Random(12)
    words = ["bado", "fide", "gulo", "mare", "nipo", "rute"]
    fill = lambda k: " ".join(rng.choice(words) for _ in range(k))
    data = [(i, fill(20)) for i in range(400)]
    # no value occurs twice, but the domain's documents name its firm, and the network's its site
    data += [(1000 + i, f"{fill(4)} Quorvex {fill(3)} u{i}@hq.quorvex.example {fill(5 + i)}") for i in range(6)]
    data += [(2000 + i, f"{fill(4)} 10.20.30.{i} {fill(3)} Tolmir {fill(5 + i)}") for i in range(6)]
    data += [(3000 + i, f"{fill(9 + i)} zz{i}q@mail{i}.example") for i in range(6)]
    text = dict(data)
    hidden = lambda **kw: {(r.doc_id, text[r.doc_id][s.start:s.end]) for r in pii.find(docs_of(data), **kw).collect() for s in r.spans if s.rank == 4}
    assert hidden() == {(1000 + i, "Quorvex") for i in range(6)} | {(2000 + i, "Tolmir") for i in range(6)}
    assert hidden(parts=False) == set()


def plain_disclosures(data, min_contexts=2, max_chance=0.0001, least=0.7):
    """(entity, term) by the definition, over lists of documents."""
    import math
    from collections import Counter, defaultdict

    def parts(kind, v):
        v = v.lower()
        digits = re.sub("[^0-9]", "", v)
        more = {"email": ["domain:" + v.split("@")[-1]] + ["name:" + w for w in re.split("[^a-z]+", v.split("@")[0]) if len(w) >= 3 and w not in pii.FUNCTION_WORDS],
                "ip": ["net:" + ".".join(v.split(".")[:3])], "card": ["issuer:" + digits[:6]], "phone": ["area:" + digits[:-7]]}[kind]
        return {f"{list(PLAIN).index(kind)}:{v}", *more}

    def seen(t):
        base, chars = base_of(t), list(t)
        for a, _, b, _ in base:
            chars[a:b] = " " * (b - a)
        terms = {w.lower() for w in re.findall(r"[^\W_]+", "".join(chars)) if w not in pii.FUNCTION_WORDS and not (len(w) == 1 and w.isascii())}
        return set().union(*(parts(k, t[a:b]) for a, _, b, k in base)) if base else set(), terms

    n, docs = len(data), [(t, *seen(t)) for _, t in data]
    df_e, df_t, both = Counter(), Counter(), Counter()
    texts_e, texts_et = defaultdict(set), defaultdict(set)
    for t, es, ws in docs:
        df_t.update(ws)
        for e in es:
            df_e[e] += 1
            texts_e[e].add(t)
            for w in ws:
                both[e, w] += 1
                texts_et[e, w].add(t)
    close = [k for k, ts in texts_et.items() if len(ts) >= min_contexts and
             math.log(df_t[k[1]]) <= (1 - least) * math.log(n) + least * math.log(df_e[k[0]]) + 1e-9]
    out = set()
    for e, w in close:
        own = math.log2(n / df_e[e])
        p, r, m = df_t[w] / n, len(texts_et[e, w]) / len(texts_e[e]), len(texts_e[e])
        kl = r * math.log(r / p) + ((1 - r) * math.log((1 - r) / (1 - p)) if r < 1 else 0)
        chance = math.exp(-m * kl) if r > p else 1.0
        if own > 0 and math.log2(n * both[e, w] / (df_e[e] * df_t[w])) / own >= least and chance * len(close) <= max_chance:
            out.add((e, w))
    return out


def test_disclosures_are_those_of_a_plain_version(docs_of, monkeypatch):
    rng = random.Random(77)
    words = ["".join(rng.choice("bdfgl") + rng.choice("aeiou") for _ in range(3)) for _ in range(60)]
    firms = [(f"f{w}", f"hq.{w}.example") for w in words[:5]]
    data = []
    for i in range(500):
        w = [rng.choice(words) for _ in range(rng.randint(1, 12))]
        if i % 6 == 0:
            name, domain = firms[i // 6 % 5]
            w += [f"{rng.choice(words)}.{i}@{domain}"] + [name] * (rng.random() < 0.8)
        elif i % 9 == 0:
            w += [f"+44 20 794{i % 3} {1000 + i}", "ulmo" * (i % 3 == 0)]
        rng.shuffle(w)
        data.append((i, " ".join(w)))
    data += data[:40]
    own = docs_of(data)
    slim = pii._annotated(own, "doc_id", "text").where("size(base) > 0").groupBy("t1", "t2").agg(
        F.first("text").alias("text"), F.first("base").alias("base"), F.count("*").alias("copies"))
    texts = slim.withColumn("blank", pii._blanked(F.col("text"), F.col("base")))
    want = plain_disclosures(data)
    for most in (pii.MAX_HASHES, 3):                     # terms counted where they are read, or joined afterwards
        monkeypatch.setattr(pii, "MAX_HASHES", most)
        assert {(r.entity, r.term) for r in pii.disclosures(texts, own, parts=True).collect()} == want
    assert len(want) >= 5


def test_random_rows_hide_no_terms(docs_of):
    assert all(s.rank < 4 for r in pii.find(docs_of(rows())).collect() for s in r.spans)


def test_a_text_full_of_values_and_words(docs_of):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("bdfglmnprst") + rng.choice("aeiou") for _ in range(4))
    full = " ".join(f"{word()} {word()} u{i}@d{i}.example {word()}" for i in range(1500))
    data = [(i, " ".join(word() for _ in range(20))) for i in range(50)] + [(900, full), (901, full)]
    out = {r.doc_id: r.spans for r in pii.find(docs_of(data)).collect()}
    assert all(len(out[i]) == 1500 and all(s.rank == 0 for s in out[i]) for i in (900, 901))

"""Personal data: patterns, and information-theoretic sanitisation of what reveals them.

Everything is DataFrame functions; no Python runs on the executors.

*Base spans* are found by pattern: ``regexp_extract_all`` gives the matches and
``split`` by the same pattern the text between them, so running lengths are the
offsets (code points).  The patterns are written so that a match is never tried
twice (possessive, anchored where a run of characters begins); texts without the
tell-tale characters skip them.

*Revealing terms* (Sánchez and Batet, C-sanitisation).  A protected entity is a
value found by a pattern, or a part that several values may share (``parts``: the domain of
an address and the names before it, a network of 256, the issuer of a card, a number's country and
area); a term is any word outside the values of its document (but
for lower-case ``FUNCTION_WORDS`` and single ASCII letters and digits, which reveal nothing).  With counts ``df`` of documents over the whole
corpus, ``df(e,t)`` those that hold both, the pointwise mutual information of
entity ``e`` and term ``t`` is ``log2(N df(e,t) / (df(e) df(t)))`` and the
information in the entity itself is ``log2(N / df(e))``; their ratio is the share
of the entity that the term discloses.  From ``generalise_at`` on a term in a
document of its entity is replaced by a placeholder, from ``remove_at`` on it is
taken out.  Copies of one text are no evidence: a pair counts only if
``min_contexts`` distinct texts hold it, and if so many of the entity's distinct
texts would hold the term, at its frequency, with a chance of at
most ``max_chance`` (Chernoff's bound on the binomial tail, times all pairs tried).  A term in more than
``N ** (1 - g) * df(e) ** g`` documents cannot disclose a share of ``g``: it is left out before pairs are
made.  Documents without an entity stay.

Equal texts meet as one with their number.  Counts are aggregated before they are
shuffled, a row a pair; nothing is collected but the entities of one text and the
terms found in it.  Entities and terms are joined by key; only texts with a value travel, and
documents are counted only for terms that ``min_contexts`` texts of entities hold.

Cases: null is empty and has no spans; null ids, repeated rows and further
columns are kept, row by row; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuflow.llm.common import written

# The kinds in their order, their patterns (see the contract of the base) and placeholders.
KINDS = ("email", "ip", "card", "phone", "term")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried at all.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]"}
PLACEHOLDERS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]"}
#: What separates terms, and a term.
NOT_TERM, TERM = r"[^\p{L}\p{M}\p{N}]+", r"[\p{L}\p{M}\p{N}]+"
#: Words that reveal nothing; with a capital (An, In) they may be names.
FUNCTION_WORDS = ("a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the", "to", "was", "with")
#: Terms whose hashes are broadcast (8 bytes each) while documents are counted; more are joined after they are counted.
MAX_HASHES = 1 << 18
#: Matches whose offsets are summed up in one step; keeps the work linear for texts full of matches.
STEP = 256

SPAN = "struct<start:bigint,rank:int,end:bigint,value:string>"


def _located(text: Column, pattern: str, rank: int) -> Column:
    """array<(start, rank, end, value)> of all matches, by running lengths of gaps and matches."""
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("g"))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / STEP)), lambda j: F.slice(pairs, j * STEP + 1, F.lit(STEP)))

    def one(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["g"])
        end = start + F.length(F.coalesce(p["m"], F.lit("")))
        own = F.struct(start.cast("bigint").alias("start"), F.lit(rank).alias("rank"), end.cast("bigint").alias("end"), p["m"].alias("value"))
        return F.struct(end.cast("bigint").alias("at"), F.concat(acc["out"], F.array(own)).alias("out"))

    def chunk(acc: Column, c: Column) -> Column:
        part = F.aggregate(c, F.struct(acc["at"].alias("at"), F.expr(f"cast(array() as array<{SPAN}>)").alias("out")), one)
        return F.struct(part["at"].alias("at"), F.concat(acc["out"], F.array(part["out"])).alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.expr(f"cast(array() as array<array<{SPAN}>>)").alias("out"))
    # the last gap has no match behind it
    return F.filter(F.flatten(F.aggregate(chunks, start, chunk)["out"]), lambda s: s["value"].isNotNull())


def _passes(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        part = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|(?<=0))"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _keeps(kind: str):
    return lambda span: _passes(kind, span["value"])


def _of_rank(rank: int):
    return lambda span: span["rank"] == rank


def _base(text: Column) -> Column:
    found = []
    for rank, kind in enumerate(KINDS[:4]):
        hint = text.contains(HINTS[kind]) if kind == "email" else text.rlike(HINTS[kind])
        spans = F.filter(_located(text, PATTERNS[kind], rank), _keeps(kind))
        found.append(F.when(hint, spans).otherwise(F.expr(f"cast(array() as array<{SPAN}>)")))
    return F.array_sort(F.concat(*found))


def _blanked(text: Column, base: Column) -> Column:
    """``text`` with blanks in place of the base spans: other offsets stay."""

    def step(acc: Column, s: Column) -> Column:
        start = F.greatest(s["start"], acc["at"])
        put = F.concat(F.substring(text, (acc["at"] + 1).cast("int"), (start - acc["at"]).cast("int")),
                       F.repeat(F.lit(" "), F.greatest(s["end"] - start, F.lit(0)).cast("int")))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], F.array(put)).alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.expr("cast(array() as array<string>)").alias("out"))
    return F.aggregate(base, start, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))


def _is_term(word: Column) -> Column:
    return (word != "") & ~word.isin(*FUNCTION_WORDS) & ~((F.length(word) == 1) & (F.ascii(word) < 128))


def _terms(text: Column) -> Column:
    """The distinct terms of a text, in lower case."""
    return F.array_distinct(F.transform(F.filter(F.split(text, NOT_TERM), _is_term), F.lower))


def _entities(base: Column, parts: bool = False) -> Column:
    """The distinct values of a text, and with ``parts`` what several values may share."""
    def of(b: Column) -> Column:
        value = F.lower(b["value"])
        whole = F.array(F.concat_ws(":", b["rank"].cast("string"), value))
        return F.concat(whole, _parts(b["rank"], value)) if parts else whole

    return F.array_distinct(F.flatten(F.transform(base, of)))


def _parts(rank: Column, value: Column) -> Column:
    """An address's domain and the names before it, a network of 256, a card's issuer, a number's country and area."""
    names = F.filter(F.split(F.substring_index(value, "@", 1), "[^a-z]+"), lambda w: (F.length(w) >= 3) & _is_term(w))
    email = F.concat(F.array(F.concat(F.lit("domain:"), F.substring_index(value, "@", -1))), F.transform(names, lambda w: F.concat(F.lit("name:"), w)))
    digits = F.regexp_replace(value, "[^0-9]", "")
    return (F.when(rank == 0, email).when(rank == 1, F.array(F.concat(F.lit("net:"), F.substring_index(value, ".", 3))))
            .when(rank == 2, F.array(F.concat(F.lit("issuer:"), F.left(digits, F.lit(6)))))
            .otherwise(F.array(F.concat(F.lit("area:"), F.left(digits, F.length(digits) - 7)))))


def _annotated(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    own = docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text"))
    found = own.select("doc_id", "text", F.xxhash64("text").alias("t1"), F.xxhash64("text", F.lit(7)).alias("t2"), _base(F.col("text")).alias("base"))
    return found.withColumn("text", F.when(F.size("base") > 0, F.col("text")))


def _can_reach(share: float, df_e: Column) -> Column:
    """Whether a pair's share can be so much at all: the documents of both are at most those of the entity."""
    return F.log("df_t") <= (1 - share) * F.log("n") + share * F.log(df_e) + 1e-9


def disclosures(texts: DataFrame, docs: DataFrame, text_col: str = "text", min_contexts: int = 2, max_chance: float = 0.0001,
                generalise_at: float = 0.7, remove_at: float = 0.9, parts: bool = False) -> DataFrame:
    """(entity, term, share, action) of the terms that disclose an entity; ``texts``: a row per distinct
    text with a value: t1, t2, text, blank, base and the number of its ``copies``.  Runs the counts now."""
    total = docs.agg(F.count("*").alias("n"))
    held = texts.select("t1", "t2", "copies", F.explode(_entities(F.col("base"), parts)).alias("entity"))
    df_e = (held.groupBy("entity").agg(F.sum("copies").alias("df_e"), F.count("*").alias("texts_e"))
            .where(F.col("texts_e") >= min_contexts))
    df_e = written(df_e, "pii-entities")
    # the entities of a text together, so that its words are made once
    owners = held.join(df_e, "entity").groupBy("t1", "t2").agg(F.collect_list(F.struct("entity", "df_e")).alias("entities"))
    owners = written(owners.join(texts, ["t1", "t2"]).select("copies", "entities", _terms(F.col("blank")).alias("terms")), "pii-owners")
    # only a term of several of these texts can count
    tried = (owners.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("texts_t"))
             .where(F.col("texts_t") >= min_contexts).select("term"))
    tried = written(tried, "pii-tried")
    df_t = written(_term_counts(tried, texts, docs, text_col), "pii-counts")
    # what is too frequent for every entity goes before the pairs are made, for its own entity before they are counted
    most = df_e.agg(F.max("df_e").alias("most")).crossJoin(total)                         # one row
    rare = df_t.crossJoin(F.broadcast(most)).where(_can_reach(generalise_at, F.col("most"))).select("term", "df_t", "n")
    df_et = (owners.select("copies", "entities", F.explode("terms").alias("term")).join(rare, "term")
             .select("copies", "term", "df_t", "n", F.inline("entities")).where(_can_reach(generalise_at, F.col("df_e")))
             .groupBy("entity", "term").agg(F.sum("copies").alias("df_et"), F.count("*").alias("texts_et"))
             .where(F.col("texts_et") >= min_contexts))
    df_et = written(df_et, "pii-pairs")
    pairs = df_et.agg(F.count("*").alias("tried"))
    info = F.log2(F.col("n") * F.col("df_et") / (F.col("df_e") * F.col("df_t")))
    own = F.log2(F.col("n") / F.col("df_e"))
    p, r = F.col("df_t") / F.col("n"), F.col("texts_et") / F.col("texts_e")
    rest = F.when(r < 1, (1 - r) * (F.log(1 - r) - F.log(1 - p))).otherwise(0.0)      # log(0) is null
    chance = F.when(r > p, F.exp(-F.col("texts_e") * (r * (F.log(r) - F.log(p)) + rest))).otherwise(1.0)
    return (df_et.join(df_t, "term").join(df_e, "entity").crossJoin(F.broadcast(total.crossJoin(pairs)))   # one row: documents and pairs
            .where(own > 0).withColumn("share", F.try_divide(info, own)).where((F.col("share") >= generalise_at) & (chance * F.col("tried") <= max_chance))
            .select("entity", "term", "share", F.when(F.col("share") >= remove_at, "remove").otherwise("generalise").alias("action")))


def _term_counts(tried: DataFrame, texts: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """(term, df_t): the documents that hold each of the terms ``tried`` outside of values."""
    n = tried.count()
    if n == 0:                                     # nothing to count: the corpus is not read
        return tried.withColumn("df_t", F.lit(0).cast("long"))
    # terms of the whole texts, less those that stand only in values, and those that a value is part of
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    inside = F.array_except(_terms(F.col("text")), _terms(F.col("blank")))
    parts = F.array_except(_terms(F.col("blank")), _terms(F.col("text")))
    said = (docs.select(F.explode(_terms(text)).alias("term"), F.lit(1).cast("long").alias("k"))
            .union(texts.select(F.explode(inside).alias("term"), -F.col("copies")))
            .union(texts.select(F.explode(parts).alias("term"), "copies")))
    if n <= MAX_HASHES:                            # other terms go where they are read; their hashes are a number each
        hashes = tried.select(F.xxhash64("term").alias("h")).distinct()
        said = said.join(F.broadcast(hashes), F.xxhash64("term") == F.col("h"), "left_semi")
    return said.groupBy("term").agg(F.sum("k").alias("df_t")).join(tried, "term", "left_semi")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: bool = True, **thresholds) -> DataFrame:
    """Per row of ``docs``: doc_id, t1, t2 (hashes of the text) and ``spans``, sorted:
    array<(start, rank of the kind, end, action)>."""
    slim = written(_annotated(docs, id_col, text_col).select("doc_id", "t1", "t2", "text", "base"), "pii-spans")
    texts = (slim.where(F.size("base") > 0).groupBy("t1", "t2")
             .agg(F.first("text").alias("text"), F.first("base").alias("base"), F.count("*").alias("copies")))
    texts = written(texts.withColumn("blank", _blanked(F.col("text"), F.col("base"))), "pii-texts")
    shown = written(disclosures(texts, docs, text_col, parts=parts, **thresholds).select("entity", "term", "action"), "pii-shown")
    held = texts.select("t1", "t2", F.explode(_entities(F.col("base"), parts)).alias("entity"))
    owners = held.join(shown.select("entity").distinct(), "entity", "left_semi").groupBy("t1", "t2").agg(F.collect_list("entity").alias("entities"))
    due = (owners.join(texts.select("t1", "t2", "blank"), ["t1", "t2"]).select("t1", "t2", "entities", F.explode(_terms(F.col("blank"))).alias("term"))
           .join(shown.select("term").distinct(), "term", "left_semi").select("t1", "t2", "term", F.explode("entities").alias("entity"))
           .join(shown, ["entity", "term"]).groupBy("t1", "t2", "term").agg(F.max("action").alias("action")))     # remove before generalise
    due = due.groupBy("t1", "t2").agg(F.map_from_entries(F.collect_list(F.struct("term", "action"))).alias("due"))
    hits = (due.join(texts.select("t1", "t2", "blank"), ["t1", "t2"])
            .select("t1", "t2", F.explode(F.filter(_placed(F.col("blank")), lambda w: F.map_contains_key("due", w["term"]))).alias("w"), "due")
            .select("t1", "t2", "w.start", "w.end", F.element_at("due", F.col("w.term")).alias("action")))
    extra = hits.groupBy("t1", "t2").agg(F.collect_list(F.struct(F.col("start"), F.lit(len(KINDS) - 1).alias("rank"), F.col("end"), F.col("action"))).alias("extra"))
    extra = written(extra, "pii-terms")
    base = F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["rank"].alias("rank"), b["end"].alias("end"), F.lit("replace").alias("action")))
    none = F.expr("cast(array() as array<struct<start:bigint,rank:int,end:bigint,action:string>>)")
    return (slim.join(extra, ["t1", "t2"], "left")
            .select("doc_id", "t1", "t2", F.array_sort(F.concat(base, F.coalesce("extra", none))).alias("spans")))


def _placed(blank: Column) -> Column:
    """array<(term, start, end)>: every term of a text where it stands."""
    words = F.filter(_located(blank, TERM, len(KINDS) - 1), lambda w: _is_term(w["value"]))
    return F.transform(words, lambda w: F.struct(F.lower(w["value"]).alias("term"), w["start"].alias("start"), w["end"].alias("end")))


def _said(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    last = len(KINDS) - 1
    counts = [F.size(F.filter("spans", _of_rank(k))).cast("long").alias(f"n_{KINDS[k]}") for k in range(last)]
    base = F.filter("spans", lambda s: s["rank"] < last)
    return found.select("doc_id", *counts, F.sha2(_said(base), 256).alias("base_sha256"), _said(F.col("spans")).alias("spans"))


def sanitised(text: Column, spans: Column) -> Column:
    """``text`` with its sorted ``spans`` replaced by placeholders, or removed; a span that begins
    inside the one before it is merged into it."""
    names = F.array(*(F.lit(PLACEHOLDERS[k]) for k in KINDS))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        put = F.concat(F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                       F.when(s["action"] == "remove", F.lit("")).otherwise(F.element_at(names, s["rank"] + 1)))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(fresh, F.concat(acc["out"], F.array(put))).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.expr("cast(array() as array<string>)").alias("out"))
    return F.aggregate(spans, start, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))

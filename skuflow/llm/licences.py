"""Licence scan: a trained paragraph classifier confirmed by template comparison.

Everything is DataFrame functions and Spark ML's JVM-side models; no Python runs
on the executors.

*Classifier.*  Its features are the distinct words and pairs of neighbouring words
of a paragraph (sparse, hashed); it learns from lines.  Multinomial logistic regression
learns the licence families from ``TEMPLATES`` and variants of them (words left
out, words of the corpus put around them), and the class ``unknown`` from at most
``max_unknown`` paragraphs of the corpus that share no word triple with a template,
half of them with a cue.

*Calibration.*  On a held-out quarter of both, the lowest probability of a family
is set so that at most one in ``1 / false_rate`` unknown paragraphs passes; below
it a paragraph is unknown.

*Spans.*  A line may hold several notices, so it is cut where a sentence ends and before
an "and" or "or" behind a licence; a tag ``SPDX-License-Identifier`` with several
licences counts as a tag for each.  A notice may be wrapped, so not only each such piece is
scored but also each run of neighbouring ones that a notice can stretch over: those between the
first and the last have at most as many words as the longest template, and of these
two as many words next to them as two such templates count.  Blank lines end a run, marks of
comments at the start of a line are left out.

*Confirmation.*  A predicted family counts only if the span contains at least
``least_share`` of the word pairs of one of the family's templates, and a pair that only
this family's templates have, or else more of its templates than of any other family's and
no pair that only another family's have: the first half of a wrapped notice that several
families begin alike names none of them, and words between a template's that name another licence
rule it out.  Of overlapping spans of a family the one with the most word pairs of a template counts,
the shortest of these.

A span that can be confirmed holds most of a template's word pairs, so it holds
one of the words (``cues``) without which too few pairs are left.  Every line of
every whole text is searched for them, and the spans with one are compared with the
templates; those with enough of one are scored.  The others cannot be confirmed,
whatever the classifier says.  All of this is map-only; only the spans found are grouped.

Cases: null and empty texts have no paragraphs; null ids, repeated rows and
further columns are kept, row by row; an empty table gives no rows (and its
model knows no unknown paragraphs).  Of families with equal probability the first by name is
predicted; of spans that hold equally many pairs the one that ends first counts.
"""

from __future__ import annotations

import json

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skuflow.llm.common import written

UNKNOWN = "unknown"
# Families and the notices by which each is commonly given; a short notice has a
# template of its own, as it holds too little of a longer one.
TEMPLATES = {
    "agpl": ("This work is licensed under the GNU Affero General Public License, version 3.", "Licensed under the GNU AGPL v3 or later.",
             "GNU Affero General Public License",
             "This program is free software: you can redistribute it and or modify it under the terms of the GNU Affero General Public License."),
    "apache-2.0": ("Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
                   "This project is released under the Apache 2.0 license.", "Apache License 2.0"),
    "bsd": ("Use of this source code is governed by a BSD-style license.",
            "Licensed under the BSD 3-Clause License.", "BSD 2-Clause License",
            "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    "cc-by": ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0.", "CC BY 4.0"),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.", "CC BY-NC 4.0",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by-nc-nd": ("Licensed under CC BY-NC-ND 4.0.", "CC BY-NC-ND 4.0",
                    "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    "cc-by-nc-sa": ("Licensed under CC BY-NC-SA 4.0.", "CC BY-NC-SA 4.0",
                    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    "cc-by-nd": ("Licensed under CC BY-ND 4.0.", "CC BY-ND 4.0",
                 "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.", "CC BY-SA 4.0",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc0": ("Released into the public domain under CC0 1.0 Universal.", "CC0 1.0 Universal",
            "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    "epl-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
                "Licensed under the Eclipse Public License, version 2.0.", "Eclipse Public License"),
    "gpl": ("This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU GPL v3 or later.", "GNU General Public License",
            "This program is free software: you can redistribute it and or modify it under the terms of the GNU General Public License."),
    "isc": ("Permission to use, copy, modify, and or distribute this software for any purpose with or without fee is hereby granted.",
            "Licensed under the ISC License.", "The ISC License"),
    "lgpl": ("This library is licensed under the GNU Lesser General Public License, version 3.", "Licensed under the GNU LGPL v2.1 or later.",
             "GNU Lesser General Public License",
             "This library is free software: you can redistribute it and or modify it under the terms of the GNU Lesser General Public License."),
    "mit": ("Released under the MIT License.", "This project is licensed under the terms of the MIT license.", "The MIT License (MIT)",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "Licensed under the Mozilla Public License, version 2.0.", "Mozilla Public License"),
    "proprietary": ("All rights reserved. No part of this publication may be reproduced without prior written permission.",
                    "This document is confidential and proprietary; redistribution is prohibited.",
                    "All rights reserved.", "Confidential and proprietary.", "Strictly private and confidential."),
    "unlicense": ("This is free and unencumbered software released into the public domain.", "Released under the Unlicense.",
                  "Dedicated to the public domain under the Unlicense."),
}
# The names of the families in SPDX tags.
SPDX = {
    "agpl": ("AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"), "apache-2.0": ("Apache-2.0",), "bsd": ("BSD-2-Clause", "BSD-3-Clause"),
    "cc-by": ("CC-BY-3.0", "CC-BY-4.0"), "cc-by-nc": ("CC-BY-NC-3.0", "CC-BY-NC-4.0"), "cc-by-nc-nd": ("CC-BY-NC-ND-3.0", "CC-BY-NC-ND-4.0"),
    "cc-by-nc-sa": ("CC-BY-NC-SA-3.0", "CC-BY-NC-SA-4.0"), "cc-by-nd": ("CC-BY-ND-3.0", "CC-BY-ND-4.0"), "cc-by-sa": ("CC-BY-SA-3.0", "CC-BY-SA-4.0"),
    "cc0": ("CC0-1.0",), "epl-2.0": ("EPL-2.0",),
    "gpl": ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"), "isc": ("ISC",),
    "lgpl": ("LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"),
    "mit": ("MIT",), "mpl-2.0": ("MPL-2.0",), "unlicense": ("Unlicense",),
}
TAG = "SPDX-License-Identifier"


def notices(family: str) -> tuple[str, ...]:
    """The templates of a family, its tags included."""
    return (*TEMPLATES[family], *(f"{TAG}: {name}" for name in SPDX.get(family, ())))


FEATURES = 1 << 13
VARIANTS = 24
#: Lines behind a line that are looked at first.
FEW = 4
#: What ends a line, and what a line of a comment may begin with.
BREAK = r"\r\n|\r|\n"
#: Where a line is cut: behind a sentence, and before a second licence.
CUT = r"(?<=[.;!?])[\x20\t]+(?=\p{Lu})|(?<=(?i:licen[cs]e)|[0-9])[\x20\t]+(?=(?i:and|or)[\x20\t])"
#: A tag, and what stands between its names.
TAGGED = rf"(?i)^.*?{TAG}:[\x20\t]*"
BETWEEN = r"[\x20\t]*[()]+[\x20\t]*|[\x20\t]+(?i:and|or|with)[\x20\t]+"
MARK = r"^[^\p{L}\p{N}]+|^[^\p{L}\p{N}]*(?i:rem|dnl)\s+[^\p{L}\p{N}]*"
#: What separates words: everything but letters, digits, and dots and hyphens between them.
NOT_WORD = r"(?:[^\p{L}\p{N}.-]|[.-](?![\p{L}\p{N}]))+"


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), NOT_WORD), lambda w: w != "")


def _pairs(words: Column) -> Column:
    """Neighbouring words joined; none for fewer than two words."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat_ws(" ", a, b))


def _triples(words: Column) -> Column:
    n = F.greatest(F.size(words) - 2, F.lit(0))
    return F.zip_with(F.slice(_pairs(words), 1, n), F.slice(words, 3, n), lambda a, b: F.concat_ws(" ", a, b))


def _featured(df: DataFrame) -> DataFrame:
    """``words`` to ``features``: distinct words and pairs, hashed."""
    grams = df.withColumn("grams", F.concat(F.col("words"), _pairs(F.col("words"))))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features").transform(grams).drop("grams")


def paragraphs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one more column ``line`` for each line that has letters or digits."""
    lines = F.split(F.coalesce(docs[text_col].cast("string"), F.lit("")), r"[\r\n]+")
    return docs.select("*", F.explode(lines).alias("line")).where(F.col("line").rlike(r"[\p{L}\p{N}]"))


def _longest() -> int:
    return max(len(_plain_words(text)) for family in TEMPLATES for text in notices(family))


def pieces(text: Column) -> Column:
    """The lines of a text, cut where several notices may stand on one; a tag with several names as one for each."""
    def tags(line: Column) -> Column:
        names = F.filter(F.split(F.regexp_replace(line, TAGGED, ""), BETWEEN), lambda x: x != "")
        return F.transform(names, lambda x: F.concat(F.lit(TAG + ": "), x))

    cut = lambda line: F.when(line.rlike(TAGGED), tags(line)).otherwise(F.split(line, CUT))
    return F.flatten(F.transform(F.split(text, BREAK), cut))


def spans(rows: DataFrame, least_share: float, text_col: str = "text") -> DataFrame:
    """``rows`` with ``first``, ``last`` (numbers of pieces) and ``words`` in place of the text: each piece with
    a cue, and each run of neighbouring pieces with one that a notice may be wrapped over."""
    longest = _longest()
    reach = 2 * longest                                 # words of the outer lines of a run
    line = F.transform(pieces(rows[text_col]), lambda t: F.struct(
        _words(F.regexp_replace(t, MARK, "")).alias("w"), _cued(t, least_share).alias("c")))
    none = F.expr("cast(array() as array<struct<first:int,last:int,words:array<string>>>)")
    # through explode, so that the lines are made once and not for each of them
    held = (rows.where(_cued(rows[text_col], least_share))
            .select(*(c for c in rows.columns if c != text_col), F.explode(F.array(line)).alias("_lines")))

    def from_line(a: Column, i: Column) -> Column:
        def longer(acc: Column, b: Column) -> Column:
            open_ = acc["open"] & (F.size(b["w"]) > 0) & (acc["n"] <= longest)
            cued = acc["c"] | b["c"]
            own = F.struct(i.cast("int").alias("first"), (acc["last"] + 1).alias("last"),
                           F.concat(acc["words"], F.slice(b["w"], 1, reach)).alias("words"))
            return F.struct((acc["last"] + 1).alias("last"), open_.alias("open"), cued.alias("c"), (acc["n"] + F.size(b["w"])).alias("n"),
                            F.when(open_ & (acc["n"] + F.size(b["w"]) <= longest), F.concat(acc["words"], b["w"])).otherwise(acc["words"]).alias("words"),
                            F.when(open_ & cued, F.concat(acc["out"], F.array(own))).otherwise(acc["out"]).alias("out"))

        n = F.size(a["w"])
        start = F.struct(i.cast("int").alias("last"), (n > 0).alias("open"), a["c"].alias("c"), F.lit(0).alias("n"),
                         F.slice(a["w"], F.greatest(n - reach, F.lit(0)) + 1, F.lit(reach)).alias("words"),
                         F.when(a["c"], F.array(F.struct(i.cast("int").alias("first"), i.cast("int").alias("last"), a["w"].alias("words"))))
                         .otherwise(none).alias("out"))
        # each line between has a word at least; mostly a few lines hold more words than a run may
        few = F.aggregate(F.slice("_lines", i + 2, F.lit(FEW)), F.lit(0), lambda n, b: n + F.size(b["w"]))
        after = F.slice("_lines", i + 2, F.when(few > longest, FEW).otherwise(longest + 1))
        return F.when(a["c"] | F.exists(after, lambda b: b["c"]), F.aggregate(after, start, longer, lambda acc: acc["out"])).otherwise(none)

    return held.select(*(c for c in held.columns if c != "_lines"), F.inline(F.flatten(F.transform("_lines", from_line))))


def cues(least_share: float) -> list[str]:
    """Words of which every confirmed paragraph holds one: of each template the longest words,
    until the pairs without them are fewer than a confirmation needs."""
    out: set[str] = set()
    for family in TEMPLATES:
        for text in notices(family):
            words = _plain_words(text)
            pairs = {p for p in zip(words, words[1:])}
            own: set[str] = set()
            for w in sorted(set(words), key=lambda w: (w not in out, -len(w), w)):
                if sum(not own & set(p) for p in pairs) < least_share * len(pairs):
                    break
                own.add(w)
            out |= own
    return sorted(out)


def _cued(line: Column, least_share: float) -> Column:
    import re

    by_letter: dict[str, list[str]] = {}
    for cue in cues(least_share):
        by_letter.setdefault(cue[0], []).append(re.escape(cue[1:]))
    # the first letter decides most places, before anything else is looked at
    branches = "|".join(f"{re.escape(letter)}(?:{'|'.join(rest)})" for letter, rest in by_letter.items())
    return F.lower(line).rlike(rf"(?=[{''.join(by_letter)}])(?<![\p{{L}}\p{{N}}])(?:{branches})")


def _templates(spark: SparkSession) -> DataFrame:
    rows = [(family, text) for family in TEMPLATES for text in notices(family)]
    return spark.createDataFrame(rows, "family string, notice string").select("family", "notice", _words(F.col("notice")).alias("words"))


class Model:
    """A fitted classifier: probabilities of the families, the lowest that counts, and the templates."""

    def __init__(self, fitted, families: list[str], least: float, least_share: float):
        self.fitted, self.families, self.least, self.least_share = fitted, families, least, least_share

    def decide(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``family`` for each of their ``words`` (null: no licence) and ``held``, the most word pairs of one of its
        templates.  Rows that no template confirms are left out."""
        # each step behind a generator or written, so that its many uses do not work it out again; a span
        # without a pair of any template goes first, and of the others only such pairs are compared
        own = rows.select("*", F.explode(F.array(self._known(_pairs(F.col("words"))))).alias("_own")).where(F.size("_own") > 0)
        own = own.select("*", F.explode(F.array(self._held())).alias("_held"))
        near = own.select(*rows.columns, "_own", F.inline(F.array(F.struct(*self._shares())))).where(F.array_max("share") >= self.least_share)
        near = written(near.withColumn("named", self._named()).drop("_own"), "licence-spans")
        scored = written(self.fitted.transform(_featured(near)).select(*near.columns, vector_to_array("probability").alias("p")), "licence-scores")
        best = F.array_max(F.slice("p", 2, len(self.families)))            # class 0 is unknown
        guess = F.array_position(F.slice("p", 2, len(self.families)), best).cast("int")
        passed = (best >= self.least) & (best > F.element_at("p", 1))
        own = F.element_at("share", F.col("_guess"))
        alone = (F.size(F.filter("share", lambda x: x >= own)) == 1) & ~F.exists("named", lambda x: x)
        clear = F.element_at("named", F.col("_guess")) | alone
        known = F.array(*map(F.lit, self.families))
        return (scored.withColumn("_guess", guess)
                .withColumn("family", F.when(passed & (own >= self.least_share) & clear, F.element_at(known, F.col("_guess"))))
                .withColumn("held", F.element_at("most", F.col("_guess"))).drop("p", "share", "most", "named", "_guess"))

    def _known(self, pairs: Column) -> Column:
        """Those of ``pairs`` that a template has, each once."""
        known = sorted({p for family in self.families for text in notices(family) for p in _pairs_of(text)})
        return F.array_distinct(F.filter(pairs, lambda p: p.isin(known)))            # looked up in a set made once

    def _held(self) -> Column:
        """Per family and template: the share of its word pairs that ``_own`` holds, and their number where that confirms it."""
        templates = _constant([[_pairs_of(text) for text in notices(family)] for family in self.families], "array<array<array<string>>>")

        def one(pairs: Column) -> Column:
            k = F.size(F.array_intersect("_own", pairs))
            return F.transform(F.array(k / F.size(pairs)), lambda share: F.struct(
                share.alias("share"), F.when(share >= self.least_share, F.round(share * F.size(pairs)).cast("int")).otherwise(0).alias("most")))[0]

        return F.transform(templates, lambda family: F.transform(family, one))

    def _shares(self) -> list[Column]:
        """Per family: the largest share of a template's word pairs that a span holds, and the most pairs of a template confirmed."""
        return [F.transform("_held", lambda family: F.array_max(F.transform(family, lambda h: h[name]))).alias(name) for name in ("share", "most")]

    def _named(self) -> Column:
        """Per family: whether ``_own`` holds a word pair that no other family's templates have."""
        only = _constant(only_pairs(self.families), "array<array<string>>")
        return F.transform(only, lambda own: F.arrays_overlap("_own", own))


def _constant(value: list, of_type: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), of_type)


def only_pairs(families: list[str]) -> list[list[str]]:
    """Per family the word pairs that only its templates have."""
    pairs = {family: {p for text in notices(family) for p in _pairs_of(text)} for family in families}
    return [sorted(pairs[f] - {p for g in families if g != f for p in pairs[g]}) for f in families]


def _plain_words(text: str) -> list[str]:
    import re

    return [w for w in re.split(r"(?:[^\w.-]|[.-](?!\w))+", text.lower()) if w]


def _pairs_of(text: str) -> list[str]:
    words = _plain_words(text)
    return sorted({" ".join(p) for p in zip(words, words[1:])})


def train(docs: DataFrame, text_col: str = "text", max_unknown: int = 4000, false_rate: float = 0.001, least_share: float = 0.6) -> Model:
    """Fit on the templates' variants and on at most ``max_unknown`` paragraphs of the corpus; runs now."""
    spark = docs.sparkSession
    templates = _templates(spark)
    marks = F.array(*(F.lit(t) for t in sorted({" ".join(w[k:k + 3]) for f in TEMPLATES for w in map(_plain_words, notices(f)) for k in range(len(w) - 2)})))
    texts = docs.select(docs[text_col].alias("_t"))
    hashed = lambda rows: paragraphs(rows, "_t").select("line", F.xxhash64(F.lower("line")).alias("h"))
    # a line with a cue stands in a text with one
    lines, cued = hashed(texts), hashed(texts.where(_cued(F.col("_t").cast("string"), least_share)))
    # paragraphs of the smallest hashes, whatever the order of the rows and however often they occur
    half = max_unknown // 2
    least = lines.select("h").distinct().orderBy("h").limit(half).union(
        cued.where(_cued(F.col("line"), least_share)).select("h").distinct().orderBy("h").limit(half)).distinct()
    unknown = written(lines.join(F.broadcast(least), "h").groupBy("h").agg(F.min("line").alias("line"))        # max_unknown rows
                      .select(F.lit(UNKNOWN).alias("family"), F.slice(_words(F.col("line")), 1, 200).alias("words"), "h")
                      .where(~F.arrays_overlap(_triples(F.col("words")), marks) & ~F.array_contains("words", TAG.lower())), "licence-unknown")
    around = (unknown.orderBy("h").limit(VARIANTS)
              .select(F.row_number().over(Window.orderBy("h")).alias("variant"), F.slice("words", 1, 6).alias("near")))    # VARIANTS rows
    numbers = spark.range(1, VARIANTS + 1).select(F.col("id").cast("int").alias("variant")).join(around, "variant", "left")
    # a variant leaves out about a tenth of the words; odd ones stand within words of the corpus
    dropped = F.transform(F.filter(F.transform("words", lambda w, i: F.struct(i.alias("i"), w.alias("w"))),
                                   lambda w: (F.col("variant") % 3 == 0) | (F.pmod(F.xxhash64("variant", "notice", w["i"]), F.lit(10)) > 0)), lambda w: w["w"])
    near = F.coalesce("near", F.expr("cast(array() as array<string>)"))
    variants = (templates.crossJoin(F.broadcast(numbers))                        # TEMPLATES times VARIANTS rows
                .withColumn("words", F.when(F.col("variant") % 2 == 1, F.concat(near, dropped, near)).otherwise(dropped))
                .select("family", "words", F.xxhash64("variant", "notice").alias("h")))
    families = sorted(TEMPLATES)
    label = F.coalesce(F.array_position(F.array(*map(F.lit, families)), F.col("family")).cast("double"), F.lit(0.0))
    rows = written(_featured(variants.union(unknown)).select("family", label.alias("label"), "features", "h"), "licence-sample")
    held = F.pmod(F.col("h"), F.lit(4)) == 0
    if rows.where("label = 0").limit(1).count() == 0:
        rows = rows.union(_featured(spark.createDataFrame([(UNKNOWN, [""], 1)], "family string, words array<string>, h long"))
                          .select("family", F.lit(0.0).alias("label"), "features", "h"))
    fitted = LogisticRegression(family="multinomial", regParam=1e-3, maxIter=60).fit(rows.where(~held))
    top = F.array_max(F.slice(vector_to_array("probability"), 2, len(families)))
    share = fitted.transform(rows.where(held & (F.col("label") == 0))).agg(F.percentile(top, 1 - false_rate)).first()[0]
    return Model(fitted, families, max(0.5, share or 0.0), least_share)


def scan(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_paragraphs (lines with letters or digits), n_licences (notices: spans
    of a family that do not overlap) and ``licences`` (distinct families, sorted, comma-joined)."""
    own = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    model = model or train(own)
    row = F.struct(F.xxhash64("text").alias("t1"), F.xxhash64("text", F.lit(7)).alias("t2"))
    own = own.withColumn("row", row)
    held = spans(own.select("row", "text"), model.least_share)

    def apart(acc: Column, s: Column) -> Column:
        fresh, better = s["first"] > acc["end"], s["held"] > acc["held"]
        return F.struct(F.when(fresh | better, s["last"]).otherwise(acc["end"]).alias("end"),
                        F.when(fresh | better, s["held"]).otherwise(acc["held"]).alias("held"), (acc["n"] + fresh.cast("long")).alias("n"))

    start = F.struct(F.lit(-1).alias("end"), F.lit(0).alias("held"), F.lit(0).cast("long").alias("n"))
    # the shortest span of those that end together and hold as much; equal texts hold the same ones
    found = (model.decide(held).where("family is not null").groupBy("row", "family", "last", "held").agg(F.max("first").alias("first"))
             .groupBy("row", "family").agg(F.array_sort(F.collect_list(F.struct("last", "first", "held"))).alias("spans"))
             .select("row", "family", F.aggregate("spans", start, apart, lambda acc: acc["n"]).alias("n")))
    per_text = written(found.groupBy("row").agg(F.sum("n").alias("n_licences"), F.array_join(F.array_sort(F.collect_set("family")), ",").alias("licences")), "licence-hits")
    return (own.withColumn("n_paragraphs", F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"[\r\n]+"), lambda p: p.rlike(r"[\p{L}\p{N}]"))).cast("long"))
            .select("doc_id", "row", "n_paragraphs").join(per_text, "row", "left")
            .select("doc_id", "n_paragraphs", F.coalesce("n_licences", F.lit(0).cast("long")).alias("n_licences"), F.coalesce("licences", F.lit("")).alias("licences")))

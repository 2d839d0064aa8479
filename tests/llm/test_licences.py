import random

import pytest
from skuflow.llm import licences as L
from tests.llm.conftest import MESSY

WORDS = ["ther", "nding", "la", "the", "of", "release", "license", "version", "under", "on", "work", "is", "thinor"]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def model(docs_of):
    rng = random.Random(3)
    docs = docs_of([(i, "\n".join(prose(rng, rng.randint(1, 30)) for _ in range(8))) for i in range(60)])
    return L.train(docs, max_unknown=300)


def test_held_out_notices_and_prose(model, docs_of):
    rng = random.Random(9)
    rows, want = [], {}
    for k, (family, texts) in enumerate((f, t) for f, ts in L.TEMPLATES.items() for t in [ts]):
        for j, text in enumerate(texts):
            i = 100 * k + j
            rows.append((i, f"{prose(rng, 12)}\n  {text.upper() if j % 2 else text}\n{prose(rng, 25)}"))
            want[i] = family
    rows += [(5000 + i, "\n".join(prose(rng, rng.randint(1, 40)) for _ in range(5))) for i in range(120)]
    out = {r.doc_id: r for r in L.scan(docs_of(rows), model).collect()}
    hits = [out[i].licences == f for i, f in want.items()]
    assert sum(hits) >= 0.9 * len(hits)
    assert sum(out[i].n_licences > 0 for i, _ in rows if i >= 5000) <= 1


def test_messy_rows(model, docs_of):
    extra = [(7, "Released under the MIT License."), (7, "Released under the MIT License."), (8, "\n\nLicensed under CC BY-NC 4.0.\r\nReleased under the MIT License.\n")]
    out = sorted(((r.doc_id, r.n_paragraphs, r.n_licences, r.licences) for r in L.scan(docs_of(MESSY + extra), model).collect()), key=str)
    assert len(out) == len(MESSY) + 3
    assert [o for o in out if o[2]] == [(7, 1, 1, "mit"), (7, 1, 1, "mit"), (8, 2, 2, "cc-by-nc,mit")]
    assert L.scan(docs_of([]), model).count() == 0


def test_empty_corpus_can_be_trained_on(docs_of):
    assert L.scan(docs_of([])).count() == 0


# wordings that are not in TEMPLATES
HELD_OUT = {
    "agpl": ["Distributed under the GNU Affero General Public License.", "You may copy it under the GNU AGPL v3 or later.",
             "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the FSF."],
    "cc-by-nc-nd": ["Photos are CC BY-NC-ND 4.0.", "This film is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."],
    "cc-by-nc-sa": ["Slides: CC BY-NC-SA 4.0, 2020.", "This course is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."],
    "cc-by-nd": ["Maps available under CC BY-ND 4.0.", "This map is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "epl-2.0": ["Distributed under the Eclipse Public License, v2.0.", "This program is made available under the terms of the Eclipse Public License 2.0 which is at its site."],
    "isc": ["Distributed under the ISC License.", "Permission to use, copy, modify, and/or distribute this code for any purpose with or without fee is hereby granted, provided that"],
    "unlicense": ["This is free and unencumbered code released into the public domain.", "Given away and released under the Unlicense, see UNLICENSE."],
    "apache-2.0": ["Copyright 2019 Example Corp. Licensed under the Apache License, Version 2.0", "Distributed under the Apache License 2.0.",
                   "This library is released under the Apache 2.0 license, see LICENSE."],
    "bsd": ["Distributed under the BSD 2-Clause License.", "The code is governed by a BSD-style license found in LICENSE.",
            "Redistribution and use in source and binary forms are permitted, with or without modification."],
    "cc-by": ["Text available under CC BY 4.0.", "This article is licensed under a Creative Commons Attribution 4.0 International License, unless noted."],
    "cc-by-nc": ["Content is CC BY-NC 4.0 unless noted.", "This article is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa": ["Photos: CC BY-SA 4.0.", "The book is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc0": ["The data is given away under CC0 1.0 Universal.", "To the extent possible under law, Jane Doe has waived all copyright and related rights to this dataset."],
    "gpl": ["Distributed under the terms of the GNU General Public License v2.", "You may copy it under the GNU General Public License, version 3."],
    "lgpl": ["Distributed under the GNU Lesser General Public License.", "You may copy it under the GNU LGPL v2.1 or later."],
    "mit": ["Distributed under the MIT License.", "The MIT License (MIT) Copyright (c) 2015 Jane Doe", "Code is licensed under the terms of the MIT license, see LICENSE."],
    "mpl-2.0": ["Distributed under the Mozilla Public License 2.0.", "This file is subject to the terms of the Mozilla Public License, v. 2.0."],
    "proprietary": ["All Rights Reserved", "(c) 2021 Example Corp. All rights reserved.", "Copyright 2018 by the authors, all rights reserved worldwide.",
                    "Confidential and proprietary information of Example Corp."],
}


def recall(model, docs_of):
    """Per family: the found share of its held-out notices, each between lines of prose."""
    rng = random.Random(17)
    rows, want = [], []
    for family, texts in HELD_OUT.items():
        for text in texts:
            rows.append((len(rows), f"{prose(rng, 20)}\n\n{text}\n\n{prose(rng, 20)}"))
            want.append(family)
    out = {r.doc_id: r.licences for r in L.scan(docs_of(rows), model).collect()}
    assert [(rows[i][1], out[i]) for i, w in enumerate(want) if out[i] not in ("", w)] == []      # no other family
    return {f: sum(out[i] == f for i, w in enumerate(want) if w == f) / want.count(f) for f in HELD_OUT}


def test_wordings_that_are_not_templates(model, docs_of):
    found = recall(model, docs_of)
    print(found)
    assert not {t for ts in HELD_OUT.values() for t in ts} & {t for ts in L.TEMPLATES.values() for t in ts}
    assert set(found) == set(L.TEMPLATES) and all(share >= 0.9 for share in found.values())


GPL = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"
CC = "This work is licensed under a Creative Commons {} 4.0 International License."
CC_FAMILIES = {"cc-by": "Attribution", "cc-by-nc": "Attribution-NonCommercial", "cc-by-sa": "Attribution-ShareAlike"}


def test_wrapped_notices(model, docs_of):
    import textwrap

    rng = random.Random(23)
    notices = [("gpl", GPL), *((f, CC.format(v)) for f, v in CC_FAMILIES.items())]
    rows, want = [], {}
    for family, text in notices:
        for width in (20, 40, 70):
            for mark, end in (("", "\n"), ("# ", "\n"), (" * ", "\r\n"), ("--", "\n"), ("REM ", "\r")):
                lines = [mark + line for line in textwrap.wrap(text, width, break_on_hyphens=False, break_long_words=False)]
                want[len(rows)] = family
                rows.append((len(rows), end.join([prose(rng, 15), mark, *lines, mark, prose(rng, 15)])))
    out = {r.doc_id: (r.n_licences, r.licences) for r in L.scan(docs_of(rows), model).collect()}
    assert out == {i: (1, f) for i, f in want.items()}


def test_spans_of_several_notices(model, docs_of):
    half = CC.format("").split(" 4.0")[0]
    rows = [(1, half), (2, f"{half}\n\nAttribution 4.0 International License."),        # the variant is not named, or stands apart
            (3, "Released under the\nMIT License.\nReleased under the\nMIT License."),
            (4, "Licensed under\nCC BY-NC 4.0.\nReleased under\nthe MIT License.")]
    rows += [(6, rows[2][1]), (6, rows[2][1])]
    out = sorted((r.doc_id, r.n_licences, r.licences) for r in L.scan(docs_of(rows), model).collect())
    assert out == [(1, 0, ""), (2, 0, ""), (3, 2, "mit"), (4, 2, "cc-by-nc,mit"), (6, 2, "mit"), (6, 2, "mit")]


def test_spans_are_all_that_a_notice_can_stretch_over(spark):
    rng = random.Random(4)
    longest = L._longest()
    lines = [prose(rng, rng.choice([0, 1, 2, 5, 30])) for _ in range(80)]
    got = sorted((r.first, r.last) for r in L.spans(spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string"), 0.6).collect())
    size, cued = [len(x.split()) for x in lines], [bool(set(x.split()) & {"license", "version", "under", "release"} & set(L.cues(0.6))) for x in lines]
    want = [(i, j) for i in range(80) for j in range(i, 80) if any(cued[i:j + 1]) and (i == j or min(size[i:j + 1]) > 0 and sum(size[i + 1:j]) <= longest)]
    assert got == want


def test_several_notices_on_one_line_and_tags(model, docs_of):
    want = {"Released under the MIT License. Licensed under CC BY 4.0.": "cc-by,mit",
            "Licensed under the MIT License or the Apache License, Version 2.0.": "apache-2.0,mit",
            "// SPDX-License-Identifier: Apache-2.0": "apache-2.0", "# SPDX-License-Identifier: MIT": "mit",
            "/* SPDX-License-Identifier: (GPL-2.0-only OR BSD-3-Clause) */": "bsd,gpl",
            "SPDX-License-Identifier: LGPL-2.1-or-later AND ISC AND EPL-2.0": "epl-2.0,isc,lgpl",
            "SPDX-License-Identifier: AGPL-3.0-or-later": "agpl", "SPDX-License-Identifier: NoSuchName-1.0": ""}
    rng = random.Random(31)
    rows = [(i, f"{prose(rng, 9)}\n{t}\n{prose(rng, 9)}") for i, t in enumerate(want)]
    out = {r.doc_id: r.licences for r in L.scan(docs_of(rows), model).collect()}
    assert out == dict(enumerate(want.values()))


def test_decisions_are_those_of_a_plain_version(model, docs_of, spark):
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F

    rng = random.Random(41)
    bits = [w for ts in L.TEMPLATES.values() for t in ts for w in [t, " ".join(t.split()[:5]), " ".join(t.split()[3:])]] + ["GNU", "Affero", "MIT", "SPDX-License-Identifier: MIT"]
    texts = [" ".join(rng.choice(bits) if rng.random() < 0.6 else prose(rng, 3) for _ in range(rng.randint(1, 3))) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, text string").select("i", L._words(F.col("text")).alias("words"))
    p = {r.i: r.p for r in model.fitted.transform(L._featured(rows)).select("i", vector_to_array("probability").alias("p")).collect()}
    got = {r.i: (r.family, r.held if r.family else None) for r in model.decide(rows).collect()}

    def gram(t):
        w = L._plain_words(t)
        return set(zip(w, w[1:]))

    templates = {f: [gram(t) for t in L.notices(f)] for f in model.families}
    want = {}
    for i, t in enumerate(texts):
        own = gram(t)
        share = {f: max(len(own & g) / len(g) for g in gs) for f, gs in templates.items()}
        if max(share.values()) < model.least_share:
            continue
        named = {f for f in templates if any(q in g for q in own for g in templates[f]) and
                 any(all(q not in g for e in templates if e != f for g in templates[e]) for q in own if any(q in g for g in templates[f]))}
        best = max(p[i][1:])
        f = model.families[list(p[i][1:]).index(best)]
        alone = sum(x >= share[f] for x in share.values()) == 1 and not named
        ok = best >= model.least and best > p[i][0] and share[f] >= model.least_share and (f in named or alone)
        held = max((len(own & g) for g in templates[f] if len(own & g) / len(g) >= model.least_share), default=0)
        want[i] = (f, held) if ok else (None, None)
    assert got == want and sum(f is not None for f, _ in want.values()) > 50

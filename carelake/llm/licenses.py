"""Licence scans by a trained paragraph classifier, in DataFrame functions only.

A paragraph is a line of a document, or a notice wrapped over several lines without a blank one
(no letter or digit, such as a bare comment mark) between them, wherever its lines break: from each
line on, the words up to ``STRETCH`` times those of a template are compared with it; if they hold
``similarity`` or more of its word pairs and all its marks, the lines up to the last of these pairs
are a run.  Of runs of a family that overlap, the one with most pairs stands, the shortest of equals;
its lines are joined and are one paragraph, numbered by its first line.  Its lines are none then.
Features of a paragraph are its distinct words and word pairs.
A sparse multinomial logistic regression (L1 penalty) is trained on licence notices in
many worn forms (words dropped, cut off, set among other text), on notices of licences
without a family of their own (class ``unknown``), and on paragraphs of the corpus that
resemble no notice (class ``none``).  A temperature found on held-out examples calibrates
the probabilities; a licence paragraph whose best family stays below ``least`` is
``unknown``.  A family is confirmed when the paragraph holds ``similarity`` or more of the
word pairs of one of its templates, all those among them that tell the family from its
siblings (``MARKS``: version, lesser, sa, nd ...); an unconfirmed one is reported as ``unknown``.

Scoring reads every paragraph.  The weights tell which terms a paragraph must have one of
to be classified as a licence at all (``LicenseModel.cue``); a pattern finds these
paragraphs, and only they are cut into terms and looked up in the weights (a literal of
``VOCABULARY`` terms at most).  Paragraphs are scored in their own rows, without a shuffle;
only what is found is grouped by document.  The fit uses ``BACKGROUND`` paragraphs of the corpus at
most, lines of 2000 characters or more not among them.

Cases: null and empty documents have no licences; a line of any length is one paragraph;
repeated rows are reported apiece; an empty table gives no rows (and no background is
no obstacle to the fit); other columns are ignored.
"""

from __future__ import annotations

import json
import math
import re
from dataclasses import dataclass
from functools import reduce
from operator import add, or_

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import col, staged

VOCABULARY = 4096
BACKGROUND = 3000
WORN = 24  # worn forms of each notice
STRETCH = 1.5  # words of a wrapped notice, as a multiple of its template's
FILLED = r"[\p{L}\p{N}]"

#: fixed values: wording of common licence notices, by family
NOTICES = {
    "MIT": [
        "Under the MIT License.",
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ],
    "Apache-2.0": [
        "Under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "GPL-3.0": [
        "Under the GNU General Public License, version 3.",
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License v3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License.",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "BSD-3-Clause": [
        "Under the BSD 3-Clause License.",
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD license.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "SPDX-License-Identifier: CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright 2024. All rights reserved. No part of this publication may be reproduced without permission.",
    ],
    "unknown": [
        "Licensed under the terms of the community licence.",
        "Released under the Mozilla Public License 2.0.",
        "Distributed under the Eclipse Public License.",
        "Licensed under the Boost Software License.",
        "Released under the zlib License.",
        "Use of this material is subject to the licence agreement.",
        "This file is licensed under its own licence terms, see the file LICENSE.",
        "Published under an open data license.",
        "Licensed under the European Union Public Licence.",
        "Licensed under the Artistic License.",
        "Released under the Unlicense.",
        "This work is dedicated to the public domain.",
        "Licensed under the GNU General Public License, version 2.",
        "Licensed under the GNU Lesser General Public License, version 3.",
        "Licensed under the GNU Affero General Public License, version 3.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met.",  # of BSD licences with two, three and four clauses
        "SPDX-License-Identifier: ISC",
        "SPDX-License-Identifier: MPL-2.0",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
        "SPDX-License-Identifier: BSD-2-Clause",
        "Licensed under CC BY-SA 4.0.",
        "Licensed under CC BY-ND 4.0.",
        "Licensed under CC BY-NC-SA 4.0.",
        "Licensed under CC BY-NC-ND 4.0.",
    ],
}
#: word pairs that name the family itself; a template that has them confirms only with all of its own
MARKS = {
    "MIT": {"mit license", "deal in", "identifier mit"},
    "Apache-2.0": {"apache license", "version 2", "license 2", "identifier apache", "apache 2"},
    "GPL-3.0": {"gnu general", "general public", "version 3", "license v3", "identifier gpl", "gpl 3"},
    "BSD-3-Clause": {"bsd 3", "3 clause", "bsd license", "its contributors", "endorse or"},
    "CC-BY-NC-4.0": {"cc by", "by nc", "nc 4", "attribution noncommercial", "noncommercial 4"},
    "CC-BY-4.0": {"cc by", "by 4", "commons attribution", "attribution 4"},
    "proprietary": {"all rights", "rights reserved"},
}
FAMILIES = [f for f in NOTICES if f != "unknown"]
CLASSES = [*FAMILIES, "unknown", "none"]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def pairs_of(words: Column) -> Column:
    return F.when(F.size(words) > 1, F.zip_with(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(1))),
        F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(1))),
        lambda a, b: F.concat_ws(" ", a, b))).otherwise(F.array().cast("array<string>"))


def terms_of(words: Column) -> Column:
    return F.array_distinct(F.concat(words, pairs_of(words)))


def rows_of(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A small table from a literal (no Python rows)."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def paragraphs(docs: DataFrame, doc_id: str, text: str, similarity: float | None = None) -> DataFrame:
    """rid, doc_id, n_paragraphs (lines that are filled), paragraph, line; the last line of each row is a null
    that stands for it.  With ``similarity``, wrapped notices are joined."""
    t = F.coalesce(col(text).cast("string"), F.lit(""))
    src = docs.select(F.monotonically_increasing_id().alias("rid"), col(doc_id).alias("doc_id"),
                      F.split(t, "\n").alias("lines"), t.alias("t"))
    filled = F.size(F.filter("lines", lambda x: x.rlike(r"\S"))).cast("long").alias("n_paragraphs")
    if similarity is None:
        return src.select("rid", "doc_id", filled, F.posexplode(
            F.concat("lines", F.array(F.lit(None).cast("string")))).alias("paragraph", "line"))
    # few documents hold the marks of a notice at all; the others' lines are taken as they are
    keep = ["rid", "doc_id", "n_paragraphs", "lines"]
    src = src.select("rid", "doc_id", filled, "lines", (
        (F.size("lines") > 1) & hinted(F.lower("t")) & F.lower("t").rlike(marks_pattern())).alias("marked"))
    src = src.select(*keep, F.when(F.col("marked"), notices_at(F.col("lines"), similarity)).alias("at"))
    src = src.select(*keep, F.when(F.col("at").isNotNull(), F.filter(
        fullest(F.col("at")), lambda r: r["end"] - r["start"] > 1)).alias("runs"))
    inside = F.array_distinct(F.flatten(F.transform("runs", lambda r: F.sequence(r["start"], r["end"] - 1))))
    src = src.select(*keep, "runs", F.when(F.size("runs") > 0, inside).alias("inside"))
    rest = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("inside"))
    joined = F.concat(
        F.transform(rest, lambda i: F.struct(i.alias("paragraph"), F.get("lines", i).alias("line"))),
        F.transform("runs", lambda r: F.struct(r["start"].alias("paragraph"), F.array_join(
            F.slice("lines", r["start"] + 1, r["end"] - r["start"]), " ").alias("line"))))
    alone = F.transform("lines", lambda x, i: F.struct(i.alias("paragraph"), x.alias("line")))
    row = F.array(F.struct(F.size("lines").alias("paragraph"), F.lit(None).cast("string").alias("line")))
    return src.select("rid", "doc_id", "n_paragraphs", F.inline(
        F.concat(F.when(F.col("inside").isNotNull(), joined).otherwise(alone), row)))


def longest_marks() -> list[str]:
    """Of each template's marks, the longest; a text without any of them holds no notice."""
    return sorted({max(marks, key=lambda m: (len(m), m)) for _, _, marks, _ in templates()})


def marks_pattern() -> str:
    return "|".join(rf"(?<!{FILLED})" + p.replace(" ", r"[^\p{L}\p{N}]+") + rf"(?!{FILLED})" for p in longest_marks())


def hinted(lower: Column) -> Column:
    """True where ``marks_pattern`` can match at all, by plain searches for the longest word of each mark."""
    words = {max(m.split(" "), key=len) for m in longest_marks()}
    plain = [lower.contains(w) for w in sorted(words) if len(w) > 3 and not any(v in w for v in words if v != w)]
    short = [m for m in longest_marks() if len(max(m.split(" "), key=len)) <= 3]
    return reduce(or_, plain + [lower.rlike(m.replace(" ", r"[^\p{L}\p{N}]+")) for m in short])


def span() -> int:
    """The most words that a wrapped notice can take, and so the most lines."""
    return max(words for *_, words in templates())


def notices_at(lines: Column, similarity: float) -> Column:
    """For each line, the runs of lines (start, end, family, held) from there that hold a template."""
    def tokens(x: Column, i: Column) -> Column:
        found = F.transform(words_of(x), lambda w: F.struct(w.alias("word"), i.alias("line")))
        return F.when(F.size(found) > 0, found).otherwise(F.array(F.struct(F.lit("").alias("word"), i.alias("line"))))

    def from_here(ahead: Column) -> Column:
        """The runs from the first word of ``ahead``, which ends before a blank line."""
        pairs = F.transform(F.sequence(F.lit(0), F.size(ahead) - 2), lambda i: F.struct(
            F.concat_ws(" ", F.get(ahead, i)["word"], F.get(ahead, i + 1)["word"]).alias("pair"), i.alias("at"),
            F.get(ahead, i + 1)["line"].alias("line")))
        text = F.array_join(F.transform(ahead, lambda w: w["word"]), " ")
        start = F.get(ahead, 0)["line"]
        return F.when((F.size(ahead) > 1) & text.rlike(marks_pattern()), F.get(F.transform(F.array(pairs), lambda p: F.filter(
            F.transform(template_literal(), lambda t: run(p, t, start)), lambda r: (
                r["held"] >= similarity * r["size"]) & r["marked"])), 0)).otherwise(none)

    def run(pairs: Column, t: Column, start: Column) -> Column:
        own = F.filter(F.slice(pairs, F.lit(1), t["words"] - 1), lambda p: F.array_contains(t["pairs"], p["pair"]))
        return F.get(F.transform(F.array(own), lambda o: F.get(F.transform(F.array(F.transform(
            o, lambda p: p["pair"])), lambda names: held(o, names, t, start)), 0)), 0)

    def held(own: Column, names: Column, t: Column, start: Column) -> Column:
        distinct = F.array_distinct(names)
        # the last pair that was not there before, and one that follows it at once
        last = F.array_max(F.transform(distinct, lambda x: F.get(own, (F.array_position(names, x) - 1).cast("int"))["at"]))
        end = F.array_max(F.transform(F.filter(own, lambda p: p["at"] <= last + 1), lambda p: p["line"])) + 1
        return F.struct(start.alias("start"), end.alias("end"), t["family"].alias("family"), F.size(distinct).alias("held"),
                        F.size(t["pairs"]).alias("size"),
                        F.forall(t["marks"], lambda m: F.array_contains(distinct, m)).alias("marked"))

    none = F.array().cast("array<struct<start:int,end:int,family:string,held:int,size:int,marked:boolean>>")
    blank = F.array(F.struct(F.lit("").alias("word"), F.lit(-1).alias("line")))

    def first_words(found: Column) -> Column:
        """The runs of each line, from the words of the whole text."""
        own = F.transform(found, lambda ws: F.size(ws))
        words = F.flatten(found)
        starts = F.aggregate(own, F.array(F.lit(1)), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)))
        return F.get(F.transform(F.array(F.struct(words.alias("words"), starts.alias("starts"))), lambda d: F.transform(
            F.sequence(F.lit(0), F.size(found) - 1), lambda i: F.get(F.transform(F.array(F.concat(F.slice(
                d["words"], F.get(d["starts"], i), span()), blank)), lambda x: from_here(F.slice(x, F.lit(1), (
                    F.array_position(F.transform(x, lambda w: w["word"]), "") - 1).cast("int")))), 0))), 0)

    return F.get(F.transform(F.array(F.transform(lines, tokens)), first_words), 0)


def fullest(at: Column) -> Column:
    """Of runs of a family that overlap, the one that holds most pairs (the shortest, then the first of
    equals), without those that overlap an earlier one still; a run of class unknown gives way to any
    that holds as many pairs."""
    def stands(c: Column) -> Column:
        back = F.greatest(c["start"] - span(), F.lit(0))
        near = F.flatten(F.slice(at, back + 1, c["end"] - back))
        return ~F.exists(near, lambda d: ((d["family"] == c["family"]) | (c["family"] == "unknown")) & (
            d["end"] > c["start"]) & (
            F.struct(-d["held"], d["family"] == "unknown", d["end"] - d["start"], d["start"]) < F.struct(
                -c["held"], c["family"] == "unknown", c["end"] - c["start"], c["start"])))

    few = F.lit(len(NOTICES) * span())
    return F.aggregate(
        F.filter(F.flatten(at), stands),
        F.array().cast("array<struct<start:int,end:int,family:string,held:int,size:int,marked:boolean>>"),
        lambda a, c: F.when(F.exists(F.slice(a, F.greatest(F.size(a) - few, F.lit(0)) + 1, few), lambda d: (
            d["family"] == c["family"]) & (d["end"] > c["start"])), a).otherwise(F.concat(a, F.array(c))))


def similarity_to(words: Column, templates: Column, family: Column | None = None, marked: bool = False) -> Column:
    """The largest share of a template's word pairs that ``words`` hold (``marked``: of templates
    whose marks they all hold)."""
    pairs = pairs_of(words)
    chosen = templates if family is None else F.filter(templates, lambda t: t["family"] == family)
    if marked:
        chosen = F.filter(chosen, lambda t: F.size(F.array_intersect(t["marks"], pairs)) == F.size(t["marks"]))
    return F.aggregate(F.transform(chosen, lambda t: F.size(F.array_intersect(pairs, t["pairs"])) / F.size(t["pairs"])),
                       F.lit(0.0), lambda a, x: F.greatest(a, x))


def templates() -> list[tuple[str, list[str], list[str], int]]:
    """family, word pairs and marks of each notice, and the words that it may be spread over."""
    out = []
    for family, notices in NOTICES.items():
        for n in notices:
            w = re.findall(r"[^\W_]+", n.lower())
            pairs = sorted({f"{a} {b}" for a, b in zip(w, w[1:], strict=False)})
            named = MARKS.get(family) or {p for p in pairs if re.search(r" (un)?licen[cs]e$|^(public|cc|gnu|identifier|binary) ", p)}
            out.append((family, pairs, [p for p in pairs if p in named], math.ceil(STRETCH * len(w))))
    return out


def template_literal() -> Column:
    return F.array(*[F.struct(F.lit(family).alias("family"), F.array(*map(F.lit, pairs)).alias("pairs"),
                              F.array(*map(F.lit, marks)).cast("array<string>").alias("marks"), F.lit(words).alias("words"))
                     for family, pairs, marks, words in templates()])


def examples(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """label, words, fold: worn notices, and a bounded sample of other paragraphs of the corpus."""
    spark = docs.sparkSession
    lines = paragraphs(docs, doc_id, text).where("line is not null and length(trim(line)) > 0").select("line")
    lines = lines.where(F.length("line") < 2000).orderBy(F.xxhash64("line"), "line").limit(BACKGROUND)
    bare = lines.select(words_of(F.col("line")).alias("words"))
    background = staged(bare.where((F.size("words") > 0) & (similarity_to(F.col("words"), template_literal()) < 0.5)
                            & ~F.array_contains("words", "license") & ~F.array_contains("words", "licence")).select(
        F.lit(CLASSES.index("none")).alias("label"), "words", F.pmod(F.xxhash64("words"), F.lit(4)).alias("fold")),
        "licence-background")
    notices = rows_of(spark, [{"label": CLASSES.index(f), "notice": n} for f, ns in NOTICES.items() for n in ns],
                      "label:int,notice:string")
    forms = notices.select("label", words_of(F.col("notice")).alias("all"), F.explode(
        F.sequence(F.lit(0), F.lit(WORN - 1))).alias("form"))
    kept = F.filter("all", lambda w, i: (F.col("form") == 0) | (F.size("all") < 4) | (
        F.pmod(F.xxhash64(w, i, F.col("form")), F.lit(12)) > 0))
    worn = forms.select("label", kept.alias("words"), F.pmod("form", F.lit(4)).cast("long").alias("fold"),
                        F.when(F.col("form") % 2 == 1, F.pmod(F.xxhash64("all", "form"), F.lit(997))).alias("at"))
    # half of them stand among words of the corpus, others each time
    beside = background.select(F.pmod(F.xxhash64("words"), F.lit(997)).alias("at"),
                               F.slice("words", 1, 6).alias("near")).groupBy("at").agg(F.max("near").alias("near"))
    worn = worn.join(F.broadcast(beside), "at", "left").select(
        "label", F.when(F.col("near").isNotNull(), F.concat("near", "words")).otherwise(F.col("words")).alias("words"),
        "fold")
    return worn.unionByName(background)


@dataclass
class LicenseModel:
    terms: list[str]
    weights: list[list[float]]  # by term, then class; already calibrated, like the intercepts
    intercepts: list[float]

    def cue(self) -> str | None:
        """A pattern of terms of which every licence paragraph has one.

        P(none) < 1/2 needs a class whose log odds against ``none`` exceed -log(classes).
        The weakest terms are left out as long as all of them together cannot lift any
        class from the intercepts to there.
        """
        none = len(CLASSES) - 1
        need = [self.intercepts[none] - b - math.log(none) for b in self.intercepts[:none]]
        lift = {t: [max(0.0, x - w[none]) for x in w[:none]] for t, w in zip(self.terms, self.weights, strict=True)}
        cues = sorted((t for t in lift if max(lift[t]) > 0), key=lambda t: (max(lift[t]), t))
        while cues:
            need = [n - x for n, x in zip(need, lift[cues[0]], strict=True)]
            if min(need) <= 1e-6:
                break
            cues.pop(0)
        if not cues:
            return None
        by_letter: dict[str, list[str]] = {}
        for c in sorted(cues):
            rest = r"[^\p{L}\p{N}]+".join(re.escape(w) for w in c.split(" "))
            by_letter.setdefault(rest[0], []).append(rest[1:])
        groups = "|".join(f"{k}(?:{'|'.join(v)})" for k, v in sorted(by_letter.items()))
        return rf"(?<![\p{{L}}\p{{N}}])(?:{groups})(?![\p{{L}}\p{{N}}])"


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> LicenseModel:
    rows = staged(examples(docs, doc_id, text).select("label", "fold", terms_of(F.col("words")).alias("terms")).coalesce(4),
                  "licence-examples")
    counted = CountVectorizer(inputCol="terms", outputCol="features", binary=True, vocabSize=VOCABULARY, minDF=3).fit(rows)
    seen = counted.transform(rows)
    model = LogisticRegression(family="multinomial", elasticNetParam=1.0, regParam=0.002, maxIter=60,
                               standardization=False).fit(seen.where("fold > 0"))
    # the temperature that makes held-out examples likeliest
    held = model.transform(seen.where("fold = 0")).select(
        F.col("label").cast("int").alias("y"), vector_to_array("rawPrediction").alias("s"))
    grid = [0.4, 0.5, 0.65, 0.8, 1.0, 1.25, 1.6, 2.0, 2.5]

    def loss(t: float) -> Column:
        top = F.array_max("s")
        total = F.log(F.aggregate("s", F.lit(0.0), lambda a, x: a + F.exp((x - top) / t)))
        return F.avg(total - (F.element_at("s", F.col("y") + 1) - top) / t)

    losses = held.agg(*[loss(t).alias(f"l{i}") for i, t in enumerate(grid)]).first()
    best = min((losses[i], t) for i, t in enumerate(grid) if losses[i] is not None)[1] if losses[0] is not None else 1.0
    matrix, ahead = model.coefficientMatrix.toArray() / best, (model.interceptVector.toArray() / best).tolist()
    n = matrix.shape[0]
    matrix = [[*matrix[:, j].tolist(), *[-50.0] * (len(CLASSES) - n)] for j in range(matrix.shape[1])]
    kept = [(t, w) for t, w in zip(counted.vocabulary, matrix, strict=True) if any(w[:n])]
    return LicenseModel([t for t, _ in kept], [w for _, w in kept], ahead + [-50.0] * (len(CLASSES) - n))


def scan(docs: DataFrame, model: LicenseModel, least: float = 0.6, similarity: float = 0.8, doc_id: str = "doc_id",
         text: str = "text") -> DataFrame:
    """One row per licence paragraph, and one with a null paragraph per document row:
    rid (of the row), doc_id, n_paragraphs, paragraph, license, probability, similarity, confirmed."""
    none = len(CLASSES) - 1
    lines = paragraphs(docs, doc_id, text, similarity)
    cue = model.cue()
    hit = F.lower("line").rlike(cue) if cue else F.lit(False)
    lines = lines.where(F.col("line").isNull() | hit)
    words = lines.select("rid", "doc_id", "n_paragraphs", F.when(F.col("line").isNotNull(), F.col("paragraph")).alias(
        "paragraph"), words_of(F.coalesce("line", F.lit(""))).alias("words"))
    # The terms that have weights are few, and so are those of a paragraph among them.  The
    # scores are written once: as expressions they would be repeated wherever they are used.
    matched = words.withColumn("matched", F.array_intersect(
        terms_of(F.col("words")), F.array(*map(F.lit, model.terms)).cast("array<string>")))

    def score(k: int) -> Column:
        weights = F.create_map(*[F.lit(x) for t, w in zip(model.terms, model.weights, strict=True) for x in (t, w[k])])
        return F.aggregate("matched", F.lit(model.intercepts[k]), lambda a, t: a + F.element_at(weights, t))

    n = range(len(CLASSES))
    scored = staged(matched.select(*words.columns, *[score(k).alias(f"s{k}") for k in n]), "licence-scores")
    scored = scored.withColumn("most", F.greatest(*[F.col(f"s{k}") for k in n]))
    odds = scored.select(*words.columns, *[F.exp(F.col(f"s{k}") - F.col("most")).alias(f"o{k}") for k in n])
    odds = odds.withColumn("total", reduce(add, [F.col(f"o{k}") for k in n]))
    shares = odds.select(*words.columns, *[(F.col(f"o{k}") / F.col("total")).alias(f"p{k}") for k in n])
    families = range(len(FAMILIES))
    judged = shares.withColumn("top", F.greatest(*[F.col(f"p{k}") for k in families]))
    judged = judged.withColumn("family", F.coalesce(*[F.when(F.col(f"p{k}") == F.col("top"), F.lit(FAMILIES[k]))
                                                      for k in families]))
    is_licence = F.col("paragraph").isNotNull() & (F.col(f"p{none}") < 0.5)
    judged = judged.where(F.col("paragraph").isNull() | is_licence).withColumns({name: F.when(
        is_licence, similarity_to(F.col("words"), template_literal(), F.col("family"), marked))
        for name, marked in (("alike", False), ("marked", True))})
    confirmed = (F.col("top") >= least) & (F.col("marked") >= similarity)
    found = judged.select(
        "rid", "doc_id", "n_paragraphs", "paragraph",
        F.when(is_licence, F.when(confirmed, F.col("family")).otherwise("unknown")).alias("license"),
        F.when(confirmed, F.col("top")).otherwise(1 - F.col(f"p{none}")).alias("probability"),
        F.col("alike").alias("similarity"), confirmed.alias("confirmed"))
    return found.where("paragraph is null or license is not null")


def per_document(found: DataFrame) -> DataFrame:
    """Per document row: n_paragraphs, n_licenses (paragraphs), licenses (names, comma-joined), and the least
    probability and similarity among them."""
    return found.groupBy("rid", "doc_id", "n_paragraphs").agg(
        F.count("license").alias("n_licenses"),
        F.concat_ws(",", F.array_sort(F.collect_set("license"))).alias("licenses"),
        F.min(F.when(F.col("license").isNotNull(), F.col("probability"))).alias("probability"),
        F.min(F.when(F.col("license").isNotNull(), F.col("similarity"))).alias("similarity")).drop("rid")


def softmax(scores: list[float]) -> list[float]:
    top = max(scores)
    e = [math.exp(s - top) for s in scores]
    return [x / sum(e) for x in e]


def brute_force(model: LicenseModel, line: str, least: float = 0.6, similarity: float = 0.8) -> str | None:
    """The class of one paragraph by plain arithmetic over all terms; None if it is no licence."""
    w = re.findall(r"[^\W_]+", line.lower())
    terms = set(w) | {f"{a} {b}" for a, b in zip(w, w[1:], strict=False)}
    weight = dict(zip(model.terms, model.weights, strict=True))
    p = softmax([b + sum(weight[t][k] for t in terms if t in weight) for k, b in enumerate(model.intercepts)])
    if p[-1] >= 0.5:
        return None
    k = max(range(len(FAMILIES)), key=lambda i: p[i])
    alike = 0.0
    for family, pairs, marks, _ in templates():
        if family == FAMILIES[k] and terms.issuperset(marks):
            alike = max(alike, len(terms.intersection(pairs)) / len(pairs))
    return FAMILIES[k] if p[k] >= least and alike >= similarity else "unknown"

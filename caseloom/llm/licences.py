"""Licence notices in documents: a trained paragraph classifier, confirmed by comparison with templates.

A paragraph (line) becomes counts of word 1- and 2-grams; only n-grams of the templates are features, so vectors are sparse and
ordinary prose has next to none.  A multinomial logistic regression tells the licence families, "unknown" (licensing language of
no known family) and "none" apart.  It is trained here, on variants of the templates and a bounded sample of the corpus's own
paragraphs.  A prediction is *confirmed* when one of the best family's templates is found in the paragraph: at least
``TEMPLATE_SHARE`` of the template's distinct word pairs.  A family that is not confirmed counts only if its probability reaches
a limit that separates right from wrong families on held-out alterations of all sentences; below it the paragraph is "unknown".

Notices that are wrapped over several lines are found by runs: neighbouring lines that each have a telling word pair of the
templates.  A run's joined text is compared with the templates too; where it confirms a family that none of its lines
confirms alone, it is one row, and its lines that confirm nothing by themselves are none.

Built-in functions and ``pyspark.ml`` only.
"""

from __future__ import annotations

import re

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.common import stored

# Sentences by which each family is known.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "License-Identifier: Apache-2.0",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "License-Identifier: GPL-3.0-or-later",
    ),
    "gpl-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License.",
        "License-Identifier: GPL-2.0-only",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License.",
        "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "License-Identifier: LGPL-2.1",
    ),
    "mit": (
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "License-Identifier: MIT",
    ),
    "bsd": (
        "Licensed under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "License-Identifier: BSD-3-Clause",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "License-Identifier: MPL-2.0",
    ),
    **{
        f"cc-{short.lower()}": (
            f"Licensed under CC {short} 4.0.",
            f"CC {short} 3.0",
            f"This work is licensed under a Creative Commons {name} 4.0 International License.",
            f"Licensed under the Creative Commons {name} License.",
        )
        for short, name in (
            ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
            ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        )
    },
    "cc0": (
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This work is dedicated to the public domain under Creative Commons Zero.",
    ),
    "agpl-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License.",
        "License-Identifier: AGPL-3.0-or-later",
    ),
    "epl-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
        "License-Identifier: EPL-2.0",
    ),
    "isc": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
        "License-Identifier: ISC",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "License-Identifier: Unlicense",
    ),
    "bsl-1.0": (
        "Distributed under the Boost Software License, Version 1.0.",
        "License-Identifier: BSL-1.0",
    ),
    "eupl-1.2": (
        "Licensed under the European Union Public Licence, version 1.2.",
        "License-Identifier: EUPL-1.2",
    ),
}
# Licensing language of no family above.
UNKNOWN = (
    "All rights reserved.",
    "This software is licensed under the terms of a commercial agreement.",
    "Licensed under the terms of the community license of the project.",
    "All rights reserved; no part of this work may be copied without permission of the publisher.",
    "This file is licensed under the same license as the package itself.",
    "Use of this work is subject to the license terms of the owner.",
    "You may not use, copy or modify this software without written permission.",
    "Proprietary and confidential; redistribution is prohibited.",
    "We may not obtain a copy of the book without permission of the publisher.",
    "This article compares the licenses that projects choose and how their terms differ.",
)
# Paragraphs with such wording may be notices of no template: they are never taken for ordinary text.
# A pattern for lower-cased text from the start of a word on, where most places are left at once.
WORDING = r"(?:(?:sub|re|un)?licen[sc]|lizenz|copyright|©|creative commons|cc[ -]?(?:by|0|zero)\b|by-(?:nc|nd|sa)\b|public domain|(?:all|some) rights reserved)"
_START = r"(?<![\p{L}\p{Nd}])"
# Word pairs of these alone are in any text; the lines of a wrapped notice have others.
_PLAIN = frozenset("a all an and any are as at be by for from in is it may no not of on or that the this to under use with without you".split())
# Families whose templates share most of their words: of a run only the best of each counts.
_RELATED = {"gpl-3.0": "gnu", "gpl-2.0": "gnu", "lgpl": "gnu", "agpl-3.0": "gnu", **{f: "cc" for f in TEMPLATES if f.startswith("cc-")}}
NEGATIVE_ROWS = 3_000  # paragraphs of the corpus the classifier is trained on at most, taken by hash
TEMPLATE_SHARE = 0.6
SEED = 11


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{Nd}]+"), lambda w: w != "")


def _grams(words: str) -> Column:
    pairs = F.zip_with(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.concat(F.col(words), pairs)


def _pairs(words: Column) -> Column:
    rest = F.greatest(F.size(words) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(words, F.lit(1), rest), F.slice(words, F.lit(2), rest), lambda a, b: F.concat_ws(" ", a, b)))


def _literal(grams: list[str]) -> Column:
    """The n-grams, which hold letters, digits and spaces only, as a constant array: one literal that Spark splits once per plan."""
    return F.split(F.lit("|".join(grams)), r"\|")


def _with_grams(rows: DataFrame) -> DataFrame:
    return rows.withColumn("words", _words(F.col("paragraph"))).withColumn("grams", _grams("words"))


def _variants(sentence: str) -> list[str]:
    """The sentence, without its ends, and inside other text."""
    words = sentence.split()
    cut = max(1, len(words) // 5)
    return [sentence, " ".join(words[cut:]), " ".join(words[:-cut]), f"Copyright the authors. {sentence}", f"{sentence} See the file for details."]


def _altered(sentence: str) -> list[str]:
    """Notices as the training has not seen them: words dropped or swapped, other lead-ins and endings.  Of short sentences some of
    these are variants that it has seen; they are left out."""
    words = sentence.split()
    dropped = [" ".join(w for k, w in enumerate(words) if k % 5 != at) for at in (1, 3)]
    swapped = list(words)
    for k in range(1, len(words) - 1, 4):
        swapped[k], swapped[k + 1] = swapped[k + 1], swapped[k]
    made = [*dropped, " ".join(swapped), f"Unless noted otherwise, this package holds: {sentence}", f"{sentence} Questions go to the maintainers of the project."]
    plain = lambda text: re.findall(r"[^\W_]+", text.lower())
    seen = [plain(v) for v in _variants(sentence)]
    return [v for v in made if plain(v) not in seen]


def separating_limit(right: list[float], wrong: list[float]) -> float:
    """The limit that loses the least share of the right ones and lets in the least share of the wrong ones; between two values."""
    values = sorted({0.0, 1.0, *right, *wrong})
    middles = [(a + b) / 2 for a, b in zip(values, values[1:])]
    return min(middles, key=lambda t: sum(p < t for p in right) / max(len(right), 1) + sum(p >= t for p in wrong) / max(len(wrong), 1))


def any_of(words: set[str]) -> str:
    """Pattern for one of the words.  Common beginnings are written once, so a place in the text is left after a letter or two
    instead of being tried against every word."""
    branches: dict[str, set[str]] = {}
    for word in words:
        branches.setdefault(word[:1], set()).add(word[1:])
    inner = [re.escape(first) + any_of(rest) for first, rest in sorted(branches.items()) if first]
    if not inner:
        return ""
    return f"(?:{'|'.join(inner)})" + "?" * ("" in branches)


def telling_pairs(pairs: list[str]) -> str:
    """Pattern for one of the word pairs from the start of a word on, as ``_pairs`` finds them in lower-cased text; pairs of plain words alone are left out."""
    after: dict[str, set[str]] = {}
    for first, second in (p.split() for p in pairs if not set(p.split()) <= _PLAIN):
        after.setdefault(first, set()).add(second)
    # first words that are followed by the same words share a branch
    same: dict[frozenset[str], set[str]] = {}
    for first, seconds in after.items():
        same.setdefault(frozenset(seconds), set()).add(first)
    gap = r"[^\p{L}\p{Nd}]+"
    branches = "|".join(any_of(firsts) + gap + any_of(set(seconds)) for seconds, firsts in sorted(same.items(), key=lambda x: min(x[1])))
    # the look at the first word's beginning rejects most places of a text before any branch is tried
    return rf"(?={any_of(set(after))}{gap})(?:{branches})(?![\p{{L}}\p{{Nd}}])"


def paragraphs(documents: DataFrame) -> DataFrame:
    """doc_id, position, paragraph: non-blank lines."""
    lines = F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("position", "paragraph")
    return documents.select("doc_id", lines).where(F.col("paragraph").rlike(r"\p{L}"))


def units(documents: DataFrame, pairs: list[str]) -> DataFrame:
    """doc_id, position, paragraph, run: the lines with licence wording or a telling pair of ``pairs`` (run NULL), and the confirmed runs
    (run: the family).

    Lines of a confirmed run that no template confirms alone are left out.  All is worked out inside a row of ``documents``."""
    names = list(TEMPLATES)
    of = {f: sorted({p for s in TEMPLATES[f] for p in _pairs_of(s)}) for f in names}
    telling = {f: [p for p in of[f] if not set(p.split()) <= _PLAIN] for f in names}
    # Whole texts are looked at first, then lines; only lines that pass are split into words.
    look = f"{_START}(?:{WORDING}|{telling_pairs(pairs)})"
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("position"), x.alias("paragraph")))
    lines = F.filter(lines, lambda h: F.lower(h["paragraph"]).rlike(look))
    hits = F.transform(
        lines,
        lambda h: F.struct(h["position"].alias("position"), h["paragraph"].alias("paragraph"), F.array_intersect(_pairs(_words(h["paragraph"])), _literal(pairs)).alias("pairs")),
    )
    # A text without such lines has no run and leaves with the explode below; a filter here would work the lines out twice.
    hits = documents.where(F.lower("text").rlike(look)).select("doc_id", hits.alias("hits"))
    every = _literal(sorted({p for f in names for p in telling[f]}))
    hits = hits.withColumn("told", F.transform("hits", lambda h: F.arrays_overlap(h["pairs"], every)))

    def begins(h: Column, i: Column) -> Column:
        return (i == 0) | ~F.get("told", i) | ~F.get("told", i - 1) | (F.get("hits", i - 1)["position"] + 1 != h["position"])

    marked = F.transform("hits", lambda h, i: F.struct(i.alias("at"), begins(h, i).alias("first")))
    hits = hits.withColumn("first", F.transform(F.filter(marked, lambda m: m["first"]), lambda m: m["at"]))
    run = F.transform("first", lambda a, k: F.slice("hits", a + 1, F.coalesce(F.get("first", k + 1), F.size("hits")) - a))
    runs = hits.select("doc_id", F.explode(run).alias("hits"))
    several = F.size("hits") > 1  # a single line is compared with its family's templates later
    runs = runs.withColumn("whole", F.when(several, F.array_join(F.transform("hits", lambda h: h["paragraph"]), " ")))
    runs = runs.withColumn("pairs", F.when(several, _pairs(_words(F.col("whole")))))
    runs = runs.withColumn("by_run", F.when(several, F.array(*(_family_share(f, F.col("pairs")) for f in names))))
    runs = runs.withColumn("by_line", F.when(several, F.transform("hits", lambda h: F.array(*(_family_share(f, h["pairs"]) for f in names)))))

    def confirms_alone(members: list[int]) -> Column:
        return F.exists("by_line", lambda x: F.array_max(F.array(*(F.get(x, F.lit(k)) for k in members))) >= TEMPLATE_SHARE)

    def begin_of(family: str) -> Column:
        return F.get(F.filter("hits", lambda h: F.arrays_overlap(h["pairs"], _literal(telling[family]))), F.lit(0))["position"]

    groups: dict[str, list[int]] = {}
    for k, f in enumerate(names):
        groups.setdefault(_RELATED.get(f, f), []).append(k)
    found = []
    for members in groups.values():
        shares = [F.get("by_run", F.lit(k)) for k in members]
        best = F.array_max(F.array(*shares))
        by_a_line = confirms_alone(members)
        # the notice begins with the first line that has a telling pair of its family
        begin = [begin_of(names[k]) for k in members]
        notice = F.coalesce(*(F.when(x == best, F.struct(b.alias("position"), F.col("whole").alias("paragraph"), F.lit(names[k]).alias("run"))) for x, b, k in zip(shares, begin, members)))
        found.append(F.when((best >= TEMPLATE_SHARE) & ~by_a_line, notice))
    runs = runs.withColumn("found", F.filter(F.array(*found), lambda x: x.isNotNull()))
    line = F.transform(
        "hits",
        lambda h, i: F.when(
            (F.size("found") == 0) | (F.array_max(F.get("by_line", i)) >= TEMPLATE_SHARE),
            F.struct(h["position"].alias("position"), h["paragraph"].alias("paragraph"), F.lit(None).cast("string").alias("run")),
        ),
    )
    found_or_line = F.explode(F.concat(F.filter(line, lambda x: x.isNotNull()), "found")).alias("unit")
    return runs.select("doc_id", found_or_line).select("doc_id", "unit.position", "unit.paragraph", "unit.run")


def train(spark: SparkSession, lines: DataFrame) -> tuple[PipelineModel, list[str], float]:
    """Fitted stages, class names by label, and the probability a family must reach.

    Negatives are at most NEGATIVE_ROWS paragraphs of the corpus without licence wording that share few n-grams with the templates."""
    names = ["none", "unknown", *TEMPLATES]
    texts = [(names.index(f), s) for f, sentences in TEMPLATES.items() for s in sentences] + [(1, s) for s in UNKNOWN]
    rows = [(label, v, held) for label, s in texts for held, make in ((False, _variants), (True, _altered)) for v in make(s)]
    known = _with_grams(spark.createDataFrame(rows, "label int, paragraph string, held boolean"))
    vocabulary = [r[0] for r in known.where("not held").select(F.explode("grams").alias("g")).distinct().orderBy("g").collect()]  # of the templates
    terms = _literal(vocabulary)
    sample = lines.where(~F.lower("paragraph").rlike(_START + WORDING)).orderBy(F.xxhash64(F.lit(SEED), "doc_id", "position"), "doc_id", "position").limit(NEGATIVE_ROWS)
    sample = _with_grams(sample.select("paragraph"))
    common = F.size(F.filter("grams", lambda g: F.array_contains(terms, g) & g.contains(" ")))
    negatives = sample.where(2 * common < F.size("grams") - F.size("words") + 1)
    negatives = negatives.select(F.lit(0).alias("label"), "paragraph", F.lit(False).alias("held"), "words", "grams")
    counter = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features")
    # some thousand rows at most (NEGATIVE_ROWS and the sentences): the solver's many passes are one short task each
    data = stored(counter.transform(known.unionByName(negatives)).select("label", "features", "held").coalesce(1), "licence_rows")
    counts = {r["label"]: r["count"] for r in data.where("not held").groupBy("label").count().collect()}
    total = sum(counts.values())
    balance = F.lit(1.0)
    for label, n in sorted(counts.items()):
        balance = F.when(F.col("label") == label, total / n / len(counts)).otherwise(balance)
    fit = LogisticRegression(maxIter=60, regParam=1e-3, elasticNetParam=0.2, family="multinomial", weightCol="weight")
    model = fit.fit(data.where("not held").withColumn("weight", balance))
    # a few hundred rows: the best family's probability, and whether the notice is of that family
    families = F.slice(vector_to_array("probability"), F.lit(3), F.lit(len(TEMPLATES)))
    held = model.transform(data.where("held")).select("label", F.array_max(families).alias("p"), F.array_position(families, F.array_max(families)).alias("at"))
    held = [(r["p"], r["label"] == r["at"] + 1) for r in held.collect()]
    limit = separating_limit([p for p, right in held if right], [p for p, right in held if not right])
    return PipelineModel([counter, model]), names, limit


def scan_licences(documents: DataFrame) -> DataFrame:
    """doc_id, position, family, probability, similarity, confirmed: one row per paragraph (line or wrapped notice) with licensing language.

    ``position`` is the number from 0 of the line, or of a wrapped notice's first line.  ``similarity`` is the largest share of a template's word pairs found in the paragraph
    (of the predicted family; 0 for "unknown", which is never confirmed).  NULL, empty and blank texts have no rows; rows are
    read one by one, so NULL ids, repeated rows and further columns (left out) change nothing; an empty table gives no rows.
    """
    spark = documents.sparkSession
    lines = paragraphs(documents.select("doc_id", "text"))
    model, names, limit = train(spark, lines)
    counter, classifier = model.stages
    # A paragraph without a word pair of the templates is ordinary text (single words of theirs are everywhere); only the
    # others are counted and scored.
    counted = counter.transform(_with_grams(units(documents, sorted(g for g in counter.vocabulary if " " in g))))
    scored = classifier.transform(counted).withColumn("p", vector_to_array("probability"))
    families = F.slice("p", F.lit(3), F.lit(len(names) - 2))
    known = F.array(*map(F.lit, names[2:]))
    at = F.coalesce(F.array_position(known, F.col("run")), F.array_position(families, F.array_max(families)))
    licence = scored.withColumn("at", (at - 1).cast("int"))
    licence = licence.withColumn("best", F.get(families, F.col("at"))).withColumn("family", F.get(known, F.col("at")))
    licence = licence.withColumn("pairs", F.filter("grams", lambda g: g.contains(" ")))
    similarity = F.lit(0.0)
    for family in TEMPLATES:
        similarity = F.when(F.col("family") == family, _family_share(family, F.col("pairs"))).otherwise(similarity)
    # the templates of the best family are compared first: what they confirm needs no probability
    licence = licence.withColumn("similarity", similarity).withColumn("found", F.col("similarity") >= TEMPLATE_SHARE)
    licence = licence.where(F.col("found") | (F.get("p", F.lit(0)) < 0.5)).withColumn("named", F.col("found") | (F.col("best") >= limit))
    licence = licence.withColumn("family", F.when(F.col("named"), F.col("family")).otherwise("unknown"))
    licence = licence.withColumn("similarity", F.when(F.col("named"), F.col("similarity")).otherwise(0.0))
    return licence.select(
        "doc_id", F.col("position").cast("long").alias("position"), "family", F.round("best", 6).alias("probability"), F.round("similarity", 6).alias("similarity"),
        (F.col("similarity") >= TEMPLATE_SHARE).alias("confirmed"),
    )


def _pairs_of(sentence: str) -> list[str]:
    words = [w for w in re.split(r"[^\w]+|_", sentence.lower()) if w]
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def _share_found(sentence: str, found: Column) -> Column:
    pairs = _pairs_of(sentence)
    return F.size(F.array_intersect(found, _literal(pairs))) / F.lit(float(len(pairs)))


def _family_share(family: str, found: Column) -> Column:
    """The largest share of a template's word pairs among ``found``."""
    return F.array_max(F.array(*(_share_found(s, found) for s in TEMPLATES[family])))

r"""Licence scan: spans of text against licence templates by Dice coefficient over word bigrams.

Spans are the lines of a text and its paragraphs of more than one line (runs
of lines without a blank one). A span and a template are normalised to their
lower-case words of letters and digits; their similarity is the Dice
coefficient of their sets of word bigrams, ``2 * shared / (a + b)``.

A Dice coefficient of ``threshold`` takes ``threshold / (2 - threshold)`` of
the template's distinct bigrams in the span. A span without any of a choice of
words (``anchors``) that more than the rest of the bigrams hold can't match
that template; neither can one of fewer words than the bigrams it needs, nor
one whose distinct bigrams outnumber the template's by the inverse. Most spans
are dropped on their words, and bigrams are built for the rest only. Repeated
words and bigrams change none of these bounds.

DataFrame functions only, no shuffle: templates are a bounded list of
constants. A row is a matching span with its best template (of equals the
first by name). Defined results: null and empty texts and spans of fewer than
two words match nothing; repeated rows are scanned each for itself. Extra
columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import computed

THRESHOLD = 0.8

# Public licence notices.
TEMPLATES = {
    "AGPL-3.0": "This program is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except '
                         "in compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-NC-4.0-short": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
               "to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                      "General Public License as published by the Free Software Foundation, either version 3 of the "
                      "License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  'associated documentation files (the "Software"), to deal in the Software without restriction, including '
                  "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
                  "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
                  "following conditions:",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def template_bigrams(text: str) -> tuple[int, list[str]]:
    """A template's word count and distinct bigrams."""
    words = re.findall(r"[^\W_]+", text.lower())
    return len(words), sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def size_bounds(words: int, threshold: float) -> tuple[float, float]:
    """Bounds on the words of a span without repeated bigrams; the scan itself does not rely on them."""
    return words * threshold / (2 - threshold), words * (2 - threshold) / threshold


def least_shared(grams: int, threshold: float) -> int:
    """Bigrams that a span shares at least with a template of ``grams`` distinct ones if it matches."""
    return max(1, math.ceil(grams * threshold / (2 - threshold) - 1e-9))


def anchors(grams: list[str], threshold: float) -> set[str]:
    """Words of which every match of the template holds one, long ones first."""
    spare = len(grams) - least_shared(len(grams), threshold)
    chosen: set[str] = set()
    for word in sorted({w for g in grams for w in g.split()}, key=lambda w: (-len(w), w)):
        if sum(not chosen.isdisjoint(g.split()) for g in grams) > spare:
            break
        chosen.add(word)
    return chosen


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                  templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """``(id_col, kind, first_line, words, license, dice)`` of every span that matches a template."""
    known = [(name, template_bigrams(text)[1]) for name, text in sorted(templates.items())]
    lines = F.split(F.col(text_col), "\n")
    numbered = computed(docs.filter(F.col(text_col).isNotNull()), F.col(id_col).alias("id"), lines.alias("lines"))
    starts = F.filter(F.transform("lines", lambda x, i: F.when(  # a line that is not blank, after one that is or none
        (F.trim(x) != "") & (F.coalesce(F.trim(F.get("lines", i - 1)), F.lit("")) == ""), i)), lambda i: i.isNotNull())
    opened = computed(numbered, "id", "lines", starts.alias("starts"))

    def paragraph(start, i):
        rest = F.coalesce(F.get("starts", i + 1), F.size("lines")) - start
        body = F.slice("lines", start + 1, rest)
        many = F.size(F.filter(body, lambda x: F.trim(x) != "")) > 1
        return F.when(many, F.struct(F.lit("paragraph").alias("kind"), start.alias("first_line"),
                                     F.array_join(body, " ").alias("span")))

    single = F.transform("lines", lambda x, i: F.struct(F.lit("line").alias("kind"), i.alias("first_line"), x.alias("span")))
    spans = opened.select("id", F.explode(F.concat(single, F.filter(F.transform("starts", paragraph),
                                                                    lambda s: s.isNotNull()))).alias("s")).select("id", "s.*")
    word = r"[\p{L}\p{N}]+"
    n_words = F.size("w")
    needed = min(least_shared(len(grams), threshold) for _, grams in known)
    most = max(len(grams) for _, grams in known) * (2 - threshold) / threshold + 1e-9
    any_word = F.array(*map(F.lit, sorted(set().union(*(anchors(grams, threshold) for _, grams in known)))))
    worded = computed(spans, "id", "kind", "first_line", F.regexp_extract_all(F.lower("span"), F.lit(word), F.lit(0)).alias("w"))
    sized = worded.filter((n_words > needed) & F.arrays_overlap("w", any_word.cast("array<string>")))
    pairs = F.array_distinct(F.transform(F.sequence(F.lit(1), n_words - 1),
                                         lambda i: F.concat(F.get("w", i - 1), F.lit(" "), F.get("w", i))))
    paired = computed(sized, "id", "kind", "first_line", n_words.alias("words"), pairs.alias("pairs"))
    scored = []
    for name, grams in known:
        shared = F.size(F.array_intersect(F.col("pairs"), F.array(*map(F.lit, grams)).cast("array<string>")))
        dice = 2.0 * shared / (F.size("pairs") + len(grams))
        # sorted by similarity, then the first name: struct order with the similarity negated
        scored.append(F.struct((-dice).alias("minus"), F.lit(name).alias("license")))
    first = F.least(*scored) if len(scored) > 1 else scored[0]
    best = computed(paired.filter(F.size("pairs") <= most), "id", "kind", "first_line", "words", first.alias("best"))
    found = best.filter(F.col("best.minus") <= -threshold)
    return found.select(F.col("id").alias(id_col), "kind", F.col("first_line").cast("int").alias("first_line"), "words",
                        F.col("best.license").alias("license"), (-F.col("best.minus")).alias("dice"))


def oracle(threshold: float = THRESHOLD, templates: dict[str, str] = TEMPLATES) -> str:
    """The scan of ``documents`` in DuckDB SQL."""
    known = ", ".join(f"('{n}', '{t.replace(chr(39), chr(39) * 2)}')" for n, t in sorted(templates.items()))
    words = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"
    pairs = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""
WITH templates(license, t) AS (VALUES {known}),
tw AS (SELECT license, {words.format('t')} AS w FROM templates),
tp AS (SELECT license, len(w) AS n, {pairs} AS p FROM tw),
split AS (SELECT row_number() OVER () AS r, doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
lined AS (SELECT r, doc_id, unnest(range(0, len(lines))) AS i, unnest(lines) AS line FROM split),
marked AS (SELECT *, trim(line) = '' AS blank FROM lined),
opened AS (SELECT *, NOT blank AND coalesce(lag(blank) OVER (PARTITION BY r ORDER BY i), true) AS opens FROM marked),
grouped AS (SELECT *, sum(opens::INT) OVER (PARTITION BY r ORDER BY i) AS g FROM opened),
spans AS (
  SELECT r, doc_id, 'line' AS kind, i AS first_line, line AS span FROM lined
  UNION ALL
  SELECT r, doc_id, 'paragraph', min(i), string_agg(line, ' ' ORDER BY i) FROM grouped
  WHERE g > 0 GROUP BY r, doc_id, g HAVING count(*) FILTER (NOT blank) > 1),
worded AS (SELECT r, doc_id, kind, first_line, {words.format('span')} AS w FROM spans),
paired AS (SELECT r, doc_id, kind, first_line, len(w) AS words, {pairs} AS p FROM worded WHERE len(w) >= 2 AND len(w) <= (SELECT max(n) FROM tp) * (2 - {threshold}) / {threshold}),
scored AS (
  SELECT r, doc_id, kind, first_line, words, license, 2.0::DOUBLE * len(list_intersect(paired.p, tp.p)) / (len(paired.p) + len(tp.p)) AS dice
  FROM paired JOIN tp ON words BETWEEN n * {threshold} / (2 - {threshold}) AND n * (2 - {threshold}) / {threshold})
SELECT doc_id, kind, first_line::INT AS first_line, words::INT AS words, license, dice FROM scored WHERE dice >= {threshold}
QUALIFY row_number() OVER (PARTITION BY r, kind, first_line ORDER BY dice DESC, license) = 1"""

"""Licence scans: normalised text against licence templates by the Dice
coefficient over word bigrams, in DataFrame functions only.

Three kinds of unit are compared: every line of a text, the text as a whole,
and passages, which are runs of words anywhere in it.  Units and templates
are lower-cased, everything but letters and digits becomes a space, and the
set of their word bigrams is compared: 2 * shared / (both sizes).  A line or
whole text is compared with a notice only if their sizes allow the threshold
(size bounds) and they share a bigram (an equi-join on bigrams).

Passages are compared with the notices and with the full licence texts.  They
find notices wrapped over lines, notices inside a longer line, and licence
files.  A passage starts and ends with a bigram of the template and is at most
(2 - threshold) / threshold times as long as it.  Bigrams of the template
count once in a passage, others each time.  What a matching line or whole text
holds already is no passage of that licence, and of overlapping passages the
one with the larger coefficient (the longer one of equals) is the unit.

Texts that lack the words that every match must hold (see ``may_match``) are
left out before anything is split.

Defined cases: null and empty texts and units of fewer than two words match
nothing; a unit that matches several templates is reported under each; equal
lines of a document are one unit each; repeated rows of a document add up; a
null doc_id is a document; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, written
from .license_texts import FULL_TEXTS

THRESHOLD = 0.8

# Notices as the licences' own texts ask to state them.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions "
        "and limitations under the License.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Released under the BSD 3-Clause License.",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
}


# words of a text, and the set of pairs of neighbouring words
_WORDS = r"filter(split(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), w -> w != '')"
_PAIRS = "array_distinct(zip_with(slice(words, 1, greatest(size(words) - 1, 0)), slice(words, 2, greatest(size(words) - 1, 0)), (a, b) -> concat(a, ' ', b)))"


# (bigram, line) of all words of a text, across its lines
_PLACES = ("zip_with(slice(words, 1, greatest(size(words) - 1, 0)), slice(words, 2, greatest(size(words) - 1, 0)), "
           "(a, b) -> struct(concat(a.w, ' ', b.w) AS bigram, a.line AS line))")
_LINED = r"flatten(transform(split(text, '\n'), (x, i) -> transform({words}, w -> struct(w AS w, i AS line))))".format(words=_WORDS.format(text="x"))

# words shorter than this are no anchors if longer ones do
_ANCHOR_CHARS = 6
# templates of more bigrams than this are looked for in long texts only
_LONG = 500


def template_bigrams(spark, templates=None) -> DataFrame:
    """(license, template, size, length, bigram) of the templates: size counts
    the distinct bigrams, length all of them."""
    rows = [(name, f"{name}#{n}", text) for name, texts in (templates or TEMPLATES).items() for n, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "license string, template string, text string").withColumn("words", F.expr(_WORDS.format(text="text")))
    df = df.withColumn("b", F.expr(_PAIRS))
    return df.select("license", "template", F.size("b").alias("size"), (F.size("words") - 1).alias("length"), F.explode("b").alias("bigram"))


def may_match(known, threshold: float, text: Column) -> Column:
    """False only for texts in which no unit can match a template of ``known``
    (rows of ``template_bigrams``).

    A match of a template of s bigrams shares at least s * threshold / (2 -
    threshold) of them.  Words that stand in more of its bigrams than may be
    missing are its anchors: a text with none of them holds no match."""
    grams: dict[str, list[str]] = {}
    for r in known:
        grams.setdefault(r["template"], []).append(r["bigram"])
    tiers: dict[int, tuple[set, set]] = {}
    for _, own in sorted(grams.items(), key=lambda x: (len(x[1]), x[0])):
        shared = math.ceil(len(own) * threshold / (2 - threshold) - 1e-9)
        words, pairs = tiers.setdefault(len(own) > _LONG, (set(), set()))
        shortest = min(2 * shared, tiers.get("chars", 2 * shared)) if len(own) > _LONG else 0
        if shortest:
            tiers["chars"] = shortest
        left = [b for b in own if not any(w in b for w in words)]
        choice = sorted({w for b in own for w in b.split(" ") if len(w) >= _ANCHOR_CHARS})
        while len(left) >= shared and choice:
            word = max(choice, key=lambda w: (sum(w in b for b in left), len(w)))
            if not any(word in b for b in left):
                break
            words.add(word)
            left = [b for b in left if word not in b]
        left.sort(key=lambda b: (len(b), b))
        while len(left) >= max(shared, 1):
            pairs.add(left.pop())

    def holds(t, words, pairs):
        found = F.lit(False)
        for w in sorted(words):
            found = found | F.contains(t, F.lit(w))
        for a, b in sorted(p.split(" ") for p in pairs):
            found = found | (F.contains(t, F.lit(a)) & F.contains(t, F.lit(b)) & F.regexp_like(t, F.lit(a + r"[^\p{L}\p{N}]+" + b)))
        return found

    chars = tiers.pop("chars", 0)
    # one element, so that the text is lower-cased once
    return F.exists(F.array(F.lower(text)), lambda t: holds(t, *tiers.get(False, ((), ()))) | ((F.length(t) >= chars) & holds(t, *tiers.get(True, ((), ())))))


def _line_matches(texts: DataFrame, known, templates: DataFrame, threshold: float) -> DataFrame:
    """(doc_id, row, unit, whole, license, dice) of lines and whole texts."""
    sizes = {r["template"]: r["size"] for r in known}
    bigrams = sorted({r["bigram"] for r in known})
    # a unit of a bigrams may match a template of b only if 2 * min(a, b) / (a + b) reaches the threshold
    low = min(sizes.values()) * threshold / (2 - threshold)
    high = max(sizes.values()) * (2 - threshold) / threshold
    units = texts.withColumn("lines", F.size(F.split("text", "\n")))
    units = units.select("doc_id", "row", "lines", F.posexplode(F.expr(r"if(instr(text, '\n') > 0, concat(split(text, '\n'), array(text)), array(text))")).alias("unit", "text"))
    units = units.withColumn("words", F.expr(_WORDS.format(text="text"))).filter(F.size("words") > low)
    whole = (F.col("lines") == 1) | (F.col("unit") == F.col("lines"))
    units = units.select("doc_id", "row", "unit", whole.alias("whole"), F.expr(_PAIRS).alias("bigrams")).filter(F.size("bigrams").between(low, high))
    units = units.filter(F.arrays_overlap("bigrams", F.array(*[F.lit(b) for b in bigrams])))
    shared = (units.select("doc_id", "row", "unit", "whole", F.size("bigrams").alias("n"), F.explode("bigrams").alias("bigram"))
              .join(F.broadcast(templates), "bigram")
              .filter((F.col("n") >= F.col("size") * (threshold / (2 - threshold))) & (F.col("n") <= F.col("size") * ((2 - threshold) / threshold))))
    dice = (shared.groupBy("doc_id", "row", "unit", "whole", "license", "template", "n", "size").agg(F.count("*").alias("k"))
            .withColumn("dice", 2 * F.col("k") / (F.col("n") + F.col("size"))).filter(F.col("dice") >= threshold))
    return dice.groupBy("doc_id", "row", "unit", "whole", "license").agg(F.max("dice").alias("dice"))


def _passages(texts: DataFrame, lines: DataFrame, templates: DataFrame, threshold: float) -> DataFrame:
    """(doc_id, license, n, dice) of each row's passages, beside the ``lines``
    that match: n passages, dice the largest coefficient."""
    places = texts.select("doc_id", "row", F.expr(_LINED).alias("words")).select("doc_id", "row", F.posexplode(F.expr(_PLACES)).alias("pos", "at"))
    hits = places.select("doc_id", "row", "pos", "at.bigram", "at.line").join(F.broadcast(templates), "bigram")
    hits = hits.join(lines.filter("whole").select("row", "license"), ["row", "license"], "left_anti")
    hits = hits.join(lines.filter("not whole").select("row", "license", F.col("unit").alias("line")), ["row", "license", "line"], "left_anti")
    key = ["doc_id", "row", "license", "template", "size", "length"]
    held = hits.groupBy(*key).agg(F.collect_list(F.struct("pos", F.xxhash64("bigram").alias("b"))).alias("h"))
    # a match shares so many bigrams of the template
    held = held.filter(F.expr("size(array_distinct(transform(h, x -> x.b)))") >= F.col("size") * (threshold / (2 - threshold)))
    one = held.select(*key, F.explode("h").alias("h")).select(*key, "h.pos", "h.b")
    one = one.withColumn("prev", F.lag("pos", 1, -1).over(Window.partitionBy("row", "template", "b").orderBy("pos")))
    one = one.withColumn("run", F.col("pos") - F.row_number().over(Window.partitionBy("row", "template").orderBy("pos")))
    one = one.withColumn("run", F.min("pos").over(Window.partitionBy("row", "template", "run")))
    found = one.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("pos", "prev", "run"))).alias("h"))
    # To begin earlier in a run of hits lowers no coefficient, so passages begin
    # where a run does, and every quarter of the template in long runs
    found = found.withColumn("most", F.expr(f"cast(floor(length * {(2 - threshold) / threshold!r}) as int)"))
    found = found.withColumn("starts", F.expr("filter(transform(h, (x, i) -> struct(x.pos AS a, x.run AS run, i AS i)), x -> (x.a - x.run) % greatest(1, length div 4) = 0)"))
    new = "if(x.prev < p.a, 1, 0)"
    dice = f"2.0D * (s.k + {new}) / (s.k + {new} + x.pos - p.a + 1 - (s.hits + 1) + size)"
    better = f"x.pos - p.a < most AND {dice} > s.d"
    found = found.withColumn("p", F.expr(
        f"transform(starts, p -> aggregate(slice(h, p.i + 1, most), struct(p.a AS a, p.a AS e, 0.0D AS d, 0 AS k, 0 AS hits), "
        f"(s, x) -> struct(s.a AS a, if({better}, x.pos, s.e) AS e, if({better}, {dice}, s.d) AS d, s.k + {new} AS k, s.hits + 1 AS hits)))"))
    found = found.select("doc_id", "row", "license", F.explode("p").alias("p")).filter(F.col("p.d") >= threshold)
    per_row = found.groupBy("doc_id", "row", "license").agg(F.sort_array(F.collect_list(F.struct("p.a", "p.e", "p.d"))).alias("p"))
    taken = "x.a > s.e + 1 OR x.d > s.d OR (x.d = s.d AND x.e > s.e)"
    swept = F.expr("aggregate(p, struct(0L AS n, -2 AS e, 0.0D AS d, 0.0D AS dice), (s, x) -> struct("
                   f"if(x.a > s.e + 1, s.n + 1, s.n) AS n, if({taken}, x.e, s.e) AS e, if({taken}, x.d, s.d) AS d, greatest(s.dice, x.d) AS dice))")
    return per_row.select("doc_id", "license", swept.alias("s")).select("doc_id", "license", "s.n", "s.dice")


def scan(docs: DataFrame, threshold: float = THRESHOLD, templates=None, full_texts=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and licence found in it: doc_id, license, n_units
    (units that match) and dice (the largest coefficient)."""
    spark = docs.sparkSession
    prepare(spark)
    if full_texts is None:
        full_texts = {} if templates else FULL_TEXTS
    templates = templates or TEMPLATES
    # bounded: the templates
    notices = template_bigrams(spark, templates)
    both = {name: (*templates.get(name, ()), *((full_texts[name],) if name in full_texts else ())) for name in {**templates, **full_texts}}
    everything = template_bigrams(spark, both)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    texts = written(texts.filter(may_match(everything.collect(), threshold, F.col("text"))), "licence-texts")
    lines = written(_line_matches(texts, notices.collect(), notices, threshold), "licence-lines")
    units = lines.select("doc_id", "license", F.lit(1).cast("long").alias("n"), "dice").unionByName(_passages(texts, lines, everything, threshold))
    return units.groupBy("doc_id", "license").agg(F.sum("n").alias("n_units"), F.max("dice").alias("dice"))


def oracle_sql(threshold: float = THRESHOLD, templates=None) -> str:
    """The same in DuckDB SQL."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ", ".join(f"({quote(name)}, {quote(f'{name}#{n}')}, {quote(text)})" for name, texts in (templates or TEMPLATES).items() for n, text in enumerate(texts))
    words = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
    return f"""
WITH t AS (SELECT license, template, {words} AS w FROM (VALUES {rows}) AS v(license, template, text)),
tb AS (SELECT license, template, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM t),
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, unnest(CASE WHEN contains(text, chr(10)) THEN list_append(string_split(text, chr(10)), text) ELSE [text] END) AS text FROM d),
lw AS (SELECT row_number() OVER () AS unit, doc_id, {words} AS w FROM l),
u AS (SELECT unit, doc_id, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM lw WHERE len(w) > 1),
ub AS (SELECT unit, doc_id, len(b) AS n, unnest(b) AS bigram FROM u),
tt AS (SELECT license, template, len(b) AS size, unnest(b) AS bigram FROM tb),
s AS (SELECT unit, doc_id, license, template, 2.0::DOUBLE * count(*) / (n + size) AS dice FROM ub JOIN tt USING (bigram) GROUP BY unit, doc_id, license, template, n, size),
m AS (SELECT unit, doc_id, license, max(dice) AS dice FROM s WHERE dice >= {threshold} GROUP BY 1, 2, 3)
SELECT doc_id, license, count(*) AS n_units, max(dice) AS dice FROM m GROUP BY 1, 2
"""

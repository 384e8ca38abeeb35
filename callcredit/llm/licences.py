"""Licence scan: word-bigram Dice coefficients against licence templates.

A unit is one line of a text, the whole text if it has several lines, or a run
of consecutive words, also over line ends. Units and templates are lower-cased,
and all but letters and digits becomes one space. A unit with a bigrams and a
template with b, counted with repeats, share c bigrams, each as often as the
side with fewer has it; the template matches when 200 * c >= percent * (a + b).
Since c <= min(a, b), a template can only match units with b * t / (2 - t) to
b * (2 - t) / t bigrams (t = percent / 100), and at least a * t / (2 - t) of a
unit's bigrams must be the template's.

Lines and whole texts are compared with the notices (``templates``), each with
its best one. Words are counted first; only units within some template's bounds
are normalised, and only those with enough bigrams of any template are compared,
with the templates within whose bounds they are.

Runs are compared with the notices and the full licence texts (``full_texts``).
For a template, the bigrams of the text that it knows are found. Weighing those
200 - percent and the others -percent, a run that matches weighs percent * b or
more, as c is at most its known bigrams; the heaviest run, found in one pass,
tells whether any can match. If so, the best run from each start is found: a
known bigram counts in a run while the one as many occurrences earlier as the
template has of it lies before the start, so one pass gives c for every end.
Starts are left out only where one more word before always raises the
coefficient: the bigram before is known and still counts up to the size bound.
So the best run of all is always found.

Matches that overlap: one that shares fewer bigrams goes, a run also goes for a
line or whole text that shares as many, and of runs that share as many the one
with the higher coefficient stays, then the template listed first.

Rows are independent: no shuffle, and templates are literals whose number the
caller sets. Defined results: null, empty and wordless texts match nothing; of
equal coefficients the template listed first is the best; repeated rows give
equal results; other columns of the input are not carried.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callcredit.llm.storage import documents

PERCENT = 80

# Notices by which texts state their licence, and opening
# passages of the licences themselves.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
)

# Whole licences, as their publishers give them, without copyright lines where
# these are filled in by the user.
FULL_TEXTS = tuple((f.stem, f.read_text()) for f in sorted((Path(__file__).parent / "licence_texts").glob("*.txt")))

WORD = r"[\p{L}\p{N}]+"
GAP = r"[^\p{L}\p{N}]+"


def _bigrams(text: str) -> list[str]:
    words = re.findall(r"[^\W_]+", text.lower())
    return [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def size_bounds(n: int, percent: int) -> tuple[int, int]:
    """Bigram counts of units that can match a template of ``n`` bigrams."""
    return math.ceil(n * percent / (200 - percent)), n * (200 - percent) // percent


def _template_array(templates, percent: int) -> Column:
    cells = []
    for i, (_, text) in enumerate(templates):
        grams = _bigrams(text)
        low, high = size_bounds(len(grams), percent)
        cells.append(F.struct(
            F.lit(i).alias("i"), F.lit(len(grams)).alias("b"), F.lit(low).alias("low"), F.lit(high).alias("high"),
            F.array(*[F.struct(F.lit(g).alias("g"), F.lit(k).alias("k")) for g, k in sorted(Counter(grams).items())]).alias("grams")))
    return F.array(*cells)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _among(column: str, grams) -> Column:
    """The elements of ``column`` with one of ``grams``; as SQL text, as a call
    for each of thousands of literals takes minutes."""
    return F.expr(f"filter({column}, x -> x.g IN ({', '.join(map(_quoted, grams))}))")


def _runs(known: str, i: int, text: str, percent: int) -> Column:
    """The best matching run from each start that can be best, by ``known``
    bigrams (i, g) in order; null where the bounds allow none."""
    grams = Counter(_bigrams(text))
    b = grams.total()
    high = size_bounds(b, percent)[1]
    least = math.ceil(b * percent / (200 - percent))
    repeated = ",".join(f"{g}:{k}" for g, k in grams.items() if k > 1)

    def heaviest(own: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            weight = F.greatest(acc["weight"] - (x["i"] - acc["i"] - 1) * percent, F.lit(0)) + (200 - percent)
            return F.struct(x["i"].alias("i"), weight.alias("weight"), F.greatest(acc["most"], weight).alias("most"))
        return F.aggregate(own, F.struct(F.lit(0).alias("i"), F.lit(0).alias("weight"), F.lit(0).alias("most")), step, lambda acc: acc["most"])

    def linked(by_gram: Column) -> Column:
        """(i, before, after): where the bigram stands as often earlier and later as the template has it."""
        def link(x: Column, n: Column) -> Column:
            k = F.coalesce(F.try_element_at(F.str_to_map(F.lit(repeated)), x["g"]).cast("int"), F.lit(1)) if repeated else F.lit(1)
            at = lambda m: F.when(F.get(by_gram, m)["g"] == x["g"], F.get(by_gram, m)["i"])
            return F.struct(x["i"].alias("i"), at(n - k).alias("before"), at(n + k).alias("after"))
        return F.array_sort(F.transform(by_gram, link))

    def start(x: Column, n: Column, links: Column) -> Column:
        previous = F.get(links, n - 1)
        adjacent = F.coalesce(previous["i"] == x["i"] - 1, F.lit(False))
        return F.struct(x["i"].alias("i"), n.alias("n"), (~adjacent | F.coalesce(previous["after"] < x["i"] + high, F.lit(False))).alias("open"))

    def best(s: Column, links: Column) -> Column:
        counted = F.filter(F.slice(links, s["n"] + 1, high), lambda x: (x["i"] < s["i"] + high) & (x["before"].isNull() | (x["before"] < s["i"])))

        def run(x: Column, n: Column) -> Column:
            return F.struct(((n + 1) * 2 / (x["i"] - s["i"] + 1 + b)).alias("dice"), (-x["i"]).alias("end"), (n + 1).alias("shared"))
        return _let(F.array_max(F.transform(counted, run)), lambda r: F.struct(
            r["dice"].alias("dice"), F.lit(-i).alias("order"), r["shared"].alias("shared"), s["i"].alias("at"), (1 - r["end"]).alias("end"),
            (r["shared"] * 200 >= (1 - r["end"] - s["i"] + b) * percent).alias("hit")))

    def all_best(links: Column) -> Column:
        starts = F.filter(F.transform(links, lambda x, n: start(x, n, links)), lambda x: x["open"])
        return F.filter(F.transform(starts, lambda x: best(x, links)), lambda r: r["hit"])

    def found(own: Column) -> Column:
        by_gram = F.array_sort(F.transform(own, lambda x: F.struct(x["g"].alias("g"), x["i"].alias("i"))))
        return F.when((F.size(own) >= least) & (heaviest(own) >= percent * b), _let(by_gram, lambda y: _let(linked(y), all_best)))

    return _let(_among(known, sorted(grams)), found)


def scan_licences(docs: DataFrame, templates=TEMPLATES, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text",
                  full_texts=FULL_TEXTS) -> DataFrame:
    """(doc_id, n_matches, licence, dice, licences): matching units, the best
    match, and all licences found, by name, joined by commas."""
    known = _template_array(templates, percent)
    every = (*templates, *full_texts)
    names = F.array(*[F.lit(n) for n, _ in every])
    vocabulary = sorted({g for _, t in templates for g in _bigrams(t)})
    all_grams = sorted({g for _, t in every for g in _bigrams(t)})
    ranges = sorted({size_bounds(len(_bigrams(t)), percent) for _, t in templates})

    def comparable(u: Column) -> Column:
        wanted = F.lit(False)
        for low, high in ranges:
            wanted = wanted | (u["n"] - 1).between(low, high)
        return wanted

    def words(text: Column) -> Column:
        return F.filter(F.split(F.regexp_replace(F.lower(text), GAP, " "), " "), lambda w: w != "")

    def unit_grams(u: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(u["w"]) - 1), lambda i: F.concat_ws(" ", F.element_at(u["w"], i), F.element_at(u["w"], i + 1)))

    def known_enough(u: Column) -> Column:
        return F.size(F.filter(u["grams"], lambda g: g.isin(vocabulary))) * (200 - percent) >= u["a"] * percent

    def match(u: Column, t: Column) -> Column:
        shared = F.aggregate(
            t["grams"], F.lit(0), lambda total, g: total + F.least(g["k"], F.size(F.filter(u["grams"], lambda x: x == g["g"]))))
        return F.struct((shared * 2 / (u["a"] + t["b"])).alias("dice"), (-t["i"]).alias("order"), shared.alias("shared"), u["line"].alias("line"),
                        (shared * 200 >= (u["a"] + t["b"]) * percent).alias("hit"))

    def matches(u: Column) -> Column:
        near = F.filter(known, lambda t: u["a"].between(t["low"], t["high"]))
        return F.array_max(F.filter(F.transform(near, lambda t: match(u, t)), lambda m: m["hit"]))

    def placed(m: Column) -> Column:
        """A match of a line or, as line -1, of the whole text, with its words."""
        lines = F.col("_line_of")
        first = F.when(m["line"] < 0, 1).otherwise(F.array_position(lines, m["line"]).cast("int"))
        size = F.size(F.filter(lines, lambda x: (m["line"] < 0) | (x == m["line"])))
        return F.struct((-m["shared"]).alias("fewer"), F.lit(0).alias("run"), (-m["dice"]).alias("worse"), (-m["order"]).alias("i"),
                        first.alias("at"), (first + size - 1).alias("end"))

    def of_run(m: Column) -> Column:
        return F.struct((-m["shared"]).alias("fewer"), F.lit(1).alias("run"), (-m["dice"]).alias("worse"), (-m["order"]).alias("i"),
                        m["at"].alias("at"), m["end"].alias("end"))

    def kept(ordered: Column) -> Column:
        def rival(x: Column, k: Column) -> Column:
            return (k["at"] <= x["end"]) & (x["at"] <= k["end"]) & ((x["run"] == 1) | (k["fewer"] < x["fewer"]))
        return F.aggregate(ordered, F.slice(ordered, 1, 0), lambda some, x: F.when(
            F.exists(some, lambda k: rival(x, k)), some).otherwise(F.concat(some, F.array(x))))

    least = min(size_bounds(len(_bigrams(t)), percent)[0] for _, t in every)
    found = (
        docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
        .withColumn("_split", F.split("_text", "\n"))
        .withColumn("_lines", F.transform("_split", lambda x, i: F.struct(x.alias("text"), F.regexp_count(x, F.lit(WORD)).alias("n"), i.alias("line"))))
        .withColumn("_whole", F.when(F.size("_lines") > 1, F.array(F.struct(
            F.col("_text").alias("text"), F.aggregate("_lines", F.lit(0), lambda n, x: n + x["n"]).alias("n"), F.lit(-1).alias("line")))))
        .withColumn("_units", F.filter(F.concat("_lines", F.coalesce("_whole", F.slice("_lines", 1, 0))), comparable))
        .withColumn("_units", F.transform("_units", lambda u: F.struct(words(u["text"]).alias("w"), u["line"].alias("line"))))
        .withColumn("_units", F.transform("_units", lambda u: F.struct(unit_grams(u).alias("grams"), u["line"].alias("line"))))
        .withColumn("_units", F.filter(F.transform("_units", lambda u: F.struct(
            u["grams"].alias("grams"), F.size(u["grams"]).alias("a"), u["line"].alias("line"))), known_enough))
        .withColumn("_of_units", F.filter(F.transform("_units", matches), lambda m: m.isNotNull()))
        .withColumn("_words", words(F.col("_text")))
        .withColumn("_grams", F.transform("_words", lambda w, i: F.struct((i + 1).alias("i"), F.concat_ws(" ", w, F.get("_words", i + 1)).alias("g"))))
        .withColumn("_known", _among("_grams", all_grams))
        .withColumn("_of_runs", F.when(F.size("_known") >= least, F.flatten(F.filter(
            F.array(*[_runs("_known", i, t, percent) for i, (_, t) in enumerate(every)]), lambda r: r.isNotNull()))))
        .withColumn("_of_runs", F.transform("_of_runs", of_run))
        .withColumn("_line_of", F.when(F.size("_of_units") > 0, F.flatten(F.transform(
            "_split", lambda x, i: F.array_repeat(i, F.size(words(x)))))))
        .withColumn("_of_units", F.transform("_of_units", placed))
        .withColumn("_all", F.array_sort(F.concat("_of_units", F.coalesce("_of_runs", F.slice("_of_units", 1, 0)))))
        .withColumn("_hits", F.transform(kept(F.col("_all")), lambda m: F.struct((-m["worse"]).alias("dice"), (-m["i"]).alias("order"))))
        .withColumn("_best", F.array_max("_hits")))
    name = lambda m: F.element_at(names, 1 - m["order"])
    return found.select(
        "doc_id", F.size("_hits").cast("long").alias("n_matches"),
        F.when(F.size("_hits") > 0, name(F.col("_best"))).alias("licence"),
        F.coalesce(F.col("_best.dice"), F.lit(0.0)).alias("dice"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("_hits", name))), ",").alias("licences"))


def op6_licence_scan(spark, sf_dir: str) -> DataFrame:
    return scan_licences(documents(spark, sf_dir))


QUERIES = {"op6_licence_scan": op6_licence_scan}


# Compares every line and whole text with every notice, one row a pair. Of runs
# it knows nothing; the tests compare them with every run by brute force.
ORACLE_SQL = {"op6_licence_scan": f"""
WITH template(i, name, body) AS (VALUES {', '.join(f'({i}, {_quoted(n)}, {_quoted(t)})' for i, (n, t) in enumerate(TEMPLATES))}),
doc AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM documents),
unit AS (
    SELECT rid, unnest(range(len(l))) AS u, unnest(l) AS body
    FROM (SELECT rid, string_split(body, chr(10)) || CASE WHEN contains(body, chr(10)) THEN [body] ELSE [] END AS l FROM doc)),
words AS (
    SELECT kind, id, u, list_filter(string_split(regexp_replace(lower(body), '{GAP}', ' ', 'g'), ' '), lambda w: w <> '') AS w
    FROM (SELECT 'u' AS kind, rid AS id, u, body FROM unit UNION ALL SELECT 't', i, 0, body FROM template)),
gram AS (
    SELECT kind, id, u, len(w) - 1 AS n, unnest(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS g
    FROM words WHERE len(w) BETWEEN 2 AND 1000),
counted AS (SELECT kind, id, u, n, g, count(*) AS k FROM gram GROUP BY ALL),
pair AS (
    SELECT a.id AS rid, a.u, b.id AS i, any_value(a.n) AS na, any_value(b.n) AS nb, sum(least(a.k, b.k)) AS shared
    FROM counted a JOIN counted b ON a.g = b.g AND a.kind = 'u' AND b.kind = 't' GROUP BY a.id, a.u, b.id),
best_of_unit AS (
    SELECT rid, u, arg_max(i, (shared * 2 / (na + nb), -i)) AS i, max(shared * 2 / (na + nb)) AS dice
    FROM pair WHERE shared * 200 >= (na + nb) * {PERCENT} GROUP BY rid, u),
best AS (
    SELECT rid, count(*) AS n_matches, arg_max(i, (dice, -i)) AS i, max(dice) AS dice,
           array_to_string(list_sort(list(DISTINCT name)), ',') AS licences
    FROM best_of_unit JOIN template USING (i) GROUP BY rid)
SELECT doc_id, coalesce(n_matches, 0)::BIGINT AS n_matches, name AS licence, coalesce(dice, 0)::DOUBLE AS dice,
       coalesce(licences, '') AS licences
FROM doc LEFT JOIN best USING (rid) LEFT JOIN template ON template.i = best.i
"""}

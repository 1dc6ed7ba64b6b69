"""License scans: blocks of text compared to licence templates by the Dice coefficient over their sets of word bigrams.

A unit is a line, or a paragraph of more than one line, of the normalised text (lower case; runs of anything but
letters, digits and line ends become one space). Where no unit matches a licence, runs of lines are units too, so that a
notice is found wherever it starts and however it is wrapped. A unit of ``a`` bigrams can reach a coefficient ``s`` with a
template of ``b`` only if ``b * s / (2 - s) <= a <= b * (2 - s) / s``, and only if it holds ``b * s / (2 - s)`` of the
template's bigrams: documents that hold fewer of every template's bigrams, and units outside the bounds of every template,
are dropped before anything is exploded, and pairs outside before they are counted. Bigrams meet the templates by an
equi-join with a table that is part of this file, and so of fixed size. No text is shuffled.

Edge cases: null or empty text and units of one word have no bigrams and match nothing; repeated rows are scanned
one by one and their matches add up; ties between templates of one licence count once for each unit; an empty table
gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

#: Public licence notices, by SPDX id; a licence with several paragraphs has several templates.
TEMPLATES = [
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MIT", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-2-Clause", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def bigrams(text: str) -> set[str]:
    """The set of word bigrams of a template."""
    words = re.sub(r"[\W_]+", " ", text.lower()).split()
    return {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}


def bounds(size: int, threshold: float) -> tuple[float, float]:
    """Least and most bigrams of a unit that can match a template of ``size`` bigrams."""
    return size * threshold / (2 - threshold), size * (2 - threshold) / threshold


def _grams(words: Column) -> Column:
    pairs = F.greatest(F.lit(0), F.size(words) - 1)
    return F.array_distinct(F.zip_with(F.slice(words, F.lit(1), pairs), F.slice(words, F.lit(2), pairs), lambda a, b: F.concat_ws(" ", a, b)))


def possible(text: Column, sets: list[set[str]], threshold: float) -> Column:
    """Whether a text holds so much of a template's bigrams that a part of it may match."""
    need = lambda g: math.ceil(bounds(len(g), threshold)[0] - 1e-9)
    words = F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")
    known = F.array_intersect(_grams(words), F.array(*map(F.lit, sorted(set().union(*sets)))))
    # most texts hold hardly any: the templates are looked at one by one for the rest alone
    holds = lambda k: reduce(lambda x, y: x | y, (F.size(F.array_intersect(k, F.array(*map(F.lit, sorted(g))))) >= need(g) for g in sets))
    return F.exists(F.filter(F.array(known), lambda k: F.size(k) >= min(map(need, sets))), holds)


def units(docs: DataFrame, most_words: int) -> DataFrame:
    """(doc_id, row, unit, run, words) of every line, every paragraph of more than one line, and every run of two or more
    lines of up to ``most_words`` words that begins and ends with a word."""
    clean = F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}\n]+", " ")
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), clean.alias("_text"))
    words = lambda p: F.filter(F.split(p, " "), lambda w: w != "")
    blocks = F.filter(F.split("_text", r"\n *\n[ \n]*"), lambda b: F.contains(F.trim(b), F.lit("\n")))
    lines = F.transform(F.split("_text", "\n"), words)
    rows = rows.select("doc_id", "row", lines.alias("lines"), F.transform(blocks, lambda b: words(F.replace(b, F.lit("\n"), F.lit(" ")))).alias("blocks"))
    plain = rows.select("doc_id", "row", F.posexplode(F.concat("lines", "blocks")).alias("unit", "words")).withColumn("run", F.lit(False))
    # blank lines part nothing here: runs are of the lines with words
    full = rows.select("doc_id", "row", F.filter("lines", lambda w: F.size(w) > 0).alias("lines")).filter(F.size("lines") > 1)
    sizes = F.aggregate("lines", F.array(F.lit(0)), lambda s, w: F.concat(s, F.array(F.element_at(s, -1) + F.size(w))))
    starts = full.select("doc_id", "row", "lines", sizes.alias("to")).select("*", F.explode(F.sequence(F.lit(0), F.size("lines") - 2)).alias("at"))
    last = F.least(F.size("lines"), F.col("at") + most_words)
    ends = F.filter(F.sequence(F.col("at") + 2, F.greatest(last, F.col("at") + 2)), lambda e: F.get("to", e) - F.get("to", F.col("at")) <= most_words)
    runs = starts.select("doc_id", "row", "lines", "at", F.explode(ends).alias("end"))
    runs = runs.select("doc_id", "row", F.xxhash64("at", "end").alias("unit"), F.flatten(F.slice("lines", F.col("at") + 1, F.col("end") - F.col("at"))).alias("words"), F.lit(True).alias("run"))
    return plain.select("doc_id", "row", F.col("unit").cast("long").alias("unit"), "run", "words").unionByName(runs)


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, row, unit, run, license, template, dice) of every unit that reaches the threshold with a template; ``run``
    tells those that are runs of lines only."""
    sets = [bigrams(text) for _, text in templates]
    rows = [(b, t, templates[t][0], len(grams)) for t, grams in enumerate(sets) for b in sorted(grams)]
    if not rows:
        raise ValueError("no template has two words")
    # an inline table stays inside the JVM; bigrams hold letters, digits and spaces only
    values = ", ".join(f"('{b}', {t}, '{name}', {n})" for b, t, name, n in rows)
    table = docs.sparkSession.sql(f"SELECT * FROM VALUES {values} AS v(bigram, template, license, template_size)")
    sizes = sorted({r[3] for r in rows})
    fits = F.lit(False)
    for low, high in (bounds(s, threshold) for s in sizes):
        fits |= F.col("size").between(low, high)
    n = F.size("words")
    near = docs.select("doc_id", "text").filter(possible(F.col("text"), [g for g in sets if g], threshold))
    # a run of more words than this has too many bigrams, unless words repeat: then a shorter run of them matches better
    most_words = math.floor(bounds(sizes[-1], threshold)[1]) + 1
    # the number of words bounds the number of bigrams from above: a cheap test before the set is built
    short = units(near, most_words).filter((n >= 2) & (n - 1 >= bounds(sizes[0], threshold)[0]))
    keys = ["doc_id", "row", "unit", "run", "size"]
    sized = short.select(*keys[:-1], _grams(F.col("words")).alias("grams")).withColumn("size", F.size("grams")).filter(fits)
    met = sized.select(*keys, F.explode("grams").alias("bigram")).join(F.broadcast(table), "bigram")
    low, high = bounds(1, threshold)
    near = met.filter(F.col("size").between(F.col("template_size") * low, F.col("template_size") * high))
    counted = near.groupBy(*keys, "license", "template", "template_size").agg(F.count("*").alias("common"))
    dice = 2.0 * F.col("common") / (F.col("size") + F.col("template_size"))
    return counted.withColumn("dice", dice).filter(F.col("dice") >= threshold).select("doc_id", "row", "unit", "run", "license", "template", "dice")


def document_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license, n_units (lines and paragraphs that match it, or 1 of a row in which only runs of lines do), dice
    (the best of those): one row for each licence found in a document."""
    best = scan(docs, templates, threshold).groupBy("doc_id", "row", "unit", "run", "license").agg(F.max("dice").alias("dice"))
    found = best.groupBy("doc_id", "row", "license").agg(F.count_if(~F.col("run")).alias("n"), F.max(F.when(~F.col("run"), F.col("dice"))).alias("own"), F.max("dice").alias("any"))
    found = found.select("doc_id", "license", F.greatest("n", F.lit(1)).alias("n"), F.coalesce("own", "any").alias("dice"))
    return found.groupBy("doc_id", "license").agg(F.sum("n").alias("n_units"), F.round(F.max("dice"), 6).alias("dice"))


def oracle_sql(templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    values = ", ".join(f"({t}, '{name}', '{text.replace(chr(39), chr(39) * 2)}')" for t, (name, text) in enumerate(templates))
    return rf"""
WITH templates(template, license, text) AS (VALUES {values}),
template_sets AS (
  SELECT template, license, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS grams
  FROM (SELECT *, string_split(trim(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS w FROM templates)
), clean AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_replace(lower(text), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') AS t FROM documents WHERE text IS NOT NULL
), parts AS (
  SELECT doc_id, r, 'l' AS kind, generate_subscripts(string_split(t, chr(10)), 1) AS i, unnest(string_split(t, chr(10))) AS p FROM clean
  UNION ALL
  SELECT doc_id, r, 'b', i, replace(p, chr(10), ' ') FROM (
    SELECT doc_id, r, generate_subscripts(regexp_split_to_array(t, '\n *\n[ \n]*'), 1) AS i, unnest(regexp_split_to_array(t, '\n *\n[ \n]*')) AS p FROM clean
  ) WHERE contains(trim(p, ' '), chr(10))
), unit_sets AS (
  SELECT doc_id, r, kind, i, list_distinct(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS grams
  FROM (SELECT *, list_filter(string_split(p, ' '), lambda x: x <> '') AS w FROM parts) WHERE len(w) >= 2
), found AS (
  SELECT doc_id, r, kind, i, license, max(2.0::DOUBLE * len(list_intersect(u.grams, t.grams)) / (len(u.grams) + len(t.grams))) AS dice
  FROM unit_sets u JOIN template_sets t ON 2.0 * least(len(u.grams), len(t.grams)) >= {threshold} * (len(u.grams) + len(t.grams)) - 1e-9
  GROUP BY ALL HAVING dice >= {threshold}::DOUBLE
), doc_sets AS (
  SELECT doc_id, r, list_distinct(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS grams
  FROM (SELECT doc_id, r, list_filter(string_split(replace(t, chr(10), ' '), ' '), lambda x: x <> '') AS w FROM clean) WHERE len(w) >= 2
), may AS (
  SELECT DISTINCT doc_id, r FROM doc_sets d, template_sets t WHERE len(list_intersect(d.grams, t.grams)) >= len(t.grams) * {threshold} / (2 - {threshold}) - 1e-9
), full_lines AS (
  SELECT doc_id, r, row_number() OVER (PARTITION BY r ORDER BY i) AS i, list_filter(string_split(p, ' '), lambda x: x <> '') AS w
  FROM parts JOIN may USING (doc_id, r) WHERE kind = 'l' AND len(list_filter(string_split(p, ' '), lambda x: x <> '')) > 0
), summed AS (SELECT *, sum(len(w)) OVER (PARTITION BY r ORDER BY i) AS upto FROM full_lines
), runs AS (
  SELECT a.doc_id, a.r, a.i, b.i AS j, flatten(list(c.w ORDER BY c.i)) AS w FROM summed a
  JOIN summed b ON a.r = b.r AND b.i > a.i AND b.upto - a.upto + len(a.w) <= {math.floor(bounds(max(len(bigrams(t)) for _, t in templates), threshold)[1]) + 1}
  JOIN summed c ON c.r = a.r AND c.i BETWEEN a.i AND b.i GROUP BY ALL
), run_sets AS (SELECT doc_id, r, i, j, list_distinct(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS grams FROM runs
), run_found AS (
  SELECT doc_id, r, license, max(2.0::DOUBLE * len(list_intersect(u.grams, t.grams)) / (len(u.grams) + len(t.grams))) AS dice
  FROM run_sets u JOIN template_sets t ON 2.0 * least(len(u.grams), len(t.grams)) >= {threshold} * (len(u.grams) + len(t.grams)) - 1e-9
  GROUP BY ALL HAVING dice >= {threshold}::DOUBLE
), both_ AS (
  SELECT doc_id, license, dice FROM found UNION ALL
  SELECT doc_id, license, dice FROM run_found x WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.r = x.r AND f.license = x.license)
)
SELECT doc_id, license, count(*) AS n_units, round(max(dice), 6) AS dice FROM both_ GROUP BY ALL
"""

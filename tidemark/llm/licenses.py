"""Licence scan. DataFrame and SQL functions only.

Normalised text is compared with licence templates by the Dice coefficient over word bigrams. Units of text are
the lines, the paragraphs of several lines, and the whole document. A template is a candidate for a
unit only where their sizes allow the similarity; units that no template's size allows are never split
into bigrams.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.let import let
from tidemark.llm.common import lower_ascii, wrapped

LEAST = 0.8

# Licence notices and short licence texts.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
        the specific language governing permissions and limitations under the License."""],
    "MIT": [
        "Released under the MIT License.", "Licensed under the MIT License.",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of
        the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
        NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
        EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN
        ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
        OTHER DEALINGS IN THE SOFTWARE."""],
    "ISC": [
        "Licensed under the ISC License.",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
        ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
        DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
        WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
        USE OR PERFORMANCE OF THIS SOFTWARE."""],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.",
                     "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
        any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
        without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General
        Public License for more details."""],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option)
        any later version."""],
    "LGPL-2.1": ["This work is licensed under the GNU Lesser General Public License, version 2.1."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights "
                "to this work."],
    "Unlicense": [
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means."""],
    "Proprietary": ["All rights reserved."],
}


def words_of(text: Column) -> Column:
    """Normalised words: A-Z in lower case, letters, digits and the dots inside numbers; all else separates."""
    plain = F.regexp_replace(lower_ascii(text), r"[^\p{L}\p{N}.]+|\.(?![0-9])", " ")
    return F.filter(F.split(plain, " +"), lambda w: w != "")


def bigrams_of(text: Column) -> Column:
    """Distinct pairs of neighbouring words; a single word is paired with nothing. The words are bound once."""
    def pairs(words: Column) -> Column:
        n = F.greatest(F.size(words) - 1, F.lit(0))
        both = F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))
        return F.when(F.size(words) == 1, words).otherwise(F.array_distinct(both))

    return let(words_of(text), pairs)


def cue_words(grams: list[list[str]], least: float) -> list[str]:
    """Words of which every text that matches a template holds at least one, at the beginning of a word.

    A match shares at least least / (2 - least) of the template's bigrams. For each template words are chosen, long and widely
    used ones first, until the bigrams without them are fewer than that.
    """
    chosen: list[str] = []
    ratio = least / (2.0 - least) * (1 - 1e-9)  # a size at the bound stays

    def holds(gram: str, cue: str) -> bool:
        return f" {gram}".find(f" {cue}") >= 0

    for own in sorted(grams, key=len):
        left = [g for g in own if not any(holds(g, c) for c in chosen)]
        while len(left) >= math.ceil(ratio * len(own) - 1e-9):
            words = sorted({w for g in left for w in g.split(" ")})
            chosen.append(max(words, key=lambda w: (len(w) > 6, len(w) > 4, sum(holds(g, w) for g in left), -len(w), w)))
            left = [g for g in left if not holds(g, chosen[-1])]
    return chosen


def has_any(text: Column, words: list[str]) -> Column:
    """Plain searches: several times faster than one pattern of all words."""
    return let(lower_ascii(text), lambda t: reduce(or_, [t.contains(w) for w in words]))


def templates(spark: SparkSession, texts: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """template (number), license, grams (bigrams), size. One row per notice: as many as the library knows."""
    rows = [(i, name, text) for i, (name, text) in enumerate((n, t) for n, all_ in texts.items() for t in all_)]
    known = spark.createDataFrame(rows, "template int, license string, text string")
    return known.select("template", "license", bigrams_of(F.col("text")).alias("grams")).withColumn(
        "size", F.size("grams"))


def units(docs: DataFrame) -> DataFrame:
    """The rows' units: row (the document's columns), unit (line, paragraph, text), place (from 0), text."""
    none = F.array().cast("array<string>")

    def marked(name: str, values: Column) -> Column:
        return F.transform(values, lambda t, i: F.struct(F.lit(name).alias("unit"), i.cast("long").alias("place"), t.alias("text")))

    def cut(text: Column) -> Column:
        blocks = F.when(text.rlike("\n[ \t]*\n"), F.filter(F.split(text, "\n[ \t]*\n"), lambda b: b.contains("\n"))).otherwise(none)
        return let(F.split(text, "\n"), lambda lines: F.concat(
            marked("line", lines), marked("paragraph", blocks),
            marked("text", F.when(F.size(lines) > 1, F.array(text)).otherwise(none))))

    given = F.coalesce("text", F.lit(""))
    text = F.when(given.contains("\r"), F.regexp_replace(given, "\r\n?", "\n")).otherwise(given)
    return docs.select("row", F.inline(let(text, cut)))


def scan(docs: DataFrame, least: float = LEAST, texts: dict[str, list[str]] = TEMPLATES, columns: tuple[str, ...] = ("doc_id",)
         ) -> DataFrame:
    """One row per unit and licence with a Dice coefficient of at least ``least``: the columns, unit, place, license,
    template (the licence's best), score.

    Size bounds: two sets reach a Dice coefficient d only if the smaller has at least d / (2 - d) times the larger's size.
    Before a unit is split into words its characters are bounded from below: at least two for each word. Bigrams are
    distinct, so a very long unit that repeats a licence or pads it matches like the licence itself. The sizes also say how many
    bigrams a match shares at least, so texts without any of a few words (see :func:`cue_words`) are left out first. Null and empty texts have no unit that matches. Repeated rows give repeated matches; of templates
    of one licence with equal scores the first counts. Other columns are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    known = [(r.template, r.license, list(r.grams)) for r in templates(spark, texts).collect()]
    sizes = [len(g) for _, _, g in known]
    ratio = least / (2.0 - least) * (1 - 1e-9)  # a size at the bound stays
    cues = cue_words([g for _, _, g in known], least)
    rows = units(docs.where(has_any(F.col("text"), cues)).select(wrapped(docs, columns), "text"))
    plausible = rows.where(F.length("text") >= int(2 * ratio * min(sizes) - 1)).where(has_any(F.col("text"), cues))
    grams = plausible.select("row", "unit", "place", F.monotonically_increasing_id().alias("id"),
                             bigrams_of(F.col("text")).alias("grams"))
    # The generator comes first, so that the bigrams are made once; the size is counted from its rows' array.
    sized = grams.select("row", "unit", "place", "id", F.inline(let(F.col("grams"), lambda g: F.transform(g, lambda x: F.struct(
        F.size(g).alias("size"), x.alias("gram")))))).where(F.col("size").between(ratio * min(sizes), max(sizes) / ratio))
    # The templates' bigrams: fixed, some thousand short strings.
    table = spark.createDataFrame([(t, name, len(g), x) for t, name, g in known for x in g],
                                  "template int, license string, template_size int, gram string")
    unit = ["row", "unit", "place", "id", "size"]
    exploded = sized.select(*unit, "gram")
    size, other = F.col("size"), F.col("template_size")
    shared = exploded.join(F.broadcast(table), (exploded.gram == table.gram) & (
        F.least(size, other) >= ratio * F.greatest(size, other))).groupBy(*unit, "template", "license", "template_size").agg(
        F.count(F.lit(1)).alias("shared"))
    scored = shared.withColumn("score", F.round(2.0 * F.col("shared") / (size + other), 6)).where(F.col("score") >= least)
    return scored.groupBy(*unit[:4], "license").agg(
        F.max(F.struct("score", (-F.col("template")).alias("template"))).alias("best")).select(
        "row.*", "unit", "place", "license", (-F.col("best.template")).alias("template"), F.col("best.score").alias("score"))


def licenses_by_document(docs: DataFrame, least: float = LEAST, texts: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """One row per doc_id that has a match: doc_id, license of the best match, score, n_matches, licenses (all, sorted)."""
    return scan(docs, least, texts).groupBy("doc_id").agg(
        F.max(F.struct("score", (-F.col("template")).alias("template"), "license")).alias("best"),
        F.count(F.lit(1)).alias("n_matches"), F.array_sort(F.collect_set("license")).alias("licenses")).select(
        "doc_id", "best.license", "best.score", "n_matches", "licenses")

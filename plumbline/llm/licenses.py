"""Licence scan by a positional index of rare words.

The words of the licence templates form a small vocabulary.  One pass over all documents counts in how many each of them occurs,
which gives its inverse document frequency.  For each template a file looks up the ``RARE`` highest-IDF words of that template that it holds, so several
notices in one file do not compete; a template is left out only where the file lacks one of its mandatory words altogether.  Their postings
(template, position), shifted by the places of the words in the file, meet at one relative position where a template stands in
the file; a relative position needs ``VOTES`` of them.  Only there are the mandatory phrases of the template looked at, each at its own relative place.

Base labels are the places where a base phrase's words stand consecutively.  Both kinds are reported together.

All of it is DataFrame expressions inside the row; only the vocabulary counts are shuffled, and only they (a few hundred numbers) reach the
driver.  Words are runs of digits, ASCII letters and non-ASCII characters after lower-casing A-Z.

Null text counts as empty: no words, no labels, score 0.  Repeated rows get the same answer each.  A text of any length is scanned whole.
Ties between equally rare words take the smaller word.  An empty table gives an empty result.  Extra columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RARE = 6
VOTES = 3
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# fixed values: the phrases of the base scan and their labels
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    mandatory: tuple[str, ...]

    @property
    def words(self) -> list[str]:
        return [w for w in re.split(BREAK, self.text.lower()) if w]

    def places(self) -> list[tuple[int, list[str]]]:
        """Where each mandatory phrase stands in the template."""
        words = self.words
        out = []
        for phrase in self.mandatory:
            p = phrase.split()
            out.append((next(i for i in range(len(words)) if words[i : i + len(p)] == p), p))
        return out


# fixed values: whole texts of short licences and notices
MIT = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE.
"""
ISC = """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright
notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
"""
BSD = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
"""
APACHE = """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of
the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.
"""
GPL = """
This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software
Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS
FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
"""

# fixed values: public licences, their notices and sentences of them
TEMPLATES = (
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge",)),
    Template("apache-2", "Licensed under the Apache License, Version 2.0", ("apache license version 2",)),
    Template("gpl-3", "This work is licensed under the GNU General Public License, version 3", ("gnu general public license version 3",)),
    Template("gpl", "under the terms of the GNU General Public License as published by the Free Software Foundation", ("gnu general public license",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license",)),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4 0",)),
    Template("mit", MIT, ("permission is hereby granted free of charge", "the above copyright notice and this permission notice shall be included", "without warranty of any kind")),
    Template("isc", ISC, ("permission to use copy modify and or distribute this software", "the author disclaims all warranties")),
    Template("bsd", BSD, ("redistribution and use in source and binary forms", "this software is provided by the copyright holders and contributors as is")),
    Template("apache-2", APACHE, ("licensed under the apache license version 2 0", "limitations under the license")),
    Template("gpl-3", GPL, ("gnu general public license", "either version 3 of the license", "without any warranty")),
)


def normal(text: Column) -> Column:
    """Words joined by one space, one more in front and behind; a single space for no words."""
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(low, BREAK, " ")), F.lit(" "))


def words_of(norm: Column) -> Column:
    """Array of words of a normal form."""
    return F.filter(F.split(F.trim(norm), " "), lambda w: w != "")


def stands(words: Column, at: Column, phrase: list[str]) -> Column:
    out = (F.get(words, at) == phrase[0]) & (F.slice(words, at + 1, len(phrase)) == _strings(phrase))
    return F.coalesce(F.when(at >= 0, out), F.lit(False))


def _all_places(words: Column, phrase: list[str]) -> Column:
    """Every place of a phrase; the words are walked only where the joined text contains it."""
    some = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: stands(words, i, phrase))
    return F.when(F.contains("norm", F.lit(f" {' '.join(phrase)} ")), some).otherwise(F.array().cast("array<int>"))


def _strings(values: list[str]) -> Column:
    """Literal array of words (no word holds a quote), made in one call."""
    return F.expr("array(" + ", ".join(f"'{v}'" for v in values) + ")")


def idf(norms: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """Inverse document frequency of each licence word over all rows of column ``norm``."""
    n = norms.count()
    held = norms.select(F.explode(F.array_intersect(_strings(vocabulary), words_of(F.col("norm")))).alias("w")).groupBy("w").count().collect()
    df = {r["w"]: r["count"] for r in held}
    return {w: math.log((n + 1) / (df.get(w, 0) + 1)) for w in vocabulary}


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, base: dict[str, str] = BASE, id_col: str = "doc_id", text_col: str = "text", rare: int = RARE, need: int = VOTES) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score, found): found lists (label, place) of the templates."""
    norms = docs.select(F.col(f"`{id_col}`").alias("id"), normal(F.col(f"`{text_col}`")).alias("norm"))
    vocabulary = sorted({w for t in templates for w in t.words})
    weight = idf(norms, vocabulary)
    ranked = sorted(vocabulary, key=lambda w: (-weight[w], w))
    shift = 1 << 20  # keeps relative positions positive
    postings = {w: [t * (1 << 44) + shift - q for t, x in enumerate(templates) for q, y in enumerate(x.words) if y == w] for w in vocabulary}
    posted = F.expr("map(" + ", ".join(f"'{w}', array({', '.join(f'{p}L' for p in postings[w])})" for w in ranked) + ")")

    words = F.col("words")
    rows = norms.withColumn("words", words_of(F.col("norm")))
    places = [_all_places(words, phrase.split()) for phrase in base]
    # the rarest words of each template: the first of its ranked words that the file holds
    held = F.array_intersect(_strings(ranked), words)

    def anchors(x: Template) -> Column:
        must = _strings(sorted({w for _, phrase in x.places() for w in phrase}))
        own = F.slice(F.array_intersect(F.col("held"), _strings(x.words)), 1, rare)
        return F.when(F.size(F.array_except(must, F.col("held"))) == 0, own).otherwise(F.array().cast("array<string>"))

    picked = F.array_distinct(F.flatten(F.array(*[anchors(x) for x in templates])))
    rows = rows.select("id", "norm", "words", F.size(words).cast("long").alias("n_words"), *[c.alias(f"b{i}") for i, c in enumerate(places)], held.alias("held"))
    rows = rows.withColumn("rare", picked)
    looked = F.transform("rare", lambda w: F.element_at(posted, w))
    rows = rows.withColumn("posts", F.when(F.size("rare") >= need, looked).otherwise(F.array().cast("array<array<bigint>>")))
    marked = F.transform(words, lambda w, i: F.struct(F.array_position(F.col("rare"), w).cast("int").alias("k"), i.alias("i")))
    hits = F.when(F.size("posts") > 0, F.filter(marked, lambda x: x["k"] > 0)).otherwise(F.array().cast("array<struct<k:int,i:int>>"))
    rows = rows.withColumn("hits", hits)
    votes = F.flatten(F.transform("hits", lambda h: F.transform(F.get(F.col("posts"), h["k"] - 1), lambda p: p + h["i"])))
    rows = rows.withColumn("votes", F.array_sort(votes))
    met = F.filter(F.sequence(F.lit(need - 1), F.size("votes") - 1), lambda j: F.get(F.col("votes"), j) == F.get(F.col("votes"), j - (need - 1)))
    rows = rows.withColumn("met", F.when(F.size("votes") >= need, F.array_distinct(F.transform(met, lambda j: F.get(F.col("votes"), j)))).otherwise(F.array().cast("array<bigint>")))

    def judged(code: Column) -> Column:
        """(label, place, share of the template's words in place) of a template that stands there, else null."""
        t, at = F.floor(code / (1 << 44)), (code % (1 << 44) - shift).cast("int")
        out = F.lit(None).cast("struct<label:string,place:int,share:double>")
        for k, x in enumerate(templates):
            ok = F.lit(True)
            for q, phrase in x.places():
                ok = ok & stands(words, at + q, phrase)
            share = F.size(F.filter(F.transform(_strings(x.words), lambda w, q: F.get(words, at + q) == w), lambda same: same)) / len(x.words)
            out = F.when((t == k) & ok, F.struct(F.lit(x.label).alias("label"), at.alias("place"), share.alias("share"))).otherwise(out)
        return out

    rows = rows.withColumn("found", F.filter(F.transform("met", judged), lambda f: f.isNotNull()))
    every = F.concat(*[F.col(f"b{i}") for i in range(len(base))])
    base_set = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.when(F.size(f"b{i}") > 0, F.array(F.lit(label))).otherwise(F.array().cast("array<string>")) for i, label in enumerate(base.values())]))))
    both = F.array_sort(F.array_union(base_set, F.transform("found", lambda f: f["label"])))
    return rows.select(
        F.col("id").alias(id_col),
        "n_words",
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.array_join(base_set, ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda f: f["share"])), F.lit(0.0)).alias("score"),
        F.transform("found", lambda f: F.struct(f["label"].alias("label"), f["place"].alias("place"))).alias("found"),
    )

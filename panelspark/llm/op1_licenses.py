"""Licence scan by Dice coefficient over word bigrams (DataFrame functions only).

Units of a document are its lines, the whole text, and windows of consecutive
words within or across lines. Text is lower-cased, everything but letters and
digits becomes a blank, and a unit's set of word bigrams is compared with each
template's. Two exact bounds prune:

* Dice >= t needs t / (2 - t) <= |unit| / |template| <= (2 - t) / t, so only
  templates of a fitting size are compared with a unit;
* a unit that reaches t shares at least t / (2 - t) of a template's bigrams.
  Words that touch more than the rest of them (the template's anchors)
  therefore occur in it, and a unit without any anchor is skipped unseen.

Windows are of every size that the first bound permits, counted in bigrams. They
are tried only for templates of which the whole text holds t / (2 - t) of the
bigrams, which a match needs, and only from where a bigram of the template
stands: a best window begins and ends with one. Of overlapping windows of one
template the best score stays, of those of several templates the one that
shares the most bigrams; a window is left out if the whole text or a line
that it touches has already matched the same template.

Templates are a parameter of bounded size; they are compared inside the row,
so nothing is shuffled.

Defined cases: null and empty texts have no licence; texts of any length are
scanned whole; of templates with equal score the smaller name wins; repeated
rows each get a result; an empty table gives none; extra columns are kept and
the result column is renamed if its name is taken.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import computed_once, free_name

THRESHOLD = 0.8

# Notices and licence texts, by name.
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
        the specific language governing permissions and limitations under the License.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS
        "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
        CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
        (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
        BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
        TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF
        THE POSSIBILITY OF SUCH DAMAGE.""",
    "CC-BY-4.0-line": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0-line": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0-line": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        General Public License for more details.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
        SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
        IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
        PERFORMANCE OF THIS SOFTWARE.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
        SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION
        OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE.""",
    "MIT-line": "Released under the MIT License.",
    "MPL-2.0-notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
        the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
}


def template_words(text: str) -> list[str]:
    return re.sub(r"[^\w]+|_", " ", text.lower()).split()


def template_bigrams(text: str) -> list[str]:
    w = template_words(text)
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:])})


def anchors(text: str, threshold: float) -> set[str]:
    """Words, the longest first, that touch more bigrams than a match may lack."""
    grams = [g.split() for g in template_bigrams(text)]
    may_lack = int(len(grams) * (1 - threshold / (2 - threshold)) + 1e-9)
    found, words = set(), sorted({w for g in grams for w in g}, key=lambda w: (-len(w), w))
    for w in words:
        if sum(1 for g in grams if found & set(g)) > may_lack:
            break
        found.add(w)
    return found


def _literal(templates: dict[str, str]) -> str:
    quoted = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return "array(" + ",".join(
        f"named_struct('name', {quoted(name)}, 'length', {max(0, len(template_words(text)) - 1)}, 'grams', array({','.join(map(quoted, template_bigrams(text)))}))"
        for name, text in sorted(templates.items())) + ")"


def windows(lines: Column, whole: Column, table: Column, threshold: float) -> Column:
    """Windows that match, as (licence, score, from, to), from and to being line numbers. lines: the words of each
    line; whole: the distinct bigrams of the text."""
    ratio = threshold / (2 - threshold)
    let = lambda value, f: F.transform(F.array(value), f)[0]
    at = F.flatten(F.transform(lines, lambda ws, i: F.transform(F.filter(ws, lambda w: w != ""), lambda w: F.struct(i.alias("line"), w.alias("w")))))
    fits = F.filter(table, lambda x: F.size(F.array_intersect(whole, x["grams"])) >= F.size(x["grams"]) * ratio)
    apart = lambda x, h: (x["last"] < h["first"]) | (x["first"] > h["last"])

    def picked(found):
        """Of overlapping windows the first in the order of the structs."""
        return F.aggregate(F.array_sort(found), F.slice(found, 1, 0), lambda held, x: F.when(
            F.forall(held, lambda h: apart(x, h)), F.array_append(held, x)).otherwise(held))

    def bigrams(ws):
        """(place, place of the same bigram before or -1, bigram), by place."""
        n = F.greatest(F.size(ws) - 1, F.lit(0))
        grams = F.zip_with(F.slice(ws, 1, n), F.slice(ws, 2, n), lambda x, y: F.concat(x["w"], F.lit(" "), y["w"]))
        return let(F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("p")))), lambda o: F.array_sort(F.transform(
            o, lambda x, i: F.struct(x["p"].alias("p"), F.when(F.get(o, i - 1)["g"] == x["g"], F.get(o, i - 1)["p"]).otherwise(-1).alias("prev"), x["g"].alias("g")))))

    def from_start(marked, size, length, s):
        """The best window that begins at place s: bigrams it shares, bigrams it has, where it ends."""
        start = F.struct(F.lit(0).alias("m"), F.lit(0).alias("n"), F.lit(0.0).alias("score"), F.lit(0).alias("shared"), F.lit(0).alias("last"))

        def step(acc, x):
            new = (x["prev"] < s).cast("int")
            m, n = acc["m"] + F.when(x["hit"], new).otherwise(0), acc["n"] + new
            return let(F.struct(m.alias("m"), n.alias("n"), (2.0 * m / (n + size)).alias("score")), lambda y: F.when(
                y["score"] > acc["score"], F.struct(y["m"].alias("m"), y["n"].alias("n"), y["score"].alias("score"), y["m"].alias("shared"), x["p"].alias("last"))
            ).otherwise(F.struct(y["m"].alias("m"), y["n"].alias("n"), acc["score"].alias("score"), acc["shared"].alias("shared"), acc["last"].alias("last"))))

        return let(F.aggregate(F.slice(marked, s + 1, length), start, step), lambda r: F.struct(
            (-r["score"]).alias("minus"), s.alias("first"), (r["last"] + 1).alias("last"), r["shared"].alias("shared")))

    def of_template(grams, x):
        length = F.floor(x["length"] / ratio + 1e-9).cast("int")
        marked = F.transform(grams, lambda g: F.struct(g["p"].alias("p"), g["prev"].alias("prev"), F.array_contains(x["grams"], g["g"]).alias("hit")))
        found = let(marked, lambda k: F.transform(F.filter(k, lambda g: g["hit"]), lambda g: from_start(k, F.size(x["grams"]), length, g["p"])))
        best = let(F.filter(found, lambda h: h["minus"] <= -threshold), picked)
        return F.transform(best, lambda h: F.struct((-h["shared"]).alias("less"), h["minus"].alias("minus"), x["name"].alias("licence"),
                                                    h["first"].alias("first"), h["last"].alias("last")))

    def of_text(ws):
        found = let(bigrams(ws), lambda grams: F.flatten(F.transform(fits, lambda x: of_template(grams, x))))
        return F.transform(let(found, picked), lambda h: F.struct(h["licence"].alias("licence"), (-h["minus"]).alias("score"),
                                                                  F.get(ws, h["first"])["line"].alias("from"), F.get(ws, h["last"])["line"].alias("to")))

    return F.when(F.size(fits) > 0, let(at, of_text))


def scan(df: DataFrame, text: str = "text", out: str = "licences", templates: dict[str, str] = TEMPLATES,
         threshold: float = THRESHOLD) -> DataFrame:
    """Adds an array with, for every matching unit, (unit: line number from 0, that of its first word for a window, or
    -1 for the whole text; licence; score), by unit. Of several templates the best one is named."""
    t = F.col(text)
    a, b, c = (free_name(df, f"licence_{x}") for x in ("units", "grams", "seen"))
    sure = F.array(*map(F.lit, sorted({w for x in templates.values() for w in anchors(x, threshold)})))
    words = lambda u: F.split(F.btrim(F.regexp_replace(F.lower(u), r"[^\p{L}\p{N}]+", " ")), " ")
    grams = lambda w: F.array_distinct(F.zip_with(
        F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda x, y: F.concat(x, F.lit(" "), y)))
    unit = lambda n, u: F.struct(n.cast("int").alias("unit"), words(u).alias("words"))
    df0 = df.withColumn(c, F.arrays_overlap(F.split(F.lower(t), r"[^\p{L}\p{N}]+"), sure))
    # The whole text comes last; lines without an anchor can't match by themselves, but windows may run across them.
    units = F.concat(F.transform(F.split(t, "\n"), lambda u, i: unit(i, u)), F.array(unit(F.lit(-1), t)))
    df1 = df0.withColumn(a, F.when(F.col(c), units)).drop(c)
    kept = lambda u: (u["unit"] == -1) | F.arrays_overlap(u["words"], sure)
    df2 = df1.withColumn(b, F.transform(F.filter(F.col(a), kept), lambda u: F.struct(u["unit"].alias("unit"), grams(u["words"]).alias("grams"))))
    table, ratio = F.expr(_literal(templates)), threshold / (2 - threshold)

    def best(u):
        n = F.size(u["grams"])
        fits = F.filter(table, lambda x: (n >= F.size(x["grams"]) * ratio) & (n * ratio <= F.size(x["grams"])))
        scored = F.transform(fits, lambda x: F.struct(
            (-2.0 * F.size(F.array_intersect(u["grams"], x["grams"])) / (n + F.size(x["grams"]))).alias("minus"),
            x["name"].alias("licence")))
        return F.struct(u["unit"].alias("unit"), F.array_min(scored).alias("best"))

    hits = F.filter(F.transform(F.col(b), best), lambda h: h["best"]["minus"] <= -threshold)
    hits = F.transform(hits, lambda h: F.struct(h["unit"].alias("unit"), h["best"]["licence"].alias("licence"),
                                                (-h["best"]["minus"]).alias("score")))
    none = F.expr("cast(array() as array<struct<unit:int,licence:string,score:double>>)")
    lines = F.transform(F.filter(F.col(a), lambda u: u["unit"] >= 0), lambda u: u["words"])
    wide = windows(lines, F.element_at(F.col(b), -1)["grams"], table, threshold)

    def both(found):
        known = lambda x: F.exists(found, lambda h: (h["licence"] == x["licence"]) & (
            (h["unit"] == -1) | h["unit"].between(x["from"], x["to"])))
        more = F.transform(F.filter(wide, lambda x: ~known(x)), lambda x: F.struct(x["from"].cast("int").alias("unit"), x["licence"], x["score"]))
        return F.concat(found, F.coalesce(more.cast("array<struct<unit:int,licence:string,score:double>>"), none))

    out = free_name(df, out)
    every = F.when(F.col(b).isNotNull(), F.array_sort(F.transform(F.array(hits), both)[0]))
    return computed_once(df2.withColumn(out, F.coalesce(every, none)).drop(a, b), out)


def best_of(licences: Column) -> Column:
    """The hit with the best score, of equal ones the smallest name; null if there is none."""
    top = F.array_min(F.transform(licences, lambda h: F.struct((-h["score"]).alias("minus"), h["licence"].alias("licence"))))
    return F.struct(top["licence"].alias("licence"), (-top["minus"]).alias("score"))

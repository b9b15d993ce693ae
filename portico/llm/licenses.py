"""Licence scans: Dice coefficient over word bigrams against templates, in DataFrame functions only."""

from __future__ import annotations

import math
import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .exact_dedup import normalised

#: Well-known public licence notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
_DISCLAIMER = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_MIT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
#: Licence texts and headers in full, beside the notices. Those of GPL, MPL, CC and Apache run to thousands of words; only their headers are here.
BODIES = [
    ("MIT", f"{_MIT} The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {_DISCLAIMER}"),
    ("BSD-2-Clause", f"{_BSD} {_BSD_END}"),
    ("BSD-3-Clause", f"{_BSD} {_BSD_THIRD} {_BSD_END}"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
]
THRESHOLD = 0.8
#: Words too common to look for unless nothing else is left.
COMMON = set("a an and any are as by for from free use in is it may not of on or that the this to under with you without following source public version software".split())
#: ASCII but for digits and a-z, after lower-casing.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def template_bigrams(text: str) -> list[str]:
    words = re.sub(BREAK, " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def _bigrams(unit: Column) -> Column:
    """Distinct pairs of successive words of a text, A-Z lower-cased already. The words are bound once, by a lambda."""
    words = F.filter(F.split(F.regexp_replace(unit, BREAK, " "), " "), lambda w: w != "")
    pairs = F.transform(F.array(words), lambda w: F.array_distinct(F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w)), lambda x, y: F.concat_ws(" ", x, y))))
    return F.when(F.size(words) > 1, pairs[0]).otherwise(F.array().cast("array<string>"))


def gate_words(templates: list[tuple[str, str]], threshold: float) -> list[str]:
    """Words of which any text near enough to a template has one, few and long.

    A Dice of t takes at least t / (2 - t) of a template's b bigrams, so one of any b - ceil(b t / (2 - t)) + 1 of
    them: words are taken, those first that serve most templates, until so many bigrams of each hold one.
    """
    left = []
    for _, text in templates:
        grams = [set(g.split(" ")) for g in template_bigrams(text)]
        left.append((grams, len(grams) - math.ceil(len(grams) * threshold / (2 - threshold) - 1e-9) + 1))
    taken: set[str] = set()
    missing = lambda grams, need: need - sum(bool(g & taken) for g in grams)
    while open_ := [(grams, need) for grams, need in left if missing(grams, need) > 0]:
        words = {w for grams, _ in open_ for g in grams if not g & taken for w in g}
        gain = lambda w: sum(min(sum(w in g for g in grams if not g & taken), missing(grams, need)) for grams, need in open_)
        taken.add(max(sorted(words), key=lambda w: (w not in COMMON, gain(w), len(w))))
    return sorted(taken)


def license_scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """For each row: doc_id, n_units, n_matches, license, dice.

    Units are the text as a whole and each of its lines; n_matches of them have a Dice of at least `threshold`
    with some template. `license` is the id with the highest Dice (then the smallest id), null without a match.
    Of the templates only those are compared whose number of bigrams b fits the unit's a: a t / (2 - t) <= b <=
    a (2 - t) / t. All of it happens within a row; nothing is shuffled. A text without any of the words that
    a match needs is passed over at once.

    Null or empty text: one empty unit, no match. Null or repeated ids: each row by itself. Empty table: no rows.
    """
    t, low = threshold, normalised(F.col(text))
    table = F.array(*[F.struct(F.lit(name).alias("license"), F.array(*[F.lit(g) for g in template_bigrams(body)]).alias("grams")) for name, body in templates])
    units = F.concat(F.array(F.col("_low")), F.when(F.instr("_low", "\n") > 0, F.split("_low", "\n")).otherwise(F.array().cast("array<string>")))

    def matches(grams: Column) -> Column:
        a = F.size(grams)
        fits = F.filter(table, lambda x: (F.size(x["grams"]) * (2 - t) >= a * t) & (F.size(x["grams"]) * t <= a * (2 - t)))
        scored = F.transform(fits, lambda x: F.struct((F.size(F.array_intersect(grams, x["grams"])) * 2.0 / (a + F.size(x["grams"]))).alias("dice"), x["license"].alias("license")))
        return F.array_sort(F.filter(scored, lambda s: s["dice"] >= t), lambda x, y: F.when(x["dice"] > y["dice"], -1).when(x["dice"] < y["dice"], 1).when(x["license"] < y["license"], -1).when(x["license"] > y["license"], 1).otherwise(0))

    best = F.filter(F.transform(F.transform(units, _bigrams), lambda g: F.try_element_at(matches(g), F.lit(1))), lambda m: m.isNotNull())
    kind = "array<struct<dice:double,license:string>>"
    signs = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
    apart = F.concat(F.lit(" "), F.translate("_low", signs, " " * len(signs)), F.lit(" "))
    gate = F.exists(F.array(apart), lambda x: reduce(or_, [F.contains(x, F.lit(f" {w} ")) for w in gate_words(templates, threshold)]))
    rows = docs.select(F.col(doc_id).alias("doc_id"), low.alias("_low"))
    rows = rows.select("doc_id", F.size(units).cast("long").alias("n_units"), F.when(gate, best).otherwise(F.array().cast(kind)).alias("m"))
    top = F.try_element_at(F.array_sort("m", lambda x, y: F.when(x["dice"] > y["dice"], -1).when(x["dice"] < y["dice"], 1).when(x["license"] < y["license"], -1).when(x["license"] > y["license"], 1).otherwise(0)), F.lit(1))
    return rows.select("doc_id", "n_units", F.size("m").cast("long").alias("n_matches"), top["license"].alias("license"), F.round(top["dice"], 9).alias("dice"))


def license_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", templates: list[tuple[str, str]] = TEMPLATES + BODIES, threshold: float = THRESHOLD) -> DataFrame:
    """For each row: doc_id, n_licenses, license, dice, by windows of words, whatever the line breaks.

    A window has as many bigrams as the template and begins at one of its bigrams (or is the whole text, if that is
    shorter). n_licenses ids have a window with a Dice of at least `threshold` to one of their templates; `license`
    is the id with the highest Dice (then the smallest id), null without a match. A text whose bigrams hold fewer
    than t / (2 - t) of a template's cannot have such a window and is not cut into any. Nothing is shuffled.

    Null or empty text: no match. Null or repeated ids: each row by itself. Empty table: no rows.
    """
    t = threshold
    grams = [(name, template_bigrams(body)) for name, body in templates]
    table = F.array(*[F.struct(F.lit(name).alias("license"), F.array(*[F.lit(g) for g in own]).alias("grams")) for name, own in grams])
    union = F.array(*[F.lit(g) for g in sorted({g for _, own in grams for g in own})])
    words = F.filter(F.split(F.regexp_replace("_low", BREAK, " "), " "), lambda w: w != "")
    pairs = F.transform(F.array(words), lambda w: F.when(F.size(w) > 1, F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w)), lambda x, y: F.concat_ws(" ", x, y))).otherwise(F.array().cast("array<string>")))[0]
    signs = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
    spaced = F.concat(F.lit(" "), F.translate("_low", signs, " " * len(signs)), F.lit(" "))
    gate = F.exists(F.array(spaced), lambda x: reduce(or_, [F.contains(x, F.lit(f" {w} ")) for w in gate_words(templates, t)]))

    def best(p: Column, x: Column) -> Column:
        """The highest Dice of a window of the bigrams p with the template x; windows begin at a shared bigram."""
        b = F.size(x["grams"])
        at = F.filter(F.transform(p, lambda g, k: F.when(F.array_contains(x["grams"], g), k + 1)), lambda k: k.isNotNull())
        windows = F.transform(at, lambda k: F.array_distinct(F.slice(p, k, b)))
        return F.array_max(F.transform(windows, lambda g: F.size(F.array_intersect(g, x["grams"])) * 2.0 / (F.size(g) + b)))

    def found(p: Column) -> Column:
        held = F.array_intersect(p, union)
        near = F.transform(F.array(held), lambda h: F.filter(table, lambda x: F.size(F.array_intersect(h, x["grams"])) * (2 - t) >= F.size(x["grams"]) * t - 1e-9))[0]
        return F.filter(F.transform(near, lambda x: F.struct(best(p, x).alias("dice"), x["license"].alias("license"))), lambda s: s["dice"] >= t)

    kind = "array<struct<dice:double,license:string>>"
    rows = docs.select(F.col(doc_id).alias("doc_id"), normalised(F.col(text)).alias("_low"))
    rows = rows.select("doc_id", F.when(gate, F.transform(F.array(pairs), found)[0]).otherwise(F.array().cast(kind)).alias("m"))
    top = F.try_element_at(F.array_sort("m", lambda x, y: F.when(x["dice"] > y["dice"], -1).when(x["dice"] < y["dice"], 1).when(x["license"] < y["license"], -1).when(x["license"] > y["license"], 1).otherwise(0)), F.lit(1))
    return rows.select("doc_id", F.size(F.array_distinct(F.transform("m", lambda s: s["license"]))).cast("long").alias("n_licenses"), top["license"].alias("license"), F.round(top["dice"], 9).alias("dice"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


ORACLE = rf"""
WITH t(license, grams) AS (VALUES {", ".join(f"({_quoted(n)}, [{', '.join(map(_quoted, template_bigrams(b)))}])" for n, b in TEMPLATES)}),
d AS (SELECT doc_id, row_number() OVER () AS n, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
u AS (SELECT n, doc_id, unnest(list_concat([low], CASE WHEN contains(low, chr(10)) THEN string_split(low, chr(10)) ELSE [] END)) AS unit FROM d),
w AS (SELECT n, doc_id, row_number() OVER () AS k, list_filter(string_split(regexp_replace(unit, '{BREAK}', ' ', 'g'), ' '), lambda x: x <> '') AS words FROM u),
g AS (SELECT n, doc_id, k, CASE WHEN len(words) > 1 THEN list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) ELSE [] END AS grams FROM w),
s AS (SELECT g.k, t.license, len(list_intersect(g.grams, t.grams)) * 2.0::DOUBLE / (len(g.grams) + len(t.grams)) AS dice FROM g, t WHERE len(t.grams) * 1.2 >= len(g.grams) * 0.8 AND len(t.grams) * 0.8 <= len(g.grams) * 1.2),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY dice DESC, license) AS r FROM s WHERE dice >= 0.8) WHERE r = 1),
m AS (SELECT g.n, g.doc_id, b.license, b.dice, row_number() OVER (PARTITION BY g.n ORDER BY b.dice DESC NULLS LAST, b.license) AS r, count(*) OVER (PARTITION BY g.n) AS n_units, count(b.dice) OVER (PARTITION BY g.n) AS n_matches FROM g LEFT JOIN b ON g.k = b.k)
SELECT doc_id, n_units, n_matches, license, round(dice, 9) AS dice FROM m WHERE r = 1
"""

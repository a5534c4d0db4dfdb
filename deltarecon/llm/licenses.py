"""Licence scan (DataFrame functions only).

Parts of a text are normalised to lower-case words and compared to licence templates
by the Dice coefficient of their sets of word bigrams: twice the shared over the sum
of both sizes. Dice of at least t needs sizes within a factor (2 - t) / t of each
other, so a part is compared only with templates inside that bound.

The parts are sentences, lines, paragraphs and the whole text, and runs of segments
(what lies between sentence or line ends), so that a licence in several paragraphs
or lines is found inside a longer text. For each template, islands are unbroken
stretches of segments at least half of whose bigrams are the template's; runs go from
the begin of one island to the end of the same or of a later one, those over several
islands only up to the bound in words.

Most texts meet no template: a text's bigrams are hashed once and looked up in a bit
map. A part that reaches t holds t / (2 - t) of a template's bigrams at least, so of
any more than the rest at least one: the map has as many of every template, and a
few more, the rarest among the templates. Only for a text that has enough of a
template's rare bigrams, and then of all its bigrams, are parts made.

The scan is within the row: templates are a fixed, small array of hashes, and
nothing is shuffled.

Cases: null and empty texts have no units and match nothing; a unit without two
words has no bigram; ties of the best coefficient go to the name first in
order; repeated rows and ids are scanned on their own; an empty table gives no
rows; other columns don't matter; a very long text is one row's work, in time
linear in its length but for its islands, which are paired.
"""

from __future__ import annotations

from collections import Counter

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deltarecon.llm.common import let, lower_ascii, words
from deltarecon.llm.license_texts import TEXTS

MIN_PERCENT = 80  # of Dice; whole numbers keep the bounds exact
WIDE = 200 - MIN_PERCENT
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SENTENCE_BREAK = r"[.!?]+[\x20\x09-\x0D]+|\n"
PARAGRAPH_BREAK = r"\n[\x20\x09-\x0D]*\n"

def template_bigrams(text: str) -> set[tuple[str, str]]:
    ws = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    return set(zip(ws, ws[1:]))


# The usual statements and notices of public licences, by SPDX name.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This project is licensed under the Apache License 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS "
            "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
            "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
            "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
            "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

# What licences are called in statements, by SPDX name.
NAMES = {
    "0BSD": ["BSD Zero Clause License"],
    "AGPL-3.0": ["GNU Affero General Public License v3.0", "GNU AGPLv3 license"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache 2.0 License", "Apache License 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License"],
    "BSL-1.0": ["Boost Software License, Version 1.0"],
    "CC0-1.0": ["CC0 1.0 Universal license"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License, v. 2.0"],
    "GPL-2.0": ["GNU General Public License v2.0", "GNU GPLv2 license"],
    "GPL-3.0": ["GNU General Public License v3.0", "GNU GPLv3 license"],
    "ISC": ["ISC License"],
    "LGPL-2.1": ["GNU Lesser General Public License v2.1", "GNU LGPLv2.1 license"],
    "LGPL-3.0": ["GNU Lesser General Public License v3.0", "GNU LGPLv3 license"],
    "MIT": ["MIT License"],
    "MPL-2.0": ["Mozilla Public License 2.0", "Mozilla Public License, v. 2.0"],
    "Zlib": ["zlib License"],
}
STATEMENTS = ["Licensed under the {}.", "Released under the {}.", "Distributed under the {}.", "This project is licensed under the {}."]


def _gnu_notice(work: str, name: str, version: str) -> str:
    free = (f"This {work} is free software; you can redistribute it and/or modify it under the terms of the {name} as "
            f"published by the Free Software Foundation; either version {version} of the License, or (at your option) any "
            "later version.")
    return free + (f" This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
                   f"the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more "
                   f"details. You should have received a copy of the {name} along with this {work}. If not, see "
                   "https://www.gnu.org/licenses/.")


# Whole notices, and their first paragraphs, of the GNU licences.
_GNU = [("AGPL-3.0", "program", "GNU Affero General Public License", "3"), ("GPL-2.0", "program", "GNU General Public License", "2"),
        ("GPL-3.0", "program", "GNU General Public License", "3"), ("LGPL-2.1", "library", "GNU Lesser General Public License", "2.1"),
        ("LGPL-3.0", "library", "GNU Lesser General Public License", "3")]
_NOTICES = [(spdx, _gnu_notice(*rest)) for spdx, *rest in _GNU]
_NOTICES += [(spdx, notice[:notice.index(" This", 5)]) for spdx, notice in _NOTICES]
_NOTICES += [("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                         "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/")]
_known = {(name, tuple(sorted(template_bigrams(text)))) for name, text in TEMPLATES}
for _name, _text in [*((name, s.format(called)) for name, names in NAMES.items() for called in names for s in STATEMENTS),
                     *_NOTICES, *TEXTS.items()]:
    _key = _name, tuple(sorted(template_bigrams(_text)))
    if _key not in _known:
        _known.add(_key)
        TEMPLATES.append((_name, _text))


def _pair_hash(a: str, b: str) -> int:
    """The session's ``xxhash64(a, b)``: the hash of one value seeds the next."""
    h = xxhash.xxh64_intdigest(b.encode(), xxhash.xxh64_intdigest(a.encode(), 42))
    return h - (1 << 64) if h >> 63 else h


# Bigrams that a part may lack of a template of n: at most n * MAY_LACK.
MAY_LACK = (200 - 2 * MIN_PERCENT) / WIDE
MAP_BITS = 18


def rare_bigrams() -> list[set[tuple[str, str]]]:
    """For each template more bigrams than a match may lack, the rarest among all templates."""
    every = [template_bigrams(text) for _, text in TEMPLATES]
    n_with = Counter(p for pairs in every for p in pairs)
    n_word = Counter(w for pairs in every for p in pairs for w in p)
    out = []
    for pairs in every:
        lack = int(len(pairs) * MAY_LACK)
        ranked = sorted(pairs, key=lambda p: (n_with[p], min(n_word[p[0]], n_word[p[1]]), p))
        out.append(set(ranked[:lack + 1 + len(pairs) // 6]))
    return out


def _template_column() -> Column:
    def hashes(pairs: set[tuple[str, str]]) -> Column:
        # One text, not an expression an element: there are tens of thousands.
        return F.split(F.lit(",".join(str(_pair_hash(*p)) for p in sorted(pairs))), ",").cast("array<bigint>")

    return F.array(*(
        F.struct(F.lit(name).alias("name"), F.lit(len(pairs)).alias("n"), hashes(pairs).alias("pairs"), hashes(rare).alias("rare"),
                 F.lit(len(rare) - int(len(pairs) * MAY_LACK)).alias("least"))
        for (name, text), rare in zip(TEMPLATES, rare_bigrams()) for pairs in [template_bigrams(text)]))


def _bit_map() -> Column:
    """A bit for every rare bigram, as an array of longs (32 KB)."""
    bits = [0] * (1 << MAP_BITS - 6)
    for rare in rare_bigrams():
        for p in rare:
            at = _pair_hash(*p) & (1 << MAP_BITS) - 1
            bits[at >> 6] |= 1 << (at & 63)
    return F.lit([b - (1 << 64) if b >> 63 else b for b in bits]).cast("array<bigint>")


def units(text: Column) -> Column:
    """Distinct sentences, lines, paragraphs and the whole of a text."""
    t = F.coalesce(text, F.lit(""))
    return F.array_distinct(F.concat(
        F.split(t, SENTENCE_BREAK), F.split(t, "\n"), F.split(t, PARAGRAPH_BREAK), F.array(t)))


def _pairs(ws: Column) -> Column:
    return F.transform(F.slice(ws, 1, F.greatest(F.size(ws) - 1, F.lit(0))), lambda w, i: F.xxhash64(w, ws[i + 1]))


_HITS = "array<struct<dice:double,name:string>>"


def _scored(pairs: Column, templates: Column) -> Column:
    """``(dice, name)`` of the templates that a part with the distinct ``pairs`` matches."""
    near = F.filter(templates, lambda t: (
        t["n"] * MIN_PERCENT <= F.size(pairs) * WIDE) & (F.size(pairs) * MIN_PERCENT <= t["n"] * WIDE))
    scored = F.transform(near, lambda t: F.struct(
        F.size(F.array_intersect(pairs, t["pairs"])).alias("shared"), (F.size(pairs) + t["n"]).alias("both"),
        t["name"].alias("name")))
    enough = F.filter(scored, lambda s: 200 * s["shared"] >= MIN_PERCENT * s["both"])
    return F.transform(enough, lambda s: F.struct((2.0 * s["shared"] / s["both"]).alias("dice"), s["name"].alias("name")))


def _near_templates(h: Column, templates: Column, bits: Column) -> Column:
    """The templates of which the text's bigrams hold as many as a match needs."""
    def mapped(x: Column) -> Column:
        at = x.bitwiseAND(F.lit((1 << MAP_BITS) - 1))
        return F.getbit(bits[F.shiftright(at, 6).cast("int")], at.bitwiseAND(F.lit(63)).cast("int")) == 1

    def by_rare(found: Column) -> Column:
        some = F.filter(templates, lambda t: (t["least"] <= F.size(found)) & (
            F.size(F.array_intersect(found, t["rare"])) >= t["least"]))
        return F.when(F.size(found) > 0, some).otherwise(F.slice(templates, 1, 0))

    def by_all(some: Column) -> Column:
        whole = let(F.array_distinct(h), lambda d: F.filter(some, lambda t: (
            F.size(F.array_intersect(d, t["pairs"])) * WIDE >= t["n"] * MIN_PERCENT)))
        return F.when(F.size(some) > 0, whole).otherwise(some)

    return let(let(F.array_distinct(F.filter(h, mapped)), by_rare), by_all)


def _run_hits(t: Column, h: Column, starts: Column) -> Column:
    """What runs of segments match of one template. ``starts``: the first word of each segment."""
    def end_of(j: Column) -> Column:
        return F.coalesce(F.get(starts, j + 1), F.size(h) + 1)  # the word after a segment's last

    def islands(common: Column) -> Column:
        def dense_segment(s: Column, j: Column) -> Column:
            n = F.least(end_of(j), F.size(h)) - s  # bigrams that begin in it
            shared = F.size(F.filter(F.slice(h, s + 1, F.greatest(n, F.lit(0))), lambda x: F.array_contains(common, x)))
            return (shared > 0) & (2 * shared >= n)

        def ends(dense: Column) -> Column:
            none = F.lit(False)
            begins = F.filter(F.transform(dense, lambda x, j: F.when(
                x & ~F.coalesce(F.get(dense, j - 1), none), starts[j])), lambda x: x.isNotNull())
            stops = F.filter(F.transform(dense, lambda x, j: F.when(
                x & ~F.coalesce(F.get(dense, j + 1), none), end_of(j))), lambda x: x.isNotNull())
            return F.struct(begins.alias("begins"), stops.alias("stops"))

        return let(F.transform(starts, dense_segment), ends)

    def between(i: Column) -> Column:
        def from_one(a: Column, nth: Column) -> Column:
            stops = F.filter(i["stops"], lambda e, at: (at == nth) | (
                (e > a) & ((e - a - 1) * MIN_PERCENT <= t["n"] * WIDE)))
            return F.flatten(F.transform(stops, lambda e: let(
                F.array_distinct(F.slice(h, a + 1, e - a - 1)), lambda pairs: _scored(pairs, F.array(t)))))

        return F.flatten(F.transform(i["begins"], from_one))

    return let(let(F.array_intersect(h, t["pairs"]), islands), between)


def _text_hits(text: Column, h: Column, near: Column) -> Column:
    """Hits of each unit that has one, and of all runs, for a text near some templates."""
    of_units = F.transform(F.filter(units(text), lambda u: u != ""), lambda u: let(
        F.array_distinct(_pairs_of(u)), lambda pairs: _scored(pairs, near)))
    segments = F.filter(F.transform(F.split(text, SENTENCE_BREAK), lambda s: words(lower_ascii(s), BETWEEN_WORDS)),
                        lambda ws: F.size(ws) > 0)
    first = F.flatten(F.transform(segments, lambda ws: F.transform(ws, lambda _, i: i == 0)))
    starts = F.filter(F.transform(first, lambda x, i: F.when(x, i)), lambda x: x.isNotNull())
    of_runs = let(starts, lambda at: F.flatten(F.transform(near, lambda t: _run_hits(t, h, at))))
    return F.struct(F.filter(of_units, lambda m: F.size(m) > 0).alias("units"), of_runs.alias("runs"))


def _pairs_of(unit: Column) -> Column:
    return let(words(lower_ascii(unit), BETWEEN_WORDS), _pairs)


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``n_units``, ``n_matched`` (units that match
    a template), ``licenses`` (names found in units and runs, sorted, comma-joined),
    ``best_dice`` and ``best_license`` (null without a match)."""
    templates, bits = _template_column(), _bit_map()
    text = F.coalesce(F.col("text"), F.lit(""))
    nothing = F.lit(None).cast(f"struct<units:array<{_HITS}>,runs:{_HITS}>")

    def scan(h: Column) -> Column:
        return let(_near_templates(h, templates, bits), lambda near: F.when(
            F.size(near) > 0, _text_hits(text, h, near)).otherwise(nothing))

    df = docs.select("doc_id", F.size(F.filter(units(text), lambda u: u != "")).cast("long").alias("n_units"),
                     let(_pairs_of(text), scan).alias("found"))
    hits = F.coalesce(F.concat(F.flatten("found.units"), F.col("found.runs")), F.array().cast(_HITS))
    df = df.select("doc_id", "n_units", F.coalesce(F.size("found.units"), F.lit(0)).cast("long").alias("n_matched"), hits.alias("hits"))
    best = F.sort_array(F.transform("hits", lambda h: F.struct((-h["dice"]).alias("d"), h["name"].alias("name"))))
    df = df.withColumn("best", best)
    first = F.when(F.size("best") > 0, F.element_at("best", 1))
    return df.select(
        "doc_id", "n_units", F.greatest("n_matched", F.lit(0).cast("long")).alias("n_matched"),
        F.array_join(F.sort_array(F.array_distinct(F.transform("hits", lambda h: h["name"]))), ",").alias("licenses"),
        F.round(-first["d"], 9).alias("best_dice"), first["name"].alias("best_license"))

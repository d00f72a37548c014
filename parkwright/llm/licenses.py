"""Licence notices in documents, by the Dice coefficient of word bigrams.

The units of a text are its lines, its paragraphs (lines between blank ones) and
the whole of it. A unit is normalised to lower-case words of letters and digits;
its set of word bigrams A is compared with that of each template B as
2 |A & B| / (|A| + |B|). At a threshold t this needs |B| t/(2-t) <= |A| <= |B| (2-t)/t,
which bounds the sizes a unit is compared at, and the words it may have. Further,
|A & B| >= t/(2-t) |B|, so of any |B| - ceil(t/(2-t) |B|) + 1 bigrams of a template
one must occur: a unit without a word of such anchor bigrams is left out at once.

Licences that match no unit are looked for inside longer ones: in windows of the
whole text's words, of each template's size range, from one of its bigrams to
another. Of windows that overlap, the one with most shared bigrams counts. TEMPLATES
are short notices and the paragraphs of licences, so a licence text is found by its
paragraphs, however its lines are broken.

Scale: native expressions look at each text in its own task; nothing is shuffled.
The templates are one constant table that expressions walk, so the plan is the same for
ten templates and for thousands.

Defined cases: null, empty and unmatched texts get no licence (empty string,
null best). Of templates with equal coefficients the first by name wins. Repeated
rows are scanned each. Very long texts are scanned whole, in the memory of their task.
Columns beyond doc_id and text are not looked at, whatever their names. No rows in, no
rows out.
"""

from __future__ import annotations

import json
import re
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parkwright.llm.shared import let

#: Paragraphs of licences, and the notices by which works name them.
TEMPLATES = {
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    "Apache-2.0-warranty": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "BSD-clause-1": "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "BSD-clause-2": "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-clause-3": "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "BSD-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSD-warranty": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "ISC-warranty": 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "MIT": "Released under the MIT License.",
    "MIT-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "MIT-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT-warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
RESTRICTED = ("AGPL-3.0-header", "CC-BY-NC-4.0", "CC-BY-NC-4.0-long", "GPL-3.0", "GPL-3.0-header")
THRESHOLD = Fraction(4, 5)
_TEMPLATE = "array<struct<name:string,bigrams:array<string>,n:int,low:int,high:int,span:int>>"
_WINDOW = "struct<less:int,sizes:int,name:string,start:int,end:int>"


def by_paragraphs(texts: dict[str, str], least_words: int = 8) -> dict[str, str]:
    """Templates of whole licence texts: each paragraph of at least ``least_words`` words, as 'name/place'."""
    parts = {name: [p for p in re.split(r"\n[ \t]*\n", text) if len(template_words(p)) >= least_words] for name, text in texts.items()}
    return {f"{name}/{i}": " ".join(p.split()) for name, own in parts.items() for i, p in enumerate(own, 1)}


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def template_bigrams(text: str) -> list[str]:
    words = template_words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def anchors(bigrams: list[str], least_share: Fraction) -> list[str]:
    """As many bigrams as make sure that a match has one of them: those with the longest words."""
    needed = -(-least_share.numerator * len(bigrams) // least_share.denominator)
    return sorted(bigrams, key=lambda b: (-max(map(len, b.split())), b))[: len(bigrams) - needed + 1]


def _constant(value: list, kind: str) -> Column:
    """``value`` as one constant of the plan, however long it is."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def matches(text: Column, templates: dict[str, str] = TEMPLATES, threshold: Fraction = THRESHOLD) -> Column:
    """(shared, sizes, name) of the best template of each unit that matches one, and of notices only found inside; Dice is 2 shared / sizes."""
    sets, share = {name: template_bigrams(t) for name, t in sorted(templates.items())}, threshold / (2 - threshold)
    low = {n: -(-share.numerator * len(s) // share.denominator) for n, s in sets.items()}
    high = {n: share.denominator * len(s) // share.numerator for n, s in sets.items()}
    # a bigram may come again in a notice, so it may be longer than its set
    span = {n: high[n] + len(template_words(templates[n])) - 1 - len(s) for n, s in sets.items()}
    # one word of each anchor bigram, the longer
    bigrams = sorted({b for s in sets.values() for b in anchors(s, share)})
    wanted = _constant(sorted({max(b.split(), key=len) for b in bigrams}), "array<string>")
    least = min(low.values()) + 1
    every_bigram = sorted({b for s in sets.values() for b in s})
    table = _constant([{"name": n, "bigrams": s, "n": len(s), "low": low[n], "high": high[n], "span": span[n]} for n, s in sets.items()], _TEMPLATE)
    lines = F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\n]+", " "), "\n")
    split = lambda line: F.array_remove(F.split(line, "[ \n]+"), "")

    def unit(w: Column, all_templates: Column) -> Column:
        bigrams = F.array_distinct(F.transform(F.slice(w, 2, F.size(w) - 1), lambda x, i: F.concat(F.get(w, i), F.lit(" "), x)))
        one = lambda b, t: F.struct(F.size(F.array_intersect(b, t["bigrams"])).alias("shared"), (F.size(b) + t["n"]).alias("sizes"), t["name"].alias("name"))
        enough = lambda m: m["shared"] * 2 * threshold.denominator >= m["sizes"] * threshold.numerator
        every = lambda b: F.filter(F.transform(F.filter(all_templates, lambda t: F.size(b).between(t["low"], t["high"])), lambda t: one(b, t)), enough)
        # the first of the highest coefficients, compared in whole numbers
        better = lambda a, m: F.when(a.isNull() | (m["shared"] * a["sizes"] > a["shared"] * m["sizes"]), m).otherwise(a)
        return let(bigrams, lambda b: F.aggregate(every(b), F.lit(None).cast("struct<shared:int,sizes:int,name:string>"), better))

    def units(rows: Column) -> Column:
        whole = F.array_join(rows, "\n")
        paragraphs = F.filter(F.split(whole, r"\n *(?:\n *)+"), lambda p: p.contains("\n"))
        # a text that is one paragraph, or one line, is looked at once
        return F.array_distinct(F.concat(rows, paragraphs, F.array(whole)))

    def windows(w: Column, all_templates: Column) -> Column:
        """(shared, sizes, name) of the notices inside ``w``, those with most shared bigrams first, none over another."""
        every = _constant(every_bigram, "array<string>")

        def one(t: Column, bigrams: Column, hits: Column) -> Column:
            def window(own: Column, i: Column, j: Column) -> Column:
                start, end = F.get(own, i)["at"], F.get(own, j)["at"]
                shared = F.size(F.array_distinct(F.transform(F.slice(own, i + 1, j - i + 1), lambda h: h["b"])))
                size = F.size(F.array_distinct(F.slice(bigrams, start + 1, end - start + 1)))
                return F.when(end - start < t["span"], F.struct((-shared).alias("less"), (size + t["n"]).alias("sizes"), t["name"].alias("name"), start.alias("start"), end.alias("end")))

            def ends(own: Column, i: Column) -> Column:
                return F.filter(F.transform(F.sequence(i + (t["low"] - 1), F.size(own) - 1), lambda j: window(own, i, j)), lambda m: m.isNotNull() & (-m["less"] * 2 * threshold.denominator >= m["sizes"] * threshold.numerator))

            near = lambda own, i: F.get(own, i + (t["low"] - 1))["at"] - F.get(own, i)["at"] < t["span"]
            # a best window starts and ends at bigrams of its template
            found = lambda own: F.when(F.size(own) >= t["low"], F.flatten(F.transform(F.filter(F.sequence(F.lit(0), F.size(own) - t["low"]), lambda i: near(own, i)), lambda i: ends(own, i))))
            return F.coalesce(let(F.filter(hits, lambda h: F.array_contains(t["bigrams"], h["b"])), found), F.array().cast(f"array<{_WINDOW}>"))

        apart = lambda m, o: (m["end"] < o["start"]) | (o["end"] < m["start"])
        take = lambda kept, m: F.when(F.forall(kept, lambda o: apart(m, o)), F.array_append(kept, m)).otherwise(kept)
        all_of = lambda bigrams, hits: F.array_sort(F.flatten(F.transform(all_templates, lambda t: one(t, bigrams, hits))))
        chosen = lambda bigrams, hits: F.aggregate(all_of(bigrams, hits), F.array().cast(f"array<{_WINDOW}>"), take)
        placed = lambda bigrams, present: F.filter(F.transform(bigrams, lambda b, i: F.when(F.array_contains(present, b), F.struct(i.alias("at"), b.alias("b")))), lambda h: h.isNotNull())
        bigrams = F.transform(F.slice(w, 2, F.size(w) - 1), lambda x, i: F.concat(F.get(w, i), F.lit(" "), x))
        rows = let(bigrams, lambda bs: let(F.array_intersect(bs, every), lambda present: F.when(F.size(present) >= min(low.values()), let(placed(bs, present), lambda hits: chosen(bs, hits)))))
        return F.transform(rows, lambda m: F.struct((-m["less"]).alias("shared"), m["sizes"].alias("sizes"), m["name"].alias("name")))

    def with_windows(worth: Column, all_templates: Column) -> Column:
        # the whole text is the last unit, and worth it if any unit is
        inside = F.when(F.size(worth) > 0, windows(F.get(worth, F.size(worth) - 1), all_templates))
        added = lambda own: F.filter(inside, lambda m: ~F.exists(own, lambda o: o["name"] == m["name"]))
        return let(F.filter(F.transform(worth, lambda w: unit(w, all_templates)), lambda m: m.isNotNull()), lambda own: F.coalesce(F.concat(own, added(own)), own))

    def looked_at(rows: Column) -> Column:
        worth = F.filter(F.transform(units(rows), split), lambda w: (F.size(w) >= least) & F.arrays_overlap(w, wanted))
        # most texts have none of the words, or none of the bigrams, anywhere
        none = F.array().cast("array<struct<shared:int,sizes:int,name:string>>")
        pairs = lambda w: F.transform(F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda x, i: F.concat(F.get(w, i), F.lit(" "), x))
        anchored = lambda w: F.arrays_overlap(w, wanted) & F.arrays_overlap(pairs(w), _constant(bigrams, "array<string>"))
        return let(split(F.array_join(rows, " ")), lambda w: F.when(anchored(w), let(worth, lambda own: let(table, lambda t: with_windows(own, t)))).otherwise(none))

    return let(lines, looked_at)


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: Fraction = THRESHOLD) -> DataFrame:
    """(doc_id, licenses, n_matches, best_license, best_shared, best_sizes, restricted) for each row of ``docs``.

    ``licenses`` joins the names found, sorted. The best match has the Dice
    coefficient 2 * best_shared / best_sizes.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), matches(F.col("text").cast("string"), templates, threshold).alias("m"))
    better = lambda a, m: F.when(a.isNull() | (m["shared"] * a["sizes"] > a["shared"] * m["sizes"]) | ((m["shared"] * a["sizes"] == a["shared"] * m["sizes"]) & (m["name"] < a["name"])), m).otherwise(a)
    own = own.withColumn("best", F.aggregate("m", F.lit(None).cast("struct<shared:int,sizes:int,name:string>"), better))
    names = F.array_sort(F.array_distinct(F.transform("m", lambda m: m["name"])))
    own = own.withColumn("names", names)
    return own.select(
        "doc_id", F.array_join("names", ",").alias("licenses"), F.size("m").cast("long").alias("n_matches"), F.col("best.name").alias("best_license"),
        F.col("best.shared").cast("long").alias("best_shared"), F.col("best.sizes").cast("long").alias("best_sizes"), F.arrays_overlap("names", F.array(*[F.lit(x) for x in RESTRICTED])).alias("restricted"),
    )

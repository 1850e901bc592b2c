"""Licence scans: normalised text compared to licence templates by Dice coefficient over word bigrams, with DataFrame functions only.

Units of a text are its lines, its paragraphs and the whole. Two exact bounds spare most comparisons. A unit is compared
only to templates whose number of bigrams allows the wanted coefficient at all. And a text is split, into units or runs, only if
it holds one of a few words, chosen so that nothing without them can share enough bigrams with any template. For a template that no unit
matches, every run of words can (a notice inside a longer line, or wrapped inside a paragraph): the best run begins and ends with
bigrams of the template, so only those are tried, of templates enough of whose bigrams the text holds. Nothing is shuffled.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 0.8

#: The wording of common notices.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "Apache-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved."),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without '
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR '
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must "
        "retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "
        '"AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT '
        "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
        "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
        "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must "
        "retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
        'CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. '
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
        "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice "
        'appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. '
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
        "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is "
        "granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin "
        "of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation "
        "would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not "
        "be removed or altered from any source distribution.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
        "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software "
        "dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and "
        "successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
    ),
    (
        "BSL-1.0",
        'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, '
        "reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, "
        "all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be "
        "included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable "
        "object code generated by a source language processor.",
    ),
]


def bigrams(text: str) -> set[str]:
    words = re.findall(r"[^\W_]+", text.lower())
    return {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}


def needed_words(templates: list[tuple[str, str]], least: float = LEAST) -> list[str]:
    """Words such that a unit without any of them falls short of ``least`` against every template.

    A unit that shares s bigrams has s itself at least, so its coefficient is 2 s / (s + t) at most: with fewer than
    least * t / (2 - least) bigrams free of the words, a template of t bigrams is out of reach. Words that take away most
    bigrams come first, until that holds for all; short words, which any text holds, only where no other is left.
    """
    sets = [bigrams(text) for _, text in templates]
    chosen: list[str] = []

    def free(grams: set[str]) -> list[str]:
        return [g for g in grams if not set(g.split()) & set(chosen)]

    while short := [g for g in sets if len(free(g)) >= least * len(g) / (2 - least) * (1 - 1e-9)]:
        gain = Counter(w for g in short for x in free(g) for w in set(x.split()))
        chosen.append(max(gain, key=lambda w: (len(w) >= 6, gain[w], len(w), w)))
    return chosen


def _sql_text(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _template_column(templates: list[tuple[str, str]]) -> Column:
    parts = [f"named_struct('k', {k}, 'grams', array({', '.join(map(_sql_text, sorted(bigrams(text))))}))" for k, (_, text) in enumerate(templates)]
    return F.expr(f"array({', '.join(parts)})")


def _in_runs(grams: Column, shared: Column, known: list[tuple[str, str]], least: float) -> Column:
    """(dice, k) of each template that a run of ``grams``, the bigrams of a text in order, reaches; of the best run.

    shared: those of the text's bigrams that any template has, each once.

    Runs are as long as the template's size bounds allow. One that begins or ends with another text's bigram is never better
    than without it.
    """
    reach = least / (2 - least) * (1 - 1e-9)
    size = lambda t: F.size(t["grams"])
    held = F.filter(_template_column(known), lambda t: F.size(F.array_intersect(shared, t["grams"])) >= size(t) * F.lit(reach))
    placed = F.transform(
        held,
        lambda t: F.struct(t["k"].alias("k"), t["grams"].alias("grams"), F.ceil(size(t) * F.lit(reach)).cast("int").alias("need"), F.filter(F.sequence(F.lit(0), F.size(grams) - 1), lambda i: F.array_contains(t["grams"], F.get(grams, i))).alias("at")),
    )

    def dice(t: Column, first: Column, last: Column) -> Column:
        run = F.slice(grams, first + 1, last - first + 1)
        return F.when((last - first) * F.lit(reach) < size(t), 2.0 * F.size(F.array_intersect(run, t["grams"])) / (F.size(F.array_distinct(run)) + size(t))).otherwise(F.lit(0.0))

    def best(t: Column) -> Column:
        # of the template's bigrams a run begins with one and holds as many as are needed within the size bound; its end is within it too
        most = F.ceil(size(t) / F.lit(reach)).cast("int")
        starts = F.filter(F.sequence(F.lit(0), F.size(t["at"]) - t["need"]), lambda i: F.get(t["at"], i + t["need"] - 1) - F.get(t["at"], i) <= most)
        ends = lambda i: F.filter(F.slice(t["at"], i + t["need"], most + 1), lambda last: last - F.get(t["at"], i) <= most)
        return F.array_max(F.transform(starts, lambda i: F.array_max(F.transform(ends(i), lambda last: dice(t, F.get(t["at"], i), last)))))

    return F.filter(F.transform(placed, lambda t: F.struct(best(t).alias("dice"), (-t["k"]).alias("k"))), lambda m: m["dice"] >= least)


def license_scan(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] | None = None, least: float = LEAST, runs: bool = False
) -> DataFrame:
    """Per row: id, license (of the best template, null if none reaches ``least``), template (its number), dice and n_matches (pairs of a unit and a template that reach it).

    Units are lines, paragraphs and the whole; with ``runs``, for each template that none of them reaches, all runs of words too,
    of which the best counts. At ties the first template counts. Text is lowered and split at all that isn't a letter or digit; equal units of a text
    count once. A null or empty text has no licence; a null id stays null; repeated rows give repeated results; an empty table
    gives none; other columns are ignored. Long texts are compared whole; runs are tried only where a template's bigrams stand
    close enough to each other, so time grows with the text's length.
    """
    templates = TEMPLATES if templates is None else templates
    known = [(name, text) for name, text in templates if bigrams(text)]
    sizes = [len(bigrams(text)) for _, text in known]
    bound = least / (2 - least) * (1 - 1e-9)  # a little slack: the coefficient itself decides at the edge
    low, high = min(sizes) * bound, max(sizes) / bound
    words = needed_words(known, least)
    text = F.col("text")
    whole = F.concat(F.split(text, r"\n"), F.split(text, r"\n[\x20\t\r]*\n"), F.array(text))
    has = f"(?iu){'|'.join(map(re.escape, words))}"
    units = F.filter(F.array_distinct(whole), lambda u: u.rlike(has))
    rows = df.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))
    # a run of a text without the words falls short as its units do
    rows = rows.withColumn("text", F.when(text.rlike(has), text)).withColumn("units", units)
    of_text = lambda u: F.array_remove(F.split(F.lower(u), r"[^\p{L}\p{N}]+"), "")
    in_order = lambda w: F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.concat(a, F.lit(" "), b))
    rows = rows.select(id_col, "text", F.transform("units", of_text).alias("words"))
    pairs = F.transform("words", lambda w: F.array_distinct(in_order(w)))
    # a word alone has no bigram; units out of every template's bounds need no bigrams
    rows = rows.select(id_col, "text", F.filter("words", lambda w: (F.size(w) - 1 >= low) & (F.size(w) > 1)).alias("words")).select(id_col, "text", pairs.alias("pairs"))
    rows = rows.select(id_col, "text", F.filter("pairs", lambda p: F.size(p).between(low, high)).alias("pairs"))
    reach = F.lit(bound)
    matched = F.transform(
        "pairs",
        lambda p: F.filter(
            F.transform(
                F.filter(_template_column(known), lambda t: (F.size(t["grams"]) >= F.size(p) * reach) & (F.size(p) >= F.size(t["grams"]) * reach)),
                lambda t: F.struct((2.0 * F.size(F.array_intersect(p, t["grams"])) / (F.size(p) + F.size(t["grams"]))).alias("dice"), (-t["k"]).alias("k")),
            ),
            lambda m: m["dice"] >= least,
        ),
    )
    rows = rows.select(id_col, "text", F.flatten(matched).alias("matched"))
    if runs:
        # the bigrams of the whole in their order; a text of one word has none
        rows = rows.withColumn("words", of_text(text)).withColumn("grams", F.when(F.size("words") > 1, in_order(F.col("words"))))
        every = F.array(*[F.lit(g) for g in sorted(set().union(*[bigrams(x) for _, x in known]))])
        rows = rows.withColumn("shared", F.when(F.size("grams") > 0, F.array_intersect("grams", every)))
        by_unit = F.coalesce("matched", F.array().cast("array<struct<dice:double,k:int>>"))
        more = F.filter(_in_runs(F.col("grams"), F.col("shared"), known, least), lambda r: ~F.exists(by_unit, lambda m: m["k"] == r["k"]))
        rows = rows.select(id_col, F.when(F.size("shared") > 0, F.concat(by_unit, more)).otherwise(F.col("matched")).alias("matched"))
    best = F.array_max("matched")
    names = F.array(*[F.lit(name) for name, _ in known])
    rows = rows.withColumn("best", best)
    return rows.select(
        id_col,
        F.get(names, -F.col("best.k")).alias("license"),
        (-F.col("best.k")).cast("int").alias("template"),
        F.coalesce("best.dice", F.lit(0.0)).alias("dice"),
        F.coalesce(F.when(F.size("matched") >= 0, F.size("matched")), F.lit(0)).cast("long").alias("n_matches"),
    )

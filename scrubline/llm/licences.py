"""Licence scans by Dice coefficient over word bigrams, with DataFrame functions only.

``licence_matches`` compares units.  Units are whole documents (line 0) and their lines.  Units and templates are
normalised to lower-case words of ASCII letters and digits.  The coefficient is
2 * common / (n + m) over bigrams with repeats, so it can only reach ``least`` if
the numbers of bigrams n and m are within a factor of (2 - least) / least; a unit
outside that range of every template is left out by its word count alone.  The
bigrams of the others are joined with those of the templates, a fixed table, and
only those that a template has are counted further, per unit and template.

``licence_passages`` compares every run of a document's words, whatever its lines,
so it also finds texts that are wrapped or embedded and notices within a sentence.
Only documents with one of the ``anchors`` are looked at: words of each template in
so many of its bigrams that no run can reach ``least`` without one.  Of their bigrams
those of a template are kept with their places; a run that begins and ends with such
a bigram is never worse than a longer one around it.  Of overlapping runs of one
template the best is taken, then the earliest, then the shortest.

Defined cases: null, empty and very short units match nothing; a unit may match
several templates; rows that are repeated are units of their own; a null identifier
is kept; an empty table gives an empty result; further columns do not matter.
"""

from __future__ import annotations

import re
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty

LEAST = 0.8
_BSD_CONDITIONS = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)


def _gnu_notice(name: str, version: object) -> str:
    return (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the {name} as "
        f"published by the Free Software Foundation, either version {version} of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        f"even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more "
        f"details. You should have received a copy of the {name} along with this program. If not, see "
        "<https://www.gnu.org/licenses/>."
    )


# Notices and texts of public licences.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "mit-line": "Released under the MIT License.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        'IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: " + _BSD_CONDITIONS + _BSD_DISCLAIMER
    ),
    "bsd-3-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: " + _BSD_CONDITIONS + "3. Neither the name of the copyright holder nor the names of "
        "its contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission. " + _BSD_DISCLAIMER
    ),
    "gpl-2.0-notice": _gnu_notice("GNU General Public License", 2),
    "gpl-3.0-notice": _gnu_notice("GNU General Public License", 3),
    "lgpl-2.1-notice": _gnu_notice("GNU Lesser General Public License", "2.1").replace("program", "library"),
    "lgpl-3.0-notice": _gnu_notice("GNU Lesser General Public License", 3),
    "agpl-3.0-notice": _gnu_notice("GNU Affero General Public License", 3),
    "cc0-1.0-notice": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights "
        "to this software to the public domain worldwide. This software is distributed without any warranty. You should "
        "have received a copy of the CC0 Public Domain Dedication along with this software. If not, see "
        "<http://creativecommons.org/publicdomain/zero/1.0/>."
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the "
        "author or authors of this software dedicate any and all copyright interest in the software to the public domain. "
        "We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. "
        "We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to "
        'this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR '
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
        "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
        "OTHER DEALINGS IN THE SOFTWARE."
    ),
}


def plain_words(text: Column) -> Column:
    """Lower-case words of ASCII letters and digits."""
    plain = F.lower(F.regexp_replace(text_or_empty(text), "[^A-Za-z0-9]+", " "))
    return F.array_remove(F.split(plain, " "), "")


def _bigrams(word: Column) -> Column:
    n = F.size(word) - 1
    return F.when(n > 0, F.zip_with(F.slice(word, 1, n), F.slice(word, 2, n), lambda a, b: F.concat_ws(" ", a, b)))


def template_bigrams(spark, templates: dict[str, str]) -> DataFrame:
    """``licence``, ``m`` (its bigrams), ``bigram`` and ``k`` (how often)."""
    rows = spark.createDataFrame(list(templates.items()), "licence string, text string")
    rows = rows.withColumn("b", _bigrams(plain_words(F.col("text")))).withColumn("m", F.size("b"))
    return rows.select("licence", "m", F.explode("b").alias("bigram")).groupBy("licence", "m", "bigram").agg(F.count(F.lit(1)).alias("k"))


def licence_matches(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST, templates: dict[str, str] | None = None
) -> DataFrame:
    """Identifier, ``line`` (0: the whole document), ``licence`` and ``dice`` of every
    unit that a template matches with at least ``least``."""
    known = template_bigrams(docs.sparkSession, templates or TEMPLATES)
    # as many rows as there are templates, which are a fixed table; never the corpus
    sizes = sorted(r["m"] for r in known.select("licence", "m").distinct().collect())
    ratio = (2 - least) / least

    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("at"), F.col(text_col).alias("text"))
    lines = F.split(text_or_empty(F.col("text")), "\n")
    # the generator makes the words of each unit once; a filter on them would repeat it
    parts = F.transform(F.concat(F.array(text_or_empty(F.col("text"))), lines), plain_words)
    word = rows.select("id", "at", F.posexplode(parts).alias("line", "w")).withColumn("n", F.size("w") - 1)
    near = F.lit(False)
    for m in sizes:
        near = near | ((F.col("n") * ratio >= m) & (F.col("n") <= m * ratio))
    found = (
        word.filter(near)
        .select("id", "at", "line", "n", F.explode(_bigrams(F.col("w"))).alias("bigram"))
        .join(F.broadcast(known), "bigram")
        .filter((F.col("n") * ratio >= F.col("m")) & (F.col("n") <= F.col("m") * ratio))
        .groupBy("id", "at", "line", "n", "licence", "m", "bigram", "k")
        .agg(F.count(F.lit(1)).alias("c"))
        .groupBy("id", "at", "line", "n", "licence", "m")
        .agg(F.sum(F.least("c", "k")).alias("common"))
    )
    dice = 2.0 * F.col("common") / (F.col("n") + F.col("m"))
    return found.withColumn("dice", F.round(dice, 6)).filter(dice >= least).select(F.col("id").alias(id_col), "line", "licence", "dice")


def anchors(templates: dict[str, str], least: float) -> list[str]:
    """Words of which every run that reaches ``least`` with a template has one: the
    longest words of each, until fewer bigrams are without them than a run must share."""
    found = set()
    for text in templates.values():
        word = re.sub("[^A-Za-z0-9]+", " ", text).lower().split()
        grams = list(zip(word, word[1:]))
        shared = ceil(len(grams) * least / (2 - least))
        for longest in sorted(set(word), key=lambda w: (-len(w), w)):
            if sum(not found & {*g} for g in grams) < shared:
                break
            found.add(longest)
    return sorted(found)


def licence_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST, templates: dict[str, str] | None = None
) -> DataFrame:
    """Identifier, ``start`` (the first word's number, from 1), ``words``, ``licence`` and
    ``dice`` of the runs of words that a template matches with at least ``least``."""
    templates = templates or TEMPLATES
    # rounding may lift a coefficient to ``least``
    ratio = (2 - least + 1e-6) / (least - 1e-6)
    known = template_bigrams(docs.sparkSession, templates)
    asked = F.array(*map(F.lit, anchors(templates, least - 1e-6)))
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("at"), F.col(text_col).alias("text"))
    # the generator makes the words of each document once; a filter on them would repeat it
    word = rows.select("id", "at", F.explode(F.array(plain_words(F.col("text")))).alias("w")).filter(F.arrays_overlap("w", asked))
    hit = F.struct("pos", "bigram", "k")
    hits = (
        word.select("id", "at", F.posexplode(_bigrams(F.col("w"))).alias("pos", "bigram"))
        .join(F.broadcast(known), "bigram")
        .groupBy("id", "at", "licence", "m")
        .agg(F.sort_array(F.collect_list(hit)).alias("hits"))
        .withColumn("need", F.ceil(F.col("m") / ratio).cast("int"))
        .withColumn("most", F.floor(F.col("m") * ratio).cast("int"))
        .filter(F.size("hits") >= F.col("need"))
    )
    # a run begins where enough of the template's bigrams follow within the longest run
    first = F.filter(
        F.sequence(F.lit(1), F.size("hits") - F.col("need") + 1),
        lambda i: F.element_at("hits", (i + F.col("need") - 1).cast("int"))["pos"] - F.element_at("hits", i)["pos"] < F.col("most"),
    )
    runs = hits.withColumn("i", F.explode(first)).withColumn("start", F.element_at("hits", F.col("i"))["pos"])
    runs = runs.select("id", "at", "licence", "m", "most", "start", F.explode(F.slice("hits", F.col("i"), F.col("most"))).alias("hit"))
    runs = runs.select("*", "hit.*").filter(F.col("pos") - F.col("start") < F.col("most"))
    own = Window.partitionBy("at", "licence", "start")
    nth = F.row_number().over(Window.partitionBy("at", "licence", "start", "bigram").orderBy("pos"))
    common = F.sum(F.when(F.col("nth") <= F.col("k"), 1).otherwise(0)).over(own.orderBy("pos"))
    n = F.col("pos") - F.col("start") + 1
    dice = F.round(2.0 * common / (n + F.col("m")), 6)
    good = runs.withColumn("nth", nth).withColumn("dice", dice).withColumn("n", n).filter(F.col("dice") >= least)
    ranked = good.groupBy("id", "at", "licence").agg(F.sort_array(F.collect_list(F.struct((-F.col("dice")).alias("rank"), "start", "n"))).alias("runs"))
    taken = F.aggregate(
        "runs",
        F.slice("runs", 1, 0),
        lambda held, x: F.when(
            # n bigrams have n + 1 words
            F.exists(held, lambda y: (x["start"] <= y["start"] + y["n"]) & (y["start"] <= x["start"] + x["n"])), held
        ).otherwise(F.concat(held, F.array(x))),
    )
    return ranked.select("id", "licence", F.explode(taken).alias("run")).select(
        F.col("id").alias(id_col), (F.col("run.start") + 1).alias("start"), (F.col("run.n") + 1).alias("words"), "licence", (-F.col("run.rank")).alias("dice")
    )

"""Licence scans: Dice coefficient over word bigrams, in DataFrame operations.

Texts are normalised (lower case, everything but letters and digits becomes one space) and compared with
licence templates by ``2 |A and B| / (|A| + |B|)`` over word bigrams, B a template's set of ``m`` of them.

``find`` looks anywhere in a text, across lines and inside sentences. A passage begins at a bigram that the template has
and ends at the last such bigram within ``m`` positions; A is its positions, and what it shares counts once each. A passage
can reach the threshold t only with ``t / (2 - t) * m`` shared bigrams. So of a text only the places of bigrams of templates are kept,
by a lookup in the set of all of them before anything is exploded; a template whose bound a text cannot meet in
any ``m`` positions is pruned, and only passages that begin at a place where it can are compared. Each template has
the best passage of a text, the first of equal ones; where passages of several templates overlap, the one that shares most bigrams stays.

``scan`` compares each line as a whole. Sizes no template allows are dropped before bigrams are made, and the
sets' sizes bound each pair.

Templates are broadcast; ``MAX_BIGRAMS`` bounds them.

Defined results: null and empty texts match nothing, a passage of one word has no bigram. Ties
between templates go to the higher coefficient, then to the first name. Rows with equal id are scanned each. An empty table or no
templates give no rows. Texts of any length are read whole; what is gathered for a text and a template are the places of its bigrams there.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclerlake.llm.common import whole_text

THRESHOLD = 0.8
MAX_BIGRAMS = 100_000

# fixed values: customary notices of public licences
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Proprietary": "All rights reserved.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

# fixed values: customary texts of public licences, without names and years
TEXTS = {
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express
or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "BSD-2-Clause-text": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause-text": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors
may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE
COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS
OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "GPL-3.0-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the
hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See
the GNU General Public License for more details.""",
    "ISC-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the
above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "MIT-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "MIT-grant": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction""",
}
EVERY = TEMPLATES | TEXTS


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def words_of(text: str) -> list[str]:
    return re.sub(r"[\W_]+", " ", text.lower()).split()


def template_bigrams(templates: dict[str, str]) -> list[tuple[str, str, int]]:
    rows = []
    for name, text in templates.items():
        words = words_of(text)
        pairs = sorted({f"{a} {b}" for a, b in zip(words, words[1:])})
        rows += [(name, pair, len(pairs)) for pair in pairs]
    if len(rows) > MAX_BIGRAMS:
        raise ValueError("too many template bigrams to broadcast")
    return rows


def passages(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``row, doc_id, line, passage``: the lines of each text, numbered from 1."""
    rows = docs.select(F.col(key).alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.split(whole_text(text), "\r?\n|\r").alias("lines"))
    return rows.select("row", "doc_id", F.posexplode("lines").alias("at", "passage")).withColumn("line", F.col("at") + 1)


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, line, license, dice``: the best template of every passage that reaches the threshold."""
    spark = docs.sparkSession
    rows = template_bigrams(templates)
    known = spark.createDataFrame(rows, "license string, bigram string, template_size int")
    sizes = [n for *_, n in rows] or [0]
    least, most = threshold / (2 - threshold), (2 - threshold) / threshold
    found = passages(docs, key, text).withColumn("words", F.split(normalised(F.col("passage")), " "))
    n = F.size("words") - 1
    # repeated bigrams make a passage longer than its set; only the lower bound holds before the set is made
    found = found.where(n >= least * min(sizes))
    pairs = F.zip_with(F.slice("words", F.lit(1), n), F.slice("words", F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b))
    found = found.withColumn("bigrams", F.array_distinct(pairs)).withColumn("size", F.size("bigrams"))
    found = found.where(F.col("size").between(least * min(sizes), most * max(sizes)))
    each = found.select("row", "doc_id", "line", "size", F.explode("bigrams").alias("bigram"))
    fits = F.col("template_size").between(F.col("size") * least, F.col("size") * most)
    shared = each.join(F.broadcast(known), "bigram").where(fits)
    dice = 2 * F.count("*") / (F.first("size") + F.first("template_size"))
    scored = shared.groupBy("row", "doc_id", "line", "license").agg(dice.alias("dice")).where(F.col("dice") >= threshold)
    best = F.min(F.struct((-F.col("dice")).alias("minus"), "license")).alias("best")
    return scored.groupBy("row", "doc_id", "line").agg(best).select("doc_id", "line", F.col("best.license").alias("license"), (-F.col("best.minus")).alias("dice"))


def find(docs: DataFrame, templates: dict[str, str] = EVERY, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, license, dice, first_word, n_words``: the best passage of each template that reaches the threshold in a text.

    Words of the normalised text are numbered from 1.
    """
    spark = docs.sparkSession
    rows = template_bigrams(templates)
    names = sorted({bigram for _, bigram, _ in rows})
    number = {bigram: i for i, bigram in enumerate(names)}
    known = spark.createDataFrame([(name, bigram, number[bigram], m) for name, bigram, m in rows], "license string, bigram string, b int, m int")
    needed = F.ceil(threshold / (2 - threshold) * F.col("m") - 1e-9).cast("int")
    known = known.withColumn("needed", F.greatest(needed, F.lit(1)))

    words = F.split(normalised(whole_text(text)), " ")
    texts = docs.select(F.col(key).alias("doc_id"), F.monotonically_increasing_id().alias("row"), words.alias("words")).where(F.size("words") > 1)

    def bigram(i: Column) -> Column:
        return F.concat_ws(" ", F.get("words", i), F.get("words", i + 1))

    at = F.filter(F.sequence(F.lit(0), F.size("words") - 2), lambda i: bigram(i).isin(names) if names else F.lit(False))
    places = texts.select("doc_id", "row", F.transform(at, lambda i: F.struct(i.alias("p"), bigram(i).alias("bigram"))).alias("places"))
    # few bigrams of a text are in any template, so little is exploded and joined
    each = places.select("doc_id", "row", F.inline("places")).join(F.broadcast(known), "bigram")
    met = each.groupBy("row", "doc_id", "license", "m", "needed").agg(F.sort_array(F.collect_list(F.struct("p", "b"))).alias("met"))
    met = met.where(F.size("met") >= F.col("needed"))
    last = F.size("met") - F.col("needed")
    begins = F.filter(F.sequence(F.lit(0), last), lambda i: F.get("met", i + F.col("needed") - 1)["p"] - F.get("met", i)["p"] < F.col("m"))

    def passage(i: Column) -> Column:
        start = F.get("met", i)["p"]
        inside = F.filter(F.slice("met", i + 1, F.col("m")), lambda e: e["p"] < start + F.col("m"))
        shared = F.size(F.array_distinct(F.transform(inside, lambda e: e["b"])))
        length = F.element_at(inside, -1)["p"] - start + 1
        return F.struct((2 * shared / (length + F.col("m"))).alias("dice"), (-start).alias("minus"), length.alias("length"), shared.alias("shared"))

    best = F.array_max(F.transform(begins, passage))
    found = met.withColumn("best", best).where(F.col("best.dice") >= threshold)
    # at most one passage per template
    order = F.struct((-F.col("best.shared")).alias("shared"), (-F.col("best.dice")).alias("dice"), "license")
    found = found.select("row", "doc_id", F.struct(order.alias("order"), (-F.col("best.minus")).alias("start"), F.col("best.length").alias("length")).alias("hit"))
    hits = found.groupBy("row", "doc_id").agg(F.collect_list("hit").alias("hits"))

    def beaten(h: Column) -> Column:
        return F.exists("hits", lambda g: (g["order"] < h["order"]) & (g["start"] < h["start"] + h["length"]) & (h["start"] < g["start"] + g["length"]))

    kept = hits.select("doc_id", F.explode(F.filter("hits", lambda h: ~beaten(h))).alias("hit"))
    dice = -F.col("hit.order.dice")
    return kept.select("doc_id", F.col("hit.order.license").alias("license"), dice.alias("dice"), (F.col("hit.start") + 1).alias("first_word"), (F.col("hit.length") + 1).alias("n_words"))

"""Licence scans: Dice coefficient over word bigrams (DataFrame functions only).

A text is normalised (lower case, anything but letters and digits becomes a
space) and taken apart into units: the whole text, its paragraphs and its
lines. Notices inside longer lines are found by windows of a template's own
length, placed where bigrams of the template fall. The Dice coefficient of two bags of bigrams can only reach the threshold
if their sizes lie within a factor of each other, so units whose size fits no
template are dropped before their bigrams are formed, and templates outside a
unit's bounds before anything is counted. Shared bigrams are found through an
inverted index of the templates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.sinks.tables import materialize

# Common licence notices and grants, by SPDX identifier.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                         "General Public License as published by the Free Software Foundation, either version 3 of the "
                         "License, or (at your option) any later version."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met: 1. Redistributions of source code must retain the "
                     "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
                     "binary form must reproduce the above copyright notice, this list of conditions and the following "
                     "disclaimer in the documentation and/or other materials provided with the distribution. "
                     "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
                     "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
                     "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
                     "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
                     "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
                     "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER "
                     "IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF "
                     "THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met: 1. Redistributions of source code must retain the "
                     "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
                     "binary form must reproduce the above copyright notice, this list of conditions and the following "
                     "disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither "
                     "the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                     "products derived from this software without specific prior written permission. "
                     "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
                     "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
                     "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
                     "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
                     "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
                     "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER "
                     "IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF "
                     "THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
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
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
]
NOT_WORD = r"[^\p{L}\p{N}\n]+"
THRESHOLD = 0.8


def templates_frame(spark: SparkSession, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """The templates as ``(template, license, body)``."""
    return spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(templates)],
                                 "template int, license string, body string")


def normalised(text: Column) -> Column:
    """Lower case; runs of anything but letters, digits and line ends become one space."""
    return F.regexp_replace(F.lower(text), NOT_WORD, " ")


def bigrams(ws: Column) -> Column:
    """Word bigrams of an array column; none of fewer than two words."""
    n = F.greatest(F.size(ws) - 1, F.lit(0))
    return F.zip_with(F.slice(ws, F.lit(1), n), F.slice(ws, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))


def once(value: Column) -> Column:
    """``value`` as a generated column: computed once, where a projection would be repeated for every use."""
    return F.explode(F.array(value))


def scan(df: DataFrame, templates: DataFrame, *, id_col: str = "doc_id", text: str = "text",
         threshold: float = THRESHOLD, index_limit: int = 500_000) -> DataFrame:
    """Licence notices found: one row per document, unit and licence.

    Returns ``doc_id``, ``unit`` (text, paragraph, line or window), ``place`` (from 0,
    in the document, for paragraphs and lines; a window's first word), ``license`` and ``dice``: twice
    the shared word bigrams (repeats counted) over the sum of both sides', for
    the licence's best template, where it is at least ``threshold`` (over 0).
    A text of one line is one unit ``line``; paragraphs are only looked at where
    a blank line parts them. A window has as many words as a template (fewer at
    the end of a text) and begins with one of its bigrams; windows are given for licences that
    no other unit of the text has, the best one (the first of equals) among those that begin
    within the longest template's length of each other.

    Null and empty texts, and units of fewer than two words, match nothing; nor
    do templates of fewer than two words or with a null body. Repeated rows are
    scanned each and give repeated results; a null id stays null. Other columns
    are ignored. Empty tables: no rows. ``templates`` has ``template``,
    ``license`` and ``body``; their sizes are read by the driver (a pair of bounds
    per distinct size). Their bigrams are the index that units are joined with,
    broadcast if there are at most ``index_limit`` of them.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be over 0 and at most 1")
    least = threshold / (2 - threshold)
    flat = F.trim(F.translate(normalised(F.col("body")), "\n", " "))
    t = (templates.where("body is not null")
         .select("template", "license", bigrams(F.filter(F.split(flat, " "), lambda w: w != "")).alias("grams"))
         .where("size(grams) > 0").withColumn("n_t", F.size("grams")))
    index = (t.select("template", "license", "n_t", F.explode("grams").alias("gram"))
             .groupBy("template", "license", "n_t", "gram").agg(F.count("*").alias("c_t")))
    counts = t.groupBy("n_t").agg(F.count("*").alias("k")).collect()
    sizes = [r["n_t"] for r in counts]
    if sum(r["n_t"] * r["k"] for r in counts) <= index_limit:
        index = F.broadcast(index)

    def fits(n: Column) -> Column:  # some template is within reach of n bigrams
        ok = F.lit(False)
        for low, high in _merged([(s * least, s / least) for s in sizes]):
            ok = ok | n.between(low - 1e-9, high + 1e-9)
        return ok

    docs = (df.where(F.col(text).isNotNull()).withColumn("__row", F.monotonically_increasing_id())
            .select("__row", F.col(id_col).alias("doc_id"), once(normalised(F.col(text))).alias("norm"))
            .withColumnRenamed("__row", "row"))

    def sized(units: str, kind: str) -> str:  # words are parted by single spaces here
        return (f"transform({units}, (x, i) -> struct('{kind}' as unit, cast(i as int) as place, trim(x) as body, "
                f"length(trim(x)) - length(replace(x, ' ', '')) as n))")

    paragraphs = "transform(split(norm, '\\n[ \\n]*\\n'), x -> regexp_replace(x, '[ \\n]+', ' '))"
    lines = docs.select("row", "doc_id", "norm", once(F.expr(sized("split(norm, '\\n')", "line"))).alias("lines"))
    # a text has as many words as its lines; it is only joined to one unit if their number fits
    total = F.expr("aggregate(lines, -1, (s, x) -> s + if(x.body = '', 0, cast(x.n as int) + 1))")
    whole = F.when((F.size("lines") > 1) & fits(F.col("total")), F.expr(sized(
        "array(regexp_replace(norm, '[ \\n]+', ' '))", "text")))
    parts = F.when(F.col("norm").rlike("\\n *\\n"), F.expr(sized(paragraphs, "paragraph")))
    units = (lines.select("row", "doc_id", "norm", "lines", once(total).alias("total"))
             .select("row", "doc_id", F.explode(F.concat("lines", F.coalesce(parts, F.expr("slice(lines, 1, 0)")),
                                                         F.coalesce(whole, F.expr("slice(lines, 1, 0)")))).alias("u"))
             .select("row", "doc_id", "u.unit", "u.place", "u.n", "u.body").where((F.col("n") > 0) & fits(F.col("n"))))
    shared = (units.select("row", "doc_id", "unit", "place", "n", once(F.split("body", " ")).alias("ws"))
              .select("row", "doc_id", "unit", "place", "n", F.explode(bigrams(F.col("ws"))).alias("gram"))
              .join(index, "gram")
              .where((F.col("n") >= F.col("n_t") * least - 1e-9) & (F.col("n") <= F.col("n_t") / least + 1e-9))
              .groupBy("row", "doc_id", "unit", "place", "license", "template", "n", "n_t", "gram", "c_t")
              .agg(F.count("*").alias("c"))
              .groupBy("row", "doc_id", "unit", "place", "license", "template", "n", "n_t")
              .agg(F.sum(F.least("c", "c_t")).alias("both")))
    dice = 2 * F.col("both") / (F.col("n") + F.col("n_t"))
    found = materialize(shared.withColumn("dice", dice).where(F.col("dice") >= threshold)
                        .groupBy("row", "doc_id", "unit", "place", "license").agg(F.max("dice").alias("dice")), "licenses")
    inside = _windows(docs, t, index, threshold).join(found.select("row", "license").distinct(), ["row", "license"], "left_anti")
    return found.drop("row").unionByName(inside.select("doc_id", F.lit("window").alias("unit"), "place", "license", "dice"))


def _windows(docs: DataFrame, t: DataFrame, index: DataFrame, threshold: float) -> DataFrame:
    """The best windows by licence: ``row, doc_id, license, place, dice``.

    A window shares at least ``least`` of a template's bigrams, so it holds one of any ``n_t - need + 1`` of them:
    texts without the longer word of any of those, taken by length, are passed over. Bigram matches
    are put in buckets as long as the template; a window lies in two neighbouring ones, so
    a pair of buckets with too few matches holds none, and the others have at most two lengths of matches.
    """
    need = F.ceil(F.col("n_t") * (threshold / (2 - threshold)) - 1e-9)
    telling = (t.select("n_t", need.alias("need"), F.expr(
        "slice(reverse(array_sort(transform(grams, g -> array_max(transform(split(g, ' '), w -> struct(length(w) as n, w as w)))))), "
        f"1, int(n_t - ceil(n_t * {threshold / (2 - threshold)} - 1e-9) + 1)).w").alias("ws"))
        .agg(F.array_distinct(F.flatten(F.collect_list("ws"))).alias("ws"), F.max("n_t").alias("most")).first())
    if not telling["ws"]:
        return docs.select("row", "doc_id", F.lit("").alias("license"), F.lit(0).alias("place"), F.lit(0.0).alias("dice")).limit(0)
    words = F.array(*[F.lit(w) for w in telling["ws"]])  # at most as many as the templates have
    ws = docs.select("row", "doc_id", once(F.expr("filter(split(translate(norm, '\n', ' '), ' '), w -> w <> '')")).alias("ws"))
    grams = (ws.where(F.arrays_overlap("ws", words)).withColumn("n_doc", F.size("ws") - 1)
             .select("row", "doc_id", "n_doc", F.posexplode(bigrams(F.col("ws"))).alias("pos", "gram")))
    hits = (grams.join(index, "gram").withColumn("own", F.expr("int(pos div n_t)"))
            .withColumn("bucket", F.explode(F.expr("array(own, own - 1)"))))
    pairs = (hits.groupBy("row", "doc_id", "n_doc", "template", "license", "n_t", "bucket")
             .agg(F.collect_list(F.struct("pos", "gram", "c_t")).alias("hits"))  # at most 2 * n_t
             .where(F.size("hits") >= need))
    starts = (pairs.withColumn("p", F.explode(F.expr("transform(filter(hits, h -> h.pos div n_t = bucket), h -> h.pos)")))
              .withColumn("hits", F.expr("filter(hits, h -> h.pos >= p and h.pos < p + n_t)"))
              .withColumn("n", F.least("n_t", F.col("n_doc") - F.col("p"))).where(F.size("hits") >= need))
    key = ["row", "doc_id", "license", "template", "n_t", "p", "n"]
    scored = (starts.select(*key, F.explode("hits").alias("h")).groupBy(*key, "h.gram", "h.c_t").agg(F.count("*").alias("c"))
              .groupBy(*key).agg(F.sum(F.least("c", "c_t")).alias("both"))
              .withColumn("dice", 2 * F.col("both") / (F.col("n") + F.col("n_t"))).where(F.col("dice") >= threshold)
              .groupBy("row", "doc_id", "license", "p").agg(F.max("dice").alias("dice")))
    most = int(telling["most"])
    near = Window.partitionBy("row", "license").orderBy("p").rangeBetween(-most, most)
    best = F.max(F.struct("dice", (-F.col("p")).alias("q"))).over(near)
    return (scored.withColumn("best", best).where((F.col("best.dice") == F.col("dice")) & (F.col("best.q") == -F.col("p")))
            .select("row", "doc_id", "license", F.col("p").alias("place"), "dice"))


def _merged(spans: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out

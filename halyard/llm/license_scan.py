"""License scans by diagonal voting.

Templates are license phrases, whole license texts and the notices that files carry, as a table of (label, text); a
caller may pass more.  Every rolling 3-word hash of a text that is a template's hash becomes a row (word place, hash, the
words), and a Spark join with the template positions gives votes: the offset diagonal, place in the text minus place in the template.  Votes are aggregated by (text, template, diagonal);
neighbouring diagonals (up to 2 apart: a word added or left out) merge into a span.  The join compares the
words as well as the hash, so every vote is verified; a span counts if it is no longer than one and a half
templates and its distinct template positions are all of a short template's, or 60 % of a longer one's, so a license
text keeps its label with one word in twenty changed.

A base phrase stands where one diagonal has all of the phrase's votes: its words are consecutive there.

Texts are lower-cased in A-Z only.  Null texts are empty: no words, no labels, score 0.  Repeated rows are
scanned row by row; an empty table gives an empty result.  A text without a label has empty label strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from halyard.session import cut_lineage

K = 3              # words of a hash; no template is shorter
SHORT = 8          # templates of fewer positions must be whole: they differ from each other in a word
COVER = 0.6        # share of a longer template's positions that a span needs
NEAR = 2           # diagonals that merge
SPREAD = 1.5       # longest span, in templates
LISTED = 5_000     # template hashes that are tested inside the row; with more, all k-grams go to the join

# The base phrases and their labels.
BASE = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]

# Further phrases of well-known licenses.
MORE = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "you may not use this file except in compliance with the license"),
    ("gpl-2", "gnu general public license version 2"),
    ("gpl-3", "gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl-3", "gnu affero general public license version 3"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("reserved", "all rights reserved"),
]

# Whole license texts and file notices.
TEXTS = [
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS
BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS
ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE
LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND
CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF
USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
DAMAGE."""),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any
damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial
applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be
misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the
product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be
misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by
any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in
the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and
successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software
under copyright law."""),
    ("apache-2", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either
express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("gpl-3", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed
in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with
this program. If not, see https://www.gnu.org/licenses/."""),
]

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """Lower-cases a text without turning another character into a-z.

    Of all characters only the Kelvin sign and the dotted capital I have a lower case that starts in ASCII;
    they are put aside first.
    """
    aside = F.replace(F.replace(text, F.lit("K"), F.lit("")), F.lit("İ"), F.lit(""))
    return F.lower(aside)


def split_words(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), lambda w: w != "")


def template_positions(spark: SparkSession, more: DataFrame | None = None) -> DataFrame:
    """One row a template position: t, label, base, size (positions), at, words, hash; written once.

    ``more``: a table (label, text) of further templates; those of fewer than K words have no position.
    """
    own = [(t, label, text) for t, (label, text) in enumerate(BASE + MORE + TEXTS)]
    all_ = spark.createDataFrame(own, "t long, label string, text string")
    if more is not None:
        all_ = all_.unionByName(more.select((F.monotonically_increasing_id() + len(own)).alias("t"), "label", "text"))
    w = all_.select("t", "label", (F.col("t") < len(BASE)).alias("base"), split_words(F.col("text")).alias("w")) \
        .withColumn("size", F.size("w") - (K - 1)).where("size > 0")
    p = w.select("t", "label", "base", "size", "w", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("at"))
    return cut_lineage(p.select("t", "label", "base", "size", "at", F.array_join(F.slice("w", F.col("at") + 1, K), " ").alias("words"))
                       .withColumn("hash", _hash(F.split("words", " "), F.lit(0))), "templates")


def _hash(words: Column, i: Column) -> Column:
    return F.xxhash64(*[F.get(words, i + j) for j in range(K)])


def marked(docs: DataFrame, templates: list | None, text: str = "text") -> DataFrame:
    """row (unique), doc_id, n_words and the text's k-grams whose hash is a template's; written once.

    Up to LISTED hashes the join's filter runs inside the row, over all rolling k-grams (first word, then hash), so only
    matches become rows; without a list (None) every k-gram goes to the join.
    """
    d = docs.select("doc_id", split_words(F.col(text)).alias("_w"))
    d = d.withColumn("n_words", F.size("_w").cast("long"))
    places = F.when(F.col("n_words") >= K, F.sequence(F.lit(0), (F.col("n_words") - K).cast("int"))).otherwise(F.array().cast("array<int>"))
    words = F.col("_w")
    if templates is not None:
        hashes, firsts = sorted({t["hash"] for t in templates}), sorted({t["words"].split()[0] for t in templates})
        places = F.filter(places, lambda i: F.get(words, i).isin(*firsts) & _hash(words, i).isin(*hashes))
    grams = F.transform(places, lambda i: F.struct(i.alias("place"), F.array_join(F.slice(words, i + 1, K), " ").alias("words")))
    return cut_lineage(d.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_words", grams.alias("grams")), "licenses")


def votes(rows: DataFrame, templates: DataFrame) -> DataFrame:
    """Per (row, t, diagonal): the template positions that voted, and the first and last place."""
    grams = rows.select("row", F.explode("grams").alias("g")) \
        .select("row", "g.place", "g.words", _hash(F.split("g.words", " "), F.lit(0)).alias("hash"))
    joined = grams.join(templates, ["hash", "words"])  # Spark broadcasts a small template table
    return joined.groupBy("row", "t", "label", "base", "size", (F.col("place") - F.col("at")).alias("diagonal")) \
        .agg(F.collect_set("at").alias("ats"), F.min("place").alias("low"), F.max("place").alias("high"))


def spans(voted: DataFrame) -> DataFrame:
    """Neighbouring diagonals merged: row, t, label, base, cover (share of the template), first, last, whole."""
    order = Window.partitionBy("row", "t").orderBy("diagonal")
    fresh = (F.col("diagonal") - F.lag("diagonal").over(order) > NEAR).cast("int")
    run = voted.withColumn("span", F.sum(F.coalesce(fresh, F.lit(0))).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = run.groupBy("row", "t", "label", "base", "size", "span").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("n"), F.min("low").alias("first"), (F.max("high") + K).alias("end"))
    return merged.select("row", "t", "label", "base", (F.col("n") / F.col("size")).alias("cover"), "first", "end",
                         (F.col("n") >= F.when(F.col("size") < SHORT, F.col("size")).otherwise(COVER * F.col("size"))).alias("enough"),
                         (F.col("end") - F.col("first") <= SPREAD * (F.col("size") + K - 1)).alias("close"))


def scan(spark: SparkSession, docs: DataFrame, text: str = "text", more: DataFrame | None = None) -> DataFrame:
    """One row a document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``more``: further templates (label, text).
    """
    templates = template_positions(spark, more)
    listed = templates.select("hash", "words").distinct().limit(LISTED + 1).collect()
    rows = marked(docs, listed if len(listed) <= LISTED else None, text)
    voted = votes(rows, templates)
    whole = voted.where("base and size(ats) = size").groupBy("row").agg(
        F.count(F.lit(1)).alias("n_base"), F.min("diagonal").alias("first_word"), F.max("diagonal").alias("last_word"),
        F.sort_array(F.collect_set("label")).alias("own"))
    found = spans(voted).groupBy("row").agg(
        F.max(F.when(F.col("close"), F.col("cover"))).alias("score"),
        F.sort_array(F.collect_set(F.when(F.col("close") & F.col("enough"), F.col("label")))).alias("more"))
    none = F.array().cast("array<string>")
    return rows.select("row", "doc_id", "n_words").join(whole, "row", "left").join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.array_join(F.coalesce("own", none), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(F.coalesce("own", none), F.coalesce("more", none)))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("score", F.lit(0.0))).alias("score"))

"""License scan by diagonal voting (native).

All rolling K-word hashes of a text are joined to the positions that the same hashes have in license templates
(a fixed list, so its broadcast is bounded). A hit at word p of the text and word q of a template votes for the
diagonal p - q. Votes are summed by diagonal, diagonals at most MERGE apart (and less than the template has K-grams) are
merged (words were inserted or left out), and a merged span counts where it holds at least COVER of the template's K-grams,
whose words are compared one by one. Beside it, every place of the base phrases is counted.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomlake.llm.shared import shingle_hashes

K, MERGE, COVER = 3, 3, 0.75

# Base phrases and their labels.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

# Short notices of well-known public licenses, and whole texts and notices of them, by label.
NOTICES = [
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2"),
    ("agpl-3.0", "licensed under the gnu affero general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("bsd", "licensed under the bsd license"),
    ("mpl-2.0", "licensed under the mozilla public license version 2 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("cc-by-4.0", "licensed under cc by 4 0"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa-4.0", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("reserved", "all rights reserved"),
]
TEXTS = [
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
        (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do
        so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
        BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
        AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
        OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
        (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software""",
    ),
    (
        "bsd-2-clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
        following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
        following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE
        COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
    ),
    (
        "bsd-3-clause",
        """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived
        from this software without specific prior written permission.""",
    ),
    (
        "bsd",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met""",
    ),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
        that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR
        DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT
        SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS
        OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH
        THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
        You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
        writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    ),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    (
        "gpl-3.0",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    ),
    (
        "gpl-2.0",
        """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.""",
    ),
    (
        "gpl",
        """you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software
        Foundation""",
    ),
    (
        "lgpl",
        """you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free
        Software Foundation""",
    ),
    (
        "agpl-3.0",
        """you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free
        Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    ),
    (
        "mpl-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with
        this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    (
        "zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any
        damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including
        commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this
        software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product,
        an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly
        marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any
        source distribution.""",
    ),
    (
        "bsl-1.0",
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying
        documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software,
        and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so""",
    ),
    (
        "unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
        sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
        non-commercial, and by any means.""",
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc0-1.0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain"),
]


def _template_words(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text.lower())


#: (label, words) of all templates.
TEMPLATES = [(label, _template_words(text)) for label, text in NOTICES + TEXTS]

#: What separates words: all ASCII characters but digits and letters.
_OUTSIDE = r"[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_WORDS = f"filter(split(coalesce(text, ''), '{_OUTSIDE}'), w -> w <> '')"


def _template_grams(spark: SparkSession) -> DataFrame:
    rows = [
        (t, label, q, words[q : q + K], len(words) - K + 1)
        for t, (label, words) in enumerate(TEMPLATES)
        for q in range(len(words) - K + 1)
    ]
    grams = spark.createDataFrame(rows, "template int, label string, q int, gram array<string>, n_grams int")
    return grams.withColumn("hash", shingle_hashes("gram", K)[0])


def license_spans(docs: DataFrame) -> DataFrame:
    """(row, doc_id, label, template, first_word, last_word, cover): verified spans of templates in texts."""
    grams = F.broadcast(_template_grams(docs.sparkSession))
    words = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), F.expr(f"transform({_WORDS}, w -> lower(w))").alias("words"))
    hashed = words.select("doc_id", "row", "words", shingle_hashes("words", K).alias("hashes"))
    hits = (
        hashed.select("doc_id", "row", "words", F.posexplode_outer("hashes").alias("p", "hash"))
        .join(grams, "hash")
        .filter(F.slice("words", F.col("p") + 1, K) == F.col("gram"))
    )
    one = Window.partitionBy("doc_id", "row", "template").orderBy("diagonal")
    near = F.least(F.lit(MERGE), F.col("n_grams") - 1)  # notices that follow one another are further apart
    votes = hits.groupBy("doc_id", "row", "template", "label", "n_grams", (F.col("p") - F.col("q")).alias("diagonal")).agg(
        F.collect_set("q").alias("qs"), F.min("p").alias("first_word"), (F.max("p") + K - 1).alias("last_word")
    )
    spans = (
        votes.withColumn("new", (F.col("diagonal") - F.coalesce(F.lag("diagonal").over(one), F.lit(-(2**30))) > near).cast("int"))
        .withColumn("span", F.sum("new").over(one))
        .groupBy("doc_id", "row", "template", "label", "n_grams", "span")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("qs")))).alias("found"),
            F.min("first_word").alias("first_word"),
            F.max("last_word").alias("last_word"),
        )
    )
    cover = F.col("found") / F.col("n_grams")
    return spans.filter(cover >= COVER).select("row", "doc_id", "label", "template", "first_word", "last_word", cover.alias("cover"))


def _base_places(docs: DataFrame) -> DataFrame:
    """doc_id, row, n_words and the places of base phrases; places are sought only in texts that hold a phrase's words."""
    low = F.lower(F.coalesce("text", F.lit("")))
    likely = F.lit(False)
    for phrase, _ in BASE:
        every = F.lit(True)
        for w in phrase.split():
            every = every & F.contains(low, F.lit(w))
        likely = likely | every
    at = "CASE " + " ".join(
        "WHEN " + " AND ".join(f"lower({'w' if j == 0 else f'get(v, i + {j})'}) = '{w}'" for j, w in enumerate(phrase.split())) + f" THEN '{label}'"
        for phrase, label in BASE
    ) + " END"
    places = F.expr(f"transform(array(words), v -> filter(transform(v, (w, i) -> struct(i AS p, {at} AS label)), x -> x.label IS NOT NULL))[0]")
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), likely.alias("likely"), F.expr(_WORDS).alias("words"))
    return rows.select("doc_id", "row", F.size("words").cast("long").alias("n_words"), F.when(F.col("likely"), places).alias("places"))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score).

    A null text has no words. Places, labels and score are 0, null, '' and 0.0 where nothing is found. score is
    the best cover of a template, 1.0 where a base phrase stands. Rows that repeat id and text get the same values.
    """
    p = F.transform("places", lambda x: x["p"].cast("long"))
    base_labels = F.coalesce(F.array_sort(F.array_distinct(F.transform("places", lambda x: x["label"]))), F.array().cast("array<string>"))
    base = _base_places(docs).select(
        "doc_id", "row", "n_words",
        F.coalesce(F.size(p), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(p).alias("first_word"),
        F.array_max(p).alias("last_word"),
        base_labels.alias("_base"),
    )
    found = license_spans(docs).groupBy(F.col("row").alias("_row"), F.col("doc_id").alias("_doc")).agg(
        F.collect_set("label").alias("_own"), F.max("cover").alias("_cover")
    )
    own = F.coalesce("_own", F.array().cast("array<string>"))
    return base.join(found, (base["row"] == found["_row"]) & base["doc_id"].eqNullSafe(found["_doc"]), "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("_base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("_base", own)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.least(F.coalesce("_cover", F.lit(0.0)), F.lit(1.0))).alias("score"),
    )


def op10_license_scan(spark, sf_dir):
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def license_base_places(spark, sf_dir):
    """What op10 says of the base phrases, which SQL can say too."""
    found = scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


BASE_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
p AS (
  SELECT doc_id, ws, list_filter(range(len(ws)), lambda i: ws[i + 1] = 'cc' AND ws[i + 2] = 'by') AS a,
    list_filter(range(len(ws)), lambda i: ws[i + 1] = 'general' AND ws[i + 2] = 'public' AND ws[i + 3] = 'license') AS b,
    list_filter(range(len(ws)), lambda i: ws[i + 1] = 'all' AND ws[i + 2] = 'rights' AND ws[i + 3] = 'reserved') AS c FROM w
)
SELECT doc_id, len(ws) AS n_words, len(a) + len(b) + len(c) AS n_base, list_min(list_concat(a, b, c)) AS first_word, list_max(list_concat(a, b, c)) AS last_word,
  concat_ws(',', CASE WHEN len(a) > 0 THEN 'cc-by' END, CASE WHEN len(b) > 0 THEN 'gpl' END, CASE WHEN len(c) > 0 THEN 'reserved' END) AS base_labels FROM p
"""

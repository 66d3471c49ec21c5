"""Licence scan by a positional rare-token index.

The index has a posting (word, template, position) for each word of the licence texts and notices below, stop words left out. One pass over
the texts keeps the places of indexed words, and the places of key phrases, found at their rarest word. Document
frequencies over all documents give each indexed word its IDF. For each template the ``RAREST`` words of highest
IDF that a file has are looked up; a posting at position q for a word at place p votes for the template to start at p - q.
A start whose votes reach ``SUPPORT`` of the weight of the template's rarest words is a candidate, and counts if all
mandatory phrases of the template stand within ``SLACK`` words of their place.

The base labels are verified phrases of the same index; the method adds the labels of templates.

The score is 1 with a base label, else the best support of a verified template, else half the best support of an unverified
one. Ties of IDF go by the word, and of equally supported starts each is checked. Texts of any length are scanned as a whole. Nulls: a null text is empty. Rows are scanned one by one, repeated or not, with null ids or not. An empty table gives
an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from colloquy.llm.text import require
from colloquy.session import stage, work_path

RAREST, SUPPORT, SLACK = 8, 0.5, 6
#: Phrase and label.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Label, notice, mandatory phrases.
NOTICES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("mit", "Released under the MIT License", ("mit license",)),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files, to deal in the Software without restriction",
     ("permission is hereby granted free of charge", "to deal in the software without restriction")),
    ("apache", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License",
     ("apache license",)),
    ("gpl", "licensed under the GNU General Public License, version 3", ("general public license",)),
    ("gpl", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
     "as published by the Free Software Foundation", ("you can redistribute it and or modify it", "general public license")),
    ("lgpl", "licensed under the GNU Lesser General Public License", ("lesser general public license",)),
    ("agpl", "licensed under the GNU Affero General Public License", ("affero general public license",)),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met",
     ("redistribution and use in source and binary forms", "with or without modification are permitted")),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
     ("creative commons attribution noncommercial",)),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", ("cc by sa",)),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
     ("creative commons attribution sharealike",)),
    ("cc-by", "Licensed under CC BY 4.0", ("cc by 4",)),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license",)),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
     ("for any purpose with or without fee is hereby granted",)),
    ("unlicense", "This is free and unencumbered software released into the public domain",
     ("free and unencumbered software released into the public domain",)),
    # whole texts
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
     (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
     distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
     following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
     Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
     MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
     DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE
     USE OR OTHER DEALINGS IN THE SOFTWARE.""",
     ("permission is hereby granted free of charge", "shall be included in all copies or substantial portions of the software")),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are
     met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions
     in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
     materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
     promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND
     CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR
     A PARTICULAR PURPOSE ARE DISCLAIMED.""",
     ("redistributions of source code must retain the above copyright notice", "redistributions in binary form must reproduce the above copyright notice")),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the
     above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
     REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
     DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
     NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
     ("for any purpose with or without fee is hereby granted", "appear in all copies")),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages
     arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to
     alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not
     claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated
     but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This
     notice may not be removed or altered from any source distribution.""",
     ("the origin of this software must not be misrepresented", "altered source versions must be plainly marked as such")),
    ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may
     obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
     distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License
     for the specific language governing permissions and limitations under the License.""",
     ("apache license", "unless required by applicable law or agreed to in writing")),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the
     Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be
     useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
     License for more details. You should have received a copy of the GNU General Public License along with this program.""",
     ("under the terms of the gnu general public license", "you should have received a copy of the gnu general public license")),
    ("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file,
     You can obtain one at http://mozilla.org/MPL/2.0/.""", ("mozilla public license", "if a copy of the mpl was not distributed with this file")),
    ("boost", """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation
     covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of
     the Software, and to permit third-parties to whom the Software is furnished to do so""",
     ("any person or organization obtaining a copy of the software and accompanying documentation",)),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or
     distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
     ("free and unencumbered software released into the public domain", "either in source code form or as a compiled binary")),
)
#: Words that are not indexed.
STOP = frozenset("a an and any are as at be by can for from in is it may not of on or that the this to was which with you".split())
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


#: A-Z only: other letters are no licence words, whatever their lower case.
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def split_words(text: str) -> list[str]:
    return [w for w in re.split(BREAK, text.translate(LOWER)) if w]


PHRASES = tuple(dict.fromkeys([p for p, _ in BASE] + [p for _, _, needed in NOTICES for p in needed]))
VOCABULARY = tuple(sorted({w for _, notice, _ in NOTICES for w in split_words(notice)} - STOP))


def words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), "".join(map(chr, LOWER)), "".join(map(chr, LOWER.values())))
    return F.array_remove(F.split(lower, BREAK), "")


def _anchor(phrase: list[str]) -> int:
    """Place of the longest indexed word, as the one likely to be the rarest."""
    return max((i for i, w in enumerate(phrase) if w in VOCABULARY), key=lambda i: len(phrase[i]))


def _places(number: int) -> Column:
    phrase = PHRASES[number].split()
    anchor = _anchor(phrase)

    def stands(at: Column) -> Column:
        order = [anchor] + [i for i in range(len(phrase)) if i != anchor]
        return reduce(lambda a, b: a & b, [F.coalesce(F.get("w", at + (i - anchor)) == phrase[i], F.lit(False)) for i in order])

    return F.transform(
        F.filter("hit", stands), lambda at: F.struct(F.lit(number).alias("phrase"), (at - anchor).alias("start")),
    )


def indexed(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, n_words, hits, places), one row per document, stored; ``rid`` tells rows apart."""
    require(docs, "doc_id", "text")
    split = docs.select("doc_id", words(F.col("text")).alias("w"))
    every = F.when(F.size("w") > 0, F.sequence(F.lit(0), F.size("w") - 1)).otherwise(F.array().cast("array<int>"))
    hit = split.select("doc_id", "w", F.filter(every, lambda i: F.get("w", i).isin(*VOCABULARY)).alias("hit"))
    places = F.when(F.size("hit") > 0, F.flatten(F.array(*[_places(i) for i in range(len(PHRASES))])))
    rows = hit.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", F.size("w").cast("bigint").alias("n_words"),
        F.transform("hit", lambda i: F.struct(F.get("w", i).alias("word"), i.alias("at"))).alias("hits"),
        F.coalesce(places, F.array().cast("array<struct<phrase:int,start:int>>")).alias("places"),
    )
    return stage(rows, work_path(docs.sparkSession, "license-index"))


def _tables(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """Postings (word, template, q) and needs (template, label, phrase, q, needed): fixed lists of some hundred rows."""
    postings, needs = [], []
    for t, (label, notice, needed) in enumerate(NOTICES):
        tokens = split_words(notice)
        postings += [(w, t, q) for q, w in enumerate(tokens) if w not in STOP]
        for phrase in needed:
            own = phrase.split()
            q = next(i for i in range(len(tokens)) if tokens[i : i + len(own)] == own)
            needs.append((t, label, PHRASES.index(phrase), q, len(needed)))
    return (
        spark.createDataFrame(postings, "word string, template int, q int"),
        spark.createDataFrame(needs, "n_template int, label string, n_phrase int, n_q int, needed int"),
    )


def matches(index: DataFrame) -> DataFrame:
    """(rid, template, start, support, label): candidate starts; ``label`` is null where a mandatory phrase is missing."""
    spark = index.sparkSession
    postings, needs = _tables(spark)
    n = index.count()
    df = index.select(F.explode(F.array_distinct("hits.word")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    # one row per indexed word, of which there are some hundred
    listed = postings.join(F.broadcast(df), "word", "left")
    listed = listed.withColumn("idf", F.log(F.lit(n + 1.0) / (F.coalesce("df", F.lit(0)) + 1)) + F.lit(1e-6))
    by_weight = Window.partitionBy("template").orderBy(F.col("idf").desc(), "word")
    weights = listed.select("template", "word", "idf").distinct().withColumn("place", F.row_number().over(by_weight))
    weights = weights.where(F.col("place") <= RAREST).groupBy("template").agg(F.sum("idf").alias("whole"))
    listed = stage(listed.drop("df").join(weights, "template"), work_path(spark, "license-postings"))

    found = index.select("rid", F.explode("hits").alias("hit")).select("rid", "hit.word", "hit.at")
    found = found.join(F.broadcast(listed), "word")
    rarest = Window.partitionBy("rid", "template").orderBy(F.col("idf").desc(), "word")
    found = found.withColumn("place", F.dense_rank().over(rarest)).where(F.col("place") <= RAREST)
    voted = found.withColumn("start", F.col("at") - F.col("q")).groupBy("rid", "template", "start", "word", "whole").agg(F.max("idf").alias("idf"))
    voted = voted.groupBy("rid", "template", "start").agg(F.least(F.lit(1.0), F.sum("idf") / F.max("whole")).alias("support"))
    voted = voted.where(F.col("support") >= SUPPORT)

    asked = voted.join(F.broadcast(needs), F.col("template") == F.col("n_template"))
    # by stretches of the file, two of which at most hold the places looked for, so that a notice repeated over and over meets its own places only
    wide = 2 * SLACK + 1
    due = F.col("start") + F.col("n_q")
    asked = asked.withColumn("stretch", F.explode(F.sequence(F.floor((due - SLACK) / wide), F.floor((due + SLACK) / wide))))
    places = index.select(F.col("rid").alias("p_rid"), F.explode("places").alias("p")).select(
        "p_rid", "p.phrase", F.col("p.start").alias("p_start"), F.floor(F.col("p.start") / wide).alias("p_stretch"))
    near = F.abs(F.col("p_start") - due) <= SLACK
    same = (F.col("rid") == F.col("p_rid")) & (F.col("n_phrase") == F.col("phrase")) & (F.col("stretch") == F.col("p_stretch"))
    met = asked.join(places, same & near, "left")
    checked = met.groupBy("rid", "template", "start", "support", "label", "needed").agg(
        F.size(F.collect_set(F.when(F.col("p_rid").isNotNull(), F.col("n_phrase")))).alias("met"),
    )
    return checked.select("rid", "template", "start", "support", F.when(F.col("met") == F.col("needed"), F.col("label")).alias("label"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: words, places of base phrases, labels, score."""
    index = indexed(docs)
    by_row = matches(index).groupBy(F.col("rid").alias("m_rid")).agg(
        F.collect_set("label").alias("found"),
        F.max(F.when(F.col("label").isNotNull(), F.col("support")).otherwise(F.col("support") / 2)).alias("best"),
    )
    joined = index.join(by_row, F.col("rid") == F.col("m_rid"), "left")
    base = F.filter("places", lambda p: p["phrase"] < len(BASE))
    labels = F.array(*[F.lit(label) for _, label in BASE])
    joined = joined.select(
        "doc_id", "n_words", F.coalesce("found", F.array().cast("array<string>")).alias("found"), "best",
        F.transform(base, lambda p: p["start"]).alias("starts"),
        F.array_distinct(F.transform(base, lambda p: F.get(labels, p["phrase"]))).alias("base"),
    )
    return joined.select(
        "doc_id", "n_words", F.size("starts").cast("bigint").alias("n_base"),
        F.array_min("starts").cast("bigint").alias("first_word"), F.array_max("starts").cast("bigint").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", "found"))), ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )

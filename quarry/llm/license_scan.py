"""License scans by diagonal voting, in DataFrame functions only.

Every text is cut into words; the hash of each k consecutive words (k-gram) is joined to the k-grams
of the license templates, a fixed table of a few hundred rows given as a parameter. A match at word i of the text and word j of a
template votes for the offset diagonal i - j. Votes are summed per diagonal, diagonals at most GAP
apart merge into one span (insertions and deletions shift a copy by a few words), and a span is verified by the share
of the template's k-grams that it holds, each counted once. Where no span of a template holds enough alone, spans that follow each other in
the text and in the template count together, whatever stands between them. Phrases are templates that must be held without a gap: each of their pairs of words on one diagonal.

Hashes are built by doubling (pairs, then pairs of pairs), so a text costs three passes over its words and
no k-long slice is ever made. Texts are read once; hashes that are in no template are dropped before
the join, and what is left of each text (its matching hashes) is written to the shared folder. What is
shuffled are the votes, summed per task first.

Null and empty texts have no words, zero counts, empty labels and score 0. Texts that repeat row by row
give the same result for each row. Whole texts are scanned whatever their length.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, written

#: Fixed values of the contract: phrase and label.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Openings and notices of public licences with the method's own labels.
TEMPLATES = {
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "apache-notice": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl-3": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-conditions": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "mit-conditions": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-warranty": "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
    "zlib": "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely",
    "boost": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "cc-deed": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "mit-release": "Released under the MIT License.",
    "all-rights-reserved": "Copyright. All rights reserved.",
    "public-domain": "This work has been identified as being free of known restrictions under copyright law, including all related and neighboring rights",
}
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
K, GAP, SHARE = 4, 3, 0.6
HITS = "array<struct<k:int,i:int,h:bigint>>"


def _pairs(h, step: int):
    """Hash of elements i and i + step of an array of hashes, for every i that has both."""
    n = F.size(h) - step
    return F.when(n > 0, F.zip_with(F.slice(h, 1, F.greatest(n, F.lit(1))), F.slice(h, step + 1, F.greatest(n, F.lit(1))), lambda a, b: F.xxhash64(a, b))).otherwise(
        F.array().cast("array<bigint>")
    )


def grams(df: DataFrame, text: str = "text") -> DataFrame:
    """df with _h2 and _h4, the hashes of its word pairs and of its runs of four, and n_words."""
    words = F.regexp_extract_all(ascii_lower(F.coalesce(F.col(text), F.lit(""))), F.lit(WORD), F.lit(0))
    df = df.withColumn("_h1", F.transform(words, lambda w: F.xxhash64(w)))
    df = df.withColumn("_h2", _pairs(F.col("_h1"), 1)).withColumn("n_words", F.size("_h1").cast("long"))
    return df.withColumn("_h4", _pairs(F.col("_h2"), 2)).drop("_h1")


def _chained(spans: str):
    """The most votes of spans (a, z, i, j, votes; ascending) that follow each other from a to z in the template and from i to j in the text."""
    none = F.array().cast("array<struct<z:int,j:int,votes:bigint>>")

    def add(done, s):
        before = F.transform(F.filter(done, lambda c: (c["z"] < s["a"]) & (c["j"] < s["i"])), lambda c: c["votes"])
        votes = s["votes"] + F.coalesce(F.array_max(before), F.lit(0).cast("long"))
        return F.concat(done, F.array(F.struct(s["z"].alias("z"), s["j"].alias("j"), votes.alias("votes"))))

    return F.array_max(F.transform(F.aggregate(F.col(spans), none, add), lambda c: c["votes"]))


def template_grams(spark, phrases: dict[str, str], templates: dict[str, str]) -> DataFrame:
    """(h, k, name, at, n): the k-grams of all templates; texts under K words count by their pairs."""
    rows = [(t, n, True) for t, n in phrases.items()] + [(t, n, False) for n, t in templates.items()]
    df = grams(spark.createDataFrame(rows, "text string, name string, phrase boolean"))
    short = F.col("phrase") | (F.col("n_words") < K)
    df = df.withColumn("_h", F.when(short, F.col("_h2")).otherwise(F.col("_h4"))).withColumn("n", F.size("_h"))
    return df.select("name", "phrase", "n", F.when(short, 2).otherwise(K).alias("k"), F.posexplode("_h").alias("at", "h"))


def scan(df: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row."""
    spark = df.sparkSession
    known = template_grams(spark, phrases, templates).collect()  # the parameter's own rows
    table = spark.createDataFrame([(r.h, r.k, r.name, r.phrase, r.at, r.n) for r in known], "h long, k int, name string, phrase boolean, at int, n int")
    two, four = ([r.h for r in known if r.k == k] for k in (2, K))
    rows = grams(df.select(F.col(key).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("th"), F.col(text).alias("text")))

    def held(h: str, k: int, hashes: list[int]):
        """Places of the hashes that occur in a template; texts without any are passed over by one set test."""
        at = F.filter(F.transform(h, lambda x, i: F.struct(F.lit(k).alias("k"), i.alias("i"), x.alias("h"))), lambda x: x["h"].isin(hashes))
        return F.when(F.arrays_overlap(F.col(h), F.array(*map(F.lit, hashes))), at).otherwise(F.array().cast(HITS)) if hashes else F.array().cast(HITS)

    rows = written(rows.select("id", "th", "n_words", F.concat(held("_h2", 2, two), held("_h4", K, four)).alias("hits")))
    all_rows = rows.select("id", "th", "n_words")
    hits = rows.select("id", "th", F.explode("hits").alias("g")).select("id", "th", "g.k", "g.i", "g.h")
    votes = hits.join(F.broadcast(table), ["k", "h"]).withColumn("diagonal", F.col("i") - F.col("at"))
    # a repeated row votes twice for the same place: places are distinct
    place = ["id", "th", "name", "phrase", "n", "diagonal"]
    # at most n places of a template, which is a parameter
    diagonals = votes.groupBy(*place).agg(F.collect_set("at").alias("ats"), F.min("at").alias("a"), F.max("at").alias("z")).withColumn("votes", F.size("ats"))
    base = (
        diagonals.where("phrase and votes = n")
        .groupBy("id", "th")
        .agg(F.count("*").alias("n_base"), F.min("diagonal").cast("long").alias("first_word"), F.max("diagonal").cast("long").alias("last_word"), F.collect_set("name").alias("base"))
    )
    by = Window.partitionBy("id", "th", "name").orderBy("diagonal")
    spans = (
        diagonals.where("not phrase")
        .withColumn("new", (F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by), F.lit(GAP + 1)) > GAP).cast("int"))
        .withColumn("span", F.sum("new").over(by))
        .groupBy("id", "th", "name", "n", "span")
        .agg(F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).cast("long").alias("votes"), F.min("a").alias("a"), F.max("z").alias("z"), F.min(F.col("a") + F.col("diagonal")).alias("i"), F.max(F.col("z") + F.col("diagonal")).alias("j"))
        .groupBy("id", "th", "name", "n")
        .agg(F.max("votes").alias("most"), F.sum("votes").alias("all"), F.sort_array(F.collect_list(F.struct("a", "z", "i", "j", "votes"))).alias("spans"))
        .withColumn("votes", F.when((F.col("most") < SHARE * F.col("n")) & (F.col("all") >= SHARE * F.col("n")), _chained("spans")).otherwise(F.col("most")))
        .withColumn("share", F.least(F.lit(1.0), F.col("votes") / F.col("n")))
        .where(F.col("share") >= SHARE)
        .groupBy("id", "th")
        .agg(F.collect_set("name").alias("own"), F.max("share").alias("share"))
    )
    found = base.join(spans, ["id", "th"], "full").select(
        F.col("id").alias("_id"), F.col("th").alias("_th"), "n_base", "first_word", "last_word", "base", "own", "share"
    )
    none = F.array().cast("array<string>")
    both = all_rows.join(found, all_rows.id.eqNullSafe(found._id) & (all_rows.th == found._th), "left")
    labels = reduce(F.array_union, [F.coalesce("base", none), F.coalesce("own", none)])
    return both.select(
        F.col("id").alias(key),
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.array_join(F.array_sort(F.coalesce("base", none)), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        F.greatest(F.coalesce("share", F.lit(0.0)), F.when(F.col("n_base") > 0, 1.0).otherwise(0.0)).alias("score"),
    )

"""Licences of files: TF-IDF cosine of their notices to templates, then inheritance by directory.

Every line of a file, every run of up to ``RUN`` adjacent paragraphs or comment blocks, and the whole text of a
file with a licence file's name, is compared with the templates (notices, standard headers, title lines and
whole short licences); the best cosine from ``THRESHOLD`` on gives the file its licence. A file without one takes that
of the nearest ancestor directory (its own first) that has a licence file.

DataFrame functions only. Document frequencies come from all files, those of the templates' words first: a
text without any of their telling words can't reach the threshold (by the Cauchy-Schwarz bound on the rest),
so only texts with one are compared, and only the frequencies of their other words are kept, in a table joined
by word. What is broadcast by hint are the templates' words, fixed by the templates. Directories are joined
once each, not by file.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, functions as F

from stakescore import staging
from stakescore.llm.license_texts import TEXTS

THRESHOLD = 0.75
#: Paragraphs of the longest run; the longest template has five, and a blank line may cut one more.
RUN = 6

#: Usual notices of well-known licences.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([.-].*)?$"
NO_WORD = r"[^\p{L}\p{N}]+"
#: Lines without a word end a paragraph, also those of comment marks alone.
PARAGRAPH = r"\n(?:[^\p{L}\p{N}\n]*\n)+"
#: A line with a comment mark before one without ends a block.
BLOCK_END = r"(?m)^([ \t]*[#/*;%!-]+[^\n]*)\n(?=[ \t]*[\p{L}\p{N}])"


def words(text: str) -> list[str]:
    """Words of a template, as :func:`_words` finds them."""
    return re.findall(r"[^\W_]+", text.lower())


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), NO_WORD), lambda w: w != "")


def inverse_frequency(files: int, containing: int) -> float:
    return math.log((1 + files) / (1 + containing)) + 1


def telling(vectors: list[dict[str, float]], threshold: float, rank: dict[str, float] | None = None) -> set[str]:
    """Words of which a text must have one to reach the threshold with any template.

    From the least ``rank`` (or weight) on, words are left out that leave what is left out less than
    ``threshold`` of every template's norm.
    """
    norms = [math.sqrt(sum(x * x for x in v.values())) for v in vectors]
    weight = {w: max(v.get(w, 0) for v in vectors) for v in vectors for w in v}
    common = [0.0] * len(vectors)
    kept = set(weight)
    rank = rank or weight
    for word in sorted(weight, key=lambda w: (rank[w], w)):
        more = [c + v.get(word, 0) ** 2 for c, v in zip(common, vectors)]
        if any(math.sqrt(m) >= threshold * n * (1 - 1e-9) for m, n in zip(more, norms)):
            continue
        common = more
        kept.discard(word)
    return kept


def _runs(text: Column, signs: Column) -> Column:
    """Runs of up to ``RUN`` adjacent paragraphs, from each on that has a telling word within its longest run."""
    paragraphs = F.split(F.regexp_replace(text, BLOCK_END, "$1\n\n"), PARAGRAPH)
    told = F.transform(paragraphs, lambda p: F.struct(p.alias("text"), F.arrays_overlap(_words(p), signs).alias("told")))

    def from_each(parts: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.size(parts)), lambda i: F.exists(F.slice(parts, i, F.lit(RUN)), lambda p: p["told"]))
        return F.flatten(F.transform(starts, lambda i: F.transform(
            F.sequence(F.lit(1), F.least(F.lit(RUN), F.size(parts) - i + 1)), lambda k: F.array_join(F.slice(parts["text"], i, k), "\n"))))

    # Bound by a lambda, so that the paragraphs are split once.
    return F.flatten(F.transform(F.array(told), from_each))


def own_licences(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(path, licence, score) of the ``files`` (path, text) with a notice; of repeated paths, the best."""
    spark = files.sparkSession
    templates = (*TEMPLATES, *TEXTS)
    terms = [Counter(words(text)) for _, text in templates]
    vocabulary = sorted(set().union(*terms))
    known = F.split(F.lit(" ".join(vocabulary)), " ")
    found = F.array_intersect(_words(F.col("text")), known)
    counted = {r["word"]: r["n"] for r in files.select(F.explode(found).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    total = files.count()
    idf = {w: inverse_frequency(total, counted.get(w, 0)) for w in vocabulary}
    vectors = [{w: n * idf[w] for w, n in t.items()} for t in terms]
    signs = F.split(F.lit(" ".join(sorted(telling(vectors, threshold, idf)))), " ")

    is_licence_file = F.element_at(F.split("path", "/"), -1).rlike(LICENCE_FILE)
    lines = F.split("text", "\n")
    named = files.filter("path is not null and text is not null")
    whole = F.when(is_licence_file, F.concat(lines, F.array("text"))).otherwise(lines)
    runs = F.when(F.arrays_overlap(_words(F.col("text")), signs), _runs(F.col("text"), signs))
    units = named.select("path", F.explode(whole).alias("line")).unionByName(
        named.select("path", F.explode(runs).alias("line"))
    ).select("path", F.xxhash64("line").alias("unit"), _words(F.col("line")).alias("words")).filter(F.arrays_overlap("words", signs))
    counts = staging.written(
        units.dropDuplicates(["path", "unit"]).select("path", "unit", F.explode("words").alias("word")).groupBy(
            "path", "unit", "word").agg(F.count("*").alias("n")),
        "words",
    )
    others = counts.select("word").distinct().filter(~F.array_contains(known, F.col("word")))
    frequencies = staging.written(
        files.select(F.explode(F.array_distinct(_words(F.col("text")))).alias("word")).groupBy("word").agg(
            F.count("*").alias("containing")
        ).join(others, "word", "left_semi").select(
            "word", (F.log(F.lit(1.0 + total) / (F.lit(1) + F.col("containing"))) + 1).alias("other")),
        "frequencies",
    )
    lengths = [math.sqrt(sum(x * x for x in v.values())) for v in vectors]
    # One literal, as thousands of them take the planner seconds.
    entries = json.dumps([
        {"word": w, "idf": idf[w], "parts": [{"template": k, "share": v[w] / lengths[k]} for k, v in enumerate(vectors) if w in v]}
        for w in vocabulary
    ])
    entry = "array<struct<word: string, idf: double, parts: array<struct<template: int, share: double>>>>"
    weights = spark.range(1).select(F.explode(F.from_json(F.lit(entries), entry)).alias("entry")).select("entry.*")
    weighed = counts.join(F.broadcast(weights), "word", "left").join(frequencies, "word", "left").withColumn(
        "weight", F.col("n") * F.coalesce("idf", "other"))
    norms = weighed.groupBy("path", "unit").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    dots = weighed.select("path", "unit", "weight", F.explode("parts").alias("part")).groupBy("path", "unit", "part.template").agg(
        F.sum(F.col("weight") * F.col("part.share")).alias("dot"))
    names = F.array(*[F.lit(name) for name, _ in templates])
    scores = dots.join(norms, ["path", "unit"]).select(
        "path", F.get(names, F.col("template")).alias("licence"), F.round(F.col("dot") / F.col("norm"), 6).alias("score")
    ).filter(F.col("score") >= threshold)
    # The best score; of equal ones, the licence that comes first.
    return scores.groupBy("path").agg(F.min(F.struct((-F.col("score")).alias("minus"), "licence")).alias("best")).select(
        "path", "best.licence", (-F.col("best.minus")).alias("score"))


def _directory(path: Column) -> Column:
    """The path without its last part; the root is ''."""
    return F.array_join(F.slice(F.split(path, "/"), 1, F.size(F.split(path, "/")) - 1), "/")


def inherited(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """(directory, licence, source) from the nearest of a directory and its ancestors that is licensed.

    ``directories`` and ``licensed`` have a directory a row, the latter with licence and source.
    """
    parts = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    ancestors = directories.select("directory", F.explode(F.array_distinct(above)).alias("ancestor"))
    found = ancestors.join(licensed.withColumnRenamed("directory", "ancestor"), "ancestor")
    return found.groupBy("directory").agg(
        F.max_by(F.struct("licence", "source"), F.length("ancestor")).alias("nearest")
    ).select("directory", "nearest.licence", "nearest.source")


def licences(files: DataFrame, path: str = "path", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per file: path, licence, score, how (``notice``, ``inherited`` or null) and source.

    ``source`` is the path of the file that holds the notice. A directory with several licence files takes
    the best score, of equal ones the first path. A null or empty text has no notice; a null path has no
    directory and no licence; rows that repeat a path are one file to others, and each get its licence. A
    file without any licence has nulls. Other columns are not read.
    """
    files = files.select(F.col(path).alias("path"), F.col(text).alias("text"))
    own = staging.written(own_licences(files, threshold), "licences")
    named = own.filter(F.element_at(F.split("path", "/"), -1).rlike(LICENCE_FILE))
    licensed = named.groupBy(_directory(F.col("path")).alias("directory")).agg(
        F.min(F.struct((-F.col("score")).alias("minus"), "path", "licence")).alias("best")
    ).select("directory", "best.licence", F.col("best.path").alias("source"))
    places = files.select("path", _directory(F.col("path")).alias("directory"))
    nearest = staging.written(inherited(places.select("directory").filter("directory is not null").distinct(), licensed), "inherited")
    joined = places.join(own.withColumnRenamed("licence", "own"), "path", "left").join(nearest, "directory", "left")
    return joined.select(
        "path", F.coalesce("own", "licence").alias("licence"), "score",
        F.when(F.col("own").isNotNull(), "notice").when(F.col("licence").isNotNull(), "inherited").alias("how"),
        F.when(F.col("own").isNotNull(), F.col("path")).otherwise(F.col("source")).alias("source"),
    )

"""License scan: TF-IDF cosine of headers and licence files to templates, then inheritance by directory.

All of it is DataFrame expressions. Inverse document frequencies of the templates' words come from all documents.
A line is compared with every template by the cosine of TF-IDF vectors; a word that no template has counts with
the highest weight, that of a word seen once. Only lines with an anchor word are spread into words: for each
template, anchors are its heaviest words, such that the rest alone cannot reach the threshold; so no line
above the threshold is lost. A document's license is its best line's; ties go to the first name in order.

A document without one inherits that of the nearest directory above it that holds a licence file. Directories,
not documents, are joined with their ancestors, so a large directory is one row.

Defined results: null and empty texts have no license of their own. A null path has no directory and inherits
nothing. Several licence files in a directory: the best score counts, then the first name. Repeated rows are
reported one by one. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knownby.llm.common import store

# The wording of public licenses' notices and opening lines.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction."),
    ("Proprietary", "All rights reserved."),
]
THRESHOLD = 0.8
_SPLIT = r"[^a-z0-9]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), _SPLIT), "")


def _template_words(text: str) -> list[str]:
    return [w for w in re.split(_SPLIT, text.lower()) if w]


def _idf(n_docs: int, df: int) -> float:
    return math.log((1 + n_docs) / (1 + df)) + 1


def _frequencies(docs: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Number of documents, and of those that hold each word of the templates."""
    has = F.array_intersect(_words(F.coalesce("text", F.lit(""))), F.array(*map(F.lit, vocabulary)))
    counts = docs.select(F.explode(F.concat(has, F.array(F.lit("")))).alias("word")).groupBy("word").count().collect()  # the vocabulary
    held = {r["word"]: r["count"] for r in counts}
    return held.pop("", 0), held


def _anchors(weights: list[dict[str, float]], threshold: float) -> list[str]:
    """Words of which a line must hold one to reach the threshold with any template."""
    out = set()
    for unit in weights:
        rest = 1.0
        for word, w in sorted(unit.items(), key=lambda x: (-x[1], x[0])):
            if rest < threshold ** 2 - 1e-9:
                break
            out.add(word)
            rest -= w * w
    return sorted(out)


def own_licenses(docs: DataFrame, threshold: float = THRESHOLD, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """A stored row for each document: row, doc_id, path, own_license, own_score (both null if none)."""
    templates = TEMPLATES if templates is None else templates
    counts = [Counter(_template_words(text)) for _, text in templates]
    vocabulary = sorted({w for c in counts for w in c})
    n_docs, df = _frequencies(docs, vocabulary)
    idf = {w: _idf(n_docs, df.get(w, 0)) for w in vocabulary}
    unseen = _idf(n_docs, 1)
    norms = [math.sqrt(sum((n * idf[w]) ** 2 for w, n in c.items())) for c in counts]
    units = [{w: n * idf[w] / norm for w, n in c.items()} for c, norm in zip(counts, norms)]
    anchored = r"(?i)(?<![A-Za-z0-9])(" + "|".join(_anchors(units, threshold)) + r")(?![A-Za-z0-9])"

    spark = docs.sparkSession
    rows = [(w, i, name, float(u[w])) for i, ((name, _), u) in enumerate(zip(templates, units)) for w in u]
    template_words = spark.createDataFrame(rows, "word string, template int, license string, unit double")
    word_weights = spark.createDataFrame([(w, float(v)) for w, v in idf.items()], "word string, idf double")

    stored = store(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "path",
                               F.filter(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda l: l.rlike(anchored)).alias("lines")), "license-lines")
    lines = stored.select("row", F.posexplode("lines").alias("line", "words")).withColumn("words", _words(F.col("words")))
    terms = lines.select("row", "line", F.explode("words").alias("word")).groupBy("row", "line", "word").agg(F.count("*").alias("n"))
    weighed = terms.join(F.broadcast(word_weights), "word", "left").withColumn("w", F.col("n") * F.coalesce("idf", F.lit(unseen)))  # the templates' words
    lengths = weighed.groupBy("row", "line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weighed.join(F.broadcast(template_words), "word").groupBy("row", "line", "template", "license").agg(F.sum(F.col("w") * F.col("unit")).alias("dot"))
    scores = dots.join(lengths, ["row", "line"]).select("row", "license", F.round(F.col("dot") / F.col("norm"), 6).alias("score")).where(F.col("score") >= threshold)
    best = scores.groupBy("row").agg(F.min(F.struct((-F.col("score")).alias("minus"), "license")).alias("b")) \
        .select("row", F.col("b.license").alias("own_license"), (-F.col("b.minus")).alias("own_score"))
    return store(stored.drop("lines").join(best, "row", "left"), "own-licenses")


def _directory(path: Column) -> Column:
    """The path without its last part; the root is the empty string."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan_licenses(docs: DataFrame, is_license_file: Column, threshold: float = THRESHOLD) -> DataFrame:
    """docs: doc_id, path, text. One row per document: doc_id, path, own_license, own_score, license, origin, inherited_from.

    ``is_license_file`` is an expression over doc_id and path.
    """
    own = own_licenses(docs, threshold).withColumn("dir", _directory(F.col("path"))).withColumn("is_file", F.coalesce(is_license_file, F.lit(False)))
    grants = own.where("is_file AND own_license IS NOT NULL AND dir IS NOT NULL").groupBy("dir") \
        .agg(F.min(F.struct((-F.col("own_score")).alias("minus"), F.col("own_license").alias("license"))).alias("g")) \
        .select(F.col("dir").alias("above"), F.col("g.license").alias("granted"))
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    dirs = own.where("dir IS NOT NULL").select("dir").distinct().withColumn("above", F.explode(F.array_distinct(F.concat(above, F.array(F.lit(""))))))
    nearest = dirs.join(grants, "above").groupBy("dir").agg(F.max(F.struct(F.length("above").alias("depth"), "above", "granted")).alias("n")) \
        .select("dir", F.col("n.above").alias("inherited_from"), F.col("n.granted").alias("granted"))
    out = own.join(nearest, "dir", "left")
    inherits = F.col("own_license").isNull()
    origin = F.when(~inherits, F.when(F.col("is_file"), "file").otherwise("header")).when(F.col("granted").isNotNull(), "inherited").otherwise("none")
    return out.select("doc_id", "path", "own_license", "own_score", F.coalesce("own_license", "granted").alias("license"), origin.alias("origin"),
                      F.when(inherits, F.col("inherited_from")).alias("inherited_from"))

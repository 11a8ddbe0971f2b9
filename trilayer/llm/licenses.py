"""Licences of files by sparse TF-IDF cosine, and from the directories above.

Units are the lines of a file (its headers), windows of up to ``WINDOW`` lines as long as
the longest notice, which begin and end in lines with a notice's word that is no function
word (lines without words are passed over), and, for licence files, the text as a whole.
Templates are notices and, compared with licence files as a whole only, the full texts in
``license_texts``. A unit's vector holds its words by count times idf, with idf = ln((1 + N) / (1 + df)) + 1
over all N files. A unit is compared with licence templates; only words in common add to
the product, so the comparison is a join on words. By Cauchy's inequality a unit without
any of some words of a template (a notice's heaviest, a full text's rarest ones), taken
until the rest of its norm falls below the threshold, cannot reach it; only units with one
of these words are vectors at all.

A file has the licence of its best unit. Other files inherit that of the licence file in
the nearest directory above them (join on every directory of their path). Native DataFrame
functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trilayer.operators.joins import broadcast_if_small
from trilayer.workspace import written

#: The usual wording of notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without"
     " modification, are permitted under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "Subject to the terms of the Mozilla Public License, version 2.0."),
)
#: Standard headers of source files, and of full texts what stands for them there.
HEADERS = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may"
     " not use this file except in compliance with the License. You may obtain a copy of the"
     " License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under"
     " the terms of the GNU General Public License as published by the Free Software"
     " Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under"
     " the terms of the GNU General Public License as published by the Free Software"
     " Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under"
     " the terms of the GNU Lesser General Public License as published by the Free Software"
     " Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of"
     " this software and associated documentation files (the \"Software\"), to deal in the"
     " Software without restriction, including without limitation the rights to use, copy,"
     " modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and"
     " to permit persons to whom the Software is furnished to do so"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose"
     " with or without fee is hereby granted, provided that the above copyright notice and"
     " this permission notice appear in all copies."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its"
     " contributors may be used to endorse or promote products derived from this software"
     " without specific prior written permission."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License,"
     " v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"
     " https://mozilla.org/MPL/2.0/."),
)
#: Words of notices that do not begin or end a window by themselves.
FUNCTION_WORDS = ("a", "and", "any", "as", "at", "by", "for", "if", "in", "is", "it", "may", "not",
                  "of", "on", "or", "that", "the", "this", "to", "under", "was", "with", "you")
#: Templates of more words are full texts, which whole licence files are compared with;
#: headers are compared with the others.
NOTICE_WORDS = 100
THRESHOLD = 0.7
#: Kinds of units; of equal scores the first counts.
LINE, WHOLE, BLOCK = range(3)
WORD = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
LICENSE_NAMES = r"(?i)(?:^|/)(?:licen[cs]e|copying|notice)(?:\.[a-z]+)?$"


def full_texts() -> list[tuple[str, str]]:
    """Licences by the names of their files."""
    folder = Path(__file__).with_name("license_texts")
    return [(path.stem, path.read_text("utf-8")) for path in sorted(folder.glob("*.txt"))]


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _counts(units: DataFrame, keys: Sequence[str]) -> DataFrame:
    return units.select(*keys, F.explode("words").alias("term")).groupBy(*keys, "term").agg(
        F.count("*").alias("tf"))


def _df(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """Files that have each wanted term."""
    spread = files.select(F.explode(F.array_distinct("words")).alias("term"))
    known = spread.join(broadcast_if_small(wanted), "term").groupBy("term").agg(
        F.count("*").alias("df"))
    return wanted.join(known, "term", "left").select("term", F.coalesce("df", F.lit(0)).alias("df"))


def _weighted(counts: DataFrame, df: DataFrame, total: int, keys: Sequence[str]) -> DataFrame:
    """Terms with weight, and the norm of the unit they are in."""
    idf = F.log((1.0 + F.lit(total)) / (1.0 + F.col("df"))) + 1.0
    rows = counts.join(broadcast_if_small(df), "term").withColumn("weight", F.col("tf") * idf)
    norms = rows.groupBy(*keys).agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"))
    return rows.join(norms, list(keys))


def scan(files: DataFrame, id_column: str, path: str, text: str,
         templates: Sequence[tuple[str, str]] | None = None,
         threshold: float = THRESHOLD) -> DataFrame:
    """Per distinct (id, path) of ``files``: license, score, via (`header`, `file`,
    `inherited` or `none`) and from_dir (the directory inherited from).

    ``path`` is relative, with `/`; a null path is a file of its own that inherits nothing,
    null and empty texts have no words. Rows that repeat an id and a path are one file
    whose units are those of all. Of equal scores the template that sorts first wins; of
    licence files in one directory that of the highest score, then of the first name.
    A licence may have several templates; without any given they are ``TEMPLATES``,
    ``HEADERS`` and the full texts. Without files the result is empty, without templates nothing has a licence.
    """
    if templates is None:
        templates = [*TEMPLATES, *HEADERS, *full_texts()]
    spark = files.sparkSession
    rows = files.select(F.col(id_column).alias("file_id"), F.col(path).alias("path"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    keys = ["file_id", "path"]
    total = rows.count()
    worded = rows.select(*keys, "text", terms(F.col("text")).alias("words"))
    bodies = [(number, *template) for number, template in enumerate(templates)]
    models = spark.createDataFrame(bodies, "body int, template string, text string").select(
        "body", "template", terms(F.col("text")).alias("words"))
    is_long = (F.size("words") > NOTICE_WORDS).alias("long")
    names = models.select("body", "template", is_long)
    longest = models.filter(F.size("words") <= NOTICE_WORDS).agg(
        F.coalesce(F.max(F.size("words")), F.lit(0))).first()[0]
    model_counts = written(_counts(models, ["body"]), "license-templates")
    model_df = written(_df(worded, model_counts.select("term").distinct()), "license-df")
    model = written(_weighted(model_counts, model_df, total, ["body"]).join(
        broadcast_if_small(names), "body"), "license-model")

    first = Window.partitionBy("body").orderBy(
        F.when(F.col("long"), F.col("df")), F.desc("weight"), "term")
    taken = F.sum(F.col("weight") ** 2).over(first.rowsBetween(Window.unboundedPreceding, -1))
    left = 1 - F.coalesce(taken, F.lit(0.0)) / F.col("norm") ** 2
    needed = model.withColumn("left", left).filter(
        F.col("left") >= threshold**2 * (1 - 1e-9)).select("long", "term").distinct()
    heads = {False: [], True: []}
    for row in needed.collect():  # of the templates, so a few
        heads[row["long"]].append(row["term"])

    def some(words, found):
        return F.arrays_overlap(words, F.split(F.lit(" ".join(found)), " "))

    notices = model.filter(~F.col("long")).select("term").distinct().collect()
    edges = sorted({r["term"] for r in notices} - set(FUNCTION_WORDS) | set(heads[False]))
    asked = worded.filter(some("words", heads[False])).select(*keys, "text")
    lines = _windows(written(asked, "license-files"), keys, longest,
                     lambda words: some(words, heads[False]), lambda words: some(words, edges))
    whole = worded.filter(F.col("path").rlike(LICENSE_NAMES)).select(
        *keys, F.lit(WHOLE).alias("kind"), "words")
    units = lines.unionByName(whole.filter(some("words", heads[False] + heads[True])))
    unit_keys = [*keys, "kind", "unit"]
    units = written(
        units.withColumn("unit", F.xxhash64("words")).select(*unit_keys, "words"),
        "license-units")
    # equal units have equal vectors: one of each is compared
    kinds = units.groupBy("unit").agg(
        F.first("words").alias("words"), F.max(F.col("kind") == WHOLE).alias("whole"))
    counts = written(_counts(kinds, ["unit", "whole"]), "license-counts")
    more = counts.select("term").distinct().join(model_df, "term", "left_anti")
    df = written(model_df.unionByName(_df(worded, written(more, "license-terms"))), "license-all-df")
    vectors = _weighted(counts, df, total, ["unit", "whole"])
    other = model.select("body", "template", F.col("term").alias("model_term"), "long",
                         F.col("weight").alias("model_weight"), F.col("norm").alias("model_norm"))
    both = vectors.join(broadcast_if_small(other), (F.col("term") == F.col("model_term"))
                        & (F.col("whole") | ~F.col("long")))
    scores = both.groupBy("unit", "body", "template").agg(
        (F.sum(F.col("weight") * F.col("model_weight"))
         / F.first("norm") / F.first("model_norm")).alias("score")
    ).filter(F.col("score") >= threshold)
    best = scores.groupBy("unit").agg(
        F.min(F.struct((-F.col("score")).alias("low"), "template")).alias("best"))
    named = units.join(broadcast_if_small(written(best, "license-scores")), "unit").select(
        *keys, F.col("best.template").alias("own"), F.col("best.low").alias("low"),
        "kind")
    own = written(named.groupBy(*keys).agg(
        F.min(F.struct("low", "own", "kind")).alias("first")).select(
        *keys, F.col("first.own").alias("own"), (-F.col("first.low")).alias("own_score"),
        (F.col("first.kind") == WHOLE).alias("is_whole")), "license-own")
    return _inherited(rows.select(*keys).distinct(), own, keys).withColumnRenamed(
        "file_id", id_column)


def _windows(files: DataFrame, keys: list[str], longest: int, asked, edge) -> DataFrame:
    """Lines, and windows of lines that are shorter than ``longest`` words without their
    last line, with a word that is ``asked`` for; both ends of a window are an ``edge``.

    Each line has a word at least, so a window has ``longest`` + 1 lines at most.
    """
    every = F.filter(F.transform(F.split("text", "\n"), terms), lambda words: F.size(words) > 0)
    split = files.select(*keys, every.alias("lines"))

    def within(rows):
        """Lines that begin within ``longest`` words."""
        start = F.struct(F.lit(0).alias("words"), F.lit(0).alias("lines"))
        return F.aggregate(
            rows, start,
            lambda sum_, row: F.when(sum_["words"] < longest, F.struct(
                (sum_["words"] + F.size(row)).alias("words"), (sum_["lines"] + 1).alias("lines"),
            )).otherwise(sum_),
            lambda sum_: sum_["lines"],
        )

    near = F.transform(
        F.filter(
            F.transform("lines", lambda _, at: F.slice("lines", at + 1, F.lit(longest + 1))),
            lambda rows: edge(rows[0])),
        lambda rows: F.slice(rows, F.lit(1), F.greatest(within(rows), F.lit(1))))
    starts = split.select(*keys, F.explode(F.filter(near, lambda rows: F.exists(rows, asked))).alias("near"))
    spans = F.transform(F.sequence(F.lit(1), F.size("near")), lambda n: F.struct(
        F.when(n == 1, LINE).otherwise(BLOCK).alias("kind"),
        edge(F.element_at("near", n)).alias("ends"),
        F.flatten(F.slice("near", F.lit(1), n)).alias("words")))
    found = starts.select(*keys, F.inline(spans))
    fits = (F.col("kind") == LINE) | F.col("ends")
    return found.filter(fits & asked(F.col("words"))).select(*keys, "kind", "words")


def _directories(path: Column) -> Column:
    """Every directory above a file, the root (an empty name) included."""
    steps = F.slice(F.split(path, "/"), F.lit(1), F.size(F.split(path, "/")) - 1)
    return F.transform(F.sequence(F.lit(0), F.size(steps)),
                       lambda k: F.array_join(F.slice(steps, F.lit(1), k), "/"))


def _inherited(files: DataFrame, own: DataFrame, keys: list[str]) -> DataFrame:
    above = own.filter(F.col("path").rlike(LICENSE_NAMES)).select(
        F.element_at(_directories(F.col("path")), -1).alias("dir"),
        F.struct((-F.col("own_score")).alias("low"), "own").alias("named"))
    above = above.groupBy("dir").agg(F.min("named").alias("named"))
    above = broadcast_if_small(written(above, "license-dirs"))
    joined = files.join(
        broadcast_if_small(own.select(F.col("file_id").alias("own_id"),
                                      F.col("path").alias("own_path"), "own", "own_score",
                                      "is_whole")),
        F.col("file_id").eqNullSafe(F.col("own_id")) & F.col("path").eqNullSafe(F.col("own_path")),
        "left").drop("own_id", "own_path")
    asking = joined.filter(F.col("own").isNull() & F.col("path").isNotNull()).select(
        *keys, F.posexplode(_directories(F.col("path"))).alias("depth", "dir"))
    nearest = asking.join(above, "dir").groupBy(*keys).agg(
        F.max(F.struct("depth", "dir", "named")).alias("near")).select(
        F.col("file_id").alias("near_id"), F.col("path").alias("near_path"), "near")
    found = joined.join(
        nearest,
        F.col("file_id").eqNullSafe(F.col("near_id")) & (F.col("path") == F.col("near_path")), "left")
    via = (F.when(F.col("own").isNotNull(), F.when(F.col("is_whole"), "file").otherwise("header"))
           .when(F.col("near").isNotNull(), "inherited").otherwise("none"))
    return found.select(
        *keys, F.coalesce("own", "near.named.own").alias("license"),
        F.coalesce(F.col("own_score"), -F.col("near.named.low")).alias("score"),
        via.alias("via"), F.col("near.dir").alias("from_dir"))

"""Licence notices by Dice coefficient over word bigrams, in DataFrame functions alone.

The units compared are the lines of a text and the text as a whole. Two bounds keep most of them from
any comparison: at a Dice coefficient of ``t``, a unit of ``a`` bigrams and a template of ``b``
have ``a`` from ``t / (2 - t) * b`` to ``(2 - t) / t * b``, so units meet templates on their number of
bigrams, each template listed under every number it admits; and they must share a bigram.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Least Dice coefficient of a match.
DICE = 0.8

# Licence identifiers and the notices that name them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("Proprietary", "All rights reserved."),
)


def _words(text: Column) -> Column:
    """Normalised words: lower case, every run of other than letters and digits one blank."""
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def _bigrams(words: Column) -> Column:
    """Distinct word bigrams; none for fewer than two words."""
    pairs = F.zip_with(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
        F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.array_distinct(pairs)


def template_table(spark: SparkSession, templates=TEMPLATES, dice: float = DICE) -> DataFrame:
    """Templates by every number of bigrams they admit: licence, template, size, meets, bigrams."""
    rows = [
        F.struct(F.lit(k).alias("template"), F.lit(name).alias("licence"), F.lit(text).alias("notice"))
        for k, (name, text) in enumerate(templates)
    ]
    raw = spark.range(1).select(F.inline(F.array(*rows)))
    table = raw.select("template", "licence", _bigrams(_words(F.col("notice"))).alias("own"))
    table = table.withColumn("size", F.size("own")).where("size > 0")
    low = F.ceil(F.col("size") * (dice / (2 - dice)) - 1e-9).cast("int")
    high = F.floor(F.col("size") * ((2 - dice) / dice) + 1e-9).cast("int")
    return table.withColumn("meets", F.explode(F.sequence(F.greatest(low, F.lit(1)), high)))


def licence_notices(
    docs: DataFrame,
    templates=TEMPLATES,
    dice: float = DICE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Matches: doc_id, line (from 1; 0 for the text as a whole), licence, dice.

    A unit gives its best template; ties go to the first listed. A text of one line is compared once,
    as line 1. Null and empty texts and units of fewer than two words match nothing. Rows that
    repeat are reported each; a null id stays null. Other columns are not read.
    """
    table = template_table(docs.sparkSession, templates, dice)
    # a unit has at least as many distinct bigrams as distinct words but one
    longest = max(len(re.split("[^0-9A-Za-z]+", text)) for _, text in templates)
    most = int(longest * (2 - dice) / dice) + 1
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), lines.alias("lines"))
    slim = slim.withColumn("row", F.monotonically_increasing_id())
    numbered = slim.select("row", "doc_id", F.posexplode("lines").alias("at", "unit"))
    numbered = numbered.withColumn("line", F.col("at") + 1)
    whole = slim.where(F.size("lines") > 1).select(
        "row", "doc_id", F.lit(0).alias("line"), F.array_join("lines", " ").alias("unit")
    )
    units = numbered.select("row", "doc_id", "line", "unit").union(whole)
    units = units.where(F.length("unit") >= 3).select("row", "doc_id", "line", _words(F.col("unit")).alias("words"))
    units = units.where(F.size(F.array_distinct("words")) <= most)
    units = units.withColumn("bigrams", _bigrams(F.col("words"))).drop("words")
    units = units.withColumn("n", F.size("bigrams")).where("n > 0")
    met = units.join(F.broadcast(table), F.col("n") == F.col("meets"))
    met = met.where(F.arrays_overlap("bigrams", "own"))
    score = 2.0 * F.size(F.array_intersect("bigrams", "own")) / (F.col("n") + F.col("size"))
    met = met.withColumn("dice", score).where(F.col("dice") >= dice)
    best = F.max_by(F.struct("licence", "dice"), F.struct("dice", -F.col("template")))
    found = met.groupBy("row", "line").agg(F.min("doc_id").alias("doc_id"), best.alias("best"))
    return found.select("doc_id", "line", F.col("best.licence").alias("licence"), F.col("best.dice").alias("dice"))

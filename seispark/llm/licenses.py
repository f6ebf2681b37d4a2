"""License scan: lines and whole texts against license templates."""

import functools
import math
import re

from pyspark.sql import functions as F

from seispark.llm.text import row_key

# Names and public notice texts of common licenses.
TEMPLATES = [
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

LEAST = 0.9


def words(text):
    """Words of the normalised text: lower case, anything but letters and digits is a blank."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")


def pairs(words):
    """Distinct hashes of neighbouring words."""
    left, right = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.size(words))
    return F.array_distinct(F.zip_with(left, right, lambda a, b: F.xxhash64(a, b)))


def template_table(spark, templates):
    """(template, license, pair, size): the pairs of every template and how many it has."""
    rows = spark.createDataFrame([(k, name, text) for k, (name, text) in enumerate(templates)], "template int, license string, text string")
    found = rows.withColumn("words", words(F.col("text"))).withColumn("pairs", pairs(F.col("words")))
    return found.select("template", "license", F.explode("pairs").alias("pair"), F.size("pairs").alias("size"))


def _serves(anchor, word):
    return anchor in word if len(anchor) > 4 else anchor == word


def anchors(templates, least):
    """A few words of which every unit that can pass holds one.

    A unit that reaches ``least`` with a template shares at least c of its b pairs, so it holds one of any
    b - c + 1 of them. Words are taken, long ones that serve many templates first, until each
    template has so many pairs with one of them; a long word may also be part of a longer one.
    """
    left = []
    for _, text in templates:
        w = re.sub(r"[\W_]+", " ", text.lower()).split()
        own = set(zip(w, w[1:]))
        fewest = math.ceil(least / (2 - least) * len(own) - 1e-9)
        shared = math.ceil(least * (fewest + len(own)) / 2 - 1e-9)
        left.append((own, len(own) - shared + 1))
    taken = []
    while True:
        open_ = [{p for p in own if not any(_serves(t, w) for t in taken for w in p)} for own, need in left if sum(any(_serves(t, w) for t in taken for w in p) for p in own) < need]
        if not any(open_):
            return taken
        words_ = {w for own in open_ for p in own for w in p}
        taken.append(max(words_, key=lambda w: (len(w) >= 7, sum(any(_serves(w, x) for x in p) for own in open_ for p in own), len(w), w)))


def scan(docs, templates=TEMPLATES, least=LEAST, id_col="doc_id", text_col="text"):
    """(_id, license, score, n_lines, whole_text): licenses that a line or the whole text of a row states.

    Dice coefficient 2c / (a + b) over the distinct word pairs of unit and template, ``least`` or more.
    A unit (each line, and the text if it has several) can reach that only if its number of pairs lies
    within least / (2 - least) and its inverse times the template's: others are not compared. Before that, texts
    and units without any of the templates' anchor words are left out, which no match can do without. Pairs
    are matched by an equi-join with the template table, which has a few pairs per template
    and is broadcast: its size is that of ``templates``, whatever the corpus. Only matches are counted
    up, so a notice in a third of all lines is no group. A unit states one license, the one it is most like.

    ``score`` is the best of the row's units, ``n_lines`` how many lines match, ``whole_text`` if the whole
    text does. Rows without a license give no row, nor do null or empty texts and units of one word; equal rows count as one.
    """
    spark = docs.sparkSession
    patterns = template_table(spark, templates)
    bound = least / (2 - least)
    found = anchors(templates, least)

    def holds(col, word):
        inside = F.contains(F.lower(col), F.lit(word))
        return inside if len(word) > 4 else inside & F.lower(col).rlike(f"(?<![\\p{{L}}\\p{{N}}]){word}(?![\\p{{L}}\\p{{N}}])")

    def hopeful(col):
        return functools.reduce(lambda a, b: a | b, [holds(col, w) for w in found], F.lit(False))

    rows = docs.select(*row_key(id_col, text_col)).where(hopeful(F.col("_text")))
    lines = F.split("_text", "\n", -1)
    units = rows.select("_id", "_h", F.posexplode(F.when(F.size(lines) > 1, F.concat(F.array("_text"), lines)).otherwise(lines)).alias("_n", "_unit"), (F.size(lines) > 1).alias("_many"))
    # pairs of a unit are at most its words less one, so a short unit is left out before they are made
    sizes = patterns.agg(F.min("size").alias("low"), F.max("size").alias("high")).first()
    low, high = int(bound * (sizes["low"] or 0)), int((sizes["high"] or 0) / bound) + 1
    units = units.where(hopeful(F.col("_unit"))).withColumn("_words", words(F.col("_unit"))).where(F.size("_words") > max(low, 1))
    units = units.select("_id", "_h", "_n", "_many", pairs(F.col("_words")).alias("_pairs")).where(F.size("_pairs").between(low, high))
    entries = units.select("_id", "_h", "_n", "_many", F.size("_pairs").alias("_size"), F.explode("_pairs").alias("pair"))
    met = entries.join(F.broadcast(patterns), "pair").where((F.col("_size") >= bound * F.col("size") - 1e-9) & (F.col("size") >= bound * F.col("_size") - 1e-9))
    hits = met.groupBy("_id", "_h", "_n", "_many", "template", "license", "_size", "size").agg(F.count("*").alias("_common"))
    scored = hits.withColumn("score", 2.0 * F.col("_common") / (F.col("_size") + F.col("size"))).where(F.col("score") >= least)
    # a unit states the license it is most like, the first template on ties
    best = scored.groupBy("_id", "_h", "_n", "_many").agg(F.max(F.struct("score", -F.col("template"), "license")).alias("_best"))
    whole = (F.col("_n") == 0) & F.col("_many")
    return best.groupBy("_id", "_h", "_best.license").agg(
        F.max("_best.score").alias("score"), F.sum(F.when(whole, 0).otherwise(1)).cast("long").alias("n_lines"), F.max(whole).alias("whole_text")
    )

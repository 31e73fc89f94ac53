"""License scans: the Dice coefficient over word bigrams against licence templates, natively.

Units are the lines of a text and, for licence texts over several lines, its
paragraphs (parted by blank lines).  A unit's words are its lower-cased runs of
letters and digits.  Dice = 2 |A and B| / (|A| + |B|) >= t bounds the sizes:
|A| lies between t / (2 - t) and (2 - t) / t times |B|; units whose number of
words fits no template are dropped before any pair is made, and only pairs that pass the
bound are counted, by a join on the bigram.  The same bound says that a match holds
t / (2 - t) of a template's bigrams, so of any set of more bigrams than the rest it
holds at least one, with both words; texts and units without such a pair of words for
any template are passed over before they are cut into words.  Nothing that matches is lost.

Edge cases: null and empty texts have no units; units of one word have no
bigram and match nothing; a unit reports each template it reaches; equal units of a
document are counted in n_units; rows that repeat a doc_id add up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

THRESHOLD = 0.8

#: Public licence notices and licence texts, by SPDX-like id.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT-notice-licensed": "Licensed under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0-notice": "This work has been dedicated to the public domain under CC0 1.0.",
    "BSD-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "all-rights-reserved": "All rights reserved.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
           "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
           "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
           "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
           "following conditions:",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
           "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
           "that the following conditions are met:",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                  "in compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
               "General Public License as published by the Free Software Foundation, either version 3 of the License, "
               "or (at your option) any later version.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def bigrams(w: Column) -> Column:
    """Distinct pairs of neighbouring words."""
    n = F.greatest(F.size(w) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(w, F.lit(1), n), F.slice(w, F.lit(2), n),
                                       lambda a, b: F.concat_ws(" ", a, b)))


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(license, n_template, bigram): a few rows per word of the templates."""
    t = spark.createDataFrame(sorted(templates.items()), "license string, template string")
    t = t.withColumn("b", bigrams(words(F.col("template"))))
    return t.select("license", F.size("b").alias("n_template"), F.explode("b").alias("bigram"))


def anchors(template_bigrams: dict[str, list[str]], low: float) -> dict[str, list[str]]:
    """Words and, for each, their partners: a unit that reaches a template holds a word and one of
    its partners.  At most (1 - low) of a template's bigrams may be missing, so one more than that are
    taken, those with long words (which are rare) or words taken before first."""
    partners: dict[str, set[str]] = {}
    for own in template_bigrams.values():
        pairs = [sorted(b.split(" "), key=lambda x: (len(x), x)) for b in own]
        need = int((1 - low) * len(pairs) + 1e-6) + 1
        for short, long in sorted(pairs, key=lambda p: (p[1] not in partners, -len(p[1]), p))[:need]:
            partners.setdefault(long, set()).add(short)
    return {w: sorted(p) for w, p in sorted(partners.items())}


def may_match(text: Column, words_of: dict[str, list[str]]) -> Column:
    """Whether the text holds one of the words and a partner of it.  The one-element array has
    the text lower-cased once, not once a word."""
    if not words_of:
        return F.lit(False)
    known = F.array(*[F.struct(F.lit(w).alias("w"), F.array(*map(F.lit, p)).alias("p")) for w, p in words_of.items()])
    return F.exists(F.array(F.lower(text)), lambda t: F.exists(
        known, lambda a: F.contains(t, a["w"]) & F.exists(a["p"], lambda q: F.contains(t, q))))


def license_units(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, unit_words, license, dice) per matching unit of a document; `unit_words` is the
    unit's normalised text."""
    spark = docs.sparkSession
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    table = template_table(spark, templates)
    own: dict[str, list[str]] = {}
    for r in table.collect():                  # the templates' own bigrams, a fixed small number
        own.setdefault(r["license"], []).append(r["bigram"])
    words_of = anchors(own, low)
    fits = F.lit(False)
    for n in sorted({len(b) for b in own.values()}):
        fits = fits | F.col("n_unit").between(F.lit(n * low - 1e-9), F.lit(n * high + 1e-9))
    text = F.col("text")
    # a paragraph that is one line is that line
    paragraphs = F.filter(F.split(text, r"\n[ \t\r]*\n"), lambda p: F.instr(F.trim(p), "\n") > 0)
    units = (docs.where(may_match(text, words_of)).select("doc_id", F.explode(F.concat(F.split(text, "\n"), paragraphs)).alias("u"))
             .where(may_match(F.col("u"), words_of)))
    unit = (units.select("doc_id", words(F.col("u")).alias("w")).where(F.size("w") > 1)
            .select("doc_id", F.array_join("w", " ").alias("unit_words"), bigrams(F.col("w")).alias("b"))
            .withColumn("n_unit", F.size("b")).where(fits))
    counted = unit.groupBy("doc_id", "unit_words", "n_unit").agg(F.count(F.lit(1)).alias("n_units"))
    pairs = (counted.withColumn("bigram", F.explode(bigrams(F.split("unit_words", " "))))
             .join(F.broadcast(table), "bigram")
             .where((F.col("n_unit") >= low * F.col("n_template") - 1e-9) & (F.col("n_unit") <= high * F.col("n_template") + 1e-9)))
    return (pairs.groupBy("doc_id", "unit_words", "license").agg(
                F.count(F.lit(1)).alias("shared"), F.first("n_unit").alias("n_unit"),
                F.first("n_template").alias("n_template"), F.first("n_units").alias("n_units"))
            .withColumn("dice", 2.0 * F.col("shared") / (F.col("n_unit") + F.col("n_template")))
            .where(F.col("dice") >= threshold - 1e-9)
            .select("doc_id", "unit_words", "license", "n_units", "dice"))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, license, n_units, dice) per document and licence found: how many of its units
    match, and the best match."""
    return license_units(docs).groupBy("doc_id", "license").agg(
        F.sum("n_units").alias("n_units"), F.round(F.max("dice"), 6).alias("dice"))

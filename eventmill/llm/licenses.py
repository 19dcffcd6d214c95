"""Licence scan: units of text compared with licence templates by the Dice coefficient over word bigrams.

DataFrame functions only. A document is read as its lines, its sentences, its paragraphs and as a whole; each template is
a licence notice or a paragraph of a licence text. Lines without a letter or digit part paragraphs as empty ones do, so
the paragraphs of a comment block are told apart. Texts and units that hold none of the templates' telling words cannot
reach the wanted coefficient and are passed over unread. A unit whose bigram count cannot reach the wanted coefficient with any
template is dropped before its bigrams are spelt out, and a unit meets only the templates within its own bounds.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.llm.common import cut

THRESHOLD = 0.8

#: Fixed values: (licence, wording) of public licence notices and paragraphs.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("Apache-2.0", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("CDDL-1.0", 'The contents of this file are subject to the terms of the Common Development and Distribution License (the "License"). You may not use this file except in compliance with the License.'),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
)

#: What separates words: every ASCII character that is neither letter nor digit.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Words too frequent to tell a licence by, taken as telling words last.
FREQUENT = ("a", "all", "and", "any", "are", "as", "at", "be", "by", "can", "do", "following", "for", "from", "http", "https", "if", "in",
            "including", "is", "it", "may", "must", "no", "not", "obtain", "of", "on", "or", "org", "person", "that", "the", "their", "this",
            "to", "use", "used", "was", "with", "without", "work", "you", "your", "under")
#: Between paragraphs: line ends with nothing but separators between them.
PARAGRAPH = r"\n[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\n"
#: Between sentences: an end mark before white space, or the end of a paragraph.
SENTENCE = r"[.!?:;][\x20\x09-\x0D]+|" + PARAGRAPH


def normalised_words(text: Column) -> Column:
    """Lower-cased words; ASCII punctuation and white space separate them."""
    return F.filter(F.split(F.lower(text), SEPARATORS), lambda w: w != "")


def bigrams(words: Column) -> Column:
    """Word bigrams in order; none for fewer than two words."""
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(F.size(words) > 1, pairs).otherwise(F.array().cast("array<string>"))


def telling_words(templates: Iterable[tuple[str, str]], threshold: float) -> list[str]:
    """Words one of which every unit that reaches the threshold with some template holds.

    A coefficient of `threshold` needs threshold / (2 - threshold) of the template's bigrams. For each template words
    are taken, those taken before first, then long ones, until the bigrams without any of them are fewer than that.
    """
    kept: set[str] = set()
    for _, wording in templates:
        words = [w for w in re.split(SEPARATORS, wording.lower()) if w]
        pairs = list(zip(words, words[1:]))
        need = threshold / (2 - threshold) * len(pairs) - 1e-9
        own: set[str] = set()
        for word in sorted(set(words), key=lambda w: (w in FREQUENT, w not in kept, -len(w), w)):
            if sum(1 for a, b in pairs if a not in own and b not in own) < need:
                break
            own.add(word)
        kept |= own
    return sorted(kept)


def holds_a_word(text: Column, words: Sequence[str]) -> Column:
    """Whether one of the words stands in the text as normalised_words would give it."""
    edge = SEPARATORS.removesuffix("+")
    listed = "|".join(re.escape(w) for w in words)
    return F.lower(text).rlike(f"(?:^|{edge})(?:{listed})(?:{edge}|$)") if words else F.lit(False)


def template_bigrams(spark: SparkSession, templates: Iterable[tuple[str, str]]) -> DataFrame:
    """(template, license, template_size, bigram, in_template): bigrams of each template with their counts."""
    rows = [F.struct(F.lit(i).alias("template"), F.lit(name).alias("license"), F.lit(text).alias("wording")) for i, (name, text) in enumerate(templates)]
    listed = F.array(*rows).cast("array<struct<template:int,license:string,wording:string>>")
    base = spark.range(1).select(F.inline(listed)).withColumn("grams", bigrams(normalised_words(F.col("wording"))))
    return base.withColumn("template_size", F.size("grams")).select("template", "license", "template_size", F.explode("grams").alias("bigram")).groupBy(
        "template", "license", "template_size", "bigram").agg(F.count(F.lit(1)).alias("in_template"))


def scan(docs: DataFrame, templates: Iterable[tuple[str, str]] = TEMPLATES, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document and licence found: doc_id, license, template, dice, n_units.

    A unit that reaches the threshold counts for its best template (the lowest number among equals), so that notices
    that differ in a word or two are told apart. dice is the best coefficient (2 * shared bigrams, counted with repeats /
    bigrams of both), template the lowest number among the best, n_units how many units count for the licence. Units are
    the distinct word sequences of a document's lines, sentences, paragraphs and whole text, so one-line texts count
    once. A notice is not found within a longer sentence that adds more words than the threshold allows.

    Nulls: a null text has no units; rows with a null id are kept under null. Texts with fewer than two words match
    nothing. Very long texts are read whole; their whole-text unit simply exceeds the size bounds. Repeated rows count
    as one document per id. Empty tables give no rows, and other columns are ignored. The templates are a parameter;
    their table holds only these texts, which bounds the broadcast.
    """
    spark = docs.sparkSession
    templates = list(templates)
    per_bigram = cut(template_bigrams(spark, templates))
    sizes = per_bigram.select("template_size").distinct().agg(F.min("template_size"), F.max("template_size")).first()
    least, most = (sizes[0] or 0, sizes[1] or 0)
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    text = F.col(text_col)
    telling = telling_words(templates, threshold)
    pieces = F.array_distinct(F.concat(F.split(text, r"\n"), F.split(text, PARAGRAPH), F.split(text, SENTENCE), F.array(text)))
    # split stops one piece beyond what the largest template allows, so long units are told apart without being spelt out
    longest = int(high * most) + 2
    pieces_seen = F.size(F.split(F.col("unit"), SEPARATORS, longest + 3))
    units = (docs.filter(holds_a_word(text, telling)).select(F.col(id_col).alias("doc_id"), F.explode(pieces).alias("unit"))
             .filter((F.length("unit") >= 3) & holds_a_word(F.col("unit"), telling) & pieces_seen.between(2, longest + 2)).withColumn("words", normalised_words(F.col("unit")))
             .filter(F.size("words").between(max(2, int(low * least)), longest)))
    units = units.withColumn("at", F.monotonically_increasing_id()).select("doc_id", "at", F.xxhash64("words").alias("unit"), F.size("words").alias("n"), F.explode(bigrams(F.col("words"))).alias("bigram"))
    counted = units.withColumn("unit_size", F.col("n") - 1)
    hits = (counted.join(F.broadcast(per_bigram), "bigram")
            .filter((F.col("unit_size") >= low * F.col("template_size") - 1e-9) & (F.col("unit_size") <= high * F.col("template_size") + 1e-9)))
    shared = (hits.groupBy("at", "doc_id", "unit", "unit_size", "template", "license", "template_size", "bigram", "in_template").agg(F.count(F.lit(1)).alias("in_unit"))
              .groupBy("at", "doc_id", "unit", "unit_size", "template", "license", "template_size").agg(F.sum(F.least("in_unit", "in_template")).alias("shared")))
    dice = shared.withColumn("dice", 2.0 * F.col("shared") / (F.col("unit_size") + F.col("template_size"))).filter(F.col("dice") >= threshold)
    best = dice.groupBy("at", "doc_id", "unit").agg(F.max_by(F.struct("template", "license", "dice"), F.struct("dice", -F.col("template"))).alias("best"))
    return best.select("doc_id", "unit", "best.*").groupBy("doc_id", "license").agg(
        F.max("dice").alias("dice"), F.max_by("template", F.struct("dice", -F.col("template"))).alias("template"),
        F.countDistinct("unit").alias("n_units")).select("doc_id", "license", "template", "dice", "n_units")


def scan_sql(docs: str = "documents", templates: Iterable[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same in DuckDB SQL, without the size bounds: every unit against every template."""
    quoted = ", ".join("({}, '{}', '{}')".format(i, name, text.replace("'", "''")) for i, (name, text) in enumerate(templates))
    words = f"[x for x in regexp_split_to_array(lower({{}}), '{SEPARATORS}') if x <> '']"
    pairs = "[w[i] || ' ' || w[i + 1] for i in range(1, len(w))]"
    return f"""
WITH t0 AS (SELECT template, license, {words.format("wording")} AS w FROM (VALUES {quoted}) v(template, license, wording)),
t1 AS (SELECT template, license, {pairs} AS g FROM t0),
t AS (SELECT template, license, tn, b, count(*) AS tc FROM (SELECT template, license, len(g) AS tn, unnest(g) AS b FROM t1) GROUP BY ALL),
p AS (SELECT DISTINCT doc_id, unnest(list_concat(list_concat(string_split(text, chr(10)), regexp_split_to_array(text, '{PARAGRAPH}')), list_concat(regexp_split_to_array(text, '{SENTENCE}'), [text]))) AS unit FROM {docs} WHERE text IS NOT NULL),
u0 AS (SELECT DISTINCT doc_id, {words.format("unit")} AS w FROM p),
u1 AS (SELECT doc_id, array_to_string(w, ' ') AS unit, {pairs} AS g FROM u0),
u AS (SELECT doc_id, unit, un, b, count(*) AS uc FROM (SELECT doc_id, unit, len(g) AS un, unnest(g) AS b FROM u1) WHERE b IN (SELECT b FROM t) GROUP BY ALL),
s AS (SELECT doc_id, unit, template, license, 2.0::DOUBLE * sum(least(uc, tc)) / (un + tn) AS dice FROM u JOIN t USING (b) GROUP BY doc_id, unit, un, template, license, tn),
k AS (SELECT * FROM s WHERE dice >= {threshold!r}::DOUBLE QUALIFY row_number() OVER (PARTITION BY doc_id, unit ORDER BY dice DESC, template) = 1)
SELECT doc_id, license, CAST(arg_max(template, dice - template * 1e-9) AS INTEGER) AS template, max(dice) AS dice, count(DISTINCT unit) AS n_units FROM k GROUP BY doc_id, license"""

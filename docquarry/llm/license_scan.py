"""License scans: enough shingles of each template retrieve it, shingle containment verifies.

Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.binding import bound
from .common import materialise, query, table
from .line_dedup import small_or_plain

WIDTH = 5

# Notices of public licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY '
        "KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "BSD-notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:"
    ),
    "MPL-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
}


def normalised(text: Column) -> Column:
    """Lower case, with one space for each run of other characters than letters and digits."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _shingles(text: Column) -> Column:
    """The hashes of each run of five words of a text, in order, repeated ones too."""

    def runs(hashes: Column) -> Column:
        all_ = F.transform(hashes, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, WIDTH)]))
        return F.slice(all_, 1, F.greatest(F.size(hashes) - (WIDTH - 1), F.lit(0)))

    return bound(F.transform(F.split(normalised(text), " "), lambda w: F.xxhash64(w)), runs)


def _keys(wanted: Column, percent: int) -> Column:
    """So many of a template's shingles that a text with none of them lacks more than it may."""
    needed = F.ceil(F.size(wanted) * percent / 100)
    return F.slice(wanted, 1, F.greatest(F.size(wanted) - needed + 1, F.lit(0)).cast("int"))


def _first_line(text: Column, shingles: Column, wanted: Column) -> Column:
    """The number of the line on which the first of the wanted shingles begins."""
    words = F.transform(F.split(text, "\n", -1), lambda x: F.size(F.filter(F.split(normalised(x), " "), lambda w: w != "")))
    lines = F.flatten(F.transform(words, lambda n, i: F.array_repeat(i, n)))
    at = F.array_position(F.transform(shingles, lambda s: F.array_contains(wanted, s)), True)
    return F.get(lines, at.cast("int") - 1)


def scan_licenses(
    docs: DataFrame, templates: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, template_id, line_no, matched, total, containment): templates of which a document holds
    at least ``percent`` / 100 of the distinct five-word shingles; ``line_no`` is the first line on
    which one of them begins.

    ``templates`` has template_id and text.  A document that may lack at most m shingles of a template
    has one of any m + 1, so m + 1 of each template retrieve all that hold it, wherever lines end.
    Then the whole document's shingles, over line ends, are compared.

    Words are runs of letters and digits, lower-cased.  Null, empty and shorter texts hold nothing.
    Rows without an id are not reported; rows that repeat an id give each template once, by the row
    that holds most.  Templates without id or of fewer than five words match nothing.  Several
    templates may match a document.  No rows give no rows; other columns are not read.
    """
    given = templates.where("template_id is not null and text is not null").select("template_id", "text")
    shingled = given.select("template_id", F.array_distinct(_shingles(F.col("text"))).alias("wanted"))
    shingled = shingled.where(F.size("wanted") > 0)
    keys = materialise(shingled.select("template_id", F.explode(_keys(F.col("wanted"), percent)).alias("key")), "templates")

    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # The outer form of explode: the inner one would add a filter that computes the arrays again.
    own = texts.select("doc_id", F.explode_outer(_shingles(F.col("text"))).alias("key"))
    hits = own.join(small_or_plain(keys), "key")
    retrieved = materialise(hits.select("doc_id", "template_id").distinct(), "retrieved")

    held = texts.join(small_or_plain(retrieved.select("doc_id").distinct()), "doc_id")
    held = held.select("doc_id", "text", _shingles(F.col("text")).alias("shingles"))
    both = held.join(retrieved, "doc_id").join(small_or_plain(shingled), "template_id")
    matched = F.size(F.array_intersect("wanted", "shingles")).cast("long")
    line = _first_line(F.col("text"), F.col("shingles"), F.col("wanted")).alias("line_no")
    judged = both.select("doc_id", "template_id", line, matched.alias("matched"), F.size("wanted").cast("long").alias("total"))
    judged = judged.where(100 * F.col("matched") >= percent * F.col("total"))
    best = judged.groupBy("doc_id", "template_id").agg(
        F.min("line_no").alias("line_no"), F.max("matched").alias("matched"), F.max("total").alias("total")
    )
    return best.withColumn("containment", F.col("matched") / F.col("total"))


def _sql() -> str:
    quoted = {k: v.replace("'", "''") for k, v in TEMPLATES.items()}
    rows = ", ".join(f"('{k}', '{v}')" for k, v in quoted.items())
    pieces = "list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))"
    return f"""WITH templates(template_id, "text") AS (VALUES {rows}),
    t AS (SELECT DISTINCT template_id, unnest({pieces}) AS s FROM (
        SELECT template_id, regexp_extract_all(lower("text"), '[\\p{{L}}\\p{{N}}]+') AS w FROM templates) WHERE len(w) > 4),
    size AS (SELECT template_id, count(*) AS total FROM t GROUP BY ALL),
    d AS (SELECT DISTINCT doc_id, unnest({pieces}) AS s FROM (
        SELECT doc_id, regexp_extract_all(lower("text"), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents) WHERE len(w) > 4),
    hits AS (SELECT doc_id, template_id, count(*) AS matched FROM d JOIN t USING (s) GROUP BY ALL)
    SELECT doc_id, template_id, matched, total, CAST(matched AS DOUBLE) / total AS containment
    FROM hits JOIN size USING (template_id) WHERE 100 * matched >= 80 * total"""


def known_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES.items()), "template_id string, text string")


@query("op6_license_scan", _sql())
def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return scan_licenses(docs, known_templates(spark)).drop("line_no")

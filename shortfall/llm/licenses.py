"""Licence scan (operator 4, native): TF-IDF cosine of headers and licence files to
licence templates, then inheritance from the nearest ancestor directory.

* A file's units are its lines, its paragraphs (split at blank lines) and its whole text. A unit is
  a sparse vector of term counts times inverse document frequencies, counted over all files. The terms of templates are
  counted first. A unit's other terms weigh 1 at least; units that reach the threshold with that weight are few, and their other terms are
  then counted over all files, too.
* A unit that lacks the heaviest terms of every template cannot reach the threshold: per template
  the lightest terms whose common norm stays below the threshold are left out, the
  others are anchors, and only files with an anchor are looked at. This loses no match.
* The best line or paragraph gives a file its own licence (a header); a file whose whole text matches is a
  licence file and holds for its directory and those below, for files without a licence of their own.

Everything is DataFrame operations; only templates, their terms and weights (bounded by the template
list) are broadcast or sent to the driver. Defined results: NULL or empty text and NULL path have no licence of their own, a NULL path inherits
nothing; equal scores go to the smaller licence id, equal directories' licence files to the higher score, then the smaller path;
rows of one path are one file and give a row each; empty tables give no rows; without templates nothing matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shortfall.session import pin, pin_folder

THRESHOLD = 0.7

# Licence ids and texts of their usual notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("LicenseRef-All-Rights-Reserved", "All rights reserved."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
# Licence ids that stand in SPDX lines.
SPDX = ["0BSD", "AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense"]
TEMPLATES += [(name, f"SPDX-License-Identifier: {name}") for name in SPDX]


def template_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(TEMPLATES)], "template int, license_id string, text string")


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def _idf(total: int) -> Column:
    return F.log((1.0 + total) / (1.0 + F.coalesce("df", F.lit(0)))) + 1.0


def _vectors(templates: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(term, idf) of the templates' terms, (template, license_id, term, w) with unit norms, number of files."""
    counted = templates.select("template", "license_id", F.explode(terms(F.col("text"))).alias("term")).groupBy("template", "license_id", "term").agg(F.count("*").alias("tf"))
    vocabulary = [r["term"] for r in counted.select("term").distinct().orderBy("term").collect()]
    known = F.array(*[F.lit(t) for t in vocabulary]).cast("array<string>")
    total = files.count()
    seen = files.select(F.explode(F.array_intersect(terms(F.col("text")), known)).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    idf = (counted.select("term").distinct().join(seen, "term", "left")
           .select("term", _idf(total).alias("idf")))
    weights = counted.join(idf, "term").withColumn("x", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy("template")))
    return idf, weights.select("template", "license_id", "term", (F.col("x") / norm).alias("w")), total


def own_licenses(files: DataFrame, templates: DataFrame, threshold: float, folder: str) -> DataFrame:
    """(file, license_id, score, whole): best match of each file with one, for its lines and paragraphs and for its whole text."""
    idf, weights, total = _vectors(templates, files)
    weights, idf = pin(weights, "weights", folder), pin(idf, "idf", folder)
    lighter = Window.partitionBy("template").orderBy("w", "term")
    anchors = [r["term"] for r in weights.withColumn("below", F.sum(F.col("w") * F.col("w")).over(lighter))
               .where(F.col("below") >= threshold * threshold * 0.999999).select("term").distinct().collect()]     # terms of templates
    if not anchors:
        return files.select("file", F.lit("").alias("license_id"), F.lit(0.0).alias("score"), F.lit(True).alias("whole")).limit(0)
    listed = F.array(*[F.lit(t) for t in sorted(anchors)])
    near = files.where(F.arrays_overlap(terms(F.col("text")), listed)).select("file", "text")
    part = lambda kind, pattern: F.transform(F.split("text", pattern), lambda part, i: F.struct(F.lit(kind).alias("kind"), i.alias("unit"), part.alias("part")))
    whole = F.array(F.struct(F.lit(2).alias("kind"), F.lit(0).alias("unit"), F.col("text").alias("part")))
    units = near.select("file", F.inline(F.concat(part(0, "\n"), part(1, "\n[ \\t\\r]*\n"), whole)))
    units = units.select("file", "kind", "unit", terms(F.col("part")).alias("words")).where(F.arrays_overlap("words", listed))
    keys = ["file", "kind", "unit"]
    counted = units.select(*keys, F.explode("words").alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("tf"))
    counted = pin(counted, "counted", folder)                     # read three times; the texts are split once
    # the right sides have a row per term, or per term and template; other terms weigh 1 at least
    least = counted.join(F.broadcast(idf), "term", "left").withColumn("x", F.col("tf") * F.coalesce("idf", F.lit(1.0)))
    dots = (least.join(F.broadcast(weights), "term").groupBy(*keys, "template", "license_id").agg(F.sum(F.col("x") * F.col("w")).alias("dot"))
            .join(least.groupBy(*keys).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm")), keys))
    possible = pin(dots.where(F.round(F.col("dot") / F.col("norm"), 6) >= threshold).select(*keys, "license_id", "dot"), "possible", folder)
    within = counted.join(possible.select(*keys).distinct(), keys, "left_semi").join(F.broadcast(idf), "term", "left")
    within = pin(within, "within", folder)
    other = pin(within.where("idf IS NULL").select("term").distinct(), "other", folder)
    seen = (files.select(F.explode(F.array_distinct(terms(F.col("text")))).alias("term")).join(other, "term", "left_semi")
            .groupBy("term").agg(F.count("*").alias("df")).select("term", _idf(total).alias("own_idf")))
    weighed = within.join(seen, "term", "left").withColumn("x", F.col("tf") * F.coalesce("idf", "own_idf"))
    norms = weighed.groupBy(*keys).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    scored = possible.join(norms, keys).withColumn("score", F.round(F.col("dot") / F.col("norm"), 6)).where(F.col("score") >= threshold)
    first = Window.partitionBy("file", "whole").orderBy(F.desc("score"), "license_id")
    return (scored.select("file", "license_id", "score", (F.col("kind") == 2).alias("whole")).groupBy("file", "whole", "license_id").agg(F.max("score").alias("score"))
            .withColumn("at", F.row_number().over(first)).where("at = 1").select("file", "license_id", "score", "whole"))


def scan(files: DataFrame, templates: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(path, license_id, score, origin, from_dir) of every row of ``files (path, text)``; origin is
    ``file``, ``header``, ``inherited`` or NULL. Paths have ``/`` between their parts."""
    folder = pin_folder(files.sparkSession)
    base = files.select(F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    texts = base.where("path IS NOT NULL").select(F.col("path").alias("file"), "text")
    own = pin(own_licenses(texts, templates, threshold, folder), "own", folder)
    mine = own.groupBy("file").agg(F.max_by("license_id", F.struct("whole", "score")).alias("license_id"), F.max_by("score", F.struct("whole", "score")).alias("score"), F.max("whole").alias("whole"))
    parent = lambda c: F.when(c.isNull(), F.lit(None).cast("string")).when(F.instr(c, "/") > 0, F.regexp_replace(c, "/[^/]*$", "")).otherwise(F.lit(""))
    declared = (own.where("whole").withColumn("dir", parent(F.col("file")))
                .withColumn("at", F.row_number().over(Window.partitionBy("dir").orderBy(F.desc("score"), "file"))).where("at = 1")
                .select(F.col("dir").alias("from_dir"), F.col("license_id").alias("dir_license"), F.col("score").alias("dir_score")))
    dirs = base.where("path IS NOT NULL").select(parent(F.col("path")).alias("dir")).distinct()
    parts = F.split("dir", "/")
    above = F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))))
    climbed = dirs.select("dir", F.posexplode(above).alias("depth", "from_dir")).join(declared, "from_dir")
    nearest = (climbed.withColumn("at", F.row_number().over(Window.partitionBy("dir").orderBy(F.desc("depth")))).where("at = 1")
               .select("dir", "from_dir", "dir_license", "dir_score"))
    # rows have no text from here on; a directory with a third of all files meets one row
    rows = base.select("path", parent(F.col("path")).alias("dir")).join(mine, F.col("path") == F.col("file"), "left").join(nearest, "dir", "left")
    has = F.col("license_id").isNotNull()
    return rows.select(
        "path", F.coalesce("license_id", "dir_license").alias("license_id"), F.when(has, F.col("score")).otherwise(F.col("dir_score")).alias("score"),
        F.when(has & F.col("whole"), "file").when(has, "header").when(F.col("dir_license").isNotNull(), "inherited").alias("origin"),
        F.when(~has, F.col("from_dir")).alias("from_dir"))


def oracle_sql(files: str, threshold: float = THRESHOLD) -> str:
    """DuckDB SQL for ``scan`` with the built-in templates; ``files`` is a query of (doc_id, path, text) with distinct paths."""
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    rows = ", ".join(f"({i}, {quoted(n)}, {quoted(t)})" for i, (n, t) in enumerate(TEMPLATES))
    words = "string_split_regex(lower({}), '[^a-z0-9]+')"
    return f"""
WITH files AS ({files}), tpl(template, license_id, text) AS (VALUES {rows}),
tt AS (SELECT template, license_id, term, count(*) AS tf FROM (
  SELECT template, license_id, unnest({words.format('text')}) AS term FROM tpl) WHERE term <> '' GROUP BY ALL),
total AS (SELECT count(*)::DOUBLE AS n FROM files),
df AS (SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct({words.format('text')})) AS term FROM files) GROUP BY term),
idf AS (SELECT term, ln((1.0 + n) / (1.0 + coalesce(df, 0))) + 1.0 AS idf FROM (SELECT DISTINCT term FROM tt) LEFT JOIN df USING (term), total),
w AS (SELECT template, license_id, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY template)) AS w FROM tt JOIN idf USING (term)),
units AS (
  SELECT path, 0 AS kind, generate_subscripts(string_split(text, chr(10)), 1) AS unit, unnest(string_split(text, chr(10))) AS part FROM files
  UNION ALL
  SELECT path, 1, generate_subscripts(string_split_regex(text, '\\n[ \\t\\r]*\\n'), 1), unnest(string_split_regex(text, '\\n[ \\t\\r]*\\n')) FROM files
  UNION ALL SELECT path, 2, 0, text FROM files),
counted AS (SELECT path, kind, unit, term, count(*) AS tf FROM (
  SELECT path, kind, unit, unnest({words.format('part')}) AS term FROM units) WHERE term <> '' GROUP BY ALL),
weighed AS (SELECT c.*, tf * (ln((1.0 + n) / (1.0 + df)) + 1.0) AS x FROM counted c JOIN df USING (term), total),
norms AS (SELECT path, kind, unit, sqrt(sum(x * x)) AS norm FROM weighed GROUP BY ALL),
dots AS (SELECT path, kind, unit, template, license_id, sum(x * w) AS dot FROM weighed JOIN w USING (term) GROUP BY ALL),
scored AS (SELECT path, kind = 2 AS whole, license_id, max(round(dot / norm, 6)) AS score FROM dots JOIN norms USING (path, kind, unit)
  WHERE round(dot / norm, 6) >= {threshold} GROUP BY ALL),
own AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY path, whole ORDER BY score DESC, license_id) = 1),
mine AS (SELECT * FROM own QUALIFY row_number() OVER (PARTITION BY path ORDER BY whole DESC) = 1),
placed AS (SELECT doc_id, path, CASE WHEN contains(path, '/') THEN regexp_replace(path, '/[^/]*$', '') ELSE '' END AS dir FROM files),
declared AS (SELECT dir, license_id, score FROM own JOIN placed USING (path) WHERE whole
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, path) = 1),
climbed AS (SELECT dir, depth, array_to_string(string_split(dir, '/')[1:depth], '/') AS from_dir FROM (
  SELECT dir, unnest(range(0, CASE WHEN dir = '' THEN 1 ELSE len(string_split(dir, '/')) + 1 END)) AS depth FROM (SELECT DISTINCT dir FROM placed))),
nearest AS (SELECT c.dir, c.from_dir, d.license_id, d.score FROM climbed c JOIN declared d ON d.dir = c.from_dir
  QUALIFY row_number() OVER (PARTITION BY c.dir ORDER BY depth DESC) = 1)
SELECT p.doc_id, coalesce(m.license_id, n.license_id) AS license_id, CASE WHEN m.license_id IS NULL THEN n.score ELSE m.score END AS score,
  CASE WHEN m.whole THEN 'file' WHEN m.license_id IS NOT NULL THEN 'header' WHEN n.license_id IS NOT NULL THEN 'inherited' END AS origin,
  CASE WHEN m.license_id IS NULL THEN n.from_dir END AS from_dir
FROM placed p LEFT JOIN mine m USING (path) LEFT JOIN nearest n ON n.dir = p.dir"""

"""Operator 3: licence scans, all in DataFrame functions.

Comment marks go and wrapped lines become one, so that a header or licence file
reads as running text. Its sentences that speak of a licence are compared with
templates of notices, headers, licence texts and SPDX tags by the cosine of
sparse TF-IDF vectors; document frequencies count all such sentences of all
files. A template that names a version also needs that version in the sentence.
A file takes the licence of its best sentence: a named licence goes before a
plain claim of all rights, and a licence before one that it extends. A file that
is named as one, or is mostly licence text and has BODY words of it, is the
licence file of its directory; a short header is not. A file without a licence of its own inherits that of its nearest
ancestor directory that has one, by joins on directory paths.

Equal sentences are scored once, however often they occur; vectors meet the
templates, whose number is fixed, by term. Files meet directories on the path
of each ancestor, with one row per directory, so a large directory is a skewed
but splittable join side and never a product.

Defined results: null or empty texts have no licence of their own but inherit;
a null path is the path ''; rows that share a path are one file and get the
same result; ties go to the licence and path that sort first; further columns
are carried along, but for those named as the results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii, stash, table

MIN_COSINE, BODY = 0.6, 60
CUE = (
    r"(?i)\b(licen[cs]e[ds]?|copyright|rights reserved|spdx-license-identifier|permission is hereby granted|permission to use|"
    r"redistribution and use|redistributions in binary form|neither the name|public domain|creative commons|general public)\b"
)
TERM = r"[a-z0-9]+(?:\.[0-9]+)*"
SENTENCE_END = r"(?<=[.!?])[ \t]+"
#: A tag, which nothing after it belongs to.
TAG = r"(?i)(spdx-license-identifier:[ \t]*[a-z0-9.+-]+)"
#: Line ends inside running text: before a comment line that goes on, and before a line that starts in the middle of a sentence.
WRAPPED = (r"\n[ \t]*(//+|\*+|#+|;+|--+|%+)[ \t]+([^ \t\n])", r"\n[ \t]*([a-z(])")
#: Comment marks that are left at the start or end of a line.
MARKS = r"(?m)^[ \t]*(/\*+|\*+/?|//+|#+|;+|--+|<!--+|%+)[ \t]*|[ \t]*(\*+/|--+>)[ \t]*$"
LICENSE_FILE = r"(?i)^(licen[cs]e|copying|notice)([._-].*)?$"
_GPL = (
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation; "
    "either version {} of the License, or (at your option) any later version"
)
#: Licence names, the wording of their notices, headers and texts, and what a sentence needs besides.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0", "2"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License", "2"),
    ("MIT", "Released under the MIT License", "MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", ""),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions", ""),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies", ""),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ""),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License", "2"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License", "3"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "neither"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2", "2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3", "3"),
    ("GPL-2.0", _GPL.format("General Public License", 2), "version 2"),
    ("GPL-3.0", _GPL.format("General Public License", 3), "version 3"),
    ("GPL-3.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License", "version 3"),
    ("LGPL-2.1", _GPL.format("Lesser General Public License", 2.1), "lesser.*2.1"),
    ("LGPL-3.0", _GPL.format("Lesser General Public License", 3), "lesser.*3"),
    ("LGPL-3.0", "licensed under the GNU Lesser General Public License, version 3", "lesser.*3"),
    ("AGPL-3.0", _GPL.format("Affero General Public License", 3), "affero.*3"),
    ("AGPL-3.0", "licensed under the GNU Affero General Public License, version 3", "affero.*3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mozilla"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0", "boost"),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following", "organization"),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0", "eclipse.*1"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "eclipse.*2"),
    ("Unlicense", "This is free and unencumbered software released into the public domain", "unencumbered"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0", "4"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0", "SA.*4"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0", "NC.*4"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License", "4"),
    ("CC0-1.0", "dedicated to the public domain under Creative Commons CC0 1.0", ""),
    ("Proprietary", "All rights reserved", ""),
)
#: Notices, and a tag for each licence: name, wording, the pattern that a sentence needs.
TEMPLATES = tuple((name, text, "(?i)" + needs.replace(".1", "\\.1")) for name, text, needs in NOTICES) + tuple(
    (name, f"SPDX-License-Identifier: {name}", rf"(?i)identifier:[ \t]*{name}".replace(".0", "\\.0"))
    for name in dict.fromkeys(n for n, _, _ in NOTICES if n != "Proprietary")
)
#: Licences that give way to others in one file; all others are 2.
RANK = {"Proprietary": 0, "BSD-2-Clause": 1}


def terms(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(TERM), F.lit(0))


def sentences(text: Column) -> Column:
    """The sentences of a text that speak of a licence, without blanks at their ends."""
    text = F.regexp_replace(text, TAG, "$1\n\n")
    for k, end in enumerate(WRAPPED):
        text = F.regexp_replace(text, end, f" ${2 - k}")
    text = F.regexp_replace(text, MARKS, "")
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(CUE))
    each = F.flatten(F.transform(lines, lambda line: F.split(line, SENTENCE_END, -1)))
    return F.filter(F.transform(each, lambda s: F.btrim(s, F.lit(" \t\r"))), lambda s: s.rlike(CUE))


def score_sentences(found: DataFrame) -> DataFrame:
    """(sentence, license, rank, score) of the sentences that reach MIN_COSINE, from (sentence) with repeats."""
    spark = found.sparkSession
    distinct = found.groupBy("sentence").agg(F.count("*").alias("n"))
    total = found.count()
    tf = distinct.select("sentence", "n", F.explode(terms(F.col("sentence"))).alias("term")).groupBy("sentence", "n", "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.sum("n").alias("df"))
    idf = lambda df: F.log((F.lit(total) + 1.0) / (df + 1.0)) + 1.0
    weighted = tf.join(df, "term").select("sentence", "term", (F.col("tf") * idf(F.col("df"))).alias("w"))
    rows = [
        F.struct(F.lit(k).alias("template"), F.lit(name).alias("license"), F.lit(text).alias("text"), F.lit(needs).alias("needs"), F.lit(RANK.get(name, 2)).alias("rank"))
        for k, (name, text, needs) in enumerate(TEMPLATES)
    ]
    templates = spark.range(1).select(F.inline(F.array(*rows)))
    given = templates.select("template", "license", F.explode(terms(F.col("text"))).alias("term")).groupBy("template", "license", "term").agg(F.count("*").alias("tf"))
    given = given.join(df, "term", "left").select("template", "license", "term", (F.col("tf") * idf(F.coalesce("df", F.lit(0)))).alias("v"))
    norms = given.groupBy("template").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("t_norm")).join(templates.select("template", "needs", "rank"), "template")
    own = weighted.groupBy("sentence").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    # the templates are a fixed list: a few hundred rows whatever the input
    dot = weighted.join(F.broadcast(given), "term").groupBy("sentence", "template", "license").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    cosine = dot.join(F.broadcast(norms), "template").join(own, "sentence").select(
        "sentence", "license", "needs", "rank", F.round(F.col("dot") / (F.col("norm") * F.col("t_norm")), 6).alias("score")
    )
    cosine = cosine.filter((F.col("score") >= MIN_COSINE) & F.rlike(F.col("sentence"), F.col("needs")))
    best = cosine.groupBy("sentence").agg(F.min(F.struct((-F.col("score")).alias("s"), "license", "rank")).alias("b"))
    return best.select("sentence", F.col("b.license").alias("license"), F.col("b.rank").alias("rank"), (-F.col("b.s")).alias("score"))


def scan_licenses(files: DataFrame) -> DataFrame:
    """files with (path, text): license, basis ('file', 'header', 'inherited' or 'none'), license_dir and score in place of the text."""
    files = files.drop("license", "basis", "license_dir", "score").withColumn("license_scan_path", F.coalesce("path", F.lit("")))
    spoken = files.filter(F.col("text").rlike(CUE)).select("license_scan_path", "text").withColumn("sentence", F.explode(sentences(F.col("text"))))
    spoken = spoken.select("license_scan_path", "sentence", F.size(terms(F.col("text"))).alias("words"), F.size(terms(F.col("sentence"))).alias("own"))
    spoken = stash(spoken, "licence-sentences")
    scored = score_sentences(spoken.select("sentence"))
    held = spoken.join(scored, "sentence")
    per_file = held.groupBy("license_scan_path").agg(
        F.min(F.struct((-F.col("rank")).alias("r"), (-F.col("score")).alias("s"), "license")).alias("b"), F.sum("own").alias("own"), F.max("words").alias("words")
    )
    parent = F.regexp_replace("license_scan_path", "/?[^/]*$", "")
    is_file = F.regexp_extract("license_scan_path", "[^/]*$", 0).rlike(LICENSE_FILE) | ((F.col("own") * 2 >= F.col("words")) & (F.col("own") >= BODY))
    per_file = per_file.select(
        "license_scan_path", F.col("b.license").alias("license"), (-F.col("b.s")).alias("score"), F.when(is_file, "file").otherwise("header").alias("basis"), parent.alias("dir")
    )
    dirs = per_file.filter("basis = 'file'").groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("s"), "license", "license_scan_path")).alias("d"))
    dirs = dirs.select("dir", F.col("d.license").alias("dir_license"))
    bare = files.select("license_scan_path").distinct().join(per_file.select("license_scan_path"), "license_scan_path", "left_anti")
    parts = F.split(parent, "/", -1)
    up = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(parts, 1, i), "/").alias("dir")))
    above = bare.select("license_scan_path", F.explode(up).alias("a")).select("license_scan_path", "a.depth", "a.dir")
    near = above.join(dirs, "dir").groupBy("license_scan_path").agg(F.max(F.struct("depth", "dir", "dir_license")).alias("n"))
    near = near.select("license_scan_path", F.col("n.dir").alias("license_scan_near_dir"), F.col("n.dir_license").alias("license_scan_near"))
    own = per_file.select("license_scan_path", F.col("license").alias("license_scan_own"), F.col("score"), F.col("basis").alias("license_scan_basis"), F.col("dir").alias("license_scan_own_dir"))
    out = files.drop("text").join(own, "license_scan_path", "left").join(near, "license_scan_path", "left")
    return out.select(
        *[c for c in files.columns if c not in ("license_scan_path", "text")],
        F.coalesce("license_scan_own", "license_scan_near").alias("license"),
        F.coalesce("license_scan_basis", F.when(F.col("license_scan_near").isNotNull(), "inherited"), F.lit("none")).alias("basis"),
        F.coalesce(F.when(F.col("license_scan_basis") == "file", F.col("license_scan_own_dir")), "license_scan_near_dir").alias("license_dir"),
        "score",
    )


def document_path() -> Column:
    """Documents as a tree of files: source, then language, then a folder per hundred ids."""
    part = F.concat(F.lit("part"), F.floor(F.col("doc_id") / 100).cast("string"))
    return F.concat_ws("/", "source", "lang", part, F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", document_path().alias("path"), "text")
    found = scan_licenses(docs).select("doc_id", "path", "license", "basis", "license_dir", F.round("score", 3).alias("score"))
    return found


def _sql() -> str:
    quoted = lambda s: s.replace("'", "''")
    given = ", ".join(f"({k}, '{name}', '{quoted(text)}', '{quoted(needs)}', {RANK.get(name, 2)})" for k, (name, text, needs) in enumerate(TEMPLATES))
    joined = f"regexp_replace(text, '{TAG}', '\\1\n\n', 'g')"
    for k, end in enumerate(WRAPPED):
        joined = f"regexp_replace({joined}, '{end}', ' \\{2 - k}', 'g')"
    joined = f"regexp_replace({joined}, '{MARKS}', '', 'g')"
    low = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '" + TERM + "')"
    return rf"""
WITH f AS (
  SELECT doc_id, concat_ws('/', source, lang, 'part' || floor(doc_id / 100)::BIGINT, doc_id || '.txt') AS path, coalesce(text, '') AS text FROM documents
),
line AS (SELECT path, text, unnest(string_split({joined}, chr(10))) AS line FROM f WHERE regexp_matches(text, '{CUE}')),
raw AS (
  SELECT path, text, unnest(string_split(regexp_replace(line, '([.!?])[ \t]+', '\1' || chr(10), 'g'), chr(10))) AS s
  FROM line WHERE regexp_matches(line, '{CUE}')
),
spoken AS (
  SELECT path, trim(s, ' ' || chr(9) || chr(13)) AS sentence, len({low.format("text")}) AS words, len({low.format("s")}) AS own
  FROM raw WHERE regexp_matches(s, '{CUE}')
),
d AS (SELECT sentence, count(*) AS n FROM spoken GROUP BY sentence),
total AS (SELECT count(*) AS total FROM spoken),
tf AS (
  SELECT sentence, n, term, count(*) AS tf FROM (SELECT sentence, n, unnest({low.format("sentence")}) AS term FROM d) GROUP BY ALL
),
df AS (SELECT term, sum(n)::DOUBLE AS df FROM tf GROUP BY term),
w AS (SELECT sentence, term, tf * (ln((total + 1.0) / (df + 1.0)) + 1.0) AS w FROM tf JOIN df USING (term), total),
t AS (SELECT * FROM (VALUES {given}) AS t(template, license, text, needs, rank)),
tt AS (SELECT template, license, term, count(*) AS tf FROM (SELECT template, license, unnest({low.format("text")}) AS term FROM t) GROUP BY ALL),
v AS (SELECT template, license, term, tf * (ln((total + 1.0) / (coalesce(df, 0) + 1.0)) + 1.0) AS v FROM tt LEFT JOIN df USING (term), total),
tn AS (SELECT template, sqrt(sum(v * v)) AS tn FROM v GROUP BY template),
sn AS (SELECT sentence, sqrt(sum(w * w)) AS sn FROM w GROUP BY sentence),
dot AS (SELECT sentence, template, license, sum(w * v) AS dot FROM w JOIN v USING (term) GROUP BY ALL),
cosine AS (
  SELECT sentence, dot.license, rank, needs, round(dot / (sn * tn), 6) AS score FROM dot JOIN tn USING (template) JOIN sn USING (sentence) JOIN t USING (template)
),
scored AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sentence ORDER BY score DESC, license, rank) AS k FROM cosine
                 WHERE score >= {MIN_COSINE} AND regexp_matches(sentence, needs)) WHERE k = 1
),
held AS (SELECT path, license, rank, score, own, words FROM spoken JOIN scored USING (sentence)),
agg AS (SELECT path, sum(own) AS own, max(words) AS words FROM held GROUP BY path),
best AS (SELECT * FROM (SELECT path, license, score, row_number() OVER (PARTITION BY path ORDER BY rank DESC, score DESC, license) AS k FROM held) WHERE k = 1),
per AS (
  SELECT path, license, score, regexp_replace(path, '/?[^/]*$', '') AS dir,
    CASE WHEN regexp_matches(regexp_extract(path, '[^/]*$'), '{LICENSE_FILE}') OR (own * 2 >= words AND own >= {BODY}) THEN 'file' ELSE 'header' END AS basis
  FROM best JOIN agg USING (path)
),
dirs AS (
  SELECT dir, license FROM (SELECT dir, license, row_number() OVER (PARTITION BY dir ORDER BY score DESC, license, path) AS k FROM per WHERE basis = 'file') WHERE k = 1
),
up AS (
  SELECT path, i AS depth, array_to_string(parts[1:i], '/') AS dir
  FROM (SELECT path, parts, unnest(range(1, len(parts) + 1)) AS i
        FROM (SELECT path, string_split(regexp_replace(path, '/?[^/]*$', ''), '/') AS parts FROM f WHERE path NOT IN (SELECT path FROM per)))
),
near AS (
  SELECT * FROM (SELECT path, dir, license, row_number() OVER (PARTITION BY path ORDER BY depth DESC) AS k FROM up JOIN dirs USING (dir)) WHERE k = 1
)
SELECT f.doc_id, f.path, coalesce(per.license, near.license) AS license,
  coalesce(per.basis, CASE WHEN near.license IS NOT NULL THEN 'inherited' END, 'none') AS basis,
  coalesce(CASE WHEN per.basis = 'file' THEN per.dir END, near.dir) AS license_dir, round(per.score, 3) AS score
FROM f LEFT JOIN per ON f.path = per.path LEFT JOIN near ON f.path = near.path
"""


SQL = _sql()

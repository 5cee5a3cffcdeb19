r"""Licence scan (operator 3), in DataFrame operations alone.

1. Words are ``[0-9a-z]`` and non-ASCII runs after lower-casing A-Z.  idf of every
   word, 1 + ln((N + 1) / (df + 1)), counts all rows; frequencies are counted once,
   stored, and joined to the words of the lines.
2. Every line of a file is a header candidate, and so is every window of up to
   ``WRAP`` consecutive lines (wrapped headers) and the whole text of a licence
   file; all are called lines below.
   Lines and templates are sparse TF-IDF vectors; a line's licence is the
   template with the largest cosine, if that is at least ``COSINE``.  Lines
   without a *required* word cannot reach it and are left out before scoring: a
   template's required words are those that remain after dropping its lightest
   words while their norm is below ``COSINE`` of the template's (Cauchy-Schwarz
   bounds the cosine by that share).  Equal lines are scored once.
3. A file's own licence is that of its best line.  Licence files
   (``LICENSE``, ``COPYING``, ... by name) give theirs to their directory; a
   file without an own licence takes that of its nearest ancestor directory that
   has one, found by joins on paths: distinct directories are unfolded into
   their ancestors, matched, and the deepest match kept.

Defined results: null text is empty; a null path is a file in the root; rows of one
path are files of their own, told apart by a hash of their text; equal
scores go to the licence first in the alphabet, then the first line; several
licence files of a directory give the best scored licence; repeated rows are
repeated in the result.  A clashing column of the input is not read.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from poolbook.llm.common import stored

COSINE = 0.6
#: Consecutive lines that a header may be wrapped over.
WRAP = 4
#: Licence -> header text.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "CC-BY-4.0": "Licensed under Creative Commons Attribution 4.0 International, CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law the author has waived all copyright, CC0 1.0 Universal.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Proprietary": "Copyright. All rights reserved. Unauthorized copying is prohibited.",
}
FILE_NAME = r"(?i)^(?:licen[cs]e|copying|notice|unlicense)(?:[.-].*)?$"
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(c: Column) -> Column:
    return F.filter(F.split(_lower(c), _NOT_WORD), lambda w: w != "")


def template_words() -> dict[str, Counter]:
    """Word counts of every template (plain Python on the constants above)."""
    import re

    return {name: Counter(w for w in re.split(_NOT_WORD, text.lower()) if w) for name, text in TEMPLATES.items()}


def document_frequencies(files: DataFrame) -> DataFrame:
    """w, n: the rows that hold word ``w``, for every word; the empty word counts all rows."""
    held = F.array_distinct(F.concat(words(F.coalesce("text", F.lit(""))), F.array(F.lit(""))))
    return files.select(F.explode(held).alias("w")).groupBy("w").agg(F.count("*").alias("n"))


def statistics(seen: DataFrame) -> tuple[int, dict[str, float]]:
    """(rows, idf per template word) from ``document_frequencies``."""
    vocabulary = sorted({w for c in template_words().values() for w in c})
    df = {r["w"]: r["n"] for r in seen.filter(F.col("w").isin("", *vocabulary)).collect()}
    n = df.get("", 0)  # the empty word is in every row
    return n, {w: 1 + math.log((n + 1) / (df.get(w, 0) + 1)) for w in vocabulary}


def required_words(idf: dict[str, float], cosine: float) -> list[str]:
    """Words of which a line needs one at least to reach ``cosine`` with any template."""
    out = set()
    for counts in template_words().values():
        weight = {w: n * idf[w] for w, n in counts.items()}
        limit, dropped = cosine**2 * 0.999 * sum(x * x for x in weight.values()), 0.0
        for w in sorted(weight, key=lambda w: (weight[w], w)):
            dropped += weight[w] ** 2
            if dropped >= limit:
                out.add(w)
    return sorted(out)


def score_lines(lines: DataFrame, seen: DataFrame, n: int, idf: dict[str, float], cosine: float) -> DataFrame:
    """key, license, score for the distinct lines that reach ``cosine``.  Only
    keys, not texts, are shuffled with the words."""
    spark = lines.sparkSession
    rows = []
    for name, counts in template_words().items():
        norm = math.sqrt(sum((k * idf[w]) ** 2 for w, k in counts.items()))
        rows += [(w, name, k * idf[w] / norm) for w, k in counts.items()]
    templates = F.broadcast(spark.createDataFrame(rows, "w string, license string, share double"))
    tf = lines.select("key", "line").dropDuplicates(["key"]).select("key", F.explode(words(F.col("line"))).alias("w")).groupBy("key", "w").agg(F.count("*").alias("tf"))
    # The document frequencies of the lines' words alone; few beside those of all words.
    known = stored(seen.join(tf.select("w").distinct(), "w", "left_semi"), "known")
    weighted = tf.join(known, "w", "left").select("key", "w", (F.col("tf") * (1 + F.log((n + 1) / (F.col("n") + 1)))).alias("x"))
    both = weighted.join(templates, "w", "left").groupBy("key", "license").agg(F.sum(F.col("x") * F.col("share")).alias("dot"))
    norm = weighted.groupBy("key").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    scored = both.filter("license IS NOT NULL").join(norm, "key").select("key", "license", F.round(F.col("dot") / F.col("norm"), 6).alias("score"))
    return scored.filter(F.col("score") >= cosine).groupBy("key").agg(F.min(F.struct((-F.col("score")).alias("minus"), F.col("license"))).alias("b")).select(
        "key", F.col("b.license").alias("license"), (-F.col("b.minus")).alias("score"))


def _parent(path: Column) -> Column:
    """Directory of a path, without the last slash; empty for the root."""
    return F.regexp_replace(F.regexp_replace(path, "/[^/]*$", ""), "^[^/]+$", "")


def ancestors(directory: Column) -> Column:
    """The directory and everything above it, up to the root."""
    parts = F.split(directory, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))


def _is_license(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1).rlike(FILE_NAME)


def candidates(path: Column, text: Column) -> Column:
    """Lines of ``text``, windows of up to ``WRAP`` of them, and a licence file's
    whole text; windows beyond the end are null."""
    lines = F.split(text, "\n")
    windows = [lines]
    for k in range(2, WRAP + 1):
        windows.append(F.zip_with(windows[-1], F.slice(lines, k, F.size(lines)), lambda a, b: F.concat(a, F.lit("\n"), b)))
    return F.flatten(F.array(*windows, F.when(_is_license(path), F.array(text)).otherwise(F.array().cast("array<string>"))))


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text", cosine: float = COSINE) -> DataFrame:
    """path, own_license, own_score, license, license_from (the directory it is
    inherited from; null if own or none) of every row of ``files``."""
    # Rows may share a path (all null ones do), so a row is its path and its text.
    slim = files.select(F.coalesce(path_col, F.lit("/")).alias("path"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("own"))
    seen = stored(document_frequencies(slim), "words")
    n, idf = statistics(seen)
    need = required_words(idf, cosine)
    listed = F.array(*map(F.lit, need))
    # Few texts have a required word; only those are taken apart into lines.
    split = slim.filter(F.arrays_overlap(words(F.col("text")), listed)).select("path", "own", F.posexplode(candidates(F.col("path"), F.col("text"))).alias("at", "line"))
    lines = stored(split.filter(F.arrays_overlap(words(F.col("line")), listed)).withColumn("key", F.unhex(F.sha2("line", 256))), "lines")
    best = lines.select("path", "own", "at", "key").join(score_lines(lines, seen, n, idf, cosine), "key").groupBy("path", "own").agg(
        F.min(F.struct((-F.col("score")).alias("minus"), F.col("license"), F.col("at"))).alias("b")).select(
        F.col("path").alias("_path"), F.col("own").alias("_own"), F.col("b.license").alias("own_license"), (-F.col("b.minus")).alias("own_score"))
    best = stored(best, "own")
    directory = _parent(F.col("_path"))
    given = best.filter(_is_license(F.col("_path"))).groupBy(directory.alias("above")).agg(
        F.min(F.struct((-F.col("own_score")).alias("minus"), F.col("own_license").alias("license"))).alias("b")).select("above", F.col("b.license").alias("license"))
    all_ = slim.select("path", "own", _parent(F.col("path")).alias("directory"))
    unfolded = all_.select("directory").distinct().select("directory", F.explode(ancestors(F.col("directory"))).alias("above"))
    nearest = unfolded.join(given, "above").groupBy("directory").agg(F.max(F.struct(F.length("above").alias("n"), "above", "license")).alias("b")).select(
        "directory", F.col("b.above").alias("_from"), F.col("b.license").alias("_license"))
    joined = all_.join(best, (all_["path"] == best["_path"]) & (all_["own"] == best["_own"]), "left").join(nearest, "directory", "left")
    return joined.select("path", "own_license", "own_score", F.coalesce("own_license", "_license").alias("license"),
                         F.when(F.col("own_license").isNull(), F.col("_from")).alias("license_from"))


#: Documents of at most this many characters stand in for licence files.
NOTE_CHARS = 200


def documents_as_files(docs: DataFrame) -> DataFrame:
    """``documents`` as a tree: /source/thousand/ten/id.txt; short notes are
    LICENSE files of the directory whose level their id names (id mod 3)."""
    up = [F.col("source"), F.floor(F.col("doc_id") / 1000).cast("string"), F.floor(F.col("doc_id") / 10).cast("string")]
    level = F.pmod("doc_id", F.lit(3))
    folder = F.when(level == 0, up[0]).when(level == 1, F.concat_ws("/", *up[:2])).otherwise(F.concat_ws("/", *up))
    note = F.length(F.coalesce("text", F.lit(""))) <= NOTE_CHARS
    name = F.when(note, F.concat(folder, F.lit("/LICENSE."), F.col("doc_id").cast("string"))).otherwise(F.concat(F.concat_ws("/", *up), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")))
    return docs.select(F.concat(F.lit("/"), name).alias("path"), "text")


def oracle() -> str:
    """DuckDB SQL of the query; every line is scored."""
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    split = lambda c: f"list_filter(string_split_regex({low.format(c)}, '{_NOT_WORD}'), lambda w: w <> '')"
    rows = ", ".join(f"('{w}', '{name}', {k})" for name, c in template_words().items() for w, k in c.items())
    return f"""
WITH f AS (
  SELECT coalesce(text, '') AS text, '/' || CASE WHEN length(coalesce(text, '')) <= {NOTE_CHARS} THEN
      CASE doc_id % 3 WHEN 0 THEN source WHEN 1 THEN source || '/' || (doc_id // 1000) ELSE source || '/' || (doc_id // 1000) || '/' || (doc_id // 10) END || '/LICENSE.' || doc_id
    ELSE source || '/' || (doc_id // 1000) || '/' || (doc_id // 10) || '/' || doc_id || '.txt' END AS path
  FROM documents
), t(w, license, k) AS (VALUES {rows}),
n AS (SELECT count(*) AS n FROM f),
df AS (SELECT w, count(*) AS c FROM (SELECT unnest(list_distinct({split('text')})) AS w FROM f) GROUP BY w),
idf AS (SELECT w, 1 + ln((n + 1) / (coalesce(c, 0) + 1)) AS idf FROM (SELECT DISTINCT w FROM t) LEFT JOIN df USING (w), n),
tw AS (SELECT w, license, k * idf / sqrt(sum((k * idf) ** 2) OVER (PARTITION BY license)) AS share FROM t JOIN idf USING (w)),
line AS (SELECT path, line, {split('line')} AS ws FROM (SELECT path, unnest(string_split(text, chr(10))) AS line FROM f)),
l AS (SELECT DISTINCT line, ws FROM line WHERE list_has_any(ws, (SELECT list(DISTINCT w) FROM t))),
x AS (SELECT line, w, tf * coalesce(idf, 1 + ln(n + 1)) AS x FROM (SELECT line, w, count(*) AS tf FROM (SELECT line, unnest(ws) AS w FROM l) GROUP BY ALL) LEFT JOIN idf USING (w), n),
s AS (SELECT line, license, round(sum(x * share) / any_value(norm), 6) AS score FROM x JOIN tw USING (w) JOIN (SELECT line, sqrt(sum(x * x)) AS norm FROM x GROUP BY line) USING (line) GROUP BY ALL),
b AS (SELECT line, license, score FROM s WHERE score >= {COSINE} QUALIFY row_number() OVER (PARTITION BY line ORDER BY score DESC, license) = 1),
own AS (SELECT path, license AS own_license, score AS own_score FROM line JOIN b USING (line) QUALIFY row_number() OVER (PARTITION BY path ORDER BY score DESC, license) = 1),
given AS (
  SELECT regexp_replace(path, '/[^/]*$', '') AS above, own_license AS license FROM own WHERE regexp_matches(path, '/LICENSE[^/]*$')
  QUALIFY row_number() OVER (PARTITION BY above ORDER BY own_score DESC, own_license) = 1
),
near AS (
  SELECT dir, above, license FROM (SELECT DISTINCT regexp_replace(path, '/[^/]*$', '') AS dir FROM f) JOIN given ON dir = above OR starts_with(dir, above || '/')
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY length(above) DESC) = 1
)
SELECT path, own_license, own_score, coalesce(own_license, license) AS license, CASE WHEN own_license IS NULL THEN above END AS license_from
FROM f LEFT JOIN own USING (path) LEFT JOIN near ON near.dir = regexp_replace(path, '/[^/]*$', '')"""

"""Licence scan of file trees: SPDX tags, sparse TF-IDF cosine of notices, headers and licence files to short notices and
to the full texts, standard headers and titles in ``resources/licences``, then inheritance from the nearest ancestor
directory that has a licence. DataFrame functions only.
"""

from __future__ import annotations

import math
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.llm.common import cut
from flowguard.llm.stand_ins import FILES_SQL, files

#: SPDX names and the short notices by which texts refer to a licence.
TEMPLATES = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms are permitted under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms are permitted under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "Subject to the terms of the Mozilla Public License, version 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain, see the Unlicense."),
)
#: Names of licence files (upper case, without ending), and words by which a line may be a notice.
LICENCE_FILES = ("LICENSE", "LICENCE", "COPYING", "UNLICENSE")
NOTICE = r"(?i)licen[cs]e|copyright|spdx|public domain|redistribution|cc0"
#: A term, and the least cosine at which a notice counts as a template's.
TERM, LEAST = r"[a-z0-9]+(?:[.-][a-z0-9]+)*", 0.6
#: Files <licence>.<full, header or title>.txt, and the least cosine by kind. A title names little else than the licence:
#: one without its version or number of clauses must not count as any.
TEXTS = Path(__file__).resolve().parent.parent / "resources" / "licences"
LEAST_OF = {"full": LEAST, "header": LEAST, "title": 0.85}
#: Paragraphs that a header or a licence text inside a file may go on for.
WINDOW = 6
SPDX = r"(?i)SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+():/ \t-]+)"
#: How a line of a comment starts, and how a block of comment ends.
MARK, CLOSE = r"(?://|#|/\*|\*|--|;|%)", r"(\*/|-->|\"\"\"|''')[ \t]*\n"


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def licence_texts() -> list[tuple[str, str, str]]:
    """(licence, kind, text) of the files of TEXTS."""
    return [(*f.name.removesuffix(".txt").rsplit(".", 1), f.read_text("utf-8")) for f in sorted(TEXTS.glob("*.txt"))]


def template_terms(spark: SparkSession) -> tuple[DataFrame, Column]:
    """(corpus, template, licence, least, term, idf, weight): unit vectors of the templates, of the short notices (corpus
    0) and of the texts (corpus 1), each with its own idf; and the idf of terms that no template of a corpus has. Its size
    is that of the templates."""
    rows = [(0, n, t, LEAST) for n, t in TEMPLATES] + [(1, n, t, LEAST_OF[k]) for n, k, t in licence_texts()]
    n = [sum(r[0] == c for r in rows) for c in (0, 1)]
    tf = (spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                                "template int, corpus int, licence string, notice string, least double")
          .select("corpus", "template", "licence", "least", F.explode(terms(F.col("notice"))).alias("term"))
          .groupBy("corpus", "template", "licence", "least", "term").agg(F.count("*").alias("tf")))
    of_corpus = lambda x: F.when(F.col("corpus") == 0, F.lit(x[0])).otherwise(F.lit(x[1]))
    idf = tf.groupBy("corpus", "term").agg(F.count("*").alias("df")).select(
        "corpus", "term", (F.log(of_corpus([1.0 + k for k in n]) / (1.0 + F.col("df"))) + 1.0).alias("idf"))
    vectors = tf.join(idf, ["corpus", "term"]).withColumn("w", F.col("tf") * F.col("idf"))
    norms = vectors.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return vectors.join(norms, "template").select("corpus", "template", "licence", "least", "term", "idf", (
        F.col("w") / F.col("norm")).alias("weight")), of_corpus([math.log(1.0 + k) + 1.0 for k in n])


def paragraphs(text: Column) -> Column:
    """Blocks of lines with a letter or digit; a block also ends where a comment or its marks end or begin."""
    out = F.regexp_replace(F.translate(text, "\r", ""), CLOSE, "$1\n\n")
    out = F.regexp_replace(out, rf"(?m)^([ \t]*+{MARK}[^\n]*)\n(?=[ \t]*+(?!{MARK})\S)", "$1\n\n")
    out = F.regexp_replace(out, rf"(?m)^([ \t]*+(?!{MARK})\S[^\n]*)\n(?=[ \t]*+{MARK})", "$1\n\n")
    return F.split(F.regexp_replace(out, r"(?m)^[^\p{L}\p{N}\n]+$", ""), "\n{2,}")


def passages(rows: DataFrame) -> DataFrame:
    """(path, file_id, at, short, passage): every line that may be a notice, each such sentence of it and each short
    notice in the middle of it; every paragraph that may be one, alone and with up to WINDOW - 1 of those that follow;
    of a licence file its whole text as well. Passages that are only paragraphs are not compared with the short notices
    (short is false)."""
    some = rows.where(F.col("is_licence") | F.col("text").rlike(NOTICE))
    may = lambda x: x.rlike(NOTICE)
    plain = lambda x: F.concat(F.lit(" "), F.array_join(terms(x), " "), F.lit(" "))
    notices = F.array(*[F.struct(F.lit(t).alias("t"), plain(F.lit(t)).alias("p")) for _, t in TEMPLATES])
    lines = some.select("path", "file_id", F.explode(F.filter(F.split("text", "\n"), may)).alias("line"))
    sentences = F.filter(F.split("line", r"(?<=[.!?])\s+"), may)
    within = F.transform(F.filter(notices, lambda n: F.contains(F.col("_plain"), n["p"])), lambda n: n["t"])
    of_lines = (lines.withColumn("_plain", plain(F.col("line")))
                .select("path", "file_id", F.explode(F.array_distinct(F.concat(F.array("line"), sentences, within))).alias("passage"))
                .withColumn("short", F.lit(True)))
    parts = (some.select("path", "file_id", paragraphs(F.col("text")).alias("all"))
             .select("path", "file_id", "all", F.posexplode("all").alias("i", "one")).where(may(F.col("one"))))
    windows = F.transform(F.sequence(F.lit(1), F.least(F.lit(WINDOW), F.size("all") - F.col("i"))),
                          lambda k: F.array_join(F.slice("all", F.col("i") + 1, k), "\n"))
    of_parts = parts.select("path", "file_id", F.explode(windows).alias("passage")).withColumn("short", F.lit(False))
    whole = some.where("is_licence").select("path", "file_id", F.col("text").alias("passage"), F.lit(True).alias("short"))
    return (of_lines.unionByName(of_parts).unionByName(whole)
            .groupBy("path", "file_id", F.xxhash64("passage").alias("at"))
            .agg(F.max("short").alias("short"), F.first("passage").alias("passage")))


def tagged(rows: DataFrame) -> DataFrame:
    """(path, file_id, licence): the SPDX expression of a file's tags, all that differ joined by AND. The names of
    TEMPLATES stand for their -only and -or-later forms as well; other names are given as they are."""
    tags = F.transform(F.regexp_extract_all("text", F.lit(SPDX), F.lit(1)),
                       lambda t: F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace(t, r"[\s-]+$", "")),
                                                                   r"(?i)-(?:only|or-later)\b|\+", ""), r"\s+", " "))
    names = F.array_sort(F.array_distinct(F.filter(tags, lambda t: t.rlike("[A-Za-z0-9]"))))
    known = F.create_map(*[F.lit(x) for n in sorted({n for n, *_ in [*TEMPLATES, *licence_texts()]}) for x in (n.lower(), n)])
    named = F.transform(names, lambda t: F.coalesce(known[F.lower(t)], F.when(
        (F.size(names) > 1) & t.contains(" "), F.concat(F.lit("("), t, F.lit(")"))).otherwise(t)))
    return (rows.where(F.col("text").rlike("(?i)SPDX-License-Identifier:"))
            .select("path", "file_id", F.array_join(F.array_sort(F.array_distinct(named)), " AND ").alias("licence"))
            .where("licence <> ''"))


def own_licences(rows: DataFrame) -> DataFrame:
    """(path, file_id, own, score): the licence of a file's SPDX tags (score 1), else the template nearest to any passage
    of the file, if its least cosine or more; ties go to the first name.

    Cosines come from sums over shared terms: passages' terms are counted before they meet the templates, whose terms
    (about ten thousand rows) are broadcast. Passages are exchanged once, when repeated ones are dropped; all sums of a
    passage (its norm under template -1, its dots) are made where it lies.
    """
    template, unknown = template_terms(rows.sparkSession)
    key = ["path", "file_id", "at", "corpus"]
    corpora = F.when(F.col("short"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))
    found = passages(rows).select("path", "file_id", "at", F.explode(corpora).alias("corpus"), "passage")
    tf = found.select(*key, F.explode(terms(F.col("passage"))).alias("term")).groupBy(*key, "term").agg(F.count("*").alias("tf"))
    about = template.groupBy("corpus", "term").agg(
        F.first("idf").alias("idf"), F.collect_list(F.struct("template", "weight")).alias("in"))
    known = tf.join(F.broadcast(about), ["corpus", "term"], "left").withColumn("w", F.col("tf") * F.coalesce("idf", unknown))
    square = F.struct(F.lit(-1).alias("template"), (F.col("w") * F.col("w")).alias("x"))
    dots = F.transform(F.coalesce("in", F.array().cast("array<struct<template:int,weight:double>>")),
                       lambda t: F.struct(t["template"].alias("template"), (F.col("w") * t["weight"]).alias("x")))
    sums = (known.select(*key, F.explode(F.concat(F.array(square), dots)).alias("s"))
            .groupBy(*key, F.col("s.template").alias("template")).agg(F.sum("s.x").alias("x")))
    norm = F.sqrt(F.max(F.when(F.col("template") == -1, F.col("x"))))
    near = sums.groupBy(*key).agg(norm.alias("norm"), F.collect_list(F.when(
        F.col("template") >= 0, F.struct("template", F.col("x").alias("dot")))).alias("dots"))  # at most one a template
    names = template.select("template", "licence", "least").distinct()
    # equal cosines may differ in their last digits: they are compared and given to nine places
    near = (near.select("path", "file_id", "norm", F.explode("dots").alias("d"))
            .select("path", "file_id", "d.template", F.round(F.col("d.dot") / F.col("norm"), 9).alias("score"))
            .join(F.broadcast(names), "template").where(F.col("score") >= F.col("least"))
            .select("path", "file_id", "licence", "score", F.lit(1).alias("rank")))
    tags = tagged(rows).select("path", "file_id", "licence", F.lit(1.0).alias("score"), F.lit(0).alias("rank"))
    return (near.unionByName(tags).groupBy("path", "file_id")
            .agg(F.min(F.struct("rank", (-F.col("score")).alias("s"), "licence")).alias("best"))
            .select("path", "file_id", F.col("best.licence").alias("own"), (-F.col("best.s")).alias("score")))


def folder_of(path: Column) -> Column:
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.lit(""))


def scan(df: DataFrame, file_id: str = "file_id", path: str = "path", text: str = "text") -> DataFrame:
    """(file_id, path, own, score, licence, origin, licence_folder) for every row of ``df``.

    own is the licence of the file's SPDX tags (score 1), else of its notices, headers or text (score: cosine). licence is own (origin 'own'), else that of the licence
    file in the nearest folder on the way up to the root '' (origin 'inherited', licence_folder), else null. Several
    licence files of a folder: the best score counts, then the first licence by name. Null and empty texts have no
    notice; a null path inherits nothing. Texts are read whole. Repeated rows (same id and path) each get their row; an
    empty table gives none. Folders, not files, walk up the tree: each folder asks once for its ancestors.
    """
    name = F.upper(F.regexp_replace(F.regexp_replace(F.col(path), "^.*/", ""), "[.][^.]*$", ""))
    rows = df.select(F.col(file_id).alias("file_id"), F.col(path).alias("path"), F.coalesce(text, F.lit("")).alias("text"),
                     F.coalesce(name.isin(*LICENCE_FILES), F.lit(False)).alias("is_licence"),
                     folder_of(F.col(path)).alias("folder"))
    own = cut(own_licences(rows.select("file_id", "path", "is_licence", "text").where("path IS NOT NULL")))
    marked = own.withColumn("_name", F.upper(F.regexp_replace(F.regexp_replace("path", "^.*/", ""), "[.][^.]*$", "")))
    of_folder = (marked.where(F.col("_name").isin(*LICENCE_FILES)).withColumn("folder", folder_of(F.col("path")))
                 .groupBy("folder").agg(F.min(F.struct((-F.col("score")).alias("s"), "own")).alias("b"))
                 .select(F.col("folder").alias("up"), F.col("b.own").alias("given")))
    folders = rows.select("folder").where("folder IS NOT NULL").distinct()
    parts = F.split("folder", "/")
    ups = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    nearest = (folders.withColumn("up", F.explode(F.array_distinct(ups))).join(of_folder, "up")
               .groupBy("folder").agg(F.max(F.struct(F.length("up").alias("n"), "up", "given")).alias("b"))
               .select("folder", F.col("b.given").alias("inherited"), F.col("b.up").alias("from_folder")))
    plain = rows.select("file_id", "path", "folder")
    out = (plain.join(own.withColumnsRenamed({"path": "_path", "file_id": "_id"}),
                      F.col("path").eqNullSafe(F.col("_path")) & F.col("file_id").eqNullSafe(F.col("_id")), "left")
           .join(nearest, "folder", "left"))
    lacks = F.col("own").isNull()
    return out.select(
        "file_id", "path", "own", "score", F.coalesce("own", "inherited").alias("licence"),
        F.when(~lacks, "own").when(F.col("inherited").isNotNull(), "inherited").alias("origin"),
        F.when(lacks, F.col("from_folder")).alias("licence_folder"))


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(files(spark, sf_dir))


OP3_SQL = "WITH" + FILES_SQL + r""",
r AS (SELECT file_id, path, coalesce(text, '') AS text, regexp_replace(path, '/[^/]*$', '') AS folder,
      path LIKE '%/LICENSE' AS is_licence FROM files),
l AS (SELECT file_id, path, i AS line_no, string_split(text, chr(10))[i + 1] AS passage
      FROM (SELECT *, unnest(range(len(string_split(text, chr(10))))) AS i FROM r)),
p AS (SELECT * FROM l WHERE regexp_matches(passage, '(?i)licen[cs]e|copyright|spdx|public domain|redistribution|cc0')
      UNION ALL SELECT file_id, path, -1, text FROM r WHERE is_licence),
t0 (licence, notice) AS (VALUES """ + ", ".join(f"('{a}', '{b}')" for a, b in TEMPLATES) + r"""),
t1 AS (SELECT licence, term, count(*) AS tf FROM (SELECT licence,
       unnest(regexp_extract_all(lower(notice), '[a-z0-9]+(?:[.-][a-z0-9]+)*')) AS term FROM t0) GROUP BY ALL),
idf AS (SELECT term, ln((1.0 + (SELECT count(*) FROM t0)) / (1.0 + count(*))) + 1.0 AS idf FROM t1 GROUP BY term),
t2 AS (SELECT licence, term, tf * idf AS w FROM t1 JOIN idf USING (term)),
t3 AS (SELECT licence, term, w / sqrt(sum(w * w) OVER (PARTITION BY licence)) AS weight FROM t2),
f AS (SELECT file_id, path, line_no, term, count(*) AS tf FROM (SELECT file_id, path, line_no,
      unnest(regexp_extract_all(lower(passage), '[a-z0-9]+(?:[.-][a-z0-9]+)*')) AS term FROM p) GROUP BY ALL),
g AS (SELECT f.*, f.tf * coalesce(idf, ln(1.0 + (SELECT count(*) FROM t0)) + 1.0) AS w FROM f LEFT JOIN idf USING (term)),
n AS (SELECT file_id, path, line_no, sqrt(sum(w * w)) AS norm FROM g GROUP BY ALL),
c AS (SELECT file_id, path, licence, round(sum(w * weight) / any_value(norm), 9) AS score
      FROM g JOIN t3 USING (term) JOIN n USING (file_id, path, line_no) GROUP BY file_id, path, line_no, licence),
o AS (SELECT file_id, path, arg_min(licence, (-score, licence)) AS own, max(score) AS score FROM c WHERE score >= 0.6
      GROUP BY file_id, path),
d AS (SELECT folder, arg_min(own, (-score, own)) AS given FROM o JOIN r USING (file_id, path) WHERE is_licence
      GROUP BY folder),
x AS (SELECT a.folder, arg_max(b.given, length(b.folder)) AS inherited, arg_max(b.folder, length(b.folder)) AS up
      FROM (SELECT DISTINCT folder FROM r) a JOIN d b ON a.folder = b.folder OR starts_with(a.folder, b.folder || '/')
      GROUP BY a.folder)
SELECT r.file_id, r.path, own, score, coalesce(own, inherited) AS licence,
       CASE WHEN own IS NOT NULL THEN 'own' WHEN inherited IS NOT NULL THEN 'inherited' END AS origin,
       CASE WHEN own IS NULL THEN up END AS licence_folder
FROM r LEFT JOIN o USING (file_id, path) LEFT JOIN x USING (folder)
"""

"""License scan in built-in functions: TF-IDF matching and directory inheritance.

Statements.  Every line of every file (header or anywhere else) is compared with
licence templates by the cosine of sparse TF-IDF vectors, and so are windows of
a template's length over the words of the file, where they cross lines (wrapped notices) or
lie in a line of more than ``LONG_LINE`` words, and the whole text of a licence
file by name or of at most ``WHOLE`` words.  Of lines and windows that share
a line the better ones are statements; a whole text is one where it has no other.
The inverse document frequency of the template words is
counted over all lines.  A word outside the templates adds the largest idf to
the length of a vector, so prose around a statement in a line lowers its cosine.  Before any join, a
line or window must hold one of the *necessary* words: those rarest words of a template
without which the cosine to it cannot reach the threshold (the other words
carry less than that share of its length).  A window is laid around each necessary word
so that the word has the place it has in the template.  The rest is a sparse join on words.

Inheritance.  A file without a statement takes the licence of the nearest
directory above it that has a licence file: directories are joined to the paths
above them, after the files of a directory have been reduced to one row, and the
way back to the files is salted, so a directory that holds a third of all files
is no hot key.

The templates are a fixed table of the caller (rows, not text in the corpus), so
the template side of the join is small by construction.

Defined cases: null text has no lines, a null path is the root directory's file
''; equal scores go to the first licence id in alphabetical order; identical rows get
a row each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from threadline.llm.common import checkpointed, documents

#: Licence ids and their usual notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright; released under CC0 1.0."),
)
THRESHOLD = 0.75
#: A text is a licence file if at least this share of its words stands in licence statements, or by its name.
FILE_SHARE = 0.8
FILE_NAME = r"(?i)(^|/)(licen[sc]e|copying|copyright|notice|unlicense)([._-][^/]*)?$"
SALTS = 16
#: Words of a line that is searched by windows, words that share one row in that search, words of a short whole text.
LONG_LINE, CHUNK, WHOLE = 48, 64, 128
LINE, WINDOW, TEXT = 0, 1, 2
#: Between words: anything but letters, digits and dots before a digit (versions such as 2.0).  Not a repeated group: Java
#: recurses once for each repeat, and a run of some thousand characters would overflow a task's stack and end its executor.
WORD_BREAK = r"[^a-z0-9.]+|\.+(?![0-9])"


def line_words(line: Column) -> Column:
    """Lower-case words."""
    return F.array_remove(F.split(F.lower(line), WORD_BREAK), "")


def _template_vectors(templates) -> dict[str, list]:
    """Words with frequency per template, as in :func:`line_words`."""
    out = {}
    for k, (name, text) in enumerate(templates):
        words = [w for w in re.split(WORD_BREAK, text.lower()) if w]
        out[k] = (name, {w: words.count(w) for w in words})
    return out


def lines(files: DataFrame) -> DataFrame:
    """(key, text, no, w): the words of every line.

    The words are made inside the generator, so later filters on them do not
    repeat the regular expressions.
    """
    return files.select("key", "text", F.posexplode(F.transform(F.split("text", "[\n\r]+"), line_words)).alias("no", "w"))


def _units(files: DataFrame, needed: list[str], anchors: DataFrame, width: int) -> DataFrame:
    """(key, kind, no, only, first, last, w, file_words): the lines, windows and whole texts with necessary words.

    ``no`` is the number of a line and the first word of a window; ``first`` and ``last`` are the lines of its
    template words, ``only`` the template of a window (-1: all).  Identical rows have one of each.
    A one-element explode holds arrays fast that later expressions read many times.
    """
    lines_of = files.select("key", "named", F.explode(F.array(F.transform(F.split("text", "[\n\r]+"), line_words))).alias("ws"))
    tagged = F.flatten(F.transform("ws", lambda w, i: F.transform(w, lambda x: F.struct(
        x.alias("word"), i.alias("no"), (F.size(w) > LONG_LINE).alias("long")))))
    near = (lines_of.where(F.exists("ws", lambda w: F.exists(w, lambda x: x.isin(needed))))
            .select("key", "named", "ws", F.explode(F.array(tagged)).alias("flat")))

    def unit(kind, no, end, words):
        return F.struct(F.lit(kind).alias("kind"), no.cast("int").alias("no"), end.cast("int").alias("end"), words.alias("words"))

    zero, size = F.lit(0), F.size("flat")
    line = F.transform(F.filter(F.transform("ws", lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
                                lambda x: F.exists(x["w"], lambda y: y.isin(needed))),
                       lambda x: unit(LINE, x["i"], x["i"], F.transform(x["w"], lambda y: F.struct(
                           y.alias("word"), x["i"].alias("no"), F.lit(False).alias("long")))))
    # neighbouring words: a core of CHUNK words from ``end`` on, and up to a template's length on both sides from ``no`` on
    chunk = F.transform(
        F.filter(F.sequence(zero, size - 1, F.lit(CHUNK)),
                 lambda at: F.exists(F.slice("flat", at + 1, CHUNK), lambda x: x["word"].isin(needed))),
        lambda at: unit(WINDOW, F.greatest(at - width, zero), at, F.slice(
            "flat", F.greatest(at - width, zero) + 1, at + CHUNK + width - F.greatest(at - width, zero))))
    whole = F.when(F.col("named") | (size <= WHOLE), F.array(unit(TEXT, zero, zero, F.col("flat"))))
    pieces = checkpointed(near.select("key", size.alias("file_words"), F.explode(F.concat(
        line, chunk, F.coalesce(whole, F.filter(line, lambda x: F.lit(False))))).alias("u")).select("key", "file_words", "u.*"))

    own = (pieces.where(F.col("kind") != WINDOW)
           .select("key", "kind", "no", F.lit(-1).alias("only"), F.col("no").alias("first"), F.col("no").alias("last"),
                   F.col("words.word").alias("w"), "file_words"))
    core = F.transform(F.slice("words", F.col("end") - F.col("no") + 1, CHUNK),
                       lambda x, i: F.struct((F.col("end") + i).alias("p"), x["word"].alias("word")))
    start = F.greatest(F.col("a.p") - F.col("place"), zero)
    match = F.filter("win", lambda x: F.map_contains_key("squares", x["word"]))
    seen = F.aggregate(F.array_intersect(F.col("win.word"), F.map_keys("squares")), F.lit(0.0),
                       lambda acc, x: acc + F.element_at("squares", x))
    windows = (pieces.where(F.col("kind") == WINDOW)
               .select("key", "file_words", "no", "words", F.explode(F.filter(core, lambda x: x["word"].isin(needed))).alias("a"))
               .join(F.broadcast(anchors), F.col("a.word") == F.col("anchor"))
               .select("key", "file_words", "only", "squares", "least", start.alias("at"), F.explode(F.array(F.slice(
                   "words", start - F.col("no") + 1, F.col("a.p") - F.col("place") + F.col("size") - start))).alias("win"))
               .where(seen >= F.col("least")).withColumn("match", match)
               .select("key", F.lit(WINDOW).alias("kind"), F.col("at").alias("no"), "only", F.element_at("match", 1)["no"].alias("first"),
                       F.element_at("match", -1)["no"].alias("last"), F.col("win.word").alias("w"), "file_words",
                       F.element_at("match", 1)["long"].alias("long"))
               .where((F.col("first") < F.col("last")) | F.col("long")).drop("long"))
    return checkpointed(own.unionByName(windows).dropDuplicates(["key", "kind", "no", "only"]))


def statements(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(key, kind, no, only, n_words, file_words, license, score): lines, windows and whole texts whose best template reaches
    the threshold, the better ones of those that share a line; ``named`` tells licence files by name."""
    spark = files.sparkSession
    vectors = _template_vectors(templates)
    vocabulary = sorted({w for _, v in vectors.values() for w in v})
    found = lines(files)

    # document frequency over all lines, of the template words only (a bounded table)
    own = F.array_distinct(F.filter("w", lambda x: x.isin(vocabulary)))
    counted = found.select(F.explode(F.concat(own, F.array(F.lit("")))).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    df = {r.word: r.df for r in counted.collect()}
    n_lines = df.get("", 0)
    idf_of = {w: _idf(n_lines, df.get(w, 0)) for w in vocabulary}
    far = _idf(n_lines, 0)

    # necessary words: leave out frequent words of a template while their share of its length stays below the threshold
    needed: set[str] = set()
    places = []
    for k, (_, v) in vectors.items():
        weight = {w: (tf * idf_of[w]) ** 2 for w, tf in v.items()}
        total, spare, own_needed = sum(weight.values()), 0.0, set()
        for w in sorted(weight, key=lambda w: (-df.get(w, 0), w)):
            spare += weight[w]
            if (spare / total) ** 0.5 >= threshold:
                own_needed.add(w)
        needed |= own_needed
        words = [w for w in re.split(WORD_BREAK, templates[k][1].lower()) if w]
        places += [(k, w, q, len(words), {x: float(y) for x, y in weight.items()}, float(total * threshold**2 * (1 - 1e-9)))
                   for q, w in enumerate(words) if w in own_needed]
    rows = [(k, name, w, float(tf * idf_of[w]), float(sum((f * idf_of[x]) ** 2 for x, f in v.items()) ** 0.5))
            for k, (name, v) in vectors.items() for w, tf in v.items()]
    table = spark.createDataFrame(rows, "template int, license string, word string, weight double, length double")
    idf = spark.createDataFrame([(w, float(x)) for w, x in idf_of.items()], "word string, idf double")

    anchors = spark.createDataFrame(places, "only int, anchor string, place int, size int, squares map<string,double>, least double")
    near = _units(files, sorted(needed), anchors, max([p[3] for p in places], default=1))
    unit = ["key", "kind", "no", "only", "n_words"]
    terms = (near.select("key", "kind", "no", "only", F.size("w").alias("n_words"), F.explode("w").alias("word"))
             .groupBy(*unit, "word").agg(F.count("*").alias("tf")).join(idf, "word"))
    norm = (terms.groupBy(*unit).agg(F.sum((F.col("tf") * F.col("idf")) ** 2).alias("sq"), F.sum("tf").alias("n_in"))
            .select(*unit, F.sqrt(F.col("sq") + (F.col("n_words") - F.col("n_in")) * F.lit(far**2)).alias("norm")))
    dots = (terms.join(table, "word").where((F.col("only") < 0) | (F.col("only") == F.col("template"))).groupBy(*unit, "template", "license", "length")
            .agg(F.sum(F.col("tf") * F.col("idf") * F.col("weight")).alias("dot")))
    scored = (dots.join(norm, unit)
              .withColumn("score", F.round(F.col("dot") / (F.col("norm") * F.col("length")), 9)).where(F.col("score") >= threshold))
    best = F.max_by(F.struct("license", "score"), F.struct("score", F.col("template") * -1))
    about = near.select("key", "kind", "no", "only", F.size("w").alias("n_words"), "first", "last", "file_words")
    hits = checkpointed(scored.groupBy(*unit).agg(best.alias("b")).join(about, unit)
                        .select(*unit, "first", "last", "file_words", "b.license", "b.score"))

    # a line under a better window and a window over a line as good are no statements of their own
    shared = Window.partitionBy("key", "line")
    on = hits.where(F.col("kind") != TEXT).withColumn("line", F.explode(F.sequence("first", "last")))
    other = F.when(F.col("kind") == LINE, F.max(F.when(F.col("kind") == WINDOW, F.col("score"))).over(shared) > F.col("score"))
    other = other.otherwise(F.max(F.when(F.col("kind") == LINE, F.col("score"))).over(shared) >= F.col("score"))
    kept = (on.withColumn("lost", F.coalesce(other, F.lit(False))).groupBy(*unit, "file_words", "license", "score")
            .agg(F.max("lost").alias("lost")).where(~F.col("lost")).drop("lost"))
    alone = hits.where(F.col("kind") == TEXT).join(kept.select("key").distinct(), "key", "left_anti")
    return kept.unionByName(alone.select(*kept.columns))


def _spread(spans: Column) -> Column:
    """(n, covered) of windows (start, end): how many lie side by side, and the words under any of them."""
    none = F.struct(F.lit(0).alias("n"), F.lit(0).alias("stop"), F.lit(0).alias("reach"), F.lit(0).alias("covered"))
    return F.aggregate(F.array_sort(spans), none, lambda a, x: F.struct(
        (a["n"] + F.when((a["n"] == 0) | (x["start"] >= a["stop"]), 1).otherwise(0)).alias("n"),
        F.when((a["n"] == 0) | (x["start"] >= a["stop"]), x["end"]).otherwise(F.least(a["stop"], x["end"])).alias("stop"),
        F.greatest(a["reach"], x["end"]).alias("reach"),
        (a["covered"] + F.greatest(x["end"] - F.greatest(x["start"], a["reach"]), F.lit(0))).alias("covered")))


def _idf(n: int, df: int) -> float:
    return math.log((1 + n) / (1 + df)) + 1


def parents(path: Column) -> Column:
    """All directories above a path, nearest first; the root is ''."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.size(parts) - 1, F.lit(0), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text", id_col: str = "doc_id",
         templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Per file: id, path, license, score, how (header, file, inherited, none), from_dir, n_statements."""
    base = files.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(path_col), F.lit("")).alias("path"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # identical rows share one key and come back as often as they were
    key = F.struct("path", "doc_id", F.xxhash64("text").alias("h"))
    keyed = base.select(key.alias("key"), "text", F.col("path").rlike(FILE_NAME).alias("named"))
    whole = F.col("kind") != WINDOW
    span = F.when(~whole, F.struct(F.col("no").alias("start"), (F.col("no") + F.col("n_words")).alias("end")))
    hits = (statements(keyed, templates, threshold)
            .groupBy("key").agg(F.max_by(F.struct("license", "score"), F.struct(
                "score", F.col("kind") * -1, F.col("no") * -1, F.col("only") * -1)).alias("b"),
                                F.count_if(whole).alias("n"), F.coalesce(F.sum(F.when(whole, F.col("n_words"))), F.lit(0)).alias("words"),
                                F.collect_list(span).alias("spans"), F.max("file_words").alias("file_words"))
            .withColumn("side", _spread(F.col("spans")))
            .select("key", "b.license", "b.score", (F.col("n") + F.col("side.n")).alias("n_statements"),
                    (F.col("words") + F.col("side.covered")).alias("in_statements"), "file_words"))
    own = (keyed.select("key").join(hits, "key", "left")
           .select(F.col("key.doc_id").alias("doc_id"), F.col("key.path").alias("path"), "license", "score",
                   F.col("key.path").rlike(FILE_NAME).alias("is_named"),
                   F.coalesce("n_statements", F.lit(0).cast("long")).alias("n_statements"),
                   ((F.col("license").isNotNull()) & (F.col("key.path").rlike(FILE_NAME)
                    | (F.col("in_statements") >= FILE_SHARE * F.col("file_words")))).alias("is_file"),
                   F.element_at(parents(F.col("key.path")), 1).alias("dir")))
    own = checkpointed(own.withColumn("is_file", F.coalesce("is_file", F.lit(False))))

    # one licence per directory that has a licence file (one by name first), then the nearest one above each directory of files
    granted = (own.where("is_file").groupBy(F.col("dir").alias("above"))
               .agg(F.max_by(F.struct("license", "score"), F.struct("is_named", "score", "path")).alias("b"))
               .select("above", F.col("b.license").alias("dir_license"), F.col("b.score").alias("dir_score")))
    dirs = own.select("dir").distinct().select("dir", F.posexplode(
        F.concat(F.array("dir"), F.when(F.col("dir") == "", F.array().cast("array<string>")).otherwise(parents(F.col("dir")))))
        .alias("far", "above"))
    nearest = (dirs.join(granted, "above").groupBy("dir")
               .agg(F.min_by(F.struct("above", "dir_license", "dir_score"), "far").alias("b"))
               .select("dir", F.col("b.above").alias("from_dir"), "b.dir_license", "b.dir_score",
                       F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salted = own.withColumn("salt", F.pmod(F.xxhash64("doc_id", "path"), F.lit(SALTS)).cast("int"))
    none = F.col("license").isNull()
    return (salted.join(nearest, ["dir", "salt"], "left")
            .select("doc_id", "path", F.coalesce("license", "dir_license").alias("license"),
                    F.coalesce("score", "dir_score").alias("score"),
                    F.when(~none & F.col("is_file"), "file").when(~none, "header")
                    .when(F.col("dir_license").isNotNull(), "inherited").otherwise("none").alias("how"),
                    F.when(none, F.col("from_dir")).alias("from_dir"), "n_statements"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: the source is the top directory, the language the one below it."""
    docs = documents(spark, sf_dir)
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")), F.col("doc_id").cast("string"))
    return scan(docs.withColumn("path", path))

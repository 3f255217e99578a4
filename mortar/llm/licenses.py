"""License scans (native): diagonal voting.

Every template is cut into rolling word pairs; all rolling word pairs of the
documents are joined to the template positions by hash (and checked word by
word).  A match at document position d and template position t votes for the
diagonal d - t.  A base phrase stands where one diagonal holds every pair of
the phrase.  For the longer notices, neighbouring diagonals (within
``DRIFT`` words) are merged, and a span is kept when the merged diagonals
cover at least ``COVER`` of the template's pairs within a bounded length.
Where stray votes chain on to a longer band, the diagonals within ``DRIFT`` of
each of its diagonals are tried, and the best of those that meet are kept.

Defined cases: null is the empty text; repeated rows each get the same
result; a text without words has no place, null first and last word, empty
labels and score 0.  The template table is a constant of this module, so
broadcasting it is bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .text import word_array

# --- fixed values: phrases and labels of the contract ----------------------
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Opening words of public licence notices, labelled by this operator.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction": "mit-notice",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
    "with the license": "apache-notice",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
    "public license as published by the free software foundation": "gpl-notice",
    "redistribution and use in source and binary forms with or without modification are permitted provided that "
    "the following conditions are met": "bsd-notice",
    "this work is licensed under a creative commons attribution": "cc-notice",
    "this source code form is subject to the terms of the mozilla public license": "mpl-notice",
}
# Pairs made of these words alone stand everywhere and carry no vote.
PLAIN_WORDS = frozenset("a an and any as by file for form in is it of or that the this to under use with you".split())
# --- end of fixed values ------------------------------------------------------

DRIFT = 3
COVER = 0.6
STRETCH = 1.5


def template_pairs(spark: SparkSession) -> DataFrame:
    """(a, b, template, label, base, tpos, n_pairs, n_words): rolling pairs of every template."""
    rows = []
    for number, (phrase, label) in enumerate([*BASE.items(), *NOTICES.items()]):
        words = phrase.split()
        base = phrase in BASE
        pairs = [(i, a, b) for i, (a, b) in enumerate(zip(words, words[1:]))
                 if base or a not in PLAIN_WORDS or b not in PLAIN_WORDS]
        rows += [(a, b, number, label, base, i, len(pairs), len(words)) for i, a, b in pairs]
    schema = "a string, b string, template int, label string, base boolean, tpos int, n_pairs int, n_words int"
    return spark.createDataFrame(rows, schema)


def votes(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, template..., pos, diag): one row per matched pair."""
    words = docs.select("doc_id", F.xxhash64("text").alias("mark"), word_array(F.col("text")).alias("w"))
    pairs = (
        words.select("doc_id", "mark", "w", F.posexplode("w").alias("pos", "first"))
        .withColumn("second", F.get("w", F.col("pos") + 1))
        .where(F.col("second").isNotNull())
        .select("doc_id", "mark", "pos", "first", "second", F.xxhash64("first", "second").alias("h"))
    )
    table = template_pairs(docs.sparkSession).withColumn("th", F.xxhash64("a", "b"))
    return (
        pairs.join(F.broadcast(table), (F.col("h") == F.col("th")) & (F.col("first") == F.col("a"))
                   & (F.col("second") == F.col("b")))
        .select("doc_id", "mark", "template", "label", "base", "tpos", "n_pairs", "n_words", "pos",
                (F.col("pos") - F.col("tpos")).alias("diag"))
    )


def license_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, label, base, first_word, last_word, cover): verified places."""
    by_diagonal = votes(docs).groupBy("doc_id", "mark", "template", "label", "base", "n_pairs", "n_words", "diag").agg(
        F.collect_set("tpos").alias("tpos"), F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    whole = by_diagonal.where(F.col("base") & (F.size("tpos") == F.col("n_pairs"))).select(
        "doc_id", "mark", "label", "base", F.col("diag").alias("first_word"),
        (F.col("diag") + F.col("n_words") - 1).alias("last_word"), F.lit(1.0).alias("cover"))
    # neighbouring diagonals of one document and template
    w = Window.partitionBy("doc_id", "mark", "template").orderBy("diag")
    jump = F.when(F.col("diag") - F.lag("diag").over(w) <= DRIFT, 0).otherwise(1)
    by_band = Window.partitionBy("doc_id", "mark", "template", "band")
    length, bound = F.col("last_word") - F.col("first_word") + 1, STRETCH * F.col("n_words")
    banded = (
        by_diagonal.where(~F.col("base"))
        .withColumn("jump", jump)
        .withColumn("band", F.sum("jump").over(w))
        .withColumn("long", F.max("hi").over(by_band) + 2 - F.min("lo").over(by_band) > bound)
    )
    merged = (
        banded.where(~F.col("long"))
        .groupBy("doc_id", "mark", "label", "base", "template", "n_pairs", "n_words", "band")
        .agg(F.size(F.array_distinct(F.flatten(F.collect_list("tpos")))).alias("covered"),
             F.min("lo").alias("first_word"), (F.max("hi") + 1).alias("last_word"))
        .withColumn("cover", F.col("covered") / F.col("n_pairs"))
        .where(F.col("cover") >= COVER)
    )
    parts = banded.where("long")
    for reach in range(DRIFT + 1):
        near = by_band.orderBy("diag").rangeBetween(-reach, reach)
        one = parts.select(
            "*", (F.size(F.array_distinct(F.flatten(F.collect_list("tpos").over(near)))) / F.col("n_pairs")).alias("cover"),
            F.min("lo").over(near).alias("first_word"), (F.max("hi").over(near) + 1).alias("last_word"))
        fits = F.struct("cover", (-length).alias("short"), "first_word", "last_word")
        parts = one.withColumn(f"try{reach}", F.when((F.col("cover") >= COVER) & (length <= bound), fits)).drop(
            "cover", "first_word", "last_word")
    place = F.struct("best.cover", "best.short", (-F.col("diag")).alias("first"))
    within = (
        parts.withColumn("best", F.greatest(*[f"try{r}" for r in range(DRIFT + 1)])).where(F.col("best").isNotNull())
        .withColumn("top", F.max(place).over(by_band.orderBy("diag").rangeBetween(-2 * DRIFT, 2 * DRIFT)))
        .where(F.col("top") == place)
        .select("doc_id", "mark", "label", "base", F.col("best.first_word").alias("first_word"),
                F.col("best.last_word").alias("last_word"), F.col("best.cover").alias("cover"))
    )
    return whole.unionByName(merged.select(*within.columns)).unionByName(within)


def license_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, one row per document."""
    def joined(labels):
        return F.array_join(F.sort_array(F.array_distinct(F.coalesce(labels, F.array().cast("array<string>")))), ",")

    base = F.col("base")
    found = license_spans(docs).groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).cast("long").alias("last_word"),
        F.collect_set(F.when(base, F.col("label"))).alias("_base"),
        F.collect_set("label").alias("_all"),
        F.max("cover").alias("cover"),
    )
    rows = docs.select("doc_id", F.xxhash64("text").alias("mark"),
                       F.size(word_array(F.col("text"))).cast("long").alias("n_words"))
    out = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        joined(F.col("_base")).alias("base_labels"), joined(F.col("_all")).alias("labels"),
        F.coalesce("cover", F.lit(0.0)).cast("double").alias("score"),
    )

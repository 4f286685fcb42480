"""License texts in documents by diagonal voting, in DataFrame functions only.

Words are runs of digits, lower-case letters (A-Z folded) and non-ASCII characters. Every template is
cut into word k-grams: two words for the short base phrases, three for license sentences.

1. Every document position gives the hashes of its rolling 2- and 3-gram, in one generator; a join with
   the templates' k-gram hashes (a fixed table) yields votes (template, diagonal), where the diagonal is
   the position in the document minus the one in the template. The words of a vote are compared, so a
   hash collision is no vote.
2. Votes are counted per document, template and diagonal, with partial sums before the shuffle.
3. A base phrase stands where a diagonal has a vote from each of its 2-grams. For a license sentence,
   diagonals that differ by at most three words (words left out or put in) are merged; the merged span
   is accepted if its votes cover enough of the template and it isn't much longer than the template.

Cases: a null text is an empty one, without words (n_words 0, no label, score 0); null ids, ties and
repeated rows are kept, one result row per input row; an empty table gives an empty result; other
columns are ignored. ``lower`` folds non-ASCII capitals too, which can't make or break a word.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lineweave.llm.tables import cut, read_table

#: Base phrases and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Well-known public license sentences and their labels.
LICENSE_TEXTS = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "Released under the MIT License"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl-notice", "This work is licensed under the GNU General Public License"),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by-notice", "This work is licensed under a Creative Commons Attribution"),
    ("cc-by-nc", "Licensed under CC BY-NC"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("warranty", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED"),
]

_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words by which neighbouring diagonals may differ, share of a template's k-grams that must vote, and
#: how many template lengths a merged span may have.
NEAR, LEAST_COVER, LONGEST = 3, 0.6, 2


def template_grams(spark: SparkSession) -> DataFrame:
    """The templates' k-grams: k, gram (hash), template, label, base, n_grams, place, g0, g1, g2."""
    rows = []
    texts = [(2, label, phrase) for phrase, label in BASE_PHRASES.items()] + [(3, *t) for t in LICENSE_TEXTS]
    for number, (k, label, text) in enumerate(texts):
        words = re.findall("[0-9a-z]+", text.lower())
        grams = [words[i : i + k] for i in range(len(words) - k + 1)]
        for place, g in enumerate(grams):
            rows.append((k, number, label, k == 2, len(grams), place, g[0], g[1], g[2] if k == 3 else None))
    table = spark.createDataFrame(rows, "k int, template int, label string, base boolean, n_grams int, place int, g0 string, g1 string, g2 string")
    return table.withColumn("gram", F.when(F.col("k") == 2, F.xxhash64("g0", "g1")).otherwise(F.xxhash64("g0", "g1", "g2")))


def _rolling(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, n_words, place, w0, w1, w2) for every word place, one row at least per document."""
    words = F.split(F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), _GAP)
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id"), words.alias("words"))
    # A text that begins or ends between words has an empty first or last part.
    blank = lambda part: F.when(part == "", 1).otherwise(0)
    lead = blank(F.element_at("words", 1))
    tail = F.when(F.size("words") > 1, blank(F.element_at("words", -1))).otherwise(0)
    rows = rows.select("rid", "doc_id", "words", lead.alias("lead"), (F.size("words") - lead - tail).cast("long").alias("n_words"))
    zipped = F.arrays_zip(F.col("words").alias("w0"), F.expr("slice(words, 2, size(words))").alias("w1"), F.expr("slice(words, 3, size(words))").alias("w2"))
    return rows.select("rid", "doc_id", "n_words", "lead", F.posexplode(zipped).alias("at", "w")).select(
        "rid", "doc_id", "n_words", "at", (F.col("at") - F.col("lead")).alias("place"), "w.w0", "w.w1", "w.w2"
    )


def license_spans(docs: DataFrame) -> DataFrame:
    """Votes per row, template and diagonal: rid, doc_id, n_words, label, base, n_grams, template,
    diagonal, votes, first_place, last_place. Every input row has one row without a template."""
    spark = docs.sparkSession
    templates = template_grams(spark)
    grams = _rolling(docs).select("*", F.xxhash64("w0", "w1").alias("h2"), F.xxhash64("w0", "w1", "w2").alias("h3"))
    # A first sieve with the fixed hashes keeps the row that stands for the document and the hits.
    known = [[r["gram"] for r in templates.where(f"k = {k}").select("gram").distinct().collect()] for k in (2, 3)]
    grams = grams.where((F.col("at") == 0) | F.col("h2").isin(known[0]) | F.col("h3").isin(known[1]))
    kinds = [F.struct(F.lit(k).alias("k"), gram.alias("gram")) for k, gram in ((0, F.lit(None).cast("long")), (2, F.col("h2")), (3, F.col("h3")))]
    keyed = grams.withColumn("key", F.explode(F.array(*kinds)))
    keyed = keyed.select("rid", "doc_id", "n_words", "at", F.col("place").alias("word"), "w0", "w1", "w2", "key.k", "key.gram").where("k > 0 or at = 0")
    # The templates are a fixed table of a few hundred rows.
    met = keyed.join(F.broadcast(templates), ["k", "gram"], "left").where("k = 0 or (w0 = g0 and w1 = g1 and (k = 2 or w2 = g2))")
    return met.groupBy("rid", "doc_id", "n_words", "template", "label", "base", "n_grams", F.expr("word - place").alias("diagonal")).agg(
        F.count("template").alias("votes"), F.min("word").alias("first_place"), F.max("word").alias("last_place")
    )


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score (the best cover of a template; 1 with a base phrase)."""
    # Cut: both branches below read the same votes, and row ids, from one pass over the texts.
    votes = cut(license_spans(docs), "license-votes")
    line = Window.partitionBy("rid", "template").orderBy("diagonal")
    apart = F.when(F.col("diagonal") - F.lag("diagonal").over(line) <= NEAR, 0).otherwise(1)
    runs = votes.where("not base or base is null").withColumn("new", apart).withColumn("run", F.sum("new").over(line))
    runs = runs.groupBy("rid", "doc_id", "n_words", "template", "label", "n_grams", "run").agg(
        F.when(F.sum("votes") > 0, F.least(F.lit(1.0), F.sum("votes") / F.first("n_grams"))).otherwise(0.0).alias("cover"), (F.max("last_place") - F.min("first_place") + 1).alias("width")
    )
    accepted = (F.col("cover") >= LEAST_COVER) & (F.col("width") <= LONGEST * (F.col("n_grams") + 2))
    runs = runs.select("rid", "doc_id", "n_words", F.lit(None).cast("string").alias("base_label"), F.when(accepted, F.col("label")).alias("label"), "cover", F.lit(None).cast("long").alias("start"))
    base = votes.where("base and votes = n_grams").select("rid", "doc_id", "n_words", F.col("label").alias("base_label"), "label", F.lit(1.0).alias("cover"), F.col("diagonal").cast("long").alias("start"))
    names = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return (
        runs.union(base)
        .groupBy("rid")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.count("start").alias("n_base"),
            F.min("start").alias("first_word"),
            F.max("start").alias("last_word"),
            names("base_label").alias("base_labels"),
            names("label").alias("labels"),
            F.max("cover").alias("score"),
        )
        .drop("rid")
    )


def op4_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))

"""License scans by diagonal voting, in DataFrame operations only.

Every rolling word bigram of every text is hashed and joined with the positions
of the same bigram in a fixed set of templates.  A match at word ``p`` of the
text and ``t`` of the template, whose words agree as well, votes for the diagonal
``p - t``, where the template would begin.  Votes are gathered by diagonal as a
set of template positions.  Diagonals up to ``DRIFT`` words on (words added or
left out) are merged, and a span is verified by the share of *different* template
positions that voted within it, so one bigram said again and again is one vote.
Of overlapping spans the best stands, the first on ties.  A short phrase must have
all its bigrams on one diagonal, which is the phrase word by word.

The text is read once.  A sentinel bigram per row, which joins one dummy
template position, carries the row's word count through the same plan, so rows
without a match need no second scan or join.  Each row has an identity of its
own: equal or null ``doc_id`` values are never merged.

Edge cases: null text is empty; texts under two words have no match; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Fixed by the contract: phrase and label.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Passages of public licences that name themselves no other way; label and words.
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
#: Templates of at most so many words must match in full, longer ones to this share, within diagonals that differ by at most so much.
SHORT_WORDS, LEAST_SHARE, DRIFT = 8, 0.6, 6


def template_bigrams(spark: SparkSession) -> DataFrame:
    """Template positions by bigram; the size is fixed by the tables above."""
    rows = []
    for n, (words, label, base) in enumerate([(p, label, True) for p, label in BASE] + [(w, label, False) for label, w in TEMPLATES]):
        w = words.split(" ")
        if len(w) > 64:
            raise ValueError(f"a template of {len(w)} words: its positions do not fit in the bits of a long")
        rows += [(n, label, base, len(w), t, w[t], w[t + 1]) for t in range(len(w) - 1)]
    frame = spark.createDataFrame(rows, "template int, label string, base boolean, size int, t int, w1 string, w2 string")
    sentinel = spark.createDataFrame([(-1, "", False, 0, 0, "", "")], frame.schema)
    return frame.union(sentinel).select("template", "label", "base", "size", "t", F.col("w1").alias("t1"), F.col("w2").alias("t2"), F.xxhash64("w1", "w2").alias("gram"))


def spans(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Verified spans, and one row with a null template and the word count for each row of ``docs``.

    Columns: _row, ``key``, n_words, template, label, base, start, share.
    """
    folded = F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.array_remove(F.split(folded, SEPARATORS), "")
    rows = docs.select(key, F.monotonically_increasing_id().alias("_row"), words.alias("_words"))
    following = F.expr("slice(_words, 2, greatest(size(_words) - 1, 0))")
    # The sentinel comes last, at position size(_words): the bigram of two empty words, which no text has.
    pairs = F.expr("concat(slice(arrays_zip(_words, _next), 1, greatest(size(_words) - 1, 0)), array(named_struct('_words', '', '_next', '')))")
    grams = (
        rows.withColumn("_next", following)
        .select(key, "_row", F.size("_words").alias("_n"), pairs.alias("_pairs"))
        .select(key, "_row", "_n", F.posexplode("_pairs").alias("_p", "_pair"))
        .select(key, "_row", "_n", "_p", F.col("_pair._words").alias("_w1"), F.col("_pair._next").alias("_w2"))
        .withColumn("gram", F.xxhash64("_w1", "_w2"))
    )
    votes = grams.join(F.broadcast(template_bigrams(docs.sparkSession)), "gram").where((F.col("_w1") == F.col("t1")) & (F.col("_w2") == F.col("t2")))
    diagonal = F.when(F.col("template") < 0, F.col("_n")).otherwise(F.col("_p") - F.col("t"))
    # template positions as bits: templates have fewer than 64 words
    by_diagonal = votes.groupBy("_row", key, "template", "label", "base", "size", diagonal.alias("start")).agg(F.bit_or(F.expr("shiftleft(1L, t)")).alias("_bits"))
    own = Window.partitionBy("_row", "template").orderBy("start")
    reach = F.when(F.col("size") <= SHORT_WORDS, F.bit_count("_bits")).otherwise(F.bit_count(F.bit_or("_bits").over(own.rangeBetween(0, DRIFT))))
    share = F.col("_found") / F.greatest(F.col("size") - 1, F.lit(1)).cast("double")
    apart = F.col("size") <= SHORT_WORDS
    enough = (F.col("template") < 0) | (apart & (F.col("_found") == F.col("size") - 1)) | (~apart & (share >= LEAST_SHARE))
    # the span begins where its fullest diagonal does
    fullest = F.max(F.struct(F.bit_count("_bits").alias("n"), (-F.col("start")).alias("at"))).over(own.rangeBetween(0, DRIFT))
    stands = by_diagonal.withColumns({"_found": reach, "_fullest": fullest}).where(enough).withColumn("share", share)
    # of spans that overlap the best one stands, the first on ties
    better = F.max("share").over(own.rangeBetween(-DRIFT, DRIFT))
    before = F.max("share").over(own.rangeBetween(-DRIFT, -1))
    merged = stands.withColumns({"_better": better, "_before": before})
    verified = (F.col("template") < 0) | apart | ((F.col("share") == F.col("_better")) & (F.col("_before").isNull() | (F.col("_before") < F.col("share"))))
    return merged.where(verified).select("_row", key, F.when(F.col("template") < 0, F.col("start")).cast("long").alias("n_words"), F.when(F.col("template") >= 0, F.col("template")).alias("template"), "label", "base", F.when(apart, F.col("start")).otherwise(-F.col("_fullest.at")).cast("long").alias("start"), F.when(F.col("template") >= 0, F.col("share")).alias("share"))


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: n_words, n_base, first_word, last_word, base_labels, labels, score."""
    base = F.col("base") & F.col("template").isNotNull()
    joined = lambda c: F.concat_ws(",", F.sort_array(F.collect_set(c)))
    return (
        spans(docs, text, key)
        .groupBy("_row", key)
        .agg(
            F.max("n_words").alias("n_words"),
            F.count(F.when(base, 1)).alias("n_base"),
            F.min(F.when(base, F.col("start"))).alias("first_word"),
            F.max(F.when(base, F.col("start"))).alias("last_word"),
            joined(F.when(base, F.col("label"))).alias("base_labels"),
            joined(F.when(F.col("template").isNotNull(), F.col("label"))).alias("labels"),
            F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
        )
        .drop("_row")
    )

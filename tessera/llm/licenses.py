"""License scan by diagonal voting.

All rolling word bigrams of a text are joined to the positions at which license
templates hold them.  Matches that lie on one diagonal (place in the text less
place in the template) vote for one alignment; neighbouring diagonals, left by
inserted or missing words, are merged where they are also neighbours in the text.  A span is
verified word by word: its words that no match covers and the template's that it lacks
are edits, and the words that tell a template from its relatives must be there.  Of
templates whose spans overlap the best count.  Phrases count only when whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import NON_WORD, ascii_lower, keyed, on_document, words

#: Phrases that count where their words stand consecutively.
PHRASES = [("cc-by", "cc by"), ("gpl", "general public license"),
           ("reserved", "all rights reserved")]
#: Templates of the method: a label, words of the usual notice, and those that a span
#: must hold.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0", "apache 2"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
            "software and associated documentation files", "permission granted software"),
    ("mit", "released under the mit license", "mit"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
            "permitted provided that the following conditions are met", "redistribution permitted"),
    ("gpl-notice", "this work is licensed under the gnu general public license", "gnu public"),
    ("cc-notice", "this work is licensed under a creative commons attribution license",
     "creative commons attribution"),
    ("cc-by", "licensed under cc by 4 0", "cc by"),
    ("cc-nc", "licensed under cc by nc 4 0", "cc nc"),
    ("cc-sa", "licensed under cc by sa 4 0", "cc sa"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license", "mozilla"),
    ("public-domain", "this work is dedicated to the public domain", "public domain"),
]
#: Templates are broadcast: all their bigrams together, at most.
MAX_GRAMS = 100_000


def _bigrams(phrases, templates) -> list[tuple]:
    rows = []
    texts = [(True, *p, "") for p in phrases] + [(False, *t) for t in templates]
    for tid, (is_phrase, label, text, must) in enumerate(texts):
        ws = re.findall(r"[0-9a-z\u0080-\U0010ffff]+", text)
        if len(ws) < 2 or not set(must.split()) <= set(ws):
            raise ValueError(f"a template needs two words, and those it must have: {text!r}")
        needed = [ws.index(m) for m in must.split()]
        rows += [(tid, label, is_phrase, len(ws) - 1, needed, i, a, b)
                 for i, (a, b) in enumerate(zip(ws, ws[1:], strict=False))]
    if len(rows) > MAX_GRAMS:
        raise ValueError(f"{len(rows)} bigrams of templates; at most {MAX_GRAMS} are broadcast")
    return rows


def license_spans(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                  phrases=PHRASES, templates=TEMPLATES, min_share: float = 0.6,
                  gap: int = 2) -> DataFrame:
    """Verified spans: ``_id``, ``_th`` (see ``keyed``), label, is_phrase, first
    (word, from 0), last (word, inclusive), share (of the template matched).

    A phrase's span holds its words exactly.  A template's span joins diagonals at most
    ``gap`` apart that follow each other within ``gap`` words of the text.  Its share is one less
    the edits (words of the span outside matches or template words outside them, whichever are
    more) over the template's words; it counts from ``min_share`` on, with all words
    that it must hold, unless a template of a larger share overlaps it (in a chain of overlapping
    spans the largest share stays; equal ones all do).
    """
    spark = df.sparkSession
    grams = spark.createDataFrame(
        _bigrams(phrases, templates),
        "tid int, label string, is_phrase boolean, n int, needed array<int>, tpos int, ta string, tb string"
    ).withColumn("g", F.xxhash64("ta", "tb"))
    docs = keyed(df, text_col, id_col)
    ws = docs.select("_id", "_th", words(ascii_lower(F.col("_text")), NON_WORD).alias("w"))
    pairs = ws.filter(F.size("w") >= 2).select("_id", "_th", F.posexplode(F.arrays_zip(
        F.slice("w", 1, F.size("w") - 1).alias("a"),
        F.slice("w", 2, F.size("w") - 1).alias("b"))).alias("pos", "p"))
    pairs = pairs.select("_id", "_th", "pos", F.col("p.a").alias("a"), F.col("p.b").alias("b"))
    hits = (pairs.withColumn("g", F.xxhash64("a", "b")).join(F.broadcast(grams), "g")
            .filter("a = ta AND b = tb"))  # verifies the words behind the hash
    key = ["_id", "_th", "tid", "label", "is_phrase", "n", "needed"]
    votes = (hits.groupBy(*key, (F.col("pos") - F.col("tpos")).alias("diag"))
             .agg(F.collect_set("tpos").alias("seen"), F.collect_set("pos").alias("places"),
                  F.min("pos").alias("first"), F.max("pos").alias("last")))
    # in the order of the text: diagonals that are near each other in both ways are one run
    by_place = Window.partitionBy("_id", "_th", "tid").orderBy("first", "diag")
    reach = F.max("last").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce((F.abs(F.col("diag") - F.lag("diag").over(by_place)) > gap)
                     | (F.col("first") - reach > gap + 1), F.lit(True)) | F.col("is_phrase")
    both = lambda c: F.array_distinct(F.concat(  # noqa: E731  a bigram covers two words
        F.flatten(F.collect_list(c)), F.transform(F.flatten(F.collect_list(c)), lambda x: x + 1)))
    merged = (votes.withColumn("new", new.cast("int"))
              .withColumn("run", F.sum("new").over(by_place))
              .groupBy(*key, "run")
              .agg(both("seen").alias("held"), both("places").alias("covered"),
                   F.min("first").alias("first"), (F.max("last") + 1).alias("last")))
    words_of = F.col("n") + 1
    edits = F.greatest(words_of - F.size("held"), F.col("last") - F.col("first") + 1 - F.size("covered"))
    verified = merged.withColumn("share", F.greatest(1 - edits / words_of, F.lit(0.0))).filter(
        F.when(F.col("is_phrase"), F.size("held") == words_of)
        .otherwise((F.col("share") >= min_share) & (F.size(F.array_except("needed", "held")) == 0)))
    # templates' spans that overlap, one after the other, compete
    order = Window.partitionBy("_id", "_th", "is_phrase").orderBy("first", F.desc("last"), "tid")
    ahead = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    chained = verified.withColumn("fresh", F.coalesce(F.col("first") > ahead, F.lit(True)).cast("int")) \
        .withColumn("chain", F.sum("fresh").over(order)) \
        .withColumn("most", F.max("share").over(Window.partitionBy("_id", "_th", "is_phrase", "chain")))
    return (chained.filter("is_phrase OR share = most")
            .select("_id", "_th", "label", "is_phrase", F.col("first").cast("long"),
                    F.col("last").cast("long"), "share"))


def _labels(c: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_set(c)), ",")


def scan_licenses(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                  **options) -> DataFrame:
    """(``id_col``, n_words, n_base, first_word, last_word, base_labels, labels,
    score), one row per row of ``df``.

    ``n_base`` counts all places of phrases, ``first_word`` and ``last_word`` are
    the smallest and largest of their starts; ``score`` is the largest share of
    a template or phrase that a verified span matched, 0 without one.  A null or
    empty text has no words and no labels.  Repeated rows (same id, same text)
    get the same result each; an empty table gives an empty result.
    """
    spans = license_spans(df, text_col, id_col, **options)
    base = F.col("is_phrase")
    found = spans.groupBy("_id", "_th").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"),
        _labels(F.when(base, F.col("label"))).alias("base_labels"),
        _labels(F.col("label")).alias("labels"),
        F.max("share").alias("score"))
    docs = keyed(df, text_col, id_col).select(
        "_id", "_th", F.size(words(ascii_lower(F.col("_text")), NON_WORD)).cast("long")
        .alias("n_words"))
    return on_document(docs, found, "left").select(
        F.col("_id").alias(id_col), "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))

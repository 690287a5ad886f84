"""Licence scans by diagonal voting: word k-grams joined to template places, counted by offset diagonal.

A k-gram of a text that equals the template's at place p, found at word w, votes for the diagonal w - p. Votes of
diagonals at most ``gap`` words apart belong to one span; a span holds the template if enough of its k-grams, compared
word by word, are there. Only DataFrame functions; the template table is a parameter and its size is checked.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from premia.session import broadcast_checked, materialize

K = 3
GAP = 3
COVERAGE = 0.8
HASHES = 5000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Phrases that must stand whole.
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
#: Usual notices, which may be a little altered.
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
]


def words_of(text: Column) -> Column:
    """Words of a whole text, A-Z lower-cased; null has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def templates(spark, phrases: list[tuple[str, str]] = PHRASES, notices: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """(template, label, base, grams, place, gram) with a row per k-gram of every template."""
    rows = []
    for number, (label, text, base) in enumerate([(*p, True) for p in phrases] + [(*n, False) for n in notices]):
        words = re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))
        if len(words) < K:
            raise ValueError(f"a template has fewer than {K} words: {text}")
        rows += [(number, label, base, len(words) - K + 1, i, words[i : i + K]) for i in range(len(words) - K + 1)]
    return spark.createDataFrame(rows, "template int, label string, base boolean, grams int, place int, gram array<string>")


def _hashed(words: str, i: Column) -> Column:
    return F.xxhash64(*[F.get(words, i + j) for j in range(K)])


def _keyed(table: DataFrame) -> DataFrame:
    return table.withColumn("hash", F.xxhash64(*[F.get("gram", F.lit(j)) for j in range(K)]))


def grams_met(docs: DataFrame, keep: list[str], text: str, table: DataFrame) -> DataFrame:
    """Per row of ``docs`` the columns ``keep``, n_words, and ``met``: (at, said) of the k-grams whose hash a template has.

    The texts are cut into words once. Of more than HASHES template k-grams the hashes are not sent along, and all k-grams are met.
    """
    hashes = [r["hash"] for r in _keyed(table).select("hash").distinct().limit(HASHES + 1).collect()]
    w = docs.select(*keep, words_of(F.col(text)).alias("_w"))
    n = F.size("_w")
    places = F.sequence(F.lit(0), n - K)
    if len(hashes) <= HASHES:
        places = F.filter(places, lambda i: _hashed("_w", i).isin(hashes))
    met = F.when(n >= K, F.transform(places, lambda i: F.struct(i.alias("at"), F.slice("_w", i + 1, K).alias("said"))))
    return materialize(w.select(*keep, n.cast("long").alias("n_words"), met.alias("met")))


def spans(grams: DataFrame, row: str, table: DataFrame) -> DataFrame:
    """(row, template, label, base, first_word, share): spans that hold whole phrases or at least COVERAGE of a notice.

    ``grams`` is of `grams_met`; ``row`` names a column that tells its rows apart; rows equal in it must have equal texts.
    """
    hits = grams.select(row, F.inline("met")).join(broadcast_checked(table), F.col("said") == F.col("gram"))
    votes = hits.select(row, "template", "label", "base", "grams", "place", (F.col("at") - F.col("place")).alias("diagonal")).distinct()
    lines = materialize(votes.groupBy(row, "template", "label", "base", "grams", "diagonal").agg(
        F.count("*").alias("votes"), F.collect_set("place").alias("places")  # a template's places at most
    ))  # read by phrases and notices
    whole = lines.where("base and votes = grams").select(row, "template", "label", "base", F.col("diagonal").alias("first_word"), F.lit(1.0).alias("share"))
    order = W.partitionBy(row, "template").orderBy("diagonal")
    steps = lines.where("not base").withColumn("new", (F.col("diagonal") - F.lag("diagonal").over(order) > GAP).cast("int"))
    runs = steps.withColumn("run", F.sum(F.coalesce("new", F.lit(0))).over(order.rowsBetween(W.unboundedPreceding, 0)))
    merged = runs.groupBy(row, "template", "label", "base", "grams", "run").agg(
        F.min("diagonal").alias("first_word"), F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("held")
    )
    near = merged.withColumn("share", F.col("held") / F.col("grams")).where(F.col("share") >= COVERAGE)
    return whole.unionByName(near.select(row, "template", "label", "base", "first_word", "share"))


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", table: DataFrame | None = None) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts the places of whole phrases, first_word and last_word are their smallest and largest start (null
    without one); labels adds those of the notices found; score is the largest share of a template that was found, else
    0. Null text counts as empty; without labels the strings are empty. Repeated rows and null ids give a row each; other columns
    are ignored; an empty table gives an empty result.
    """
    table = templates(docs.sparkSession) if table is None else table
    slim = docs.select(docs[id_col].alias("_id"), docs[text].alias("_text"), F.xxhash64(docs[id_col], docs[text]).alias("_row"))
    names = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    base = F.when(F.col("base"), F.col("first_word"))
    grams = grams_met(slim, ["_id", "_row"], "_text", table)
    found = spans(grams, "_row", table).groupBy("_row").agg(
        F.count(base).alias("n_base"), F.min(base).cast("long").alias("first_word"), F.max(base).cast("long").alias("last_word"),
        names(F.when(F.col("base"), F.col("label"))).alias("base_labels"), names(F.col("label")).alias("labels"),
        F.max("share").alias("score"),
    )
    blank = F.lit("")
    return grams.drop("met").join(found, "_row", "left").select(
        F.col("_id").alias(id_col), "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", blank).alias("base_labels"), F.coalesce("labels", blank).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )

"""License statements by diagonal voting.

Words are lower-cased (A-Z) runs of characters other than ASCII ones that are neither a-z nor 0-9. Every rolling
run of three words of a text is joined to the places of that run in the templates. A match votes for its diagonal, the
word of the text at which the template would start. Votes are added by document, template and diagonal; diagonals
at most ``GAP`` apart are one span, so a word put in or left out does not break a statement; a span counts if its
votes cover enough of the template. The runs are compared as strings after their hashes, so a vote is certain.

The base phrases are templates as well; all of their runs on one diagonal are a place of the phrase.

Defined results: null, empty and blank texts have no words, no labels and score 0; rows with one id and text
are judged alike, each with a row of its own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
K = 3
GAP = 4
COVERED = 0.7
# Phrases that decide the base labels.
BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
# Openings of well-known license texts and notices.
STATEMENTS = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache-2"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("this work is licensed under a creative commons attribution noncommercial", "cc-by-nc"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
]


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    return F.regexp_extract_all(_lower(text), F.lit(WORD), F.lit(0))


def templates(spark: SparkSession, statements: list[tuple[str, str]]) -> DataFrame:
    """A row for each run of three words: template, its label, place, number of runs, and whether it is a base phrase."""
    rows = []
    for number, (text, label) in enumerate(BASE + statements):
        parts = text.split()
        for i in range(len(parts) - K + 1):
            rows.append((number, label, number < len(BASE), i, len(parts) - K + 1, " ".join(parts[i : i + K])))
    frame = spark.createDataFrame(rows, "_template int, _label string, _base boolean, _at int, _runs int, _own string")
    return frame.withColumn("_hash", F.xxhash64("_own"))


def spans(grams: DataFrame, key: list[str], wanted: DataFrame, gap: int = GAP, covered: float = COVERED) -> DataFrame:
    """Verified spans from rows of ``key``, ``_pos``, ``_gram``: label, base, start, end (words), cover."""
    grams = grams.withColumn("_hash", F.xxhash64("_gram"))
    votes = grams.join(F.broadcast(wanted), "_hash").where("_gram = _own")  # templates: a fixed list
    diagonals = votes.groupBy(*key, "_template", "_label", "_base", "_runs", (F.col("_pos") - F.col("_at")).alias("_diag")).agg(
        F.collect_set("_at").alias("_ats"), F.min("_pos").alias("_first"), F.max("_pos").alias("_last")
    )
    order = Window.partitionBy(*key, "_template").orderBy("_diag")
    new = F.coalesce((F.col("_diag") - F.lag("_diag").over(order) > F.when(F.col("_base"), 0).otherwise(gap)).cast("int"), F.lit(1))
    grouped = diagonals.withColumn("_new", new).withColumn("_span", F.sum("_new").over(order))
    merged = grouped.groupBy(*key, "_template", "_label", "_base", "_runs", "_span").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("_ats")))).alias("_votes"),
        F.min("_first").alias("_start"), (F.max("_last") + K - 1).alias("_end"),
    )
    cover = F.col("_votes") / F.col("_runs")
    return merged.withColumn("_cover", cover).where(F.when(F.col("_base"), F.col("_cover") == 1).otherwise(F.col("_cover") >= covered))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", statements: list[tuple[str, str]] | None = None) -> DataFrame:
    """``doc_id``, ``n_words``, base places and labels, all labels, and ``score``, the best cover of a template."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("_t"), text.alias("_text"))
    listed = rows.select("doc_id", "_t", words(F.col("_text")).alias("_words"))
    runs = F.transform(
        F.slice("_words", 1, F.greatest(F.size("_words") - (K - 1), F.lit(0))),
        lambda w, i: F.concat_ws(" ", w, F.get("_words", i + 1), F.get("_words", i + 2)),
    )
    grams = listed.select("doc_id", "_t", F.posexplode(runs).alias("_pos", "_gram"))
    wanted = templates(spark, STATEMENTS if statements is None else statements)
    found = spans(grams, ["doc_id", "_t"], wanted)
    base = F.col("_base")
    # Rows with one id and text add their votes to one span, so a place is counted once for all of them.
    summed = found.groupBy(F.col("doc_id").alias("_d"), F.col("_t").alias("_u")).agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("_start"))).alias("first_word"),
        F.max(F.when(base, F.col("_start"))).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("_label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("_label")), ",").alias("labels"), F.max("_cover").alias("score"),
    )
    counted = rows.select("doc_id", "_t", F.regexp_count(_lower(F.col("_text")), F.lit(WORD)).cast("bigint").alias("n_words"))
    both = counted.join(summed, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_t") == F.col("_u")), "left")
    return both.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        F.col("first_word").cast("bigint").alias("first_word"), F.col("last_word").cast("bigint").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )

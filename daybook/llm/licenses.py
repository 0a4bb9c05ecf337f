"""License notices by diagonal voting.

All rolling word k-grams of the documents are joined by hash to the k-grams of the templates (a table in code, so its
broadcast has a fixed size); equal words are checked at the join. A match of document word p and template word t votes
for the diagonal p - t. Votes are counted per document, template and diagonal; each diagonal is merged with its
neighbours, which hold what stands before or after an inserted or missing word, and the merged span is a notice if it
covers enough of the template. A phrase stands where a diagonal holds all of its k-grams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from daybook.llm.common import grams, repeated, whole, words

K = 3
#: Phrases that must stand word for word, and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
#: Sentences by which public licenses are given, and their labels.
NOTICES = (
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the Software), to deal in the Software without restriction, including without limitation "
     "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", "mit"),
    ("Licensed under the Apache License, Version 2.0", "apache-2"),
    ("you may not use this file except in compliance with the License. You may obtain a copy of the License at "
     "http www apache org licenses LICENSE 2.0", "apache-2"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl-3"),
    ("it under the terms of the GNU General Public License as published by the Free Software Foundation, either "
     "version 3 of the License", "gpl-3"),
    ("it under the terms of the GNU General Public License as published by the Free Software Foundation; either "
     "version 2 of the License", "gpl-2"),
    ("under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "lgpl"),
    ("under the terms of the GNU Affero General Public License as published by the Free Software Foundation", "agpl-3"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met", "bsd"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies", "isc"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mpl-2"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc"),
    ("This is free and unencumbered software released into the public domain", "unlicense"),
)


def template_grams(spark: SparkSession, phrases=PHRASES, notices=NOTICES, k: int = K) -> DataFrame:
    """(template, label, base, place, gram, n_grams): the templates' k-grams and their places."""
    rows = [(i, text, label, i < len(phrases)) for i, (text, label) in enumerate([*phrases, *notices])]
    split = spark.createDataFrame(rows, "template int, text string, label string, base boolean").select(
        "template", "label", "base", words(F.col("text")).alias("_words"))
    return split.select("template", "label", "base", F.greatest(F.size("_words") - k + 1, F.lit(0)).alias("n_grams"),
                        F.posexplode(grams("_words", k)).alias("place", "gram"))


def diagonals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, notices=NOTICES,
              k: int = K) -> DataFrame:
    """(_id, _row, n_words, template, label, base, n_grams, diagonal, places, first): a row per diagonal with votes.

    Each document has a row at least, one without a template if none of its words is in one. Rows that repeat both the
    id and the text are counted together: the largest ``rows`` of a document tells how many there are.
    """
    known = template_grams(docs.sparkSession, phrases, notices, k).withColumn("_hash", F.xxhash64("gram"))
    rows = (
        docs.select(F.col(id_col).alias("_id"), whole(text_col).alias("_text"))
        .select("_id", F.xxhash64("_text").alias("_row"), words(F.col("_text")).alias("_words"))
        .select("_id", "_row", F.size("_words").cast("long").alias("n_words"),
                F.posexplode_outer(grams("_words", k)).alias("pos", "_gram"))
        .withColumn("_hash", F.xxhash64("_gram"))
    )
    met = rows.join(F.broadcast(known), (rows["_hash"] == known["_hash"]) & (rows["_gram"] == known["gram"]), "left")
    seen = met.filter(F.col("template").isNotNull() | F.col("pos").isNull() | (F.col("pos") == 0))
    return seen.groupBy("_id", "_row", "n_words", "template", "label", "base", "n_grams",
                        (F.col("pos") - F.col("place")).alias("diagonal")).agg(
        F.collect_set("place").alias("places"), F.min("pos").alias("first"), F.max("pos").alias("last"),
        F.count_if(F.coalesce("pos", F.lit(0)) == 0).alias("rows"))


def spans(found: DataFrame, slack: int = 3) -> DataFrame:
    """``found`` (as ``diagonals`` gives it) with ``coverage``: the share of the template's k-grams that stand on the
    diagonal or on one at most ``slack`` words beside it, and the merged span ``start``, ``stop`` in words."""
    near = W.partitionBy("_id", "_row", "template").orderBy("diagonal").rangeBetween(-slack, slack)
    covered = F.size(F.array_distinct(F.flatten(F.collect_list("places").over(near))))
    return found.select("*", F.min("first").over(near).alias("start"), (F.max("last").over(near) + K).alias("stop"),
                        (covered / F.col("n_grams")).alias("coverage"))


def license_notices(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7,
                    slack: int = 3) -> DataFrame:
    """(id, label, start, stop, coverage): the merged spans that cover ``threshold`` of a template's k-grams or more.

    Words are counted from 0 and ``stop`` is the word after the span. Null and empty texts have none.
    """
    merged = spans(diagonals(docs, id_col, text_col), slack).filter(
        F.col("template").isNotNull() & (F.col("coverage") >= F.when(F.col("base"), 1.0).otherwise(threshold)))
    return merged.groupBy(F.col("_id").alias(id_col), "label", "start", "stop").agg(F.max("coverage").alias("coverage"))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7,
                 slack: int = 3) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score): one row per row of ``docs``.

    ``n_base`` counts the places of phrases, ``first_word`` and ``last_word`` are their smallest and largest start
    (null if none), ``score`` is the largest coverage of a template by a merged span. Null and empty texts have no
    words, empty labels and score 0.
    """
    merged = spans(diagonals(docs, id_col, text_col), slack)
    place = F.col("base") & (F.size("places") == F.col("n_grams"))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    found = merged.groupBy("_id", "_row", "n_words").agg(
        F.max("rows").alias("_rows"), F.count_if(place).alias("n_base"),
        F.min(F.when(place, F.col("diagonal").cast("long"))).alias("first_word"),
        F.max(F.when(place, F.col("diagonal").cast("long"))).alias("last_word"),
        joined(F.when(place, F.col("label"))).alias("base_labels"),
        joined(F.when(place | (~F.col("base") & (F.col("coverage") >= threshold)), F.col("label"))).alias("labels"),
        F.coalesce(F.max("coverage"), F.lit(0.0)).alias("score"),
    )
    return repeated(found, "_rows").drop("_row").withColumnRenamed("_id", id_col)


def license_sql(threshold: float = 0.7, slack: int = 3) -> str:
    """``license_scan`` over documents in SQL."""
    quoted = ", ".join(f"({i}, '{text}', '{label}', {i < len(PHRASES)})"
                       for i, (text, label) in enumerate([*PHRASES, *NOTICES]))
    split = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    three = "w[p + 1] || ' ' || w[p + 2] || ' ' || w[p + 3]"
    return f"""
        WITH t AS (SELECT template, label, base, {split} AS w FROM (VALUES {quoted}) v(template, text, label, base)),
        tg AS (SELECT template, label, base, len(w) - 2 AS n, p AS place, {three} AS gram
            FROM (SELECT *, unnest(range(len(w) - 2)) AS p FROM t)),
        d AS (SELECT doc_id, {split} AS w FROM documents),
        g AS (SELECT doc_id, p AS pos, {three} AS gram FROM (SELECT *, unnest(range(len(w) - 2)) AS p FROM d)),
        diag AS (SELECT doc_id, template, label, base, n, pos - place AS diagonal, list(DISTINCT place) AS places
            FROM g JOIN tg USING (gram) GROUP BY ALL),
        cov AS (SELECT *, len(list_distinct(flatten(list(places) OVER (PARTITION BY doc_id, template ORDER BY diagonal
            RANGE BETWEEN {slack} PRECEDING AND {slack} FOLLOWING)))) / n AS coverage, base AND len(places) = n AS place FROM diag)
        SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, count(*) FILTER (WHERE place) AS n_base,
            CAST(min(diagonal) FILTER (WHERE place) AS BIGINT) AS first_word,
            CAST(max(diagonal) FILTER (WHERE place) AS BIGINT) AS last_word,
            coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE place), '') AS base_labels,
            coalesce(string_agg(DISTINCT label, ',' ORDER BY label)
                FILTER (WHERE place OR (NOT base AND coverage >= {threshold})), '') AS labels,
            coalesce(max(coverage), 0.0) AS score
        FROM d LEFT JOIN cov USING (doc_id) GROUP BY d.doc_id, d.w"""

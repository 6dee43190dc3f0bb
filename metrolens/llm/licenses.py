"""License scans by diagonal voting, in DataFrame operations only.

The word bigrams of every document are joined with the bigrams of the license
templates. A match at word p of the document and q of the template votes for
the diagonal p - q. Votes are folded per (document, template, diagonal) in the
scan tasks; neighbouring diagonals, which words put in or left out of the
notice make, are merged; a merged span is verified by the share of the
template's bigrams found in it and by its length. A phrase needs all its
bigrams on one diagonal, so every place of it counts by itself. The words
themselves are compared where hashes meet.

Null and empty texts have no words and no places. Repeated rows are scanned
each for itself.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from metrolens.llm.common import table

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

GAP = 4  # neighbouring diagonals of one span are at most so many words apart
COVERAGE = 0.6  # share of a notice's bigrams that a span must hold
SHORT = 12  # a notice of fewer words must be there in full: a word tells its kin apart
STRETCH = 1.6  # a span may be so many times as long as its notice

# Phrases of which every place counts.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Opening sentences of public licenses and their usual short notices, at most 64 words each.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
    " documentation files": "mit",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
    " granted provided that the above copyright notice": "isc",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the"
    " following conditions are met": "bsd",
    "you may not use this file except in compliance with the license you may obtain a copy of the license at": "apache",
    "licensed under the apache license version 2 0": "apache-2.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public"
    " license as published by the free software foundation": "gpl",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "licensed under the gnu general public license version 2": "gpl-2.0",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general"
    " public license": "lgpl",
    "gnu affero general public license": "agpl",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "licensed under cc by 4 0": "cc-by-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "creative commons attribution 4 0 international license": "cc-by-4.0",
    "creative commons attribution sharealike 4 0 international license": "cc-by-sa-4.0",
    "creative commons attribution noncommercial 4 0 international license": "cc-by-nc-4.0",
    "this is free and unencumbered software released into the public domain": "unlicense",
}


def template_rows(phrases: dict[str, str], notices: dict[str, str]) -> list[tuple]:
    """``(template, label, exact, grams, words, spot, first, second)`` per bigram."""
    out = []
    for template, (text, label, exact) in enumerate(
        [(t, n, True) for t, n in phrases.items()] + [(t, n, False) for t, n in notices.items()]
    ):
        words = text.split()
        if not 2 <= len(words) <= 65 or not all(re.fullmatch("[0-9a-z]+", w) for w in words):
            raise ValueError(f"a template is 2 to 65 lower-case words: {text!r}")
        if re.search("[^0-9a-z.-]", label):
            raise ValueError(f"a label is of lower-case letters, digits, '.' and '-': {label!r}")
        out += [
            (template, label, exact, len(words) - 1, len(words), at, a, b)
            for at, (a, b) in enumerate(zip(words, words[1:]))
        ]
    return out


def template_values(phrases: dict[str, str], notices: dict[str, str]) -> str:
    """The rows as the body of a SQL VALUES list."""
    return ",\n".join(
        f"({t}, '{label}', {str(exact).lower()}, {grams}, {words}, {at}, '{a}', '{b}')"
        for t, label, exact, grams, words, at, a, b in template_rows(phrases, notices)
    )


COLUMNS = "template, label, exact, grams, words, spot, first, second"


def words_of(text: Column) -> Column:
    """Maximal runs of digits, A-Z-lowered letters and characters beyond ASCII."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, SEPARATOR), "")


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: dict[str, str] | None = None,
    notices: dict[str, str] | None = None,
    gap: int = GAP,
    coverage: float = COVERAGE,
) -> DataFrame:
    """Verified spans, and one row for each document without any.

    ``row`` numbers the documents; ``id``, ``n_words``, ``label`` (null: no
    span), ``exact`` (a place of a phrase), ``start``, ``stop`` (words from 0,
    ``stop`` excluded) and ``cover``, the share of the template found.
    """
    spark = docs.sparkSession
    phrases = PHRASES if phrases is None else phrases
    notices = NOTICES if notices is None else notices
    values = template_values(phrases, notices)
    # A fixed list of a few hundred rows, and one that every document meets at position -1.
    templates = spark.sql(
        f"SELECT {COLUMNS}, xxhash64(first, second) AS gram FROM VALUES {values} AS t({COLUMNS}) "
        "UNION ALL SELECT -1, NULL, false, 0, 0, 0, NULL, NULL, 0L"
    )
    words, pos = F.col("__words"), F.col("__pos")
    tokens = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").alias("id"),
        words_of(F.col(f"`{text_col}`")).alias("__words"),
    ).withColumn("n_words", F.size("__words"))
    first, second = F.get(words, pos), F.get(words, pos + 1)
    places = F.sequence(F.lit(-1), F.greatest(F.col("n_words") - 2, F.lit(-1)))
    gram = F.when(pos < 0, F.lit(0).cast("long")).otherwise(F.xxhash64(first, second))
    grams = tokens.select("*", F.explode(places).alias("__pos")).withColumn("__gram", gram)
    same = (F.col("__gram") == F.col("gram")) & (
        ((pos < 0) & (F.col("template") < 0)) | ((pos >= 0) & (first == F.col("first")) & (second == F.col("second")))
    )
    kind = ("label", "exact", "grams", "words")  # of a template
    votes = (
        grams.join(F.broadcast(templates), same)
        .select("row", "id", "n_words", "template", *kind, "spot", "__pos", (pos - F.col("spot")).alias("diagonal"))
        .groupBy("row", "id", "n_words", "template", *kind, "diagonal")
        .agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("spot"))).alias("found"),
            F.min("__pos").alias("low"),
            F.max("__pos").alias("high"),
        )
    )
    # A phrase stands where one diagonal has all its bigrams; a notice's lone votes are chance meetings.
    seeds = votes.filter(
        (F.col("template") < 0)
        | (F.col("exact") & (F.bit_count("found") == F.col("grams")))
        | (~F.col("exact") & (F.bit_count("found") >= 2))
    )
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along)
    new = F.col("exact") | apart.isNull() | (apart > gap)
    spans = (
        seeds.withColumn("new", new.cast("int"))
        .withColumn("span", F.sum("new").over(along))
        .groupBy("row", "id", "n_words", "template", *kind, "span")
        .agg(
            (F.bit_count(F.bit_or("found")) / F.greatest(F.col("grams"), F.lit(1))).alias("cover"),
            F.min("low").alias("start"),
            (F.max("high") + 2).alias("stop"),
        )
    )
    verified = (
        (F.col("template") < 0)
        | F.col("exact")
        | (
            (F.col("cover") >= F.when(F.col("words") < SHORT, 1.0).otherwise(coverage))
            & (F.col("stop") - F.col("start") <= F.col("words") * STRETCH)
        )
    )
    return spans.filter(verified).select(
        "row", "id", "n_words", "label", "exact", "start", "stop", "cover", (F.col("template") < 0).alias("document")
    )


def label_documents(docs: DataFrame, **options) -> DataFrame:
    """One row per document: words, places of phrases, labels and the best cover (see :func:`scan`)."""
    spans = scan(docs, **options)
    joined = lambda names: F.array_join(F.array_sort(names), ",")
    return (
        spans.groupBy("row", "id")
        .agg(
            F.max("n_words").cast("long").alias("n_words"),
            F.count_if("exact").alias("n_base"),
            F.min(F.when(F.col("exact"), F.col("start"))).cast("long").alias("first_word"),
            F.max(F.when(F.col("exact"), F.col("start"))).cast("long").alias("last_word"),
            joined(F.collect_set(F.when(F.col("exact"), F.col("label")))).alias("base_labels"),
            joined(F.collect_set("label")).alias("labels"),
            F.coalesce(F.max(F.when(~F.col("document"), F.col("cover"))), F.lit(0.0)).alias("score"),
        )
        .select(
            F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
        )
    )


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: words, places of the base phrases and labels of every document."""
    return label_documents(table(spark, sf_dir, "documents"))


def oracle_sql() -> str:
    """The same scan in DuckDB SQL, joined on the words themselves."""
    return rf"""
WITH templates({COLUMNS}) AS (VALUES {template_values(PHRASES, NOTICES)}),
tokens AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), placed AS (
  SELECT doc_id, w, unnest(range(len(w) - 1)) AS pos FROM tokens
), votes AS (
  SELECT p.doc_id, t.template, any_value(t.label) AS label, any_value(t.exact) AS exact, any_value(t.grams) AS grams,
         any_value(t.words) AS words, p.pos - t.spot AS diagonal, list(DISTINCT t.spot) AS found,
         min(p.pos) AS low, max(p.pos) AS high
  FROM placed p JOIN templates t ON p.w[p.pos + 1] = t.first AND p.w[p.pos + 2] = t.second
  GROUP BY p.doc_id, t.template, p.pos - t.spot
), seeds AS (
  SELECT *, CASE WHEN exact OR diagonal - lag(diagonal) OVER along <= {GAP} IS NOT TRUE THEN 1
                 ELSE 0 END AS new
  FROM votes
  WHERE CASE WHEN exact THEN len(found) = grams ELSE len(found) >= 2 END
  WINDOW along AS (PARTITION BY doc_id, template ORDER BY diagonal)
), islands AS (
  SELECT *, sum(new) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM seeds
), spans AS (
  SELECT doc_id, template, any_value(label) AS label, any_value(exact) AS exact, any_value(words) AS words,
         len(list_distinct(flatten(list(found)))) / any_value(grams) AS cover, min(low) AS start, max(high) + 2 AS stop
  FROM islands GROUP BY doc_id, template, span
), verified AS (
  SELECT * FROM spans WHERE exact OR (cover >= CASE WHEN words < {SHORT} THEN 1 ELSE {COVERAGE} END AND stop - start <= words * {STRETCH})
)
SELECT d.doc_id, any_value(len(d.w)) AS n_words, count(*) FILTER (v.exact) AS n_base,
       min(v.start) FILTER (v.exact) AS first_word, max(v.start) FILTER (v.exact) AS last_word,
       coalesce(list_aggregate(list_sort(list_distinct(list(v.label) FILTER (v.exact))), 'string_agg', ','), '')
         AS base_labels,
       coalesce(list_aggregate(list_sort(list_distinct(list(v.label) FILTER (v.label IS NOT NULL))), 'string_agg', ','),
                '') AS labels,
       coalesce(max(v.cover), 0.0)::DOUBLE AS score
FROM tokens d LEFT JOIN verified v ON v.doc_id = d.doc_id
GROUP BY d.doc_id
"""

"""License scan by diagonal voting (operator 8), in built-in functions only.

All rolling word k-grams of all documents are joined to the positions of the same k-gram in the
license templates. A hit at document position p and template position t votes for the diagonal
p - t. Votes are aggregated per (document, template, diagonal); neighbouring diagonals, which a
missing or added word makes of one, are merged around each diagonal; merged spans are verified by the
share of the template's k-grams they cover in the template's order.

The k-gram text itself is joined along with its hash, so equal hashes of different words never
vote. The template table has one row per template word and is the parameter's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from .common import BROADCAST_ROWS, lower_ascii

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The base phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Opening and grant sentences of public licenses, for spans that are near but not equal to them.
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0 you may not use this file except in compliance with the license", "apache"),
    ("licensed under the apache license version 2 0", "apache"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)


def document_words(text: Column) -> Column:
    """Words of the text with A-Z in lower case; none for null."""
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def grams(words: Column, k: int) -> Column:
    """The k-gram that starts at each word; null for the last k - 1 words."""
    def at(word: Column, i: Column) -> Column:
        return F.when(i <= F.size(words) - k, F.concat_ws(" ", word, *[F.get(words, i + j) for j in range(1, k)]))
    return F.transform(words, at)


def template_positions(spark: SparkSession, phrases: tuple, templates: tuple, k: int) -> DataFrame:
    """One row per gram of each template: template, label, base, n_grams, at, own (its words), hash. Grams have k words,
    or all of a shorter template."""
    listed = [(i, label, i < len(phrases), words, min(k, len(words)))
              for i, (words, label) in enumerate((text.split(), label) for text, label in (*phrases, *templates))]
    rows = [(i, label, base, len(words) - n + 1, at, " ".join(words[at:at + n]))
            for i, label, base, words, n in listed for at in range(len(words) - n + 1)]
    table = spark.createDataFrame(rows, "template int, label string, base boolean, n_grams int, at int, own string")
    return table.withColumn("hash", F.xxhash64("own"))


def in_order(parts: Column) -> Column:
    """Most grams of a template that follow each other in the text in the template's order; parts are merged diagonals
    (diagonal, ats). Hits are taken by template position; each continues the longest run that ends before it."""
    hits = F.array_sort(F.flatten(F.transform(parts, lambda d: F.transform(
        d["ats"], lambda t: F.struct(t.alias("t"), (d["diagonal"] + t).alias("p"))))))

    def longer(runs: Column, hit: Column) -> Column:
        before = F.filter(runs, lambda r: (r["t"] < hit["t"]) & (r["p"] < hit["p"]))
        best = F.coalesce(F.array_max(F.transform(before, lambda r: r["n"])), F.lit(0)) + 1
        return F.array_append(runs, F.struct(hit["t"].alias("t"), hit["p"].alias("p"), best.alias("n")))
    none = F.array().cast("array<struct<t: int, p: int, n: int>>")
    return F.aggregate(hits, none, longer, lambda runs: F.array_max(F.transform(runs, lambda r: r["n"])))


def license_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, phrases: tuple = PHRASES,
                   templates: tuple = TEMPLATES, k: int = 2, reach: int = 6, cover: float = 0.85) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    A base phrase stands where one diagonal has all its grams. A template is found where the diagonals
    at most `reach` from one of them together cover at least `cover` of its grams in the template's order; `score` is the
    best cover found (1 with a base phrase, 0 with nothing). Phrases of fewer than k words are one gram. Null and empty
    texts have no words, no labels and score 0; rows that repeat id and text get a row each; other columns are ignored.
    """
    spark = docs.sparkSession
    table = template_positions(spark, phrases, templates, k)
    lengths = [len(t.split()) for t, _ in (*phrases, *templates)]
    if sum(lengths) <= BROADCAST_ROWS:
        table = F.broadcast(table)
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("text_key"), document_words(text).alias("words"))
    rows = rows.withColumn("n_words", F.size("words"))  # before the explode, which would else carry all words with each entry
    sizes = sorted({min(k, n) for n in lengths})
    # an entry per size and word, and one more without a gram that carries the number of words and of equal rows
    entries = F.concat(*[grams(F.col("words"), n) for n in sizes], F.array(F.lit(None).cast("string")))
    placed = rows.select("doc_id", "text_key", "n_words", F.posexplode(entries).alias("entry", "gram"))
    placed = (placed.where(F.col("gram").isNotNull() | (F.col("entry") == F.col("n_words") * len(sizes)))
              .withColumn("pos", F.when(F.col("gram").isNotNull(), F.col("entry") % F.col("n_words"))).drop("entry")
              .withColumn("hash", F.xxhash64("gram")))
    hits = (placed.join(table, "hash", "left").where(F.col("gram").isNull() | (F.col("gram") == F.col("own")))
            .withColumn("diagonal", F.col("pos") - F.col("at")))
    doc = ("doc_id", "text_key")
    votes = hits.groupBy(*doc, "template", "label", "base", "n_grams", "diagonal").agg(
        F.collect_set("at").alias("ats"), F.max("n_words").alias("n_words"), F.count(F.lit(1)).alias("n_rows"))
    votes = votes.repartition(*doc)
    # neighbouring diagonals: all within reach of a diagonal, whatever else of the template stands between them
    near = Window.partitionBy(*doc, "template").orderBy("diagonal").rangeBetween(-reach, reach)
    merged = votes.withColumn("parts", F.when(~F.col("base"), F.collect_list(F.struct("diagonal", "ats")).over(near)))
    needed = F.col("n_grams") * cover
    likely = F.size(F.array_distinct(F.flatten(F.transform("parts", lambda d: d["ats"])))) >= needed
    merged = merged.withColumn("parts", F.when(likely, F.col("parts"))).withColumn("share", in_order(F.col("parts")))
    starts = F.collect_list(F.when(F.col("base") & (F.size("ats") == F.col("n_grams")), F.col("diagonal")))
    found = (F.col("share") >= needed) & F.col("label").isNotNull()
    per_doc = merged.groupBy(*doc).agg(
        F.max("n_words").cast("long").alias("n_words"), F.max(F.when(F.col("label").isNull(), F.col("n_rows"))).alias("n_rows"),
        starts.alias("starts"), F.collect_set(F.when(F.col("base") & (F.size("ats") == F.col("n_grams")), F.col("label"))).alias("base_set"),
        F.collect_set(F.when(found, F.col("label"))).alias("near_set"), F.max(F.when(found, F.col("share") / F.col("n_grams"))).alias("near"))
    out = per_doc.select(
        "doc_id", "n_words", F.size("starts").cast("long").alias("n_base"), F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"), F.concat_ws(",", F.array_sort("base_set")).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union("base_set", "near_set"))).alias("labels"),
        F.when(F.size("starts") > 0, F.lit(1.0)).otherwise(F.coalesce("near", F.lit(0.0))).alias("score"),
        F.explode(F.array_repeat(F.lit(1), F.col("n_rows").cast("int"))).alias("copy"))
    return out.drop("copy")

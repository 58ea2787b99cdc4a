"""License scans by diagonal voting, in DataFrame functions only.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased (null: empty). Every
rolling 2-gram of a text is hashed and joined to the positions of the same hash in the templates; a hit
at text word p and template word t votes for the diagonal p - t. Diagonals of one template that lie
within ``SLACK`` of each other, and whose spans are no further apart than the template is long, are
merged, so a few inserted or dropped words do not end a match. A merged span is verified by its words: the 2-grams hit
must cover the share ``LEAST`` of the template's words, each position counted once, so one replaced word costs one
word. The template's deciding words, which tell it from other licenses, must be among those covered.

The four base phrases are templates whose span must be whole on a single diagonal; one such diagonal is
one place. The other templates add labels of their own. ``score`` is the largest verified share
(1 for a base place, 0 without any).

Each row of the input gives a row; null or empty text has no words; repeated rows give repeated rows;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

# The base phrases and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Sentences of well-known licenses and notices, the label each adds, and its deciding words.
TEMPLATES = (
    ("licensed under the apache license version 2 0", "apache-2.0", "apache 2"),
    ("you may not use this file except in compliance with the license", "apache-2.0", "compliance license"),
    ("released under the mit license", "mit-notice", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software "
     "and associated documentation files", "mit-notice", "permission documentation"),
    ("licensed under the gnu general public license version 3", "gpl-3.0", "general 3"),
    ("gnu general public license version 2", "gpl-2.0", "general 2"),
    ("under the terms of the gnu lesser general public license", "lgpl", "lesser"),
    ("under the terms of the gnu affero general public license", "agpl", "affero"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0", "cc nc 4"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0", "cc sa 4"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by-4.0", "commons 4"),
    ("redistribution and use in source and binary forms with or without modification are permitted",
     "bsd", "redistribution binary"),
    ("permission to use copy modify and or distribute this software for any purpose with or without "
     "fee is hereby granted", "isc", "permission purpose"),
    ("subject to the terms of the mozilla public license", "mpl", "mozilla"),
    ("this is free and unencumbered software released into the public domain", "unlicense", "unencumbered"),
)

GRAM = 2
SLACK = 3
LEAST = 0.75
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text):
    """The words of a text column. The Kelvin sign, whose lower case is ASCII, becomes another letter first."""
    folded = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))
    return F.array_remove(F.split(folded, SEPARATORS), "")


def grams_of(words):
    """The hash of every 2-gram, in order; none for fewer than two words."""
    return F.when(F.size(words) >= GRAM, F.transform(
        F.sequence(F.lit(1), F.size(words) - GRAM + 1),
        lambda i: F.xxhash64(F.element_at(words, i), F.element_at(words, i + 1)))).otherwise(
        F.array().cast("array<bigint>"))


def template_positions(spark: SparkSession, base=BASE, templates=TEMPLATES) -> DataFrame:
    """gram, template, t (position), n (words of the template), is_base, label and the deciding positions."""
    rows = [(i, phrase, label, True, []) for i, (phrase, label) in enumerate(base)]
    rows += [(len(base) + i, phrase, label, False, [phrase.split().index(w) for w in deciding.split()])
             for i, (phrase, label, deciding) in enumerate(templates)]
    table = spark.createDataFrame(
        rows, "template int, phrase string, label string, is_base boolean, deciding array<int>")
    table = table.withColumn("words", F.split("phrase", " ")).withColumn("grams", grams_of(F.col("words")))
    return table.select(
        "template", "label", "is_base", "deciding", F.size("words").alias("n"),
        F.posexplode("grams").alias("t", "gram"))


def license_scan(docs: DataFrame, base=BASE, templates=TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and matches."""
    positions = template_positions(docs.sparkSession, base, templates)
    every = (
        docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words_of(F.col("text")).alias("words"))
        .select("row", "doc_id", F.size("words").alias("n_words"), grams_of(F.col("words")).alias("grams"))
        .select("row", "doc_id", "n_words", F.posexplode_outer("grams").alias("p", "gram")))
    # The templates are this module's own few hundred positions, so broadcasting them is bounded.
    hits = (
        every.join(F.broadcast(positions), "gram", "left")
        .where(F.col("template").isNotNull() | F.coalesce(F.col("p"), F.lit(0)).eqNullSafe(0)))
    diagonals = (
        hits.groupBy("row", "doc_id", "n_words", "template", "label", "is_base", "deciding", "n",
                     (F.col("p") - F.col("t")).alias("diagonal"))
        .agg(F.collect_set("t").alias("ts"), F.min("p").alias("p0"), F.max("p").alias("p1")))
    # Merge neighbouring diagonals: a new group starts where diagonal or span is too far from the last.
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = (
        (F.col("diagonal") - F.lag("diagonal").over(order) > SLACK)
        | (F.col("p0") > F.lag("p1").over(order) + F.col("n")) | F.col("is_base"))
    grouped = diagonals.withColumn("span", F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(order))
    spans = (
        grouped.groupBy("row", "doc_id", "n_words", "template", "label", "is_base", "deciding", "n", "span")
        .agg(F.array_distinct(F.flatten(F.collect_list("ts"))).alias("ts"),
             F.min("p0").alias("p0"), F.max("p1").alias("p1")))
    covered = F.array_union("ts", F.transform("ts", lambda t: t + GRAM - 1))
    share = F.when(F.col("template").isNotNull(), F.size(covered) / F.col("n"))
    whole = F.col("is_base") & (F.size("ts") == F.col("n") - GRAM + 1)
    good = F.when(F.col("is_base"), whole).otherwise(
        (share >= LEAST) & (F.size(F.array_except("deciding", covered)) == 0) & (F.col("p1") - F.col("p0") <= 2 * F.col("n") + SLACK))
    verified = spans.withColumn("share", share).withColumn("whole", whole).withColumn("good", good)
    joined = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    return (
        verified.groupBy("row", "doc_id", "n_words").agg(
            F.count(F.when(F.col("whole"), 1)).alias("n_base"),
            F.min(F.when(F.col("whole"), F.col("p0"))).cast("long").alias("first_word"),
            F.max(F.when(F.col("whole"), F.col("p0"))).cast("long").alias("last_word"),
            joined(F.when(F.col("whole"), F.col("label"))).alias("base_labels"),
            joined(F.when(F.col("good"), F.col("label"))).alias("labels"),
            F.coalesce(F.max(F.when(F.col("good"), F.col("share"))), F.lit(0.0)).alias("score"),
            F.sort_array(F.collect_list(F.when(F.col("good"), F.struct(
                F.col("p0").alias("start"), (F.col("p1") + GRAM).alias("end"), "label", "share"))))
            .alias("matches"))
        .drop("row").withColumn("n_words", F.col("n_words").cast("long")))

"""License scans by diagonal voting.

All rolling word k-grams of the texts are hashed and joined to the places of the same grams in license templates, by two
independent hashes (96 bits), so that no other gram passes for one of a template's. A match votes for its diagonal, the offset
between the two places; neighbouring diagonals merge (words added or left out move the rest by a few places), and a span counts
if enough of the template's words stand in it. Templates are notices and whole texts; their grams are a table, sent to all
tasks while its counted size allows and else joined by a shuffle.

Cases: null texts count as empty: no words, no labels, score 0. Repeated rows and ids are rows of their own. Texts shorter
than a gram cannot match. Templates that fit equally well all give their labels. Clashing extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martkit.llm.common import WORD, id_text, lower_ascii, sent_if_small
from martkit.llm.license_texts import TEXTS

K = 3
#: Diagonals this near to each other are one passage.
SHIFT = 3
#: Least share of a template's words that a span must hold.
COVERAGE = 0.8


@dataclass(frozen=True)
class Template:
    label: str
    words: str
    exact: bool = False


#: The contract's phrases, then well-known notices.
TEMPLATES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc0", "the person who associated a work with this deed has dedicated the work to the public domain"),
    Template("all-rights-reserved", "all rights reserved", True),
    Template("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    Template("agpl-3", "it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license"),
    Template("epl-2", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"),
    *(Template(label, words) for label, words in TEXTS),
)
BASE_COUNT = 3


def _gram(words: list) -> list:
    """Two hashes of neighbouring words."""
    return [F.xxhash64(*words).alias("gram"), F.hash(*words).alias("proof")]


def template_grams(spark: SparkSession, templates: tuple[Template, ...] = TEMPLATES, k: int = K) -> DataFrame:
    """``gram, proof, template, place``: as many rows as the templates have words."""
    rows = []
    for t, template in enumerate(templates):
        words = template.words.split()
        if len(words) < k:
            raise ValueError(f"{template.words!r} has fewer than {k} words")
        rows += [(t, p, words[p : p + k]) for p in range(len(words) - k + 1)]
    df = spark.createDataFrame(rows, "template int, place int, w array<string>")
    return df.select(*_gram([F.get("w", F.lit(i)) for i in range(k)]), "template", "place")


def votes(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, doc_id, n_words, template, diagonal, places`` for each diagonal with a vote; template -1 once for each text."""
    spark = docs.sparkSession
    # the entry of two zeros stands for a text itself
    known = template_grams(spark, templates, k).unionByName(spark.createDataFrame([(0, 0, -1, 0)], "gram long, proof int, template int, place int"))
    texts = id_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    words = texts.withColumn("w", F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(WORD), F.lit(0))).drop("text").withColumn("n_words", F.size("w"))
    starts = F.when(F.col("n_words") >= k, F.sequence(F.lit(0), F.col("n_words") - k))
    hashed = words.withColumn("h", F.transform(starts, lambda i: F.struct(*_gram([F.get("w", i + j) for j in range(k)]))))
    # exploding "outer" keeps the planner from testing the whole expression twice
    end = F.array(F.struct(F.lit(0).cast("long").alias("gram"), F.lit(0).alias("proof")))
    every = hashed.select("row", "doc_id", "n_words", F.concat(F.coalesce("h", end), F.when(F.col("h").isNotNull(), end).otherwise(F.slice(end, 1, 0))).alias("grams"))
    rows = every.select("row", "doc_id", "n_words", F.posexplode_outer("grams").alias("at", "g"))
    rows = rows.select("row", "doc_id", "n_words", "at", "g.gram", "g.proof")
    met = rows.join(sent_if_small(known, 24), ["gram", "proof"]).repartition("row")
    diagonal = F.when(F.col("template") >= 0, F.col("at") - F.col("place"))
    return met.groupBy("row", "doc_id", "n_words", "template", diagonal.alias("diagonal")).agg(F.collect_set("place").alias("places"))


def spans(voted: DataFrame, templates: tuple[Template, ...] = TEMPLATES, k: int = K, shift: int = SHIFT, coverage: float = COVERAGE) -> DataFrame:
    """``row, doc_id, n_words, template, label, exact, first_word, last_word, score``; the row of template -1 stays."""
    about = voted.sparkSession.createDataFrame(
        [(i, t.label, t.exact, len(t.words.split())) for i, t in enumerate(templates)], "template int, label string, exact boolean, size int"
    )
    df = voted.join(F.broadcast(about), "template", "left")
    by = Window.partitionBy("row", "template").orderBy("diagonal")
    far = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by) > F.when(F.col("exact"), 0).otherwise(shift), F.lit(True))
    df = df.withColumn("passage", F.sum(far.cast("int")).over(by))
    at = lambda pick: F.aggregate("places", F.lit(None).cast("int"), lambda a, x: pick(F.coalesce(a, x), x))
    df = df.withColumn("low", F.col("diagonal") + at(F.least)).withColumn("high", F.col("diagonal") + at(F.greatest) + k - 1)
    keys = ["row", "doc_id", "n_words", "template", "label", "exact", "size", "passage"]
    merged = df.groupBy(*keys).agg(
        F.min("low").alias("first_word"), F.max("high").alias("last_word"), F.flatten(F.collect_list("places")).alias("places")
    )
    held = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + k - 1))))
    merged = merged.withColumn("score", F.size(held) / F.col("size"))
    return merged.where((F.col("template") < 0) | (F.col("score") >= F.when(F.col("exact"), 1.0).otherwise(coverage))).drop("places", "passage", "size")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its words, spans and labels."""
    found = spans(votes(docs, id_col=id_col, text_col=text_col))
    base = (F.col("template") >= 0) & (F.col("template") < BASE_COUNT)
    real = F.col("template") >= 0
    return found.groupBy("row", "doc_id", "n_words").agg(
        F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("first_word"))).alias("first_word"), F.max(F.when(base, F.col("first_word"))).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set(F.when(real, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(real, F.col("score"))), F.lit(0.0)).alias("score"),
        F.collect_list(F.when(real, F.struct("first_word", "last_word", "label", "score"))).alias("spans"),
    )

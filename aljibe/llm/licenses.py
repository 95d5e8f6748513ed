"""License texts in documents: words of known phrases, and diagonals of word k-grams shared with templates. DataFrame functions only."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aljibe.session import staged

#: Phrases and labels of the base.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Notices and short license lines as published with the licenses.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the "
            "Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
            "the Software, and to permit persons to whom the Software is furnished to do so"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy "
               "of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
            "Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the "
             "Free Software Foundation"),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the "
             "Free Software Foundation"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright "
            "notice and this permission notice appear in all copies"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
]
GRAM = 3  # words of a k-gram
SHIFT = 3  # diagonals this near are one place: so many words may be put in or left out between two votes
LEAST = 0.8  # share of a template's words that a place must hold
SPREAD = 1.5  # a place is at most so many times as long as its template
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), SEPARATORS), "")


def grams(tokens: Column) -> Column:
    """The k-grams from each word on, as text; fewer words have none."""
    last = F.size(tokens) - GRAM
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.concat_ws(" ", *[F.get(tokens, i + j) for j in range(GRAM)])))


def template_grams(spark: SparkSession, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """template, label, n_template (its words), at, gram: the words of the templates bound its rows."""
    texts = [F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(text).alias("text")) for i, (label, text) in enumerate(templates)]
    tokens = spark.range(1).select(F.inline(F.array(*texts))).select("template", "label", words(F.col("text")).alias("tokens"))
    return tokens.select("template", "label", F.size("tokens").alias("n_template"), F.posexplode(grams(F.col("tokens"))).alias("at", "gram"))


def places(docs: DataFrame, text: Column, templates: DataFrame) -> DataFrame:
    """``text_key`` (SHA-256 of the text), label, start, stop (words, exclusive) and share of the places that vote for a template.

    Every k-gram of every text is joined to the template positions by hash. A vote is for the diagonal, position less template position; votes are
    combined per task first, so the copies of a text send them once. Neighbouring diagonals of a template are merged, and the place is
    verified by the words themselves: hash hits whose words differ do not count, and ``share`` is the part of the template's words that
    lie under a k-gram found there. What is windowed and gathered belongs to one text.
    """
    hashed = lambda df: df.withColumn("hash", F.xxhash64("gram"))
    all_grams = docs.select(F.sha2(text, 256).alias("text_key"), words(text).alias("tokens"))
    all_grams = hashed(all_grams.select("text_key", F.posexplode(grams(F.col("tokens"))).alias("pos", "gram")))
    known = F.broadcast(hashed(templates).withColumnRenamed("gram", "known"))
    votes = all_grams.join(known, "hash").groupBy("text_key", "template", "label", "n_template", (F.col("pos") - F.col("at")).alias("diagonal"))
    diagonals = votes.agg(F.collect_set(F.when(F.col("gram") == F.col("known"), F.col("at"))).alias("at")).where(F.size("at") > 0)
    along = Window.partitionBy("text_key", "template").orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(along) > SHIFT).cast("int"), F.lit(0))
    merged = diagonals.withColumn("apart", apart).withColumn("place", F.sum("apart").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    whole = merged.groupBy("text_key", "template", "label", "n_template", "place").agg(
        F.min(F.col("diagonal") + F.array_min("at")).cast("bigint").alias("start"), (F.max(F.col("diagonal") + F.array_max("at")) + GRAM).cast("bigint").alias("stop"),
        F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"),
    )
    covered = F.array_distinct(F.flatten(F.transform("at", lambda t: F.sequence(t, t + GRAM - 1))))
    tight = F.col("stop") - F.col("start") <= F.col("n_template") * SPREAD
    return whole.where(tight).select("text_key", "label", "start", "stop", (F.size(covered) / F.col("n_template")).alias("share"))


def verdicts(found: DataFrame) -> DataFrame:
    """Per text: ``found_labels`` of its verified places and the largest ``share`` of any place. Of places that overlap, the one that holds most of its template counts."""
    along = Window.partitionBy("text_key").orderBy("start", "stop", "label")
    before = F.max("stop").over(along.rowsBetween(Window.unboundedPreceding, -1))
    islands = found.withColumn("apart", (F.col("start") >= F.coalesce(before, F.lit(0))).cast("int"))
    islands = islands.withColumn("island", F.sum("apart").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    best = islands.withColumn("best", F.max("share").over(Window.partitionBy("text_key", "island")))
    wins = (F.col("share") >= LEAST) & (F.col("share") == F.col("best"))
    return best.groupBy("text_key").agg(F.collect_set(F.when(wins, F.col("label"))).alias("found_labels"), F.max("share").alias("share"))


def phrase_places(tokens: Column, text: Column) -> Column:
    """Array of (word, label) where a phrase stands; texts that hold no phrase's rarest word are not searched."""
    def label_at(i: Column) -> Column:
        found = F.lit(None).cast("string")
        for phrase, label in PHRASES.items():
            found = F.when(reduce(and_, [F.get(tokens, i + j) == word for j, word in enumerate(phrase.split())]), label).otherwise(found)
        return found

    at = F.transform(F.sequence(F.lit(0), F.size(tokens) - 1), lambda i: F.struct(i.cast("bigint").alias("word"), label_at(i).alias("label")))
    lowered = F.translate(text, UPPER, LOWER)
    likely = (lowered.contains("license") | lowered.contains("cc")) & (F.size(tokens) > 0)
    return F.when(likely, F.filter(at, lambda x: x["label"].isNotNull())).otherwise(F.array().cast("array<struct<word:bigint,label:string>>"))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Base columns tell of the places of PHRASES; ``labels`` has those of verified template places too. ``score`` is 1 with a base place, else the largest share
    of a template's words found in one place (0 without). NULL texts are empty; repeated rows and NULL ids are scanned like any other; other columns are not read.
    Texts are not shuffled: their votes are, and meet the rows again by the SHA-256 of the text, so copies share them. The verdicts are
    written first (runs a job), so that both sides of that join come straight from a shuffle and AQE splits a text with many copies.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("_text"), words(text).alias("_tokens"))
    rows = rows.select("doc_id", F.sha2("_text", 256).alias("text_key"), F.size("_tokens").cast("bigint").alias("n_words"),
                       phrase_places(F.col("_tokens"), F.col("_text")).alias("_places"))
    starts, labels = F.col("_places.word"), F.array_distinct(F.col("_places.label"))
    rows = rows.select(
        "doc_id", "text_key", "n_words", F.size("_places").cast("bigint").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), F.array_sort(labels).alias("_base"),
    )
    voted = staged(verdicts(places(docs, text, template_grams(docs.sparkSession, templates))))
    both = F.array_sort(F.array_union("_base", F.coalesce("found_labels", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0)))
    joined = rows.join(voted, "text_key", "left")
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("_base", ",").alias("base_labels"), F.array_join(both, ",").alias("labels"),
        score.alias("score"),
    )

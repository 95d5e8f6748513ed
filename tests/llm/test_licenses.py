import random
import re

from pyspark.sql import functions as F

from aljibe.llm import licenses

PHRASES = {("gnu", "general", "public", "license"): "gpl", ("apache", "license"): "apache", ("cc", "by"): "cc-by", ("mit", "license"): "mit"}


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_base(text):
    words = words_of(text)
    found = [(i, label) for i in range(len(words)) for phrase, label in PHRASES.items() if tuple(words[i : i + len(phrase)]) == phrase]
    starts = [i for i, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in found}))


def brute_places(text, templates):
    """Places of one text by comparing every k-gram with every template position."""
    words, found = words_of(text), []
    for label, template in templates:
        own = words_of(template)
        votes = sorted((i - j, j) for i in range(len(words) - 2) for j in range(len(own) - 2) if words[i : i + 3] == own[j : j + 3])
        groups = []
        for diagonal, j in votes:
            if not groups or diagonal - groups[-1][-1][0] > 3:
                groups.append([])
            groups[-1].append((diagonal, j))
        for group in groups:
            start, stop = min(d + j for d, j in group), max(d + j for d, j in group) + 3
            if stop - start <= 1.5 * len(own):
                found.append((label, start, stop, round(len({j + x for _, j in group for x in range(3)}) / len(own), 9)))
    return sorted(found)


def documents(seed=3):
    dice, docs = random.Random(seed), []
    vocabulary = "the of software license apache cc by mit gnu general public free use and é日 x1".split()
    for i in range(60):
        words = [dice.choice(vocabulary) for _ in range(dice.randrange(0, 60))]
        for _ in range(dice.randrange(0, 3)):
            notice = words_of(dice.choice(licenses.TEMPLATES)[1])
            for _ in range(dice.randrange(0, 4)):
                place = dice.randrange(len(notice))
                notice[place : place + dice.randrange(0, 2)] = [dice.choice(vocabulary)] * dice.randrange(0, 3)
            at = dice.randrange(len(words) + 1)
            words[at:at] = notice
        docs.append((i, dice.choice([" ", ", ", "--", "\n"]).join(words)))
    return docs


def test_places_equal_brute_force(spark):
    docs = documents()
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = licenses.places(frame, F.col("text"), licenses.template_grams(spark))
    keyed = found.join(frame.select("doc_id", F.sha2("text", 256).alias("text_key")), "text_key")
    got = sorted((r.doc_id, r.label, r.start, r.stop, round(r.share, 9)) for r in keyed.collect())
    assert got == sorted((i, *place) for i, text in docs for place in brute_places(text, licenses.TEMPLATES))


def test_base_columns_equal_brute_force(spark, with_clashes):
    docs = documents(5) + [
        (None, None), (100, ""), (101, "MIT\x00license MIT LICENSE cc-by CC/BY"), (101, "MIT\x00license MIT LICENSE cc-by CC/BY"), (102, "apache licenses mitlicense"),
        (103, "GNU General\tPublic License " * 3), (104, "Ücc by ccé by cc by"), (105, "...---..."), (106, "KELVIN K mit Ⅼicense ﬁ"), (107, "word " * 50_000 + "mit license"),
    ]
    frame = with_clashes(spark.createDataFrame(docs, "doc_id long, text string"))
    for name in ("label", "text_key", "labels", "_tokens", "share", "template"):
        frame = frame.withColumn(name, F.lit("x"))
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.license_scan(frame).collect()), key=repr)
    assert got == sorted(((i, *brute_base(text or "")) for i, text in docs), key=repr)
    assert licenses.license_scan(frame.limit(0)).collect() == []


def labels_of(spark, *texts):
    rows = licenses.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return [(r.labels, round(r.score, 3)) for r in sorted(rows, key=lambda r: r.doc_id)]


def test_notices_are_found_although_words_differ(spark):
    bsd = dict(licenses.TEMPLATES)["bsd"]
    changed = bsd.replace("source and binary", "source, object and binary").replace("following conditions", "conditions below")
    assert labels_of(
        spark, f"Intro text. {bsd.upper()}. More.", changed, " ".join(bsd.split()[:8]), "We use source and binary forms.", "Licensed under CC BY-NC 4.0.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "none of it",
    ) == [("bsd", 1.0), ("bsd", 0.81), ("", 0.381), ("", 0.19), ("cc-by,cc-by-nc", 1.0), ("lgpl", 1.0), ("", 0.0)]


def test_only_spark_functions_and_no_text_in_a_shuffle(spark):
    docs, plans = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string"), []
    voted = licenses.verdicts(licenses.places(docs, F.col("text"), licenses.template_grams(spark)))
    for df in (voted, licenses.license_scan(docs)):
        text = df._jdf.queryExecution().executedPlan().toString()
        plans.append(text)
        for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"):
            assert word not in text
    exchanges = [line for text in plans for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("_tokens" in line or "_text#" in line or "_text," in line for line in exchanges)

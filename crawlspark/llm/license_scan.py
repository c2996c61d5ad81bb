"""License scans: an exact set-similarity join of text blocks with license templates, in DataFrame functions alone.

A text is cut into blocks of ``BLOCK`` words, one beginning every ``STEP`` words, so that a notice of up to ``STEP`` words
lies whole in a block however its lines break. A block carries a template's label if it holds at least ``THRESHOLD`` of
the template's distinct words. The join is exact:

* frequencies: a template's words are ordered by how often they stand in all texts, the rarest first;
* prefix filter: a block that may reach the threshold holds one of the first ``|T| - needed + 1`` words of the template;
* length filter: it has at least ``needed`` distinct words;
* positional filter: what it holds of the prefix, and all of the template behind the prefix, must reach ``needed``;
* the blocks left are compared in full.

Where templates with mostly the same words match in one block, ``matches`` gives the best containment, and the larger word set
among equals. ``scan`` keeps all of them, but for a match that better ones explain: all its words found are also words of the
better templates, and the block doesn't hold enough of them more often than those notices stand there. So the GPL isn't read
into a notice of the LGPL, and where both stand both are named. Beside that, plain phrases are found where their words stand
consecutively. Words are runs of letters, digits and non-ASCII characters, A-Z in lower case. Null and empty texts have no words, labels or places. The templates are a fixed list of a
few hundred words: they are broadcast, texts are not shuffled. Rows that share an id are scanned one by one.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK, STEP, THRESHOLD, RIVAL = 64, 32, 0.85, 0.5
# Phrases, and notices of common licenses (their first sentences, at most STEP words).
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
TEMPLATES = {
    "apache-2.0": ["licensed under the apache license version 2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"],
    "gpl-notice": ["licensed under the gnu general public license", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"],
    "lgpl-notice": ["licensed under the gnu lesser general public license", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by"],
    "agpl-notice": ["licensed under the gnu affero general public license"],
    "mit-notice": ["released under the mit license", "licensed under the mit license", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"],
    "bsd-notice": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "isc-notice": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"],
    "mpl-2.0": ["this source code form is subject to the terms of the mozilla public license v 2.0"],
    "cc-by-4.0": ["licensed under cc by 4.0", "licensed under a creative commons attribution 4.0 international license"],
    "cc-by-nc-4.0": ["licensed under cc by nc 4.0", "licensed under a creative commons attribution noncommercial 4.0 international license"],
    "cc-by-sa-4.0": ["licensed under cc by sa 4.0", "licensed under a creative commons attribution sharealike 4.0 international license"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
}
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same with A-Z among the words, for texts as they are.
ANY_WORD, ANY_GAP, IN_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAP), lambda w: w != "")


def templates() -> list[tuple[str, list[str]]]:
    return [(label, sorted(set(re.split(r"[^a-z0-9]+", notice)) - {""})) for label, notices in TEMPLATES.items() for notice in notices]


def frequencies(df: DataFrame, text: str = "text") -> dict[str, int]:
    """How often each word of a template stands in all texts: a few hundred numbers."""
    known = {w for _, words_ in templates() for w in words_}
    table = df.sparkSession.createDataFrame([(w,) for w in sorted(known)], "word string")
    # Only the templates' words matter: what has capitals is lowered after the cut, word by word.
    each = df.select(F.explode(F.split(text, ANY_GAP)).alias("word")).select(F.translate("word", UPPER, LOWER).alias("word"))
    return {r["word"]: r["n"] for r in each.join(F.broadcast(table), "word").groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}


def _whole(alternatives, gap: str = "") -> str:
    return rf"(?i)(?<!{IN_WORD})(?:{'|'.join(alternatives)})(?!{IN_WORD})"


def places_of(w: Column, phrase: list[str]) -> Column:
    """Where the words of a phrase stand consecutively in an array of words, from 0."""
    begins = F.filter(F.transform(w, lambda x, i: F.when(x == phrase[0], i)), lambda i: i.isNotNull())
    return F.filter(begins, lambda i: F.array_join(F.slice(w, i + 1, len(phrase)), " ") == " ".join(phrase))


def matches(df: DataFrame, key: list[str], text: str = "text", every: bool = False) -> DataFrame:
    """key, block, label, containment where a block reaches a template's threshold: the best of similar templates.

    With ``every``: all of them that better ones don't explain.
    """
    counts = frequencies(df, text)
    index, shapes = [], []
    for t, (label, own) in enumerate(templates()):
        needed = math.ceil(THRESHOLD * len(own) - 1e-9)
        ordered = sorted(own, key=lambda w: (counts.get(w, 0), w))
        prefix = ordered[:len(own) - needed + 1]
        index += [(w, t) for w in prefix]
        shapes.append((t, label, ordered, needed, len(prefix)))
    spark = df.sparkSession
    prefixes = F.broadcast(spark.createDataFrame(index, "word string, template int"))
    table = F.broadcast(spark.createDataFrame(shapes, "template int, label string, words array<string>, needed int, prefix int"))
    rare = df.filter(F.col(text).rlike(_whole(sorted({w for w, _ in index}))))
    cut = rare.select(*key, words(F.col(text)).alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((F.size("w") - BLOCK) / STEP)).cast("int"))
    # One block after another as arrays: only blocks that hold a prefix word are opened.
    rare_words = F.array(*[F.lit(w) for w in sorted({w for w, _ in index})])
    blocks = cut.select(*key, F.explode(F.filter(F.transform(starts, lambda b: F.struct(b.alias("block"), F.slice("w", b * STEP + 1, BLOCK).alias("words"))),
                                                 lambda b: F.arrays_overlap(b["words"], rare_words))).alias("b")).select(*key, "b.block", "b.words")
    hits = blocks.withColumn("word", F.explode(F.array_intersect("words", rare_words))).join(prefixes, "word")
    counted = hits.groupBy(*key, "block", "template", "words").agg(F.count(F.lit(1)).alias("held"))
    shaped = counted.withColumnRenamed("words", "block_words").withColumn("own", F.array_distinct("block_words")).join(table, "template")
    long_enough = F.size("own") >= F.col("needed")
    reachable = F.col("held") + F.size("words") - F.col("prefix") >= F.col("needed")
    shared = F.size(F.array_intersect("own", "words"))
    found = shaped.filter(long_enough & reachable).withColumn("shared", shared).filter(F.col("shared") >= F.col("needed"))
    if every:
        return _unexplained(found, key)
    sets = [(t, set(own)) for t, _, own, _, _ in shapes]
    rivals = F.array(*[F.lit(f"{a}<{b}") for a, x in sets for b, y in sets if a != b and len(x & y) >= RIVAL * min(len(x), len(y))])
    match = F.struct("template", "label", (F.col("shared") / F.size("words")).alias("containment"), F.size("words").alias("size"))
    per_block = found.groupBy(*key, "block").agg(F.collect_set(match).alias("all"))

    def beaten(m):
        return F.exists("all", lambda o: F.array_contains(rivals, F.concat_ws("<", m["template"].cast("string"), o["template"].cast("string")))
                        & ((o["containment"] > m["containment"]) | ((o["containment"] == m["containment"]) & (o["size"] > m["size"]))))
    best = F.filter("all", lambda m: ~beaten(m))
    return per_block.select(*key, "block", F.explode(best).alias("m")).select(*key, "block", "m.label", "m.containment")


def _unexplained(found: DataFrame, key: list[str]) -> DataFrame:
    """key, block, label, containment of verified matches, but for those that better matches of their block explain."""
    match = F.struct("template", "label", (F.col("shared") / F.size("words")).alias("containment"), F.size("words").alias("size"), "needed", "words",
                     F.array_intersect("own", "words").alias("held"))
    per_block = found.groupBy(*key, "block").agg(F.collect_list(match).alias("all"), F.first("block_words").alias("block_words"))

    def times(word):
        return F.size(F.filter("block_words", lambda x: x == word))

    def explains(o, m):
        better = (o["containment"] > m["containment"]) | ((o["containment"] == m["containment"]) & (o["size"] > m["size"]))
        return better & (F.size(F.array_except(m["held"], o["words"])) == 0)

    def stands(o, m):
        # As often as the rarest of its words that the other lacks; without such a word it is the same place.
        return F.coalesce(F.array_min(F.transform(F.array_except(o["held"], m["words"]), times)), F.lit(BLOCK))

    def own_place(m):
        taken = F.aggregate(F.filter("all", lambda o: explains(o, m)), F.lit(0), lambda n, o: n + stands(o, m))
        return F.size(F.filter(m["held"], lambda w: times(w) > taken)) >= m["needed"]
    return per_block.select(*key, "block", F.explode(F.filter("all", own_place)).alias("m")).select(*key, "block", "m.label", "m.containment")


def scan(df: DataFrame, row: str = "doc_id", text: str = "text") -> DataFrame:
    """n_words, n_base, first_word, last_word, base_labels, labels, score for each row of ``df``, with its ``row`` column.

    The score is the best containment found, at least 0.5 where a phrase stands, else 0.
    """
    plain = df.select(F.col(row).alias("_id"), F.xxhash64(text).alias("_tie"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    phrases = [(p.split(" "), label) for p, label in PHRASES.items()]
    may = F.col("_text").rlike(_whole([ANY_GAP.join(p) for p, _ in phrases]))
    w = F.col("_words")
    cut = plain.select("_id", "_tie", F.regexp_count("_text", F.lit(ANY_WORD)).cast("long").alias("n_words"),
                       F.when(may, words(F.col("_text"))).otherwise(F.array().cast("array<string>")).alias("_words"))
    for k, (own, _) in enumerate(phrases):
        cut = cut.withColumn(f"_at{k}", places_of(w, own))
    places = F.concat(*[F.col(f"_at{k}") for k in range(len(phrases))])
    base = F.filter(F.array(*[F.when(F.size(f"_at{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(phrases)]), lambda x: x.isNotNull())
    counted = cut.select("_id", "_tie", "n_words", F.size(places).cast("long").alias("n_base"), F.array_min(places).cast("long").alias("first_word"),
                         F.array_max(places).cast("long").alias("last_word"), F.array_sort(F.array_distinct(base)).alias("_base"))
    found = matches(plain, ["_id", "_tie"], "_text", every=True).groupBy("_id", "_tie").agg(F.collect_set("label").alias("_labels"), F.max("containment").alias("_best"))
    found = found.toDF("_id2", "_tie2", "_labels", "_best")
    rows = counted.join(found, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_tie") == F.col("_tie2")), "left")
    labels = F.array_sort(F.array_union("_base", F.coalesce("_labels", F.array().cast("array<string>"))))
    score = F.greatest(F.coalesce("_best", F.lit(0.0)), F.when(F.col("n_base") > 0, 0.5).otherwise(0.0))
    return rows.select(F.col("_id").alias(row), "n_words", "n_base", "first_word", "last_word", F.array_join("_base", ",").alias("base_labels"),
                       F.array_join(labels, ",").alias("labels"), score.alias("score"))

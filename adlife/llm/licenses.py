"""License scan: exact set-similarity join of text blocks with notice templates.

A block is a window of ``WINDOW`` neighbouring lines (fewer at the end of a text), so a
notice is found however it is wrapped, as long as it does not run over more lines; windows
start at every line that holds a template word. A block holds a template when at
least ``threshold`` of the template's distinct words are in it. The join is exact:

1. words of the templates are ordered by how many lines of the whole corpus
   hold them, rarest first (one pass, summed per task; the result has one row
   per template word);
2. a block that reaches the threshold must hold one of the template's first
   ``n - need + 1`` words in that order (prefix filter), at least ``need``
   template words (length filter), and enough words behind the first common
   one in both orders (positional filter);
3. the remaining (block, template) pairs are verified.

Everything is built-in Spark expressions. The word index is a table of the
templates; it is broadcast up to ``BROADCAST_ROWS`` rows and joined by its words beyond. Blocks are
tested inside the row that holds the text; only blocks that pass
the prefix and length filters are kept, in a narrow written table.

Defined cases: a null text counts as empty; an empty text has no block; equal
rows give equal results, row by row; an empty table gives an empty result;
input columns never meet the helper names because only the key and text are
read and they are renamed first.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlife.llm.common import materialized

# FIXED VALUES: phrases whose places are always reported, with their labels.
BASE_PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# FIXED VALUES: opening or naming sentences of public license notices.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "You may not use this file except in compliance with the License."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights to this work"),
)

THRESHOLD = 0.9
#: Lines of a block: the longest template takes two lines of 78 columns, or four of 40.
WINDOW = 4
BROADCAST_ROWS = 10_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words once A-Z are lower-cased.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def spaced(low: Column) -> Column:
    """The words of a lower-cased text, joined by single blanks."""
    return F.trim(F.regexp_replace(low, GAP, " "))


def word_set(text: str) -> list[str]:
    return sorted(set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())))


def need(size: int, threshold: float) -> int:
    return max(1, math.ceil(size * threshold - 1e-9))


def lines(low: Column) -> Column:
    return F.split(low, "\n")


def held_by_line(low: Column, order: Sequence[str]) -> Column:
    """array<array<string>>: the template words of each line, in the global order."""
    return F.transform(lines(low), lambda x: F.array_intersect(_literals(order), F.split(spaced(x), " ")))


def _literals(items: Sequence[str]) -> Column:
    return F.array(*[F.lit(x) for x in items]) if items else F.array().cast("array<string>")


def word_order(texts: DataFrame, vocabulary: Sequence[str]) -> list[str]:
    """``vocabulary`` by the number of lines of the corpus that hold each word, rarest first."""
    held = texts.select(F.explode(lines(F.col("low"))).alias("b")).select(
        F.explode(F.array_intersect(_literals(vocabulary), F.split(spaced(F.col("b")), " "))).alias("word"))
    count = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (count.get(w, 0), w))


def plan_templates(order: Sequence[str], templates: Sequence[tuple[str, str]], threshold: float) -> list[dict]:
    """Per template its words in the global order, how many are needed, and its prefix length."""
    rank = {w: i for i, w in enumerate(order)}
    out = []
    for k, (label, text) in enumerate(templates):
        tokens = sorted(word_set(text), key=rank.__getitem__)
        n = need(len(tokens), threshold)
        out.append({"template": k, "label": label, "tokens": tokens, "need": n, "prefix": len(tokens) - n + 1})
    return out


def candidate_blocks(held: Column, order: Sequence[str], plans: Sequence[dict]) -> Column:
    """array<struct(block_no, held)> of the blocks that pass the prefix and the length filter, from the column of
    :func:`held_by_line`; ``block_no``: the first line, ``held``: the template words, in the global order."""
    prefixes = sorted({w for p in plans for w in p["tokens"][:p["prefix"]]})
    least = min(p["need"] for p in plans)
    none = F.array().cast("array<string>")
    every = F.transform(held, lambda h, i: F.struct(i.cast("long").alias("block_no"), F.when(
        F.size(h) > 0, F.array_distinct(F.concat(h, *[F.coalesce(F.get(held, i + k), none) for k in range(1, WINDOW)])))
        .otherwise(none).alias("held")))
    some = F.filter(every, lambda x: (F.size(x["held"]) >= least) & F.arrays_overlap(x["held"], _literals(prefixes)))
    return F.transform(some, lambda x: F.struct(x["block_no"].alias("block_no"),
                                                F.array_intersect(_literals(order), x["held"]).alias("held")))


def join_templates(found: DataFrame, plans: Sequence[dict], key: str) -> DataFrame:
    """(key, block_no, template, label, containment) of verified pairs, from (key, blocks)."""
    spark = found.sparkSession
    rows = [(w, i, p["template"], p["label"], p["tokens"], p["need"])
            for p in plans for i, w in enumerate(p["tokens"][:p["prefix"]])]
    index = spark.createDataFrame(rows, "word string, at int, template int, label string, tokens array<string>, need int")
    probe = found.select(key, F.explode("blocks").alias("b")).select(
        key, "b.block_no", "b.held", F.posexplode("b.held").alias("q", "word"))
    # one probe word per (block, template): the first common one
    pairs = probe.join(F.broadcast(index) if len(rows) <= BROADCAST_ROWS else index, "word").where(
        F.size(F.array_intersect(F.slice("tokens", 1, F.col("at")), F.col("held"))) == 0)
    size, behind = F.size("tokens"), F.size("held") - F.col("q") - 1
    pairs = pairs.where((F.size("held") >= F.col("need"))
                        & (1 + F.least(size - F.col("at") - 1, behind) >= F.col("need")))
    overlap = F.size(F.array_intersect("tokens", "held"))
    return (pairs.withColumn("overlap", overlap).where(F.col("overlap") >= F.col("need"))
            .select(key, "block_no", "template", "label", (F.col("overlap") / size).alias("containment")))


def phrase_places(joined: Column, phrases: Sequence[tuple[str, str]]) -> Column:
    """array<struct(label, at)>: every place of every phrase in blank-joined words (0-based word index)."""
    parts = []
    for phrase, label in phrases:
        first, *rest = phrase.split(" ")

        def at(words: Column, first=first, rest=rest, label=label) -> Column:
            def hit(w, i):
                ok = w == first
                for k, r in enumerate(rest, 1):
                    ok = ok & (F.get(words, i + k) == r)
                return F.when(ok, F.struct(F.lit(label).alias("label"), i.cast("long").alias("at")))
            return F.filter(F.transform(words, hit), lambda x: x.isNotNull())

        inside = F.contains(F.concat(F.lit(" "), joined, F.lit(" ")), F.lit(f" {phrase} "))
        none = F.array().cast("array<struct<label:string,at:bigint>>")
        parts.append(F.when(inside, at(F.split(joined, " "))).otherwise(none))
    return F.concat(*parts)


def scan_table(docs: DataFrame, key: str, templates: Sequence[tuple[str, str]] = TEMPLATES,
               threshold: float = THRESHOLD, text_col: str = "text") -> tuple[DataFrame, list[dict]]:
    """A written narrow table (row_id, key, n_words, places, blocks), and the template plans."""
    texts = docs.select(F.col(f"`{key}`").alias("key"), lowered(F.col(f"`{text_col}`")).alias("low"))
    vocabulary = sorted({w for _, t in templates for w in word_set(t)})
    order = word_order(texts, vocabulary)
    plans = plan_templates(order, templates, threshold)
    joined = texts.select("key", spaced(F.col("low")).alias("joined"), held_by_line(F.col("low"), order).alias("held"))
    n_words = F.when(F.col("joined") == "", 0).otherwise(
        F.length("joined") - F.length(F.replace("joined", F.lit(" "), F.lit(""))) + 1)
    narrow = joined.select(F.monotonically_increasing_id().alias("row_id"), "key", n_words.cast("long").alias("n_words"),
                           phrase_places(F.col("joined"), BASE_PHRASES).alias("places"),
                           candidate_blocks(F.col("held"), order, plans).alias("blocks"))
    return materialized(narrow, "license-blocks"), plans


def license_blocks(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """(key, block_no, template, label, containment): every block of every text that holds a template."""
    found, plans = scan_table(docs, key, **options)
    return join_templates(found, plans, "row_id").join(found.select("row_id", "key"), "row_id").select(
        F.col("key").alias(key), "block_no", "template", "label", "containment")


def license_scan_query(docs: DataFrame) -> DataFrame:
    found, plans = scan_table(docs, "doc_id")
    per_row = (join_templates(found, plans, "row_id").groupBy("row_id")
               .agg(F.collect_set("label").alias("found"), F.max("containment").alias("best")))
    labels = F.transform("places", lambda x: x["label"])
    starts = F.transform("places", lambda x: x["at"])
    text = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return found.drop("blocks").join(per_row, "row_id", "left").select(
        F.col("key").alias("doc_id"), "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        text(labels).alias("base_labels"),
        text(F.concat(labels, F.coalesce("found", F.array().cast("array<string>")))).alias("labels"),
        F.coalesce("best", F.lit(0.0)).alias("score"))

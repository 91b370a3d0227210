"""License scan: an exact set-similarity join of text blocks with templates,
in DataFrame functions only.

A block is a line of at most ``BLOCK_WORDS`` words, or a run of words of about a
template's length (``SLACK`` more) wherever it lies in a paragraph, across line
breaks or inside a longer line; it is taken as the set of its words. A template
is a known license sentence, taken the same way. A block meets a template when it
contains at least ``threshold`` of the template's words. Only texts that hold so
many words of some template at all are looked into. Lines, and for runs the
stretches of two runs that overlap by one, go through the prefix-filter join:

* words outside every template cannot add to an overlap and are dropped (the
  vocabulary of the templates is bounded by the template list);
* the remaining words are ordered by how many blocks of the corpus hold them,
  rarest first. With ``need`` = the overlap a template asks for, a qualifying
  pair shares a word among the first ``|block| - need + 1`` of the block and the
  first ``|template| - need + 1`` of the template (prefix filter);
* the block must hold ``need`` words at all (length filter), and the words left
  after the meeting positions must still allow ``need`` (positional filter);
* survivors are verified on the full sets, stretches on their runs.

Besides, exact phrases are located (``phrase_places``).

Defined cases: null and empty texts have no words, places or labels and score
0; ties of frequency are ordered by the word; repeated rows are scanned each;
very long texts are scanned whole, in stretches; columns other than the id and
the text are not read; empty tables give no rows; an empty template list finds
phrases only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aidspark.llm.common import documents, lower_ascii, materialize

# Fixed by the task: words and the phrases with their labels.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_NO_WORD_IN_LINE = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: License sentences as commonly written, with the label each stands for.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "you may not use this file except in compliance with the License"),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are "
            "permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                     "International License"),
]
THRESHOLD = 0.9
#: A longer line is no block as a whole.
BLOCK_WORDS = 64
#: Words that a run may have besides as many as the template.
SLACK = 4
#: Templates are literals of the plan; a longer list belongs in several calls.
MAX_TEMPLATE_WORDS = 5000


def joined_words(text: Column) -> Column:
    """The words of a text with one blank between them."""
    return F.trim(F.regexp_replace(text, _NO_WORD, " "))


def word_count(joined: Column) -> Column:
    return F.when(joined == "", F.lit(0)).otherwise(
        F.length(joined) - F.length(F.translate(joined, " ", "")) + 1)


def phrase_places(joined: Column, phrase: str) -> Column:
    """Starts (words from 0) of a phrase in words joined by blanks. The words
    are only told apart in the few texts that hold the phrase."""
    parts = phrase.split()

    def starts(words):
        def here(i):
            out = F.get(words, i) == parts[0]
            for k, w in enumerate(parts[1:], 1):
                out = out & (F.get(words, i + k) == w)
            return out
        return F.filter(F.sequence(F.lit(0), F.size(words) - len(parts)), here)

    found = F.transform(F.array(F.split(joined, " ")), starts)[0]  # names the words once: they are split once
    return (F.when(F.contains(F.concat(F.lit(" "), joined, F.lit(" ")), F.lit(f" {phrase} ")), found)
            .otherwise(F.array().cast("array<int>")))


def _template_words(templates):
    import re
    rx = re.compile(WORD)
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return [(label, rx.findall(text.translate(low))) for label, text in templates]


def _template_sets(templates):
    return [(label, sorted(set(words))) for label, words in _template_words(templates)]


def _needed(words, threshold: float) -> int:
    return max(1, math.ceil(threshold * len(set(words)) - 1e-9))


def _literal(words) -> Column:
    return F.array(*map(F.lit, sorted(set(words))))


def candidates(src: DataFrame, templates, threshold: float) -> DataFrame:
    """Rows of ``src`` whose text (``low``) holds the words that some template needs."""
    known = [w for _, w in _template_words(templates) if w]
    if not known:
        return src.limit(0)
    held = F.array_intersect(F.split(F.regexp_replace("low", _NO_WORD, " "), " "), _literal([w for k in known for w in k]))

    def enough(h):
        out = F.lit(False)
        for k in known:
            out = out | (F.size(F.array_intersect(h, _literal(k))) >= _needed(k, threshold))
        return out

    return src.filter(F.exists(F.array(held), enough))  # names the words held once


def blocks_of(src: DataFrame, templates) -> DataFrame:
    """``block`` (row, part, at), ``words``, ``whole``: the lines of the texts (``low``)
    as blocks of their own, and stretches of paragraphs that hold every run of
    about a template's length, as each begins a run's length after the one before
    and is twice as long."""
    run = max([len(w) for _, w in _template_words(templates)] or [1]) + SLACK
    plain = F.regexp_replace("low", _NO_WORD_IN_LINE, " ")
    lines = (src.select("row", F.posexplode(F.split(plain, "\n")).alias("part", "text"))
             .select(F.struct("row", "part", F.lit(-1).alias("at")).alias("block"), F.split(F.trim("text"), " ").alias("words"))
             .filter(F.size("words") <= BLOCK_WORDS).withColumn("whole", F.lit(True)))
    paragraphs = (src.select("row", F.posexplode(F.split(plain, r"\n ?(?:\n ?)+")).alias("part", "text"))
                  .select("row", "part", F.split(F.trim(F.regexp_replace("text", "[ \n]+", " ")), " ").alias("all")))
    stretches = (paragraphs.select("row", "part", "all", F.explode(F.sequence(
        F.lit(0), F.greatest(F.lit(0), F.ceil(F.size("all") / run).cast("int") - 2))).alias("at"))
        .select(F.struct("row", "part", "at").alias("block"), F.slice("all", F.col("at") * run + 1, F.lit(2 * run)).alias("words"))
        .withColumn("whole", F.lit(False)))
    return lines.unionByName(stretches)


def run_overlap(words: Column, template_words: Column, run: Column) -> Column:
    """The most words of a template that a run of so many of ``words`` holds. A run
    that holds most of them can begin at one of them, so only these are tried."""
    begins = F.filter(F.sequence(F.lit(1), F.size(words)), lambda i: F.array_contains(template_words, F.get(words, i - 1)))
    return F.array_max(F.transform(begins, lambda i: F.size(F.array_intersect(F.slice(words, i, run), template_words))))


def template_join(blocks: DataFrame, templates=None, threshold: float = THRESHOLD) -> DataFrame:
    """Blocks (``block`` id, ``words``) x templates they contain:
    ``block, template`` (place in the list), ``label, overlap, needed, template_words``.
    A block that is not ``whole`` (default: all are) must hold its share within a
    run of the template's length and ``SLACK``."""
    given = _template_words(templates if templates is not None else TEMPLATES)
    sets = [(label, sorted(set(words)), len(words)) for label, words in given if words]
    if sum(len(s) for _, s, _ in sets) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates hold more than {MAX_TEMPLATE_WORDS} words; scan in several calls")
    spark = blocks.sparkSession
    schema = ("template int, label string, needed int, template_words int, trank array<int>, twords array<string>, run int")
    if not sets:
        return (blocks.select("block").limit(0)
                .select("block", F.lit(0).alias("template"), F.lit("").alias("label"),
                        F.lit(0).alias("overlap"), F.lit(0).alias("needed"), F.lit(0).alias("template_words")))
    vocabulary = sorted({w for _, s, _ in sets for w in s})
    need = [_needed(s, threshold) for _, s, _ in sets]
    lowest = min(need)
    vocab_lit = F.array(*map(F.lit, vocabulary))
    whole = F.col("whole") if "whole" in blocks.columns else F.lit(True)
    # length filter against the least demanding template
    held = materialize(blocks.select("block", F.array_intersect("words", vocab_lit).alias("held"), whole.alias("whole"),
                                     F.when(~whole, F.col("words")).alias("words"))
                       .filter(F.size("held") >= lowest), "blocks")
    # global frequency order over the template vocabulary (at most that many rows)
    counted = {r["w"]: r["n"] for r in held.select(F.explode("held").alias("w")).groupBy("w")
               .agg(F.count("*").alias("n")).collect()}
    order = sorted(vocabulary, key=lambda w: (counted.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    ranks = F.array_sort(F.transform("held", lambda w: F.array_position(F.array(*map(F.lit, order)), w).cast("int") - 1))
    probe = (held.withColumn("brank", ranks)
             .select("block", "brank", "whole", "words",
                     F.posexplode(F.slice("brank", 1, F.size("brank") - lowest + 1)).alias("bpos", "rank")))
    index = spark.createDataFrame(
        [(i, label, need[i], len(s), sorted(rank[w] for w in s), s, n + SLACK) for i, (label, s, n) in enumerate(sets)], schema)
    prefix = (index.select("*", F.posexplode(F.slice("trank", F.lit(1), F.col("template_words") - F.col("needed") + 1))
                           .alias("tpos", "rank")))
    size = F.size("brank")
    met = (probe.join(F.broadcast(prefix), "rank")  # bounded by MAX_TEMPLATE_WORDS
           .filter((size >= F.col("needed"))
                   & (F.col("bpos") <= size - F.col("needed"))
                   # words shared before the meeting word can be at most min(bpos, tpos)
                   & (F.least("bpos", "tpos") + F.least(size - F.col("bpos"), F.col("template_words") - F.col("tpos"))
                      >= F.col("needed")))
           # the first of the words that the two share: so each pair is verified once
           .filter(F.array_intersect("brank", "trank")[0] == F.col("rank"))
           .withColumn("overlap", F.size(F.array_intersect("brank", "trank"))).filter(F.col("overlap") >= F.col("needed"))
           .withColumn("overlap", F.when(F.col("whole"), F.col("overlap")).otherwise(
               run_overlap(F.col("words"), F.col("twords"), F.col("run"))))
           .filter(F.col("overlap") >= F.col("needed")))
    return met.select("block", "template", "label", "overlap", "needed", "template_words")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=None,
         threshold: float = THRESHOLD, phrases: dict | None = None) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, places`` (starts of the
    phrases), ``base_labels`` and ``method_labels`` (arrays),
    ``score``: 1 with a phrase, else the highest contained share of a template
    that was met, else 0."""
    phrases = PHRASES if phrases is None else phrases
    src = (documents(docs, id_col, text_col)
           .select("doc_id", lower_ascii(F.col("text")).alias("low"))
           .withColumn("row", F.struct(F.col("doc_id"), F.xxhash64("low").alias("h"))))
    templates = TEMPLATES if templates is None else templates
    asked = materialize(candidates(src, templates, threshold).select("row", "low"), "license-candidates")
    met = template_join(blocks_of(asked, templates), templates, threshold).select(
        F.col("block.row").alias("row"), "label", (F.col("overlap") / F.col("template_words")).alias("share"))
    hits = (met.select(F.col("row.doc_id").alias("hid"), F.col("row.h").alias("hh"), "label", "share")
            .groupBy("hid", "hh").agg(F.collect_set("label").alias("method_labels"), F.max("share").alias("share")))
    found = src.select("doc_id", F.col("row.h").alias("h"), joined_words(F.col("low")).alias("joined"))
    out = found.select(
        "doc_id", "h", word_count(F.col("joined")).cast("long").alias("n_words"),
        *[phrase_places(F.col("joined"), p).alias(f"p{i}") for i, p in enumerate(phrases)])
    cols = [F.col(f"p{i}") for i in range(len(phrases))]
    places = F.array_sort(F.flatten(F.array(*cols))) if cols else F.array().cast("array<int>")
    labels = F.array(*[F.when(F.size(c) > 0, F.lit(label)) for c, label in zip(cols, phrases.values())]) \
        if cols else F.array().cast("array<string>")
    out = out.select("doc_id", "h", "n_words", places.alias("places"),
                     F.array_sort(F.array_distinct(F.array_compact(labels))).alias("base_labels"))
    return (out.join(hits, out["doc_id"].eqNullSafe(hits["hid"]) & (out["h"] == hits["hh"]), "left")
            .select("doc_id", "n_words", "places", "base_labels",
                    F.coalesce("method_labels", F.array().cast("array<string>")).alias("method_labels"),
                    F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score")))

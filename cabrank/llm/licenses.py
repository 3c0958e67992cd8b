r"""Licence notices by Dice coefficients over word bigrams.

A text is scanned as a whole, by lines and by sentences. Each of these units is normalised
(lower case; everything but letters a-z and digits separates words) and becomes its set
of word bigrams. The Dice coefficient of sets of sizes m and n is at most
2 * min(m, n) / (m + n), so a template can only match units whose size lies between
n * t / (2 - t) and n * (2 - t) / t. These permitted sizes are listed per template, and an
equi-join on the size yields the few templates each unit is compared with.

A unit that reaches the threshold shares at least n * t / (2 - t) bigrams with the template, so it
holds one of any other n - n * t / (2 - t) + 1 of them. The ones with the longest words are the template's marks, and only texts that
hold the longer word of a mark, or both its words next to each other if they are short, are cut into units at all.

Notices wrapped over lines or of several sentences are found in runs of pieces, which are lines and the sentences
of lines. A text that holds a mark of a template, and enough of its bigrams, is searched for it: a run
starts at every piece that shares something with the template and grows piece by piece, within a line and across
lines, until it has more distinct bigrams than the largest permitted size. Nothing else ends a run. A licence found in no
unit of a doc_id, but in its runs, is reported with the best of them, as one unit.

All of it is DataFrame functions; units and runs are not shuffled, only matches are (with more than LISTED marks, the texts with marks too). Null texts count
as empty. Texts with fewer than two words match nothing. Very long texts are held in one row, with their bigrams.
Templates with the same name are alternatives; null or one-word templates are ignored. A null doc_id is reported like any
other, and repeated doc_ids are reported together. Empty tables give an empty result;
further columns are left alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from cabrank.llm.common import saved, text_of

THRESHOLD = 0.8
#: Templates and their sizes are broadcast up to this number of sizes, which is counted before.
BROADCAST_SIZES = 200_000
#: Marks are listed in the plan up to this number; with more of them, every text is cut.
LISTED = 10_000
#: Marks without a word of so many letters are looked for as a whole, as their words are too common.
LONG_WORD = 4

# Short notices and opening paragraphs of public licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
)


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES), "license string, template string")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, though ``use`` mentions it several times."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def bigrams(text: Column) -> Column:
    """The distinct pairs of neighbouring words of a text."""
    return bound(words(text), neighbours)


def units(text: Column) -> Column:
    """The text, its lines if there are several, and the sentences of lines with several, each once."""

    def cut(lines: Column) -> Column:
        sentences = F.flatten(F.transform(lines, lambda line: F.split(line, r"(?<=[.!?])[ \t]+")))
        return F.array_distinct(F.concat(F.array(text), lines, sentences))

    return bound(F.split(text, "\n"), cut)


def permitted(known: DataFrame, threshold: float) -> DataFrame:
    """license, pairs of the templates, once for every size of a unit that may reach the threshold."""
    n = F.size("pairs")
    low = F.ceil(n * threshold / (2 - threshold) - 1e-9).cast("int")
    high = F.floor(n * (2 - threshold) / threshold + 1e-9).cast("int")
    return known.select("license", "pairs", F.explode(F.sequence(F.greatest(low, F.lit(1)), high)).alias("size"))


def least_shared(threshold: float) -> Column:
    """The bigrams a unit that reaches the threshold shares with a template at least."""
    return F.ceil(F.size("pairs") * threshold / (2 - threshold) - 1e-9).cast("int")


def marks_of(known: DataFrame, threshold: float) -> DataFrame:
    """template, pair, word: bigrams of which every match has one, and the longer word of each."""
    longest = lambda p: F.array_max(F.transform(F.split(p, " "), lambda w: F.struct(F.length(w).alias("n"), w.alias("word"))))
    ranked = F.sort_array(F.transform("pairs", lambda p: F.struct(longest(p).alias("longest"), p.alias("pair"))), asc=False)
    marks = F.slice(ranked, F.lit(1), F.size("pairs") - least_shared(threshold) + 1)
    return known.select("template", F.explode(marks).alias("mark")).select("template", "mark.pair", F.col("mark.longest.word").alias("word"))


def may_hold(text: Column, marks: list[Row]) -> Column:
    """Whether a text holds the longer word of a mark, or a whole mark of short words."""
    rare = sorted({m.word for m in marks if len(m.word) >= LONG_WORD})
    short = sorted({m.pair for m in marks if len(m.word) < LONG_WORD})
    holds = F.lit(False)
    if rare:
        holds = holds | F.arrays_overlap(F.split(F.lower(text), "[^a-z0-9]+"), F.array(*map(F.lit, rare)))
    if short:
        anyone = "|".join(pair.replace(" ", "[^a-z0-9]+") for pair in short)
        holds = holds | F.lower(text).rlike(f"(?<![a-z0-9])(?:{anyone})(?![a-z0-9])")
    return holds


def scan(documents: DataFrame, known: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per doc_id and licence found: doc_id, license, dice (the best) and n_units (how many units match)."""
    known = templates(documents.sparkSession) if known is None else known
    known = known.where("license IS NOT NULL AND template IS NOT NULL")
    known = known.select("license", bigrams(F.col("template")).alias("pairs")).where(F.size("pairs") > 0)
    known = saved(known.withColumn("template", F.monotonically_increasing_id()))
    sizes = saved(permitted(known, threshold))
    n, lowest, highest = sizes.agg(F.count("*"), F.min("size"), F.max("size")).first()
    marks = saved(marks_of(known, threshold))
    texts = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_of().alias("text"))
    listed = marks.limit(LISTED + 1).collect()
    if len(listed) <= LISTED:
        texts = texts.where(may_hold(F.col("text"), listed))
    texts = saved(texts)
    # One expression up to the explode: later conditions would otherwise compute the bigrams again.
    own = F.filter(
        F.transform(units(F.col("text")), bigrams), lambda p: (F.size(p) >= (lowest or 1)) & (F.size(p) <= (highest or 0))
    )
    paired = texts.select("doc_id", F.explode_outer(own).alias("own"))
    found = matches(paired, sizes, n, threshold).groupBy("doc_id", "license").agg(F.max("dice").alias("dice"), F.count("*").alias("n_units"))
    if not n:
        return found
    found = saved(found)
    over = runs(texts, F.broadcast(known) if n <= BROADCAST_SIZES else known, marks, listed, threshold)
    same = F.col("o.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("o.license") == F.col("f.license"))
    more = over.alias("o").join(found.alias("f"), same, "left_anti").select("doc_id", "license", "dice", F.lit(1).cast("long").alias("n_units"))
    return found.unionByName(more)


def matches(paired: DataFrame, sizes: DataFrame, n: int, threshold: float) -> DataFrame:
    """doc_id, license, dice for every unit and template that reach the threshold."""
    small = F.broadcast(sizes) if n <= BROADCAST_SIZES else sizes
    both = F.size(F.array_intersect("own", "pairs"))
    return (
        paired.join(small, F.size("own") == F.col("size"))
        .select("doc_id", "license", (2 * both / (F.size("own") + F.size("pairs"))).alias("dice"))
        .where(F.col("dice") >= threshold)
    )


def in_order(w: Column) -> Column:
    """The pairs of a list of words, in order."""
    joined = F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(F.size(w) > 1, joined).otherwise(F.array().cast("array<string>"))


def neighbours(w: Column) -> Column:
    """The distinct pairs of a list of words."""
    return F.array_distinct(in_order(w))


def best_run(threshold: float) -> Column:
    """The best Dice coefficient of a run of pieces with the template ``pairs``.

    ``every`` has the bigrams of the text in order, ``ends`` the number of words up to each piece, from 0 on.
    The bigram over the end of a piece belongs to a run that goes on after it.
    """
    n = F.size("pairs")
    highest = F.floor(n * (2 - threshold) / threshold + 1e-9)
    words_to = lambda piece: F.element_at("ends", piece.cast("int") + 1)

    def span(piece: Column, start: Column) -> Column:
        """The bigrams that come to a run that started at ``start`` when it takes ``piece``."""
        first = F.when(piece == start, words_to(piece - 1) + 1).otherwise(words_to(piece - 1))
        return F.slice("every", first, words_to(piece) - first)

    def grown(start: Column) -> Column:
        empty = F.struct(F.slice("every", 1, 0).alias("own"), F.lit(0.0).alias("best"), F.lit(False).alias("over"))

        def take(run: Column, piece: Column) -> Column:
            def compared(own: Column) -> Column:
                dice = 2 * F.size(F.array_intersect(own, "pairs")) / (F.size(own) + n)
                over = F.size(own) > highest
                kept = F.when(over, F.slice("every", 1, 0)).otherwise(own)
                return F.struct(kept.alias("own"), F.greatest(run["best"], F.when(~over, dice).otherwise(0.0)).alias("best"), over.alias("over"))

            return F.when(run["over"], run).otherwise(bound(F.array_union(run["own"], span(piece, start)), compared))

        return F.aggregate(F.sequence(start, F.size("ends") - 1), empty, take, lambda run: run["best"])

    touching = lambda piece: F.arrays_overlap(F.slice("every", words_to(piece - 1) + 1, words_to(piece) - words_to(piece - 1)), "pairs")
    starts = F.filter(F.sequence(F.lit(1), F.size("ends") - 1), touching)
    return F.array_max(F.transform(starts, grown))


def runs(texts: DataFrame, known: DataFrame, marks: DataFrame, listed: list[Row], threshold: float) -> DataFrame:
    """doc_id, license, dice of the best run of pieces that reaches the threshold, for the texts (row, doc_id, text)."""

    def pieces(line: Column) -> Column:
        return F.filter(F.transform(F.split(line, r"(?<=[.!?])[ \t]+"), words), lambda w: F.size(w) > 0)

    def cut(lists: Column) -> Column:
        ends = F.aggregate(lists, F.array(F.lit(0)), lambda done, w: F.concat(done, F.array(F.element_at(done, -1) + F.size(w))))
        return F.struct(bound(F.flatten(lists), in_order).alias("every"), ends.alias("ends"))

    # One expression, so that no text is cut twice; kept, so that later ones do not cut it again.
    own = texts.select("row", "doc_id", bound(F.flatten(F.transform(F.split("text", "\n"), pieces)), cut).alias("cut"))
    own = own.select("row", "doc_id", "cut.every", "cut.ends").where(F.size("ends") > 2)
    if len(listed) <= LISTED:
        of_pair: dict[str, list[int]] = {}
        for mark in listed:
            of_pair.setdefault(mark.pair, []).append(mark.template)
        held = F.array(*map(F.lit, of_pair))
        named = F.map_from_arrays(held, F.array(*[F.array(*map(F.lit, t)) for t in of_pair.values()]))
        hits = F.transform(F.array_intersect("every", held), lambda pair: F.element_at(named, pair))
        own = saved(own.withColumn("templates", F.array_distinct(F.flatten(hits))).where(F.size("templates") > 0))
        asked = own.select("doc_id", "every", "ends", F.explode("templates").alias("template"))
    else:
        own = saved(own)
        pairs = own.select("row", F.explode(F.array_distinct("every")).alias("pair"))
        asked = own.join(pairs.join(marks, "pair").select("row", "template").distinct(), "row")
    both = asked.join(known, "template").where(F.size(F.array_intersect("every", "pairs")) >= least_shared(threshold))
    best = saved(both.select("doc_id", "license", best_run(threshold).alias("dice")))
    return best.where(F.col("dice") >= threshold).groupBy("doc_id", "license").agg(F.max("dice").alias("dice"))

"""License scans with DataFrame functions only.

A template is the set of its runs of three words.  Templates of similar length share a window length; windows overlap so that
every place where a template can stand lies whole in one window.  MinHash bands of one hash retrieve templates for a window:
their number comes from the lowest Jaccard similarity that a window with a match can have, so that a match is missed with
probability `miss` or less.  A retrieved pair counts if the window holds at least `least` of the template's runs exactly.

Only documents and windows that hold a word of every template's anchor words are cut: a template's anchors are the fewest words
without which less than `least` of its runs are left, so a text without them can't match.  That is derived from the templates,
drops no match, and keeps the scan to one pattern for most of a corpus.

Null and empty texts match nothing; rows of one identifier are reported as one; an empty table gives no rows;
other columns are ignored; texts are read whole.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gleaner.llm.common import pinned

RUN = 3
LEAST = 0.8
MISS = 1e-4
#: (license, text) of common notices, and of a passage each from license bodies that hold no notice; a parameter of scan().
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
            " files, to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
            " License as published by the Free Software Foundation"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
            " following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General"
             " Public License as published by the Free Software Foundation"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General"
             " Public License as published by the Free Software Foundation"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
            " provided that the above copyright notice and this permission notice appear in all copies"),
    ("ISC", "Released under the ISC License."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "Released under the Unlicense."),
    ("Apache-2.0", "each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable"
                   " copyright license to reproduce, prepare Derivative Works of"),
    ("GPL-3.0", "The GNU General Public License is a free, copyleft license for software and other kinds of works."),
    ("AGPL-3.0", "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works"),
    ("LGPL-3.0", "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU"
                 " General Public License"),
    ("CC0-1.0", "The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related Rights"
                " (defined below) upon the creator and subsequent owner(s)"),
    ("CC-BY-4.0", "to be bound by the terms and conditions of this Creative Commons Attribution 4.0 International Public License"),
    ("MPL-2.0", "means Source Code Form to which the initial Contributor has attached the notice in Exhibit A"),
]


def words_of(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def runs_of(words: list[str]) -> list[tuple[str, ...]]:
    return list(dict.fromkeys(tuple(words[i:i + RUN]) for i in range(max(1, len(words) - RUN + 1))))


def anchors(templates: list[tuple[str, str]], least: float) -> list[str]:
    """Words of which every match of every template holds at least one: rare ones among the templates' own words first."""
    found: set[str] = set()
    for _, text in templates:
        runs = runs_of(words_of(text))
        free = [r for r in runs if not found & set(r)]
        while len(free) >= least * len(runs):
            best = max({w for r in free for w in r}, key=lambda w: (len(w) > 5, sum(w in r for r in free), len(w), w))
            found.add(best)
            free = [r for r in free if best not in r]
    return sorted(found)


def plan(templates: list[tuple[str, str]], least: float, miss: float) -> list[tuple[int, int, int, list[int]]]:
    """(window words, stride, bands, template numbers) by class of template length, a quarter apart."""
    classes: dict[int, list[int]] = {}
    for i, (_, text) in enumerate(templates):
        n = len(words_of(text))
        classes.setdefault(int(math.ceil(math.log(max(n, RUN), 1.25))), []).append(i)
    out = []
    for members in classes.values():
        longest = max(len(words_of(templates[i][1])) for i in members)
        stride = max(1, longest // 4)
        window = longest + stride - 1
        runs = min(len(runs_of(words_of(templates[i][1]))) for i in members)
        lowest = least * runs / (window - RUN + 1 + (1 - least) * runs)
        out.append((window, stride, max(1, math.ceil(math.log(miss) / math.log(1 - lowest))), members))
    return out


def _runs(words: Column) -> Column:
    """Hashes of a word array's runs, in order."""
    last = F.greatest(F.size(words) - RUN, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(RUN)]))


def _bands(runs: Column, bands: int) -> Column:
    """Minimum of every seeded hash of the runs, with the band's number."""
    def lowest(band: int) -> Column:
        return F.array_min(F.transform(runs, lambda r: F.xxhash64(r, F.lit(band))))

    return F.array(*[F.struct(F.lit(b).alias("band"), lowest(b).alias("low")) for b in range(bands)])


def _split(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def template_table(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    rows = [(i, name, text) for i, (name, text) in enumerate(templates)]
    table = spark.createDataFrame(rows, "template int, license string, body string")
    return table.select("template", "license", F.array_distinct(_runs(_split(F.col("body")))).alias("own"))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, least: float = LEAST, miss: float = MISS) -> DataFrame:
    """doc_id, license, template, containment, n_windows, first_word of every template found in a document.

    Of templates of a class found within half a window of each other only those held best count.  containment is that of the best window, n_windows counts the windows that match, first_word is the first one's place.
    """
    spark = docs.sparkSession
    known = template_table(spark, templates)
    text = F.coalesce(F.col("text"), F.lit(""))
    anchor = "(?i)(?<![a-z0-9])(?:" + "|".join(anchors(templates, least)) + ")(?![a-z0-9])"
    rows = docs.filter(text.rlike(anchor)).select(F.col("doc_id").cast("long").alias("doc_id"), _split(text).alias("words"))
    rows = rows.filter(F.size("words") > 0).withColumn("held", F.arrays_overlap("words", F.array(*[F.lit(a) for a in anchors(templates, least)])))
    rows = pinned(rows.filter("held").drop("held"), "anchored")  # every class reads these, not the corpus
    found = None
    for window, stride, bands, members in plan(templates, least, miss):
        own = known.filter(F.col("template").isin(members))
        keys = own.select("template", F.explode(_bands(F.col("own"), bands)).alias("key")).select("template", "key.*")
        starts = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(stride))
        held = F.arrays_overlap("words", F.array(*[F.lit(a) for a in anchors([templates[i] for i in members], least)]))
        cut = rows.filter(held).select("doc_id", "words", F.explode(starts).alias("start"))
        cut = cut.select("doc_id", "start", F.slice("words", F.col("start") + 1, window).alias("words")).filter(held)
        cut = cut.select("doc_id", "start", F.array_distinct(_runs(F.col("words"))).alias("runs"))
        cut = cut.select("doc_id", "start", "runs", F.explode(_bands(F.col("runs"), bands)).alias("key"))
        pairs = cut.select("doc_id", "start", "runs", "key.*").join(F.broadcast(keys), ["band", "low"])
        pairs = pairs.join(F.broadcast(own), "template")  # both are bounded by the templates
        share = F.size(F.array_intersect("runs", "own")) / F.size("own")
        hits = pairs.select("doc_id", "start", "template", "license", share.alias("share")).filter(F.col("share") >= least)
        near = Window.partitionBy("doc_id").orderBy("start").rangeBetween(-(window // 2), window // 2)
        hits = hits.distinct().withColumn("best", F.max("share").over(near)).filter("share = best").drop("best")
        found = hits if found is None else found.unionByName(hits)
    return found.groupBy("doc_id", "license", "template").agg(
        F.max("share").alias("containment"), F.count("*").alias("n_windows"), F.min("start").cast("long").alias("first_word")
    )

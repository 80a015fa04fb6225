"""Licence notices found by comparing normalised text with templates; DataFrame functions only.

Text is lower-cased, and all but ASCII letters and digits becomes a space.  Every line, and every
paragraph of several lines, is compared with the templates by the Dice coefficient over word
bigrams, 2 |A & B| / (|A| + |B|): the size of a span counts all its bigrams, the intersection the
distinct ones that it shares with the template's set.  A coefficient of at least t needs sizes whose ratio lies
in [t / (2 - t), (2 - t) / t], so most spans are dropped by their number of words alone, and each
span left is compared only with the templates whose size allows a match.  Nothing is shuffled.

A notice may also stand inside a longer line or be wrapped within a longer comment.  So each template has
a few anchors, bigrams that few templates share; where one occurs among the lines that are no notices
themselves, a window of the template's length is laid around it and compared in the same way.

A notice with changed words may lack its anchors or hold them elsewhere.  A span that matches a template of
m bigrams shares at least t / (2 - t) m of them, so it holds one of any m - that + 1.  Texts that hold one
of the rarest so many, and that least number of all, get a window of the template's length at each word from which it
takes in the least number.  So every window that matches is compared, whether it holds an anchor or not.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Dice coefficient from which a span counts as a notice.
LEAST = 0.8
#: Public licence notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "all-rights-reserved": "All rights reserved.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
        "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
        "whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "Apache-2.0-text": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at"
    ),
    "GPL-text": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."
    ),
}


#: Bigrams of a template at which windows are laid.
ANCHORS = 2


def anchors(templates: dict[str, str], most: int = ANCHORS) -> list[tuple[str, str, int, int]]:
    """(template, bigram, words before it in the template, words of the template): the bigrams that the fewest
    templates have, longer ones first."""
    words = {name: re.sub("[^a-z0-9]+", " ", t.lower()).split() for name, t in templates.items()}
    pairs = {name: [f"{a} {b}" for a, b in zip(w, w[1:])] for name, w in words.items()}
    count = Counter(p for found in pairs.values() for p in set(found))
    out = []
    for name, found in sorted(pairs.items()):
        best = sorted(set(found), key=lambda p: (count[p], -len(p), p))[:most]
        out += [(name, p, found.index(p), len(words[name])) for p in best]
    return out


def prefixes(templates: dict[str, str], least: float = LEAST) -> list[tuple[str, list[str], list[str], int, int]]:
    """(template, its rarest bigrams, all of them, how many of all a matching span shares at least, words of the
    template): a matching span holds one of the rarest."""
    sets = {name: bigrams(t) for name, t in templates.items()}
    count = Counter(p for found in sets.values() for p in found)
    out = []
    for name, found in sorted(sets.items()):
        need = max(math.ceil(least / (2 - least) * len(found) - 1e-9), 1)
        rare = sorted(found, key=lambda p: (count[p], -len(p), p))[: len(found) - need + 1]
        if found:
            out.append((name, rare, found, need, len(re.sub("[^a-z0-9]+", " ", templates[name].lower()).split())))
    return out


def bigrams(text: str) -> list[str]:
    words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def scan(docs: DataFrame, text: str = "text", templates: dict[str, str] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """``docs`` with license (the best match, null if none), dice (its coefficient, else null) and
    n_notices (spans that match, and one more if a window does); columns of these names are replaced.

    Equal coefficients go to the name that sorts last.  Null and empty texts match nothing.  The
    templates are part of the plan, so they must be few (some hundreds); texts may be of any length.
    """
    docs = docs.drop("license", "dice", "n_notices")
    sets = {name: bigrams(t) for name, t in templates.items()}
    sets = {name: b for name, b in sets.items() if b}
    table = F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(len(b)).alias("n"), F.array(*map(F.lit, b)).alias("grams"))
        for name, b in sorted(sets.items())
    ])
    low, high = least / (2 - least), (2 - least) / least
    smallest, largest = min(map(len, sets.values())), max(map(len, sets.values()))

    # Lines keep their ends through the clean-up; two or more ends part paragraphs.
    clean = F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), "[^a-z0-9\\n]+", " ")
    rows = docs.withColumn("__clean", clean)
    lines = F.split("__clean", "\n")
    several = F.filter(F.split("__clean", "\n *\n[ \n]*"), lambda p: F.instr(F.trim(F.translate(p, "\n", "|")), "|") > 0)
    spans = F.transform(F.concat(lines, several), lambda s: F.trim(F.regexp_replace(s, "[ \n]+", " ")))
    n_words = lambda s: F.length(s) - F.length(F.translate(s, " ", "")) + 1
    # Words are counted before anything is cut up, so long spans cost no more than that.
    some = F.filter(spans, lambda s: (n_words(s) - 1 >= low * smallest) & (n_words(s) - 1 <= high * largest))
    words = F.transform(some, lambda s: F.split(s, " "))
    rows = rows.withColumn("__words", words)

    size = lambda w: F.size(w) - 1

    def best(w: Column) -> Column:
        near = F.filter(table, lambda t: (size(w["w"]) >= low * t["n"]) & (size(w["w"]) <= high * t["n"]))
        scored = F.transform(near, lambda t: F.struct(
            (2.0 * F.size(F.array_intersect(w["g"], t["grams"])) / (size(w["w"]) + t["n"])).alias("dice"), t["name"].alias("name")))
        return F.array_max(F.filter(scored, lambda x: x["dice"] >= least))

    fit = F.filter("__words", lambda w: F.exists(table, lambda t: (size(w) >= low * t["n"]) & (size(w) <= high * t["n"])))
    pairs = F.transform(fit, lambda w: F.struct(w.alias("w"), _pairs(w).alias("g")))
    rows = rows.withColumn("__pairs", pairs).drop("__words")
    rows = rows.withColumn("__spans", F.filter(F.transform("__pairs", lambda p: F.struct(F.array_join(p["w"], " ").alias("s"), best(p).alias("b"))), lambda x: x["b"].isNotNull())).drop("__pairs")

    # Windows: only texts that hold an anchor, or enough of a template's bigrams, are cut into words.
    places = anchors(templates)
    left = F.filter(F.transform(F.split("__clean", "\n"), lambda s: F.trim(s)), lambda s: (s != "") & ~F.array_contains(F.col("__spans")["s"], s))
    holds = lambda a: F.contains(F.col("__left"), a)
    held = F.exists(F.array(*map(F.lit, dict.fromkeys(p for _, p, _, _ in places))), holds)
    whole = F.array(*[
        F.struct(F.array(*map(F.lit, rare)).alias("rare"), F.array(*map(F.lit, found)).alias("grams"), F.lit(need).alias("need"), F.lit(n).alias("n"))
        for _, rare, found, need, n in prefixes(templates, least)
    ])
    near = F.filter(whole, lambda t: F.exists(t["rare"], holds) & (F.size(F.filter(t["grams"], holds)) >= t["need"]))
    rows = rows.withColumn("__left", F.array_join(left, " ")).drop("__clean").withColumn("__near", near)
    rows = rows.withColumn("__rest", F.when((F.size("__near") > 0) | held, F.split("__left", " "))).drop("__left")
    spots = F.array(*[F.struct(F.lit(p).alias("pair"), F.lit(k).alias("before"), F.lit(n).alias("n")) for _, p, k, n in places])
    grams = _pairs(F.col("__rest"))
    where = lambda is_one: F.filter(F.transform(F.col("__grams"), lambda g, i: F.when(is_one(g), i)), lambda i: i.isNotNull())
    window = lambda i, n: F.struct(F.slice(F.col("__rest"), i + 1, n).alias("w"))
    at = F.flatten(F.transform(spots, lambda t: F.transform(where(lambda g: g == t["pair"]), lambda i: window(F.greatest(i - t["before"], F.lit(0)), t["n"]))))

    def starts(t: Column) -> Column:
        """The words from which ``n`` words take in at least ``need`` bigrams of a template; ``at``: where those are."""
        last = lambda j: F.get(t["at"], j + t["t"]["need"] - 1)
        reach = t["t"]["n"] - 2
        runs = F.transform(t["at"], lambda i, j: F.when(last(j) - i <= reach, F.sequence(F.greatest(last(j) - reach, F.lit(0)), i)))
        return F.array_distinct(F.flatten(F.filter(runs, lambda r: r.isNotNull())))

    found = F.transform(F.col("__near"), lambda t: F.struct(t.alias("t"), where(lambda g: F.array_contains(t["grams"], g)).alias("at")))
    more = F.flatten(F.transform(found, lambda t: F.transform(starts(t), lambda i: window(i, t["t"]["n"]))))
    windows = F.transform(F.col("__at"), lambda x: F.struct(x["w"].alias("w"), _pairs(x["w"]).alias("g")))
    rows = rows.withColumn("__grams", F.when(F.col("__rest").isNotNull(), grams)).withColumn("__at", F.when(F.col("__grams").isNotNull(), F.concat(at, more))).drop("__grams", "__rest", "__near")
    rows = rows.withColumn("__inside", F.array_max(F.filter(F.transform(F.when(F.col("__at").isNotNull(), windows), best), lambda x: x.isNotNull())))
    rows = rows.withColumn("__best", F.greatest(F.array_max(F.col("__spans")["b"]), F.col("__inside")))
    return rows.select(
        *docs.columns, F.col("__best.name").alias("license"), F.col("__best.dice").alias("dice"),
        (F.size("__spans") + F.col("__inside").isNotNull().cast("int")).cast("long").alias("n_notices"),
    )


def _pairs(words: Column) -> Column:
    return F.transform(
        F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))),
        lambda w, i: F.concat(F.get(words, i), F.lit(" "), w),
    )

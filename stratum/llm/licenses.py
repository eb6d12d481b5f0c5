"""Licence scans: Dice coefficient over word bigrams [DataFrame functions only].

The whole text is normalised to words (line breaks, comment marks and
punctuation fall away) and cut to its bigrams once.  A licence template is
compared with every window of as many words as it has.  A window that reaches
the least coefficient has all but a few of the template's bigrams (the size
bound), so it holds one of a few chosen ones, its anchors: only windows around
anchors are built, and texts without a word of any anchor are not looked at
further.  All of it is one projection; nothing is shuffled.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Public licence notices and short licence texts.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
    "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions:",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
    "that the above copyright notice and this permission notice appear in all copies.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met:",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
    "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "LGPL-2.1": "This library is licensed under the GNU Lesser General Public License, version 2.1.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "All-rights-reserved": "All rights reserved.",
}


def normal_words(text: str) -> list[str]:
    """Words of a template, as ``_words`` makes them of a passage."""
    return re.sub(r"[^\w]+|_", " ", text.lower()).split()


def bigrams(text: str) -> list[str]:
    w = normal_words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:], strict=False)))


def anchors(text: str, least: float) -> list[str]:
    """Bigrams of a template of which every window that matches it has one.

    With n bigrams in the template, a match shares least * n / (2 - least) of
    them or more; of any more bigrams than the rest, it shares one.  Those with
    the longest words are taken, since these are rare."""
    grams = bigrams(text)
    spare = len(grams) - math.ceil(least * len(grams) / (2 - least) - 1e-9)
    longest = lambda g: max(g.split(), key=lambda w: (len(w), w))
    return sorted(grams, key=lambda g: (-len(longest(g)), g))[: spare + 1]


def _any(text: Column, some: list[str]) -> Column:
    test = F.lit(False)
    for w in some:
        test = test | F.contains(text, F.lit(w))
    return test


def matches(text: Column, templates: dict[str, str] | None = None, least: float = 0.8) -> Column:
    """Array of (license, dice, start, passage) of a text, one for each template
    that a window matches: its best window, the first of equal ones; start:
    the window's first word, from 0; passage: its normalised words."""
    templates = TEMPLATES if templates is None else templates
    known = {k: v for k, v in templates.items() if bigrams(v)}
    kind = "array<struct<license:string,dice:double,start:int,passage:string>>"
    if not known:
        return F.array().cast(kind)
    rare = {k: anchors(v, least) for k, v in known.items()}
    every = sorted({g for some in rare.values() for g in some})
    gate = {max(g.split(), key=lambda w: (len(w), w)) for g in every}
    gate = sorted(w for w in gate if not any(o != w and o in w for o in gate))
    table = F.array(*(F.struct(F.lit(k).alias("license"), F.array(*map(F.lit, bigrams(v))).alias("grams"), F.lit(len(bigrams(v))).alias("n"),
                               F.array(*map(F.lit, rare[k])).alias("anchors"), F.lit(len(normal_words(v)) - 1).alias("pairs")) for k, v in known.items()))
    one = lambda x, f: F.element_at(F.transform(F.array(x), f), 1)  # noqa: E731  binds x, so it is computed once

    def windows(w: Column, g: Column, at: Column) -> Column:
        """Best window of each template; at: places of anchors in the bigrams g."""
        def best(t: Column) -> Column:
            mine = F.filter(at, lambda i: F.array_contains(t["anchors"], F.get(g, i)))
            starts = F.array_distinct(F.flatten(F.transform(mine, lambda i: F.sequence(
                F.greatest(i - t["pairs"] + 1, F.lit(0)), F.least(i, F.greatest(F.size(g) - t["pairs"], F.lit(0)))))))
            cut = F.transform(starts, lambda s: F.struct(s.alias("s"), F.array_distinct(F.slice(g, s + 1, t["pairs"])).alias("x")))
            scored = F.transform(cut, lambda c: F.struct(
                (F.size(F.array_intersect(c["x"], t["grams"])) * F.lit(2.0) / (F.size(c["x"]) + t["n"])).alias("dice"), (-c["s"]).alias("back")))
            return F.struct(t["license"].alias("license"), F.array_max(scored).alias("top"), t["pairs"].alias("pairs"))

        good = F.filter(F.transform(table, best), lambda b: b["top"]["dice"] >= least - 1e-12)
        return F.transform(good, lambda b: F.struct(
            b["license"].alias("license"), b["top"]["dice"].alias("dice"), (-b["top"]["back"]).alias("start"),
            F.array_join(F.slice(w, 1 - b["top"]["back"], b["pairs"] + 1), " ").alias("passage")))

    def pairs(w: Column) -> Column:
        fewer = F.greatest(F.size(w) - 1, F.lit(0))
        return F.zip_with(F.slice(w, 1, fewer), F.slice(w, 2, fewer), lambda a, b: F.concat(a, F.lit(" "), b))

    def places(g: Column) -> Column:
        return F.filter(F.transform(g, lambda x, i: F.when(x.isin(every), i)), lambda i: i.isNotNull())

    low = F.lower(text)
    words = F.split(F.btrim(F.regexp_replace(low, r"[^\p{L}\p{N}]+", " ")), " ")
    none = F.array().cast(kind)
    found = one(words, lambda w: one(pairs(w), lambda g: one(places(g), lambda at: F.when(F.size(at) > 0, windows(w, g, at)).otherwise(none))))
    return F.when(text.isNotNull() & _any(low, gate), found).otherwise(none)


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8) -> DataFrame:
    """doc_id, n_matches, licenses, best_dice: one row per row of ``docs``.

    n_matches: the templates that some window of the whole text matches, each
    once; licenses: their names in order, comma-joined ('' without matches);
    best_dice: the largest coefficient (0.0 without).  A text with fewer words
    than a template is compared whole.  Null and empty texts, and texts of one
    word, match nothing.  Texts of any length are read whole; repeated rows
    have equal results; an empty table gives no rows.  Other columns aren't
    read."""
    found = docs.select("doc_id", matches(F.col("text"), templates, least).alias("_m"))
    return found.select(
        "doc_id", F.size("_m").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.transform("_m", lambda m: m["license"])), ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform("_m", lambda m: m["dice"])), F.lit(0.0)).alias("best_dice"))

"""License scans (6): lines, paragraphs and whole texts against licence templates by Dice coefficient over word bigrams.
DataFrame functions only, within the row: nothing is shuffled.

Text is normalised to words of [A-Za-z0-9], in lower case. A unit (a line; a paragraph of several lines; a text of
several paragraphs) with a distinct bigrams matches a template with b when 2 * shared / (a + b) >= num / den. Then
shared >= b * num / (2 * den - num), and a lies between that and b * (2 * den - num) / num. Both bounds prune: units
of no fitting size are not compared, and as a match must share that many bigrams, it must hold one of the template's
anchors, words whose bigrams are too many to be all missing. Texts and units without any anchor are left at once.

Defined results: of licences with the same Dice the first by name counts; null and empty texts match nothing; a unit of one word has no bigram and matches nothing; repeated
units count each; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Public notices and standard headers of common licences, by SPDX identifier.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "This project is licensed under the terms of the MIT license.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}


def bigrams_of(text: str) -> set[str]:
    words = re.findall("[a-z0-9]+", "".join(c.lower() if c.isascii() else " " for c in text))
    return {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}


def least_shared(b: int, num: int, den: int) -> int:
    return -(-b * num // (2 * den - num))


def anchors(bigrams: set[str], num: int, den: int) -> set[str]:
    """Words that every match must hold one of: their bigrams are more than a match may lack."""
    left, out = set(bigrams), set()
    while len(bigrams) - len(left) <= len(bigrams) - least_shared(len(bigrams), num, den):
        # Longer words first among equally frequent ones: they are rarer in other text.
        count = Counter(w for x in left for w in set(x.split()))
        best = max(count, key=lambda w: (len(w) > 3 or w.isdigit() is False and len(w) == 3, count[w], len(w), w))
        out.add(best)
        left = {x for x in left if best not in x.split()}
    return out


def license_matches(text: Column, templates: dict[str, list[str]] = TEMPLATES, num: int = 4, den: int = 5) -> Column:
    """array<struct<unit string, license string, dice double, n bigint>>: the best match of each unit that has one."""
    known = sorted((name, sorted(bigrams_of(t))) for name, texts in templates.items() for t in texts)
    words = sorted(set().union(*(anchors(set(b), num, den) for _, b in known)))
    firsts = "".join(sorted({w[0] for w in words}))
    anchor = rf"(?i)(?<![A-Za-z0-9])(?=[{firsts}])(?:{'|'.join(words)})(?![A-Za-z0-9])"
    least = min(least_shared(len(b), num, den) for _, b in known)
    most = max(len(b) * (2 * den - num) // num for _, b in known)
    paragraphs = F.split(text, r"\n[\x20\x09\r]*\n[\x20\x09\r\n]*", -1)
    units = F.concat(
        F.transform(F.split(text, r"\n", -1), lambda x: F.struct(F.lit("line").alias("unit"), x.alias("text"))),
        F.transform(F.filter(paragraphs, lambda x: x.contains("\n")), lambda x: F.struct(F.lit("paragraph").alias("unit"), x.alias("text"))),
        F.when(F.size(paragraphs) > 1, F.array(F.struct(F.lit("text").alias("unit"), text.alias("text")))).otherwise(F.array().cast("array<struct<unit:string,text:string>>")),
    )
    near = F.filter(units, lambda x: x["text"].rlike(anchor))

    def bigrams(x: Column) -> Column:
        found = F.transform(F.regexp_extract_all(x, F.lit("[A-Za-z0-9]+"), F.lit(0)), lambda w: F.lower(w))
        pairs = F.arrays_zip(F.slice(found, 1, F.greatest(F.size(found) - 1, F.lit(0))).alias("a"), F.slice(found, 2, F.greatest(F.size(found) - 1, F.lit(0))).alias("b"))
        return F.array_distinct(F.transform(pairs, lambda p: F.concat_ws(" ", p["a"], p["b"])))

    counted = F.transform(near, lambda x: F.struct(x["unit"].alias("unit"), bigrams(x["text"]).alias("own")))
    fitting = F.filter(counted, lambda x: F.size(x["own"]).between(least, most))

    def best(x: Column) -> Column:
        a, rows = F.size(x["own"]), []
        for name, b in known:
            shared = F.size(F.array_intersect(x["own"], F.array(*map(F.lit, b))))
            fits = a.between(least_shared(len(b), num, den), len(b) * (2 * den - num) // num)
            dice = F.when(fits, F.lit(2.0) * shared / (a + F.lit(len(b)))).otherwise(0.0)
            rows.append(F.struct(dice.alias("dice"), F.lit(name).alias("license")))
        top = F.reduce(F.array(*rows), F.struct(F.lit(0.0).alias("dice"), F.lit("").alias("license")), lambda acc, y: F.when(y["dice"] > acc["dice"], y).otherwise(acc))
        return F.struct(x["unit"].alias("unit"), top.alias("top"))

    matched = F.filter(F.transform(fitting, best), lambda x: x["top"]["dice"] >= num / den)
    flat = F.transform(matched, lambda x: F.struct(x["unit"].alias("unit"), x["top"]["license"].alias("license"), x["top"]["dice"].alias("dice")))
    none = F.array().cast("array<struct<unit:string,license:string,dice:double>>")
    return F.when(text.rlike(anchor), flat).otherwise(none)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """A row for each row of docs: id, n_matches, licenses (distinct names in order, comma-joined), best_dice."""
    found = docs.select(F.col(id_col), license_matches(F.coalesce(F.col(text_col), F.lit("")), **options).alias("m"))
    return found.select(id_col, F.size("m").cast("bigint").alias("n_matches"), F.array_join(F.array_sort(F.array_distinct(F.transform("m", lambda x: x["license"]))), ",").alias("licenses"), F.round(F.coalesce(F.array_max(F.transform("m", lambda x: x["dice"])), F.lit(0.0)), 6).alias("best_dice"))

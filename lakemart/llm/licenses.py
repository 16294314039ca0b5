"""Licence scan: Dice coefficient over word bigrams against licence templates.

Only Spark expressions: each text is scanned within its row, so nothing is
shuffled.  A template is compared with a unit only where the sizes of the two
bigram sets can reach the wanted coefficient.  Units are the lines of a text, its
paragraphs of several lines, and the whole text: so a notice is found on a line of
its own, wrapped between blank lines, or as all there is.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_DICE = 0.8
SPACES = " \t\r\n"
#: What separates paragraphs.
BLANK_LINES = r"\n[ \t\r]*\n[ \t\r\n]*"

# fixed values: licence notices as their licensors word them
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("proprietary", "All rights reserved."),
]


def template_bigrams(text: str) -> list[str]:
    plain = "".join(c if c in string.ascii_lowercase + string.digits else " " for c in text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(plain, plain[1:])})


def _words(text: Column) -> Column:
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.split(F.trim(F.regexp_replace(lower, "[^a-z0-9]+", " ")), " ")


def _bigrams(words: Column) -> Column:
    n = F.size(words) - 1
    return F.array_distinct(F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat(a, F.lit(" "), b)))


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] | None = None, least: float = LEAST_DICE, keep: list[str] | None = None) -> DataFrame:
    """Add to each document its nearest licence template.

    license: of the best unit's template, null where no unit reaches `least`;
    dice: that coefficient; n_matches: units that reach `least` with any template.
    Among equal coefficients the template listed first wins.  Null and empty
    texts, and texts without two words, have no match.  Long texts are scanned whole, an empty table
    gives no rows.  Repeated rows are scanned each; columns of `docs` that have the name of a result are replaced.
    """
    templates = TEMPLATES if templates is None else templates
    bigrams = [template_bigrams(t) for _, t in templates]
    sizes = [len(b) for b in bigrams]
    # 2 min / (a + b) >= least only between these sizes; a little wider for rounding
    ratio = least / (2 - least) * (1 - 1e-9)
    known = F.array(*[F.struct(F.lit(-k).alias("k"), F.lit(len(b)).alias("n"), F.array(*[F.lit(x) for x in b]).alias("b")) for k, b in enumerate(bigrams)])

    def best(unit: Column) -> Column:
        size = F.size(unit)
        near = F.filter(known, lambda t: (t["n"] >= size * ratio) & (size >= t["n"] * ratio))
        scored = F.transform(near, lambda t: F.struct((2.0 * F.size(F.array_intersect(unit, t["b"])) / (size + t["n"])).alias("dice"), t["k"].alias("k")))
        return F.array_max(F.filter(scored, lambda s: s["dice"] >= least))

    text = F.coalesce("text", F.lit(""))
    none = F.array().cast("array<string>")
    # a paragraph of one line is a unit already, so is a text without a blank line
    paragraphs = F.filter(F.split(text, BLANK_LINES), lambda p: F.instr(F.btrim(p, F.lit(SPACES)), "\n") > 0)
    units = F.concat(
        F.split(text, "\n"),
        F.when(text.rlike(BLANK_LINES), paragraphs).otherwise(none),
        F.when(F.instr(text, "\n") > 0, F.array(text)).otherwise(none),
    )
    kept = docs.columns if keep is None else keep
    kept = [c for c in kept if c.lower() not in ("license", "dice", "n_matches", "_units")]
    step = docs.select(*kept, F.transform(units, _words).alias("_units"))
    step = step.withColumn("_units", F.transform(F.filter("_units", lambda w: F.size(w) >= 2), _bigrams))
    low, high = int(min(sizes) * ratio), max(sizes) / ratio
    step = step.withColumn("_units", F.filter("_units", lambda b: (F.size(b) >= low) & (F.size(b) <= high)))
    step = step.withColumn("_units", F.filter(F.transform("_units", best), lambda m: m.isNotNull()))
    top = F.array_max("_units")
    names = F.array(*[F.lit(n) for n, _ in templates])
    return step.select(
        *kept, F.size("_units").cast("long").alias("n_matches"), F.when(top.isNotNull(), F.element_at(names, 1 - top["k"])).alias("license"), top["dice"].alias("dice")
    )


def oracle(least: float = LEAST_DICE) -> str:
    """The scan of `documents` in SQL."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ", ".join(f"({k}, {quote(n)}, [{', '.join(map(quote, template_bigrams(t)))}])" for k, (n, t) in enumerate(TEMPLATES))
    plain = f"trim(regexp_replace(translate(u, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^a-z0-9]+', ' ', 'g'))"
    return f"""
    WITH templates(k, license, tb) AS (VALUES {rows}),
    units AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS u FROM documents
        UNION ALL SELECT doc_id, text FROM documents WHERE contains(text, chr(10))
        UNION ALL SELECT doc_id, p FROM (
            SELECT doc_id, unnest(regexp_split_to_array(text, '{BLANK_LINES}')) AS p FROM documents WHERE regexp_matches(text, '{BLANK_LINES}')
        ) WHERE contains(trim(p, ' ' || chr(9) || chr(13) || chr(10)), chr(10))
    ),
    words AS (SELECT doc_id, string_split({plain}, ' ') AS w FROM units),
    bigrams AS (
        SELECT doc_id, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM words WHERE len(w) >= 2
    ),
    scored AS (
        SELECT doc_id, row_number() OVER () AS unit, b, k, license, 2.0 * len(list_intersect(b, tb)) / (len(b) + len(tb)) AS dice
        FROM bigrams JOIN templates ON list_has_any(b, tb)
    ),
    matched AS (SELECT doc_id, b, max(dice) AS dice, arg_min(license, (1 - dice, k)) AS license, arg_min(k, (1 - dice, k)) AS k FROM scored WHERE dice >= {least} GROUP BY doc_id, b),
    counted AS (SELECT doc_id, sum(n) AS n FROM (SELECT doc_id, b, count(*) AS n FROM bigrams GROUP BY ALL) JOIN (SELECT DISTINCT doc_id, b FROM matched) USING (doc_id, b) GROUP BY doc_id)
    SELECT d.doc_id, coalesce(c.n, 0)::BIGINT AS n_matches, m.license, m.dice
    FROM documents d LEFT JOIN counted c USING (doc_id)
    LEFT JOIN (SELECT doc_id, arg_min(license, (1 - dice, k)) AS license, max(dice) AS dice FROM matched GROUP BY doc_id) m USING (doc_id)
    """

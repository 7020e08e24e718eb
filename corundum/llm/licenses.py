"""License scans by MinHash bands over overlapping text windows, in DataFrame operations only.

Words are runs of a-z and 0-9 of the lower-cased text, shingles are five words. Templates fall into classes by length; for a
class of up to L words the text is read in windows of 1.25 L words that start every L/4, so an occurrence lies wholly in
one. Windows and templates get BANDS MinHash values of one row each (the minimum of a seeded hash); equal values retrieve a template,
then the exact share of the template's shingles inside the window must reach 0.8. The worst window holds a template
with similarity 1/6 (one shingle of six), which collides with probability 1 - (5/6)**64 = 0.99999.

Windows without any template shingle cannot reach a containment above 0 and are not sketched; that is a property of the exact test,
not a second search. Templates may be of any length from five words on; classes double up to the longest, and a shorter one, which
has no shingle, raises an error.

Null, empty and short texts match nothing; rows that repeat a doc_id are one document, of which n_windows counts the different windows,
whichever row they are in, and so are all rows without an id; extra columns are ignored; an empty table gives an empty result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corundum.llm._spark import small
from corundum.llm.quality import bind

#: Names and texts of licenses (fixed values, public notices).
TEMPLATES = [
    ("Apache-2.0 line", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0 header", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0 line", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0 line", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0 line", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("MIT line", "Released under the MIT License."),
    ("MIT grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
WIDTH, BANDS, PERCENT, LEAST = 5, 64, 80, 8


def shingles(text: F.Column) -> F.Column:
    """Hashes of all runs of five words, in order."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), lambda w: w != "")
    runs = lambda h: F.transform(F.sequence(F.lit(1), F.size(h) - (WIDTH - 1)), lambda i: F.xxhash64(*[F.element_at(h, i + k) for k in range(WIDTH)]))
    return bind(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.when(F.size(h) >= WIDTH, runs(h)).otherwise(F.array().cast("array<bigint>")))


def signature(sets: str) -> F.Column:
    """MinHash values under BANDS seeded hashes."""
    return F.transform(F.sequence(F.lit(1), F.lit(BANDS)), lambda k: F.array_min(F.transform(sets, lambda x: F.xxhash64(x, k))))


def templates(spark: SparkSession, texts=TEMPLATES) -> DataFrame:
    """license, class, sh (distinct shingles): one row per template."""
    rows = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(n).alias("license"), F.lit(t).alias("text")) for n, t in texts])).alias("t")).select("t.license", shingles(F.col("t.text")).alias("all"))
    words = F.size("all") + WIDTH - 1
    size = F.lit(LEAST)  # doubled until it holds the template
    for k in range(1, 32 - LEAST.bit_length()):
        size = F.when(words > LEAST << (k - 1), LEAST << k).otherwise(size)
    return rows.select("license", size.alias("class"), F.array_distinct("all").alias("sh"))


def scan(docs: DataFrame, texts=TEMPLATES) -> DataFrame:
    """One row per document and license found: doc_id, license, first_word (of its first window), n_windows, matched and total shingles."""
    spark = docs.sparkSession
    t = templates(spark, texts)
    known = t.collect()  # as many rows as there are templates
    if none := [r["license"] for r in known if not r["sh"]]:
        raise ValueError(f"templates of fewer than {WIDTH} words can't be matched: {none}")
    own = F.array(*[F.lit(x) for x in sorted({s for r in known for s in r["sh"]})])
    d = docs.select("doc_id", shingles(F.col("text")).alias("s")).where(F.arrays_overlap("s", own))
    windows = None
    for c in sorted({r["class"] for r in known}):
        step, take = c // 4, c + c // 4 - (WIDTH - 1)
        starts = F.filter(F.sequence(F.lit(0), F.size("s") - 1, F.lit(step)), lambda at: F.arrays_overlap(F.slice("s", at + 1, F.lit(take)), own))
        w = d.select("doc_id", F.lit(c).alias("class"), F.explode(F.transform(starts, lambda at: F.struct(at.alias("at"), F.array_distinct(F.slice("s", at + 1, F.lit(take))).alias("w")))).alias("x")).select("doc_id", "class", "x.at", "x.w")
        windows = w if windows is None else windows.unionByName(w)
    banded = windows.select("doc_id", "class", "at", "w", F.posexplode(signature("w")).alias("band", "low"))
    bands = t.select("license", "class", F.posexplode(signature("sh")).alias("band", "low"))
    met = banded.join(small(bands), ["class", "band", "low"]).select("doc_id", "class", "at", "w", "license").distinct()
    matched = F.size(F.array_intersect("w", "sh"))
    hit = met.join(small(t.select("license", "class", "sh")), ["license", "class"]).select("doc_id", "license", "at", "w", matched.alias("matched"), F.size("sh").alias("total")).where(f"100 * matched >= {PERCENT} * total")
    return hit.groupBy("doc_id", "license").agg(F.min("at").cast("long").alias("first_word"), F.count("*").alias("n_windows"), F.max("matched").cast("long").alias("matched"), F.max("total").cast("long").alias("total"))


def _oracle() -> str:
    values = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in TEMPLATES)
    words = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^a-z0-9]+'), lambda x: x <> '')"
    size = f"({LEAST} * pow(2, greatest(0, ceil(log2(n / {LEAST})))))::INT"
    return f"""
WITH a(license, text) AS (VALUES {values}),
b AS (SELECT license, {words} AS w FROM a),
c AS (SELECT license, len(w) AS n, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS sh FROM b WHERE len(w) >= 5),
t AS (SELECT license, {size} AS class, sh FROM (SELECT DISTINCT * FROM c)),
z AS (SELECT license, COUNT(*) AS total FROM t GROUP BY license),
d AS (SELECT doc_id, {words} AS w FROM documents),
p AS (SELECT doc_id, len(w) - 4 AS n, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS pos FROM d WHERE len(w) >= 5),
s AS (SELECT doc_id, n, pos, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o || ' ' || lead(x, 4) OVER o AS sh FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
m AS (SELECT doc_id, license, class, sh, n, pos FROM s JOIN t USING (sh)),
u AS (SELECT doc_id, license, sh, class // 4 * k AS pos FROM (SELECT *, unnest(range(greatest(0, (pos - (class + class // 4 - 5)) // (class // 4)), pos // (class // 4) + 1)) AS k FROM m)
      WHERE class // 4 * k <= pos AND pos < class // 4 * k + class + class // 4 - 4),
g AS (SELECT doc_id, license, pos, COUNT(DISTINCT sh) AS matched FROM u GROUP BY ALL)
SELECT doc_id, license, MIN(pos)::BIGINT AS first_word, COUNT(*) AS n_windows, MAX(matched)::BIGINT AS matched, MAX(total)::BIGINT AS total
FROM g JOIN z USING (license) WHERE 100 * matched >= {PERCENT} * total GROUP BY doc_id, license
"""


ORACLE = _oracle()

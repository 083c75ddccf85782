"""License scan: MinHash bands over overlapping windows, then exact shingle containment.

Texts are lower-cased and cut at everything but a-z and 0-9; five consecutive words are a
shingle. For each template size m (in shingles) a text is cut into windows of 3m/2 shingles,
m/2 apart, so any run of m shingles lies inside one window. A window has BANDS MinHash
values, one row a band, each filed under (size, band, value) and joined with the templates'.
A whole copy of the template has similarity 2/3 or more to its window, a copy with four
fifths of the shingles 0.47: the chance that no band collides is below 3e-8 and 4e-5. Found
pairs are then compared as sets of shingle texts: containment is the part of the template's
shingles that the window has, and THRESHOLD or more is a match.

A match needs at least one shared shingle, so windows without any shingle of any template are
left out before signatures are made; this loses nothing. Only DataFrame operations run on the
texts. Templates are a fixed list, whose size bounds the broadcast side of the band join.

Result: one row for each id and template that match, with the best containment, the first
matching window and the number of windows. Null, empty and shorter texts match nothing; rows
of one id are reported together; null ids form one id. Other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .license_texts import WHOLE

SHINGLE, BANDS, THRESHOLD = 5, 16, 0.8
#: Short notices of public licenses, and with them their whole texts.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
} | WHOLE


def words(text: str | None) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", (text or "").lower()) if w]


def shingles(ws: list[str]) -> list[str]:
    return [" ".join(ws[i : i + SHINGLE]) for i in range(len(ws) - SHINGLE + 1)]


def chained(values: list[bytes]) -> int:
    """Spark's xxhash64 of several columns, as a signed integer."""
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(v, h)
    return h - (1 << 64) if h >> 63 else h


def hashed(ws: list[str]) -> list[int]:
    return [chained([w.encode() for w in ws[i : i + SHINGLE]]) for i in range(len(ws) - SHINGLE + 1)]


def band_value(hashes: list[int], band: int) -> int:
    return min(_long_int(h, band) for h in hashes)


def _long_int(h: int, band: int) -> int:
    """Spark's xxhash64 of (long, int); hashing a fixed-width value equals hashing its little-endian bytes."""
    x = xxhash.xxh64_intdigest(np.int64(h).tobytes(), 42)
    x = xxhash.xxh64_intdigest(np.int32(band).tobytes(), x)
    return x - (1 << 64) if x >> 63 else x


def _template_bands(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    rows = []
    for name, text in sorted(templates.items()):
        ws = words(text)
        own, parts = hashed(ws), sorted(set(shingles(ws)))
        rows += [(len(own), band, band_value(own, band), name, parts) for band in range(BANDS)]
    return spark.createDataFrame(rows, "size int, band int, value long, template string, parts array<string>")


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, template, containment, first_word, n_windows for docs (doc_id, text)."""
    templates = templates or TEMPLATES
    if any(len(words(t)) < SHINGLE for t in templates.values()):
        raise ValueError("a template needs five words")
    known = sorted({h for t in templates.values() for h in hashed(words(t))})
    sizes = sorted({len(hashed(words(t))) for t in templates.values()})
    split = F.array_remove(F.split(F.lower("text"), "[^a-z0-9]+"), "")
    hashes = lambda ws: F.transform(ws, lambda w, i: F.xxhash64(w, *[F.get(ws, i + k) for k in range(1, SHINGLE)]))
    # exploding a one-element array keeps the optimizer from splitting the text anew for each shingle
    once = F.explode(F.transform(F.array(split), lambda ws: F.struct(ws.alias("w"), F.slice(hashes(ws), F.lit(1), F.greatest(F.size(ws) - (SHINGLE - 1), F.lit(0))).alias("h"))))
    own = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), once.alias("x")).select("doc_id", "x.*")
    hits = own.where(F.arrays_overlap("h", F.array(*[F.lit(h) for h in known])))
    cutting = F.array(*[F.struct(F.lit(m).alias("size"), F.lit(m + (m + 1) // 2).alias("span"), F.lit(max(1, (m + 1) // 2)).alias("step")) for m in sizes])
    cuts = hits.select("doc_id", "w", "h", F.explode(cutting).alias("c")).select("doc_id", "w", "h", "c.*")
    # the last window starts where it still reaches the end; earlier ones are whole
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((F.size("h") - F.col("span")) / F.col("step")).cast("int")) * F.col("step"), F.col("step"))
    windows = cuts.select("doc_id", "w", "size", "h", "span", F.explode(starts).alias("start")).select(
        "doc_id", "size", "start", F.expr("slice(h, start + 1, span)").alias("h"), F.expr(f"slice(w, start + 1, span + {SHINGLE - 1})").alias("w")
    ).where(F.arrays_overlap("h", F.array(*[F.lit(h) for h in known])))
    least = lambda k: F.array_min(F.transform("h", lambda x: F.xxhash64(x, F.lit(k))))
    bands = F.array(*[F.struct(F.lit(k).alias("band"), least(k).alias("value")) for k in range(BANDS)])
    filed = windows.select("doc_id", "size", "start", "w", F.explode(bands).alias("b")).select("doc_id", "size", "start", "w", "b.band", "b.value")
    found = filed.join(F.broadcast(_template_bands(docs.sparkSession, templates)), ["size", "band", "value"])  # BANDS rows a template
    texts = F.transform(F.sequence(F.lit(1), F.size("w") - (SHINGLE - 1)), lambda i: F.array_join(F.slice(F.col("w"), i, F.lit(SHINGLE)), " "))
    checked = found.select("doc_id", "template", "start", (F.size(F.array_intersect(texts, F.col("parts"))) / F.size("parts")).alias("containment")).where(F.col("containment") >= threshold)
    each = checked.groupBy("doc_id", "template", "start").agg(F.max("containment").alias("containment"))
    return each.groupBy("doc_id", "template").agg(F.round(F.max("containment"), 6).alias("containment"), F.min("start").cast("long").alias("first_word"), F.count("*").alias("n_windows"))


def op2_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op2_sql() -> str:
    """The same by exact containment over all windows, without signatures."""
    rows = ", ".join(f"('{n}', {sorted(set(shingles(words(t))))!r}, {len(shingles(words(t)))})" for n, t in sorted(TEMPLATES.items()))
    return f"""
WITH templates AS (
  SELECT template, parts, m + (m + 1) // 2 AS span, greatest(1, (m + 1) // 2) AS step FROM (VALUES {rows}) v(template, parts, m)
), words AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id, list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL
), runs AS (
  SELECT doc_id, list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) AS h FROM words WHERE len(w) >= 5
), near AS (
  SELECT * FROM runs JOIN templates ON list_has_any(h, parts)
), windows AS (
  SELECT doc_id, template, parts, h, span, unnest(range(0, CAST(greatest(0, ceil((len(h) - span) / step)) AS BIGINT) * step + 1, step)) AS start FROM near
), scored AS (
  SELECT doc_id, template, start, len(list_intersect(h[start + 1:start + span], parts)) / len(parts) AS containment FROM windows
), each AS (
  SELECT doc_id, template, start, max(containment) AS containment FROM scored WHERE containment >= {THRESHOLD} GROUP BY ALL
)
SELECT doc_id, template, round(max(containment), 6) AS containment, CAST(min(start) AS BIGINT) AS first_word, count(*) AS n_windows FROM each GROUP BY doc_id, template
"""

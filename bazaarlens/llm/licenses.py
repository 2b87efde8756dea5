"""License notices: MinHash bands over overlapping text windows retrieve templates, shingles verify them.

A template is cut into segments of at most ``STRIDE + 1`` words, the last ones overlapping so that none
is short. Windows of two strides overlap by one, so wherever a segment stands in a text, one window
holds it whole. That window and a segment of ``m``
words share ``m - 1`` of the window's two-word shingles, a known least similarity; the number of bands
follows from it, so that each window with a whole segment shares a band with it with probability
``RECALL`` or more. Windows found that way are verified by exact containment of the segment's shingles.

All of it is column expressions; only windows that share a band with a template leave the projection.

Edge cases: null, blank and one-word texts hold no license; repeated rows are reported one by one;
rows without id are reported with a null id; an empty table gives an empty result. Columns of the
input beside the id are dropped, since the result has a row for each text and license.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm.registry import query, table

STRIDE = 5  # words
RECALL = 0.999  # of windows that hold a whole segment
CONTAINED = 0.8  # share of a segment's shingles that a window must hold
FOUND = 0.6  # share of a template's segments that a text must hold
LEAST_WORDS = 5  # of a template, and so of a segment

# Short notices and opening sentences of common licenses.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    ),
    "cc-by-nc-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-sa-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
}


def bands_for(words: int, recall: float = RECALL) -> int:
    """One-row bands with which a window that holds a segment of ``words`` words shares one with probability ``recall``."""
    similarity = (words - 1) / (2 * STRIDE - 1)
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity))


BANDS = bands_for(LEAST_WORDS)
SEEDS = [int(x) for x in np.random.default_rng(7).integers(-(2**63), 2**63 - 1, BANDS)]


def words_of(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles_of(words: str) -> Column:
    """A hash for each two neighbouring words; ``words`` is a column."""
    n = F.size(words)
    return F.when(
        n > 1, F.zip_with(F.slice(words, F.lit(1), n - 1), F.slice(words, F.lit(2), n - 1), lambda a, b: F.xxhash64(a, b))
    ).otherwise(F.array().cast("array<bigint>"))


def band_values(window: str) -> Column:
    """Least value of a window's shingles under each seed; ``window`` is a column of hashes."""
    return F.transform(F.array(*map(F.lit, SEEDS)), lambda seed: F.array_min(F.transform(window, lambda h: h.bitwiseXOR(seed))))


def segments(spark: SparkSession, templates: dict[str, tuple[str, ...]] = TEMPLATES) -> list[dict]:
    """Every template cut into parts of equal length: license, template, n_segments, segment, shingles, and a value for each band."""
    texts = [(name, t, text) for name, own in templates.items() for t, text in enumerate(own)]
    df = spark.createDataFrame(texts, "license string, template int, text string").withColumn("words", words_of(F.col("text")))
    df = df.withColumn("shingles", shingles_of("words")).withColumn("n", F.size("words"))
    out = []
    for r in df.collect():  # as many rows as there are templates
        if r["n"] < LEAST_WORDS:
            raise ValueError(f"a template of {r['license']} has fewer than {LEAST_WORDS} words")
        parts = math.ceil(r["n"] / (STRIDE + 1))
        for i in range(parts):
            lo = (r["n"] - STRIDE - 1) * i // (parts - 1) if parts > 1 else 0
            own = sorted(set(r["shingles"][lo : lo + STRIDE]))
            values = [min(h ^ s for h in own) for s in SEEDS]
            out.append({"license": r["license"], "template": r["template"], "n_segments": parts, "segment": i, "shingles": own, "values": values})
    return out


def find_licenses(df: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, tuple[str, ...]] = TEMPLATES) -> DataFrame:
    """A row for each text and license it holds: first word, the segments found, and their mean containment."""
    parts = segments(df.sparkSession, templates)
    known = [p["values"] for p in parts]
    schema = "license string, template int, n_segments int, segment int, shingles array<bigint>, values array<bigint>"
    parts = df.sparkSession.createDataFrame([tuple(p.values()) for p in parts], schema)
    df = df.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").alias("doc_id"), words_of(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("words"))
    df = df.select("row", "doc_id", shingles_of("words").alias("shingles"))
    starts = F.when(F.size("shingles") > 0, F.sequence(F.lit(0), F.size("shingles") - 1, F.lit(STRIDE)))
    windows = F.transform(starts, lambda at: F.struct(at.alias("at"), F.slice("shingles", at + 1, F.lit(2 * STRIDE - 1)).alias("window")))
    df = df.select("row", "doc_id", F.explode(windows).alias("w")).select("row", "doc_id", "w.at", "w.window")
    df = df.withColumn("bands", band_values("window"))
    # values of different bands differ by their seeds, so one set of all templates' values will do
    values = [v for p in known for v in p]
    df = df.filter(F.exists("bands", lambda v: v.isin(values)))
    df = df.select("row", "doc_id", "at", "window", F.posexplode("bands").alias("band", "value"))
    keys = parts.select("license", "template", "n_segments", "segment", "shingles", F.posexplode("values").alias("band", "value"))
    # the template table is fixed and small: bands times segments
    met = df.join(F.broadcast(keys), ["band", "value"]).withColumn(
        "contained", F.size(F.array_intersect("shingles", "window")) / F.size("shingles")
    )
    met = met.filter(F.col("contained") >= CONTAINED)
    best = met.groupBy("row", "doc_id", "license", "template", "n_segments", "segment").agg(F.max("contained").alias("contained"), F.min("at").alias("at"))
    found = best.groupBy("row", "doc_id", "license", "template", "n_segments").agg(
        F.count("*").alias("n"), F.avg("contained").alias("containment"), F.min("at").alias("at")
    )
    found = found.filter(F.col("n") >= FOUND * F.col("n_segments"))
    return found.groupBy("row", "doc_id", "license").agg(
        F.min("at").cast("long").alias("window_start"), F.max("n").alias("n_segments"), F.round(F.max("containment"), 6).alias("containment")
    ).drop("row")


def _check_sql() -> str:
    """Exact containment of every segment in every window, without bands."""
    words = "list_filter(regexp_split_to_array(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')".format
    pairs = "list_transform(generate_series(1, len({0}) - 1), lambda i: {0}[i] || ' ' || {0}[i + 1])".format
    rows = ", ".join(f"('{n}', {t}, '{x}')" for n, texts in TEMPLATES.items() for t, x in enumerate(texts))
    width = 2 * STRIDE - 1
    return f"""with t as (select *, cast(ceil(len(w) / {STRIDE + 1}.0) as bigint) n_segments from (select col0 license, col1 template, {words('col2')} w from (values {rows}))),
    s as (select license, template, n_segments, segment, w[lo + 1:lo + {STRIDE + 1}] w from (select *, case when n_segments > 1 then (n - {STRIDE + 1}) * segment // (n_segments - 1) else 0 end lo
        from (select *, len(w) n, unnest(range(0, n_segments)) segment from t))),
    seg as (select license, template, n_segments, segment, unnest(x) sh, len(x) total from (select *, list_distinct({pairs('w')}) x from s)),
    d as (select row_number() over () row_id, doc_id, {words("coalesce(text, '')")} w from documents),
    p as (select row_id, doc_id, unnest(generate_series(0, len(w) - 2)) i, unnest({pairs('w')}) sh from d where len(w) > 1),
    hit as (select p.*, license, template, n_segments, segment, total from p join seg using (sh)),
    met as (select row_id, doc_id, license, template, n_segments, segment, pos, count(distinct sh) / any_value(total) contained
        from (select *, unnest([i // {STRIDE} * {STRIDE}, i // {STRIDE} * {STRIDE} - {STRIDE}]) pos from hit)
        where pos >= 0 and i < pos + {width} group by all having contained >= {CONTAINED}),
    best as (select row_id, doc_id, license, template, n_segments, segment, max(contained) contained, min(pos) pos from met group by all),
    f as (select row_id, doc_id, license, template, n_segments, count(*) n, avg(contained) c, min(pos) pos from best group by all having n >= {FOUND} * n_segments)
    select doc_id, license, min(pos)::bigint window_start, max(n) n_segments, round(max(c), 6) containment from f group by row_id, doc_id, license"""


@query("op4_license_scan", _check_sql())
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licenses named in every document."""
    return find_licenses(table(spark, sf_dir, "documents"))

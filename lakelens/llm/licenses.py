"""License scan: MinHash bands over overlapping text windows, exact containment.

Everything is built-in expressions and joins.  A template of n words is looked
for in windows of 2n words that start every n words, so any run of n words lies
whole in some window.  Windows and templates get MinHash signatures of their
word shingles, banded so that a window holding at least ``CONTAINMENT`` of the
template's shingles collides with it in some band with probability
1 - ``MISS`` or more (``band_settings``).  Candidates are verified by exact
containment: the share of the template's shingles found in the window.

A window that shares no run of ``ANCHOR`` words with any template contains none
of a template's shingles, so only windows over such runs are signed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged

SHINGLE = 5             # words; shorter templates are one shingle
CONTAINMENT = 0.8
MISS = 1e-4
MAX_BANDS = 96
ANCHOR = 3

# Notices looked for (fixed values: the usual wording of public licenses).
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "mit": "Released under the MIT License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                 "provided that the following conditions are met",
    "apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of "
                         "the License at",
    "gpl-grant": "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                 "published by the Free Software Foundation",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
                 "fee is hereby granted",
    "no-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED",
}


def template_table(spark: SparkSession, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    return spark.createDataFrame(sorted(templates.items()), "license string, template string")


def word_array(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def band_settings(n: int, containment: float = CONTAINMENT, miss: float = MISS,
                  shingle: int = SHINGLE) -> tuple[int, int]:
    """(bands, rows per band) for templates of n words: the most rows for which at
    most MAX_BANDS bands keep the chance of no collision under ``miss`` at the
    least Jaccard similarity that the containment allows."""
    k = min(shingle, n)
    mine, window = n - k + 1, 2 * n - k + 1
    least = containment * mine / (window + (1 - containment) * mine)
    best = None
    for rows in range(1, 5):
        bands = math.ceil(math.log(miss) / math.log(1 - least ** rows)) if least < 1 else 1
        if bands <= MAX_BANDS or best is None:
            best = (bands, rows)
    return best


def _shingles(w: Column, k: Column) -> Column:
    """Distinct k-word shingles (the whole sequence when it is shorter)."""
    last = F.greatest(F.size(w) - k, F.lit(0))
    return F.array_distinct(F.transform(F.sequence(F.lit(0), last),
                                        lambda i: F.array_join(F.slice(w, i + 1, k), " ")))


def _low(sh: Column, n: Column) -> Column:
    """n MinHash values."""
    return F.transform(F.sequence(F.lit(0), n - 1), lambda j: F.array_min(F.transform(sh, lambda x: F.xxhash64(x, j))))


def _bands(low: Column, bands: Column, rows: Column) -> Column:
    """Hash of every band of MinHash values."""
    return F.transform(F.sequence(F.lit(0), bands - 1), lambda b: F.xxhash64(F.slice(low, b * rows + 1, rows)))


def _hash_runs(w: Column, k: int) -> Column:
    return F.when(F.size(w) >= k, F.transform(
        F.sequence(F.lit(0), F.size(w) - k),
        lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))).otherwise(F.array().cast("array<bigint>"))


def scan(docs: DataFrame, templates: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         containment: float = CONTAINMENT) -> DataFrame:
    """(id, license, containment, first_word, n_windows): one row per id and
    license found; texts without a license do not appear.

    ``templates`` has columns license and template, and is a pattern list: its
    runs of words become literals of the plan, so it must be small (it is
    checked: 100,000 words at most).  NULL and empty texts and templates match
    nothing; templates shorter than the anchor are looked for as they are.
    Rows that repeat an id are reported together.
    """
    t = (templates.select("license", word_array(F.col("template")).alias("_w")).filter(F.size("_w") > 0)
         .withColumn("_n", F.size("_w")).withColumn("_k", F.least(F.lit(SHINGLE), F.col("_n"))))
    known = t.select("license", "_n", "_w").collect()
    if sum(r["_n"] for r in known) > 100_000:
        raise ValueError("templates: scan at most 100,000 words at once, in parts")
    anchor = min([ANCHOR, *(r["_n"] for r in known)])
    own = {r["_n"]: r["_runs"] for r in t.withColumn("_r", F.explode(_hash_runs(F.col("_w"), anchor)))
           .groupBy("_n").agg(F.collect_set("_r").alias("_runs")).collect()}
    if not own:
        own = {1: [0]}
    # one entry per template length: its band settings and its runs of words
    classes = F.array(*[F.struct(
        F.lit(n).alias("n"), F.lit(band_settings(n, containment)[0]).alias("bands"),
        F.lit(band_settings(n, containment)[1]).alias("rows"),
        F.array(*[F.lit(r).cast("long") for r in sorted(runs)]).alias("runs")) for n, runs in sorted(own.items())])
    every = sorted({r for runs in own.values() for r in runs})

    d = docs.select(F.col(id_col).alias("_id"), word_array(F.col(text_col)).alias("_w"))
    d = d.withColumn("_h", _hash_runs(F.col("_w"), anchor))
    # the row number keeps the filter below from being pushed into the arrays
    # above, which would compute them once per element
    d = d.select("_id", "_w", "_h", F.monotonically_increasing_id().alias("_row"),
                 F.filter(F.sequence(F.lit(0), F.size("_h")),
                          lambda i: F.coalesce(F.get("_h", i).isin(*every), F.lit(False))).alias("_at"))
    d = d.filter(F.size("_at") > 0).withColumn("_c", F.explode(classes))
    n = F.col("_c.n")
    # the windows of this length (start j * n) that hold a run of its templates at place p
    d = d.withColumn("_j", F.explode(F.array_distinct(F.flatten(F.transform(
        F.filter("_at", lambda p: F.array_contains(F.col("_c.runs"), F.get("_h", p))),
        lambda p: F.array(F.floor(p / n), F.greatest(F.floor(p / n) - 1, F.lit(0))))))))
    d = d.select("_id", "_row", n.alias("_n"), "_j", F.col("_c.bands").alias("_bands"), F.col("_c.rows").alias("_rows"),
                 _shingles(F.slice("_w", (F.col("_j") * n + 1).cast("int"), 2 * n),
                           F.least(F.lit(SHINGLE), n)).alias("_sh"))
    windows = staged(d, "license-windows")
    windows = staged(windows.withColumn("_low", _low(F.col("_sh"), F.col("_bands") * F.col("_rows"))), "license-signed")

    t = t.withColumn("_c", F.filter(classes, lambda c: c["n"] == F.col("_n"))[0])
    t = t.withColumn("_tsh", _shingles(F.col("_w"), F.col("_k")))
    keys = t.select(F.col("_n").alias("_tn"), "license", F.posexplode(_bands(
        _low(F.col("_tsh"), F.col("_c.bands") * F.col("_c.rows")), F.col("_c.bands"), F.col("_c.rows"))).alias("_tb", "_tkey"))
    keys = staged(keys, "license-keys")
    signed = windows.select("_row", "_n", "_j", F.posexplode(
        _bands(F.col("_low"), F.col("_bands"), F.col("_rows"))).alias("_band", "_key"))
    pairs = (signed.join(keys, (F.col("_n") == F.col("_tn")) & (F.col("_band") == F.col("_tb"))
                         & (F.col("_key") == F.col("_tkey")))
             .select("_row", "_n", "_j", "license").distinct())
    exact = windows.drop("_low").join(pairs, ["_row", "_n", "_j"]).join(t.select("license", "_tsh"), "license")
    share = F.size(F.array_intersect("_tsh", "_sh")) / F.size("_tsh")
    hit = exact.withColumn("_share", share).filter(F.col("_share") >= containment)
    return hit.groupBy(F.col("_id").alias(id_col), "license").agg(
        F.max("_share").alias("containment"),
        F.min(F.col("_j") * F.col("_n")).cast("long").alias("first_word"),
        F.count_distinct("_j").alias("n_windows"))

"""License notices in texts: MinHash bands over overlapping windows, verified by shingle containment."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.base import query, table

# Short notices that name a license.
NOTICES: Mapping[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted"
                    " provided that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
                " associated documentation files",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

WIDTH = 5
#: Shingles of all templates together; they are literals of the plan.
MAX_SHINGLES = 100_000


def _words(text: str) -> Column:
    lowered = F.lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    return F.filter(F.split(lowered, r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(words: str) -> Column:
    """Hash of the words from each position on; empty for fewer than ``WIDTH`` words."""
    return F.when(F.size(words) >= WIDTH, F.transform(
        F.sequence(F.lit(0), F.size(words) - WIDTH),
        lambda i: F.xxhash64(*[F.get(F.col(words), i + k) for k in range(WIDTH)]))).otherwise(F.array().cast("array<bigint>"))


def _signature(shingles: Column, bands: int, rows: int) -> Column:
    """One value per band, from ``rows`` minima of seeded hashes each."""
    def least(seed: int) -> Column:
        return F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, F.lit(seed))))

    return F.array(*[F.xxhash64(F.lit(b), *[least(b * rows + r) for r in range(rows)]) for b in range(bands)])


def bands_for(similarity: float, rows: int, certainty: float) -> int:
    """Bands needed for two sets of this similarity to meet in one with this probability."""
    hit = similarity ** rows
    return 1 if hit >= 1 else math.ceil(math.log(1 - certainty) / math.log(1 - hit))


def scan_licenses(docs: DataFrame, notices: Mapping[str, str] = NOTICES, containment: float = 0.75,
                  rows: int = 1, certainty: float = 0.999) -> DataFrame:
    """Notices found in texts: doc_id, license, containment, first_word, n_windows.

    Words are lower-cased runs of letters and digits; shingles are five words. For each length n
    of notice (in shingles), windows of n + s - 1 shingles start every s = max(1, n // 4). An
    occurrence, with words put in or left out, may spread over 2 n positions: two windows cover
    those, so one of them holds at least half of the k = containment * n shingles that have to be there,
    and its similarity with the notice is at least (k / 2) / (2 n + s - 1 - k / 2); bands of ``rows`` minima
    are added until such a pair meets in one with probability ``certainty``. Pairs that meet are then
    counted exactly over the window and n positions on either side, where the whole of
    such an occurrence lies: shared shingles over the notice's shingles.

    A window that shares no shingle with any notice cannot share a minimum with one, so
    signatures are made only for windows around such shingles: an exact cut. Documents are
    scanned in one narrow pass of built-in functions; only the hits are shuffled, by doc_id and
    notice. ``first_word`` is the least position of a shared shingle around a verified window. NULL or
    empty texts and texts under five words give no rows; repeated rows count into one result;
    a NULL doc_id is a group of its own; an empty table gives none. Notices need five words.
    """
    spark = docs.sparkSession
    listed = spark.createDataFrame(sorted(notices.items()), "license string, notice string")
    listed = listed.withColumn("words", _words("notice")).withColumn("set", F.array_distinct(_shingles("words")))
    known = {r["license"]: r["set"] for r in listed.select("license", "set").collect()}
    hashes = sorted({h for s in known.values() for h in s})
    if not all(known.values()) or len(hashes) > MAX_SHINGLES:
        raise ValueError(f"notices need {WIDTH} words each and {MAX_SHINGLES} shingles at most in all")
    sizes = sorted({len(s) for s in known.values()})
    steps = {n: max(1, n // 4) for n in sizes}
    held = {n: math.ceil(math.ceil(containment * n) / 2) for n in sizes}
    bands = max(bands_for(held[n] / (2 * n + steps[n] - 1 - held[n]), rows, certainty) for n in sizes)

    # Positions of shingles of any notice, then the windows that hold one.
    positions = F.filter(F.sequence(F.lit(0), F.size("hashes") - 1),
                         lambda i: F.get(F.col("hashes"), i).isin(hashes))
    spans = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(steps[n]).alias("step"), F.lit(n + steps[n] - 1).alias("width"))
                      for n in sizes])

    def around(at: Column) -> Column:
        return F.flatten(F.transform(spans, lambda c: F.transform(
            F.sequence(F.greatest(F.lit(0), F.floor((at - c["width"]) / c["step"]) + 1).cast("int"),
                       F.floor(at / c["step"]).cast("int")),
            lambda j: F.struct(c["n"].alias("n"), (j * c["step"]).alias("start"), c["width"].alias("width")))))

    windows = (docs.select("doc_id", _words("text").alias("words"))
               .select("doc_id", _shingles("words").alias("hashes"))
               .select("doc_id", "hashes", F.when(F.size("hashes") > 0, positions).alias("at"))
               .select("doc_id", "hashes", F.explode_outer(F.array_distinct(F.flatten(F.transform("at", around)))).alias("w"))
               .where("w IS NOT NULL")
               .withColumn("from", F.greatest(F.lit(0), F.col("w.start") - F.col("w.n")))
               .select("doc_id", "w.n", "w.start", "from", F.slice("hashes", F.col("w.start") + 1, F.col("w.width")).alias("window"),
                       F.slice("hashes", F.col("from") + 1, F.col("w.start") - F.col("from") + F.col("w.width") + F.col("w.n")).alias("span")))
    banded = windows.select("doc_id", "n", "start", "from", "span", F.posexplode(_signature(F.col("window"), bands, rows)).alias("band", "value"))
    templates = listed.select(F.size("set").alias("n"), "license", "set",
                              F.posexplode(_signature(F.col("set"), bands, rows)).alias("band", "value"))
    shared = F.size(F.array_intersect("span", "set"))
    # The templates are broadcast: MAX_SHINGLES bounds them.
    met = banded.join(F.broadcast(templates), ["n", "band", "value"]).withColumn("containment", shared / F.size("set"))
    first = F.array_position(F.transform("span", lambda h: F.array_contains("set", h)), True) - 1 + F.col("from")
    return (met.where(F.col("containment") >= containment).withColumn("first", first)
            .groupBy("doc_id", "license").agg(
                F.max("containment").alias("containment"), F.min("first").cast("long").alias("first_word"),
                F.countDistinct("start").alias("n_windows")))


@query("op2_license_scan")
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))

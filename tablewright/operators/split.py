"""Deterministic splits by key hash: the same rows whatever the file or partition layout."""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import quoted
from ..session import materialize

_HEX_STEP = 4           # 16^4 = 65,536 prefix groups per counting pass
_HEX_TOTAL = 32         # md5 as text


def key_hash(key: str | Sequence[str], seed: int = 42) -> Column:
    """md5 of seed and key as hex text, whose text order is the split order."""
    keys = [key] if isinstance(key, str) else list(key)
    parts = [F.coalesce(quoted(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def split_by_threshold(df: DataFrame, key: str | Sequence[str], size: float,
                       seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """``(rest, part)`` with about ``size`` of the rows in ``part``: no extra pass at all."""
    limit = f"{min(int(size * 16 ** 8), 16 ** 8 - 1):08x}"
    inside = F.substring(key_hash(key, seed), 1, 8) < F.lit(limit)
    return df.filter(~inside), df.filter(inside)


def split_exact(df: DataFrame, key: str | Sequence[str], size: float,
                seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """``(rest, part)`` with exactly ``ceil(n * size)`` rows in ``part``, for a unique key.

    Both sides are plain filters on the hash. The cut is found by counting rows per hash
    prefix, four digits at a time and only under the prefix that holds the cut, so no pass
    returns more than 65,536 counts. Rows sharing a key stay on one side.
    """
    digest = key_hash(key, seed)
    cut = _cut(df.select(digest.alias("digest")), size)
    if cut is None:
        return df, df.limit(0)
    inside = F.substring(digest, 1, len(cut)) <= F.lit(cut)
    return df.filter(~inside), df.filter(inside)


def _cut(digests: DataFrame, size: float) -> str | None:
    """Smallest prefix such that hashes up to it hold the wanted number of rows."""
    found = _cut_and_rest(digests, size)
    return found[0] if found else None


def _cut_and_rest(digests: DataFrame, size: float | Fraction, absolute: bool = False) -> tuple[str, int | None] | None:
    """That prefix, and how many rows of a whole hash are wanted if not all are; ``absolute``: a number of rows."""
    prefix, before, wanted = "", 0, None
    while True:
        length = len(prefix) + _HEX_STEP
        under = digests.filter(F.col("digest").startswith(prefix)) if prefix else digests
        counts = (under.groupBy(F.substring("digest", 1, length).alias("prefix")).count().collect())
        if wanted is None:
            wanted = int(size) if absolute else math.ceil(sum(r["count"] for r in counts) * Fraction(str(size)))
            if wanted == 0:
                return None
        for r in sorted(counts, key=lambda r: r["prefix"]):
            if before + r["count"] >= wanted:
                prefix = r["prefix"]
                break
            before += r["count"]
        if before + r["count"] == wanted or length == _HEX_TOTAL:
            return prefix, None if before + r["count"] == wanted else wanted - before


def split_rows(df: DataFrame, key: str | Sequence[str], size: float, seed: int = 42,
               ) -> tuple[DataFrame, DataFrame]:
    """``(rest, part)`` with exactly ``ceil(n * size)`` rows in ``part``, however often a key is repeated.

    Rows go by the key's hash, and those of the one key on the cut by the hash of their content; both cuts
    are found by counts per prefix. Rows that are equal in all columns and lie on the cut are written once and
    numbered over all tasks: each task counts its own, and the counts' running sums tell where to cut.
    Nothing is sorted, and no group of equal rows meets in one task.
    """
    digest = key_hash(key, seed)
    found = _cut_and_rest(df.select(digest.alias("digest")), size)
    if found is None:
        return df, df.limit(0)
    cut, left = found
    if left is None:
        inside = F.substring(digest, 1, len(cut)) <= F.lit(cut)
        return df.filter(~inside), df.filter(inside)
    # ``left`` rows of the key on the cut go to the part.
    names = [quoted(c) for c in df.columns]
    content = F.md5(F.concat_ws(":", *[p for c in names for p in (F.hex(F.xxhash64(c)), F.hex(F.xxhash64(F.lit(7), c)), c.isNull().cast("string"))]))
    on_cut = digest == F.lit(cut)
    inner = _cut_and_rest(df.filter(on_cut).select(content.alias("digest")), Fraction(left, 1), absolute=True)
    if inner is None:
        return df.filter(digest >= F.lit(cut)), df.filter(digest < F.lit(cut))
    edge, equal = inner
    before = (digest < F.lit(cut)) | (on_cut & (F.substring(content, 1, len(edge)) < F.lit(edge) if equal is not None
                                                else F.substring(content, 1, len(edge)) <= F.lit(edge)))
    if equal is None:
        return df.filter(~before), df.filter(before)
    first, later = _take(materialize(df.filter(on_cut & (content == F.lit(edge))), "equal-rows"), equal)
    after = ~before & ~(on_cut & (content == F.lit(edge)))
    return df.filter(after).union(later), df.filter(before).union(first)


def _take(rows: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """The first ``n`` of written rows and the others, numbered over all tasks by per-task counts."""
    numbered = rows.withColumns({"__task": F.spark_partition_id(), "__row": F.monotonically_increasing_id()})
    per_task = {r["__task"]: r["n"] for r in numbered.groupBy("__task").agg(F.count(F.lit(1)).alias("n")).collect()}
    start, begins = 0, {}
    for task in sorted(per_task):
        begins[task] = start
        start += per_task[task]
    # Only the task in which the n-th row falls is cut; a task's own row numbers begin at its number times 2^33.
    cut_task = max((t for t, b in begins.items() if b < n), default=-1)
    limit = F.lit((cut_task << 33) + n - begins.get(cut_task, 0)).cast("long")
    first = F.col("__row") < limit
    return tuple(numbered.filter(side).drop("__task", "__row") for side in (first, ~first))


def holdout(df: DataFrame, key: str | Sequence[str], size: object, seed: int = 42, *, whole_keys: bool = True,
            ) -> tuple[DataFrame, DataFrame | None]:
    """Holdout split as configured: only for a float size strictly between 0 and 1.

    Rows of one key stay on one side; ``whole_keys=False`` splits the key on the cut, for exact sizes.
    """
    if not isinstance(size, float) or not 0 < size < 1:
        return df, None
    return (split_exact if whole_keys else split_rows)(df, key, size, seed)


def train_test(df: DataFrame, key: str | Sequence[str], test_size: float = 0.2, seed: int = 42,
               *, exact: bool = True, whole_keys: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(train, test)``; the seed is salted so that it is independent of the holdout."""
    salted = seed * 2 + 1
    if not whole_keys:
        return split_rows(df, key, test_size, salted)
    if exact:
        return split_exact(df, key, test_size, salted)
    return split_by_threshold(df, key, test_size, salted)

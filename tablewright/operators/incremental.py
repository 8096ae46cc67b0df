"""Refitting on one more version of a dataset: moments kept per version, added and taken away."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from ..sources import sinks
from ..sources.tables import path_exists
from .regression import LinearModel, Moments, moments, train


def add(a: Moments, b: Moments) -> Moments:
    """Moments of the rows of both; centred sums are moved to the common mean."""
    _same_columns(a, b)
    n = a.n + b.n
    if a.n == 0 or b.n == 0:
        whole = b if a.n == 0 else a
        return Moments(a.columns, n, a.rows_dropped + b.rows_dropped, whole.mean, whole.comoment)
    gap = b.mean - a.mean
    return Moments(a.columns, n, a.rows_dropped + b.rows_dropped, a.mean + gap * (b.n / n),
                   a.comoment + b.comoment + np.outer(gap, gap) * (a.n * b.n / n))


def take_away(a: Moments, b: Moments) -> Moments:
    """Moments of the rows of ``a`` without those of ``b``, which are among them."""
    _same_columns(a, b)
    n = a.n - b.n
    if n < 0 or a.rows_dropped < b.rows_dropped:
        raise ValueError("cannot take away more rows than there are")
    dropped = a.rows_dropped - b.rows_dropped
    if n == 0:
        return Moments(a.columns, 0, dropped, np.zeros_like(a.mean), np.zeros_like(a.comoment))
    if b.n == 0:
        return Moments(a.columns, n, dropped, a.mean, a.comoment)
    mean = a.mean + (a.mean - b.mean) * (b.n / n)
    gap = b.mean - mean
    return Moments(a.columns, n, dropped, mean, a.comoment - b.comoment - np.outer(gap, gap) * (n * b.n / a.n))


def _same_columns(a: Moments, b: Moments) -> None:
    if a.columns != b.columns:
        raise ValueError(f"moments of different columns: {sorted(set(a.columns) ^ set(b.columns)) or 'another order'}")


def moments_frame(spark: SparkSession, found: Moments) -> DataFrame:
    """One row per column: its name, place, mean and comoments with itself and the columns after it."""
    rows = [(i, c, found.n, found.rows_dropped, float(found.mean[i]), found.comoment[i, i:].tolist()) for i, c in enumerate(found.columns)]
    return spark.createDataFrame(rows, "place int, name string, n long, rows_dropped long, mean double, comoments array<double>")


def moments_from_frame(frame: DataFrame) -> Moments:
    """Read back :func:`moments_frame`; its size depends on the number of columns only."""
    rows = frame.orderBy("place").collect()
    size = len(rows)
    comoment = np.zeros((size, size))
    for i, r in enumerate(rows):
        comoment[i, i:] = comoment[i:, i] = r["comoments"]
    return Moments(tuple(r["name"] for r in rows), rows[0]["n"], rows[0]["rows_dropped"], np.array([r["mean"] for r in rows]), comoment)


def version_moments(spark: SparkSession, root: str, name: str, version: int, columns: Sequence[str], state: str,
                    prepare: Callable[[DataFrame], DataFrame] | None = None) -> tuple[Moments, bool]:
    """Moments of one version, from the stored state or from its rows; and whether the rows were read.

    Versions never change, so neither does their state; it is stored per version and list of columns.
    ``prepare`` makes the columns from a version's rows; it must not depend on other versions.
    """
    path = f"{state.rstrip('/')}/{name}/version={version}"
    if path_exists(spark, f"{path}/_SUCCESS"):
        found = moments_from_frame(spark.read.parquet(path))
        if found.columns == tuple(columns):
            return found, False
    rows = sinks.read_dataset(spark, root, f"{name}:{version}")
    found = moments(prepare(rows) if prepare else rows, columns)
    sinks.write_table(moments_frame(spark, found).coalesce(1), path)
    return found, True


def refit(spark: SparkSession, root: str, name: str, target: str, candidates: Sequence[str], state: str, *,
          versions: Sequence[int] | None = None, prepare: Callable[[DataFrame], DataFrame] | None = None,
          **options) -> tuple[LinearModel, list[int]]:
    """The model of all rows of the versions (default: all), and the versions whose rows had to be read.

    Each version is a part of the data. After one more was published only that one is read; a version left
    out is simply not added. The result is that of a fit on all rows together. ``options`` are those of
    ``regression.train``.
    """
    chosen = sinks.dataset_versions(spark, root, name) if versions is None else list(dict.fromkeys(versions))
    if not chosen:
        raise FileNotFoundError(f"No version of dataset '{name}' under {root}")
    columns = list(dict.fromkeys([*candidates, target]))
    parts = [version_moments(spark, root, name, v, columns, state, prepare) for v in chosen]
    model = train(reduce(add, [m for m, _ in parts]), target, candidates, **options)
    return model, [v for v, (_, read) in zip(chosen, parts) if read]

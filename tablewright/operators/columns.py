"""Projections, renames, filters and key joins that tolerate absent columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import numeric_columns, quoted


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the named columns that exist; the rest of the list is ignored."""
    present = [n for n in names if n in df.columns]
    return df.drop(*present) if present else df


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(subset) if subset else None)


def select_numeric(df: DataFrame, *, exclude: Iterable[str] = (), profiling: Iterable[str] = (),
                   target: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Numeric feature columns in table order.

    ``target`` never counts as a feature. ``keep`` names columns carried along in front
    whatever their type, such as the row key and the target itself.
    """
    skip = {*exclude, *profiling, *keep} | ({target} if target else set())
    return df.select(*[quoted(c) for c in (*keep, *numeric_columns(df, skip))])


def where_equal(df: DataFrame, name: str, value: Any) -> DataFrame:
    return df.filter(quoted(name) == F.lit(value))


def strip_prefixes(df: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """Remove the first matching prefix, once, from every column name."""
    renames = {}
    for name in df.columns:
        hit = next((p for p in prefixes if name.startswith(p)), None)
        if hit:
            renames[name] = name[len(hit):]
    return df.withColumnsRenamed(renames) if renames else df


def rename_columns(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns})


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return [n for n in required if n not in df.columns]


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    absent = missing_columns(df, required)
    if absent:
        raise ValueError(f"table lacks columns {absent}")
    return df


def project_as_double(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Select ``names`` in the given order as doubles, after the ``keep`` columns."""
    require_columns(df, names)
    return df.select(*[quoted(c) for c in keep],
                     *[quoted(c).cast("double").alias(c) for c in names])


def fill_missing_columns(df: DataFrame, names: Iterable[str], value: float | int = 0.0) -> DataFrame:
    return add_columns(df, {n: F.lit(value) for n in names})


def add_columns(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    """Append columns; a name the table already has keeps its first meaning."""
    fresh = {n: c for n, c in new.items() if n not in df.columns}
    return df.withColumns(fresh) if fresh else df


def add_intercept(df: DataFrame, name: str = "const") -> DataFrame:
    return df.select(F.lit(1.0).alias(name), *[quoted(c) for c in df.columns if c != name])


def transpose(df: DataFrame, id_columns: Sequence[str], columns: Sequence[str] | None = None,
              name: str = "column", value: str = "value") -> DataFrame:
    """Long form of a wide table: one row per id and column, values as text."""
    chosen = list(columns) if columns else [c for c in df.columns if c not in id_columns]
    texts = df.select(*[quoted(c) for c in id_columns],
                      *[quoted(c).cast("string").alias(c) for c in chosen])
    return texts.unpivot([quoted(c) for c in id_columns], [quoted(c) for c in chosen], name, value)


# --- alignment of two tables on an explicit key ------------------------------------------

def align_inner(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose key both tables hold."""
    return left.join(right, key, "inner")


def unmatched(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` that an inner alignment drops."""
    keys = [key] if isinstance(key, str) else list(key)
    # Distinct first: copies of one key collapse before the shuffle.
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def attach_left(base: DataFrame, extra: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Every row of ``base``, with the columns of ``extra`` where the key matches."""
    return base.join(extra, key, "left")

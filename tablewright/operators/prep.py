"""Outlier filter, imputation and scaling; fitted state is a small parameter table."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import is_numeric, number, quoted
from .profile import top_values
from .quantiles import quantiles

log = logging.getLogger(__name__)

IMPUTATION = ("mean", "median", "most_frequent", "constant")


# --- outliers ------------------------------------------------------------------------------

def iqr_bounds(df: DataFrame, column: str, k: float = 1.5, *, skip_zero_iqr: bool = True,
               accuracy: int | None = None) -> tuple[float, float] | None:
    """Inclusive limits ``Q1 - k IQR .. Q3 + k IQR``; None where the filter does not apply."""
    q1, q3 = quantiles(df, [column], (0.25, 0.75), accuracy)[column]
    if q1 is None or (q3 == q1 and skip_zero_iqr):
        return None
    return q1 - k * (q3 - q1), q3 + k * (q3 - q1)


def filter_outliers(df: DataFrame, columns: Sequence[str], k: float = 1.5, *,
                    skip_zero_iqr: bool = True, accuracy: int | None = None) -> DataFrame:
    """Filter column after column; each one's quartiles come from the rows still kept.

    Columns that are absent, not numeric or without spread are skipped. Where a filter
    applies, rows missing that value go too (NaN orders above every limit and goes as
    well). Each step is a plain range predicate that reaches the scan.
    """
    for column in columns:
        if not is_numeric(df, column):
            log.warning("outlier column %r is absent or not numeric; skipped", column)
            continue
        limits = iqr_bounds(df, column, k, skip_zero_iqr=skip_zero_iqr, accuracy=accuracy)
        if limits is not None:
            df = df.filter(quoted(column).between(F.lit(limits[0]), F.lit(limits[1])))
    return df


# --- imputation and scaling ----------------------------------------------------------------

@dataclass(frozen=True)
class ColumnTransform:
    """``(coalesce(x, fill) - offset) / divisor``; ``fill`` None leaves missing values."""

    column: str
    fill: float | None
    offset: float
    divisor: float

    def expression(self, value: Column) -> Column:
        if self.fill is not None:
            value = F.coalesce(value, F.lit(self.fill))
        if self.offset != 0.0:
            value = value - F.lit(self.offset)
        return value if self.divisor == 1.0 else value / F.lit(self.divisor)


@dataclass(frozen=True)
class Preprocessor:
    """Fitted imputation and scaling of several columns."""

    transforms: tuple[ColumnTransform, ...]

    @property
    def columns(self) -> list[str]:
        return [t.column for t in self.transforms]

    def frame(self, spark: SparkSession) -> DataFrame:
        """As the parameter table ``position, column, stat, value``."""
        rows = [(i, t.column, stat, value) for i, t in enumerate(self.transforms)
                for stat, value in (("fill", t.fill), ("offset", t.offset), ("divisor", t.divisor))]
        return spark.createDataFrame(rows, "position int, column string, stat string, value double")

    @classmethod
    def from_frame(cls, frame: DataFrame) -> Preprocessor:
        wide: dict[tuple[int, str], dict[str, float | None]] = {}
        for r in frame.collect():
            wide.setdefault((r["position"], r["column"]), {})[r["stat"]] = r["value"]
        return cls(tuple(ColumnTransform(c, v["fill"], v["offset"], v["divisor"])
                         for (_, c), v in sorted(wide.items())))


def fit_preprocessor(df: DataFrame, columns: Sequence[str], *, strategy: str | None = "mean",
                     method: str | None = "minmax", fill_value: float = 0.0,
                     accuracy: int | None = None) -> Preprocessor:
    """Learn fill values and scaling.

    Mean and constant imputation need one aggregation in all; the statistics after filling
    follow from those before it, so filled data are never scanned again. ``strategy`` None
    turns imputation off; a ``method`` other than minmax or standard imputes only.
    """
    absent = [c for c in columns if not is_numeric(df, c)]
    if absent:
        raise ValueError(f"Columns to scale are absent or not numeric: {absent}")
    if strategy is not None and strategy not in IMPUTATION:
        raise ValueError(f"Unknown imputation strategy '{strategy}'")
    method = (method or "none").lower()
    if method not in ("minmax", "standard"):
        log.warning("unsupported scaling method %r; imputing only", method)
    if not columns:
        return Preprocessor(())
    measures = {"n": F.count, "mean": F.avg, "var": F.var_pop, "lo": F.min, "hi": F.max}
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[
        make(number(df, c)).alias(f"{m}_{i}")
        for i, c in enumerate(columns) for m, make in measures.items()]).first()
    sizes = {c: row[f"n_{i}"] for i, c in enumerate(columns)}
    medians = quantiles(df, columns, (0.5,), accuracy, sizes) if strategy == "median" else {}
    modes = ({r["column"]: r["top"] for r in top_values(df, columns, "double").collect()}
             if strategy == "most_frequent" else {})

    transforms = []
    for i, c in enumerate(columns):
        n, mean, var, lo, hi = (row[f"{m}_{i}"] for m in measures)
        fill = {None: lambda: None, "mean": lambda: mean, "median": lambda: medians[c][0],
                "most_frequent": lambda: modes.get(c),
                "constant": lambda: float(fill_value)}[strategy]()
        gaps = row["rows"] - n
        if fill is not None and gaps:
            n, mean, var, lo, hi = _after_filling(n, mean, var, lo, hi, gaps, fill)
        transforms.append(ColumnTransform(c, fill, *_scaling(method, mean, var, lo, hi)))
    return Preprocessor(tuple(transforms))


def _after_filling(n, mean, var, lo, hi, gaps, fill):
    """Statistics of a column once ``gaps`` missing values hold ``fill``."""
    if n == 0:
        return gaps, fill, 0.0, fill, fill
    rows = n + gaps
    new_mean = (n * mean + gaps * fill) / rows
    new_var = (n * (var + (mean - new_mean) ** 2) + gaps * (fill - new_mean) ** 2) / rows
    return rows, new_mean, new_var, min(lo, fill), max(hi, fill)


def _scaling(method: str, mean, var, lo, hi) -> tuple[float, float]:
    if mean is None:
        return 0.0, 1.0
    if method == "minmax":
        return lo, (hi - lo) or 1.0
    if method == "standard":
        return mean, var ** 0.5 or 1.0
    return 0.0, 1.0


def fit_imputer(df: DataFrame, columns: Sequence[str], strategy: str = "mean", *,
                fill_value: float = 0.0, accuracy: int | None = None) -> Preprocessor:
    """Imputation without scaling."""
    fitted = fit_preprocessor(df, columns, strategy=strategy, method="minmax",
                              fill_value=fill_value, accuracy=accuracy)
    return Preprocessor(tuple(ColumnTransform(t.column, t.fill, 0.0, 1.0)
                              for t in fitted.transforms))


def transform(df: DataFrame, fitted: Preprocessor) -> DataFrame:
    """Fit-time layout: the fitted columns first, then the others, original names."""
    missing = [c for c in fitted.columns if c not in df.columns]
    if missing:
        raise ValueError(f"Columns to scale are absent: {missing}")
    scaled = [t.expression(number(df, t.column)).alias(t.column) for t in fitted.transforms]
    return df.select(*scaled, *[quoted(c) for c in df.columns if c not in fitted.columns])


def apply_stored(df: DataFrame, fitted: Preprocessor) -> DataFrame:
    """Score-time layout: transform by name what exists and is numeric, keep the order."""
    usable = {t.column: t for t in fitted.transforms if is_numeric(df, t.column)}
    for t in fitted.transforms:
        if t.column not in usable:
            log.warning("column %r is absent or not numeric; not transformed", t.column)
    return df.select(*[usable[c].expression(number(df, c)).alias(c) if c in usable else quoted(c)
                       for c in df.columns])

"""Profiling: shape, duplicates, summaries, null audit, histograms, correlations, labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import label_list
from ..schema import is_numeric, number, numeric_columns, quoted
from .frequent import frequent_values, text_tops
from .quantiles import quantiles
from .regression import pairwise_correlation


def shape(df: DataFrame) -> DataFrame:
    """One row: n_rows, n_cols and the column names in order."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("long").alias("n_cols"),
        F.lit(",".join(df.columns)).alias("columns"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: rows beyond the first copy of each distinct row; NULLs equal each other.

    Rows are told apart by two 64-bit hashes of all their columns, so that 16 bytes a row are shuffled, not
    the row. Copies are counted map-side first, so a row repeated in a third of the table costs
    one partial count per task.
    """
    # Hashes pass over NULLs, hence a mark for each.
    cells = [part for c in df.columns for part in (quoted(c), quoted(c).isNull())]
    digest = df.select(F.xxhash64(*cells).alias("h1"), F.xxhash64(F.lit(7), *reversed(cells)).alias("h2"))
    copies = digest.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("long")
                      .alias("n_duplicates"))


def head(df: DataFrame, key: str | Sequence[str], n: int = 100) -> DataFrame:
    """First ``n`` rows in key order (a top-n per task, then one merge of those)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(*[quoted(k) for k in keys]).limit(n)


def random_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows in pseudo-random key order: reproducible for any partitioning."""
    mix = F.md5(F.concat(F.lit(f"{seed}:"), quoted(key).cast("string")))
    return df.orderBy(mix, quoted(key)).limit(n)


def schema_listing(df: DataFrame) -> DataFrame:
    """Per column: position, type and non-null count."""
    types = F.create_map(*[F.lit(x) for f in df.schema
                           for x in (f.name, f.dataType.simpleString())])
    order = F.create_map(*[F.lit(x) for i, f in enumerate(df.schema) for x in (f.name, i)])
    audit = null_audit(df)
    return audit.select(order[F.col("column")].cast("long").alias("position"), "column",
                        types[F.col("column")].alias("dtype"),
                        (F.col("n_rows") - F.col("n_null")).alias("non_null"))


def null_audit(df: DataFrame) -> DataFrame:
    """Per column: n_null, n_rows and the null percentage. One scan for all columns."""
    missing = {c: (number(df, c) if is_numeric(df, c) else quoted(c)).isNull() for c in df.columns}
    counted = df.agg(F.count(F.lit(1)).alias("__rows"),
                     *[F.count_if(m).alias(c) for c, m in missing.items()])
    return (counted.unpivot(["__rows"], [quoted(c) for c in df.columns], "column", "n_null")
            .select("column", "n_null", F.col("__rows").alias("n_rows"),
                    F.try_divide(F.lit(100.0) * F.col("n_null"), F.col("__rows"))
                    .alias("null_pct")))


def value_frequencies(df: DataFrame, columns: Sequence[str], as_type: str = "string") -> DataFrame:
    """``(column, value, freq)`` of the non-null values of several columns in one scan."""
    values = df.select(*[
        (number(df, c) if as_type == "double" else quoted(c).cast(as_type)).alias(c)
        for c in columns])
    return (_long(values, "value").groupBy("column", "value")
            .agg(F.count(F.lit(1)).alias("freq")))


def _long(values: DataFrame, name: str) -> DataFrame:
    """Columns of one type as ``(column, <name>)`` rows without NULLs, inside generated code."""
    return (values.unpivot([], [quoted(c) for c in values.columns], "column", name)
            .filter(F.col(name).isNotNull()))


def top_values(df: DataFrame, columns: Sequence[str], as_type: str = "string") -> DataFrame:
    """Per column: number of distinct values, the most frequent one and its frequency.

    Equal frequencies go to the smallest value.
    """
    return (value_frequencies(df, columns, as_type).groupBy("column")
            .agg(F.count(F.lit(1)).alias("unique"), F.max("freq").alias("freq"),
                 F.min_by("value", F.struct(-F.col("freq"), F.col("value"))).alias("top")))


def summary(df: DataFrame, columns: Sequence[str] | None = None,
            accuracy: int | None = None) -> DataFrame:
    """Per column: count, unique, top, freq, mean, std, min, quartiles, max, earliest and latest.

    Measures that do not apply to a column's type are NULL. Numeric measures come from one
    aggregation plus the quantile passes; text measures from one count by digest.
    """
    chosen = list(columns) if columns else df.columns
    numeric = [c for c in chosen if is_numeric(df, c)]
    other = [c for c in chosen if c not in numeric]
    spark = df.sparkSession
    measures = ("count", "mean", "std", "min", "max")
    aggs = []
    for i, c in enumerate(numeric):
        v = number(df, c)
        aggs += [a.alias(f"{m}_{i}") for m, a in zip(measures, (
            F.count(v), F.avg(v), F.stddev_samp(v), F.min(v), F.max(v)))]
    aggs += [F.count(quoted(c)).alias(f"filled_{i}") for i, c in enumerate(other)]
    dated = {c for c in other if isinstance(df.schema[c].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))}
    aggs += [ends(quoted(c)).cast("string").alias(f"{m}_{i}") for i, c in enumerate(other) if c in dated
             for m, ends in (("earliest", F.min), ("latest", F.max))]
    stats = df.agg(*aggs).first()
    quartiles = quantiles(df, numeric, (0.25, 0.5, 0.75), accuracy,
                          {c: stats[f"count_{i}"] for i, c in enumerate(numeric)})
    tops = {r["column"]: r for r in text_tops(df, other).collect()} if other else {}

    rows = []
    for c in chosen:
        if c in numeric:
            i = numeric.index(c)
            q25, q50, q75 = quartiles[c]
            count, mean, std, low, high = (stats[f"{m}_{i}"] for m in measures)
            rows.append((c, count, None, None, None, mean, std, low, q25, q50, q75, high, None, None))
        else:
            t = tops.get(c)
            i = other.index(c)
            span = [stats[f"earliest_{i}"], stats[f"latest_{i}"]] if c in dated else [None, None]
            rows.append((c, stats[f"filled_{i}"], t["unique"] if t else 0,
                         t["top"] if t else None, t["freq"] if t else None, *[None] * 7, *span))
    return spark.createDataFrame(rows, (
        "column string, count long, unique long, top string, freq long, mean double, std double,"
        " min double, q25 double, q50 double, q75 double, max double, earliest string, latest string"))


def histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = 20,
              bounds: tuple[float, float] | None = None) -> DataFrame:
    """Equal-width bins per numeric column: ``column, bin, lower, upper, count``.

    Bins span the column's own minimum and maximum unless ``bounds`` are given; the last
    one includes its upper edge, and empty bins are listed. A constant column gets bins
    over half a unit either side.
    """
    chosen = list(columns) if columns else numeric_columns(df)
    values = {c: number(df, c) for c in chosen}
    if bounds is None:
        ends = df.agg(*[a for i, c in enumerate(chosen) for a in (
            F.min(values[c]).alias(f"lo_{i}"), F.max(values[c]).alias(f"hi_{i}"))]).first()
        spans = {c: (ends[f"lo_{i}"], ends[f"hi_{i}"]) for i, c in enumerate(chosen)}
    else:
        spans = {c: bounds for c in chosen}
    spans = {c: (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)
             for c, (lo, hi) in spans.items() if lo is not None}
    if not spans:
        return df.sparkSession.createDataFrame(
            [], "column string, bin int, lower double, upper double, count long")

    slots = []
    for c, (lo, hi) in spans.items():
        v = values[c]
        slot = F.least(F.floor((v - F.lit(lo)) / F.lit((hi - lo) / bins)) + 1, F.lit(bins))
        inside = v.between(F.lit(lo), F.lit(hi))
        slots.append(F.when(inside, slot.cast("int")).alias(c))
    counts = (_long(df.select(*slots), "bin").groupBy("column", "bin")
              .agg(F.count(F.lit(1)).alias("count")))
    # The grid has bins x columns rows: its size is set by the schema, not by the data.
    grid = df.sparkSession.createDataFrame(
        [(c, b, lo + (hi - lo) / bins * (b - 1), lo + (hi - lo) / bins * b if b < bins else hi)
         for c, (lo, hi) in spans.items() for b in range(1, bins + 1)],
        "column string, bin int, lower double, upper double")
    return (grid.join(counts, ["column", "bin"], "left")
            .select("column", "bin", "lower", "upper",
                    F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlations in long form ``a, b, r``, over rows where both are present."""
    chosen = list(columns) if columns else numeric_columns(df)
    matrix = pairwise_correlation(df, chosen)
    rows = [(a, b, None if matrix[i, j] != matrix[i, j] else float(matrix[i, j]))
            for i, a in enumerate(chosen) for j, b in enumerate(chosen)]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def strong_correlations(pairs: DataFrame, threshold: float = 0.35) -> DataFrame:
    """Keep each cell's r only where its size exceeds the threshold, else NULL."""
    return pairs.select("a", "b", F.when(F.abs("r") > threshold, F.col("r")).alias("r"))


def explode_labels(df: DataFrame, column: str, separator: str = "; ",
                   name: str = "label") -> DataFrame:
    """One row per label of a multi-label text column, other columns repeated."""
    return df.withColumn(name, F.explode(label_list(quoted(column), separator)))


def top_labels(df: DataFrame, column: str, n: int = 20, separator: str = "; ", *, few: bool = True) -> DataFrame:
    """The ``n`` most frequent labels; equal counts in label order.

    ``few=False`` is for labels of very many kinds: they are found by a summary instead of grouping them all.
    """
    if not few:
        labels = df.select(F.explode(label_list(quoted(column), separator)).alias("label"))
        return frequent_values(labels, ["label"], n).select(F.col("value").alias("label"), F.col("freq").alias("count"))
    return (df.select(F.explode(label_list(quoted(column), separator)).alias("label"))
            .groupBy("label").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "label").limit(n))

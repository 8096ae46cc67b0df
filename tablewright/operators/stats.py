"""Aggregations: regression metrics, group summaries and profiles, analysis of variance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tails import f_upper
from ..schema import number, numeric_columns, quoted
from ..session import materialize
from .regression import LinearModel, predict

METRICS = ("mse", "rmse", "mae", "r2", "adj_r2", "mape")

#: Most distinct groups the wide profile may turn into columns.
WIDE_GROUP_LIMIT = 1_000


def regression_metrics(df: DataFrame, actual: str, predicted: str, num_features: int) -> DataFrame:
    """One row ``mse, rmse, mae, r2, adj_r2, mape, n``; undefined measures are NULL.

    One aggregation. Rows in which either side is missing are left out.
    """
    pairs = (df.select(number(df, actual).alias("y"), number(df, predicted).alias("p"))
             .na.drop("any").select("y", (F.col("y") - F.col("p")).alias("e")))
    sums = pairs.agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("e") * F.col("e")).alias("mse"),
        F.avg(F.abs("e")).alias("mae"), F.var_pop("y").alias("spread"),
        F.avg(F.when(F.col("y") != 0, F.abs(F.col("e") / F.col("y")))).alias("relative"))
    n, mse, spread = F.col("n"), F.col("mse"), F.col("spread")
    r2 = (F.when(n < 2, F.lit(None)).when(spread > 0, 1 - F.try_divide(mse, spread))
          .when(mse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    free = n - F.lit(num_features + 1)
    return sums.withColumn("r2", F.when(n > 0, r2)).select(
        "mse", F.sqrt("mse").alias("rmse"), "mae", "r2",
        F.when(free > 0, 1 - (1 - F.col("r2")) * F.try_divide(n - 1, free)).alias("adj_r2"),
        (F.col("relative") * 100).alias("mape"), "n")


def aligned_metrics(actual: DataFrame, predicted: DataFrame, key: str | Sequence[str], y: str,
                    p: str, num_features: int, *, strict: bool = False) -> DataFrame:
    """Metrics over the keys both tables hold; ``strict`` insists on equal row counts."""
    if strict:
        left, right = actual.count(), predicted.count()
        if left != right:
            raise ValueError(f"{left} actual rows but {right} predicted ones")
    return regression_metrics(actual.join(predicted, key, "inner"), y, p, num_features)


def evaluate(df: DataFrame, model: LinearModel, *, target: str | None = None,
             split_label: str | None = None) -> DataFrame:
    """Score a table that holds features and target, and reduce it to metrics."""
    scored = predict(df, model, interval=False)
    metrics = regression_metrics(scored, target or model.target, "prediction", len(model.features))
    return metrics if split_label is None else metrics.withColumn("split", F.lit(split_label))


def round_metrics(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every floating column, for reports."""
    kinds = dict(df.dtypes)
    return df.select(*[F.round(quoted(c), digits).alias(c) if kinds[c] in ("double", "float")
                       else quoted(c) for c in df.columns])


def fit_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Slope and intercept of the straight line through (x, y)."""
    return df.agg(F.regr_slope(number(df, y), number(df, x)).alias("slope"),
                  F.regr_intercept(number(df, y), number(df, x)).alias("intercept"))


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """One row with the number of rows each condition holds for."""
    return df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def column_means(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    chosen = list(columns) if columns else numeric_columns(df)
    means = df.agg(*[F.avg(number(df, c)).alias(c) for c in chosen])
    return means.unpivot([], [quoted(c) for c in chosen], "column", "mean")


def _grouped(df: DataFrame, group: str, null_group: bool) -> DataFrame:
    """Rows to group; those without a group are left out unless they are to form one."""
    return df if null_group else df.where(quoted(group).isNotNull())


def group_summary(df: DataFrame, group: str, counted: str, averaged: Sequence[str], *,
                  null_group: bool = False) -> DataFrame:
    """Per group: non-null count of one column and means of others."""
    return _grouped(df, group, null_group).groupBy(quoted(group)).agg(
        F.count(quoted(counted)).alias(f"{counted}_count"),
        *[F.avg(number(df, c)).alias(f"{c}_mean") for c in averaged])


def group_means(df: DataFrame, group: str, columns: Sequence[str] | None = None, *,
                null_group: bool = False) -> DataFrame:
    """Long form ``column, group, mean``: any number of groups."""
    chosen = list(columns) if columns else numeric_columns(df, [group])
    means = _grouped(df, group, null_group).groupBy(quoted(group)).agg(*[F.avg(number(df, c)).alias(c) for c in chosen])
    return means.unpivot([quoted(group)], [quoted(c) for c in chosen], "column", "mean")


def group_profile(df: DataFrame, group: str, columns: Sequence[str] | None = None, *,
                  groups: Sequence | None = None, compat: bool = False,
                  max_groups: int = WIDE_GROUP_LIMIT) -> DataFrame:
    """Rows are columns of ``df``, columns are the groups, plus ``Average`` and ``Std.dev``.

    ``Std.dev`` is the sample deviation over the groups; with ``compat`` the average counts
    as one more group in it. Group values become column names, so more than ``max_groups`` of
    them are an error (``group_means`` is the long form). Without ``groups`` the aggregated means
    (columns times groups, no more) are written once, so that the table is scanned only once.
    """
    long = group_means(df, group, columns)
    if groups is None:
        long = materialize(long, "group-means")
        seen = long.select(quoted(group)).distinct().limit(max_groups + 1).collect()
        if len(seen) > max_groups:
            raise ValueError(f"More than {max_groups} groups; use group_means (long form)")
        groups = sorted(r[0] for r in seen)
    wide = long.groupBy("column").pivot(group, list(groups)).agg(F.first("mean"))
    cells = [quoted(str(g)) for g in groups]
    means = F.filter(F.array(*cells), lambda v: v.isNotNull())
    wide = wide.withColumn("Average", _array_mean(means))
    spread = F.array_append(means, F.col("Average")) if compat else means
    return wide.withColumn("Std.dev", _array_std(spread))


def _array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def _array_mean(values: Column) -> Column:
    return F.try_divide(_array_sum(values), F.size(values))


def _array_std(values: Column) -> Column:
    mean = _array_mean(values)
    squares = _array_sum(F.transform(values, lambda v: (v - mean) * (v - mean)))
    return F.sqrt(F.try_divide(squares, F.size(values) - 1))


def anova(df: DataFrame, group: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One-way analysis of variance per column: ``column, f_statistic, p_value, column_mean``.

    One pass for the overall means, one grouped aggregation for counts, means and variances
    (partially aggregated per task, so a dominant group costs no more than a small one),
    then a reduction to one row per column. Sorted by p-value.
    """
    chosen = list(columns) if columns else numeric_columns(df, [group])
    overall = df.agg(*[F.avg(number(df, c)).alias(f"m{i}") for i, c in enumerate(chosen)]).first()
    means = [overall[f"m{i}"] for i in range(len(chosen))]
    present = _grouped(df, group, False)
    per_group = present.groupBy(quoted(group).alias("g")).agg(*[
        F.struct(F.lit(c).alias("column"), F.count(number(df, c)).alias("n"),
                 # Distance from the overall mean keeps the between part free of cancellation.
                 F.avg(number(df, c) - F.lit(means[i])).alias("shift"),
                 F.var_pop(number(df, c)).alias("spread")).alias(f"s{i}")
        for i, c in enumerate(chosen)])
    rows = (per_group.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(chosen))])))
            .filter(F.col("n") > 0).groupBy("column")
            .agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"),
                 F.sum(F.col("n") * F.col("spread")).alias("within"),
                 F.sum(F.col("n") * F.col("shift")).alias("drift"),
                 F.sum(F.col("n") * F.col("shift") * F.col("shift")).alias("between"))
            .collect())
    found = {r["column"]: r for r in rows}
    out = []
    for c, mean in zip(chosen, means):
        r = found.get(c)
        f = p = None
        if r and r["k"] > 1 and r["n"] > r["k"]:
            between = r["between"] - r["drift"] ** 2 / r["n"]
            d1, d2 = r["k"] - 1, r["n"] - r["k"]
            if r["within"] > 0:
                f = (between / d1) / (r["within"] / d2)
                p = f_upper(f, d1, d2)
            elif between > 0:
                f, p = float("inf"), 0.0
        out.append((c, f, p, mean))
    return df.sparkSession.createDataFrame(
        out, "column string, f_statistic double, p_value double, column_mean double"
    ).orderBy(F.asc_nulls_last("p_value"), "column")

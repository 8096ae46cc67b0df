"""Linear regression from one pass of cross moments.

A table of any length is reduced to the (p+1) x (p+1) centred cross moments of its p
features and target. Fitting, p-values, stepwise selection and interval widths only need
that matrix, so they run on the driver without touching the table again; its size depends
on the number of columns alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.response import linear_predictor, total
from ..functions.tails import t_quantile, t_two_sided
from ..schema import number, quoted
from . import tiles
from .sweep import SweptSelection

#: Up to this many columns the moments are built-in aggregates; beyond, Arrow batches. The
#: number of pairs grows with the square, and past this point compiling the generated
#: aggregation takes longer than the matrix products.
NARROW_COLUMNS = 6
NARROW_PAIRS = 4
#: Sums kept apart while per-task results are added up.
MERGE_GROUPS = 256
#: Up to this many features the interval width is one generated expression.
NARROW_INTERVAL = 20
#: Relative eigenvalue of the correlation matrix under which a direction counts as redundant.
RANK_TOLERANCE = 1e-11


@dataclass(frozen=True)
class Moments:
    """Mean vector and centred cross moments of complete rows."""

    columns: tuple[str, ...]
    n: int
    rows_dropped: int
    mean: np.ndarray
    comoment: np.ndarray

    def index(self, names: Iterable[str]) -> list[int]:
        return [self.columns.index(n) for n in names]

    def constant(self, name: str) -> bool:
        j = self.columns.index(name)
        noise = 8 * np.finfo(float).eps * abs(self.mean[j])
        return bool(self.comoment[j, j] <= max(self.n, 1) * noise * noise)


def moments(df: DataFrame, columns: Sequence[str], tile: int = tiles.TILE) -> Moments:
    """Cross moments of the rows in which none of the columns is missing.

    Many columns are worked off in tiles of ``tile`` of them each way, see ``tiles``: a task's memory and
    what one task adds up do not grow with their square.
    """
    columns = list(dict.fromkeys(columns))
    values = _numbered(df, columns)
    n, total_rows, mean, comoment = _moments_builtin(values) if len(columns) <= NARROW_COLUMNS else _moments_tiled(values, tile)
    return Moments(tuple(columns), n, total_rows - n, mean, comoment)


def _numbered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[number(df, c).alias(f"c{i}") for i, c in enumerate(columns)])


def _moments_builtin(values: DataFrame):
    """One aggregation inside generated code; covar_pop merges partial means stably."""
    names = values.columns
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in names])
    usable = values.select(complete.alias("ok"),
                           *[F.when(complete, F.col(c)).alias(c) for c in names])
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    row = usable.agg(
        F.count(F.lit(1)).alias("total"), F.count_if("ok").alias("n"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(names)],
        *[F.covar_pop(names[i], names[j]).alias(f"v{i}_{j}") for i, j in pairs]).first()
    n, size = row["n"], len(names)
    mean, comoment = np.zeros(size), np.zeros((size, size))
    if n:
        mean[:] = [row[f"m{i}"] for i in range(size)]
        for i, j in pairs:
            comoment[i, j] = comoment[j, i] = n * row[f"v{i}_{j}"]
    return n, row["total"], mean, comoment


def _moments_tiled(values: DataFrame, tile: int):
    """Means first, then matrix products of Arrow batches shifted by those means, tile by tile."""
    total_rows, shift = tiles.column_means(values)
    size = len(shift)
    full = tiles.assemble(tiles.complete_products(values, shift, tile), size + 1, tile)
    n = 0 if full is None else round(full[0, 0, 0])
    if n == 0:
        return 0, total_rows, np.zeros(size), np.zeros((size, size))
    full = tiles.mirrored(full[0], full[0])
    slip = full[0, 1:] / n
    return n, total_rows, shift + slip, full[1:, 1:] - n * np.outer(slip, slip)


def _sum_cells(partials: DataFrame, tasks: int | None = None) -> np.ndarray:
    """Add up the per-task arrays cell by cell, in two levels.

    The first level spreads the tasks' arrays over MERGE_GROUPS sums, so that the last one
    adds that many arrays at most, however many tasks there were; it is left out for so few tasks.
    """
    vectors = partials.select(F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("g"),
                              array_to_vector("cells").alias("v"))
    if tasks is None or tasks > MERGE_GROUPS:
        vectors = vectors.groupBy("g").agg(Summarizer.sum(F.col("v")).alias("v"))
    total_ = vectors.agg(Summarizer.sum(F.col("v")).alias("v")).first()["v"]
    return total_.toArray() if total_ is not None else np.zeros(0)


def pairwise_correlation(df: DataFrame, columns: Sequence[str], tile: int = tiles.TILE) -> np.ndarray:
    """Pearson matrix, each cell over the rows in which its two columns are present; wide tables in tiles."""
    size = len(columns)
    values = _numbered(df, columns)
    if size <= NARROW_PAIRS:
        pairs = [(i, j) for i in range(size) for j in range(i, size)]
        # try_divide: a constant column has no correlation, which is NULL and not an error.
        row = values.agg(*[
            F.try_divide(F.covar_pop(*both), F.stddev_pop(both[0]) * F.stddev_pop(both[1]))
            .alias(f"r{i}_{j}") for i, j in pairs
            for both in [_both_present(f"c{i}", f"c{j}")]]).first()
        matrix = np.full((size, size), np.nan)
        for i, j in pairs:
            r = row[f"r{i}_{j}"]
            matrix[i, j] = matrix[j, i] = np.nan if r is None else r
        return np.clip(matrix, -1.0, 1.0)
    _, shift = tiles.column_means(values)
    found = tiles.assemble(tiles.pairwise_products(values, shift, tile), size, tile, len(tiles.PAIR_LAYERS))
    if found is None:
        return np.full((size, size), np.nan)
    layer = dict(zip(tiles.PAIR_LAYERS, found))
    both, sums, squares, products = (tiles.mirrored(layer[a], layer[b]) for a, b in (("count", "count"), ("a", "b"), ("aa", "bb"), ("ab", "ab")))
    with np.errstate(divide="ignore", invalid="ignore"):
        covariance = products - sums * sums.T / both
        spread = squares - sums * sums / both
        r = covariance / np.sqrt(spread * spread.T)
    return np.clip(r, -1.0, 1.0)


def _both_present(a: str, b: str) -> tuple[Column, Column]:
    return (F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b)))


# --- fitting -------------------------------------------------------------------------------

@dataclass(frozen=True)
class LinearModel:
    """Fitted coefficients, and what is needed for tests and intervals.

    ``kernel`` is the (pseudo-)inverse of X'X in coordinates centred at ``centre``, with the
    intercept first; centring keeps interval widths accurate for columns far from zero.
    """

    features: tuple[str, ...]
    target: str
    n: int
    rank: int
    rss: float
    intercept: float
    coefficients: np.ndarray
    centre: np.ndarray
    kernel: np.ndarray

    @property
    def df_resid(self) -> int:
        return self.n - self.rank

    @property
    def residual_variance(self) -> float:
        return self.rss / self.df_resid if self.df_resid > 0 else math.nan

    def standard_errors(self) -> np.ndarray:
        """Standard errors, intercept first."""
        back = np.eye(len(self.features) + 1)
        back[0, 1:] = -self.centre
        spread = np.einsum("ij,jk,ik->i", back, self.kernel, back)
        return np.sqrt(np.maximum(spread, 0.0) * self.residual_variance)

    def t_values(self) -> np.ndarray:
        weights = np.concatenate([[self.intercept], self.coefficients])
        with np.errstate(divide="ignore", invalid="ignore"):
            return weights / self.standard_errors()

    def p_values(self) -> np.ndarray:
        return np.array([t_two_sided(float(t), self.df_resid) for t in self.t_values()])


def fit(found: Moments, target: str, features: Sequence[str]) -> LinearModel:
    """Least squares with intercept; the minimum-norm solution where columns are collinear."""
    if found.n == 0:
        raise ValueError("No complete rows to fit on.")
    if target not in found.columns:
        raise ValueError(f"no target column '{target}'")
    ix, iy = found.index(features), found.columns.index(target)
    centre = found.mean[ix]
    cross = found.comoment[np.ix_(ix, ix)]
    with_target = found.comoment[ix, iy]
    scale = np.sqrt(np.maximum(np.diag(cross), 0.0))
    scale[[found.constant(f) for f in features]] = 0.0
    safe = np.where(scale > 0, scale, 1.0)
    corr = np.where((scale[:, None] > 0) & (scale[None, :] > 0), cross / np.outer(safe, safe), 0.0)
    eigenvalues, vectors = np.linalg.eigh(corr) if len(ix) else (np.zeros(0), np.zeros((0, 0)))
    used = eigenvalues > RANK_TOLERANCE * max(eigenvalues.max(initial=0.0), 1e-300)
    basis = vectors[:, used] / safe[:, None]
    inverse = (basis / eigenvalues[used]) @ basis.T
    slopes = inverse @ with_target
    rss = float(max(found.comoment[iy, iy] - slopes @ with_target, 0.0))

    k = len(ix)
    kernel = np.zeros((k + 1, k + 1))
    kernel[0, 0] = 1.0 / found.n
    kernel[1:, 1:] = inverse
    weights = np.concatenate([[found.mean[iy] - centre @ slopes], slopes])
    if not used.all():
        # Take out the component along the directions in which the design does not vary.
        to_raw = np.eye(k + 1)
        to_raw[0, 1:] = -centre
        idle = to_raw @ np.vstack([np.zeros((~used).sum()), vectors[:, ~used] / safe[:, None]])
        idle, _ = np.linalg.qr(idle)
        keep = np.eye(k + 1) - idle @ idle.T
        weights = keep @ weights
        to_centred = np.eye(k + 1)
        to_centred[0, 1:] = centre
        move = to_centred @ keep @ to_raw
        kernel = move @ kernel @ move.T
    return LinearModel(tuple(features), target, found.n, int(used.sum()) + 1, rss,
                       float(weights[0]), weights[1:], centre, kernel)


def stepwise(found: Moments, target: str, candidates: Sequence[str], *,
             initial: Sequence[str] = (), threshold_in: float = 0.05,
             threshold_out: float = 0.1) -> list[str]:
    """Forward-backward selection by p-value; no pass over the table, one sweep a step.

    Each round adds the outside column with the least p-value under ``threshold_in``, then
    removes the inside column with the greatest one over ``threshold_out``, until neither happens. Equal
    p-values go to column order. A set that comes back is an error.
    """
    if threshold_in >= threshold_out:
        raise ValueError("threshold_in must be below threshold_out, or selection may not end")
    names = [c for c in dict.fromkeys([*candidates, *initial]) if c != target]
    ix = found.index([*names, target])
    state = SweptSelection(found.comoment[np.ix_(ix, ix)], found.mean[ix], found.n)
    pool = [j for j, c in enumerate(names) if c in set(candidates) and not found.constant(c)]
    for c in initial:
        state.enter(names.index(c))
    seen: set[frozenset[int]] = set()
    while True:
        # The next round depends on the set alone: one that comes back comes back for ever.
        if frozenset(state.chosen) in seen:
            raise ValueError(f"selection goes round: {sorted(names[j] for j in state.chosen)} came up again")
        seen.add(frozenset(state.chosen))
        changed, inside = False, set(state.chosen)
        best = state.best_outside([j for j in pool if j not in inside])
        if best and best[0] < threshold_in:
            state.enter(best[1])
            changed = True
        worst = state.worst_inside()
        if worst and worst[0] > threshold_out:
            state.leave(worst[1])
            changed = True
        if not changed:
            break
    return [names[j] for j in state.chosen]


def train(found: Moments, target: str, candidates: Sequence[str], *, select: bool = True,
          initial: Sequence[str] = (), threshold_in: float = 0.05,
          threshold_out: float = 0.1) -> LinearModel:
    """Fit on the stepwise selection, or on all columns if it is off or selects nothing."""
    usable = [c for c in candidates if c != target and not found.constant(c)]
    if not usable:
        raise ValueError("no usable feature columns to train on")
    picked = stepwise(found, target, usable, initial=initial, threshold_in=threshold_in,
                      threshold_out=threshold_out) if select else usable
    return fit(found, target, picked or usable)


# --- results as tables ---------------------------------------------------------------------

def coefficient_table(spark: SparkSession, model: LinearModel) -> DataFrame:
    """``feature, coefficient, std_err, t, p`` with the intercept as ``const``."""
    rows = [(name, *(None if math.isnan(v) else float(v) for v in line)) for name, *line in zip(
        ("const", *model.features), (model.intercept, *model.coefficients),
        model.standard_errors(), model.t_values(), model.p_values())]
    return spark.createDataFrame(
        rows, "feature string, coefficient double, std_err double, t double, p double")


def model_frame(spark: SparkSession, model: LinearModel) -> DataFrame:
    """The whole model as a long parameter table ``part, row, col, name, value``."""
    rows = [("scalar", 0, 0, k, float(v)) for k, v in (
        ("n", model.n), ("rank", model.rank), ("rss", model.rss), ("intercept", model.intercept))]
    rows.append(("target", 0, 0, model.target, None))
    rows += [("coefficient", i, 0, f, float(v))
             for i, (f, v) in enumerate(zip(model.features, model.coefficients))]
    rows += [("centre", i, 0, f, float(v))
             for i, (f, v) in enumerate(zip(model.features, model.centre))]
    rows += [("kernel", i, j, None, float(v)) for (i, j), v in np.ndenumerate(model.kernel)]
    return spark.createDataFrame(rows, "part string, row int, col int, name string, value double")


def model_from_frame(frame: DataFrame) -> LinearModel:
    """Read back :func:`model_frame`; its size depends on the number of features only."""
    parts: dict[str, list] = {}
    for r in frame.orderBy("part", "row", "col").collect():
        parts.setdefault(r["part"], []).append(r)
    scalar = {r["name"]: r["value"] for r in parts["scalar"]}
    features = tuple(r["name"] for r in parts.get("coefficient", []))
    size = len(features) + 1
    return LinearModel(
        features, parts["target"][0]["name"], int(scalar["n"]), int(scalar["rank"]),
        scalar["rss"], scalar["intercept"],
        np.array([r["value"] for r in parts.get("coefficient", [])]),
        np.array([r["value"] for r in parts.get("centre", [])]),
        np.array([r["value"] for r in parts["kernel"]]).reshape(size, size))


# --- prediction ----------------------------------------------------------------------------

def prediction_columns(model: LinearModel, features: Sequence[Column], *,
                       interval: bool = True, alpha: float = 0.05) -> dict[str, Column]:
    """``prediction`` and, if asked for, the bounds of the 1 - alpha prediction interval."""
    point = linear_predictor(features, model.coefficients, model.intercept)
    if not interval:
        return {"prediction": point}
    half = (F.lit(t_quantile(1 - alpha / 2, model.df_resid))
            * F.sqrt(F.lit(model.residual_variance) * (F.lit(1.0) + _leverage(model, features))))
    return {"prediction": point, "prediction_pi_lower": point - half,
            "prediction_pi_upper": point + half}


def _leverage(model: LinearModel, features: Sequence[Column]) -> Column:
    if len(features) <= NARROW_INTERVAL:
        z = [F.lit(1.0), *(x - F.lit(float(m)) for x, m in zip(features, model.centre))]
        terms = [z[i] * z[j] * F.lit(float(model.kernel[i, j] * (1 if i == j else 2)))
                 for i in range(len(z)) for j in range(i, len(z))]
        return total(terms)
    centre, kernel = model.centre, model.kernel

    @F.pandas_udf("double")
    def leverage(*columns: pd.Series) -> pd.Series:
        import numpy as np
        import pandas as pd
        z = np.column_stack([np.ones(len(columns[0])), *[c.to_numpy(dtype=float) for c in columns]])
        z[:, 1:] -= centre
        return pd.Series(np.einsum("ij,ij->i", z @ kernel, z))

    return leverage(*features)


def predict(df: DataFrame, model: LinearModel, *, interval: bool = True,
            alpha: float = 0.05) -> DataFrame:
    """Append the prediction columns; one narrow projection."""
    absent = [f for f in model.features if f not in df.columns]
    if absent:
        raise ValueError(f"table lacks model features {absent}")
    return df.withColumns(prediction_columns(
        model, [quoted(f).cast("double") for f in model.features],
        interval=interval, alpha=alpha))

"""Clustering: K-means sweep and fit, assignment, inertia and silhouette."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from contextlib import ExitStack
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.response import total
from ..schema import number, quoted
from ..session import written
from .regression import _sum_cells

#: Squared differences up to which nearest-centre assignment is a generated expression.
NARROW_TERMS = 60


def _is_array(df: DataFrame, columns: Sequence[str]) -> bool:
    return len(columns) == 1 and isinstance(df.schema[columns[0]].dataType, T.ArrayType)


def _point(df: DataFrame, columns: Sequence[str]) -> Column:
    """The columns of a row as one array; a single array column is taken as it is."""
    if _is_array(df, columns):
        return quoted(columns[0]).cast("array<double>")
    return F.array(*[number(df, c) for c in columns])


def _with_vector(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    if _is_array(df, columns):
        return df.withColumn(name, array_to_vector(_point(df, columns)))
    return VectorAssembler(inputCols=list(columns), outputCol=name,
                           handleInvalid="error").transform(df)


# --- fitting -------------------------------------------------------------------------------

class KMeansFit(NamedTuple):
    """``table`` has the cluster column, NULL for the ``left_out`` incomplete rows."""

    table: DataFrame
    centres: np.ndarray
    inertia: float
    converged: bool
    left_out: int


class _Run(NamedTuple):
    k: int
    centres: np.ndarray
    cost: float
    converged: bool


def _complete(point: Column, width: int) -> Column:
    """Whether a point has the given length and neither NULL nor NaN in it."""
    return F.coalesce((F.size(point) == width) & ~F.exists(point, lambda v: v.isNull() | F.isnan(v)), F.lit(False))


def _width(df: DataFrame, columns: Sequence[str]) -> int:
    """Number of dimensions; of an array column, its most frequent length."""
    if not _is_array(df, columns):
        return len(columns)
    sizes = df.groupBy(F.size(quoted(columns[0])).alias("size")).agg(F.count(F.lit(1)).alias("n")).where("size > 0")
    found = sizes.orderBy(F.desc("n"), "size").first()
    return found["size"] if found else 0


def kmeans_fit(df: DataFrame, columns: Sequence[str], k: int = 3, *, seed: int = 42, n_init: int = 10,
               max_iter: int = 300, tolerance: float = 1e-4, start: Sequence[Sequence[float]] | None = None,
               name: str = "cluster") -> KMeansFit:
    """The best of ``n_init`` runs (or the run from the centres ``start``), applied to the table.

    Rows with a NULL, a NaN or another number of dimensions are left out of the fit, counted, and
    keep a NULL cluster.
    """
    width = _width(df, columns)
    runs, n, _ = _fit_runs(df, columns, width, [k] if start is not None else [k] * (1 if k == 1 else n_init),
                        None if start is None else [np.asarray(start, dtype=float)], seed, max_iter, tolerance)
    best = min(runs, key=lambda r: r.cost)
    point = _point(df, columns)
    usable = df.withColumn("__point", F.when(_complete(point, width), point))
    table = usable.withColumn(name, _nearest_udf(best.centres)(F.col("__point"))).drop("__point")
    return KMeansFit(table, best.centres, best.cost, best.converged, df.count() - n)


def kmeans_sweep(df: DataFrame, columns: Sequence[str], k_values: Sequence[int] = range(1, 11), *,
                 n_init: int = 10, seed: int = 42, max_iter: int = 300, tolerance: float = 1e-4,
                 starts: Mapping[int, Sequence[Sequence[float]]] | None = None) -> DataFrame:
    """Inertia per number of clusters, best of ``n_init`` starts: ``k, inertia, converged``.

    All runs of all ``k`` move forward together: one pass over the points, which are written once, assigns
    them under every run's centres and returns counts, sums and cost. The number of passes is
    that of the slowest run rather than the sum over all runs, and what a pass returns
    depends on k and the number of dimensions only. ``starts`` gives the centres to begin from instead.
    ``converged`` tells whether the best run came to rest within ``max_iter`` updates. Incomplete
    rows are left out as in ``kmeans_fit``.
    """
    ks = [k for k in k_values for _ in range(1 if k == 1 or starts is not None else n_init)]
    given = None if starts is None else [np.asarray(starts[k], dtype=float) for k in ks]
    runs, _, _ = _fit_runs(df, columns, _width(df, columns), ks, given, seed, max_iter, tolerance)
    best: dict[int, _Run] = {}
    for run in runs:
        if run.k not in best or run.cost < best[run.k].cost:
            best[run.k] = run
    return df.sparkSession.createDataFrame(
        [(int(k), float(best[k].cost), best[k].converged) for k in k_values], "k int, inertia double, converged boolean")


class _Work(NamedTuple):
    """What a fit cost: passes to find starts, passes of updates, distances worked out and those a plain fit needs."""

    seeding: int
    passes: int
    tested: int
    plain: int


def _fit_runs(df: DataFrame, columns: Sequence[str], width: int, ks: Sequence[int],
              starts: Sequence[np.ndarray] | None, seed: int, max_iter: int,
              tolerance: float) -> tuple[list[_Run], int, _Work]:
    """All runs to their end, the number of complete rows, and the work done.

    Every point carries, for each run, its centre and by how much that was nearer than the next at some
    earlier time. While the centres have moved less than that margin the point cannot change sides: it is
    added to its centre's sum without a distance. When too few points are settled, the points are written
    again with the margins of the present centres.
    """
    point = _point(df, columns)
    points = df.select(F.when(_complete(point, width), point).alias("p")).where("p IS NOT NULL")
    # Written tables last as long as the fit, which returns nothing that reads them.
    with ExitStack() as scratch:
        points = scratch.enter_context(written(points.select("p", F.xxhash64("p").alias("h")), "points"))
        return _runs_to_rest(points, width, ks, starts, seed, max_iter, tolerance, scratch)


def _runs_to_rest(points: DataFrame, width: int, ks: Sequence[int], starts: Sequence[np.ndarray] | None, seed: int,
                  max_iter: int, tolerance: float, scratch: ExitStack) -> tuple[list[_Run], int, _Work]:
    n, shift, spread = _moments(points, width)
    if n == 0:
        raise ValueError("No complete rows to cluster.")
    centres, seeding = (list(starts), 0) if starts is not None else _spread_starts(points, ks, seed)
    slack = tolerance * spread
    done: list[_Run | None] = [None] * len(ks)
    active = list(range(len(ks)))
    margins: _Margins | None = None
    table, since, passes, tested, plain = points.select("p"), 0, 0, 0, 0
    tasks = table.rdd.getNumPartitions()
    for step in range(max_iter + 1):
        counts, sums, cost, open_points = _assignment_pass(table, [centres[i] for i in active], shift, active, margins, tasks)
        passes, since = passes + 1, since + 1
        work = [int(o) * ks[i] for o, i in zip(open_points, active)]
        tested, plain = tested + sum(work), plain + n * sum(ks[i] for i in active)
        moving, offset = [], 0
        for position, i in enumerate(active):
            part = slice(offset, offset + ks[i])
            offset += ks[i]
            filled = counts[part] > 0
            updated = centres[i].copy()
            updated[filled] = sums[part][filled] / counts[part][filled, None] + shift
            rest = bool(((updated - centres[i]) ** 2).sum() <= slack)
            # The cost belongs to the centres of this pass.
            done[i] = _Run(ks[i], centres[i], float(cost[position]), rest)
            centres[i] = updated
            if not rest:
                moving.append(i)
        if not moving:
            break
        paying = sum(work) * width >= MARGIN_WORK and sum(work) > OPEN_SHARE * n * sum(ks[i] for i in active)
        if step < max_iter and since >= MARGIN_PASSES and paying:
            margins = _Margins(moving, [centres[i] for i in moving])
            table = scratch.enter_context(written(_with_margins(points.select("p"), margins, shift), "point-margins"))
            tasks = table.rdd.getNumPartitions()
            tested, since = tested + n * sum(ks[i] for i in moving), 0
        active = moving
    return [run for run in done if run is not None], n, _Work(seeding, passes, tested, plain)


def _moments(points: DataFrame, width: int) -> tuple[int, np.ndarray, float]:
    """Number of points, their mean, and the mean of their variances."""
    row = points.select("p").first()
    if row is None:
        return 0, np.zeros(width), 0.0
    # Squares are of the distance to one of the points, or values far from zero would cancel.
    origin = np.array(row["p"])

    def kernel(batches):
        import numpy as np
        import pyarrow as pa
        cells = np.zeros(1 + 2 * width)
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width) - origin
            cells += np.concatenate([[len(x)], x.sum(axis=0), (x ** 2).sum(axis=0)])
        yield pa.RecordBatch.from_pydict({"cells": [cells]})

    cells = _sum_cells(points.select("p").mapInArrow(kernel, "cells array<double>"))
    mean = cells[1:width + 1] / cells[0]
    return int(cells[0]), origin + mean, float(np.maximum(cells[width + 1:] / cells[0] - mean ** 2, 0).mean())


# --- starting centres

#: Rounds of draws after the first centre, points drawn in each as a multiple of k, and sums kept apart while they meet.
SEED_ROUNDS = 4
SEED_SHARE = 2
SEED_GROUPS = 64


def _spread_starts(points: DataFrame, ks: Sequence[int], seed: int) -> tuple[list[np.ndarray], int]:
    """Starting centres of every run, drawn over all rows, and the passes that took.

    One point, then ``SEED_ROUNDS`` times ``SEED_SHARE`` k points at once, each drawn in proportion to its
    squared distance to the nearest one so far: the rows with the greatest log(u) / distance, where u is
    a uniform number made of the row's content, the run and the round. A last pass counts the rows
    nearest to each drawn point, and k of these weighted points become the starts. That are six passes
    for all runs and any k, and what comes to the driver is a multiple of k. It does not depend on the
    partitions, and equal rows count once in a draw.
    """
    drawn: list[np.ndarray] = _draw(points, [np.zeros((0, 0))] * len(ks), [1] * len(ks), seed, 0)
    wide = [i for i, k in enumerate(ks) if k > 1]
    passes = 1
    for step in range(1, SEED_ROUNDS + 1 if wide else 0):
        new = _draw(points, [drawn[i] for i in wide], [SEED_SHARE * ks[i] for i in wide], seed, step, wide)
        passes += 1
        if not any(len(x) for x in new):
            break
        for i, x in zip(wide, new):
            drawn[i] = np.vstack([drawn[i], x]) if len(x) else drawn[i]
    if not wide:
        return drawn, passes
    counts, _, _, _ = _assignment_pass(points.select("p"), [drawn[i] for i in wide], drawn[0][0], wide, None)
    edges = np.cumsum([0] + [len(drawn[i]) for i in wide])
    starts = [x[:1] for x in drawn]
    for i, low, high in zip(wide, edges[:-1], edges[1:]):
        starts[i] = _reduce_weighted(drawn[i], counts[low:high], ks[i], np.random.default_rng([seed, i]))
    return starts, passes + 1


def _draw(points: DataFrame, so_far: Sequence[np.ndarray], wanted: Sequence[int], seed: int, step: int,
          runs: Sequence[int] | None = None) -> list[np.ndarray]:
    """The ``wanted`` points of each run with the greatest keys; fewer if fewer differ from those so far."""
    runs = list(range(len(so_far))) if runs is None else list(runs)

    def kernel(batches):
        import numpy as np
        import pyarrow as pa
        best: dict[int, dict[bytes, tuple[float, np.ndarray]]] = {i: {} for i in runs}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            h = batch.column(1).to_numpy().astype(np.uint64)
            for i, centres, most in zip(runs, so_far, wanted):
                key = np.log(_uniform(h, (seed * 1_000_003 + i) * 1_009 + step))
                usable = np.ones(len(x), bool)
                if len(centres):
                    gap = _nearest_gap(x, centres)
                    usable = gap > 0
                    with np.errstate(divide="ignore", over="ignore"):
                        key = np.where(usable, np.maximum(key / gap, -1e299), -np.inf)
                order = np.flatnonzero(usable)
                if len(order) > 4 * most:
                    order = order[np.argpartition(-key[order], 4 * most)[:4 * most]]
                held = best[i]
                for at in order[np.argsort(-key[order], kind="stable")].tolist():
                    if len(held) >= most and key[at] < min(v[0] for v in held.values()):
                        break
                    held[x[at].tobytes()] = (float(key[at]), x[at])
                    if len(held) > most:
                        del held[min(held, key=lambda b: (held[b][0], b))]
        rows = [(i, k, p) for i, held in best.items() for k, p in held.values()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.float64()),
                                          pa.array([r[2] for r in rows], pa.list_(pa.float64()))], ["run", "key", "p"])

    found = points.mapInArrow(kernel, "run int, key double, p array<double>").distinct()
    most = max(wanted)
    # First among a share of the tasks' points, then among what is left of each share.
    for group in (["run", F.pmod(F.xxhash64("p"), F.lit(SEED_GROUPS))], ["run"]):
        place = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("key"), F.desc("p")))
        found = found.withColumn("place", place).where(F.col("place") <= most)
    rows: dict[int, list] = {i: [] for i in runs}
    for row in found.orderBy("run", "place").collect():
        rows[row["run"]].append(row["p"])
    return [np.array(rows[i][:m], dtype=float) if rows[i] else np.zeros((0, 0)) for i, m in zip(runs, wanted)]


def _nearest_gap(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distance of every point to the nearest centre; exactly 0 for a point that is one."""
    out = np.empty(len(x))
    for at in range(0, len(x), 1024):
        part = x[at:at + 1024] - centres[0]
        moved = centres - centres[0]
        gaps = (part ** 2).sum(axis=1)[:, None] + (moved ** 2).sum(axis=1) - 2.0 * (part @ moved.T)
        nearest = gaps.argmin(axis=1)
        out[at:at + 1024] = ((part - moved[nearest]) ** 2).sum(axis=1)
    return out


def _reduce_weighted(x: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    """k centres of weighted points: drawn apart from each other, then moved a few times; points repeat if there are too few."""
    if len(x) <= k:
        return x[np.arange(k) % len(x)]
    chosen = [int(rng.choice(len(x), p=weights / weights.sum()))]
    gap = ((x - x[chosen[0]]) ** 2).sum(axis=1)
    for _ in range(k - 1):
        share = weights * gap
        total_ = share.sum()
        # Only points without rows near them may be left: then the farthest of all.
        at = int(rng.choice(len(x), p=share / total_)) if total_ > 0 else int(gap.argmax())
        chosen.append(at)
        gap = np.minimum(gap, ((x - x[at]) ** 2).sum(axis=1))
    centres = x[chosen].copy()
    for _ in range(rounds):
        nearest = ((x[:, None, :] - centres) ** 2).sum(axis=2).argmin(axis=1) if x.size * k < 1 << 24 else np.array(
            [((centres - row) ** 2).sum(axis=1).argmin() for row in x])
        mass = np.bincount(nearest, weights, minlength=k)
        moved = np.zeros_like(centres)
        np.add.at(moved, nearest, x * weights[:, None])
        centres[mass > 0] = moved[mass > 0] / mass[mass > 0, None]
    return centres


def _uniform(h: np.ndarray, salt: int) -> np.ndarray:
    """Numbers strictly between 0 and 1 made of 64-bit values."""
    z = h ^ np.uint64((salt * 0x9E3779B97F4A7C15) % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(12)).astype(float) / 2**52 + 2**-54


# --- passes over the points

#: Passes between two writings of margins, and the share of open distances above which they are written again.
MARGIN_PASSES = 3
OPEN_SHARE = 0.5
#: Products of one pass from which writing margins pays; results are the same either way.
MARGIN_WORK = 1 << 28
#: Up to this many centres a run's sums are a matrix product; beyond, points are sorted by centre.
FEW_CENTRES = 64


class _Margins(NamedTuple):
    """Runs, and their centres, to which the written margins refer."""

    runs: list[int]
    centres: list[np.ndarray]


def _with_margins(points: DataFrame, margins: _Margins, shift: np.ndarray) -> DataFrame:
    """The points with each run's nearest centre ``a`` and the margin ``m`` to the next, a little understated."""
    width = len(shift)
    runs = [c - shift for c in margins.centres]

    def kernel(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width) - shift
            own = (x ** 2).sum(axis=1)
            nearest, margin = np.zeros((len(x), len(runs)), np.int32), np.full((len(x), len(runs)), np.inf, np.float32)
            for r, centres in enumerate(runs):
                squares = (centres ** 2).sum(axis=1)
                gaps = np.sqrt(np.maximum(own[:, None] + squares - 2.0 * (x @ centres.T), 0.0))
                nearest[:, r] = gaps.argmin(axis=1)
                if len(centres) > 1 and len(x):
                    two = np.partition(gaps, 1, axis=1)
                    # Rounding must not make a margin wider than it is.
                    noise = 1e-7 * (np.sqrt(own) + np.sqrt(squares.max()))
                    margin[:, r] = (two[:, 1] - two[:, 0]) * (1 - 1e-6) - noise
            edges = pa.array(np.arange(0, nearest.size + 1, len(runs)), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(edges, pa.array(nearest.ravel())),
                                              pa.ListArray.from_arrays(edges, pa.array(margin.ravel()))], ["p", "a", "m"])

    return points.mapInArrow(kernel, "p array<double>, a array<int>, m array<float>")


def _assignment_pass(points: DataFrame, runs: Sequence[np.ndarray], shift: np.ndarray, ids: Sequence[int],
                     margins: _Margins | None, tasks: int | None = None):
    """Counts and sums per centre, cost per run and points whose distances were needed, in one pass."""
    width = len(shift)
    placed = [r - shift for r in runs]
    edges = np.cumsum([0] + [len(r) for r in runs])
    rows = int(edges[-1])
    column, limits = [], []
    for i, centres in zip(ids, runs):
        at = margins.runs.index(i) if margins is not None and i in margins.runs else None
        column.append(at)
        limits.append(None)
        if at is not None:
            moved = np.sqrt(((centres - margins.centres[at]) ** 2).sum(axis=1))
            others = np.array([np.delete(moved, j).max(initial=0.0) for j in range(len(moved))])
            limits[-1] = moved + others

    def kernel(batches):
        import numpy as np
        import pyarrow as pa
        counts, sums = np.zeros(rows), np.zeros((rows, width))
        tested, own = np.zeros(len(placed)), 0.0
        squares = [(c ** 2).sum(axis=1) for c in placed]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width) - shift
            own += (x ** 2).sum()
            if margins is not None:
                known = batch.column(1).flatten().to_numpy().reshape(len(x), -1)
                margin = batch.column(2).flatten().to_numpy().reshape(len(x), -1)
            for run, centres in enumerate(placed):
                if column[run] is None:
                    nearest, unsettled = np.zeros(len(x), np.int64), np.arange(len(x))
                else:
                    nearest = known[:, column[run]].astype(np.int64)
                    unsettled = np.flatnonzero(~(margin[:, column[run]] > limits[run][nearest]))
                tested[run] += len(unsettled)
                for at in range(0, len(unsettled), 4096):
                    part = unsettled[at:at + 4096]
                    nearest[part] = (squares[run] - 2.0 * (x[part] @ centres.T)).argmin(axis=1)
                if len(centres) <= FEW_CENTRES:
                    member = (nearest[:, None] == np.arange(len(centres))).astype(float)
                    counts[edges[run]:edges[run + 1]] += member.sum(axis=0)
                    sums[edges[run]:edges[run + 1]] += member.T @ x
                    continue
                order = np.argsort(nearest, kind="stable")
                found, first = np.unique(nearest[order], return_index=True)
                counts[edges[run] + found] += np.diff(np.append(first, len(x)))
                sums[edges[run] + found] += np.add.reduceat(x[order], first, axis=0)
        yield pa.RecordBatch.from_pydict({"cells": [np.concatenate([counts, sums.ravel(), tested, [own]])]})

    cells = _sum_cells(points.mapInArrow(kernel, "cells array<double>"), tasks)
    counts, sums = cells[:rows], cells[rows:rows * (width + 1)].reshape(rows, width)
    # Squared distances to the own centres, from the sums alone.
    centres = np.vstack(placed)
    saved = (2.0 * (centres * sums).sum(axis=1) - counts * (centres ** 2).sum(axis=1))
    cost = np.maximum(cells[-1] - np.add.reduceat(saved, edges[:-1]), 0.0)
    return counts, sums, cost, cells[rows * (width + 1):-1]


# --- assignment and quality ----------------------------------------------------------------

def assign_nearest(df: DataFrame, columns: Sequence[str], centres: Sequence[Sequence[float]],
                   name: str = "cluster") -> DataFrame:
    """Index of the nearest centre (the first of equally near ones), as one projection.

    Few distance terms become a generated expression. Many would outgrow what the JVM
    compiles, so they are a matrix operation on Arrow batches of the point column alone.
    """
    fixed = np.asarray(centres, dtype=float)
    if fixed.size > NARROW_TERMS or _is_array(df, columns):
        return df.withColumn(name, _nearest_udf(fixed)(_point(df, columns)))
    gaps = [[number(df, c) - F.lit(float(v)) for c, v in zip(columns, centre)] for centre in fixed]
    distances = F.array(*[total([g * g for g in row]) for row in gaps])
    return (df.withColumn("__distances", distances)
            .withColumn(name, (F.array_position(
                "__distances", F.array_min("__distances")) - 1).cast("int"))
            .drop("__distances"))


def _nearest_udf(centres: np.ndarray):
    width = centres.shape[1]

    @F.arrow_udf("int")
    def nearest(points: pa.Array) -> pa.Array:
        import numpy as np
        import pyarrow as pa
        usable = np.asarray(points.is_valid())
        flat = points.drop_null().flatten().to_numpy(zero_copy_only=False)
        x = flat.reshape(-1, width)
        out = np.full(len(usable), -1, dtype=np.int32)
        if len(x):
            gaps = np.stack([((x - c) ** 2).sum(axis=1) for c in centres], axis=1)
            known = ~np.isnan(gaps).any(axis=1)
            out[np.flatnonzero(usable)[known]] = gaps[known].argmin(axis=1)
        return pa.array(out, mask=out < 0)

    return nearest


def inertia(df: DataFrame, columns: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """One row: sum of squared distances to the mean of each row's cluster.

    Equals count times population variance added over clusters and dimensions, so no
    centre has to be joined back; the variances of all dimensions are one aggregate.
    """
    vectors = _with_vector(df, columns, "__point").select(quoted(cluster).alias("c"), "__point")
    spread = Summarizer.metrics("count", "variance").summary(F.col("__point"))
    per_cluster = vectors.groupBy("c").agg(spread.alias("s")).select(
        (F.col("s.count") - 1).alias("free"), vector_to_array("s.variance").alias("v"))
    squares = F.aggregate("v", F.lit(0.0), lambda a, v: a + v) * F.col("free")
    return per_cluster.agg(F.sum(squares).alias("inertia"))


def silhouette(df: DataFrame, columns: Sequence[str], cluster: str = "cluster") -> float:
    """Mean silhouette under squared Euclidean distance; linear in the number of rows."""
    vectors = _with_vector(df, columns, "__point").select("__point", quoted(cluster).alias("c"))
    return ClusteringEvaluator(featuresCol="__point", predictionCol="c").evaluate(vectors)


def silhouette_euclidean(df: DataFrame, key: str, columns: Sequence[str],
                         cluster: str = "cluster", *, block_rows: int = 4_000,
                         max_pairs: int = 10**10) -> DataFrame:
    """One row: mean silhouette under Euclidean distance, over all pairs of rows.

    The work is quadratic by definition: a table with more than ``max_pairs`` pairs of rows is
    refused with their number, to be allowed by that argument; ``silhouette`` is linear. Rows are
    spread over hash blocks of bounded size, and each pair of blocks is one small group that
    returns, per row and cluster of the other block, its summed distance; no task sees more than two
    blocks. Clusters are rows throughout, however many there are. Rows without a cluster are left
    out; ``key`` must be unique.
    """
    rows = df.select(quoted(key).alias("key"), quoted(cluster).cast("int").alias("c"),
                     _point(df, columns).alias("p")).where("c IS NOT NULL")
    sizes = rows.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    n = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if n * (n - 1) // 2 > max_pairs:
        raise ValueError(f"{n * (n - 1) // 2} pairs of rows are more than max_pairs = {max_pairs}")
    blocks = max(1, math.ceil(n / block_rows))
    key_type = rows.schema["key"].dataType.simpleString()

    def pair_sums(pair: pd.DataFrame) -> pd.DataFrame:
        import numpy as np
        import pandas as pd
        x = np.stack(pair["p"].to_numpy())
        c, block, key = (pair[name].to_numpy() for name in ("c", "block", "key"))
        low, high = pair["low"].iloc[0], pair["high"].iloc[0]
        x = x - x.mean(axis=0)
        own = (x ** 2).sum(axis=1)
        parts = []
        # Rows of one block against those of the other; a block paired with itself once.
        for mine, other in {(low, high), (high, low)}:
            a, b = np.flatnonzero(block == mine), np.flatnonzero(block == other)
            labels, which = np.unique(c[b], return_inverse=True)
            b = b[np.argsort(which, kind="stable")]
            first = np.searchsorted(np.sort(which), np.arange(len(labels)))
            for at in range(0, len(a), 256):
                part = a[at:at + 256]
                gap = own[part, None] + own[None, b] - 2.0 * (x[part] @ x[b].T)
                sums = np.add.reduceat(np.sqrt(np.maximum(gap, 0.0)), first, axis=1)
                parts.append(pd.DataFrame({"key": np.repeat(key[part], len(labels)), "c": np.repeat(c[part], len(labels)),
                                           "other": np.tile(labels, len(part)), "total": sums.ravel()}))
        return pd.concat(parts)

    block = F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")
    paired = (rows.withColumn("block", block)
              .withColumn("with", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
              .withColumn("low", F.least("block", "with"))
              .withColumn("high", F.greatest("block", "with")).drop("with"))
    partial = paired.groupBy("low", "high").applyInPandas(pair_sums, f"key {key_type}, c int, other int, total double")
    summed = partial.groupBy("key", "c", "other").agg(F.sum("total").alias("total"))
    # A row's own cluster has one partner less: itself.
    partners = F.col("n") - F.when(F.col("c") == F.col("other"), 1).otherwise(0)
    mean = F.when(partners > 0, F.col("total") / partners)
    per_row = summed.join(sizes.withColumnRenamed("c", "other"), "other").groupBy("key", "c").agg(
        F.max(F.when(F.col("c") == F.col("other"), mean)).alias("own"), F.min(F.when(F.col("c") != F.col("other"), mean)).alias("rest"))
    value = F.when(F.col("own").isNull(), F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("rest") - F.col("own"), F.greatest("own", "rest")), F.lit(0.0)))
    return per_row.agg(F.avg(value).alias("silhouette"))


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    return df.groupBy(quoted(cluster)).agg(F.count(F.lit(1)).alias("size"))


def cluster_options(config: Mapping) -> dict:
    """K-means settings of a configuration's ``model.kmeans`` section."""
    section = config.get("model", {}).get("kmeans", {})
    return {"k_values": range(section.get("k_min", 1), section.get("k_max", 10) + 1),
            "k": section.get("n_clusters", 3), "seed": section.get("random_state", 42)}

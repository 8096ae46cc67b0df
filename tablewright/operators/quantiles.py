"""Exact quantiles without holding a column's values in one place.

Spark's ``percentile`` keeps every distinct value of a column in one aggregation buffer.
Here a mergeable sketch proposes two pivots around each wanted order statistic, a counting
pass places the statistic left of, on, between or right of them, and only once an interval
holds few rows are its values fetched. Pivots are data values and leave the interval, so
every pass makes progress even when most rows share one value. All columns and
probabilities share the passes, and no pass shuffles more than one row per task.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import number

#: Values up to which one buffer may hold a whole column (the built-in ``percentile``).
BUFFER_LIMIT = 200_000
#: Rows that may be fetched in the last step, over all intervals together.
GATHER_LIMIT = 1_000_000
SKETCH_ACCURACY = 10_000
_GRID = 1024


@dataclass(frozen=True)
class _Search:
    """The ``rank``-th smallest value (0-based), known to lie strictly between the bounds."""

    column: str
    rank: int
    below: int                      # rows at or under the lower bound
    inside: int                     # rows strictly between the bounds
    low: float | None = None        # None: unbounded
    high: float | None = None
    pivots: tuple[float, float] | None = None
    expected: float = math.inf      # rows likely to lie between the pivots

    def interval(self) -> tuple:
        return self.column, self.low, self.high


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], *,
                    sizes: Mapping[str, int] | None = None, buffer_limit: int = BUFFER_LIMIT,
                    gather_limit: int = GATHER_LIMIT,
                    accuracy: int = SKETCH_ACCURACY) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of each column, missing values ignored.

    ``sizes`` passes on the columns' non-missing counts where they are known already.
    """
    if not columns:
        return {}
    values = {c: number(df, c) for c in columns}
    if sizes is None:
        counted = df.agg(*[F.count(values[c]).alias(f"n{i}") for i, c in enumerate(columns)]).first()
        sizes = {c: counted[f"n{i}"] for i, c in enumerate(columns)}
    result: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}
    small = [c for c in columns if 0 < sizes[c] <= buffer_limit]
    if small:
        wanted = F.array(*map(F.lit, probabilities))
        row = df.agg(*[F.percentile(values[c], wanted).alias(f"q{i}")
                       for i, c in enumerate(small)]).first()
        result.update({c: list(row[f"q{i}"]) for i, c in enumerate(small)})
    large = [c for c in columns if sizes[c] > buffer_limit]
    if not large:
        return result

    margin = 2.0 / accuracy
    probes = [edge for p in probabilities
              for edge in (max(0.0, p - margin), min(1.0, p + margin))]
    sketched = df.agg(*[F.percentile_approx(values[c], probes, accuracy).alias(f"s{i}")
                        for i, c in enumerate(large)]).first()
    searches: dict[tuple[str, int], _Search] = {}
    positions: dict[tuple[str, int], float] = {}
    for i, c in enumerate(large):
        for j, p in enumerate(probabilities):
            position = (sizes[c] - 1) * p
            positions[c, j] = position
            pivots = tuple(sketched[f"s{i}"][2 * j:2 * j + 2])
            for rank in {math.floor(position), math.ceil(position)}:
                searches[c, rank] = _Search(c, rank, 0, sizes[c], pivots=pivots,
                                            expected=2 * margin * sizes[c])
    if searches:
        found = _locate(df, values, searches, gather_limit, accuracy)
        for (c, j), position in positions.items():
            left, right = found[c, math.floor(position)], found[c, math.ceil(position)]
            result[c][j] = left + (right - left) * (position - math.floor(position))
    return result


def approx_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
                     accuracy: int = SKETCH_ACCURACY) -> dict[str, list[float | None]]:
    """One-pass sketch; the rank error is at most ``1 / accuracy`` of the rows."""
    row = df.agg(*[F.percentile_approx(number(df, c), list(probabilities), accuracy)
                   .alias(f"q_{i}") for i, c in enumerate(columns)]).first()
    return {c: list(row[f"q_{i}"] or [None] * len(probabilities)) for i, c in enumerate(columns)}


def quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
              accuracy: int | None = None, sizes: Mapping[str, int] | None = None,
              ) -> dict[str, list[float | None]]:
    """Exact by default; with ``accuracy`` the one-pass sketch."""
    if accuracy is None:
        return exact_quantiles(df, columns, probabilities, sizes=sizes)
    return approx_quantiles(df, columns, probabilities, accuracy)


def _between(value: Column, low: float | None, high: float | None) -> Column:
    """The value where it lies strictly between the bounds, else NULL."""
    test = value.isNotNull()
    if low is not None:
        test &= value > F.lit(low)
    if high is not None:
        test &= value < F.lit(high)
    return F.when(test, value)


def _locate(df: DataFrame, values: dict[str, Column], searches: dict[tuple[str, int], _Search],
            gather_limit: int, accuracy: int) -> dict[tuple[str, int], float]:
    found: dict[tuple[str, int], float] = {}
    # The limit holds for all intervals together: what is fetched does not grow with columns.
    gather_limit = max(1, gather_limit // len(searches))
    while searches:
        found.update(_narrow(df, values, searches, gather_limit, accuracy))
        few = {k: s for k, s in searches.items() if k not in found and s.inside <= gather_limit}
        if few:
            found.update(_fetch(df, values, few))
        for key in [k for k in searches if k in found]:
            del searches[key]
    return found


def _narrow(df: DataFrame, values: dict[str, Column], searches: dict[tuple[str, int], _Search],
            gather_limit: int, accuracy: int) -> dict[tuple[str, int], float]:
    """One pass: count around the pivots and sketch the interval expected to come next.

    Updates ``searches`` in place and returns the order statistics that hit a pivot.
    """
    grid = [k / _GRID for k in range(_GRID + 1)]
    aggregates: dict[tuple, tuple[str, Column]] = {}

    def ask(*key) -> str:
        kind, column, *bounds = key
        v = values[column]
        if key not in aggregates:
            made = {"lt": lambda: F.count_if(v < F.lit(bounds[0])),
                    "le": lambda: F.count_if(v <= F.lit(bounds[0])),
                    "sketch": lambda: F.percentile_approx(_between(v, *bounds), grid, accuracy),
                    }[kind]()
            aggregates[key] = (f"a{len(aggregates)}", made)
        return aggregates[key][0]

    for s in searches.values():
        if s.pivots:
            for pivot in s.pivots:
                ask("lt", s.column, pivot)
                ask("le", s.column, pivot)
        if s.expected > gather_limit:
            ask("sketch", s.column, *(s.pivots or (s.low, s.high)))
    row = df.agg(*[column.alias(name) for name, column in aggregates.values()]).first()

    found: dict[tuple[str, int], float] = {}
    for key, s in searches.items():
        placed = s
        if s.pivots:
            edges = [(s.low, s.below, s.below)]
            edges += [(p, row[ask("lt", s.column, p)], row[ask("le", s.column, p)])
                      for p in s.pivots]
            edges += [(s.high, s.below + s.inside, s.below + s.inside)]
            hit = next((value for value, lt, le in edges if lt <= s.rank < le), None)
            if hit is not None:
                found[key] = hit
                continue
            for (low, _, under), (high, over, _) in zip(edges, edges[1:]):
                if under <= s.rank < over:
                    placed = replace(s, low=low, high=high, below=under, inside=over - under,
                                     pivots=None, expected=math.inf)
                    break
        sketched = ("sketch", placed.column, placed.low, placed.high)
        if placed.inside > gather_limit and sketched in aggregates:
            points = row[ask(*sketched)]
            at = (placed.rank - placed.below) / placed.inside * _GRID
            reach = 1 + math.ceil(2 * _GRID / accuracy)
            placed = replace(placed, pivots=(points[max(0, math.floor(at) - reach)],
                                             points[min(_GRID, math.ceil(at) + reach)]),
                             expected=placed.inside * 2 * (reach + 1) / _GRID)
        searches[key] = placed
    return found


def _fetch(df: DataFrame, values: dict[str, Column],
           searches: dict[tuple[str, int], _Search]) -> dict[tuple[str, int], float]:
    """Fetch the few values of each interval, counted by value, and pick the ranks."""
    intervals = list({s.interval(): None for s in searches.values()})
    tagged = F.array(*[
        F.struct(F.lit(i).alias("interval"), _between(values[c], low, high).alias("value"))
        for i, (c, low, high) in enumerate(intervals)])
    table = (df.select(F.inline(F.filter(tagged, lambda e: e["value"].isNotNull())))
             .groupBy("interval", "value").agg(F.count(F.lit(1)).alias("copies")).toArrow()
             .sort_by([("interval", "ascending"), ("value", "ascending")]))
    which, value, copies = (table[c].to_numpy() for c in ("interval", "value", "copies"))
    found = {}
    for key, s in searches.items():
        mine = which == intervals.index(s.interval())
        place = np.searchsorted(s.below + np.cumsum(copies[mine]), s.rank, side="right")
        found[key] = float(value[mine][place])
    return found

"""Stepwise selection on a cross-moment matrix that is swept in place.

Sweeping a column of a correlation matrix regresses all others on it; sweeping it again takes it
back. After any number of sweeps the matrix holds the slopes of the chosen columns, the inverse of their
correlations, and what they leave of every other column and of the target. A column that enters or leaves
costs one rank-one update, and the tests of all columns are read off the matrix.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np

from ..functions.tails import t_two_sided

#: Share of a column's variation under which the chosen columns are taken to span it: it is no pivot.
PIVOT_TOLERANCE = 1e-10
#: Values of t that differ by less than this share are equal: the first column counts, not the last digit.
TIE = 1e-9
#: Sweeps after which the matrix is made anew from the correlations.
REFRESH = 64


class SweptSelection:
    """Chosen columns, those that span the others as pivots, and tests of every column.

    ``comoment`` and ``mean`` are of the candidates, then the target; ``n`` rows were counted. A chosen
    column that the pivots span adds no direction: the coefficients are then those of least norm, in the
    columns' own units and with the intercept among them.
    """

    def __init__(self, comoment: np.ndarray, mean: np.ndarray, n: int) -> None:
        self.scale = np.sqrt(np.maximum(np.diag(comoment), 0.0))
        safe = np.where(self.scale > 0, self.scale, 1.0)
        self.correlation = comoment / np.outer(safe, safe)
        self.mean, self.n, self.target = mean, n, len(mean) - 1
        self.swept = self.correlation.copy()
        self.chosen: list[int] = []
        self.pivots: list[int] = []
        self.since = 0

    @property
    def spanned(self) -> list[int]:
        return [j for j in self.chosen if j not in set(self.pivots)]

    def _sweep(self, k: int) -> None:
        a = self.swept
        pivot, column, row = a[k, k], a[:, k].copy(), a[k] / a[k, k]
        a -= np.outer(column, row)
        a[k], a[:, k] = row, -column / pivot
        a[k, k] = 1.0 / pivot
        self.since += 1

    def _refreshed(self) -> None:
        if self.since >= REFRESH:
            self.swept = self.correlation.copy()
            for k in self.pivots:
                self._sweep(k)
            self.since = 0

    def _settle(self) -> None:
        """Make pivots of chosen columns that the pivots no longer span."""
        for j in self.spanned:
            if self.swept[j, j] > PIVOT_TOLERANCE:
                self._sweep(j)
                self.pivots.append(j)

    def enter(self, j: int) -> None:
        self.chosen.append(j)
        self._settle()
        self._refreshed()

    def leave(self, j: int) -> None:
        self.chosen.remove(j)
        if j in self.pivots:
            self.pivots.remove(j)
            self._sweep(j)
            self._settle()
        self._refreshed()

    def _solution(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weights, their spread for unit variance, and a basis of the idle directions.

        All in the order intercept, pivots, spanned columns, in the columns' own units.
        """
        pivots, spanned = self.pivots, self.spanned
        scale, middle = self.scale[pivots], self.mean[pivots]
        slopes = self.swept[pivots, self.target] * self.scale[self.target] / scale
        inverse = self.swept[np.ix_(pivots, pivots)] / np.outer(scale, scale)
        size = 1 + len(pivots) + len(spanned)
        inner = 1 + len(pivots)
        weights, spread = np.zeros(size), np.zeros((size, size))
        weights[0], weights[1:inner] = self.mean[self.target] - middle @ slopes, slopes
        lean = inverse @ middle
        spread[0, 0], spread[0, 1:inner], spread[1:inner, 0] = 1.0 / self.n + middle @ lean, -lean, -lean
        spread[1:inner, 1:inner] = inverse
        idle = np.zeros((size, len(spanned)))
        if spanned:
            idle[:inner] = self._idle(spanned)
            idle[inner:] = np.eye(len(spanned))
            idle, _ = np.linalg.qr(idle)
            weights = weights - idle @ (idle.T @ weights)
            keep = np.eye(size) - idle @ idle.T
            spread = keep @ spread @ keep
        return weights, spread, idle

    def _idle(self, columns: Sequence[int]) -> np.ndarray:
        """Intercept and pivots by which each spanned column is made up, negated; one column each."""
        pivots = self.pivots
        slopes = self.swept[np.ix_(pivots, columns)] * self.scale[columns] / self.scale[pivots][:, None]
        return -np.vstack([self.mean[columns] - self.mean[pivots] @ slopes, slopes])

    def _variance(self, degrees: int) -> float:
        return max(self.swept[self.target, self.target], 0.0) * self.scale[self.target] ** 2 / degrees if degrees > 0 else math.nan

    def inside(self) -> np.ndarray:
        """|t| of the chosen columns, in the order of ``chosen``; NaN where it is not defined."""
        weights, spread, _ = self._solution()
        variance = self._variance(self.degrees)
        place = {j: 1 + k for k, j in enumerate([*self.pivots, *self.spanned])}
        at = [place[j] for j in self.chosen]
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.abs(weights[at]) / np.sqrt(np.maximum(np.diag(spread)[at], 0.0) * variance)

    @property
    def degrees(self) -> int:
        """Residual degrees of freedom of the chosen columns."""
        return self.n - len(self.pivots) - 1

    def outside(self, columns: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
        """|t| each column would have next to the chosen ones, and whether they span it (one degree of freedom more)."""
        columns = np.asarray(columns)
        left = self.swept[columns, columns]
        spanned = left <= PIVOT_TOLERANCE
        t = np.full(len(columns), math.nan)
        fresh = np.flatnonzero(~spanned)
        degrees = self.degrees - 1
        if degrees > 0 and len(fresh):
            gain = self.swept[columns[fresh], self.target] ** 2 / left[fresh]
            remaining = np.maximum(self.swept[self.target, self.target] - gain, 0.0) / degrees
            with np.errstate(divide="ignore", invalid="ignore"):
                t[fresh] = np.where(remaining == 0, math.inf, np.sqrt(gain / remaining))
        old = np.flatnonzero(spanned)
        if len(old) and self.pivots:
            weights, spread, idle = self._solution()
            # The new idle direction of each column, less what the present ones hold of it.
            new = np.zeros((len(weights), len(old)))
            new[:1 + len(self.pivots)] = self._idle(columns[old])
            new -= idle @ (idle.T @ new)
            with np.errstate(divide="ignore", invalid="ignore"):
                t[old] = np.abs(new.T @ weights) / np.sqrt(np.maximum(np.einsum("ij,ik,kj->j", new, spread, new), 0.0) * self._variance(self.degrees))
        return t, spanned

    def best_outside(self, columns: Sequence[int]) -> tuple[float, int] | None:
        """Least p-value that one more column would have, and that column; of equal ones the first."""
        if not len(columns):
            return None
        t, spanned = self.outside(columns)
        found = []
        for kind, degrees in ((False, self.degrees - 1), (True, self.degrees)):
            here = np.flatnonzero((spanned == kind) & ~np.isnan(t))
            if len(here):
                # Of columns with equal degrees of freedom the largest t has the least p.
                j = here[int((t[here] >= t[here].max() * (1 - TIE)).argmax())]
                found.append((t_two_sided(float(t[j]), degrees), -t[j], int(j)))
        if not found:
            return None
        p, _, j = min(found)
        return p, columns[j]

    def worst_inside(self) -> tuple[float, int] | None:
        """Greatest p-value of a chosen column, and that column."""
        t = self.inside()
        if not len(t) or np.isnan(t).all():
            return None
        at = int((t <= np.nanmin(t) * (1 + TIE)).argmax())
        return t_two_sided(float(t[at]), self.degrees), self.chosen[at]

"""Tail probabilities of the t and F distributions.

Used on the driver for one value per coefficient or per column, never per row, and free
of JVM calls so that it also works through Spark Connect.

Both tails are tails of a beta variable X with parameters a, b. On the scale D = log(X / (1 - X))
- log(a / b) its density is exp(h(D)) with a single peak at 0, whatever a and b are, so a tail is
the ratio of two smooth integrals. No gamma function is needed, and nothing of the size of a or
b cancels: the tables these numbers are made for have up to 1e13 rows.
"""

from __future__ import annotations

import math

import numpy as np

# Nodes w and weights of the double-exponential rule for integrals over (0, inf).
_STEP = 1 / 32
_T = np.arange(-5.0, 7.0 + _STEP / 2, _STEP)
_NODES = np.exp(_T - np.exp(-_T))
_WEIGHTS = _STEP * _NODES * (1 + np.exp(-_T))

#: Below this distance from the peak the exponent is a series: its first two terms cancel there.
_SERIES = 0.01
_FAR = 700.0


def _exponent(a: float, b: float, d: np.ndarray) -> np.ndarray:
    """h(d) = a d - (a + b) log(1 + p (e^d - 1)) with p = a / (a + b), for a <= b."""
    n, p, q = a + b, a / (a + b), b / (a + b)
    s = np.clip(d, -_SERIES, _SERIES)
    v, r = p * q, 1 - 2 * p
    series = -n * v * s * s * (1 / 2 + s * (r / 6 + s * ((1 - 6 * v) / 24 + s * (
        r * (1 - 12 * v) / 120 + s * ((1 - 30 * v + 120 * v * v) / 720 + s * r * (1 - 60 * v + 360 * v * v) / 5040)))))
    far = np.clip(d, -_FAR, _FAR)
    direct = a * far - n * np.log1p(p * np.expm1(far))
    return np.where(np.abs(d) > _FAR, -np.inf, np.where(np.abs(d) < _SERIES, series, direct))


def _slope(a: float, b: float, d: float) -> float:
    e = math.expm1(min(d, _FAR))
    p, q = a / (a + b), b / (a + b)
    return -a * q * e / (1 + p * e)


def _mass(a: float, b: float, d: float, side: int) -> float:
    """Integral of exp(h - h(d)) from d away from the peak: to the right (1) or to the left (-1)."""
    width = math.sqrt((a + b) / (a * b))
    steep = abs(_slope(a, b, d))
    scale = min(width, 1 / steep) if steep > 0 else width
    base = float(_exponent(a, b, np.array([d]))[0])
    values = np.exp(_exponent(a, b, d + side * scale * _NODES) - base)
    return scale * float(values @ _WEIGHTS)


def _below(a: float, b: float, d: float) -> float:
    """P(D < d)."""
    if a > b:
        return _above(b, a, -d)
    return _tail(a, b, d, -1) if d < 0 else 1.0 - _tail(a, b, d, 1)


def _above(a: float, b: float, d: float) -> float:
    """P(D > d)."""
    if a > b:
        return _below(b, a, -d)
    return _tail(a, b, d, 1) if d >= 0 else 1.0 - _tail(a, b, d, -1)


def _tail(a: float, b: float, d: float, side: int) -> float:
    if abs(d) > _FAR:
        return 0.0
    whole = _mass(a, b, 0.0, 1) + _mass(a, b, 0.0, -1)
    height = float(_exponent(a, b, np.array([d]))[0])
    return math.exp(height) * _mass(a, b, d, side) / whole


def f_upper(f: float, df1: float, df2: float) -> float:
    """P(F > f)."""
    if math.isnan(f) or df1 <= 0 or df2 <= 0:
        return math.nan
    if f <= 0:
        return 1.0
    if math.isinf(f):
        return 0.0
    return _below(df2 / 2.0, df1 / 2.0, -math.log(f))


def t_two_sided(t: float, df: float) -> float:
    """P(|T| > |t|)."""
    if math.isnan(t) or df <= 0:
        return math.nan
    if math.isinf(t):
        return 0.0
    if t == 0:
        return 1.0
    return _below(df / 2.0, 0.5, -2.0 * math.log(abs(t)))


def t_quantile(p: float, df: float) -> float:
    """Inverse of the t distribution function, for 0 < p < 1."""
    if df <= 0 or not 0.0 < p < 1.0:
        return math.nan
    if p == 0.5:
        return 0.0
    tail = 2.0 * min(p, 1.0 - p)
    high = 1.0
    while t_two_sided(high, df) > tail:
        high *= 2.0
    low = 0.0 if high == 1.0 else high / 2.0
    while True:
        middle = 0.5 * (low + high)
        if middle in (low, high):
            break
        if t_two_sided(middle, df) > tail:
            low = middle
        else:
            high = middle
    return math.copysign(high, p - 0.5)

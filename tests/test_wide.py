"""Tiled cross moments and selection by sweeps."""

import math
import time

import numpy as np
import pandas as pd
import pytest

from tablewright.functions.tails import t_two_sided
from tablewright.operators import features, regression, tiles
from tablewright.operators.sweep import SweptSelection


def test_passes_hold_every_upper_tile_once():
    for size, tile, layers, stripe in ((10, 3, 1, 20), (7, 256, 6, 1), (1000, 256, 6, 1 << 25), (3001, 256, 1, 1 << 25)):
        passes = tiles.tile_passes(size, tile, layers, stripe)
        n = -(-size // tile)
        assert sorted(t for p in passes for t in p) == [(i, j) for i in range(n) for j in range(i, n)]
        side = min(tile, size)
        assert all(len(p) == 1 or len(p) * layers * side * side <= stripe for p in passes)
    assert len(tiles.tile_passes(3001, 256, 1)) == 1


@pytest.mark.parametrize("tile, stripe", [(256, 1 << 25), (7, 1 << 25), (7, 150)])
def test_moments_do_not_depend_on_tiles(spark, monkeypatch, tile, stripe):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 20)) @ rng.normal(size=(20, 20)) + 1e5
    x[rng.random(x.shape) < 0.01] = np.nan
    names = [f"c{i}" for i in range(20)]
    frame = spark.createDataFrame(pd.DataFrame(x, columns=names)).repartition(6)
    monkeypatch.setattr(tiles.complete_products, "__defaults__", (tile, stripe))
    monkeypatch.setattr(tiles.pairwise_products, "__defaults__", (tile, stripe))
    found = regression.moments(frame, names, tile=tile)
    whole = x[~np.isnan(x).any(axis=1)]
    assert found.n == len(whole) and found.rows_dropped == len(x) - len(whole)
    assert np.allclose(found.mean, whole.mean(axis=0), rtol=1e-12)
    assert np.allclose(found.comoment, np.cov(whole.T, bias=True) * len(whole), rtol=1e-9)
    assert np.allclose(regression.pairwise_correlation(frame, names, tile=tile), pd.DataFrame(x).corr(), atol=1e-9)


def test_means_of_many_columns_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(tiles, "BUILTIN_MEANS", 1)
    names = list("abcdefgh")
    x = np.arange(80.0).reshape(10, 8)
    x[3, 2] = np.nan
    frame = spark.createDataFrame(pd.DataFrame(x, columns=names))
    rows, mean = tiles.column_means(regression._numbered(frame, names))
    assert rows == 10 and np.allclose(mean, np.nanmean(x, axis=0))
    assert regression.moments(frame, names).n == 9
    none = regression.moments(frame.limit(0), names)
    assert none.n == 0 and none.rows_dropped == 0
    assert np.isnan(regression.pairwise_correlation(frame.limit(0), names)).all()


def test_tile_plan_has_no_row_of_all_cells(spark):
    """A share is one tile; the sums of different tiles are different groups."""
    frame = regression._numbered(spark.createDataFrame(pd.DataFrame(np.ones((50, 9)), columns=list("abcdefghi"))), list("abcdefghi"))
    rows = tiles.complete_products(frame, np.zeros(9), 4).collect()
    assert sorted((r["i"], r["j"]) for r in rows) == [(0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2)]
    assert max(len(r["cells"]) for r in rows) == 16


# --- selection -----------------------------------------------------------------------------

def exact_moments(data, names):
    x = data[names].to_numpy(dtype=float)
    mean = x.mean(axis=0)
    return regression.Moments(tuple(names), len(x), 0, mean, (x - mean).T @ (x - mean))


def plain_stepwise(found, target, candidates, initial=(), p_in=0.05, p_out=0.1):
    """Every candidate of every round fitted by itself."""
    def last_p(columns):
        model = regression.fit(found, target, columns)
        t = model.t_values()[-1]
        return t_two_sided(float(t), model.df_resid), -abs(t)

    pool, chosen = [c for c in candidates if not found.constant(c)], list(initial)
    while True:
        changed = False
        ranked = [(*last_p([*chosen, c]), i, c) for i, c in enumerate(pool) if c not in chosen]
        ranked = [r for r in ranked if not math.isnan(r[0])]
        if ranked and min(ranked)[0] < p_in:
            # Equal but for rounding: the first.
            chosen.append(next(r[-1] for r in ranked if r[0] <= min(ranked)[0] * (1 + 1e-6)))
            changed = True
        if chosen:
            p = np.nan_to_num(regression.fit(found, target, chosen).p_values()[1:], nan=-1.0)
            if p.max() > p_out:
                chosen.pop(int((p >= p.max() * (1 - 1e-6)).argmax()))
                changed = True
        if not changed:
            return chosen


@pytest.mark.parametrize("seed", range(6))
def test_sweeps_select_what_single_fits_select(seed):
    rng = np.random.default_rng(seed)
    n = 150
    data = pd.DataFrame(rng.normal(size=(n, 8)), columns=[f"x{i}" for i in range(8)])
    data["mode"] = (rng.random(n) > 0.4).astype(float)
    data["mode2"] = data["mode"] ** 2
    data["twice"] = 2 * data["x0"] + 7
    data["sum"] = data["x1"] + data["mode"] - 3
    data["near"] = data["x2"] + 0.01 * rng.normal(size=n)
    data["y"] = data["x0"] + 0.5 * data["sum"] + 0.3 * data["x2"] + data["mode"] + rng.normal(size=n)
    names = [c for c in data if c != "y"]
    found = exact_moments(data, [*names, "y"])
    for initial in ((), ("mode", "mode2"), ("x0", "x7", "twice"), ("sum", "x1", "mode", "mode2")):
        assert regression.stepwise(found, "y", names, initial=initial) == plain_stepwise(found, "y", names, initial)


def test_tests_of_a_swept_state_are_those_of_the_fit():
    rng = np.random.default_rng(9)
    data = pd.DataFrame(rng.normal(size=(80, 5)) * [1, 10, 0.1, 3, 5] + [0, 50, 2, -8, 1], columns=list("abcde"))
    data["f"] = data["a"] * 3 - data["b"] + 4
    data["y"] = data["a"] - data["c"] + rng.normal(size=80)
    names = list("abcdef")
    found = exact_moments(data, [*names, "y"])
    state = SweptSelection(found.comoment, found.mean, found.n)
    for step in ("+0", "+1", "+5", "+3", "-0", "+0", "-1", "-3", "+4", "-5"):
        (state.enter if step[0] == "+" else state.leave)(int(step[1]))
        chosen = [names[j] for j in state.chosen]
        model = regression.fit(found, "y", chosen)
        assert model.df_resid == state.degrees
        assert np.allclose(state.inside(), np.abs(model.t_values()[1:]), rtol=1e-7)
        rest = [j for j in range(6) if j not in state.chosen]
        t, _ = state.outside(rest)
        assert np.allclose(t, [abs(regression.fit(found, "y", [*chosen, names[j]]).t_values()[-1]) for j in rest], rtol=1e-6)
    # The matrix is made anew now and then; that changes nothing.
    before = state.swept.copy()
    state.since = 10**6
    state._refreshed()
    assert np.allclose(before, state.swept, atol=1e-9)


def test_degree_two_candidates(spark, tracks):
    """All polynomials of the audio columns, some of them copies of their base."""
    audio = ["danceability", "energy", "key", "loudness", "mode", "speechiness", "acousticness", "instrumentalness", "liveness", "valence",
             "tempo", "duration_ms", "artist_popularity", "year"]
    built = features.engineer(tracks.drop("album", "artist_name", "track_name"), {"features": {
        "drop": ["artist_genres"], "audio_features": audio, "polynomial": {"audio": {"degree": 2}}}})
    names = [c for c, kind in built.dtypes if kind in ("double", "int") and c != "track_popularity"]
    assert len(names) >= 110
    found = regression.moments(built, [*names, "track_popularity"], tile=32)
    chosen = regression.stepwise(found, "track_popularity", names)
    assert chosen == plain_stepwise(found, "track_popularity", names) and chosen


def test_two_thousand_candidates_in_seconds():
    rng = np.random.default_rng(4)
    n, p = 6000, 2000
    x = rng.normal(size=(n, p))
    x[:, 1500:] = x[:, :500] * 2 + 1
    y = x[:, :40] @ rng.uniform(0.5, 1, 40) + 2 * rng.normal(size=n)
    z = np.column_stack([x, y])
    mean = z.mean(axis=0)
    found = regression.Moments((*[f"x{i}" for i in range(p)], "y"), n, 0, mean, (z - mean).T @ (z - mean))
    began = time.perf_counter()
    chosen = regression.stepwise(found, "y", found.columns[:-1], threshold_in=1e-6, threshold_out=1e-5)
    assert time.perf_counter() - began < 120
    picked = {int(c[1:]) for c in chosen}
    assert {j if j < 1500 else j - 1500 for j in picked} >= set(range(40))
    model = regression.fit(found, "y", chosen)
    assert np.nanmax(model.p_values()[1:]) <= 1e-5

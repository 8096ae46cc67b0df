"""Seeding in few passes and points that skip their distances."""

import numpy as np
import pandas as pd
import pytest

from tablewright.operators import clustering


def groups(n, k, width=3, seed=0, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.uniform(-10, 10, (k, width))
    which = rng.integers(0, k, n)
    return centres, centres[which] + spread * rng.normal(size=(n, width))


def frame(spark, x):
    return spark.createDataFrame(pd.DataFrame({"id": range(len(x)), "p": list(x)}), "id long, p array<double>")


def plain_lloyd(x, centres, max_iter, tolerance):
    slack = tolerance * x.var(axis=0).mean()
    for step in range(max_iter + 1):
        gaps = ((x[:, None, :] - centres) ** 2).sum(axis=2)
        nearest, cost = gaps.argmin(axis=1), gaps.min(axis=1).sum()
        moved = np.array([x[nearest == j].mean(axis=0) if (nearest == j).any() else c for j, c in enumerate(centres)])
        rest = ((moved - centres) ** 2).sum() <= slack
        if rest or step == max_iter:
            return centres, cost, rest, step + 1
        centres = moved


@pytest.mark.parametrize("offset", [0.0, 1e6])
def test_updates_equal_plain_lloyd_with_fewer_distances(spark, monkeypatch, offset):
    rng = np.random.default_rng(3)
    _, x = groups(3000, 8, spread=1.2)
    x = x + offset
    starts = [x[rng.choice(len(x), 8, replace=False)] for _ in range(3)]
    for passes, share in ((1, 0.1), (3, 0.5), (1000, 0.5)):
        monkeypatch.setattr(clustering, "MARGIN_PASSES", passes)
        monkeypatch.setattr(clustering, "OPEN_SHARE", share)
        monkeypatch.setattr(clustering, "MARGIN_WORK", 0)
        monkeypatch.setattr(clustering, "FEW_CENTRES", 64 if passes == 1 else 2)
        runs, n, work = clustering._fit_runs(frame(spark, x).repartition(4), ["p"], 3, [8, 8, 8], starts, 1, 60, 1e-9)
        assert n == 3000
        steps = 0
        for run, start in zip(runs, starts):
            centres, cost, rest, took = plain_lloyd(x, start, 60, 1e-9)
            steps = max(steps, took)
            assert np.allclose(run.centres, centres, rtol=1e-9, atol=1e-6) and run.cost == pytest.approx(cost, rel=1e-6) and run.converged == rest
        assert work.passes == steps and work.seeding == 0
        assert work.tested == work.plain if passes == 1000 else work.tested < 0.7 * work.plain


def test_a_hundred_starts_in_six_passes(spark):
    centres, x = groups(5000, 100)
    runs, _, work = clustering._fit_runs(frame(spark, x).repartition(5), ["p"], 3, [100], None, 7, 100, 1e-6)
    assert work.seeding <= 6
    # Near the cost of the true centres, and far from that of centres drawn at random.
    best = ((x[:, None, :] - centres) ** 2).sum(axis=2).min(axis=1).sum()
    random = plain_lloyd(x, x[np.random.default_rng(1).choice(5000, 100, replace=False)], 100, 1e-6)[1]
    assert runs[0].cost < 0.5 * random
    assert best * 0.8 < runs[0].cost < best * 40


def test_starts_do_not_depend_on_partitions_or_copies(spark):
    _, x = groups(400, 5, spread=1.0)
    once = frame(spark, x)
    points = [df.selectExpr("p", "xxhash64(p) AS h") for df in (once.coalesce(1), once.repartition(7), once.union(once))]
    found = [clustering._draw(p, [x[:2]], [9], 5, 1)[0] for p in points]
    assert np.array_equal(found[0], found[1]) and np.array_equal(found[0], found[2]) and found[0].shape == (9, 3)
    starts, passes = clustering._spread_starts(points[0], [1, 4, 4], 5)
    other, _ = clustering._spread_starts(points[1], [1, 4, 4], 5)
    assert [s.shape for s in starts] == [(1, 3), (4, 3), (4, 3)] and passes == 6
    assert all(np.allclose(a, b) for a, b in zip(starts, other)) and not np.allclose(starts[1], starts[2])


def test_fewer_points_than_centres(spark):
    x = np.array([[0.0, 0.0], [1.0, 1.0], [0.0, 0.0]] * 10)
    fit = clustering.kmeans_fit(frame(spark, x), ["p"], 4, n_init=2)
    assert fit.inertia == 0.0 and fit.converged and fit.centres.shape == (4, 2)
    rows = fit.table.collect()
    assert len({(tuple(r["p"]), r["cluster"]) for r in rows}) == 2


def test_a_fit_leaves_no_written_table(spark, shared):
    import os
    _, x = groups(300, 3)
    before = set(os.listdir(shared))
    clustering.kmeans_fit(frame(spark, x), ["p"], 3, n_init=2)
    assert set(os.listdir(shared)) == before


def test_silhouette_of_many_clusters(spark):
    """As many clusters as rows have room for, some of one row, and rows without one."""
    rng = np.random.default_rng(5)
    x, c = rng.normal(size=(120, 2)), np.concatenate([np.arange(30), rng.integers(0, 30, 80), [-7] * 10])
    df = spark.createDataFrame(pd.DataFrame({"id": range(120), "p": list(x), "cluster": c})).selectExpr(
        "id", "p", "CASE WHEN cluster >= 0 THEN cluster END AS cluster")
    x, c = x[c >= 0], c[c >= 0]
    gap = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    want = []
    for i in range(len(x)):
        size = (c == c[i]).sum()
        rest = min(gap[i][c == k].mean() for k in set(c.tolist()) - {c[i]})
        own = gap[i][c == c[i]].sum() / max(size - 1, 1)
        want.append(0.0 if size == 1 else (rest - own) / max(rest, own))
    for rows in (4_000, 17):
        assert clustering.silhouette_euclidean(df, "id", ["p"], block_rows=rows).first()[0] == pytest.approx(np.mean(want))


def test_far_from_zero(spark):
    _, x = groups(500, 3, spread=0.5)
    near, far = (clustering.kmeans_fit(frame(spark, x + o), ["p"], 3, n_init=2) for o in (0.0, 1e8))
    assert far.inertia == pytest.approx(near.inertia, rel=1e-3) and far.converged

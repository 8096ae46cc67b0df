import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright.functions import tails
from tablewright.operators import clustering, features, regression, scoring, stats


def table(spark, **cols):
    return spark.createDataFrame(pd.DataFrame(cols))


# --- distributions -------------------------------------------------------------------------

def test_tails_agree_with_an_independent_implementation(spark):
    maths = spark._jvm.org.apache.commons.math3.distribution
    for df in (1.0, 2.0, 7.0, 30.0, 1995.0, 1e6):
        t_dist = maths.TDistribution(df)
        for t in (0.0, 0.3, 1.96, 5.0, 12.0):
            assert tails.t_two_sided(t, df) == pytest.approx(2 * t_dist.cumulativeProbability(-t), rel=1e-8, abs=1e-300)
        for p in (0.025, 0.4, 0.975, 0.999):
            assert tails.t_quantile(p, df) == pytest.approx(t_dist.inverseCumulativeProbability(p), rel=1e-6)
    for d1, d2 in ((1.0, 5.0), (4.0, 9995.0), (199.0, 30.0)):
        f_dist = maths.FDistribution(d1, d2)
        for f in (0.1, 1.0, 3.0):
            assert tails.f_upper(f, d1, d2) == pytest.approx(1 - f_dist.cumulativeProbability(f), rel=1e-6)


def test_tails_edges():
    assert tails.t_quantile(0.975, 10) == pytest.approx(2.228138851964939)
    assert tails.t_two_sided(math.inf, 5) == 0.0 and math.isnan(tails.t_two_sided(1.0, 0))
    assert 0 < tails.t_two_sided(40.0, 2000) < 1e-200
    assert tails.f_upper(0.0, 2, 3) == 1.0


# --- metrics -------------------------------------------------------------------------------

def metrics(spark, y, p, k=1):
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    return stats.regression_metrics(df, "y", "p", k).first().asDict()


def test_metrics_fixture(spark):
    m = metrics(spark, [10, 20, 30, 40, 50], [12, 18, 33, 38, 52], 2)
    want = {"mse": 5.0, "rmse": math.sqrt(5), "mae": 2.2, "r2": 0.975, "adj_r2": 0.95, "mape": 9.8}
    assert {k: m[k] for k in want} == pytest.approx(want)


@pytest.mark.parametrize("y, p, mape", [
    ([100, 200, 300], [110, 180, 330], 10.0), ([0, 200, 300], [10, 180, 330], 10.0), ([0, 0], [1, 2], None), ([], [], None)])
def test_mape(spark, y, p, mape):
    assert metrics(spark, y, p)["mape"] == (pytest.approx(mape) if mape else None)


def test_perfect_fit_and_degrees_of_freedom(spark):
    assert metrics(spark, [10, 20, 30], [10, 20, 30], 2)["adj_r2"] is None
    m = metrics(spark, [10, 20, 30], [10, 20, 30], 1)
    assert (m["r2"], m["adj_r2"], m["mse"]) == (1.0, 1.0, 0.0)


def test_constant_target_and_empty(spark):
    assert metrics(spark, [5, 5, 5], [5, 5, 5])["r2"] == 1.0
    assert metrics(spark, [5, 5, 5], [5, 5, 6])["r2"] == 0.0
    empty = metrics(spark, [], [])
    assert empty.pop("n") == 0 and all(v is None for v in empty.values())


def test_aligned_metrics(spark):
    y = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0)], "k int, y double")
    p = spark.createDataFrame([(3, 30.0), (1, 10.0)], "k int, p double")
    assert stats.aligned_metrics(y, p, "k", "y", "p", 1).first()["n"] == 2
    with pytest.raises(ValueError, match="3 actual rows but 2"):
        stats.aligned_metrics(y, p, "k", "y", "p", 1, strict=True)
    nobody = p.withColumn("k", F.col("k") + 10)
    assert stats.aligned_metrics(y, nobody, "k", "y", "p", 1).first()["mse"] is None


# --- regression ----------------------------------------------------------------------------

def design(n=400, seed=5):
    rng = np.random.default_rng(seed)
    a, b, c, d = rng.random(n), 2 * rng.random(n), 0.5 * rng.random(n) + 1e4, rng.random(n)
    y = 3 * a - 2 * b + 0.5 * c + rng.normal(0, 0.1, n)
    return pd.DataFrame({"A": a, "B": b, "C": c, "D": d, "y": y})


def reference_fit(x, y):
    """Least squares straight from the rows, with the pseudo-inverse of the design."""
    z = np.column_stack([np.ones(len(x)), x])
    pinv = np.linalg.pinv(z, rcond=1e-12)
    beta = pinv @ y
    rank = np.linalg.matrix_rank(z, tol=1e-12 * np.linalg.norm(z, 2))
    rss = ((y - z @ beta) ** 2).sum()
    cov = pinv @ pinv.T * rss / (len(y) - rank)
    return beta, np.sqrt(np.diag(cov)), rank, rss, pinv @ pinv.T


@pytest.mark.parametrize("narrow", [1, 10])
def test_fit_matches_row_level_least_squares(spark, monkeypatch, narrow):
    monkeypatch.setattr(regression, "NARROW_COLUMNS", narrow)
    data = design()
    df = spark.createDataFrame(data)
    names = ["A", "B", "C", "D"]
    for parts in (1, 7):
        found = regression.moments(df.repartition(parts), [*names, "y"])
        model = regression.fit(found, "y", names)
        beta, err, rank, rss, _ = reference_fit(data[names].to_numpy(), data["y"].to_numpy())
        assert np.allclose([model.intercept, *model.coefficients], beta, rtol=1e-6)
        assert np.allclose(model.standard_errors(), err, rtol=1e-6)
        assert model.rank == rank and model.rss == pytest.approx(rss, rel=1e-7)


def test_fit_agrees_with_the_library_solver(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    data = spark.createDataFrame(design())
    names = ["A", "B", "D"]
    found = regression.fit(regression.moments(data, [*names, "y"]), "y", names)
    vectors = VectorAssembler(inputCols=names, outputCol="v").transform(data)
    other = LinearRegression(featuresCol="v", labelCol="y", solver="normal").fit(vectors)
    assert np.allclose(found.coefficients, other.coefficients.toArray(), rtol=1e-8)
    assert np.allclose(found.p_values()[1:], other.summary.pValues[:-1], rtol=1e-6, atol=1e-12)


def test_collinear_columns_get_the_minimum_norm_solution(spark):
    data = design()
    data["flag"] = (data["A"] > 0.5).astype(float)
    data["flag2"] = data["flag"] ** 2
    data["sum"] = data["A"] + data["flag"]
    names = ["A", "flag", "flag2", "sum", "B"]
    model = regression.fit(regression.moments(spark.createDataFrame(data), [*names, "y"]), "y", names)
    x, y = data[names].to_numpy(), data["y"].to_numpy()
    beta, err, rank, rss, inverse = reference_fit(x, y)
    assert model.rank == rank == 4
    assert np.allclose([model.intercept, *model.coefficients], beta, rtol=1e-6, atol=1e-8)
    assert np.allclose(model.standard_errors(), err, rtol=1e-6)
    z = np.column_stack([np.ones(len(x)), x - model.centre])
    assert np.allclose(np.einsum("ij,jk,ik->i", z, model.kernel, z),
                       np.einsum("ij,jk,ik->i", np.column_stack([np.ones(len(x)), x]), inverse,
                                 np.column_stack([np.ones(len(x)), x])), rtol=1e-6)


def assert_settled(data, names, target, chosen, p_in=0.05, p_out=0.1):
    """No column outside would enter, none inside would leave; fitted from the rows."""
    def p_values(cols):
        beta, err, rank, _, _ = reference_fit(data[cols].to_numpy(), data[target].to_numpy())
        return [tails.t_two_sided(t, len(data) - rank) for t in (beta / err)[1:]]

    assert len(set(chosen)) == len(chosen) and set(chosen) <= set(names)
    assert all(p_values([*chosen, c])[-1] >= p_in for c in names if c not in chosen)
    assert not chosen or max(p_values(list(chosen))) <= p_out


@pytest.mark.parametrize("seed", range(4))
def test_stepwise_ends_settled(spark, seed):
    rng = np.random.default_rng(seed)
    data = pd.DataFrame(rng.normal(size=(60, 7)), columns=list("abcdefg"))
    data["h"] = data["a"] + data["b"] + 0.05 * rng.normal(size=60)
    data["y"] = data["a"] + data["b"] + 0.4 * data["c"] + rng.normal(size=60)
    names = list("abcdefgh")
    found = regression.moments(spark.createDataFrame(data), [*names, "y"])
    for initial in ((), ("g",), ("a", "b", "d")):
        chosen = regression.stepwise(found, "y", names, initial=initial)
        assert_settled(data, names, "y", chosen)
        # From nothing the column of the largest correlation comes first.
        if not initial:
            best = max(names, key=lambda c: abs(np.corrcoef(data[c], data["y"])[0, 1]))
            assert best == chosen[0] or best not in chosen


def test_stepwise_keeps_the_signal(spark):
    data = design(100, 1)
    found = regression.moments(spark.createDataFrame(data), list("ABCD") + ["y"])
    chosen = regression.stepwise(found, "y", list("ABCD"))
    assert {"A", "B", "C"} <= set(chosen)
    # A column that is there at the start leaves if it adds nothing.
    assert set(regression.stepwise(found, "y", list("ABCD"), initial=["D"])) == set(chosen)
    with pytest.raises(ValueError):
        regression.stepwise(found, "y", ["A"], threshold_in=0.2, threshold_out=0.1)


def test_train_fallbacks(spark):
    rng = np.random.default_rng(0)
    noise = pd.DataFrame({"a": rng.normal(size=30), "k": 4.0, "y": rng.normal(size=30)})
    found = regression.moments(spark.createDataFrame(noise), ["a", "k", "y"])
    assert regression.train(found, "y", ["a", "k"], threshold_in=1e-9).features == ("a",)
    assert regression.train(found, "y", ["a", "k"], select=False).features == ("a",)
    with pytest.raises(ValueError):
        regression.train(found, "y", ["k"])
    with pytest.raises(ValueError):
        regression.fit(regression.moments(spark.createDataFrame(noise).limit(0), ["a", "y"]), "y", ["a"])


def test_incomplete_rows_are_counted(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (3.0, float("nan")), (2.0, 5.0)], "x double, y double")
    found = regression.moments(df, ["x", "y"])
    assert (found.n, found.rows_dropped) == (2, 2)


def test_model_table_roundtrip_and_coefficients(spark):
    model = regression.fit(regression.moments(spark.createDataFrame(design()), ["A", "B", "y"]), "y", ["A", "B"])
    back = regression.model_from_frame(regression.model_frame(spark, model))
    assert back.features == model.features and back.rss == model.rss and np.array_equal(back.kernel, model.kernel)
    rows = regression.coefficient_table(spark, model).collect()
    assert [r["feature"] for r in rows] == ["const", "A", "B"] and rows[1]["p"] < 1e-10


@pytest.mark.parametrize("limit", [0, 20])
def test_interval_width_and_coverage(spark, monkeypatch, limit):
    monkeypatch.setattr(regression, "NARROW_INTERVAL", limit)
    data, fresh = design(1500, 2), design(1500, 3)
    names = ["A", "B", "C"]
    model = regression.fit(regression.moments(spark.createDataFrame(data), [*names, "y"]), "y", names)
    rows = regression.predict(spark.createDataFrame(fresh), model).toPandas()
    inside = ((rows["y"] >= rows["prediction_pi_lower"]) & (rows["y"] <= rows["prediction_pi_upper"])).mean()
    assert 0.93 < inside < 0.97
    _, _, rank, rss, inverse = reference_fit(data[names].to_numpy(), data["y"].to_numpy())
    z = np.column_stack([np.ones(len(fresh)), fresh[names].to_numpy()])
    lever = np.einsum("ij,jk,ik->i", z, inverse, z)
    half = tails.t_quantile(0.975, 1500 - rank) * np.sqrt(rss / (1500 - rank) * (1 + lever))
    got = (rows["prediction_pi_upper"] - rows["prediction_pi_lower"]) / 2
    assert np.allclose(np.sort(got), np.sort(half), rtol=1e-6)


def test_predict_needs_every_feature(spark):
    model = regression.fit(regression.moments(spark.createDataFrame(design()), ["A", "y"]), "y", ["A"])
    with pytest.raises(ValueError, match="A"):
        regression.predict(spark.range(1), model)


# --- groups --------------------------------------------------------------------------------

def test_anova_by_hand(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("a", 2.0, 5.0), ("b", 4.0, 5.0), ("b", 5.0, 5.0), (None, 9.0, 1.0)],
                               "g string, x double, flat double")
    rows = {r["column"]: r for r in stats.anova(df, "g").collect()}
    assert rows["x"]["f_statistic"] == pytest.approx(18.0)
    assert rows["x"]["p_value"] == pytest.approx(0.0513167, rel=1e-5)
    assert rows["flat"]["f_statistic"] is None


def test_group_profile_spread(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 3.0), (2, 8.0), (2, 8.0)], "cluster int, x double")
    row = stats.group_profile(df, "cluster").first()
    assert row["Average"] == 4.0 and row["Std.dev"] == pytest.approx(np.std([1, 3, 8], ddof=1))
    compat = stats.group_profile(df, "cluster", groups=[0, 1, 2], compat=True).first()
    assert compat["Std.dev"] == pytest.approx(np.std([1, 3, 8, 4], ddof=1))


# --- clusters ------------------------------------------------------------------------------

def blobs(n=300, seed=0):
    rng = np.random.default_rng(seed)
    centre = rng.integers(0, 3, n)
    x = np.array([[0, 0], [10, 0], [0, 10]])[centre] + rng.normal(size=(n, 2))
    return pd.DataFrame({"id": range(n), "x": x[:, 0], "y": x[:, 1]})


def test_sweep_finds_the_blobs(spark):
    data = blobs()
    df = spark.createDataFrame(data).repartition(5)
    rows = {r["k"]: r["inertia"] for r in clustering.kmeans_sweep(df, ["x", "y"], range(1, 5), n_init=3).collect()}
    x = data[["x", "y"]].to_numpy()
    assert rows[1] == pytest.approx(((x - x.mean(axis=0)) ** 2).sum())
    assert all(rows[k] >= rows[k + 1] * 0.999 for k in range(1, 4))
    cost = clustering.kmeans_fit(df, ["x", "y"], 3).inertia
    assert rows[3] == pytest.approx(cost, rel=1e-6)


def test_assignment_inertia_silhouette(spark, monkeypatch):
    data = blobs(120)
    df = spark.createDataFrame(data)
    centres = [[0.0, 0.0], [10.0, 0.0], [0.0, 10.0]]
    narrow = clustering.assign_nearest(df, ["x", "y"], centres)
    monkeypatch.setattr(clustering, "NARROW_TERMS", 0)
    wide = clustering.assign_nearest(df, ["x", "y"], centres)
    assert narrow.exceptAll(wide).count() == 0
    rows = narrow.toPandas().sort_values("id")
    x, c = rows[["x", "y"]].to_numpy(), rows["cluster"].to_numpy()
    assert np.array_equal(c, ((x[:, None] - np.array(centres)) ** 2).sum(2).argmin(1))
    want = sum(((x[c == k] - x[c == k].mean(0)) ** 2).sum() for k in range(3))
    assert clustering.inertia(narrow, ["x", "y"]).first()[0] == pytest.approx(want)
    for power, value in ((1, clustering.silhouette_euclidean(narrow, "id", ["x", "y"], block_rows=25).first()[0]),
                         (2, clustering.silhouette(narrow, ["x", "y"]))):
        gap = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) ** power
        s = []
        for i in range(len(x)):
            own = gap[i][c == c[i]].sum() / ((c == c[i]).sum() - 1)
            rest = min(gap[i][c == k].mean() for k in set(c) - {c[i]})
            s.append((rest - own) / max(rest, own))
        assert value == pytest.approx(np.mean(s))


# --- responses -----------------------------------------------------------------------------

@pytest.mark.parametrize("value, bucket", [
    (20.0, "bust"), (20.04, "bust"), (20.06, "not successful"), (40.0, "not successful"), (60.0, "maybe"),
    (80.0, "great chance"), (80.1, "hit"), (-5.0, "bust"), (None, None)])
def test_buckets(spark, value, bucket):
    df = spark.createDataFrame([("Song", value)], "t string, prediction double")
    row = scoring.with_response(df, title="t").first()
    assert row["bucket"] == bucket
    if value == 20.06:
        assert row["message"] == "'Song' will not be successful! It has an expected success of 20.1%!"


def test_scorer_keeps_rows_and_input_columns(spark, tracks):
    names = ["danceability", "genre_pop", "audio_poly__artist_popularity_danceability"]
    config = {"features": {"drop": ["artist_genres", "album"], "audio_features": ["artist_popularity", "danceability"],
                           "polynomial": {"audio": {"degree": 2}}}}
    built = features.engineer(tracks, config)
    model = regression.fit(regression.moments(built, [*names, "track_popularity"]), "track_popularity", names)
    scorer = scoring.Scorer(model, config=config)
    scored = scorer.score(tracks)
    assert scored.columns == [*tracks.columns, "prediction", "prediction_pi_lower", "prediction_pi_upper"]
    assert scored.count() == tracks.count() and scored.filter("prediction is null").count() == 0
    assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()
    direct = regression.predict(built, model).agg(F.sum("prediction")).first()[0]
    assert scored.agg(F.sum("prediction")).first()[0] == pytest.approx(direct)
    with pytest.raises(ValueError, match="genre_pop"):
        scorer.score(tracks.drop("artist_genres"))


def test_scorer_fills_absent_scaled_columns_and_replaces_old_predictions(spark):
    from tablewright.operators.prep import ColumnTransform, Preprocessor
    data = spark.createDataFrame(design())
    model = regression.fit(regression.moments(data, ["A", "B", "y"]), "y", ["A", "B"])
    prep = Preprocessor((ColumnTransform("B", 1.0, -0.5, 2.0),))
    rows = spark.createDataFrame([(1, 0.5, 99.0)], "id int, A double, prediction double")
    out = scoring.Scorer(model, prep).score(rows)
    assert out.columns == ["id", "A", "prediction", "prediction_pi_lower", "prediction_pi_upper"]
    want = model.intercept + 0.5 * model.coefficients[0] + 0.25 * model.coefficients[1]
    assert out.first()["prediction"] == pytest.approx(want)
    with pytest.raises(ValueError, match="B"):
        scoring.Scorer(model, prep, fill_missing=False).score(rows)


def test_kmeans_does_not_depend_on_partitions_and_skips_incomplete_rows(spark):
    data = [(i, [float(i % 3) * 10 + (i * 7919 % 101) / 50, float(i % 3) + (i * 104729 % 97) / 60]) for i in range(300)]
    odd = [(1000, None), (1001, [1.0, None]), (1002, [float("nan"), 1.0]), (1003, [1.0]), (1004, [])]
    df = spark.createDataFrame(data + odd, "id int, p array<double>")
    results = []
    for parts in (1, 7):
        dealt = df.repartition(parts)
        sweep = [(r["k"], pytest.approx(r["inertia"], rel=1e-9), r["converged"])
                 for r in clustering.kmeans_sweep(dealt, ["p"], (1, 3), n_init=2).collect()]
        fit = clustering.kmeans_fit(dealt, ["p"], 3, n_init=2)
        assert fit.left_out == 5 and fit.converged
        clusters = {r["id"]: r["cluster"] for r in fit.table.collect()}
        assert len(clusters) == 305 and all((clusters[i] is None) == (i >= 1000) for i in clusters)
        # Three separate blobs: the rows of each have one cluster.
        assert len({(i % 3, c) for i, c in clusters.items() if c is not None}) == 3
        results.append(sweep)
    assert [(k, c) for k, _, c in results[0]] == [(k, c) for k, _, c in results[1]]
    assert [i.expected for _, i, _ in results[0]] == [i for _, i, _ in results[1]]
    stopped = clustering.kmeans_sweep(df, ["p"], [4], max_iter=0, n_init=1).first()
    assert stopped["converged"] is False
    with pytest.raises(ValueError):
        clustering.kmeans_fit(df.where("id >= 1000"), ["p"], 2)


def test_silhouette_pairs_are_allowed_explicitly(spark):
    df = spark.createDataFrame([(i, float(i), i % 2) for i in range(20)], "id int, x double, cluster int")
    with pytest.raises(ValueError, match="190 pairs"):
        clustering.silhouette_euclidean(df, "id", ["x"], max_pairs=189)

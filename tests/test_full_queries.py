"""Registered queries without SQL, held against plain computations over the rows."""

import numpy as np
import pytest

from checks import job_queries, model_queries
from checks.base import QUERIES, part_features
from tablewright.operators import clustering, features, split
from tablewright.plans import jobs
from tablewright.schema import numeric_columns

from test_kmeans_work import plain_lloyd
from test_models import reference_fit
from test_wide import exact_moments, plain_stepwise

SF = "/root/testdata/sf0.001"


def test_selection_from_all_products(spark):
    table = features.add_polynomials(part_features(spark, SF), model_queries.ALL_CANDIDATES, prefix="poly__").toPandas()
    names = [*model_queries.ALL_CANDIDATES, *[c for c in table.columns if c.startswith("poly__")]]
    assert len(names) == 35
    chosen = plain_stepwise(exact_moments(table, [*names, "revenue"]), "revenue", names)
    rows = {r["feature"]: r for r in QUERIES["stepwise"](spark, SF).collect()}
    assert set(rows) == {"const", *chosen}
    x, y = table[chosen].to_numpy(float), table["revenue"].to_numpy()
    # Columns of very different size: solved in units of their spread.
    middle, scale = x.mean(axis=0), x.std(axis=0)
    beta, err, rank, rss, _ = reference_fit((x - middle) / scale, y)
    assert np.allclose([rows[c]["coefficient"] for c in chosen], beta[1:] / scale, rtol=1e-5)
    assert np.allclose([rows[c]["std_err"] for c in chosen], err[1:] / scale, rtol=1e-5)
    metrics = QUERIES["stepwise_metrics"](spark, SF).first()
    assert metrics["mse"] == pytest.approx(rss / len(y), rel=1e-5) and metrics["n"] == len(y)


def test_jobs_with_all_products(spark):
    """Training, evaluation and scoring of the feature table that the jobs stored."""
    job = job_queries._trained(spark, SF)
    table = spark.read.parquet(job.features_path)
    names = numeric_columns(table, [job.key, "revenue"])
    fit_rows, test_rows = (t.toPandas() for t in split.train_test(table, job.key, 0.2, job.seed))
    chosen = plain_stepwise(exact_moments(fit_rows, [*names, "revenue"]), "revenue", names)
    middle, scale = fit_rows[chosen].mean().to_numpy(), fit_rows[chosen].std().to_numpy()
    beta, _, rank, _, _ = reference_fit((fit_rows[chosen].to_numpy() - middle) / scale, fit_rows["revenue"].to_numpy())

    def mse(rows):
        z = np.column_stack([np.ones(len(rows)), (rows[chosen].to_numpy() - middle) / scale])
        return ((rows["revenue"].to_numpy() - z @ beta) ** 2).mean()

    assert QUERIES["job_train"](spark, SF).first()["mse"] == pytest.approx(mse(test_rows), rel=1e-5)
    assert QUERIES["job_evaluate"](spark, SF).first()["mse"] == pytest.approx(mse(table.toPandas()), rel=1e-5)
    scored = QUERIES["job_score"](spark, SF).toPandas()
    assert len(scored) == 20 and scored["prediction"].notna().all()
    assert (scored["prediction_pi_lower"] < scored["prediction"]).all() and (scored["prediction"] < scored["prediction_pi_upper"]).all()


def test_default_clusters(spark):
    """Every run of the sweep equals plain steps from its starts; the fit's clusters are at rest."""
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    x = np.array([r["embedding"] for r in rows.collect()], dtype=float)
    found = {r["k"]: r for r in QUERIES["kmeans_elbow"](spark, SF).collect()}
    assert sorted(found) == list(range(1, 11))
    ks = [k for k in range(1, 11) for _ in range(1 if k == 1 else 10)]
    points = rows.selectExpr("CAST(embedding AS array<double>) AS p").selectExpr("p", "xxhash64(p) AS h")
    starts, passes = clustering._spread_starts(points, ks, 42)
    assert passes == 6
    best = {}
    for k, start in zip(ks, starts):
        _, cost, rest, _ = plain_lloyd(x, start, 300, 1e-4)
        best[k] = min(best.get(k, (np.inf, False)), (cost, rest))
    for k, (cost, rest) in best.items():
        assert found[k]["inertia"] == pytest.approx(cost, rel=1e-9) and found[k]["converged"] == rest
    clusters = {r["vec_id"]: r["cluster"] for r in QUERIES["kmeans_assign"](spark, SF).collect()}
    which = np.array([clusters[r["vec_id"]] for r in rows.collect()])
    means = np.array([x[which == j].mean(axis=0) for j in range(3)])
    nearest = ((x[:, None, :] - means) ** 2).sum(axis=2).argmin(axis=1)
    assert (nearest == which).mean() > 0.98


def test_cluster_job(spark):
    rows = QUERIES["job_cluster"](spark, SF).toPandas().sort_values("cluster")
    job = job_queries._job(spark, SF)
    table = jobs.preprocess(job).toPandas()
    columns = ["qty", "disc", "p_retailprice", "price"]
    assert rows["size"].sum() == len(table) and len(rows) == 3
    x, means = table[columns].to_numpy(), rows[columns].to_numpy()
    nearest = ((x[:, None, :] - means) ** 2).sum(axis=2).argmin(axis=1)
    assert np.abs(np.bincount(nearest, minlength=3) - rows["size"].to_numpy()).max() <= 0.03 * len(x)

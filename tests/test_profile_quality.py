import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.operators import profile, quality, quantiles
from tablewright.operators.quality import Expectation


def test_shape_and_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, None), (3, None)], "col1 int, col2 string")
    assert profile.shape(df).first().asDict() == {"n_rows": 5, "n_cols": 2, "columns": "col1,col2"}
    assert profile.duplicate_rows(df).first()[0] == 2
    assert profile.duplicate_rows(df.limit(0)).first()[0] == 0


def test_summary(spark):
    df = spark.createDataFrame([(i, c, i + i / 10) for i, c in zip(range(1, 6), "abcda")],
                               "col1 int, col2 string, col3 double")
    rows = {r["column"]: r for r in profile.summary(df).collect()}
    assert rows["col1"]["mean"] == 3.0 and rows["col1"]["q25"] == 2.0 and rows["col1"]["max"] == 5.0
    assert rows["col1"]["std"] == pytest.approx(math.sqrt(2.5)) and rows["col1"]["unique"] is None
    assert (rows["col2"]["unique"], rows["col2"]["top"], rows["col2"]["freq"]) == (4, "a", 2)
    assert rows["col2"]["mean"] is None and rows["col3"]["q50"] == 3.3


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert profile.null_audit(df).first()["n_null"] == 2
    assert profile.summary(df).first()["max"] == 1.0


def test_histogram_edges_and_constant(spark):
    df = spark.createDataFrame([(float(i), 7.0, None) for i in range(21)], "x double, same double, none double")
    rows = profile.histogram(df).collect()
    by = {c: {r["bin"]: r["count"] for r in rows if r["column"] == c} for c in ("x", "same")}
    assert len(rows) == 40 and sum(by["x"].values()) == 21 and by["x"][20] == 2
    assert sum(by["same"].values()) == 21


def test_labels(spark):
    df = spark.createDataFrame([("['pop'; 'uk pop']",), ("['pop']",), ("[]",), (None,)], "g string")
    assert [tuple(r) for r in profile.top_labels(df, "g", 2).collect()] == [("pop", 2), ("", 1)]
    assert profile.explode_labels(df, "g").count() == 4


@pytest.mark.parametrize("kind", ["spread", "copies", "two", "extreme"])
def test_quantiles_without_buffering_match_numpy(spark, kind):
    rng = np.random.default_rng(3)
    x = {"spread": rng.normal(size=6000),
         "copies": np.where(rng.random(6000) < 0.7, 5.0, rng.normal(size=6000) * 100),
         "two": np.where(np.arange(6000) < 1500, 1.0, 2.0),
         "extreme": np.exp(rng.normal(size=6000) * 20) * np.sign(rng.normal(size=6000))}[kind]
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "x double").repartition(5)
    p = [0.0, 0.01, 0.25, 0.5, 0.75, 1.0]
    got = quantiles.exact_quantiles(df, ["x"], p, buffer_limit=10, gather_limit=50, accuracy=500)["x"]
    assert np.allclose(got, np.quantile(x, p), rtol=1e-12)
    assert np.allclose(quantiles.exact_quantiles(df, ["x"], p)["x"], np.quantile(x, p), rtol=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert quantiles.exact_quantiles(df, ["x"], [0.5]) == {"x": [None]}
    assert quantiles.approx_quantiles(df, ["x"], [0.5]) == {"x": [None]}


def test_correlation_paths_agree(spark):
    from tablewright.operators import regression
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 6)) + 1000
    x[:, 5] = 3.0
    x[rng.random(x.shape) < 0.1] = np.nan
    import pandas as pd
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abcdef")))
    wide = regression.pairwise_correlation(df, list("abcdef"))
    want = pd.DataFrame(x).corr().to_numpy()
    assert np.allclose(wide[:5, :5], want[:5, :5], atol=1e-10)
    narrow = regression.pairwise_correlation(df, list("abc"))
    assert np.allclose(narrow, want[:3, :3], atol=1e-10)
    strong = profile.strong_correlations(profile.correlations(df, list("ab"))).collect()
    assert sum(r["r"] is not None for r in strong) == 2


VALID = [(2020, "a", 50, 0.5), (2021, "b", 60, 0.7)]
SCHEMA = "year int, track_name string, track_popularity int, energy double"
EXPECT = [Expectation("year", "int", min=2000, max=2025), Expectation("track_name", "str"),
          Expectation("track_popularity", "int", min=0, max=100),
          Expectation("energy", "float", required=False, min=0.0519, max=0.999)]


def test_valid_table_passes(spark):
    report = quality.validate(spark.createDataFrame(VALID, SCHEMA), EXPECT)
    assert report.result == "pass" and not report.errors
    quality.enforce(report)


@pytest.mark.parametrize("change, text", [
    (lambda df: df.drop("track_name"), "Missing required column: track_name"),
    (lambda df: df.withColumn("year", F.col("year").cast("string")), "has dtype 'string', expected 'int'"),
    (lambda df: df.withColumn("track_popularity", F.lit(150)), "2 values above max (100)"),
    (lambda df: df.withColumn("energy", F.lit(0.01)), "2 values below min (0.0519)"),
    (lambda df: df.withColumn("year", F.when(F.col("year") > 2020, F.col("year"))), "1 missing values (required)"),
])
def test_broken_tables_raise(spark, change, text):
    report = quality.validate(change(spark.createDataFrame(VALID, SCHEMA)), EXPECT)
    assert report.result == "fail"
    with pytest.raises(ValueError, match=text.replace("(", r"\(").replace(")", r"\)")):
        quality.enforce(report)
    quality.enforce(report, "warn")


def test_optional_missing_values_warn(spark):
    df = spark.createDataFrame([(2020, "a", 1, None)], SCHEMA)
    report = quality.validate(df, EXPECT)
    assert report.result == "pass" and "optional" in report.warnings[0]
    assert quality.validate(df.drop("energy"), EXPECT).details["energy"]["status"] == "not present (optional)"


def test_bounds_count(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 15, -5, 8)], "test_col int")
    detail = quality.validate(df, [Expectation("test_col", "int", min=0, max=10)]).details["test_col"]
    assert (detail["below_min"], detail["above_max"]) == (1, 1)


@pytest.mark.parametrize("sql, accepted", [
    ("tinyint", "int"), ("bigint", "int"), ("float", "float"), ("double", "float"), ("string", "str"),
    ("binary", "str"), ("boolean", "bool")])
def test_type_classes(spark, sql, accepted):
    df = spark.sql(f"SELECT CAST(NULL AS {sql}) AS c")
    for kind in ("int", "float", "str", "bool", "datetime"):
        report = quality.validate(df, [Expectation("c", kind, required=False)])
        assert (not report.errors) == (kind == accepted)


def test_disabled_and_empty_config(spark):
    df = spark.createDataFrame(VALID, SCHEMA)
    assert quality.validate_config(df, {"data_validation": {"enabled": False}}) is None
    empty = quality.validate_config(df, {})
    assert empty.result == "pass" and empty.document(spark).first()["details"] == {}


def test_report_tables(spark):
    report = quality.validate(spark.createDataFrame(VALID, SCHEMA).drop("year"), EXPECT)
    assert report.table(spark).count() == 4
    document = report.document(spark).first()
    assert document["result"] == "fail" and document["details"]["year"]["status"] == "missing"


def test_rules(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (4,)], "col1 int")
    rows = quality.rule_report(df, max_null_percentage=10, min_rows=10).collect()
    assert [(r["rule"], r["value"], r["passed"]) for r in rows] == [
        ("max_null_percentage", 25.0, False), ("min_rows", 4.0, False)]


def test_record_rules(spark):
    good = dict(track_name="t", year=2007, artist_popularity=75.0, genre="rock", danceability=0.7, energy=0.5,
                liveness=0.1, loudness=61.0, speechiness=0.05, tempo=75.0, valence=0.4, duration_ms=207959.0,
                acousticness=0.5, key=1.0)
    rows = [good, good | {"year": 1899, "tempo": 0.0}, good | {"energy": 1.5}, good | {"genre": None}]
    df = spark.createDataFrame(rows)
    valid, rejected = quality.split_records(df)
    assert valid.count() == 1
    assert sorted(sorted(r["violations"]) for r in rejected.collect()) == [["energy"], ["genre"], ["tempo", "year"]]
    assert quality.split_records(df.drop("key"))[0].count() == 0


def test_valid_records_are_filtered_at_the_scan(spark, tmp_path):
    rows = [(1.0,), (float("nan"),), (None,), (-1.0,), (9.0,)]
    spark.createDataFrame(rows, "x double").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    valid, rejected = quality.split_records(df, [quality.RecordRule("x", 0.0)])
    assert sorted(r.x for r in valid.collect()) == [1.0, 9.0] and rejected.count() == 3
    assert "GreaterThanOrEqual(x" in valid._jdf.queryExecution().toString().split("PushedFilters")[1]

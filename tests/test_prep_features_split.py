import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.functions.labels import GENRE_PATTERNS, flag_name
from tablewright.operators import columns, features, prep, split


def test_iqr_fixture(spark):
    df = spark.createDataFrame(list(zip([1, 2, 100, 3, 4, None], range(5, 11), [1] * 6, "uvwxyz")),
                               "A int, B int, flat int, C string")
    assert prep.iqr_bounds(df, "A") == (-1.0, 7.0)
    assert prep.filter_outliers(df, ["A"]).count() == 4
    assert prep.filter_outliers(df, ["B"]).count() == 6
    assert prep.filter_outliers(df, ["flat"]).count() == 6
    assert prep.filter_outliers(df, ["C", "D"]).count() == 6
    assert prep.filter_outliers(df, []).count() == 6
    assert prep.filter_outliers(df, ["flat"], skip_zero_iqr=False).count() == 6


def test_iqr_filters_use_rows_kept_so_far(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=500), rng.normal(size=500)
    b[a > 1.2] += 30
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    keep = np.ones(500, bool)
    for x in (a, b):
        q1, q3 = np.quantile(x[keep], [0.25, 0.75])
        keep &= (x >= q1 - 0.5 * (q3 - q1)) & (x <= q3 + 0.5 * (q3 - q1))
    assert prep.filter_outliers(df, ["a", "b"], 0.5).count() == keep.sum()


def test_outlier_filter_is_pushed_to_the_scan(spark, tmp_path):
    spark.range(100).select(F.col("id").cast("double").alias("x"), "id").write.parquet(str(tmp_path / "t"))
    plan = prep.filter_outliers(spark.read.parquet(str(tmp_path / "t")), ["x"])._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(x" in plan.split("PushedFilters")[1]


@pytest.mark.parametrize("strategy, fill", [("mean", 4.0), ("median", 3.0), ("most_frequent", 1.0), ("constant", -1.0)])
def test_imputation(spark, strategy, fill):
    df = spark.createDataFrame([(1.0,), (1.0,), (None,), (5.0,), (9.0,)], "x double")
    fitted = prep.fit_imputer(df, ["x"], strategy, fill_value=-1.0)
    assert fitted.transforms[0].fill == fill
    assert prep.transform(df, fitted).filter("x is null").count() == 0


def test_most_frequent_tie_takes_the_smallest(spark):
    df = spark.createDataFrame([(v,) for v in (9.0, 9.0, 2.0, 2.0, 5.0)], "x double")
    assert prep.fit_imputer(df, ["x"], "most_frequent").transforms[0].fill == 2.0


def test_scaling_statistics_after_filling(spark):
    values = [1.0, 2.0, None, 3.0, 100.0, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for strategy, fill in (("mean", 26.5), ("median", 2.5), ("constant", -50.0)):
        x = np.array([fill if v is None else v for v in values])
        for method, want in (("minmax", (x - x.min()) / (x.max() - x.min())), ("standard", (x - x.mean()) / x.std())):
            fitted = prep.fit_preprocessor(df, ["x"], strategy=strategy, method=method, fill_value=-50.0)
            got = [r.x for r in prep.transform(df, fitted).collect()]
            assert np.allclose(sorted(got), np.sort(want), atol=1e-12)


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(7.0, None), (7.0, None)], "same double, none double")
    for method in ("minmax", "standard"):
        out = prep.transform(df, prep.fit_preprocessor(df, ["same", "none"], method=method))
        assert [tuple(r) for r in out.collect()] == [(0.0, None)] * 2


def test_layouts_and_errors(spark):
    df = spark.createDataFrame([("k", 1.0, 2)], "name string, x double, n int")
    fitted = prep.fit_preprocessor(df, ["n", "x"])
    assert prep.transform(df, fitted).columns == ["n", "x", "name"]
    assert prep.apply_stored(df, fitted).columns == df.columns
    assert prep.apply_stored(df.drop("n"), fitted).columns == ["name", "x"]
    with pytest.raises(ValueError):
        prep.transform(df.drop("n"), fitted)
    with pytest.raises(ValueError):
        prep.fit_preprocessor(df, ["gone"])
    with pytest.raises(ValueError):
        prep.fit_preprocessor(df, ["x"], strategy="guess")


def test_scaling_by_name_not_position(spark):
    df = spark.createDataFrame([(0.0, 10.0), (10.0, 30.0)], "a double, b double")
    fitted = prep.fit_preprocessor(df, ["a", "b"])
    assert prep.apply_stored(df.select("b", "a"), fitted).orderBy("a").first().asDict() == {"b": 0.0, "a": 0.0}


LABELS = [("pop rock", "pop rock"), ("hip hop jazz", "hip-hop jazz"), ("electronic house", "electronic"),
          ("latin reggaeton", "latin"), ("metal punk", "metal"), ("classical symphony", "classic"),
          ("country", "country"), ("indie rock", "indie rock"), ("r&b soul", "r&b"), ("unknown genre", ""),
          ("POP Rock", "pop rock"), (None, ""), ("electropop", "pop electronic")]


def test_label_flags(spark):
    df = spark.createDataFrame([(t,) for t, _ in LABELS], "artist_genres string")
    for row in features.add_label_flags(df).collect():
        want = dict(LABELS)[row["artist_genres"]].split()
        got = [g for g in GENRE_PATTERNS if row[flag_name(g)] == 1]
        assert sorted(got) == sorted(want), row["artist_genres"]


def test_label_flags_edge_tables(spark):
    flags = [flag_name(g) for g in GENRE_PATTERNS]
    assert "genre_hip_hop" in flags and "genre_randb" in flags
    empty = spark.createDataFrame([], "artist_genres string")
    assert features.add_label_flags(empty).columns == ["artist_genres", *flags]
    other = spark.range(2)
    assert features.add_label_flags(other).columns == ["id"]
    zeros = features.add_label_flags(other, on_missing="zeros")
    assert all(v == 0 for r in zeros.drop("id").collect() for v in r)


def test_polynomial_names_and_counts():
    names = [features.term_name(t) for t in features.polynomial_terms(["a", "b"], 3)]
    assert names == ["a", "b", "apow2", "a_b", "bpow2", "apow3", "apow2_b", "a_bpow2", "bpow3"]
    assert len([t for t in features.polynomial_terms(range(9), 2) if len(t) > 1]) == 45
    assert features.term_name(()) == "1" and features.term_name(("my col", "x")) == "my_col_x"


def test_polynomials(spark):
    df = spark.createDataFrame([(.1, .5, "t"), (.2, .6, "t")], "danceability double, energy double, s string")
    out = features.add_polynomials(df, ["danceability", "energy", "s", "none"], prefix="audio_poly__")
    assert out.columns[3:] == ["audio_poly__danceabilitypow2", "audio_poly__danceability_energy",
                               "audio_poly__energypow2"]
    assert [round(r[4], 10) for r in out.collect()] == [0.05, 0.12]
    assert features.add_polynomials(df, ["s"], prefix="p__").columns == df.columns
    first = features.add_polynomials(df, ["energy"], prefix="p__", degree=1)
    assert first.columns[-1] == "p__energy"


def test_feature_table_excludes_target_and_profiling(spark, tracks):
    config = {"target": "track_popularity", "features": {
        "exclude": ["year"], "profiling_variables": ["artist_popularity", "energy", "mode"],
        "drop": ["track_name", "album", "artist_name", "artist_genres"],
        "audio_features": ["danceability", "energy"], "genre_features": list(GENRE_PATTERNS),
        "polynomial": {"audio": {"degree": 2}, "genre": {"degree": 2}}}}
    got = features.feature_table(tracks, config).columns
    assert "track_popularity" not in got and "energy" not in got and "year" not in got
    assert "audio_poly__danceability_energy" in got and "genre_pop" in got
    assert sum(c.startswith("genre_poly__") for c in got) == 66


def test_column_operators(spark):
    df = spark.createDataFrame([(1, 2.0, True, "x")], "num__a int, remainder__num__b double, c boolean, d string")
    assert columns.strip_prefixes(df, ["num__", "remainder__"]).columns == ["a", "num__b", "c", "d"]
    assert columns.select_numeric(df).columns == ["num__a", "remainder__num__b"]
    assert columns.drop_columns(df, ["zzz"]).columns == df.columns
    assert columns.add_columns(df, {"c": F.lit(1), "e": F.lit(1)}).columns == [*df.columns, "e"]
    assert columns.missing_columns(df, ["c", "q"]) == ["q"]
    with pytest.raises(ValueError, match="q"):
        columns.project_as_double(df, ["num__a", "q"])
    assert columns.add_intercept(df).columns[0] == "const"
    assert columns.unmatched(spark.range(5), spark.range(3), "id").count() == 2


@pytest.mark.parametrize("n, size, want", [(10, 0.1, 1), (10, 0.25, 3), (1, 0.5, 1), (997, 0.2, 200), (3, 0.99, 3)])
def test_exact_split_sizes(spark, n, size, want):
    rest, part = split.split_exact(spark.range(n), "id", size)
    assert (part.count(), rest.count()) == (want, n - want)


def test_split_ignores_layout_and_is_disjoint(spark):
    df = spark.range(500)
    parts = [{r.id for r in split.split_exact(df.repartition(k), "id", 0.3)[1].collect()} for k in (1, 7)]
    assert parts[0] == parts[1] and len(parts[0]) == 150
    rest = {r.id for r in split.split_exact(df, "id", 0.3)[0].collect()}
    assert rest | parts[0] == set(range(500)) and not rest & parts[0]


def test_exact_split_needs_several_digit_steps(spark, monkeypatch):
    monkeypatch.setattr(split, "_HEX_STEP", 1)
    assert split.split_exact(spark.range(3000), "id", 0.123)[1].count() == 369


def test_holdout_only_for_proper_sizes(spark):
    df = spark.range(10)
    for size in (None, 0, 1, 1.0, 0.0, "0.1", 2):
        assert split.holdout(df, "id", size)[1] is None
    assert split.holdout(df, "id", 0.1)[1].count() == 1


def test_train_test_independent_of_holdout(spark):
    df = spark.range(2000)
    held = {r.id for r in split.split_exact(df, "id", 0.2)[1].collect()}
    test = {r.id for r in split.train_test(df, "id", 0.2)[1].collect()}
    assert 40 < len(held & test) < 130
    loose = split.train_test(df, "id", 0.2, exact=False)[1].count()
    assert 300 < loose < 500


def test_empty_split(spark):
    rest, part = split.split_exact(spark.range(0), "id", 0.5)
    assert rest.count() == part.count() == 0


def test_flags_named_by_their_labels(spark):
    from tablewright.functions.labels import EXPLORATION_PATTERNS
    df = spark.createDataFrame([("puerto rican r&b",), (None,)], "g string")
    out = features.add_label_flags(df, "g", EXPLORATION_PATTERNS, prefix=None)
    assert {"hip-hop", "r&b", "soul"} <= set(out.columns)
    row = out.filter("g is not null").first()
    assert (row["latin"], row["r&b"], row["soul"]) == (1, 1, 0)

import os

import pytest
from pyspark.sql import functions as F

from tablewright.operators import regression, scoring
from tablewright.plans import jobs
from tablewright.sources import sinks
from tablewright.streaming.scoring import open_stream, route_stream, score_stream

AUDIO = ["danceability", "energy", "liveness", "loudness", "speechiness", "tempo", "valence", "duration_ms",
         "artist_popularity"]
CONFIG = {
    "target": "track_popularity",
    "data_source": {"type": "csv", "raw_path": "raw.csv", "processed_path": "processed",
                    "inference_holdout_path": "holdout", "inference_holdout_size": 0.1},
    "data_validation": {"report_path": "report", "schema": {"columns": [
        {"name": "year", "dtype": "int", "min": 2000, "max": 2025},
        {"name": "track_popularity", "dtype": "int", "min": 0, "max": 100}]}},
    "data_split": {"test_size": 0.2, "random_state": 42},
    "preprocessing": {"drop_columns": ["instrumentalness"],
                      "outlier_removal": {"enabled": True, "features": ["duration_ms", "track_popularity"]},
                      "scale": {"columns": ["danceability", "energy", "loudness", "tempo", "duration_ms", "key"],
                                "method": "minmax"}},
    "features": {"exclude": ["year"], "profiling_variables": ["artist_popularity", "energy", "mode"],
                 "drop": ["track_name", "album", "artist_name", "artist_genres"], "audio_features": AUDIO,
                 "genre_features": ["pop", "rock", "latin", "hip-hop"],
                 "polynomial": {"audio": {"degree": 2}, "genre": {"degree": 2}}},
    "model": {"active": "linear_regression", "linear_regression": {"save_path": "model", "stepwise": {"enabled": True}}},
    "artifacts": {"metrics_path": "metrics", "preprocessing_pipeline": "prep", "processed_dir": "processed_features"},
}


@pytest.fixture(scope="module")
def job(spark, tracks, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("job"))
    sinks.write_table(tracks.coalesce(2), f"{base}/raw.csv", "csv")
    return jobs.JobContext(spark, CONFIG, base)


def test_jobs_end_to_end(spark, job):
    profile = jobs.load_and_profile(job, f"{job.base_dir}/sets")
    assert profile["shape"].first()["n_rows"] == 600 and profile["sample"].count() == 100
    assert jobs.validate(job, f"{job.base_dir}/sets").result == "pass"
    assert sinks.read_dataset(spark, f"{job.base_dir}/sets", "validated_data:latest").count() == 600

    processed = jobs.preprocess(job)
    assert "instrumentalness" not in processed.columns
    assert spark.read.parquet(f"{job.base_dir}/holdout").count() == 60
    ends = processed.agg(F.min("tempo"), F.max("tempo"), F.count("*")).first()
    assert tuple(ends)[:2] == (0.0, 1.0) and ends[2] <= 540

    table = jobs.build_features(job)
    names = sinks.read_column_list(spark, job.feature_list_path)
    assert "track_popularity" not in names and [c for c in table.columns if c in names] == names

    model, metrics = jobs.train(job)
    assert metrics.first()["r2"] > 0.8 and metrics.first()["split"] == "test"
    assert any("artist_popularity" in f for f in model.features)
    assert jobs.evaluate(job, "all").first()["n"] == table.count()
    tested = jobs.evaluate(job, rows="test").first()
    assert tested["mse"] == pytest.approx(metrics.first()["mse"])

    held = spark.read.parquet(f"{job.base_dir}/holdout")
    scored = spark.read.parquet(jobs.batch_score(job, held, f"{job.base_dir}/predictions"))
    assert scored.count() == 60 and scored.columns[-3:] == ["prediction", "prediction_pi_lower", "prediction_pi_upper"]
    error = scored.agg(F.avg(F.abs(F.col("track_popularity") - F.col("prediction")))).first()[0]
    assert error < 5


def test_validation_failure_stops_but_leaves_a_report(spark, job):
    config = {**CONFIG, "data_validation": {"report_path": "bad_report", "schema": {"columns": [
        {"name": "year", "dtype": "int", "max": 2001}, {"name": "nope"}]}}}
    bad = jobs.JobContext(spark, config, job.base_dir)
    with pytest.raises(ValueError):
        jobs.validate(bad)
    assert spark.read.json(f"{job.base_dir}/bad_report").first()["result"] == "fail"
    off = jobs.JobContext(spark, {**CONFIG, "data_validation": {"enabled": False}}, job.base_dir)
    assert jobs.validate(off) is None


def test_train_rejects_bad_configurations(spark, job, tmp_path):
    with pytest.raises(ValueError, match="not known"):
        jobs.train(jobs.JobContext(spark, {**CONFIG, "model": {"active": "knn"}}, job.base_dir))
    spark.range(3).write.parquet(str(tmp_path / "processed_features" / "features"))
    with pytest.raises(ValueError, match="target"):
        jobs.train(jobs.JobContext(spark, CONFIG, str(tmp_path)))


@pytest.fixture()
def records(spark, tracks, tmp_path):
    rows = tracks.withColumn("genre", F.lit("rock")).withColumn(
        "tempo", F.when(F.col("year") == 2003, F.lit(0.0)).otherwise(F.col("tempo")))
    rows.repartition(4).write.parquet(str(tmp_path / "in"))
    return spark.read.parquet(str(tmp_path / "in"))


def simple_scorer(records):
    model = regression.fit(regression.moments(records, ["energy", "valence", "track_popularity"]),
                           "track_popularity", ["energy", "valence"])
    return scoring.Scorer(model)


def test_stream_scores_like_batch(spark, records, tmp_path):
    scorer = simple_scorer(records)
    stream = open_stream(spark, str(tmp_path / "in"), records.schema, maxFilesPerTrigger=1)
    for _ in range(2):      # the second run finds nothing new
        score_stream(stream, scorer, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.exceptAll(scorer.score(records)).count() == 0 and got.count() == 600


def test_stream_routes_invalid_records(spark, records, tmp_path):
    stream = open_stream(spark, str(tmp_path / "in"), records.schema)
    out = [str(tmp_path / n) for n in ("valid", "rejected", "cp2")]
    route_stream(stream, *out).awaitTermination()
    assert spark.read.parquet(out[0]).count() == 570
    rejected = spark.read.parquet(out[1])
    assert rejected.count() == 30 and rejected.first()["violations"] == ["tempo"]


def test_score_records(spark, records):
    out = scoring.score_records(records, simple_scorer(records))
    assert out.columns == ["track_name", "year", "prediction", "success", "bucket", "message"]
    assert out.count() == 570 and out.filter("message is null").count() == 0


def test_contract(spark):
    import __spark_entry__ as contract
    queries, oracles = contract.queries(), contract.oracle_sql()
    assert len(queries) > 90 and set(oracles) <= set(queries)
    if os.path.isdir(contract.SMOKE_DIR):
        assert contract.entry(spark).count() > 0


def test_all_steps_in_one_call_and_clusters(spark, tracks, tmp_path):
    base = str(tmp_path)
    sinks.write_table(tracks.coalesce(2), f"{base}/raw.csv", "csv")
    job = jobs.JobContext(spark, {**CONFIG, "model": {**CONFIG["model"], "kmeans": {"k_max": 2, "n_clusters": 2}}}, base)
    out = jobs.run_all(job, f"{base}/sets")
    assert out["shape"].first()["n_rows"] == 600 and out["scored"].count() == 60
    assert out["trained"].first()["split"] == "test" and out["evaluated"].first()["n"] > out["trained"].first()["n"]
    assert "prediction_pi_upper" in out["scored"].columns
    found = jobs.cluster(job, ["energy", "tempo"])
    assert [r["k"] for r in found["elbow"].collect()] == [1, 2]
    assert sum(r["size"] for r in found["sizes"].collect()) == found["assigned"].count()
    assert {r["column"] for r in found["profile"].collect()} == {"energy", "tempo"}


def test_preprocess_leaves_no_parsed_copy(spark, tracks, shared, tmp_path):
    sinks.write_table(tracks.coalesce(2), f"{tmp_path}/raw.csv", "csv")
    jobs.preprocess(jobs.JobContext(spark, CONFIG, str(tmp_path)))
    assert not [name for name in os.listdir(shared) if name.startswith("parsed-")]

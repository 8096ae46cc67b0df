"""Queries of the composed jobs and of streaming."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators import incremental, quality, regression
from tablewright.operators.prep import ColumnTransform, Preprocessor
from tablewright.operators.scoring import Scorer
from tablewright.plans import jobs
from tablewright.session import shared_folder, written
from tablewright.sources import sinks
from tablewright.streaming.quality import stream_report, watch_quality
from tablewright.streaming.scoring import open_stream, route_stream, score_stream

from .base import (ORACLES, PART_FEATURES_SQL, PLANTED_FEATURES_SQL, fixed_model, fixed_prediction_sql,
                   part_features, planted_features, query, read, rounded, t_quantile_sql)
from .model_queries import _iqr_step
from .table_queries import _summary_sql

# --- streaming -----------------------------------------------------------------------------


def _events_stream(spark, d):
    schema = read(spark, d, "events").schema
    return open_stream(spark, d, schema, pathGlobFilter="events.parquet")


def _timed(table):
    """The time as a number: its text differs between engines."""
    return table.withColumn("ts", F.unix_micros(F.col("ts").cast("timestamp")))


_point, _half = fixed_prediction_sql(("(value - 10) / 80", "CAST(user_id AS DOUBLE)", "value * user_id"))


@query("stream_score", f"""
SELECT event_id, epoch_us(ts) AS ts, user_id, event_type, value, props, round({_point}, 9) AS prediction,
       round({_point} - {_half}, 3) AS prediction_pi_lower, round({_point} + {_half}, 3) AS prediction_pi_upper
FROM events""".replace(
    "value * user_id", "((value - 10) / 80) * user_id"))
def stream_score(spark, d):
    scorer = Scorer(
        fixed_model(("value", "user_id", "audio_poly__value_user_id")),
        Preprocessor((ColumnTransform("value", 50.0, 10.0, 80.0),)),
        {"features": {"audio_features": ["value", "user_id"], "polynomial": {"audio": {"degree": 2}}}})
    stream = _events_stream(spark, d)
    out = shared_folder(spark, "stream")
    score_stream(stream, scorer, f"{out}/scored", f"{out}/checkpoint").awaitTermination()
    return rounded(rounded(_timed(spark.read.parquet(f"{out}/scored")), 9, "prediction"), 3,
                   "prediction_pi_lower", "prediction_pi_upper")


_EVENT_RULES = (quality.RecordRule("event_type"), quality.RecordRule("value", 1.0, 120.0),
                quality.RecordRule("user_id", 0.0, low_open=True))


@query("stream_quarantine", """
WITH c AS (SELECT event_id, epoch_us(ts) AS ts, user_id, event_type, value, props, concat_ws(',',
    CASE WHEN value < 1.0 OR value > 120.0 THEN 'value' END, CASE WHEN user_id <= 0 THEN 'user_id' END) AS violations
  FROM events)
SELECT *, CASE WHEN violations = '' THEN 'valid' ELSE 'rejected' END AS place FROM c""")
def stream_quarantine(spark, d):
    out = shared_folder(spark, "stream")
    route_stream(_events_stream(spark, d), f"{out}/valid", f"{out}/rejected", f"{out}/checkpoint",
                 rules=_EVENT_RULES).awaitTermination()
    valid = spark.read.parquet(f"{out}/valid").drop("batch")
    rejected = spark.read.parquet(f"{out}/rejected").drop("batch")
    valid, rejected = _timed(valid), _timed(rejected)
    return (valid.select("*", F.lit("").alias("violations"), F.lit("valid").alias("place"))
            .unionByName(rejected.withColumns({"violations": F.array_join("violations", ","),
                                               "place": F.lit("rejected")})))


# --- jobs ----------------------------------------------------------------------------------

_CONFIG = {
    "key": "p_partkey",
    "target": "revenue",
    "data_source": {"type": "parquet", "raw_path": "raw", "processed_path": "processed",
                    "inference_holdout_path": "holdout", "inference_holdout_size": 0.1},
    "data_validation": {
        "report_path": "report", "action_on_error": "warn", "input_artifact": "raw_data:latest",
        "output_artifact": "validated_data",
        "schema": {"columns": [
            {"name": "p_partkey", "dtype": "int"}, {"name": "p_name", "dtype": "str"},
            {"name": "p_size", "dtype": "int", "min": 3, "max": 48}, {"name": "disc", "dtype": "float", "max": 1.0}]}},
    "data_split": {"test_size": 0.2, "random_state": 42},
    "preprocessing": {
        "drop_columns": ["p_type", "not_there"],
        "outlier_removal": {"enabled": True, "features": ["price", "revenue"], "iqr_multiplier": 1.5},
        "scale": {"columns": ["qty", "disc", "p_retailprice", "price"], "method": "minmax"}},
    "features": {
        "exclude": ["tax"], "profiling_variables": ["price"], "drop": ["p_name"],
        "audio_features": ["qty", "disc", "p_size", "price"], "genre_features": [],
        "polynomial": {"audio": {"degree": 2, "include_bias": False, "interaction_only": False}}},
    "model": {"active": "linear_regression", "linear_regression": {
        "save_path": "model", "selected_features_path": "selected",
        "stepwise": {"enabled": True, "threshold_in": 0.05, "threshold_out": 0.1}}},
    "artifacts": {"metrics_path": "metrics", "preprocessing_pipeline": "prep", "processed_dir": ".",
                  "engineered_features_filename": "features", "feature_list_filename": "feature_list"},
}


def _job(spark, d) -> jobs.JobContext:
    """A fresh working folder holding the part features as the raw table."""
    base = shared_folder(spark, "job")
    sinks.write_table(part_features(spark, d), f"{base}/raw")
    return jobs.JobContext(spark, _CONFIG, base)


@query("job_profile", f"""
WITH {PART_FEATURES_SQL}
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(11 AS BIGINT) AS n_cols,
       CAST(count(*) - count(DISTINCT p_partkey) AS BIGINT) AS n_duplicates FROM pf""")
def job_profile(spark, d):
    job = _job(spark, d)
    out = jobs.load_and_profile(job, f"{job.base_dir}/datasets")
    duplicates = out["duplicates"].first()[0]
    return out["shape"].select("n_rows", "n_cols", F.lit(duplicates).cast("long").alias("n_duplicates"))


@query("job_validate", f"""
WITH {PART_FEATURES_SQL}
SELECT 'p_size' AS "column", CAST(nullif(count(*) FILTER (p_size < 3), 0) AS BIGINT) AS below_min,
       CAST(nullif(count(*) FILTER (p_size > 48), 0) AS BIGINT) AS above_max FROM pf
UNION ALL SELECT 'p_partkey', NULL, NULL UNION ALL SELECT 'p_name', NULL, NULL UNION ALL SELECT 'disc', NULL, NULL""")
def job_validate(spark, d):
    job = _job(spark, d)
    jobs.load_and_profile(job, f"{job.base_dir}/datasets")
    report = jobs.validate(job, f"{job.base_dir}/datasets")
    return report.table(spark).select("column", "below_min", "above_max")


_PREPROCESSED_SQL = f"""
WITH {PART_FEATURES_SQL},
ranked AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || p_partkey)) AS rn, count(*) OVER () AS total FROM pf),
rest AS (SELECT * FROM ranked WHERE rn > ceil(total * 0.1)),
{_iqr_step('a', 'rest', 'price', 'CAST(1.5 AS DOUBLE)')},
{_iqr_step('b', 'a', 'revenue', 'CAST(1.5 AS DOUBLE)')},
r AS (SELECT min(qty) AS q0, max(qty) AS q1, min(disc) AS d0, max(disc) AS d1,
             min(p_retailprice) AS r0, max(p_retailprice) AS r1,
             min(price) AS c0, max(price) AS c1 FROM b),
pre AS (SELECT (qty - q0) / (q1 - q0) AS qty, (disc - d0) / (d1 - d0) AS disc,
               (p_retailprice - r0) / (r1 - r0) AS p_retailprice, (price - c0) / (c1 - c0) AS price,
               p_partkey, p_name, CAST(p_size AS DOUBLE) AS p_size, n_lines, tax, revenue
        FROM b, r)
"""


@query("job_preprocess", _PREPROCESSED_SQL + """
SELECT round(qty, 6) AS qty, round(disc, 6) AS disc, round(p_retailprice, 6) AS p_retailprice, p_partkey, p_name,
       CAST(p_size AS INTEGER) AS p_size, n_lines, round(tax, 9) AS tax, round(price, 6) AS price,
       round(revenue, 7) AS revenue FROM pre""")
def job_preprocess(spark, d):
    table = jobs.preprocess(_job(spark, d))
    table = rounded(table, 6, "qty", "disc", "p_retailprice", "price")
    return rounded(rounded(table, 9, "tax"), 7, "revenue")


@query("job_holdout", f"""
WITH {PART_FEATURES_SQL},
ranked AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || p_partkey)) AS rn, count(*) OVER () AS total FROM pf)
SELECT p_partkey, p_name, p_type, p_size FROM ranked WHERE rn <= ceil(total * 0.1)""")
def job_holdout(spark, d):
    job = _job(spark, d)
    jobs.preprocess(job)
    return spark.read.parquet(f"{job.base_dir}/holdout").select("p_partkey", "p_name", "p_type", "p_size")


_TERMS = ("qty", "disc", "p_size", "price")


@query("job_features", _PREPROCESSED_SQL + """
SELECT p_partkey, round(revenue, 7) AS revenue, round(qty, 6) AS qty, round(disc, 6) AS disc,
       round(p_retailprice, 6) AS p_retailprice, CAST(p_size AS INTEGER) AS p_size, n_lines, """ + ", ".join(
    f"round({a} * {b}, 6) AS audio_poly__" + (f"{a}pow2" if a == b else f"{a}_{b}")
    for i, a in enumerate(_TERMS) for b in _TERMS[i:]) + " FROM pre")
def job_features(spark, d):
    job = _job(spark, d)
    jobs.preprocess(job)
    table = jobs.build_features(job)
    poly = [c for c in table.columns if c.startswith("audio_poly__")]
    return rounded(rounded(table, 6, "qty", "disc", "p_retailprice", *poly), 7, "revenue")


def _trained(spark, d) -> jobs.JobContext:
    job = _job(spark, d)
    jobs.preprocess(job)
    jobs.build_features(job)
    return job


@query("job_feature_list", "SELECT unnest(['qty', 'disc', 'p_retailprice', 'p_size', 'n_lines', " + ", ".join(
    f"'audio_poly__{a}pow2'" if a == b else f"'audio_poly__{a}_{b}'"
    for i, a in enumerate(_TERMS) for b in _TERMS[i:]) + "]) AS value")
def job_feature_list(spark, d):
    return spark.read.text(_trained(spark, d).feature_list_path)


# The same jobs with one feature and no selection, where the fit has a closed form.
_SINGLE = {**_CONFIG,
           "features": {"exclude": ["tax", "disc", "p_retailprice", "p_size", "n_lines"],
                        "profiling_variables": ["price"], "drop": ["p_name"]},
           "model": {"active": "linear_regression", "linear_regression": {
               "save_path": "model", "stepwise": {"enabled": False}}}}

_SINGLE_SQL = _PREPROCESSED_SQL.rstrip() + """,
sides AS (SELECT p_partkey, qty, revenue,
                 row_number() OVER (ORDER BY md5('85:' || p_partkey)) <= ceil(count(*) OVER () * 0.2) AS test FROM pre),
fitted AS (SELECT count(*) AS n, avg(qty) AS m, var_pop(qty) * count(*) AS sxx, regr_slope(revenue, qty) AS b,
                  regr_intercept(revenue, qty) AS a,
                  (1 - power(corr(revenue, qty), 2)) * var_pop(revenue) * count(*) / (count(*) - 2) AS v
           FROM sides WHERE NOT test)
"""


def _single(spark, d) -> jobs.JobContext:
    job = jobs.JobContext(spark, _SINGLE, _job(spark, d).base_dir)
    jobs.preprocess(job)
    jobs.build_features(job)
    return job


def _single_metrics(where: str, label: str) -> str:
    return _SINGLE_SQL + f""",
m AS (SELECT revenue AS y, a + b * qty AS p FROM sides, fitted WHERE {where}),
t AS (SELECT count(*) AS n, avg((y-p)*(y-p)) AS mse, avg(abs(y-p)) AS mae, var_pop(y) AS vy,
             100 * avg(abs((y-p)/y)) AS mape FROM m)
SELECT round(mse, 4) AS mse, round(sqrt(mse), 6) AS rmse, round(mae, 6) AS mae, round(1 - mse / vy, 8) AS r2,
       round(1 - mse / vy * (n - 1) / (n - 2), 8) AS adj_r2, round(mape, 6) AS mape, n, '{label}' AS split FROM t"""


def _shown(table):
    table = rounded(rounded(table, 4, "mse"), 8, "r2", "adj_r2")
    return rounded(table, 6, "rmse", "mae", "mape")


@query("job_train_single", _single_metrics("test", "test"))
def job_train_single(spark, d):
    return _shown(jobs.train(_single(spark, d))[1])


@query("job_evaluate_single", _single_metrics("true", "all"))
def job_evaluate_single(spark, d):
    job = _single(spark, d)
    jobs.train(job)
    return _shown(jobs.evaluate(job, split_label="all"))


@query("job_score_single", _SINGLE_SQL + f""",
held AS (SELECT ranked.*, (qty - q0) / (q1 - q0) AS x FROM ranked, r WHERE rn <= ceil(total * 0.1)),
s AS (SELECT held.*, a + b * x AS y, {t_quantile_sql('(n - 2)')} * sqrt(v * (1 + 1.0 / n + (x - m) * (x - m) / sxx)) AS h
      FROM held, fitted)
SELECT p_partkey, p_name, p_type, p_size, round(p_retailprice, 6) AS p_retailprice, qty, round(disc, 9) AS disc, n_lines,
       round(tax, 9) AS tax, round(price, 8) AS price, round(revenue, 7) AS revenue, round(y, 4) AS prediction, round(y - h, 4) AS prediction_pi_lower,
       round(y + h, 4) AS prediction_pi_upper FROM s""")
def job_score_single(spark, d):
    job = _single(spark, d)
    jobs.train(job)
    held = spark.read.parquet(f"{job.base_dir}/holdout")
    scored = spark.read.parquet(jobs.batch_score(job, held, f"{job.base_dir}/predictions"))
    return _with_inputs(scored, 4)


def _with_inputs(scored, digits):
    scored = rounded(scored, digits, "prediction", "prediction_pi_lower", "prediction_pi_upper")
    return rounded(rounded(rounded(rounded(scored, 9, "disc", "tax"), 6, "p_retailprice"), 8, "price"), 7, "revenue")


@query("job_score_path", ORACLES["job_score_single"])
def job_score_path(spark, d):
    """The same from a delimited file, read as the configuration says."""
    job = _single(spark, d)
    jobs.train(job)
    held = spark.read.parquet(f"{job.base_dir}/holdout")
    sinks.write_table(held, f"{job.base_dir}/holdout_csv", "csv")
    source = {**_SINGLE["data_source"], "type": "csv", "delimiter": ",", "header": 0}
    job = jobs.JobContext(spark, {**_SINGLE, "data_source": source}, job.base_dir)
    scored = spark.read.parquet(jobs.batch_score(job, "holdout_csv", f"{job.base_dir}/predictions", schema=held.schema))
    return _with_inputs(scored, 4)


# The jobs with selection among three columns, two of which make up the target.
_PLANTED = {**_CONFIG, "features": {"exclude": ["tax", "p_retailprice", "n_lines"], "profiling_variables": ["price"], "drop": ["p_name"]}}

_PLANTED_SQL = _PREPROCESSED_SQL.replace(PART_FEATURES_SQL, PLANTED_FEATURES_SQL).rstrip() + """,
sides AS (SELECT p_partkey, qty AS x1, disc AS x2, revenue AS y,
                 row_number() OVER (ORDER BY md5('42:' || p_partkey)) AS by_42,
                 row_number() OVER (ORDER BY md5('85:' || p_partkey)) <= ceil(count(*) OVER () * 0.2) AS test FROM pre),
sums AS (SELECT count(*) AS n, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my,
             var_pop(x1) * count(*) AS s11, var_pop(x2) * count(*) AS s22, covar_pop(x1, x2) * count(*) AS s12,
             covar_pop(x1, y) * count(*) AS s1y, covar_pop(x2, y) * count(*) AS s2y, var_pop(y) * count(*) AS syy
      FROM sides WHERE NOT test),
slopes AS (SELECT *, s11 * s22 - s12 * s12 AS det, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
             (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM sums),
fitted AS (SELECT *, my - b1 * m1 - b2 * m2 AS b0, (syy - b1 * s1y - b2 * s2y) / (n - 3) AS v FROM slopes)
"""


def _planted_job(spark, d) -> jobs.JobContext:
    base = shared_folder(spark, "job")
    sinks.write_table(planted_features(spark, d), f"{base}/raw")
    job = jobs.JobContext(spark, _PLANTED, base)
    jobs.preprocess(job)
    jobs.build_features(job)
    return job


def _planted_metrics(where: str, label: str) -> str:
    return _PLANTED_SQL + f""",
m AS (SELECT y, b0 + b1 * x1 + b2 * x2 AS p FROM sides, fitted WHERE {where}),
t AS (SELECT count(*) AS n, avg((y-p)*(y-p)) AS mse, avg(abs(y-p)) AS mae, var_pop(y) AS vy,
             100 * avg(abs((y-p)/y)) AS mape FROM m)
SELECT round(mse, 6) AS mse, round(sqrt(mse), 6) AS rmse, round(mae, 6) AS mae, round(1 - mse / vy, 8) AS r2,
       round(1 - mse / vy * (n - 1) / (n - 3), 8) AS adj_r2, round(mape, 6) AS mape, n, '{label}' AS split FROM t"""


def _metrics(table):
    return rounded(rounded(table, 6, "mse", "rmse", "mae", "mape"), 8, "r2", "adj_r2")


@query("job_train_planted", _planted_metrics("test", "test"))
def job_train_planted(spark, d):
    return _metrics(jobs.train(_planted_job(spark, d))[1])


@query("job_evaluate_planted", _planted_metrics("true", "all"))
def job_evaluate_planted(spark, d):
    job = _planted_job(spark, d)
    jobs.train(job)
    return _metrics(jobs.evaluate(job, split_label="all"))


@query("job_score_planted", _PLANTED_SQL + f""",
held AS (SELECT ranked.*, (qty - q0) / (q1 - q0) AS x1, (disc - d0) / (d1 - d0) AS x2 FROM ranked, r WHERE rn <= ceil(total * 0.1)),
z AS (SELECT held.*, b0 + b1 * x1 + b2 * x2 AS point, {t_quantile_sql('(n - 3)')} * sqrt(v * (1 + 1.0 / n
             + ((x1 - m1) * (x1 - m1) * s22 - 2 * (x1 - m1) * (x2 - m2) * s12 + (x2 - m2) * (x2 - m2) * s11) / det)) AS h
      FROM held, fitted)
SELECT p_partkey, p_name, p_type, p_size, round(p_retailprice, 6) AS p_retailprice, qty, round(disc, 9) AS disc, n_lines,
       round(tax, 9) AS tax, round(price, 8) AS price, round(revenue, 7) AS revenue, round(point, 5) AS prediction,
       round(point - h, 5) AS prediction_pi_lower, round(point + h, 5) AS prediction_pi_upper FROM z""")
def job_score_planted(spark, d):
    job = _planted_job(spark, d)
    jobs.train(job)
    held = spark.read.parquet(f"{job.base_dir}/holdout")
    scored = spark.read.parquet(jobs.batch_score(job, held, f"{job.base_dir}/predictions"))
    return _with_inputs(scored, 5)


# The same jobs with all polynomials and the real target; tests hold them against row-level least squares.
@query("job_train")
def job_train(spark, d):
    return jobs.train(_trained(spark, d))[1]


@query("job_evaluate")
def job_evaluate(spark, d):
    job = _trained(spark, d)
    jobs.train(job)
    return jobs.evaluate(job, split_label="all")


@query("job_score")
def job_score(spark, d):
    job = _trained(spark, d)
    jobs.train(job)
    held = spark.read.parquet(f"{job.base_dir}/holdout")
    return spark.read.parquet(jobs.batch_score(job, held, f"{job.base_dir}/predictions"))


@query("job_run_all", _single_metrics("test", "test") + " UNION ALL " + "SELECT * FROM (" + _single_metrics("true", "test") + ")")
def job_run_all(spark, d):
    """All steps in one call: the metrics of the training and those of the evaluation over all rows."""
    base = _job(spark, d).base_dir
    out = jobs.run_all(jobs.JobContext(spark, _SINGLE, base), f"{base}/datasets")
    return _shown(out["trained"].unionByName(out["evaluated"]))


@query("job_cluster")
def job_cluster(spark, d):
    """The clustering job: rows and means per cluster of its assignment; tests hold it against plain steps."""
    job = jobs.JobContext(spark, {**_CONFIG, "model": {**_CONFIG["model"], "kmeans": {"k_max": 4, "n_clusters": 3}}}, _job(spark, d).base_dir)
    jobs.preprocess(job)
    out = jobs.cluster(job, ["qty", "disc", "p_retailprice", "price"])
    return out["assigned"].groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), *[
        F.avg(c).alias(c) for c in ("qty", "disc", "p_retailprice", "price")])


# --- whole results of the jobs ---------------------------------------------------------------

_WIDTHS = {"disc": 9, "tax": 9, "p_retailprice": 6, "price": 8, "revenue": 7}


def _wide_rows(table):
    for name, digits in _WIDTHS.items():
        table = rounded(table, digits, name)
    return table


_WIDE_SELECT = "SELECT p_partkey, p_name, p_type, p_size, qty, n_lines, " + ", ".join(f"round({c}, {n}) AS {c}" for c, n in _WIDTHS.items())


@query("job_holdout_rows", f"""
WITH {PART_FEATURES_SQL},
ranked AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || p_partkey)) AS rn, count(*) OVER () AS total FROM pf)
{_WIDE_SELECT} FROM ranked WHERE rn <= ceil(total * 0.1)""")
def job_holdout_rows(spark, d):
    job = _job(spark, d)
    jobs.preprocess(job)
    return _wide_rows(spark.read.parquet(f"{job.base_dir}/holdout"))


@query("job_profile_sample", f"WITH {PART_FEATURES_SQL} {_WIDE_SELECT} FROM pf ORDER BY p_partkey LIMIT 100")
def job_profile_sample(spark, d):
    job = _job(spark, d)
    return _wide_rows(jobs.load_and_profile(job, f"{job.base_dir}/datasets")["sample"])


@query("job_profile_summary", f"WITH {PART_FEATURES_SQL}" + _summary_sql(
    "pf", ["p_partkey", "p_size", "p_retailprice", "qty", "n_lines", "disc", "tax", "price", "revenue"], ["p_name", "p_type"], [])
    .replace("CAST(min(", "round(min(").replace(" AS DOUBLE) AS min", ", 6) AS min").replace("CAST(max(", "round(max(").replace(" AS DOUBLE) AS max", ", 6) AS max"))
def job_profile_summary(spark, d):
    job = _job(spark, d)
    summary = jobs.load_and_profile(job, f"{job.base_dir}/datasets")["summary"]
    return rounded(rounded(summary, 4, "mean", "std", "q25", "q50", "q75"), 6, "min", "max")


@query("job_validate_report", f"""
WITH {PART_FEATURES_SQL},
r AS (SELECT count(*) FILTER (p_size < 3) AS low, count(*) FILTER (p_size > 48) AS high FROM pf)
SELECT 'p_size' AS "column", 'present' AS status, CAST(NULL AS VARCHAR) AS dtype, CAST(NULL AS VARCHAR) AS dtype_expected,
       CAST(NULL AS BIGINT) AS missing_count, CAST(NULL AS BIGINT) AS rows_dropped, nullif(low, 0) AS below_min, nullif(high, 0) AS above_max, CAST(NULL AS VARCHAR) AS error FROM r
""" + "".join(f"UNION ALL SELECT '{c}', 'present', NULL, NULL, NULL, NULL, NULL, NULL, NULL\n" for c in ("p_partkey", "p_name", "disc")))
def job_validate_report(spark, d):
    job = _job(spark, d)
    jobs.load_and_profile(job, f"{job.base_dir}/datasets")
    return jobs.validate(job, f"{job.base_dir}/datasets").table(spark)


# --- versions, streams, refits ---------------------------------------------------------------


@query("io_versions_kept", """
SELECT CAST(v AS BIGINT) AS version, o_orderstatus, count(*) AS n FROM orders, (VALUES (3), (4)) t(v) WHERE o_orderkey % 5 < v GROUP BY ALL""")
def io_versions_kept(spark, d):
    """Four versions published, the last two kept."""
    root, orders = shared_folder(spark, "datasets"), read(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    for version in range(1, 5):
        sinks.publish(orders.where(f"o_orderkey % 5 < {version}"), root, "orders", keep=2)
    parts = [sinks.read_dataset(spark, root, f"orders:{v}").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(v).cast("long").alias("version"), "o_orderstatus", "n") for v in sinks.dataset_versions(spark, root, "orders")]
    return reduce(DataFrame.union, parts)


_EVENT_EXPECTATIONS = (
    quality.Expectation("event_id", "int", min=100), quality.Expectation("value", "float", min=1.0, max=120.0),
    quality.Expectation("event_type", "str", allowed=("click", "view")), quality.Expectation("user_id", "int", required=False, max=50))


@query("stream_quality", """
SELECT 'event_id' AS "column", nullif(count(*) FILTER (event_id < 100), 0) AS below_min, CAST(NULL AS BIGINT) AS above_max,
       CAST(NULL AS BIGINT) AS not_allowed, count(*) AS n_rows FROM events
UNION ALL SELECT 'value', nullif(count(*) FILTER (value < 1.0), 0), nullif(count(*) FILTER (value > 120.0), 0), NULL, count(*) FROM events
UNION ALL SELECT 'event_type', NULL, NULL, nullif(count(*) FILTER (event_type NOT IN ('click', 'view')), 0), count(*) FROM events
UNION ALL SELECT 'user_id', NULL, nullif(count(*) FILTER (user_id > 50), 0), NULL, count(*) FROM events""")
def stream_quality(spark, d):
    """The events' halves arrive one after the other, with a restart between; one report in the end."""
    out, events = shared_folder(spark, "stream"), read(spark, d, "events")
    for half in (0, 1):
        events.where(F.col("event_id") % 2 == half).write.mode("append").parquet(f"{out}/in")
        watch_quality(open_stream(spark, f"{out}/in", events.schema), _EVENT_EXPECTATIONS, f"{out}/counts", f"{out}/checkpoint").awaitTermination()
    report, rows = stream_report(spark, f"{out}/counts", events, _EVENT_EXPECTATIONS)
    return report.table(spark).select("column", "below_min", "above_max", "not_allowed", F.lit(rows).cast("long").alias("n_rows"))


@query("refit_versions", ORACLES["ols_two_var"])
def refit_versions(spark, d):
    """Three versions, one of them read by the last refit; the model is that of all rows."""
    root = shared_folder(spark, "datasets")
    with written(part_features(spark, d), "part-features") as table:
        for part in range(3):
            sinks.publish(table.where(F.col("p_partkey") % 3 == part), root, "parts")
            model, read_again = incremental.refit(spark, root, "parts", "revenue", ["qty", "disc"], f"{root}/state", select=False)
    if read_again != [3]:
        raise AssertionError(f"versions {read_again} were read")
    return rounded(rounded(regression.coefficient_table(spark, model), 4, "coefficient", "std_err", "t"), 8, "p")

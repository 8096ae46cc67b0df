"""The seven jobs: load and profile, validate, preprocess, features, train, evaluate, score.

Each takes a session and a configuration dict, reads what the previous one stored, and
writes its own tables. Stages hand over Parquet, so types survive and only the columns a
stage uses are read. Rows are identified by ``config["key"]``; a table without such a
column gets a key made from its content.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import features as feature_ops
from ..operators import clustering, prep, profile, quality, regression, split, stats
from ..operators.columns import drop_columns
from ..operators.scoring import Scorer, count_unscored
from ..schema import numeric_columns, with_row_key
from ..session import materialize, written
from ..sources import sinks
from ..sources.tables import load_table, resolve

log = logging.getLogger(__name__)

ROW_KEY = "row_key"


@dataclass(frozen=True)
class JobContext:
    """A configuration together with the folder its relative paths start from."""

    spark: SparkSession
    config: Mapping[str, Any]
    base_dir: str

    def section(self, *names: str) -> Mapping[str, Any]:
        found: Any = self.config
        for name in names:
            found = found.get(name) or {}
        return found

    def path(self, name: str, default: str) -> str:
        """Location of an artifact, from whichever section configures it."""
        for section in (self.section("data_source"), self.section("artifacts"),
                        self.section("data_validation"), self.section("model", "linear_regression")):
            if section.get(name):
                return resolve(section[name], self.base_dir)
        return resolve(default, self.base_dir)

    @property
    def key(self) -> str:
        return self.config.get("key", ROW_KEY)

    @property
    def seed(self) -> int:
        return self.section("data_split").get("random_state", 42)

    @property
    def features_path(self) -> str:
        folder = self.section("artifacts").get("processed_dir", "data/processed")
        name = self.section("artifacts").get("engineered_features_filename", "features")
        return resolve(f"{folder.rstrip('/')}/{name}", self.base_dir)

    @property
    def feature_list_path(self) -> str:
        folder = self.section("artifacts").get("processed_dir", "data/processed")
        name = self.section("artifacts").get("feature_list_filename", "feature_list.txt")
        return resolve(f"{folder.rstrip('/')}/{name}", self.base_dir)

    def load(self) -> DataFrame:
        df = load_table(self.spark, self.config, base_dir=self.base_dir,
                        schema=self.section("data_source").get("schema"))
        return df if self.key in df.columns else with_row_key(df, self.key)


def load_and_profile(job: JobContext, dataset_root: str | None = None) -> dict[str, DataFrame]:
    """Shape, duplicates, first rows and summary statistics.

    With a dataset root the table is published first and profiled from that copy, so the
    source itself is parsed once.
    """
    df = job.load()
    if dataset_root:
        reference = job.section("data_validation").get("input_artifact", "raw_data:latest")
        sinks.publish(df, dataset_root, reference.partition(":")[0])
        df = sinks.read_dataset(job.spark, dataset_root, reference)
    data = df.drop(ROW_KEY)
    return {
        "table": df,
        "shape": profile.shape(data),
        "duplicates": profile.duplicate_rows(data),
        "sample": profile.head(df, job.key, 100),
        "summary": profile.summary(data),
    }


def validate(job: JobContext, dataset_root: str | None = None) -> quality.QualityReport | None:
    """Write the report, act on errors, and publish the table for the next job."""
    section = job.section("data_validation")
    if dataset_root:
        df = sinks.read_dataset(job.spark, dataset_root,
                                section.get("input_artifact", "raw_data:latest"))
    else:
        df = job.load()
    report = quality.validate_config(df, job.config)
    if report is None:
        return None
    sinks.write_document(report.document(job.spark),
                         job.path("report_path", "logs/validation_report.json"))
    quality.enforce(report, section.get("action_on_error", "raise"))
    if dataset_root:
        sinks.publish(df, dataset_root, section.get("output_artifact", "validated_data"))
    return report


def preprocess(job: JobContext) -> DataFrame:
    """Holdout split, drops, outlier filter, imputation and scaling; stores the parameters.

    Several passes follow, so text is parsed, and a key made from content is made, only once: into a
    table that is deleted afterwards. Other tables are read as they are, by the columns each pass needs.
    """
    df = job.load()
    if job.section("data_source").get("type", "csv") != "csv" and job.key != ROW_KEY:
        return _preprocess(job, df)
    with written(df, "parsed") as table:
        return _preprocess(job, table)


def _preprocess(job: JobContext, df: DataFrame) -> DataFrame:
    section = job.section("preprocessing")
    source = job.section("data_source")
    if source.get("inference_holdout_path"):
        rest, held = split.holdout(df, job.key, source.get("inference_holdout_size"), job.seed)
        if held is not None:
            sinks.write_table(held, job.path("inference_holdout_path", ""))
            df = rest
    df = drop_columns(df, section.get("drop_columns", []))
    outliers = section.get("outlier_removal", {})
    if outliers.get("enabled", False):
        df = prep.filter_outliers(df, outliers.get("features", []),
                                  outliers.get("iqr_multiplier", 1.5))
    scale = section.get("scale", {})
    columns = scale.get("columns", [])
    if columns:
        imputation = section.get("imputation", {})
        fitted = prep.fit_preprocessor(
            df, columns, method=scale.get("method", "minmax"),
            strategy=imputation.get("strategy", "mean") if imputation.get("enabled", True) else None,
            fill_value=imputation.get("fill_value", 0.0))
        df = prep.transform(df, fitted)
        sinks.write_table(fitted.frame(job.spark).coalesce(1),
                          job.path("preprocessing_pipeline", "models/preprocessing"))
    target = sinks.write_table(df, job.path("processed_path", "data/processed/table"))
    return job.spark.read.parquet(target)


def build_features(job: JobContext) -> DataFrame:
    """Feature table (with key and target carried along) and the list of feature names."""
    processed = job.spark.read.parquet(job.path("processed_path", "data/processed/table"))
    carried = [c for c in (job.key, job.config.get("target")) if c in processed.columns]
    table = feature_ops.feature_table(processed, job.config, keep=carried)
    sinks.write_table(table, job.features_path)
    names = [c for c in table.columns if c not in carried]
    sinks.write_column_list(job.spark, names, job.feature_list_path)
    return job.spark.read.parquet(job.features_path)


def train(job: JobContext) -> tuple[regression.LinearModel, DataFrame]:
    """Split, select, fit, test; stores model, selection and metrics."""
    active = job.section("model").get("active", "linear_regression")
    if active != "linear_regression":
        raise ValueError(f"model type '{active}' is not known")
    table = job.spark.read.parquet(job.features_path)
    target = job.config["target"]
    if target not in table.columns:
        raise ValueError(f"feature table has no target column '{target}'")
    candidates = numeric_columns(table, [job.key, target])
    fit_rows, test_rows = split.train_test(
        table, job.key, job.section("data_split").get("test_size", 0.2), job.seed)
    found = regression.moments(fit_rows, [*candidates, target])
    if found.rows_dropped:
        log.warning("%d training rows with missing values are not used", found.rows_dropped)
    steps = job.section("model", active, "stepwise")
    model = regression.train(
        found, target, candidates, select=steps.get("enabled", True),
        threshold_in=steps.get("threshold_in", 0.05), threshold_out=steps.get("threshold_out", 0.1))
    metrics = stats.evaluate(test_rows, model, split_label="test")
    sinks.require_columns_stored(job.spark, job.features_path, model.features)
    sinks.write_table(regression.model_frame(job.spark, model).coalesce(1),
                      job.path("save_path", "models/linear_regression"))
    sinks.write_column_list(job.spark, model.features,
                            job.path("selected_features_path", "models/selected_features"))
    stored = sinks.write_document(metrics, job.path("metrics_path", "models/metrics.json"))
    return model, job.spark.read.schema(metrics.schema).json(stored)


def stored_model(job: JobContext) -> regression.LinearModel:
    return regression.model_from_frame(
        job.spark.read.parquet(job.path("save_path", "models/linear_regression")))


def evaluate(job: JobContext, split_label: str = "test", rows: str = "all") -> DataFrame:
    """Metrics of the stored model over all rows, or with ``rows="test"`` the test part."""
    if rows not in ("all", "test"):
        raise ValueError("rows must be 'all' or 'test'")
    table = job.spark.read.parquet(job.features_path)
    if rows == "test":
        _, table = split.train_test(
            table, job.key, job.section("data_split").get("test_size", 0.2), job.seed)
    return stats.evaluate(table, stored_model(job), split_label=split_label)


def stored_scorer(job: JobContext) -> Scorer:
    fitted = prep.Preprocessor(())
    if job.section("preprocessing", "scale").get("columns"):
        fitted = prep.Preprocessor.from_frame(job.spark.read.parquet(
            job.path("preprocessing_pipeline", "models/preprocessing")))
    return Scorer(stored_model(job), fitted, job.config)


def batch_score(job: JobContext, rows: DataFrame | str, output: str, fmt: str = "parquet",
                schema: T.StructType | None = None) -> str:
    """Score a table with the stored parameters and write it with its prediction columns.

    A path is read by the configuration's ``data_source`` options. Rows left without a prediction
    are counted while writing, not in a pass of their own.
    """
    if isinstance(rows, str):
        source = {**job.section("data_source"), "raw_path": rows}
        rows = load_table(job.spark, {"data_source": source}, base_dir=job.base_dir, schema=schema)
    seen = Observation()
    scored = stored_scorer(job).score(rows).observe(
        seen, F.count(F.lit(1)).alias("rows"), count_unscored().alias("unscored"))
    sinks.write_table(scored, output, fmt)
    if seen.get["unscored"]:
        log.warning("%d of %d rows have no prediction", seen.get["unscored"], seen.get["rows"])
    return output


def cluster(job: JobContext, columns: Sequence[str]) -> dict[str, DataFrame]:
    """The clustering analysis of the configuration: elbow, assignment, sizes and group profile.

    Works on the preprocessed table.
    """
    options = clustering.cluster_options(job.config)
    table = job.spark.read.parquet(job.path("processed_path", "data/processed/table"))
    elbow = clustering.kmeans_sweep(table, columns, options["k_values"], seed=options["seed"])
    fitted = clustering.kmeans_fit(table, columns, options["k"], seed=options["seed"])
    assigned = materialize(fitted.table, "clusters")
    return {"elbow": elbow, "assigned": assigned, "sizes": clustering.cluster_sizes(assigned),
            "profile": stats.group_profile(assigned, "cluster", list(columns))}


def run_all(job: JobContext, dataset_root: str | None = None) -> dict[str, DataFrame]:
    """All steps in order: profile, validate, preprocess, features, train, evaluate, score the holdout.

    Gives the profile's tables, the test metrics of the training, the metrics of the evaluation, and the scored
    holdout where one is configured.
    """
    out = load_and_profile(job, dataset_root)
    validate(job, dataset_root)
    preprocess(job)
    build_features(job)
    out["trained"] = train(job)[1]
    out["evaluated"] = evaluate(job)
    held = job.section("data_source").get("inference_holdout_path")
    if held:
        rows = job.spark.read.parquet(resolve(held, job.base_dir))
        out["scored"] = job.spark.read.parquet(batch_score(job, rows, resolve("predictions", job.base_dir)))
    return out

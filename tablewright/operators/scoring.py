"""Scoring: fitted parameters turned into one projection, for batch and streaming tables."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import GENRE_PATTERNS
from ..functions.response import bucket_message, bucket_name, success
from ..schema import quoted
from .columns import drop_columns, fill_missing_columns, missing_columns, require_columns
from .features import engineer
from .prep import Preprocessor, apply_stored
from .quality import RECORD_RULES, RecordRule, split_records
from .regression import LinearModel, prediction_columns

log = logging.getLogger(__name__)

_INPUT = "__input"


@dataclass(frozen=True)
class Scorer:
    """Everything fitted that a new row needs; holds only per-column parameters."""

    model: LinearModel
    preprocessor: Preprocessor = Preprocessor(())
    config: Mapping[str, Any] = field(default_factory=dict)
    label_column: str = "artist_genres"
    patterns: Mapping[str, str] = field(default_factory=lambda: GENRE_PATTERNS)
    fill_missing: bool = True

    def prepare(self, df: DataFrame) -> DataFrame:
        """Drop, scale, flag and expand; stops if a model feature cannot be built.

        Columns that were scaled at fit time and are absent now count as 0.0 before
        scaling, unless ``fill_missing`` is off.
        """
        drops = self.config.get("preprocessing", {}).get("drop_columns", [])
        df = drop_columns(df, drops)
        absent = missing_columns(df, self.preprocessor.columns)
        if absent and self.fill_missing:
            log.warning("columns %s are absent; taken as 0.0", absent)
            df = fill_missing_columns(df, absent, 0.0)
        df = apply_stored(df, self.preprocessor)
        df = engineer(df, self.config, label_column=self.label_column, patterns=self.patterns)
        return require_columns(df, self.model.features)

    def score(self, df: DataFrame, *, interval: bool = True, alpha: float = 0.05) -> DataFrame:
        """Input columns, untouched and in order, followed by the prediction columns.

        Columns of the input that are named like a prediction column are replaced.
        The input row rides along as a struct while its columns are transformed, so
        attaching predictions needs no join and no key, and nothing is shuffled.
        """
        features = [quoted(f).cast("double") for f in self.model.features]
        predicted = prediction_columns(self.model, features, interval=interval, alpha=alpha)
        names = [c for c in df.columns if c not in predicted]
        ready = self.prepare(df.withColumn(_INPUT, F.struct(*[quoted(c) for c in names])))
        return ready.select(
            *[F.col(_INPUT).getField(c).alias(c) for c in names],
            *[column.alias(name) for name, column in predicted.items()])


def score_records(df: DataFrame, scorer: Scorer, rules: Sequence[RecordRule] = RECORD_RULES, *,
                  title: str = "track_name", metadata: Sequence[str] = ("track_name", "year"),
                  ) -> DataFrame:
    """Valid records with their metadata, prediction, success percentage and message."""
    valid, _ = split_records(df, rules)
    scored = scorer.score(valid, interval=False)
    return with_response(scored, title=title).select(
        *[quoted(c) for c in metadata], "prediction", "success", "bucket", "message")


def with_response(df: DataFrame, prediction: str = "prediction",
                  title: str | None = None) -> DataFrame:
    """Add the rounded percentage, its bucket and, given a title column, the message."""
    out = df.withColumn("success", success(quoted(prediction)))
    out = out.withColumn("bucket", bucket_name(F.col("success")))
    if title is not None:
        out = out.withColumn("message", bucket_message(quoted(title), F.col("success")))
    return out


def count_unscored(prediction: str = "prediction") -> Column:
    """Aggregate expression: rows that could not be given a prediction."""
    return F.count_if(quoted(prediction).isNull())

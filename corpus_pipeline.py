"""The corpus pipeline: stages over the documents table, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import decontaminate, language, ngram_join, pieces, secret_scan
from tablewright.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Least share of a text's n-grams that its language must hold.
LEAST_LANGUAGE_SCORE = 0.5


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognisable language: no letter, no text, or a low score.

    The model learns from the labels of the stage's own documents; without any it drops everything. Rows with
    NULL ids or labels are judged like others, repeated rows alike; columns and their names stay.
    """
    # The documents' own columns of the two names that the model's answer takes step aside.
    aside = {c: f"__own_{c}" for c in ("lang_pred", "score") if c in docs.columns}
    found = language.identify(docs.withColumnsRenamed(aside), language.train(docs))
    kept = found.where((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE))
    return kept.drop("lang_pred", "score").withColumnsRenamed({own: c for c, own in aside.items()}).select(docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of similar documents keep the one of the least doc_id.

    Rows that share that doc_id all stay, and so do rows without a doc_id and texts without words, which are
    similar to nothing. Columns and their names stay; an empty table stays empty.
    """
    return ngram_join.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item, up to its edit budget.

    NULL and empty texts hold none; repeated rows go or stay together; columns and their names stay; an empty
    benchmark drops nothing.
    """
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; no document goes.

    NULL texts stay NULL, texts without a secret stay as they are, ``n_chars`` counts the new text. Rows, columns
    and their names stay; without labelled strings to learn from only the fixed patterns decide.
    """
    return secret_scan.mask_secrets(docs, secret_scan.train(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add the piece ids of every text in a column ``ids``, which replaces one of that name.

    NULL and empty texts have no ids; rows and other columns stay.
    """
    return pieces.encode_pieces(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", keep_known_languages),
    ("near_duplicates", keep_one_of_each),
    ("decontaminate", drop_leaks),
    ("secrets", mask_secrets),
    ("piece_ids", encode),
]

#: Trained models and shingle links have no SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; the rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs

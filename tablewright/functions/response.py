"""Prediction expressions: linear predictor, interval width, response buckets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper edges (inclusive) of the success buckets, and the message wording.
BUCKET_EDGES: tuple[tuple[float | None, str, str], ...] = (
    (20.0, "bust", "will be a bust!"),
    (40.0, "not successful", "will not be successful!"),
    (60.0, "maybe", "will maybe be a hit!"),
    (80.0, "great chance", "has a great chance!"),
    (None, "hit", "will be an absolute HIT!"),
)


def total(terms: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def linear_predictor(features: Sequence[Column], weights: Sequence[float],
                     intercept: float) -> Column:
    return total([F.lit(float(intercept)),
                  *(x * F.lit(float(w)) for x, w in zip(features, weights))])


def success(prediction: Column) -> Column:
    return F.round(prediction, 1)


def _bucket_chain(percentage: Column, pick) -> Column:
    *bounded, (_, last_name, last_text) = BUCKET_EDGES
    chain = F.when(percentage.isNull(), F.lit(None))
    for edge, name, text in bounded:
        chain = chain.when(percentage <= F.lit(edge), F.lit(pick(name, text)))
    return chain.otherwise(F.lit(pick(last_name, last_text)))


def bucket_name(percentage: Column) -> Column:
    return _bucket_chain(percentage, lambda name, text: name)


def bucket_message(title: Column, percentage: Column) -> Column:
    """``'title' <bucket wording> It has an expected success of 12.3%!``"""
    wording = _bucket_chain(percentage, lambda name, text: text)
    return F.concat(F.lit("'"), title.cast("string"), F.lit("' "), wording,
                    F.lit(" It has an expected success of "),
                    percentage.cast("string"), F.lit("%!"))

"""Feature engineering: label flags, polynomial terms and the composed feature stage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations, combinations_with_replacement
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import GENRE_PATTERNS, flag_name, label_flags
from ..schema import is_numeric, quoted
from .columns import add_columns, drop_columns, select_numeric


def add_label_flags(df: DataFrame, column: str = "artist_genres",
                    patterns: Mapping[str, str] = GENRE_PATTERNS, *,
                    prefix: str | None = "genre_", on_missing: str = "skip") -> DataFrame:
    """One 0/1 column per label, from keyword patterns over a text column.

    Without the text column the table stays as it is, or with ``on_missing="zeros"`` gets
    flags that are all 0.
    """
    if column in df.columns:
        return df.withColumns(label_flags(quoted(column).cast("string"), patterns, prefix))
    if on_missing == "zeros":
        return df.withColumns({flag_name(k, prefix): F.lit(0) for k in patterns})
    return df


def polynomial_terms(bases: Sequence[str], degree: int = 2, *, include_bias: bool = False,
                     interaction_only: bool = False) -> list[tuple[str, ...]]:
    """Factor lists of all terms: by degree, then in the order of the base columns."""
    choose = combinations if interaction_only else combinations_with_replacement
    return [term for d in range(0 if include_bias else 1, degree + 1)
            for term in choose(bases, d)]


def term_name(term: Sequence[str]) -> str:
    """``(a, a, b)`` -> ``apow2_b``; spaces in column names become underscores."""
    powers = {f: term.count(f) for f in dict.fromkeys(term)}
    parts = [f + (f"pow{n}" if n > 1 else "") for f, n in powers.items()]
    return "_".join(parts).replace(" ", "_").replace("^", "pow") if parts else "1"


def add_polynomials(df: DataFrame, bases: Sequence[str], *, prefix: str, degree: int = 2,
                    include_bias: bool = False, interaction_only: bool = False) -> DataFrame:
    """Append the products of the numeric base columns, all in one projection.

    First-degree terms repeat the bases and are left out when higher ones exist and no bias
    is asked for. Terms nobody selects later cost nothing: they are pruned from the plan.
    """
    usable = [b for b in bases if is_numeric(df, b)]
    if not usable:
        return df
    terms = polynomial_terms(usable, degree, include_bias=include_bias,
                             interaction_only=interaction_only)
    if degree > 1 and not include_bias:
        terms = [t for t in terms if len(t) > 1]
    return add_columns(df, {prefix + term_name(t): _product(t) for t in terms})


def _product(term: Sequence[str]) -> Column:
    factors = [quoted(f).cast("double") for f in term]
    return reduce(lambda a, b: a * b, factors) if factors else F.lit(1.0)


def add_configured_polynomials(df: DataFrame, config: Mapping[str, Any]) -> DataFrame:
    """The ``audio`` and ``genre`` groups of a configuration's ``features`` section."""
    section = config.get("features", {})
    groups = {
        "audio": list(section.get("audio_features", [])),
        "genre": [flag_name(g) for g in section.get("genre_features", [])],
    }
    for group, bases in groups.items():
        options = section.get("polynomial", {}).get(group)
        if options:
            df = add_polynomials(
                df, bases, prefix=f"{group}_poly__", degree=options.get("degree", 2),
                include_bias=options.get("include_bias", False),
                interaction_only=options.get("interaction_only", False))
    return df


def engineer(df: DataFrame, config: Mapping[str, Any], *, label_column: str = "artist_genres",
             patterns: Mapping[str, str] = GENRE_PATTERNS, on_missing: str = "skip") -> DataFrame:
    """Flags, then the configured drops, then polynomials (no selection yet)."""
    df = add_label_flags(df, label_column, patterns, on_missing=on_missing)
    df = drop_columns(df, config.get("features", {}).get("drop", []))
    return add_configured_polynomials(df, config)


def feature_table(df: DataFrame, config: Mapping[str, Any], *, keep: Sequence[str] = (),
                  label_column: str = "artist_genres",
                  patterns: Mapping[str, str] = GENRE_PATTERNS) -> DataFrame:
    """The feature stage: engineer, then keep numeric columns that are not excluded.

    Profiling columns take part in the polynomials before they are excluded; the target is
    never a feature and is only carried if ``keep`` names it.
    """
    section = config.get("features", {})
    built = engineer(df, config, label_column=label_column, patterns=patterns)
    return select_numeric(built, exclude=section.get("exclude", []), keep=keep,
                          profiling=section.get("profiling_variables", []),
                          target=config.get("target"))

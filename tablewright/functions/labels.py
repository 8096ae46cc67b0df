"""Multi-label text: label lists, keyword flags and their names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keyword patterns of the label flags. They have to be exactly these for
# the flags to agree with existing feature tables.
GENRE_PATTERNS: dict[str, str] = {
    "pop": "pop",
    "rock": "rock",
    "electronic": "house|edm|electro|techno|progressive",
    "latin": "latin|reggaeton|salsa|bachata",
    "hip-hop": "hip hop|rap|urban|trap",
    "indie": "indie",
    "jazz": "jazz",
    "r&b": "r&b|soul",
    "metal": "metal|punk|hardcore",
    "classic": "classical|orchestra|symphony",
    "country": "country",
}

# The wider twelve-label set used for exploration (columns without prefix).
EXPLORATION_PATTERNS: dict[str, str] = {
    "pop": "pop",
    "rock": "rock",
    "electronic": "house|edm|electro|progressive",
    "latin": "latin|puerto|reggaeton",
    "hip-hop": "hip|rap|urban",
    "indie": "indie",
    "jazz": "jazz",
    "r&b": "r&b",
    "soul": "soul",
    "metal": "metal|punk",
    "classic": "classic",
    "country": "country",
}


def flag_name(label: str, prefix: str | None = "genre_") -> str:
    """Column name of a label flag; without a prefix (None) it is the label itself."""
    if prefix is None:
        return label
    return prefix + label.translate(str.maketrans({"&": "and", "-": "_"}))


def label_flag(text: Column, pattern: str) -> Column:
    """1 where the pattern occurs anywhere in the text, whatever its case; else 0."""
    return F.coalesce(text.rlike(f"(?i){pattern}"), F.lit(False)).cast("int")


def label_flags(text: Column, patterns: Mapping[str, str],
                prefix: str | None = "genre_") -> dict[str, Column]:
    return {flag_name(k, prefix): label_flag(text, p) for k, p in patterns.items()}


def label_list(text: Column, separator: str = "; ") -> Column:
    """``"['a'; 'b']"`` -> ``["a", "b"]``."""
    bare = F.translate(F.btrim(text, F.lit("[]")), "'", "")
    return F.split(bare, _regex_quote(separator))


def _regex_quote(literal: str) -> str:
    return "\\Q" + literal + "\\E"

"""Logical type classes, column selection by type, null and key conventions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Expectation type name -> Spark types it accepts.
TYPE_CLASSES: dict[str, tuple[type, ...]] = {
    "int": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "float": (T.FloatType, T.DoubleType, T.DecimalType),
    "str": (T.StringType, T.CharType, T.VarcharType, T.BinaryType),
    "bool": (T.BooleanType,),
}

NUMERIC_TYPES = TYPE_CLASSES["int"] + TYPE_CLASSES["float"]

#: Column layout of the track table the default configuration describes.
TRACK_SCHEMA = T.StructType(
    [T.StructField(n, T.IntegerType()) for n in ("year",)]
    + [T.StructField("track_name", T.StringType())]
    + [T.StructField("track_popularity", T.IntegerType())]
    + [T.StructField(n, T.StringType()) for n in ("album", "artist_name", "artist_genres")]
    + [T.StructField("artist_popularity", T.IntegerType())]
    + [T.StructField(n, T.DoubleType()) for n in (
        "danceability", "energy", "key", "loudness", "mode", "speechiness", "acousticness",
        "instrumentalness", "liveness", "valence", "tempo", "duration_ms")]
)


def matches_type(data_type: T.DataType, expected: str) -> bool:
    """Whether a Spark type belongs to the expected class; unknown classes never match."""
    return isinstance(data_type, TYPE_CLASSES.get(expected, ()))


def is_numeric(df: DataFrame, name: str) -> bool:
    return name in df.columns and isinstance(df.schema[name].dataType, NUMERIC_TYPES)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns (booleans are not numeric) in table order, minus ``exclude``."""
    skip = set(exclude)
    return [f.name for f in df.schema
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in skip]


def quoted(name: str) -> Column:
    """Column reference that is safe for names holding dots or spaces."""
    return F.col(f"`{name.replace('`', '``')}`")


def number(df: DataFrame, name: str) -> Column:
    """A numeric column as double, with NaN read as missing.

    Spark orders NaN above every number, so a NaN left in place would count as an
    out-of-range value or as the maximum.
    """
    value = quoted(name).cast("double")
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return F.nanvl(value, F.lit(None).cast("double"))
    return value


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating column, in one projection."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    if not floats:
        return df
    return df.select(*[
        F.nanvl(quoted(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
        if f.name in floats else quoted(f.name)
        for f in df.schema
    ])


def with_row_key(df: DataFrame, key: str = "row_key",
                 columns: Sequence[str] | None = None) -> DataFrame:
    """Add a content-derived key for tables that come without one.

    The key depends on the row's values only, so it is the same for any file layout or
    number of partitions. Rows with equal content share a key.
    """
    parts = [quoted(c) for c in (columns or df.columns)]
    body = F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})
    return df.withColumn(key, F.md5(body))

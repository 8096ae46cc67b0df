"""Scans: delimited text and columnar tables, described by a small configuration."""

from __future__ import annotations

import posixpath
from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import nan_to_null, quoted

# Spellings of "missing" in delimited text, besides the empty field.
MISSING_SPELLINGS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

FORMATS = ("csv", "parquet")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence on whatever file system the path names."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


#: What a field of each inferred type looks like; types are tried in this order.
FIELD_TYPES = (
    ("int", r"^[+-]?\d+$"), ("bigint", r"^[+-]?\d+$"),
    ("double", r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?(?i:inf|infinity)$"),
    ("boolean", r"^(?i:true|false)$"), ("date", r"^\d{4}-\d{2}-\d{2}$"),
    ("timestamp", r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}"),
)

BAD_FIELDS = "_bad_fields"


def read_delimited(spark: SparkSession, path: str, *, delimiter: str = ",",
                   header: int | None = 0, encoding: str = "utf-8",
                   schema: T.StructType | None = None, multiline: bool = False,
                   bad_fields: str = "fail") -> DataFrame:
    """Scan delimited text.

    Fields are read as text, spellings of "missing" become NULL, and only then get their types.
    Pass ``schema`` in production: without one an aggregation over the table finds the types,
    so the data is read an extra time. Fields that are not of their declared type stop the
    read (``bad_fields="fail"``; also when nothing later uses their column, as in a count), become NULL (``"null"``), or become NULL and are named in an array
    column ``_bad_fields`` (``"column"``; see ``count_bad_fields``). ``multiline`` allows line breaks
    inside quoted fields, at the price that a file can no longer be split between tasks.
    """
    if not path or not isinstance(path, str):
        raise ValueError("a table path is needed")
    if header not in (0, None):
        raise ValueError("header must be 0 (first line holds the names) or None")
    if bad_fields not in ("fail", "null", "column"):
        raise ValueError("bad_fields must be fail, null or column")
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no table at {path}")
    reader = (spark.read.option("sep", delimiter).option("encoding", encoding)
              .option("header", header == 0).option("escape", '"')
              .option("multiLine", multiline))
    if schema is not None:
        reader = reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema]))
    texts = _missing_to_null(reader.csv(path))
    if schema is None:
        return nan_to_null(_typed(texts, _inferred_types(texts)))
    types = {f.name: f.dataType.simpleString() for f in schema if not isinstance(f.dataType, T.StringType)}
    return nan_to_null(_declared(texts, types, bad_fields))


def _missing_to_null(df: DataFrame) -> DataFrame:
    return df.select(*[F.when(~F.trim(quoted(c)).isin(*MISSING_SPELLINGS), quoted(c)).alias(c) for c in df.columns])


def _typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.trim(quoted(c)).try_cast(types[c]).alias(c) if c in types else quoted(c) for c in df.columns])


def _inferred_types(texts: DataFrame) -> dict[str, str]:
    """The first type that every field of a column has; columns of none, or without fields, stay text."""
    checks = []
    for i, c in enumerate(texts.columns):
        field = F.trim(quoted(c))
        checks.append(F.count(field).alias(f"n{i}"))
        checks += [F.count_if(field.rlike(pattern) & field.try_cast(kind).isNotNull()).alias(f"n{i}_{kind}")
                   for kind, pattern in FIELD_TYPES]
    found = texts.agg(*checks).first()
    types = {}
    for i, c in enumerate(texts.columns):
        fitting = [kind for kind, _ in FIELD_TYPES if found[f"n{i}"] and found[f"n{i}_{kind}"] == found[f"n{i}"]]
        if fitting:
            types[c] = fitting[0]
    return types


def _declared(texts: DataFrame, types: Mapping[str, str], bad_fields: str) -> DataFrame:
    def bad(c: str) -> Column:
        return quoted(c).isNotNull() & F.trim(quoted(c)).try_cast(types[c]).isNull()

    if bad_fields == "fail" and types:
        # A condition on the rows, which stays when later steps use none or some of the columns.
        first = F.coalesce(*[F.when(bad(c), F.concat(F.lit(f"column '{c}' of type {types[c]} has the field: "), quoted(c))) for c in types])
        texts = texts.where(F.when(reduce(lambda a, b: a | b, [bad(c) for c in types]), F.raise_error(first).cast("boolean")).otherwise(True))
    typed = [F.trim(quoted(c)).try_cast(types[c]).alias(c) if c in types else quoted(c) for c in texts.columns]
    if bad_fields == "column":
        typed.append(F.array_compact(F.array(*[F.when(bad(c), F.lit(c)) for c in types]).cast("array<string>")).alias(BAD_FIELDS))
    return texts.select(*typed)


def count_bad_fields(df: DataFrame) -> DataFrame:
    """``column, n`` of the bad fields of a table read with ``bad_fields="column"``."""
    return df.select(F.explode(BAD_FIELDS).alias("column")).groupBy("column").agg(F.count(F.lit(1)).alias("n"))


def read_columnar(spark: SparkSession, path: str,
                  schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return nan_to_null(reader.parquet(path))


def load_table(spark: SparkSession, config: Mapping[str, Any], *, base_dir: str | None = None,
               schema: T.StructType | None = None) -> DataFrame:
    """Load the table the ``data_source`` section of a configuration describes."""
    source = config.get("data_source", {})
    kind = str(source.get("type", "csv")).lower()
    if kind not in FORMATS:
        raise ValueError(f"data_source.type is '{kind}'; known: {', '.join(FORMATS)}")
    raw_path = source.get("raw_path")
    if not raw_path or not isinstance(raw_path, str):
        raise ValueError("data_source.raw_path is not set")
    path = resolve(raw_path, base_dir)
    if kind == "parquet":
        return read_columnar(spark, path, schema)
    return read_delimited(
        spark, path, schema=schema,
        delimiter=source.get("delimiter", ","), header=source.get("header", 0),
        encoding=source.get("encoding", "utf-8"), multiline=source.get("multiline", False),
        bad_fields=source.get("bad_fields", "fail"),
    )


def resolve(path: str, base_dir: str | None) -> str:
    """Relative paths are taken from the configuration's folder; absolute ones win."""
    if base_dir is None or path.startswith("/") or "://" in path:
        return path
    return posixpath.join(base_dir, path)


def load_config(path: str) -> dict[str, Any]:
    """Read a YAML or JSON configuration file into a plain dict."""
    with open(path, encoding="utf-8") as handle:
        text = handle.read()
    if path.endswith(".json"):
        import json
        return json.loads(text)
    import yaml
    return yaml.safe_load(text) or {}

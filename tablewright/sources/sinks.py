"""Sinks: tables, column lists, one-document reports and versioned datasets."""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .tables import path_exists


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """Write a table; every task writes its own files."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.format(fmt).save(path)
    return path


def write_column_list(spark: SparkSession, names: Sequence[str], path: str) -> str:
    """One column name per line, in order."""
    rows = [(n,) for n in names]
    spark.createDataFrame(rows, "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def read_column_list(spark: SparkSession, path: str) -> list[str]:
    return [r.value for r in spark.read.text(path).collect()]


def write_document(df: DataFrame, path: str) -> str:
    """A one-row table (metrics, validation report) as a single JSON document."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def metrics_frame(spark: SparkSession, metrics: Mapping[str, Any]) -> DataFrame:
    """Metrics dict as a one-row table; undefined values are NULL."""
    schema = T.StructType([T.StructField(k, T.DoubleType()) for k in metrics])
    row = tuple(None if v is None or v != v else float(v) for v in metrics.values())
    return spark.createDataFrame([row], schema)


# --- named datasets handed from one job to the next --------------------------------------

MANIFESTS = "_manifests"


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path as that names it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _numbers(spark: SparkSession, folder: str, prefix: str = "") -> set[int]:
    """Numbers of the entries of a folder that are called ``prefix`` and a number."""
    if not path_exists(spark, folder):
        return set()
    files, target = _files(spark, folder)
    labels = [status.getPath().getName() for status in files.listStatus(target)]
    return {int(x.removeprefix(prefix)) for x in labels if x.startswith(prefix) and x.removeprefix(prefix).isdigit()}


def _versions(spark: SparkSession, root: str, name: str) -> dict[int, str]:
    """The committed versions and their folders: those with a manifest, and written folders of earlier layouts."""
    folder = f"{root.rstrip('/')}/{name}"
    found = {n: f"{folder}/version={n}" for n in _numbers(spark, folder, "version=") if path_exists(spark, f"{folder}/version={n}/_SUCCESS")}
    for n in _numbers(spark, f"{folder}/{MANIFESTS}"):
        files, target = _files(spark, f"{folder}/{MANIFESTS}/{n}")
        stream = files.open(target)
        try:
            found[n] = f"{folder}/{spark._jvm.org.apache.commons.io.IOUtils.toString(stream, 'UTF-8')}"
        finally:
            stream.close()
    return dict(sorted(found.items()))


def _claim(spark: SparkSession, folder: str, number: int, data: str) -> bool:
    """Give a version its number: create its manifest whole, unless another writer has. True if it is ours.

    The manifest is written under a name of its own and then renamed to the number, which fails if that is
    taken. A local file system renames over existing files; there a hard link does the same.
    """
    base = f"{folder}/{MANIFESTS}"
    files, ours = _files(spark, f"{base}/.{data}")
    out = files.create(ours, True)
    out.write(data.encode())
    out.close()
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{number}")
    try:
        if files.getUri().getScheme() == "file":
            os.link(ours.toUri().getPath(), target.toUri().getPath())
            return True
        return _rename_new(spark, files, ours, target)
    except FileExistsError:
        return False
    finally:
        files.delete(ours, False)


def _rename_new(spark: SparkSession, files, source, target) -> bool:
    """Rename unless the target exists; one step on file systems that keep their names in one place."""
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(files.makeQualified(source), files.makeQualified(target), options)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName() or path_exists(spark, target.toString()):
            return False
        raise


def publish(df: DataFrame, root: str, name: str, keep: int | None = None) -> int:
    """Write ``df`` as the next version of a named dataset; returns the version.

    The rows go to a folder that no version names yet. The version exists from the moment its manifest does,
    which is created whole or not at all; a writer that loses a number to another takes the next one
    without writing the rows again. So concurrent writers get different versions, readers see whole ones,
    and what a crash leaves is named by none. With ``keep`` only that many last versions stay: older
    manifests go first, then their rows, so a reader that has already resolved one may fail.
    """
    spark = df.sparkSession
    folder, data = f"{root.rstrip('/')}/{name}", f"data-{uuid.uuid4().hex}"
    write_table(df, f"{folder}/{data}", mode="errorifexists")
    while True:
        # Numbers that an unfinished write of an earlier layout has taken are passed over.
        taken = _numbers(spark, f"{folder}/{MANIFESTS}") | _numbers(spark, folder, "version=")
        version = max(taken, default=0) + 1
        if _claim(spark, folder, version, data):
            break
    if keep is not None:
        _retain(spark, root, name, keep)
    return version


def _retain(spark: SparkSession, root: str, name: str, keep: int) -> None:
    if keep < 1:
        raise ValueError("at least one version must be kept")
    known = _versions(spark, root, name)
    for version in list(known)[:-keep]:
        for path in (f"{root.rstrip('/')}/{name}/{MANIFESTS}/{version}", known[version]):
            files, target = _files(spark, path)
            files.delete(target, True)


def dataset_versions(spark: SparkSession, root: str, name: str) -> list[int]:
    """Numbers of the versions that can be read, ascending."""
    return list(_versions(spark, root, name))


def read_dataset(spark: SparkSession, root: str, reference: str) -> DataFrame:
    """Read ``name``, ``name:latest`` or ``name:<version>``."""
    name, _, tag = reference.partition(":")
    known = _versions(spark, root, name)
    if tag in ("", "latest"):
        if not known:
            raise FileNotFoundError(f"No version of dataset '{name}' under {root}")
        version = max(known)
    else:
        version = int(tag.removeprefix("v"))
        if version not in known:
            raise FileNotFoundError(f"Dataset '{name}' has no version {version}")
    return spark.read.parquet(known[version])


def require_columns_stored(spark: SparkSession, path: str, names: Sequence[str]) -> None:
    """Check a stored feature table's schema (footers only) for the selected columns."""
    stored = set(spark.read.parquet(path).columns)
    missing = [n for n in names if n not in stored]
    if missing:
        raise ValueError(f"Selected features missing from the stored feature table: {missing}")

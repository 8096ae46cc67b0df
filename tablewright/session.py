"""Session settings and the shared scratch location every operator uses."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def tuned_session(app: str = "tablewright", master: str | None = None,
                  **conf: object) -> SparkSession:
    """A session with the settings the operators are written for.

    Cluster submissions normally bring their own configuration; anything passed in
    ``conf`` (dots as ``__``) wins over the defaults set here.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the cluster's shared checkpoint location.

    The location is read from ``spark.checkpoint.dir``. Only a local-mode session may
    fall back to a temporary folder, because there driver and executors are one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="tablewright-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str = "table") -> DataFrame:
    """Write a derived table to the shared folder and go on from the written copy.

    For tables that several passes read: the work behind them is done once, later passes
    read only the columns they use, and a lost executor costs a re-read, not a re-run.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def written(df: DataFrame, purpose: str = "table") -> Iterator[DataFrame]:
    """``materialize`` for a table that only the block needs: its folder is deleted at the end."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)

"""Expectations on a stream: the counts of the batch report, kept over micro-batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.quality import Expectation, QualityReport, counts_of, planned, reported
from ..sources.tables import path_exists


def watch_quality(stream: DataFrame, expectations: Sequence[Expectation], path: str, checkpoint: str, *,
                  available_now: bool = True, interval: str = "30 seconds") -> StreamingQuery:
    """Count the rows that break each expectation, over all that the stream has brought so far.

    The counts are the state of a streaming aggregation: one row, kept under ``checkpoint`` with the sources'
    offsets, so that after a restart no row is missing and none counts twice. Every micro-batch writes
    the sums to its own ``batch=<id>`` folder under ``path``, replacing what a failed attempt may have left;
    ``stream_report`` reads the last one. Allowed values have to be lists here.
    """
    if any(isinstance(e.allowed, DataFrame) for e in expectations):
        raise ValueError("a stream is checked against lists of allowed values, not tables")
    _, checks = planned(stream, expectations)
    counts = stream.agg(F.count(F.lit(1)).alias("rows"), *counts_of(checks))

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (counts.writeStream.outputMode("complete").foreachBatch(store)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def stream_report(spark: SparkSession, path: str, template: DataFrame, expectations: Sequence[Expectation]) -> tuple[QualityReport, int]:
    """The report of the last finished micro-batch, and how many rows it covers.

    ``template`` is the stream or any table with its schema.
    """
    report, checks = planned(template, expectations)
    if not path_exists(spark, path):
        return report, 0
    rows = spark.read.parquet(path)
    last = rows.orderBy(F.desc("batch")).first()
    if last is None:
        return report, 0
    known = {(e.name, kind): last[f"n{i}"] for i, (e, kind, _) in enumerate(checks)}
    return reported(report, expectations, known), last["rows"]

"""Score records as they arrive, and route the ones that break a rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.quality import RECORD_RULES, RecordRule, split_records
from ..operators.scoring import Scorer


def open_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                **options: object) -> DataFrame:
    """A file-fed stream; the schema is given, never inferred."""
    reader = spark.readStream.format(fmt).schema(schema)
    return reader.options(**{k: str(v) for k, v in options.items()}).load(path)


def write_stream(stream: DataFrame, path: str, checkpoint: str, *,
                 fmt: str = "parquet", available_now: bool = True,
                 interval: str = "30 seconds") -> StreamingQuery:
    """Append to files; the checkpoint makes each input row land exactly once."""
    writer = (stream.writeStream.format(fmt).outputMode("append")
              .option("checkpointLocation", checkpoint))
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start(path)


def score_stream(stream: DataFrame, scorer: Scorer, path: str, checkpoint: str,
                 **options) -> StreamingQuery:
    """The batch scoring projection on a stream; it keeps no state."""
    return write_stream(scorer.score(stream), path, checkpoint, **options)


def route_stream(stream: DataFrame, valid_path: str, rejected_path: str, checkpoint: str, *,
                 rules: Sequence[RecordRule] = RECORD_RULES, available_now: bool = True,
                 interval: str = "30 seconds") -> StreamingQuery:
    """Valid rows to one place, the others with their violations to another.

    Each micro-batch writes its own ``batch=<id>`` folders, replacing what a failed attempt
    at the same batch may have left; so a restart neither loses nor doubles rows.
    """

    def route(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for part, path in zip(split_records(batch, rules), (valid_path, rejected_path)):
                part.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            batch.unpersist()

    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (stream.writeStream.foreachBatch(route)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())

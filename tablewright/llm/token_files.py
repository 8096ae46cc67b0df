"""Token ids in ORC files: run-length encoded stripes, row indexes, Bloom filters on doc_id."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.base import lists, pieces, query, small_batches, table
from tablewright.llm.words import tokenizer
from tablewright.session import shared_folder

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

FILE_SCHEMA = "doc_id long, part int, part_start long, ids array<int>"


def write_token_files(docs: DataFrame, path: str, vocabulary: str = BYTE_BPE, end_id: int = 2,
                      stripe_bytes: int = 16 << 20, index_rows: int = 1000, bloom_fpp: float = 0.01) -> None:
    """Encode every document, end it with ``end_id``, and write ORC files in doc_id order.

    Documents are dealt into ranges of doc_id and sorted inside them (ties by text), so each file
    covers one range: its stripe and row-group statistics prune by doc_id, and a Bloom filter
    serves single ids. ``part`` counts the ranges and ``part_start`` the ids before a document
    within its range, so positions over all files need the range totals only. NULL doc_ids come
    first; a NULL text is empty and gives the end id alone; repeated rows are all kept. An empty
    table gives a folder without rows. A lost executor repeats its ranges.
    """
    small_batches(docs.sparkSession)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, start = tokenizer(vocabulary), 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            for piece in pieces(batch):
                flat, lengths = words.encode(piece.column("text"))
                ends = np.cumsum(lengths)
                flat = np.insert(flat, ends, end_id).astype(np.int32)
                offsets = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])
                yield pa.record_batch({
                    "doc_id": piece.column("doc_id"),
                    "part": pa.array(np.full(len(ends), part, np.int32)),
                    "part_start": pa.array(start + offsets[:-1]),
                    "ids": lists(flat, offsets)})
                start += int(offsets[-1])

    (docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
     .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(encode, FILE_SCHEMA)
     .write.option("orc.stripe.size", stripe_bytes).option("orc.row.index.stride", index_rows)
     .option("orc.create.index", "true").option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", bloom_fpp).option("orc.compress", "ZSTD").orc(path))


def read_token_files(spark: SparkSession, path: str, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """The written rows; with ``doc_ids`` only these, found by file metadata.

    The filter is pushed to the ORC reader: stripes and row groups whose statistics or Bloom
    filters exclude the ids are not read. Stripes are read in parallel.
    """
    rows = spark.read.schema(FILE_SCHEMA).orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin([int(d) for d in doc_ids]))


def token_index(rows: DataFrame) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    small_batches(rows.sparkSession)

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            offsets = ids.offsets.to_numpy().astype(np.int64)
            values = memoryview(ids.values.to_numpy().astype("<u4")).cast("B")
            crcs = [zlib.crc32(values[4 * a:4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "part": batch.column("part"),
                "part_start": batch.column("part_start"), "n_tokens": pa.array(np.diff(offsets)),
                "ids_crc32": pa.array(crcs, pa.int64())})

    index = rows.mapInArrow(digest, "doc_id long, part int, part_start long, n_tokens long, ids_crc32 long")
    totals = rows.groupBy("part").agg(F.sum(F.size("ids")).alias("total"))
    # One row per range: the only rows this window sees.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    return index.join(offsets, "part").select(
        "doc_id", (F.col("offset") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32")


@query("op8_token_files")
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "token-ids")
    write_token_files(table(spark, sf_dir, "documents"), path)
    return token_index(read_token_files(spark, path))

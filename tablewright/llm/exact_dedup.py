"""Exact duplicates by two passes of Bloom filtering; only rows that may be repeated are shuffled."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.base import query, table
from tablewright.session import shared_folder

#: Characters that do not count when texts are compared: the space and 0x09-0x0D.
BLANKS = " \t\n\x0b\x0c\r"
#: Bits of the filter per row, bits of one block, and bits a row sets in its block.
ROW_BITS = 16
BLOCK_BITS = 512
WORDS = BLOCK_BITS // 64
#: Rows that one filter serves. It has at most 2 * SLICE_ROWS * ROW_BITS / BLOCK_BITS blocks of some 100 bytes
#: (0.4 GB), which is the bound of what is broadcast at a time; larger tables are filtered in slices of the hashes.
SLICE_ROWS = 1 << 26
#: Groups of copies with a share of 1 / HEAVY_GROUPS of all rows, and HEAVY_ROWS at least, are broadcast; that many exist at most.
HEAVY_GROUPS = 10_000
HEAVY_ROWS = 64


def squeezed(text: Column) -> Column:
    """The text as it is compared: without blanks; NULL is empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), BLANKS, "")


def _bits(h: Column) -> tuple[Column, Column]:
    """The two bits of a row within its block."""
    return tuple(F.shiftrightunsigned(h, k).bitwiseAND(F.lit(BLOCK_BITS - 1)) for k in (32, 41))


def _blocks(rows: int) -> int:
    """Blocks of a filter for so many rows, a power of two."""
    return 1 << max(0, (rows * ROW_BITS // BLOCK_BITS - 1)).bit_length()


def _block(h: Column, blocks: int) -> Column:
    return h.bitwiseAND(F.lit(blocks - 1))


def repeated_bits(hashes: DataFrame, blocks: int) -> DataFrame:
    """First pass, over a column ``h``: per block the eight words of the bits that two rows or more set.

    Rows are (block, w0..w7) with only the blocks that have such a bit. Bits are counted with
    partial aggregation, so a hash that a third of all rows share is one partial row a task.
    """
    one, two = _bits(F.col("h"))
    slots = hashes.select(F.explode(F.array_distinct(F.array(*[
        _block(F.col("h"), blocks) * BLOCK_BITS + bit for bit in (one, two)]))).alias("slot"))
    often = slots.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    word = F.shiftright("slot", 6).bitwiseAND(F.lit(WORDS - 1))
    mask = F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")
    return often.groupBy(F.shiftright("slot", 9).alias("block")).agg(
        *[F.coalesce(F.bit_or(F.when(word == j, mask)), F.lit(0).cast("long")).alias(f"w{j}") for j in range(WORDS)])


def may_repeat(rows: DataFrame, bits: DataFrame, blocks: int) -> DataFrame:
    """Second pass: the rows with ``possible``, false where the hash ``h`` is sure to occur once."""
    words = F.array(*[F.col(f"w{j}") for j in range(WORDS)])
    held = [F.getbit(F.get(words, F.shiftright(bit, 6).cast("int")), bit.bitwiseAND(F.lit(63)).cast("int")) == 1
            for bit in _bits(F.col("h"))]
    looked = rows.withColumn("block", _block(F.col("h"), blocks)).join(F.broadcast(bits), "block", "left")
    return looked.withColumn("possible", F.coalesce(held[0] & held[1], F.lit(False))).drop("block", *[f"w{j}" for j in range(WORDS)])


def _judge(marks: DataFrame, rows: int, total: int) -> DataFrame:
    """Verdicts on one slice of the written marks, of ``total`` rows in all slices."""
    blocks = _blocks(rows)
    marks = may_repeat(marks, repeated_bits(marks.select("h"), blocks), blocks)
    possible = marks.where("possible")
    # The longest original first, then the least doc_id (NULL last), then any one of equal rows.
    order = F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), "doc_id", "row")
    groups = possible.groupBy("digest").agg(F.count(F.lit(1)).alias("size"), F.min(order).alias("best")).where(
        "size > 1").select("digest", "size", F.col("best.doc_id").alias("best_id"), F.col("best.row").alias("best_row"))
    # Rows of a large group look it up where they are: there are at most HEAVY_GROUPS of that size. Others meet by digest.
    heavy = F.col("size") >= max(HEAVY_ROWS, total // HEAVY_GROUPS)
    large = groups.where(heavy).select("digest", *[F.col(c).alias(f"large_{c}") for c in ("size", "best_id", "best_row")])
    possible = possible.join(F.broadcast(large), "digest", "left")
    of_large = possible.where("large_size IS NOT NULL").select(
        "doc_id", F.col("large_best_id"), F.col("large_size"), F.col("row") == F.col("large_best_row"), "digest")
    found = F.col("size").isNotNull()
    passed = marks.where("NOT possible").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
    return passed.union(of_large).union(possible.where("large_size IS NULL").join(groups.where(~heavy), "digest", "left").select(
        "doc_id", F.when(found, F.col("best_id")).otherwise(F.col("doc_id")), F.coalesce("size", F.lit(1)),
        ~found | (F.col("row") == F.col("best_row")), "digest"))


def find_copies(docs: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Per row of (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are identical without blanks (space, 0x09-0x0D); NULL texts are empty, and
    empty ones equal each other. Of equal texts the row with the most code points stays, then the least
    doc_id, NULL last; of rows that agree in all this exactly one stays. Repeated doc_ids are rows of their
    own; other columns are ignored; an empty table gives no row.

    The texts are read once, into a written table of 56 bytes a row. The first pass counts bits of the
    rows' hashes; the second finds the rows all of whose bits were set twice. Only those are grouped by
    their SHA-256; the others go straight to the result. A wrong guess of the filter costs a row in a
    shuffle, never a result. Above ``slice_rows`` rows the hashes are dealt into slices, each in folders
    of its own, with a filter each, so that what is broadcast stays bounded.
    """
    total = docs.count()
    slices = max(1, -(-total // slice_rows))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.length(F.col("text").cast("string")), F.lit(0)).alias("n_chars"),
                        F.unhex(F.sha2(squeezed(F.col("text")), 256)).alias("digest"))
    marks = plain.select("*", F.xxhash64("digest").alias("h"), F.monotonically_increasing_id().alias("row"),
                         F.pmod(F.shiftrightunsigned(F.xxhash64("digest"), 50), F.lit(slices)).cast("int").alias("slice"))
    path = shared_folder(docs.sparkSession, "copy-marks")
    (marks.write.partitionBy("slice") if slices > 1 else marks.write).parquet(path)
    marks = docs.sparkSession.read.schema(marks.schema).parquet(path)
    # Distinct hashes spread evenly; copies fill one slice more than others, but not its filter.
    parts = [_judge(marks.where(F.col("slice") == k), -(-total // slices), total) for k in range(slices)]
    return reduce(DataFrame.union, parts).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, rows: int | None = None) -> DataFrame:
    """The documents with one row of each set of equal texts, all columns kept; see ``find_copies``.

    Rows that the filter clears pass straight through with their texts; only the others are shuffled,
    and copies are reduced to one row before they are. The texts are read twice and nothing is written.
    ``rows`` (default: counted) sizes the one filter, at most for ``SLICE_ROWS`` rows: beyond that it
    clears fewer rows, and the result stays the same.
    """
    blocks = _blocks(min(docs.count() if rows is None else rows, SLICE_ROWS))
    digest = F.unhex(F.sha2(squeezed(F.col("text")), 256))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), digest.alias("digest"))
    marked = whole.select("doc", "digest", F.xxhash64("digest").alias("h"))
    probed = may_repeat(marked, repeated_bits(marked.select("h"), blocks), blocks)
    order = F.struct(-F.coalesce(F.length(F.col("doc.text").cast("string")), F.lit(0)), F.col("doc.doc_id").isNull(), F.col("doc.doc_id"))
    one = probed.where("possible").groupBy("digest").agg(F.min_by("doc", order).alias("doc"))
    return probed.where("NOT possible").select("doc").union(one.select("doc")).select("doc.*")


OP13_SQL = r"""
WITH plain AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id) AS place,
         count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id) AS keep_id
  FROM plain)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ordered
"""


@query("op13_exact_dedup", OP13_SQL)
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_copies(table(spark, sf_dir, "documents"))

"""How many values of a column a table of allowed values does not hold.

A Bloom filter of the allowed values, laid out in blocks, is joined to the rows where they are read: a value
that it rejects is surely not allowed and counted there. What it lets through is counted by value and
compared exactly with the allowed ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import quoted
from .frequent import digests

#: Bits per allowed value, bits of a block, bits that a value sets in its block.
VALUE_BITS = 16
BLOCK_BITS = 512
WORDS = BLOCK_BITS // 64
PROBES = (32, 41, 50)
#: Blocks of the largest filter, some 100 bytes each (0.1 GB broadcast); more values make it let more through, nothing else.
MOST_BLOCKS = 1 << 20


def _bits(h: Column) -> list[Column]:
    return [F.shiftrightunsigned(h, k).bitwiseAND(F.lit(BLOCK_BITS - 1)) for k in PROBES]


def bloom_filter(hashes: DataFrame, blocks: int) -> DataFrame:
    """``block, w0..w7`` of a column ``h``; one row per block that is not empty."""
    set_bits = hashes.select(F.col("h").bitwiseAND(F.lit(blocks - 1)).alias("block"), F.explode(F.array(*_bits(F.col("h")))).alias("bit"))
    mask = F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")
    return set_bits.groupBy("block").agg(*[
        F.coalesce(F.bit_or(F.when(F.shiftright("bit", 6) == j, mask)), F.lit(0).cast("long")).alias(f"w{j}") for j in range(WORDS)])


def may_hold(rows: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """The rows with ``possible``: false where the filter is sure that it never saw the hash ``h``."""
    words = F.array(*[F.col(f"w{j}") for j in range(WORDS)])
    held = F.lit(True)
    for bit in _bits(F.col("h")):
        held &= F.getbit(F.get(words, F.shiftright(bit, 6).cast("int")), bit.bitwiseAND(F.lit(63)).cast("int")) == 1
    looked = rows.withColumn("block", F.col("h").bitwiseAND(F.lit(blocks - 1))).join(F.broadcast(bloom), "block", "left")
    return looked.withColumn("possible", F.coalesce(held, F.lit(False))).drop("block", *[f"w{j}" for j in range(WORDS)])


def count_not_in(df: DataFrame, column: str, allowed: DataFrame) -> int:
    """Rows whose value is present (NaN is missing) and not in the first column of ``allowed``.

    Values are compared as the column's own type, written as text, by two 64-bit hashes; a NULL among the
    allowed ones allows nothing. The rows are read once, with one partial count per value and task.
    """
    kind = df.schema[column].dataType

    def hashed(value: Column) -> list[Column]:
        return [h.alias(a) for h, a in zip(digests(value.cast("string")), ("h", "h2"))]

    listed = allowed.select(quoted(allowed.columns[0]).try_cast(kind).alias("v")).where("v IS NOT NULL").select(*hashed(F.col("v"))).distinct()
    blocks = 1 << min(max(0, (listed.count() * VALUE_BITS // BLOCK_BITS - 1)).bit_length(), MOST_BLOCKS.bit_length() - 1)
    value = quoted(column)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = F.when(~F.isnan(value), value)
    values = df.select(value.alias("v")).where("v IS NOT NULL").select(*hashed(F.col("v")))
    probed = may_hold(values, bloom_filter(listed.select("h"), blocks), blocks)
    # Rejected values need no name any more: they are one group.
    counted = probed.select("possible", *[F.when(F.col("possible"), F.col(h)).alias(h) for h in ("h", "h2")]).groupBy(
        "possible", "h", "h2").agg(F.count(F.lit(1)).alias("n"))
    left = counted.where("possible").join(listed, ["h", "h2"], "left_anti").select("n")
    return counted.where("NOT possible").select("n").union(left).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

"""Registry of the text queries and the array kernels the text operators share."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Text held by one Arrow batch, and by one call of a kernel inside it.
BATCH_ROWS = 1000
BATCH_BYTES = "8m"
PIECE_BYTES = 1 << 20


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL where one can be written."""
    def register(make: Query) -> Query:
        QUERIES[name] = make
        if sql is not None:
            ORACLES[name] = sql.strip()
        return make
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what an Arrow batch holds: texts may be long, and 10,000 of them are too many."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of at most ``limit`` bytes of text (one row at least)."""
    text = batch.column(column)
    sizes = np.asarray(pc.binary_length(text).fill_null(0), dtype=np.int64)
    total, begin = np.cumsum(sizes), 0
    while begin < len(total):
        before = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, before + limit, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; NULL reads as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
TAIL = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)
LONG_WORD = 256


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (in place)."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of every row, and each row's offset into them.

    Words are maximal runs of bytes other than space and 0x09-0x0D.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~SPACE[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    inner = offsets[1:-1]
    first = inner[inner < len(data)]
    begin[first] = inside[first]
    last = inner[inner > 0] - 1
    end[last] = inside[last]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, eight bytes a step over all words at once."""
    lengths = ends - starts
    hashes = mix(lengths.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    if not len(starts):
        return hashes
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    loads = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(data) + 1,), (1,))
    active, at = np.flatnonzero(lengths <= LONG_WORD), 0
    while len(active):
        left = lengths[active] - at
        chunk = loads[starts[active] + at] & TAIL[np.minimum(left, 8)]
        hashes[active] = mix(hashes[active] * np.uint64(0x9E3779B97F4A7C15) + chunk)
        at += 8
        active = active[left > 8]
    for i in np.flatnonzero(lengths > LONG_WORD):
        digest = hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8).digest()
        hashes[i] = np.frombuffer(digest, np.uint64)[0]
    return hashes


def fold(hashes: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each position on."""
    out = np.full(len(at), width * 0x9E3779B97F4A7C15 % 2**64, np.uint64)
    for k in range(width):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + hashes[at + k])
    return out


def shingle_sets(column: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row (flat), and the row offsets.

    Lower-cases A-Z. A row of fewer than ``width`` words has its whole sequence as its one
    shingle; a row without words has none.
    """
    data, offsets = utf8(column)
    data = LOWER[data]
    starts, ends, rows = word_bounds(data, offsets)
    hashes = word_hashes(data, starts, ends)
    counts = np.diff(rows)
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(bounds[-1], np.uint64)
    full = np.repeat(counts >= width, sizes)
    within = np.arange(bounds[-1]) - np.repeat(bounds[:-1], sizes)
    at = np.repeat(rows[:-1], sizes) + within
    out[full] = fold(hashes, at[full], width)
    for w in range(1, width):
        short = np.flatnonzero(counts == w)
        if len(short):
            out[bounds[short]] = fold(hashes, rows[short], w)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a > 1:
            out[a:b].sort()
    keep = np.ones(len(out), bool)
    keep[1:] = out[1:] != out[:-1]
    keep[bounds[:-1][sizes > 0]] = True
    return out[keep], np.concatenate([[0], np.cumsum(keep)])[bounds]


def lists(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A list column from flat values and row offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))


def segments(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... within every run of the given lengths."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)

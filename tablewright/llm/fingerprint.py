"""I-Match fingerprints: hashes of a text's mid-frequency terms under randomised lexicons."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.base import LOWER, mix, pieces, query, small_batches, table, utf8, word_bounds, word_hashes

#: Subsets of the lexicon: ``SEEDS`` independent ones at each share 2**-level of its terms.
LEVELS = (2, 4, 6, 7, 8, 9)
SEEDS = 8
SUBSETS = SEEDS * len(LEVELS)
#: A subset without any of the text's terms has this value instead of a hash.
NO_TERM = np.uint64(0)


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct term hashes of every row (flat), and the row offsets; terms are lower-cased words."""
    data, offsets = utf8(column)
    data = LOWER[data]
    starts, ends, rows = word_bounds(data, offsets)
    hashes = word_hashes(data, starts, ends)
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
        if b - a > 1:
            hashes[a:b].sort()
    keep = np.ones(len(hashes), bool)
    keep[1:] = hashes[1:] != hashes[:-1]
    keep[rows[:-1][np.diff(rows) > 0]] = True
    return hashes[keep], np.concatenate([[0], np.cumsum(keep)])[rows]


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(term, df) over all documents: counted per block of rows, then summed."""
    small_batches(docs.sparkSession)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def block():
            unique, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.record_batch({"term": pa.array(unique.view(np.int64)), "df": pa.array(n.astype(np.int64))})

        for batch in batches:
            for piece in pieces(batch):
                found, _ = terms(piece.column("text"))
                held.append(found)
                size += len(found)
                if size > 4_000_000:
                    yield block()
                    held, size = [], 0
        if size:
            yield block()

    return docs.select("text").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


@dataclass(frozen=True)
class Lexicon:
    """Sorted hashes of the terms within the band of inverse document frequency."""

    terms: np.ndarray
    documents: int

    def hashes(self, column: pa.Array) -> np.ndarray:
        """A 64-bit hash of each row's terms in each subset of the lexicon (rows x subsets), NO_TERM without one.

        The last column is a hash of the bytes of texts that have no term of the whole lexicon, so that of
        these equal texts agree, and only they.
        """
        found, rows = terms(column)
        at = np.searchsorted(self.terms, found)
        at[at == len(self.terms)] = 0
        kept = self.terms[at] == found if len(self.terms) else np.zeros(len(found), bool)
        rows = np.concatenate([[0], np.cumsum(kept)])[rows]
        found = found[kept]
        out = np.zeros((len(rows) - 1, SUBSETS + 1), np.uint64)
        for seed in range(SEEDS):
            drawn = mix(found ^ np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % 2**64))
            for k, level in enumerate(LEVELS):
                inside = (drawn >> np.uint64(64 - level)) == 0
                # The terms are sorted and distinct: their hashes chain to one by a sum of mixed values.
                value = np.where(inside, mix(drawn + np.uint64(level)), np.uint64(0))
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value)])
                some = np.concatenate([[0], np.cumsum(inside)])
                digest = mix(total[rows[1:]] - total[rows[:-1]])
                digest[digest == NO_TERM] = 1
                out[:, seed * len(LEVELS) + k] = np.where(some[rows[1:]] > some[rows[:-1]], digest, NO_TERM)
        for i in np.flatnonzero(rows[1:] == rows[:-1]).tolist():
            text = column[i].as_py() or ""
            out[i, -1] = max(1, int.from_bytes(hashlib.sha256(text.encode()).digest()[:8], "big"))
        return out

    def fingerprints(self, column: pa.Array) -> list[str]:
        """One fingerprint per row: the hashes as hexadecimal text, 16 digits each."""
        return written_out(self.hashes(column))


def written_out(hashes: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in hashes.astype(">u8")]


def likenesses(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per row the share of equal hashes among the subsets in which either text has one; 1 for equal rows, 0 without any."""
    used = (a[:, :SUBSETS] != NO_TERM) | (b[:, :SUBSETS] != NO_TERM)
    equal = used & (a[:, :SUBSETS] == b[:, :SUBSETS])
    share = equal.sum(axis=1) / np.maximum(used.sum(axis=1), 1)
    return np.where((a == b).all(axis=1), 1.0, share)


def likeness(a: str, b: str) -> float:
    """The same of two fingerprints."""
    one, two = (np.frombuffer(bytes.fromhex(x), ">u8").astype(np.uint64)[None, :] for x in (a, b))
    return float(likenesses(one, two)[0])


def build_lexicon(docs: DataFrame, least_share: float = 0.0005, most_share: float = 0.15) -> Lexicon:
    """Terms in at least ``least_share`` and at most ``most_share`` of all documents (and in two).

    That is the band of inverse document frequency from log(1 / most_share) to log(1 / least_share).
    It holds at most (mean distinct terms of a document) / least_share terms, whatever the number
    of documents, which bounds what comes to the driver and is broadcast.
    """
    documents = docs.count()
    band = (document_frequencies(docs).where((F.col("df") >= max(2, least_share * documents)) & (F.col("df") <= most_share * documents))
            .select("term"))
    found = np.asarray(band.toArrow().column("term").to_numpy(), np.int64)
    return Lexicon(np.sort(found.view(np.uint64)), documents)


def fingerprint_documents(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The documents with column ``fingerprint``; NULL texts are empty. A narrow pass."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(lexicon)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [p for piece in pieces(batch) for p in shared.value.fingerprints(piece.column("text"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints, pa.string())], [*batch.schema.names, "fingerprint"])

    docs = docs.drop("fingerprint")
    return docs.mapInArrow(add, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in docs.schema)}, fingerprint string")


def edited(text: str, following: str) -> str:
    """The text, its last half's code points replaced by as many first ones of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compare_neighbours(docs: DataFrame, lexicon: Lexicon, partitions: int | None = None) -> DataFrame:
    """Per document, in order of doc_id (ties by text): its fingerprint, its edited text's, the next document's.

    Documents are dealt into ranges of doc_id and streamed in order, each with the one after it; the
    last one of a range meets the first of the next non-empty range by a window over one row per range, and
    the last document of all is followed by the first. The texts are shuffled once: both the ranges and
    their edges are read from that shuffle, whose number of ranges is fixed (``partitions``, default the
    session's shuffle partitions), and nothing else is written.

    NULL texts are empty; documents without an id come first; repeated rows are documents of their own, equal
    ones next to each other; other columns are ignored. A single document is followed by itself; an empty
    table gives no row. A task holds one batch, or one longer text with its neighbour.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(lexicon)
    columns = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
               " near_edited double, near_next double")
    result = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def rows_of(ids, texts, following, of_texts: np.ndarray, of_next: np.ndarray) -> pa.RecordBatch:
        """Results of texts, each with the one that follows it."""
        new = [edited(a, b) for a, b in zip(texts, following)]
        of_new = shared.value.hashes(pa.array(new, pa.large_string()))
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new], pa.string()), pa.array(written_out(of_texts), pa.string()),
            pa.array(written_out(of_new), pa.string()), pa.array(likenesses(of_texts, of_new)),
            pa.array(likenesses(of_texts, of_next))], schema=result)

    def stream(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for piece in pieces(batch):
                ids, texts = piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()
                hashes = shared.value.hashes(pa.array(texts, pa.large_string()))
                if held is not None:
                    ids, texts, hashes = [held[0], *ids], [held[1], *texts], np.vstack([held[2], hashes])
                held = ids[-1], texts[-1], hashes[-1:]
                if len(ids) > 1:
                    yield rows_of(ids[:-1], texts[:-1], texts[1:], hashes[:-1], hashes[1:])

    def edges_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for batch in batches:
            if batch.num_rows:
                first = batch.slice(0, 1) if first is None else first
                last = batch.slice(batch.num_rows - 1)
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), last.column("doc_id"),
                                              first.column("text"), last.column("text")], ["part", "doc_id", "first_text", "last_text"])

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, following = (batch.column(c).to_pylist() for c in ("doc_id", "last_text", "next_text"))
            yield rows_of(ids, texts, following, *(shared.value.hashes(pa.array(x, pa.large_string())) for x in (texts, following)))

    # A stated number of ranges is kept as it is, so both readers of the shuffle see the same ones.
    number = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
               .repartitionByRange(number, "doc_id").sortWithinPartitions("doc_id", "text"))
    edges = ordered.mapInArrow(edges_of, "part int, doc_id long, first_text string, last_text string")
    # One row per range is all that these windows see.
    order = Window.orderBy("part")
    first_of_all = F.first("first_text").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    edges = edges.select("doc_id", "last_text", F.coalesce(F.lead("first_text").over(order), first_of_all).alias("next_text"))
    return ordered.mapInArrow(stream, columns).union(edges.mapInArrow(finish, columns))


@query("op7_fingerprints")
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return compare_neighbours(docs, build_lexicon(docs))

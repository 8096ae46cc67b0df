"""Benchmark items inside documents, up to an edit budget: exact pieces, then bit-parallel distance."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.base import query, small_batches, table
from tablewright.session import shared_folder

#: Characters of items that one pass over the documents looks for.
BLOCK_CHARS = 4_000_000


def normalize(text: str | None) -> str:
    """Lower case, white space runs as one space, none at the ends."""
    return " ".join((text or "").lower().split())


@dataclass
class Item:
    """A test item, normalised, with its error budget and its pieces' places."""

    item_id: int | None
    text: str
    budget: int
    masks: dict[str, int] = field(default_factory=dict)

    def pieces(self) -> Iterator[tuple[str, int]]:
        """budget + 1 pieces of near-equal length: ``budget`` edits leave one of them whole."""
        n, k = len(self.text), self.budget + 1
        for i in range(k):
            a, b = i * n // k, (i + 1) * n // k
            yield self.text[a:b], a


def masks_of(text: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(text):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def nearest_end(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least edit distance of a pattern of length m to any substring, and its first end (Myers 1999)."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(text):
        equal = masks.get(c, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (full & ~(horizontal | plus))
        down = plus & horizontal
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up = (up << 1) & full
        down = (down << 1) & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
        if score < best:
            best, end = score, j + 1
    return best, end


class Finder:
    """All items of a block; finds those within their budget in a text."""

    def __init__(self, items: list[Item]) -> None:
        import ahocorasick
        self.items = items
        places: dict[str, list[tuple[int, int]]] = {}
        for k, item in enumerate(items):
            for piece, at in item.pieces():
                places.setdefault(piece, []).append((k, at))
        self._automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self._automaton.add_word(piece, (len(piece), found))
        self._automaton.make_automaton()

    def find(self, text: str) -> Iterator[tuple[Item, int, int, int]]:
        """(item, distance, start, end) of the nearest place of every item, in the normalised text."""
        starts: dict[int, set[int]] = {}
        for last, (length, found) in self._automaton.iter(text):
            for k, at in found:
                starts.setdefault(k, set()).add(last + 1 - length - at)
        for k, offsets in starts.items():
            best = self._nearest(self.items[k], sorted(offsets), text)
            if best is not None:
                yield self.items[k], *best

    @staticmethod
    def _nearest(item: Item, offsets: list[int], text: str) -> tuple[int, int, int] | None:
        m, budget = len(item.text), item.budget
        for s in offsets:
            if s >= 0 and text.startswith(item.text, s):
                return 0, s, s + m
        best = None
        at = 0
        while at < len(offsets):
            # Hits whose windows overlap are searched together.
            first = last = offsets[at]
            at += 1
            while at < len(offsets) and offsets[at] - last <= m:
                last = offsets[at]
                at += 1
            begin = max(0, first - budget)
            window = text[begin:last + m + budget]
            item.masks = item.masks or masks_of(item.text)
            distance, end = nearest_end(item.masks, m, window)
            if distance <= budget and (best is None or distance < best[0]):
                _, length = nearest_end(masks_of(item.text[::-1]), m, window[:end][::-1])
                best = distance, begin + end - length, begin + end
        return best


def item_blocks(benchmark: DataFrame, error_rate: float, block_chars: int = BLOCK_CHARS) -> Iterator[list[Item]]:
    """Items in blocks of bounded size (a longer item is one by itself); empty ones are left out.

    They are normalised where they are read and fetched partition by partition, so that at no time more than a
    block and a partition of items is on the driver.
    """
    small_batches(benchmark.sparkSession)

    def normalized(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([normalize(t) for t in batch.column("text").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), texts], ["item_id", "text"])

    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text IS NOT NULL").mapInArrow(
        normalized, "item_id long, text string").where("text <> ''")
    block, held = [], 0
    for row in rows.toLocalIterator():
        block.append(Item(row["item_id"], row["text"], int(error_rate * len(row["text"]))))
        held += len(row["text"])
        if held >= block_chars:
            yield block
            block, held = [], 0
    if block:
        yield block


_FINDERS: dict[str, Finder] = {}


def _finder(name: str, items: list[Item]) -> Finder:
    """The block's automaton, built once per worker process."""
    if name not in _FINDERS:
        if len(_FINDERS) >= 2:
            _FINDERS.clear()
        _FINDERS[name] = Finder(items)
    return _FINDERS[name]


def find_leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = 0.05, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Items in documents: doc_id, item_id, distance, start, end (in the normalised text).

    An item of n characters is found where a substring of a document is within
    floor(error_rate * n) edits of it, both lower-cased with white space runs as one space. It is cut
    into budget + 1 pieces; a place within the budget holds one of them unchanged, so an
    Aho-Corasick pass over the pieces finds every candidate, and Myers' distance decides.
    Each document and item gives one row, for its nearest place (the first, if several are).

    Documents are read once per block of items (``block_chars`` characters), in a narrow pass; a block is what
    tasks receive. If there is more than one, each block's hits are written to one table of the shared folder
    before the next block is fetched, so neither the driver, nor the plan, nor what executors hold grows with
    the benchmark. Long texts are searched whole. NULL and empty texts or items match nothing, equal items
    each give a row, repeated documents repeat their rows, empty tables give no rows, other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    kinds = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()),
                       ("start", pa.int64()), ("end", pa.int64())])

    def search(finder: Finder, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        hits = [(doc, item.item_id, *place)
                for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
                for item, *place in finder.find(normalize(text))]
        if hits:
            yield pa.record_batch([pa.array(c, k.type) for c, k in zip(zip(*hits), kinds)], schema=kinds)

    found, _ = _block_by_block(rows, benchmark, error_rate, block_chars, search, "doc_id long, item_id long, distance int, start long, end long")
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = 0.05, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that hold no item (see ``find_leaks``); rows and columns stay as they are.

    NULL and empty texts hold none; rows with equal texts are kept or dropped alike, whatever their doc_ids;
    columns of any name pass; empty tables drop nothing. With one block of items that is a filter where the
    documents are read. With more, the blocks' passes write two 64-bit hashes of each text that holds an item,
    and the documents are kept that have none of them.
    """
    def clean(finder: Finder, batch: pa.RecordBatch) -> list[bool]:
        return [next(finder.find(normalize(text)), None) is None for text in batch.column("text").to_pylist()]

    def keep(finder: Finder, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield batch.filter(pa.array(clean(finder, batch), pa.bool_()))

    def leaky(finder: Finder, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        dirty = [not c for c in clean(finder, batch)]
        yield batch.filter(pa.array(dirty, pa.bool_())).select(["h1", "h2"])

    text = F.col("text").cast("string")
    names = [f"__leak_{i}" for i in (1, 2)]
    hashes = [F.xxhash64(text), F.xxhash64(F.lit(7), text)]
    marked = docs.select(text.alias("text"), *[h.alias(n) for h, n in zip(hashes, ("h1", "h2"))])
    found, blocks = _block_by_block(marked, benchmark, error_rate, block_chars, leaky, "h1 long, h2 long", one=(docs, keep, docs.schema))
    if blocks < 2:
        return found if blocks else docs
    known = found.distinct().select(*[F.col(h).alias(n) for h, n in zip(("h1", "h2"), names)])
    return docs.withColumns(dict(zip(names, hashes))).join(known, names, "left_anti").select(docs.columns)


Work = Callable[[Finder, pa.RecordBatch], Iterator[pa.RecordBatch]]


def _block_by_block(rows: DataFrame, benchmark: DataFrame, error_rate: float, block_chars: int, work: Work, schema: str,
                    one: tuple[DataFrame, Work, T.StructType] | None = None) -> tuple[DataFrame, int]:
    """What ``work`` makes of the rows for all blocks together, and the number of blocks (2 for more).

    A single block is not written; for that case ``one`` may give other rows, work and schema.
    """
    spark = rows.sparkSession
    small_batches(spark)
    run, blocks = uuid.uuid4().hex, item_blocks(benchmark, error_rate, block_chars)
    first, second = next(blocks, None), next(blocks, None)

    def passed(table: DataFrame, number: int, block: Broadcast, job: Work, kind: str | T.StructType) -> DataFrame:
        def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder = _finder(f"{run}-{number}", block.value)
            for batch in batches:
                yield from job(finder, batch)

        return table.mapInArrow(search, kind)

    if first is None:
        return spark.createDataFrame([], schema), 0
    if second is None:
        table, job, kind = one or (rows, work, schema)
        return passed(table, 0, spark.sparkContext.broadcast(first), job, kind), 1
    path = shared_folder(spark, "leaks")
    for number, items in enumerate(chain([first, second], blocks)):
        block = spark.sparkContext.broadcast(items)
        passed(rows, number, block, work, schema).write.mode("append").parquet(path)
        block.destroy()
    return spark.read.schema(schema).parquet(path), 2


@query("op10_benchmark_leaks")
def op10_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

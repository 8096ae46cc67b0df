"""SentencePiece-style unigram encoding: Viterbi over a double-array trie of scored pieces."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.base import lists, pieces, query, segments, small_batches, table, utf8
from tablewright.llm.words import WordCache

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")

#: Added to the least score for a character that no piece stands for.
FALLBACK_PENALTY = -10.0
SPACE = 0x20


@dataclass(frozen=True)
class PieceModel:
    """Pieces by id as bytes (the space marker is a space), their log scores, and the trie.

    A child of node s by byte c is t = base[s] + c where check[t] == s; ``piece`` has the id of the
    piece that ends in a node, or -1. ``byte_id`` has the id of each byte's fallback piece.
    """

    flat: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    scores: np.ndarray
    fallback: float
    byte_id: np.ndarray
    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray


def build_trie(keys: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Double array of sorted distinct byte strings with their ids."""
    size = 1 << 16
    hint = 1  # nodes with several children are placed from here on; it moves on where room is scarce
    base, check, piece = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    check[0] = 0
    used, lowest = bytearray(size), 1
    used[0] = 1
    waiting = [(0, 0, len(keys), 0)]
    while waiting:
        node, begin, end, depth = waiting.pop()
        if len(keys[begin][0]) == depth:
            piece[node] = keys[begin][1]
            begin += 1
        children, i = [], begin
        while i < end:
            c, j = keys[i][0][depth], i
            while j < end and keys[j][0][depth] == c:
                j += 1
            children.append((c, i, j))
            i = j
        if not children:
            continue
        free = used.find(0, lowest)
        lowest = free if free >= 0 else size
        place, tries = (lowest if len(children) == 1 else max(lowest, hint)), 0
        while True:
            tries += 1
            offset = place - children[0][0]
            if offset >= 0:
                while offset + 256 >= size:
                    base, check, piece = (np.concatenate([a, np.full(size, v, np.int32)])
                                          for a, v in ((base, 0), (check, -1), (piece, -1)))
                    used += bytes(size)
                    size *= 2
                if not any(used[offset + c] for c, _, _ in children):
                    break
            place = used.find(0, place + 1)
            if place < 0:
                place = size
        if len(children) > 1 and tries > 30:
            hint = place
        base[node] = offset
        for c, i, j in children:
            used[offset + c] = 1
            check[offset + c] = node
            waiting.append((offset + c, i, j, depth + 1))
    return base, check, piece


@lru_cache(maxsize=4)
def load_pieces(path: str = PIECE_MODEL) -> PieceModel:
    """Pieces of a SentencePiece file, with log scores by Zipf's law of their rank in it.

    The file holds merge ranks instead of probabilities; the r-th piece gets log(1 / r / sum(1 / k)).
    """
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    n = library.get_piece_size()
    texts, byte_id, ranked = [b""] * n, np.full(256, -1, np.int64), []
    for i in range(n):
        name = library.id_to_piece(i)
        if library.is_byte(i):
            byte_id[int(name[3:5], 16)] = i
            texts[i] = bytes([int(name[3:5], 16)])
        elif not (library.is_control(i) or library.is_unknown(i) or library.is_unused(i)):
            texts[i] = name.replace("▁", " ").encode()
            ranked.append(i)
    if (byte_id < 0).any():
        raise ValueError("the model has no byte fallback")
    if any(b" " in texts[i].lstrip(b" ") or b"\n" in texts[i] for i in ranked):
        raise ValueError("a piece reaches over a word's end")
    scores = np.full(n, -np.inf)
    ranks = np.arange(1, len(ranked) + 1)
    scores[ranked] = np.log(1 / ranks / (1 / ranks).sum()).astype(np.float32)
    trie = build_trie(sorted((texts[i], i) for i in ranked))
    lengths = np.array([len(t) for t in texts], np.int64)
    return PieceModel(np.frombuffer(b"".join(texts), np.uint8), np.cumsum(lengths) - lengths, lengths, scores,
                      float(scores[ranked].min()) + FALLBACK_PENALTY, byte_id, *trie)


def viterbi(model: PieceModel, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the best segmentation of every word (flat), and how many each has; all words at once.

    Of equally good segmentations the one whose last differing piece is longer wins.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words), np.uint8)
    word_end = np.cumsum(lengths)
    word_of = np.repeat(np.arange(len(words)), lengths)
    limit = word_end[word_of]
    lead = (data & 0xC0) != 0x80
    # Walk the trie from every character at once; each piece met is an edge from its start to its end.
    start = np.flatnonzero(lead)
    at, node, edges = start, np.zeros(len(start), np.int64), []
    origin = start
    while len(at):
        child = model.base[node] + data[at]
        fits = model.check[child] == node
        origin, at, node = origin[fits], at[fits] + 1, child[fits].astype(np.int64)
        ends = model.piece[node] >= 0
        edges.append((origin[ends], at[ends], model.piece[node[ends]].astype(np.int64)))
        on = at < limit[origin]
        origin, at, node = origin[on], at[on], node[on]
    s, e, ids = (np.concatenate([x[k] for x in edges]) if edges else np.zeros(0, np.int64) for k in range(3))
    # A character without a piece of its own falls back to its bytes.
    next_lead = np.append(start[1:], len(data))[:len(start)]
    char_end = np.zeros(len(data) + 1, np.int64)
    char_end[start] = next_lead
    single = np.zeros(len(data), bool)
    single[s[char_end[s] == e]] = True
    alone = start[~single[start]]
    s, e = np.concatenate([s, alone]), np.concatenate([e, char_end[alone]])
    scores = np.concatenate([model.scores[ids], np.full(len(alone), model.fallback)])
    ids = np.concatenate([ids, np.full(len(alone), -1)])
    # Best score of every end, by distance from the word's start.
    step = e - (word_end - lengths)[word_of[s]]
    order = np.lexsort((s, e, step))
    s, e, ids, scores, step = (x[order] for x in (s, e, ids, scores, step))
    best = np.full(len(data) + 1, -np.inf)
    back = np.zeros(len(data) + 1, np.int64)
    first_of_step = np.flatnonzero(np.append(True, step[1:] != step[:-1])) if len(step) else np.zeros(0, np.int64)
    word_start = np.zeros(len(data) + 1, bool)
    word_start[word_end - lengths] = True
    for a, b in zip(first_of_step.tolist(), [*first_of_step[1:].tolist(), len(step)]):
        begin = s[a:b]
        gained = np.where(word_start[begin], 0.0, best[begin]) + scores[a:b]
        groups = np.flatnonzero(np.append(True, e[a + 1:b] != e[a:b - 1]))
        top = np.maximum.reduceat(gained, groups)
        sizes = np.diff(np.append(groups, b - a))
        hit = np.flatnonzero(gained == np.repeat(top, sizes))
        where, pick = np.unique(np.repeat(np.arange(len(groups)), sizes)[hit], return_index=True)
        ends = e[a:b][groups]
        back[ends] = a + hit[pick]
        # An end that is the next word's start keeps no score: that word begins at nought.
        best[ends] = top
    chosen, place = [], word_end[lengths > 0]
    while len(place):
        edge = back[place]
        chosen.append(edge)
        place = s[edge]
        place = place[~word_start[place]]
    used = np.sort(np.concatenate(chosen)) if chosen else np.zeros(0, np.int64)
    used = used[np.argsort(e[used], kind="stable")]
    is_byte = ids[used] < 0
    counts = np.where(is_byte, e[used] - s[used], 1)
    out = np.repeat(ids[used], counts)
    spread = np.repeat(s[used], counts) + segments(counts)
    wide = np.repeat(is_byte, counts)
    out[wide] = model.byte_id[data[spread[wide]]]
    return out.astype(np.int32), np.bincount(word_of[s[used]], counts, len(words)).astype(np.int64)


class PieceEncoder:
    """Encodes columns of texts word by word; each distinct word is segmented once."""

    def __init__(self, model: PieceModel) -> None:
        self._cache = WordCache(lambda words: viterbi(model, words))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = utf8(column)
        full = np.diff(offsets) > 0
        data = np.insert(data, offsets[:-1][full], SPACE)  # the marker before a text
        offsets = offsets + np.concatenate([[0], np.cumsum(full)])
        # No piece holds a line end, or a space after anything else: words begin there.
        begin = np.zeros(len(data) + 1, bool)
        space, line = data == SPACE, data == 10
        begin[:-1] = (space & ~np.append(False, space[:-1])) | line
        begin[1:] |= line
        begin[offsets] = True
        starts = np.flatnonzero(begin[:-1])
        ends = np.append(starts[1:], len(data))[:len(starts)]
        at, counts = self._cache.find(data, starts, ends)
        total = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, offsets)]
        return self._cache.gather(at, counts), np.diff(total)


_ENCODERS: dict[str, PieceEncoder] = {}


def _encoder(path: str, model: Broadcast) -> PieceEncoder:
    """The worker's encoder for a model."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(model.value)
    return _ENCODERS[path]


def _with_ids(batches: Iterable[pa.RecordBatch], encoder: PieceEncoder) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            flat, lengths = encoder.encode(piece.column("text"))
            ids = lists(flat, np.concatenate([[0], np.cumsum(lengths)]))
            yield pa.RecordBatch.from_arrays([*piece.columns, ids], [*piece.schema.names, "ids"])


def _texts(column: pa.Array, m: PieceModel) -> list[str | None]:
    """Decoded texts of lists of ids."""
    ids, counts = column.flatten(), np.asarray(pc.list_value_length(column).fill_null(0), np.int64)
    ids = np.asarray(ids.fill_null(-1) if ids.null_count else ids, np.int64)
    known = (ids >= 0) & (ids < len(m.lengths))
    ids = np.where(known, ids, 0)
    lengths = np.where(known, m.lengths[ids], 0)
    data = m.flat[np.repeat(m.starts[ids], lengths) + segments(lengths)].tobytes()
    total = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
    texts = [data[a + data.startswith(b" ", a, b):b].decode("utf-8", "replace") for a, b in zip(total[:-1], total[1:])]
    return [t if v else None for t, v in zip(texts, column.is_valid().to_pylist())]


def encode_pieces(docs: DataFrame, path: str = PIECE_MODEL) -> DataFrame:
    """The documents with ``ids``, the most likely pieces of the whole text.

    A space is put before the text, spaces are written as the marker, and the segmentation of
    greatest total log score is taken; characters without a piece become their UTF-8 bytes (so
    does the marker's own character, which keeps decoding exact). NULL and empty texts have no ids. All rows
    and columns stay, but for a column named ``ids``, which is replaced. A narrow pass; the model,
    of fixed size, is broadcast.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.drop("ids")
    model = spark.sparkContext.broadcast(load_pieces(path))

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _with_ids(batches, _encoder(path, model))

    return docs.mapInArrow(encode, T.StructType([*docs.schema, T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode_pieces(tokens: DataFrame, path: str = PIECE_MODEL, to: str = "decoded") -> DataFrame:
    """The rows with the text of their ``ids`` in column ``to``; without the space put before it.

    Control ids and ids out of range are left out; bytes that are no UTF-8 become U+FFFD; NULL ids give NULL.
    """
    spark = tokens.sparkSession
    small_batches(spark)
    tokens = tokens.drop(to)
    model = spark.sparkContext.broadcast(load_pieces(path))

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            decoded = pa.array(_texts(batch.column("ids"), model.value), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*batch.schema.names, to])

    return tokens.mapInArrow(decode, T.StructType([*tokens.schema, T.StructField(to, T.StringType())]))


def round_trip(docs: DataFrame, path: str = PIECE_MODEL) -> DataFrame:
    """Digests of every document's ids and of the text decoded from them, in one pass.

    doc_id, n_tokens, n_bytes (ids of bytes), ids_crc32 (of the ids as little-endian unsigned 32-bit
    integers), decoded_sha256, and whether the decoded text is the document's (NULL: empty).
    """
    spark = docs.sparkSession
    small_batches(spark)
    model = spark.sparkContext.broadcast(load_pieces(path))

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        is_byte = np.zeros(len(m.lengths), bool)
        is_byte[m.byte_id] = True
        for batch in _with_ids(batches, _encoder(path, model)):
            column = batch.column("ids")
            flat, offsets = column.values.to_numpy(), column.offsets.to_numpy()
            values = memoryview(np.ascontiguousarray(flat, "<u4")).cast("B")
            n_bytes = np.concatenate([[0], np.cumsum(is_byte[flat])])[offsets]
            texts = [t.encode() for t in _texts(column, m)]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "n_tokens": pa.array(np.diff(offsets).astype(np.int64)),
                "n_bytes": pa.array(np.diff(n_bytes)),
                "ids_crc32": pa.array([zlib.crc32(values[4 * a:4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], pa.int64()),
                "decoded_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                "exact": pa.array([(x or "").encode() == t for x, t in zip(batch.column("text").to_pylist(), texts)], pa.bool_())})

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        check, "doc_id long, n_tokens long, n_bytes long, ids_crc32 long, decoded_sha256 string, exact boolean")


@query("op4_piece_ids")
def op4_piece_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))

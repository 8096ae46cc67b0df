"""Language identification by n-gram Bloom filters sliced by language."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.base import mix, pieces, query, small_batches, table, utf8
from tablewright.llm.words import LETTER, char_classes, code_points

UNDETERMINED = "und"
#: Languages one filter tells apart: the bits of a slot.
MAX_LANGUAGES = 64
SIZES = (2, 3, 4)


def _letters() -> np.ndarray:
    """Lower-case letter of every code point, the space for anything else."""
    kinds = char_classes()
    table = np.full(len(kinds), 32, np.uint32)
    for code in np.flatnonzero(kinds == LETTER).tolist():
        low = chr(code).lower()
        table[code] = ord(low) if len(low) == 1 else code
    return table


_LETTERS: list[np.ndarray] = []


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the n-grams of all rows, each row's offset into them, and its number of letters.

    Letters are lower-cased, runs of anything else are one space, and a space stands before and
    after each text; n-grams of ``SIZES`` characters hold a letter and no inner space.
    """
    if not _LETTERS:
        _LETTERS.append(_letters())
    data, offsets = utf8(column)
    # A space at both ends of every text.
    data = np.insert(data, offsets[:-1], 32)
    offsets = offsets + np.arange(len(offsets))
    data = np.append(data, np.uint8(32))
    codes, at = code_points(data)
    chars = _LETTERS[0][codes]
    space = chars == 32
    first = np.searchsorted(at, offsets)
    letters = np.concatenate([[0], np.cumsum(~space)])[first]
    keep = np.ones(len(chars), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    keep[first[:-1]] = True
    chars, row_of_first = chars[keep], np.concatenate([[0], np.cumsum(keep)])[first]
    space = chars == 32
    wide = chars.astype(np.uint64)
    found, places = [], []
    for n in SIZES:
        m = len(chars) - n + 1
        if m <= 0:
            continue
        inner = np.zeros(m, bool)
        for k in range(1, n - 1):
            inner |= space[k:k + m]
        take = np.flatnonzero(~inner & ~(space[:m] & space[n - 1:n - 1 + m]))
        h = np.full(len(take), n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + wide[take + k]
        found.append(mix(h))
        # An n-gram over the border of two texts ends with the next one's first space: it is the earlier text's.
        places.append(take)
    if not found:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), np.diff(letters)
    place, h = np.concatenate(places), np.concatenate(found)
    order = np.argsort(place, kind="stable")
    return h[order], np.searchsorted(place[order], row_of_first), np.diff(letters)


@dataclass(frozen=True)
class LanguageModel:
    """Slots of a Bloom filter whose bits are languages: a look-up answers for all at once."""

    languages: tuple[str, ...]
    slots: np.ndarray
    hashes: int
    false_rate: np.ndarray

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """Bit mask of the languages that hold each n-gram (with false positives)."""
        place, step = grams, (grams >> np.uint64(32)) | np.uint64(1)
        out = None
        for _ in range(self.hashes):
            got = self.slots[(place & np.uint64(len(self.slots) - 1)).astype(np.int64)]
            out = got if out is None else out & got
            place = place + step
        return out

    def shares(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Share of each row's n-grams that each language holds, corrected for false positives; letters."""
        found, offsets, letters = grams(column)
        mask = self.masks(found)
        total = np.maximum(np.diff(offsets), 1)
        shares = np.zeros((len(total), len(self.languages)))
        for k in range(len(self.languages)):
            hits = np.concatenate([[0], np.cumsum((mask >> np.uint64(k)) & np.uint64(1))]).astype(np.int64)
            rate = self.false_rate[k]
            observed = (hits[offsets[1:]] - hits[offsets[:-1]]) / total
            shares[:, k] = np.clip((observed - rate) / (1 - rate), 0, 1)
        return shares, letters


def train(labelled: DataFrame, sample_rows: int = 4_000, per_language: int = 6_000, hashes: int = 3,
          slots: int = 1 << 20) -> LanguageModel:
    """Learn the ``per_language`` most frequent n-grams of every non-NULL ``lang`` of (doc_id, text, lang).

    About ``sample_rows`` documents of each language are read, drawn by a hash of doc_id, so the
    sample does not depend on partitions; smaller languages are read whole. Frequencies are counted
    where the texts are; per_language rows of each language come to the driver, which sets their
    bits. The filter has ``slots`` words (8 MB), whatever the input.
    """
    spark = labelled.sparkSession
    small_batches(spark)
    labelled = labelled.select(F.col("doc_id"), F.col("text").cast("string"), F.col("lang").cast("string")).where("lang IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang")
             .limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    names = sorted(sizes, key=lambda name: (-sizes[name], name))
    if not names:
        return LanguageModel((), np.zeros(slots, np.uint64), hashes, np.zeros(0))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    chosen = F.lit(False)
    for name in names:
        chosen = chosen | ((F.col("lang") == name) & (draw < int(np.ceil(min(1.0, sample_rows / sizes[name]) * (1 << 20)))))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                found, offsets, _ = grams(piece.column("text"))
                languages = np.array(piece.column("lang").to_pylist())
                for name in np.unique(languages).tolist():
                    rows = np.repeat(languages == name, np.diff(offsets))
                    unique, n = np.unique(found[rows], return_counts=True)
                    yield pa.record_batch({"lang": pa.array([name] * len(unique), pa.string()),
                                           "gram": pa.array(unique.view(np.int64)), "n": pa.array(n.astype(np.int64))})

    counts = (labelled.where(chosen).select("text", "lang").mapInArrow(count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("place", place).where(F.col("place") <= per_language).select("lang", "gram").collect()
    return build(names, top, hashes, slots)


def build(names: list[str], top: Iterable[tuple[str, int]], hashes: int, slots: int) -> LanguageModel:
    bits = np.zeros(slots, np.uint64)
    by_name: dict[str, list[int]] = {n: [] for n in names}
    for lang, gram in top:
        by_name[lang].append(gram)
    false_rate = np.zeros(len(names))
    for k, name in enumerate(names):
        found = np.array(by_name[name], np.int64).view(np.uint64)
        place, step = found, (found >> np.uint64(32)) | np.uint64(1)
        for _ in range(hashes):
            at = (place & np.uint64(slots - 1)).astype(np.int64)
            bits[at] |= np.uint64(1) << np.uint64(k)
            place = place + step
        false_rate[k] = (((bits >> np.uint64(k)) & np.uint64(1)).mean()) ** hashes
    return LanguageModel(tuple(names), bits, hashes, false_rate)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The documents with ``lang_pred`` and ``score``, from the whole text alone.

    The language that holds the greatest share of the text's n-grams is taken (of equal
    ones that with more training rows), and that share is the score. "und" with score 0 where the text is NULL, has no letter, or nothing was
    learned. Rows and columns stay; columns of the two names are replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.drop("lang_pred", "score")
    shared = spark.sparkContext.broadcast(model)  # of fixed size

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.languages, UNDETERMINED], dtype=object)
        for batch in batches:
            for piece in pieces(batch):
                shares, letters = m.shares(piece.column("text"))
                known = (letters > 0) & bool(m.languages)
                best = shares.argmax(axis=1) if m.languages else np.zeros(len(letters), np.int64)
                score = np.where(known, shares[np.arange(len(best)), best] if m.languages else 0.0, 0.0)
                picked = names[np.where(known, best, len(names) - 1)]
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, pa.array(picked.tolist(), pa.string()), pa.array(score)],
                    [*piece.schema.names, "lang_pred", "score"])

    schema = T.StructType([*docs.schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(predict, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its id's text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


@query("op5_language")
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()).select("doc_id", "text", "lang"))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")

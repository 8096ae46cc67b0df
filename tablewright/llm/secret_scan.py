"""Secrets in texts: fixed patterns, and character Markov models of random and ordinary strings."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.base import query, small_batches, table

KINDS = ("assign", "access", "hex", "markov")

# Fixed patterns; "either case" is meant for ASCII letters only.
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
# What a text must hold for a pattern to match at all, tested over a whole column at once.
MAY_ASSIGN = r"""(?i)(passw(or)?d|secret|token|api_?key)["']? *[:=]"""
MAY_HEX = "[0-9a-f]{32}"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = re.compile(r"[A-Za-z0-9+/_=-]+")
CODE = np.full(128, len(ALPHABET), np.int64)
CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
SIZE = len(ALPHABET)

SPANS = "array<struct<start: long, end: long, kind: string, score: double>>"


def base_spans(text: str, assign: bool = True, access: bool = True, hexes: bool = True) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the pattern matches, in that order."""
    found = []
    if assign:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGN_LEAST]
    if access:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    if hexes:
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


@lru_cache(maxsize=8)
def _runs(least: int) -> re.Pattern:
    return re.compile(f"[A-Za-z0-9+/_=-]{{{least},}}")


def _outside(text: str, spans: list[tuple[int, int, int]], least: int) -> Iterator[re.Match]:
    """Runs of at least ``least`` characters that touch no span."""
    taken = sorted((a, b) for a, _, b in spans)
    at = 0
    for m in _runs(least).finditer(text):
        # The first span that ends after the run's start decides: later ones begin no earlier.
        while at < len(taken) and taken[at][1] <= m.start():
            at += 1
        if at == len(taken) or taken[at][0] >= m.end():
            yield m


def _bigrams(run: str) -> np.ndarray:
    codes = CODE[np.frombuffer(run.encode("ascii"), np.uint8)]
    return codes[:-1] * SIZE + codes[1:]


@dataclass(frozen=True)
class MarkovModel:
    """Log-likelihood ratio of each character pair, random over ordinary."""

    ratio: np.ndarray
    least: int = 12
    threshold: float = 0.5

    def score(self, run: str) -> float:
        """Mean log-likelihood ratio of a run's transitions."""
        return float(self.ratio[_bigrams(run)].mean())

    def score_value(self, value: str) -> float | None:
        """The same over all runs of a pattern match's value; None if no two of its characters are in the alphabet."""
        pairs = [_bigrams(run) for run in RUN.findall(value) if len(run) > 1]
        return float(self.ratio[np.concatenate(pairs)].mean()) if pairs else None


def train(docs: DataFrame, sample_rows: int = 20_000, least: int = 12, threshold: float = 0.5,
          uniform: float = 0.5) -> MarkovModel:
    """Fit both models on labelled strings of about ``sample_rows`` documents.

    Strings inside pattern matches are labelled random, all other runs of 4 or more characters
    ordinary. The sample is drawn by a hash of doc_id, so it does not depend on partitions. The random
    model is mixed with ``uniform`` parts of a uniform one: patterns show few alphabets. Only the
    pair counts (at most two per cell of the alphabet's square) come to the driver. Without any
    labelled string of a kind its model is uniform.
    """
    small_batches(docs.sparkSession)
    share = min(1.0, sample_rows / max(1, docs.count()))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, SIZE * SIZE), np.int64)
        for batch in batches:
            runs: tuple[list[str], list[str]] = ([], [])
            for text in batch.column("text").to_pylist():
                for label, run in _strings(text, base_spans(text)):
                    runs[label].append(run)
            for label, found in enumerate(runs):
                # The strings in one, with a character outside the alphabet between them.
                codes = CODE[np.frombuffer("\n".join(found).encode("ascii"), np.uint8)]
                inside = (codes[:-1] < SIZE) & (codes[1:] < SIZE)
                counts[label] += np.bincount((codes[:-1] * SIZE + codes[1:])[inside], minlength=SIZE * SIZE)
        label, pair = np.nonzero(counts)
        yield pa.record_batch({"label": pa.array(label), "pair": pa.array(pair), "n": pa.array(counts[label, pair])})

    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(np.ceil(share * (1 << 20))))
    sample = sample.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counts = np.zeros((2, SIZE, SIZE))
    for row in (sample.mapInArrow(count, "label long, pair long, n long")
                .groupBy("label", "pair").agg(F.sum("n").alias("n")).collect()):
        counts[row["label"], row["pair"] // SIZE, row["pair"] % SIZE] = row["n"]
    ordinary, random = ((counts[k] + 1) / (counts[k] + 1).sum(axis=1, keepdims=True) for k in (0, 1))
    random = (1 - uniform) * random + uniform / SIZE
    return MarkovModel(np.log(random / ordinary).ravel(), least, threshold)


def _value(text: str, start: int, kind: int, end: int) -> str:
    """The secret itself in a pattern match: without the name it is assigned to."""
    return ASSIGN.match(text[start:end])[1] if kind == 0 else text[start:end]


def _strings(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, str]]:
    """Labelled strings of a text: 1 for random, 0 for ordinary."""
    for a, kind, b in spans:
        for run in RUN.findall(_value(text, a, kind, b)):
            if len(run) > 1:
                yield 1, run
    for m in _outside(text, spans, 4):
        yield 0, m[0]


def _found(column: pa.Array, model: MarkovModel | None) -> Iterator[tuple[str, list[tuple[int, int, int, float | None]]]]:
    """Text and (start, kind number, end, score) of all its spans, row by row."""
    if column.null_count:
        column = column.fill_null("")
    tests = [pc.match_substring_regex(column, MAY_ASSIGN), pc.match_substring(column, "AKIA"),
             pc.match_substring_regex(column, MAY_HEX)]
    if model is not None:
        tests.append(pc.match_substring_regex(column, f"[A-Za-z0-9+/_=-]{{{model.least}}}"))
    tests = [t.to_pylist() for t in tests]
    for text, *may in zip(column.to_pylist(), *tests):
        if not any(may):
            yield text, []
            continue
        spans = base_spans(text, *may[:3])
        found = [(a, k, b, model.score_value(_value(text, a, k, b)) if model is not None else None) for a, k, b in spans]
        if model is not None and may[3]:
            for m in _outside(text, spans, model.least):
                score = model.score(m[0])
                if score > model.threshold:
                    found.append((m.start(), 3, m.end(), score))
            found.sort(key=lambda s: s[:2])
        yield text, found


def find_secrets(docs: DataFrame, model: MarkovModel | None) -> DataFrame:
    """Each document's doc_id and its ``spans`` (start, end in code points; kind; score of the model).

    Pattern matches come first in importance: model spans never touch them and never replace
    them. Every span has its score: that of the pattern matches tells how random their values look and
    decides nothing. Spans are ordered by start, then by kind as in ``KINDS``. A NULL text is empty, rows
    repeat as they are, NULL doc_ids stay, other columns are ignored, an empty table gives no rows. One
    narrow pass, linear in a text's length and number of spans.
    """
    small_batches(docs.sparkSession)
    kinds = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("score", pa.float64())]))

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"start": a, "end": b, "kind": KINDS[k], "score": s} for a, k, b, s in found]
                     for _, found in _found(batch.column("text"), model)]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "spans": pa.array(spans, kinds)})

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(scan, f"doc_id long, spans {SPANS}")


def mask_secrets(docs: DataFrame, model: MarkovModel | None, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span (overlapping ones together) replaced by ``mark``.

    Keeps all rows and columns; a column ``n_chars``, where there is one, counts the new text.
    NULL texts stay NULL.
    """
    small_batches(docs.sparkSession)
    schema, names = docs.schema, docs.columns

    def mask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, texts = batch.column("text"), []
            for text, found in _found(column, model):
                parts, at = [], 0
                for a, _, b, _ in found:
                    if a >= at:
                        parts += [text[at:a], mark]
                    at = max(at, b)
                texts.append("".join([*parts, text[at:]]) if found else text)
            masked = pc.if_else(column.is_valid(), pa.array(texts, column.type), pa.scalar(None, column.type))
            yield pa.RecordBatch.from_arrays([masked if n == "text" else batch.column(n) for n in names], names)

    masked = docs.mapInArrow(mask, schema)
    if "n_chars" in names:
        masked = masked.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType))
    return masked.select(names)


def joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


@query("op6_secret_scan")
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_secrets(docs, train(docs))

    def n(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", n("assign"), n("access"), n("hex"), n("markov"),
        F.sha2(joined(F.filter("spans", lambda s: s["kind"] != "markov")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))

"""Periodic runs of words: segments split at words too rare to repeat in them, then scanned lag by lag."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.base import mix, pieces, query, segments, small_batches, table

#: A run has at least so many words, and its period at least so many times.
LEAST_WORDS = 24
LEAST_COPIES = 3
#: Rounds in which all segments of a batch are split together; what is then unsettled is split one by one.
JOINT_ROUNDS = 12
#: An odd base of the block hashes, which only propose neighbours that are compared word by word.
BASE = 0x9E3779B97F4A7C15


def _settle(ids: np.ndarray, begin: int, end: int, least: int, copies: int) -> Iterator[tuple[int, int]]:
    """Split one segment until no word in a part is rare in it.

    The longest part goes on with its parent's counts less those of what was cut off; only shorter
    parts are counted anew, so a text is never counted more than a logarithmic number of times.
    """
    fresh = [(begin, end)]
    while fresh:
        low, high = fresh.pop()
        words, local, counts = np.unique(ids[low:high], return_inverse=True, return_counts=True)
        order = np.argsort(local, kind="stable") + low
        first = np.concatenate([[0], np.cumsum(counts)])
        base, cuts = low, np.flatnonzero(counts[local] < copies) + low
        while len(cuts):
            edges = np.concatenate([[low - 1], cuts, [high]])
            longest = int(np.argmax(np.diff(edges)))
            parts = list(zip((edges[:-1] + 1).tolist(), edges[1:].tolist()))
            kept = parts.pop(longest)
            fresh += [p for p in parts if p[1] - p[0] >= least]
            gone = np.concatenate([local[low - base:kept[0] - base], local[kept[1] - base:high - base]])
            lost, n = np.unique(gone, return_counts=True)
            counts[lost] -= n
            low, high = kept
            if high - low < least:
                break
            rare = lost[(counts[lost] > 0) & (counts[lost] < copies)]
            found = [order[first[w]:first[w + 1]] for w in rare.tolist()]
            cuts = np.sort(np.concatenate([f[(f >= low) & (f < high)] for f in found])) if found else np.zeros(0, np.int64)
        if high - low >= least:
            yield low, high


def surviving_segments(ids: np.ndarray, rows: np.ndarray, least: int = LEAST_WORDS, copies: int = LEAST_COPIES,
                       rounds: int = JOINT_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the segments of all rows in which every word occurs ``copies`` times or more.

    ``ids`` are the words of all rows, ``rows`` their offsets. A run holds each of its words at least
    ``copies`` times, so a word that is rarer within a segment is in no run there and splits it; the
    parts are counted again until nothing changes. Parts under ``least`` words go. No run is cut.
    """
    lengths = np.diff(rows)
    at = np.arange(len(ids))
    part = np.repeat(np.arange(len(lengths)), lengths)
    done: list[np.ndarray] = []
    for _ in range(rounds):
        # Parts of consecutive words; short ones go.
        head = np.ones(len(at), bool)
        head[1:] = (np.diff(at) != 1) | (part[1:] != part[:-1])
        starts = np.flatnonzero(head)
        lengths = np.diff(np.append(starts, len(at)))
        long = lengths >= least
        at = at[np.repeat(long, lengths)]
        lengths = lengths[long]
        if not len(at):
            break
        part = np.repeat(np.arange(len(lengths)), lengths)
        _, back, counts = np.unique(part * (int(ids.max()) + 1) + ids[at], return_inverse=True, return_counts=True)
        rare = counts[back] < copies
        open_parts = np.bincount(part[rare], minlength=len(lengths)) > 0
        firsts = at[np.cumsum(lengths) - lengths]
        done.append(np.stack([firsts, firsts + lengths])[:, ~open_parts])
        keep = open_parts[part] & ~rare
        at, part = at[keep], part[keep]
    if len(at):
        head = np.ones(len(at), bool)
        head[1:] = (np.diff(at) != 1) | (part[1:] != part[:-1])
        starts = np.flatnonzero(head)
        ends = at[np.append(starts[1:], len(at)) - 1] + 1
        rest = [s for a, b in zip(at[starts].tolist(), ends.tolist()) if b - a >= least for s in _settle(ids, a, b, least, copies)]
        done.append(np.array(rest, np.int64).reshape(-1, 2).T)
    both = np.concatenate(done, axis=1) if done else np.zeros((2, 0), np.int64)
    return both[0], both[1]


def _reach(ids: np.ndarray, at: int, stop: int, lag: int, step: int) -> int:
    """From ``at`` on by ``step`` to ``stop``: the first place whose word differs from the one ``lag`` before."""
    width = 32
    while at != stop:
        to = min(stop, at + width) if step > 0 else max(stop, at - width)
        low, high = (at, to) if step > 0 else (to, at)
        wrong = np.flatnonzero(ids[low:high] != ids[low - lag:high - lag])
        if len(wrong):
            return low + int(wrong[0]) if step > 0 else low + int(wrong[-1]) + 1
        at, width = to, width * 2
    return at


def scan_lags(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, copies: int = LEAST_COPIES) -> list[tuple[int, int, int]]:
    """(start, end, period) of all stretches in the segments that repeat their smallest period ``copies`` (2 or more) times.

    At lag q a segment is cut into blocks of q words from its start: a stretch of 3 q words holds two whole
    neighbouring blocks, which are equal. That are segment / q comparisons a lag, of hashes from running
    sums; equal neighbours are compared word by word and extended. Lags rise by powers of two: within one
    power no lag is a multiple of another, and blocks inside a stretch of a smaller period belong to it.
    """
    copies = max(copies, LEAST_COPIES)
    lengths = ends - starts
    if not len(lengths):
        return []
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    power = np.full(len(ids) + 1, BASE, np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(ids.astype(np.uint64) + np.uint64(1)) * power[:-1])])
    found: list[tuple[int, int, int]] = []
    low, most = 1, int(lengths[0]) // copies
    while low <= most:
        lags = np.arange(low, min(2 * low, most + 1))
        # Longest segments first: each lag is for the first so many of them.
        per_lag = np.searchsorted(-lengths, -copies * lags, side="right")
        lag, seg = np.repeat(lags, per_lag), segments(per_lag)
        pairs = lengths[seg] // lag - 1
        at = np.repeat(starts[seg], pairs) + segments(pairs) * np.repeat(lag, pairs)
        seg, lag = np.repeat(seg, pairs), np.repeat(lag, pairs)
        equal = (total[at + lag] - total[at]) * power[lag] == total[at + 2 * lag] - total[at + lag]
        at, seg, lag = at[equal], seg[equal], lag[equal]
        # One pair of each row of equal neighbours at one lag.
        new = np.ones(len(at), bool)
        new[1:] = (lag[1:] != lag[:-1]) | (seg[1:] != seg[:-1]) | (at[1:] != at[:-1] + lag[1:])
        at, seg, lag = at[new], seg[new], lag[new]
        if found and len(at):
            known = np.array(sorted(found))
            reach = np.concatenate([[-1], np.maximum.accumulate(known[:, 1])])
            inside = reach[np.searchsorted(known[:, 0], at, side="right")] >= at + 2 * lag
            at, seg, lag = at[~inside], seg[~inside], lag[~inside]
        reached: dict[tuple[int, int], int] = {}
        for p, s, q in zip(at.tolist(), seg.tolist(), lag.tolist()):
            if reached.get((s, q), -1) >= p + 2 * q or not np.array_equal(ids[p:p + q], ids[p + q:p + 2 * q]):
                continue
            begin, end = int(starts[s]), int(starts[s] + lengths[s])
            right = _reach(ids, p + 2 * q, end, q, 1)
            left = _reach(ids, p + q, begin + q, q, -1) - q
            reached[s, q] = right
            if right - left >= copies * q:
                found.append((left, right, q))
        low *= 2
    return found


def runs_of(ids: np.ndarray, rows: np.ndarray, least: int = LEAST_WORDS, copies: int = LEAST_COPIES) -> np.ndarray:
    """(row, start, length, period) of all runs, by row, start and period; starts count from the row's first word."""
    found = scan_lags(ids, *surviving_segments(ids, rows, least, copies), copies)
    found = np.array([f for f in found if f[1] - f[0] >= least], np.int64).reshape(-1, 3)
    row = np.searchsorted(rows, found[:, 0], side="right") - 1
    runs = np.stack([row, found[:, 0] - rows[row], found[:, 1] - found[:, 0], found[:, 2]], axis=1)
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def collapse_runs(docs: DataFrame, least: int = LEAST_WORDS, copies: int = LEAST_COPIES) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_words, runs array<struct<start, length, period>>, collapsed.

    Words are maximal runs of characters other than space and 0x09-0x0D, as they are written. A run is a
    stretch of words with smallest period q, of at least ``least`` words and ``copies`` (3 or more) times q,
    that cannot be extended with that period; runs are listed by start, then period. ``collapsed`` has the
    words that no run holds after its first period, joined by one space.

    NULL and empty texts have no words, no runs and an empty ``collapsed``. Rows are judged one by one:
    repeated rows, NULL doc_ids and ties need no rule; other columns are ignored; an empty table gives no
    row. A narrow pass: nothing is shuffled, and a task holds the words of one batch or one longer text.
    A text of n words costs n log n comparisons, also one that repeats throughout.
    """
    if copies < LEAST_COPIES:
        raise ValueError(f"a run has at least {LEAST_COPIES} copies of its period")
    small_batches(docs.sparkSession)
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", run_type), ("collapsed", pa.large_string())])

    def collapse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                texts = [(t or b"").split() for t in piece.column("text").cast(pa.large_binary()).to_pylist()]
                number: dict[bytes, int] = {}
                ids = np.array([number.setdefault(w, len(number)) for words in texts for w in words], np.int64)
                counts = np.fromiter(map(len, texts), np.int64, len(texts))
                rows = np.concatenate([[0], np.cumsum(counts)])
                runs = runs_of(ids, rows, least, copies)
                bounds = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1))
                for i in np.unique(runs[:, 0]).tolist():
                    keep = np.ones(counts[i], bool)
                    for start, length, period in runs[bounds[i]:bounds[i + 1], 1:].tolist():
                        keep[start + period:start + length] = False
                    texts[i] = [texts[i][k] for k in np.flatnonzero(keep).tolist()]
                listed = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in (1, 2, 3)], fields=list(run_type.value_type))
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id"), pa.array(counts), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), listed),
                    pa.array([b" ".join(words).decode() for words in texts], pa.large_string())], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        collapse, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def repeat_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with a periodic tail in a tenth of the documents, chosen and shaped by crc32(doc_id).

    With h that checksum, g = h div 10 and n the number of words, documents with h mod 10 = 0 and a word have
    word a + (i - a) mod p in each place i >= a, where a = g mod n and p = 1 + (n - a) div (3 + g mod 8).
    Their words are then joined by one space. Other texts, and those of NULL doc_ids, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def tail(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % F.greatest(n, F.lit(1))
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = F.transform(F.array(F.struct(a.alias("a"), p.alias("p"))), lambda at: F.transform(
            F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(
                words, F.when(i < at["a"], i).otherwise(at["a"] + (i - at["a"]) % at["p"]).cast("int"))))
        return F.when(n > 0, F.array_join(F.element_at(place, 1), " ")).otherwise("")

    # Bound once by a one-element array: lambdas would otherwise find the words anew for every place.
    found = F.transform(F.array(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))), tail)
    return docs.select("doc_id", F.when(h % 10 == 0, F.element_at(found, 1)).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse_runs(repeat_tails(table(spark, sf_dir, "documents").select("doc_id", "text")))

    def sooner(x: Column, y: Column) -> Column:
        """Greater length / period first, compared as whole numbers; then the runs' own order."""
        a, b = x["length"] * y["period"], y["length"] * x["period"]
        return F.when(a > b, -1).when(a < b, 1).when(x["start"] < y["start"], -1).when(x["start"] > y["start"], 1).otherwise(
            F.when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0))

    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    best = found.withColumn("best", F.get(F.array_sort("runs", sooner), F.lit(0)))
    return best.select("doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col(f"best.{c}") for c in ("start", "length", "period")],
                       F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
                       F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))

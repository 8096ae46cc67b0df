import hashlib
import random
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tablewright.llm.periodic_runs import collapse_runs, op11_periodic_runs, repeat_tails, runs_of, scan_lags, surviving_segments


def brute_runs(words, least=24, copies=3):
    """All (start, length, period), found lag by lag over the whole sequence."""
    n, found = len(words), []
    for q in range(1, n // copies + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            stretch = words[i:i + length]
            smallest = next(p for p in range(1, length + 1) if all(stretch[k] == stretch[k + p] for k in range(length - p)))
            if smallest == q and length >= max(least, copies * q):
                found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def random_words(rnd):
    """Words with planted repeats, some nested, some next to each other."""
    words, k = [], rnd.choice([1, 2, 3, 30])
    for _ in range(rnd.randint(0, 6)):
        block = [rnd.randint(0, k) for _ in range(rnd.randint(1, 14))]
        if rnd.random() < 0.3:
            block = block * rnd.randint(2, 6) + [rnd.randint(0, k)]
        words += block * rnd.choice([1, 1, 2, 3, 4, 7]) + block[:rnd.randint(0, len(block))]
        words += [rnd.randint(0, 60) for _ in range(rnd.choice([0, 1, 20]))]
    return words


def test_runs_equal_brute_force():
    rnd = random.Random(11)
    texts = [random_words(rnd) for _ in range(500)] + [[], [1], [1] * 24, [1] * 23, [1, 2] * 12, [1, 2] * 11, [0, 1] * 40 + [0, 2] * 40]
    rows = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    ids = np.array([w for t in texts for w in t], np.int64)
    for least, copies in ((24, 3), (6, 3), (10, 4)):
        want = [(i, *r) for i, t in enumerate(texts) for r in brute_runs(t, least, copies)]
        assert [tuple(r) for r in runs_of(ids, rows, least, copies).tolist()] == want and len(want) > 60


def test_splitting_ends_the_same_way_whatever_the_rounds():
    rnd = random.Random(12)
    for _ in range(60):
        words = [rnd.randint(0, rnd.choice([3, 10, 60])) for _ in range(rnd.randint(0, 400))]
        ids, rows = np.array(words, np.int64), np.array([0, len(words)])
        want = None
        for rounds in (40, 3, 1, 0):
            got = sorted(zip(*[x.tolist() for x in surviving_segments(ids, rows, 6, 3, rounds)]))
            assert want is None or got == want
            want = got
        for a, b in want:
            assert b - a >= 6 and np.unique(ids[a:b], return_counts=True)[1].min() >= 3


def test_long_texts_take_little_more_than_linear_time():
    rnd = np.random.default_rng(1)
    n = 300_000
    peeled = np.repeat(np.arange(n // 3), 3)
    rnd.shuffle(peeled)
    for ids, least_runs in ((np.zeros(n, np.int64), 1), (np.arange(n) % (n // 4), 1), (np.tile(np.arange(50), n // 50), 1), (peeled, 0),
                            (rnd.integers(0, 40, n), 0), (np.concatenate([np.repeat(np.arange(n // 60), 30), np.zeros(n // 2, np.int64)]), 1)):
        began = time.perf_counter()
        assert len(runs_of(ids, np.array([0, len(ids)]))) >= least_runs
        assert time.perf_counter() - began < 20


def test_lag_scan_alone_finds_them_too():
    ids = np.array([9, 8] + [1, 2, 3] * 10 + [1, 7], np.int64)
    assert scan_lags(ids, np.array([0]), np.array([len(ids)])) == [(2, 33, 3)]


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def expected(doc_id, text):
    words = planted(doc_id, text)
    runs = brute_runs(words)
    keep = [True] * len(words)
    for start, length, period in runs:
        keep[start + period:start + length] = [False] * (length - period)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    digest = [hashlib.sha256(x.encode()).hexdigest() for x in (
        "".join(f"{s},{n},{p}\n" for s, n, p in runs), " ".join(w for w, k in zip(words, keep) if k))]
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *digest)


def test_query_equals_brute_force(spark, small_docs, tmp_path):
    rnd = random.Random(2)
    rows = [(r["doc_id"], " ".join((r["text"] or "").split(" ")[:400])) for r in small_docs.collect()]
    rows += [(10_000 + k, " ".join(f"w{w}" for w in random_words(rnd))) for k in range(300)]
    rows += [(1, None), (1, ""), (None, "x " * 30), (2, "\x0b x\ty\r\nx\x0cy" * 20), (2, "\x0b x\ty\r\nx\x0cy" * 20), (3, " a " * 40),
             (None, None), (39, " \n"), (4, "é ü " * 50), (5, "A a " * 50)]
    extra = ("runs", "n_words", "collapsed", "h", "best")
    frame = spark.createDataFrame([(*r, *extra) for r in rows], "doc_id long, text string, " + ", ".join(f"{c} string" for c in extra))
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    found = op11_periodic_runs(spark, str(tmp_path)).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert sorted([tuple(r) for r in found.collect()], key=str) == sorted([expected(*r) for r in rows], key=str)
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 and r[1] for r in rows)
    plant = {(r["doc_id"], r["text"]) for r in repeat_tails(frame.where("doc_id >= 10000")).collect()}
    assert {(i, tuple((t or "").split())) for i, t in plant} == {(i, tuple(planted(i, t))) for i, t in rows if i and i >= 10_000}


def test_odd_documents_and_other_sizes(spark, odd_docs, no_docs):
    assert collapse_runs(no_docs).count() == 0
    got = collapse_runs(odd_docs).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r["doc_id"]) for r in odd_docs.collect())
    shorter = spark.createDataFrame([(1, "a b " * 4 + "c")], "doc_id int, text string")
    row = collapse_runs(shorter, least=6).collect()[0]
    assert [tuple(r) for r in row["runs"]] == [(0, 8, 2)] and row["collapsed"] == "a b c" and row["n_words"] == 9
    with pytest.raises(ValueError):
        collapse_runs(shorter, copies=2)

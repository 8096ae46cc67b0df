import hashlib
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablewright.llm import exact_dedup
from tablewright.llm.exact_dedup import drop_copies, find_copies, may_repeat, repeated_bits


def brute(rows):
    """Verdicts of (doc_id, text) rows as a sorted list."""
    groups = {}
    for doc_id, text in rows:
        text = text or ""
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text), []).append((-len(text), doc_id is None, doc_id or 0, doc_id))
    found = []
    for plain, members in groups.items():
        members.sort(key=lambda m: m[:3])
        for k, m in enumerate(members):
            found.append((m[3], members[0][3], len(members), k == 0, hashlib.sha256(plain.encode()).hexdigest()))
    return sorted(found, key=str)


def listed(frame):
    return sorted([tuple(r) for r in frame.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()], key=str)


@pytest.mark.parametrize("slice_rows", [1 << 26, 50])
def test_verdicts_equal_plain_grouping(spark, slice_rows):
    rnd = random.Random(3)
    words = ["a", "b", "c d", "é", "日本", "\U0001f600"]
    rows = [(k, " \n"[k % 2].join(rnd.choice(words) for _ in range(rnd.randint(0, 5)))) for k in range(400)]
    rows += [(1000 + k, "the copies" + " " * (k % 7)) for k in range(300)] + [(5, None), (6, ""), (6, "\x0b\x0c\r"), (7, "x y"), (7, "x y"),
             (None, "x y"), (None, None), (8, "z" * 200_000), (9, "z " * 200_000)]
    frame = spark.createDataFrame([(*r, 1, "s", "b") for r in rows], "doc_id long, text string, h long, slice string, block string")
    assert listed(find_copies(frame.repartition(5), slice_rows)) == brute(rows)


def test_odd_documents_and_empty_table(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert listed(find_copies(odd_docs)) == brute(rows)
    assert find_copies(no_docs).count() == 0
    assert drop_copies(no_docs).columns == no_docs.columns and drop_copies(no_docs).count() == 0


def test_dropping_keeps_one_row_with_all_columns(spark, odd_docs, small_docs):
    for docs in (odd_docs, small_docs):
        want = sorted(str(v[0]) for v in brute([(r["doc_id"], r["text"]) for r in docs.collect()]) if v[3])
        for rows in (None, 1):
            kept = drop_copies(docs, rows)
            assert kept.columns == docs.columns
            assert sorted(str(r["doc_id"]) for r in kept.collect()) == want


def test_filter_misses_no_repeated_hash_and_clears_most_others(spark):
    n = 20_000
    hashes = spark.range(n).select(F.xxhash64(F.col("id") % (n - 500)).alias("h"))
    blocks = exact_dedup._blocks(n)
    bits = repeated_bits(hashes, blocks)
    assert bits.count() <= blocks
    found = may_repeat(hashes.withColumn("twice", F.count("*").over(Window.partitionBy("h")) > 1), bits, blocks)
    counts = {(r["twice"], r["possible"]): r["count"] for r in found.groupBy("twice", "possible").count().collect()}
    assert (True, False) not in counts and counts[True, True] == 1000
    assert counts.get((False, True), 0) < 0.05 * n


def test_rows_that_the_filter_clears_are_not_shuffled(spark, small_docs):
    plan = drop_copies(small_docs, rows=200)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    physical = drop_copies(small_docs, rows=200)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in physical and "SortMergeJoin" not in physical

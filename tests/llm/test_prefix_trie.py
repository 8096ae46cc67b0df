import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tablewright.llm.prefix_trie import RangeMinima, common_prefixes, op12_prefix_trie, prefix_trie, sequences, with_shared_openings

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def count_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def brute_trie(conversations):
    """Nodes over {conv_id: [(role, text), ...]}, prefix by prefix."""
    nodes = {}
    for conv, turns in conversations.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(conv)
    below = {k: [m for m in nodes if m[:len(k)] == k] for k in nodes}
    children = {k: sum(len(m) == len(k) + 1 for m in below[k]) for k in nodes}
    found = []
    for k, members in nodes.items():
        ends = sorted(c for c in members if len(conversations[c]) == len(k))
        found.append((min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), children[k], sum(not children[m] for m in below[k]),
                      sum((len(nodes[m]) - 1) * count_words(m[-1][1]) for m in below[k] if m),
                      hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(found, key=str)


def rows_of(conversations):
    return [(c, k, r, t) for c, turns in conversations.items() for k, (r, t) in enumerate(turns)]


def listed(frame):
    return sorted([tuple(r) for r in frame.select(*COLUMNS).collect()], key=str)


def random_conversations(rnd, n):
    kinds = [("user", "a b"), ("user", "a  b c"), ("assistant", "x"), ("system", ""), ("", "y \t z"), ("userx", "")]
    found = {}
    for c in range(n):
        turns = [rnd.choice(kinds[:rnd.choice([1, 2, 6])]) for _ in range(rnd.choice([1, 2, 3, 5, 9]))]
        found[c * rnd.choice([1, 3]) if c * 3 not in found else 10_000 + c] = turns
    for c in range(n // 2):
        found[20_000 + c] = list(found[rnd.choice(list(found))])
    return found


@pytest.mark.parametrize("block_turns, partitions", [(1, 2), (7, 3), (60, 1), (300_000, 4), (300_000, 1)])
def test_nodes_equal_brute_force(spark, block_turns, partitions):
    conversations = random_conversations(random.Random(block_turns + partitions), 60)
    frame = spark.createDataFrame(rows_of(conversations), "conv_id long, turn long, role string, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert listed(prefix_trie(sequences(frame), block_turns)) == brute_trie(conversations)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def rebuilt(conversations):
    out = {}
    for c, turns in conversations.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = conversations.get(c - c % 20, [])[:h] + turns[h:]
    return out


def test_query_equals_brute_force(spark, tmp_path):
    conversations = random_conversations(random.Random(4), 90)
    conversations[500] = [("system", "long")] + [("user", f"turn {k % 5}") for k in range(700)]
    conversations[501] = list(conversations[500])[:600]
    rows = [(*r, "a", "b", "c") for r in rows_of(conversations)]
    # NULL turns come first, NULL roles and texts are empty, rows without a conversation go, other columns are ignored.
    rows += [(30_000, None, None, "b", "", "", ""), (30_000, 0, "user", None, "", "", ""), (30_001, 5, "", "b", "", "", ""), (None, 1, "user", "x", "", "", ""),
             (30_002, 1, "user", "é 日本", "", "", ""), (30_002, 1, "user", "é 日本", "", "", "")]
    conversations |= {30_000: [("", "b"), ("user", "")], 30_001: [("", "b")], 30_002: [("user", "é 日本")] * 2}
    random.Random(5).shuffle(rows)
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string, marks string, depth string").write.parquet(
        str(tmp_path / "conversations.parquet"))
    want = rebuilt(conversations)
    assert listed(op12_prefix_trie(spark, str(tmp_path))) == brute_trie(want)
    assert any(not t for t in want.values())


def test_empty_table_turnless_conversations_and_one_node(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie(sequences(none)).count() == 0
    empty = spark.createDataFrame([(3, None), (1, []), (2, [])], "conv_id long, turns array<struct<mark:binary,words:bigint>>")
    for size in (1, 100):
        assert listed(prefix_trie(empty, size)) == [(1, 0, None, 3, 0, 1, 0, hashlib.sha256(b"1,2,3").hexdigest())]


def test_copies_of_one_conversation_are_one_node_a_block(spark):
    same = {c: [("user", "hi there"), ("assistant", "hello")] for c in range(400)}
    frame = spark.createDataFrame(rows_of(same), "conv_id long, turn long, role string, text string")
    found = listed(prefix_trie(sequences(frame), 50))
    assert found == brute_trie(same) and len(found) == 3


def test_range_minima_find_extents():
    rnd = np.random.default_rng(3)
    for n in (1, 2, 7, 100):
        values = np.concatenate([[-1], rnd.integers(0, 4, n), [-1]])
        table = RangeMinima(values)
        for at in range(1, n + 1):
            for least in range(4):
                right = next(k for k in range(at, n + 2) if values[k] < least)
                left = next(k for k in range(at, -1, -1) if values[k] < least)
                assert table.right(np.array([at]), np.array([least]))[0] == right and table.left(np.array([at]), np.array([least]))[0] == left
                assert table.over(np.array([at]), np.array([n + 1]))[0] == values[at:n + 1].min()
    marks = np.array([[1, 1], [1, 2], [1, 1], [1, 2], [3, 3], [1, 1]], np.uint64)
    assert common_prefixes(marks, np.array([0, 2, 5, 5, 6])).tolist() == [-1, 2, 0, 0, -1]

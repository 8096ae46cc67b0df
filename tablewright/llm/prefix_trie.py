"""The trie of conversation prefixes: intervals of sorted conversations by range minima over their common prefixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.base import query, segments, small_batches, table
from tablewright.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Turns (and conversations) that one block of sorted conversations holds.
BLOCK_TURNS = 300_000
NO_ENDS = hashlib.sha256(b"").hexdigest()

PART_SCHEMA = ("block long, open boolean, key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, n_convs long,"
               " n_children long, n_leaves long, shared long, before long, upto long, first boolean, last boolean, last_depth long, ends string")


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns array<struct<mark, words>>) of every conversation, its turns in order.

    Turns are ordered by turn (NULL first), then role, then mark, the 128-bit hash of role and text by
    which they are told apart; NULL roles and texts are empty. Rows without a conv_id belong to no
    conversation and are left out. Texts are hashed where they are read; marks alone are shuffled, and a
    conversation is a row of 36 bytes a turn.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    mark = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    rows = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long"), F.struct(
        F.col("turn").cast("long").alias("turn"), role.alias("role"), mark.alias("mark"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")).alias("t"))
    sorted_turns = F.array_sort(F.collect_list("t"))
    return rows.groupBy("conv_id").agg(F.transform(sorted_turns, lambda t: F.struct(t["mark"].alias("mark"), t["words"].alias("words"))).alias("turns"))


class RangeMinima:
    """Sparse table: minima of all stretches whose length is a power of two."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        width = 1
        while 2 * width <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def over(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Least value in each non-empty [begin, end): two stretches that cover it."""
        level = np.frexp((end - begin).astype(np.float64))[1] - 1
        out = np.empty(len(begin), self.levels[0].dtype)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            values = self.levels[k]
            out[at] = np.minimum(values[begin[at]], values[end[at] - (1 << k)])
        return out

    def right(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The first place from ``at`` on with a value under ``least``; the values end with one."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            values = self.levels[k]
            inside = at < len(values)
            inside[inside] = values[at[inside]] >= least[inside]
            at[inside] += 1 << k
        return at

    def left(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The last place up to ``at`` with a value under ``least``; the values begin with one."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            begin = at - (1 << k) + 1
            inside = begin >= 0
            inside[inside] = self.levels[k][begin[inside]] >= least[inside]
            at[inside] -= 1 << k
        return at


def common_prefixes(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Turns that each row shares with the one before it; -1 at both ends (one value more than rows)."""
    lengths = np.diff(offsets)
    both = np.minimum(lengths[:-1], lengths[1:])
    within = segments(both)
    a, b = np.repeat(offsets[:-2], both) + within, np.repeat(offsets[1:-1], both) + within
    differs = np.flatnonzero((marks[a] != marks[b]).any(axis=1))
    ends = np.cumsum(both)
    first = np.searchsorted(differs, ends - both)
    out = both.copy()
    some = first < len(differs)
    place = differs[np.minimum(first, max(len(differs) - 1, 0))] if len(differs) else np.zeros(len(both), np.int64)
    some &= place < ends
    out[some] = within[place[some]]
    return np.concatenate([[-1], out, [-1]])


def _prefix_keys(marks: np.ndarray) -> list[bytes]:
    """A 128-bit key of every prefix of one conversation, the empty one first."""
    state, keys = hashlib.blake2b(digest_size=16), []
    keys.append(state.digest())
    for mark in marks:
        state.update(mark.tobytes())
        keys.append(state.copy().digest())
    return keys


def block_nodes(block: int, conv_ids: np.ndarray, offsets: np.ndarray, marks: np.ndarray, words: np.ndarray) -> dict[str, list]:
    """Columns of ``PART_SCHEMA`` for one block of conversations sorted by marks, then conv_id.

    A prefix that the row before lacks is born with its row. Every such prefix, and the one its row shares
    with the row before, finds its members by two binary searches over the range minima of the common
    prefixes, without regard to any other. All counts are then sums over the interval, which are
    differences of running sums. Nodes that reach the block's first or last row are open: their counts,
    and the words that their rows share with the rows before them, are parts to be added up.
    """
    n, lengths = len(conv_ids), np.diff(offsets)
    lcp = common_prefixes(marks, offsets)
    minima, least_ids = RangeMinima(lcp), RangeMinima(conv_ids)
    running = np.concatenate([[0], np.cumsum(words)])

    # Candidates of each row: the prefix it shares (its nodes' parent), then those born with it. The root is its own.
    shared = np.maximum(lcp[:-1], 0)
    births = lengths - shared
    base = np.concatenate([[0], np.cumsum(births)]) + 1
    has = births > 0
    shared_left = np.zeros(n, np.int64)
    shared_left[has] = minima.left(np.flatnonzero(has), shared[has])
    row = np.concatenate([[0], np.repeat(np.arange(n), births)])
    depth = np.concatenate([[0], np.repeat(shared, births) + segments(births) + 1])
    left, right = minima.left(row, depth), minima.right(row + 1, depth)

    def number(at: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Number of the node of depth d that is born with a row."""
        return np.where(d > 0, base[at] + d - shared[at] - 1, 0)

    parent = np.concatenate([[-1], np.arange(len(row) - 1)])
    firsts = base[:-1][has]
    parent[firsts] = number(shared_left[has], shared[has])
    is_open = (left == 0) | (right == n)
    # Words of the prefix that a row shares with the one before; childless ends: the last copies of what is not continued.
    common = running[offsets[:-1] + shared] - running[offsets[:-1]]
    common[0] = 0
    sums = np.concatenate([[0], np.cumsum(common)])
    childless = (lcp[1:] < lengths) & (lengths > 0)
    childless[-1] = False
    leaves = np.concatenate([[0], np.cumsum(childless)])
    counted = parent[1:][~is_open[1:]]
    children = np.bincount(counted, minlength=len(row))
    before = running[offsets[left] + np.maximum(depth - 1, 0)] - running[offsets[left]]
    upto = running[offsets[left] + depth] - running[offsets[left]]
    total = sums[right] - sums[left + 1]
    size = right - left
    smallest = least_ids.over(left, right)

    # Where each row ends: with the last prefix born with it, or where the equal row before it ends.
    source = np.maximum.accumulate(np.where(has, np.arange(n), 0))
    end = number(source, lengths)
    order = np.argsort(end, kind="stable")
    ended, begins = np.unique(end[order], return_index=True)
    texts = conv_ids[order].tolist()
    stops = np.append(begins[1:], n)
    joined = {node: ",".join(map(str, texts[a:b])) for node, a, b in zip(ended.tolist(), begins.tolist(), stops.tolist())}

    keys: dict[int, bytes] = {}
    for at in {0, n - 1}:
        depths = np.arange(lengths[at] + 1)
        nodes = number(minima.left(np.full(len(depths), at), depths), depths)
        keys.update(zip(nodes.tolist(), _prefix_keys(marks[offsets[at]:offsets[at + 1]])))
    opened = is_open.tolist()
    parents = parent.tolist()
    ids = smallest.tolist()
    saved = np.where(is_open, total, total - (size - 1) * before)
    ends = [joined.get(k, "") if o else hashlib.sha256(joined[k].encode()).hexdigest() if k in joined else NO_ENDS for k, o in enumerate(opened)]
    return {
        "block": np.full(len(row), block), "open": is_open, "key": [keys.get(k) if o else None for k, o in enumerate(opened)],
        "parent_key": [keys.get(p) for p in parents],
        "depth": depth, "conv_id": smallest, "parent_conv_id": [ids[p] if p >= 0 and not opened[p] else None for p in parents],
        "n_convs": size, "n_children": children, "n_leaves": leaves[right] - leaves[left], "shared": saved, "before": before, "upto": upto,
        "first": left == 0, "last": right == n, "last_depth": np.full(len(row), lengths[-1]), "ends": ends}


def _parts(sorted_rows: DataFrame, block_turns: int) -> DataFrame:
    """The nodes of all blocks of conversations (conv_id, marks, words) in order within and across partitions."""
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in PART_SCHEMA.split(","))])

    def build(held: list[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
        ids, lists, counts = [pa.concat_arrays([b.column(c) for b in held]) for c in ("conv_id", "marks", "words")]
        offsets = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths(), np.int64))])
        flat = lists.flatten().cast(pa.binary(16))
        data = np.frombuffer(flat.buffers()[1], np.uint64)[2 * flat.offset:2 * (flat.offset + len(flat))] if len(flat) else np.zeros(0, np.uint64)
        columns = block_nodes(block, np.asarray(ids, np.int64), offsets, data.reshape(-1, 2), np.asarray(counts.flatten(), np.int64))
        done = pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
        yield from (done.slice(at, 20_000) for at in range(0, done.num_rows, 20_000))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, block = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows + len(batch.column("marks").flatten())
            if size >= block_turns:
                yield from build(held, block)
                held, size, block = [], 0, block + 1
        if held:
            yield from build(held, block)

    return sorted_rows.mapInArrow(cut, PART_SCHEMA)


def _hash_ends(pieces: DataFrame) -> DataFrame:
    """(key, ends_sha256) of texts (key, block, ends) that follow each other by block, joined by commas."""
    schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])

    def stream(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for k, text in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
                if k != key:
                    if state is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(text.encode())
                else:
                    state.update(f",{text}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*done), schema)], schema=schema)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], schema=schema)

    return pieces.repartition("key").sortWithinPartitions("key", "block").mapInArrow(stream, "key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Nodes of the trie over (conv_id, turns array<struct<mark, words>>), one conversation a row.

    Every distinct sequence of first d turns is a node, d = 0 included; conversations that begin with it
    are its members, empty ones members of the root alone. Columns: conv_id (the least member), depth,
    parent_conv_id (the parent's conv_id; NULL for the root), n_convs, n_children, n_leaves (childless nodes of
    its subtree), saved_tokens (words that repeat an earlier member's turn, over the subtree), ends_sha256 (of
    the ids, ascending and joined by commas, of members that end here). Subtrees include their top.

    Conversations are sorted by their marks in ranges, and each range is worked off in blocks of about
    ``block_turns`` turns (a longer conversation is a block of its own). Nodes within a block are done there;
    the few that reach a block's edge are added up by key, with what the neighbouring rows of two blocks
    share. Equal conversations are told apart by conv_id in the ranges, so a large group of copies spreads
    over many tasks; of it one row a block is left. Only its ids' digest is made in one task, as a stream.

    conv_ids are distinct and not NULL (``sequences`` sees to that); NULL or empty turns are an empty
    conversation. An empty table gives no node.
    """
    spark = conversations.sparkSession
    small_batches(spark)
    turns = F.coalesce("turns", F.array().cast("array<struct<mark:binary,words:bigint>>"))
    rows = conversations.select("conv_id", F.transform(turns, lambda t: t["mark"]).alias("marks"), F.transform(turns, lambda t: t["words"]).alias("words"))
    parts = materialize(_parts(rows.repartitionByRange("marks", "conv_id").sortWithinPartitions("marks", "conv_id"), block_turns), "trie-parts")
    opened = parts.where("open")

    # What the first row of a block shares with the last one of the block before: the deepest key that both hold.
    # One row a block is all that this window sees.
    blocks = opened.where("depth = 0").select("block", "last_depth", F.lead("block").over(Window.orderBy("block")).alias("next"))
    before = opened.where("last").select("block", "key").join(blocks.select("block", "next"), "block").where(
        "next IS NOT NULL").select(F.col("next").alias("block"), "key")
    met = opened.where("first").join(before, ["block", "key"]).groupBy("block").agg(
        F.max("depth").alias("met"), F.max_by("upto", "depth").alias("met_words"))
    edges = blocks.join(met, "block", "left").join(
        met.select(F.col("block").alias("next"), F.col("met").alias("goes_on")), "next", "left").select(
        "block", "met", "met_words", F.when(F.col("goes_on").isNull() | (F.col("goes_on") < F.col("last_depth")), F.least("last_depth", F.lit(1)))
        .otherwise(0).alias("last_leaf"))
    added = opened.join(edges, "block").groupBy("key", "depth").agg(
        F.first("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.sum(F.col("n_leaves") + F.when(F.col("last"), F.col("last_leaf")).otherwise(0)).alias("n_leaves"),
        F.sum(F.col("shared") + F.when(F.col("first") & (F.col("depth") <= F.col("met")), F.col("met_words")).otherwise(0)).alias("shared"),
        F.first("before").alias("before"))
    added = materialize(added, "trie-open")
    above = added.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above_id"))
    below = added.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("open_children"))
    ends = _hash_ends(opened.where("ends <> ''").select("key", "block", "ends"))
    children = F.col("n_children") + F.coalesce("open_children", F.lit(0))
    edge_nodes = added.join(above, "parent_key", "left").join(below, "key", "left").join(ends, "key", "left").select(
        "conv_id", "depth", F.col("above_id").alias("parent_conv_id"), "n_convs", children.alias("n_children"),
        F.when(children == 0, F.greatest("n_leaves", F.lit(1))).otherwise(F.col("n_leaves")).alias("n_leaves"),
        (F.col("shared") - (F.col("n_convs") - 1) * F.col("before")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
    # Nodes under an open one learn its conv_id by block and key, so that no parent is a hot key.
    named = opened.select("block", F.col("key").alias("parent_key")).join(above, "parent_key")
    inner = parts.where("NOT open").select("block", "parent_key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                           F.col("shared").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
    under = inner.where("parent_key IS NOT NULL").join(named, ["block", "parent_key"]).withColumn("parent_conv_id", F.col("above_id"))
    columns = edge_nodes.columns
    return edge_nodes.union(inner.where("parent_key IS NULL").select(columns)).union(under.select(columns))


#: Conversations open like the first of their group of so many conv_ids, by up to that many turns.
GROUP = 20
OPENING = 4


def with_shared_openings(conversations: DataFrame) -> DataFrame:
    """Every conversation c rebuilt: the first h turns of conversation c - c mod 20, then its own after its first h.

    h is crc32(c as text) mod 4. Where that conversation has fewer turns all of them come, where there is
    none none; a conversation of at most h turns adds none of its own and may end up empty.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % OPENING).cast("int")
    heads = conversations.where(F.pmod("conv_id", F.lit(GROUP)) == 0).select(
        F.col("conv_id").alias("head_id"), F.slice("turns", 1, OPENING - 1).alias("head"))
    own = conversations.select("conv_id", "turns", h.alias("h"), (F.col("conv_id") - F.pmod("conv_id", F.lit(GROUP))).alias("head_id"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    opening = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    return own.join(heads, "head_id", "left").select("conv_id", F.concat(opening, rest).alias("turns"))


_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, (y & 1) * 3988292384))))"""
OP12_SQL = f"""
WITH numbered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, {_CRC32} % 4 AS h FROM (SELECT DISTINCT conv_id FROM numbered)),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, place, role, text FROM convs c JOIN numbered n ON n.conv_id = c.conv_id - c.conv_id % 20 AND place <= h
  UNION ALL SELECT c.conv_id, 1, place, role, text FROM convs c JOIN numbered n ON n.conv_id = c.conv_id AND place > h),
steps AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth,
         md5(length(role) || ':' || role || text) AS mark, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words FROM rebuilt),
prefixes AS (
  SELECT conv_id, depth, string_agg(mark, '') OVER (PARTITION BY conv_id ORDER BY depth) AS prefix,
         coalesce(string_agg(mark, '') OVER (PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS parent, words
  FROM steps UNION ALL SELECT conv_id, 0, '', NULL, 0 FROM convs),
nodes AS (SELECT prefix, any_value(depth) AS depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM prefixes GROUP BY prefix),
children AS (SELECT parent AS prefix, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
ends AS (
  SELECT prefix, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
  FROM (SELECT conv_id, max_by(prefix, depth) AS prefix FROM prefixes GROUP BY conv_id) GROUP BY prefix),
subtree AS (
  SELECT p.prefix, sum(CASE WHEN c.prefix IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((u.n_convs - 1) * u.words) AS saved_tokens
  FROM nodes u JOIN prefixes p ON p.conv_id = u.conv_id AND p.depth <= u.depth LEFT JOIN children c ON c.prefix = u.prefix GROUP BY p.prefix)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, m.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM nodes n LEFT JOIN nodes m ON m.prefix = n.parent LEFT JOIN children c ON c.prefix = n.prefix LEFT JOIN ends e ON e.prefix = n.prefix
JOIN subtree s ON s.prefix = n.prefix
"""


@query("op12_prefix_trie", OP12_SQL)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(with_shared_openings(sequences(table(spark, sf_dir, "conversations"))))

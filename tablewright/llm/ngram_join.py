"""Similarity join on word shingles: size-banded tiles, bitmap bounds, exact intersections."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.base import mix, pieces, query, segments, shingle_sets, small_batches, table
from tablewright.llm.components import components
from tablewright.session import materialize

# Two sets link when 100 * intersection >= 75 * union, that is 7 * intersection >= 3 * (sum of sizes).
# The bounds below follow from that share; they are no free parameters.
SHINGLE_WORDS = 5
BAND_RATIO = 4 / 3

#: Bits of the filter that keeps texts of no candidate from being shuffled (1 MB, whatever the input).
FILTER_BITS = 1 << 23
#: Members of a tile, or partners of a document, that one task compares at a time.
BLOCK = 1000
#: Members of a tile that all its unconnected members are compared with, before every pair is.
SECOND_HUBS = 4
#: Members, and their shingles, of one side of a pair job that counts links.
PAIR_BLOCK = 400
PAIR_SHINGLES = 1_000_000
#: Columns that a dense product of incidences has at a time; values of fewer rows than ``DENSE`` are paired one by one.
DENSE_COLUMNS = 2048
DENSE = 16
#: Sets whose connections one task remembers while it tests pairs.
FOREST_NODES = 1_000_000


def _class_of(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64-bit identity of every row's set (and its size)."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(flat.copy()))])
    return mix(total[offsets[1:]] - total[offsets[:-1]] + np.diff(offsets).astype(np.uint64))


def _bitmaps(flat: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """Parity bitmaps: each shingle flips one of about 2 n bits (a power of two, 64 at least)."""
    sizes = np.diff(offsets)
    words = 1 << np.maximum(0, np.ceil(np.log2(np.maximum(sizes, 1) / 32))).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(words)])
    bits = (flat >> np.uint64(3)) & np.repeat(words * 64 - 1, sizes).astype(np.uint64)
    out = np.zeros(begin[-1], np.uint64)
    place = np.repeat(begin[:-1], sizes) + (bits >> np.uint64(6)).astype(np.int64)
    np.bitwise_xor.at(out, place, np.uint64(1) << (bits & np.uint64(63)))
    data = out.tobytes()
    return [data[8 * a:8 * b] for a, b in zip(begin[:-1].tolist(), begin[1:].tolist())]


def _folded(bitmap: bytes, words: int) -> np.ndarray:
    """A bitmap at a smaller width: parities of the folded bits."""
    bits = np.frombuffer(bitmap, np.uint64)
    return np.bitwise_xor.reduce(bits.reshape(-1, words), axis=0)


def _may_link(sizes_a, sizes_b, differing) -> np.ndarray:
    """Whether the overlap that bit counts allow is enough; the sets differ in ``differing`` elements at least."""
    most = np.minimum((sizes_a + sizes_b - differing) // 2, np.minimum(sizes_a, sizes_b))
    return 7 * most >= 3 * (sizes_a + sizes_b)


def set_signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n (set size), set_id (identity of the set) and bitmap of every document."""
    small_batches(docs.sparkSession)

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                flat, offsets = shingle_sets(piece.column("text"), SHINGLE_WORDS)
                yield pa.record_batch({
                    "doc_id": piece.column("doc_id"), "n": pa.array(np.diff(offsets)),
                    "set_id": pa.array(_class_of(flat, offsets).view(np.int64)),
                    "bitmap": pa.array(_bitmaps(flat, offsets), pa.binary())})

    return docs.select("doc_id", "text").mapInArrow(sign, "doc_id long, n long, set_id long, bitmap binary")


def tiles(docs: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of set_ids of one tile, where a is the tile's least member.

    A tile has the sets of a size band that share a key. A key is a pair of shingles that follow
    each other in hash order in a document's first n / 2 + 2
    shingles. Let two sets link, with d shingles in only one of them: d is a quarter of the union
    at most, each such shingle parts at most one pair of neighbours among the common ones, so of
    the first d + 2 common ones two stay neighbours in both sets; and they lie among the first
    n / 2 + 2 shingles of each. So linked sets share a tile, while a passage that many
    documents quote does not join them, unless it makes up most of their shingles. Sizes of linked sets
    differ by at most one band of ratio 4 / 3; a set is in the tiles of its own band and of the next.

    Keys travel packed, hashed to buckets.
    """
    spark = docs.sparkSession
    small_batches(spark)
    n_buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                flat, offsets = shingle_sets(piece.column("text"), SHINGLE_WORDS)
                ids, first = np.unique(_class_of(flat, offsets), return_index=True)
                sizes = np.diff(offsets)[first]
                ids, first, sizes = ids[sizes > 1], first[sizes > 1], sizes[sizes > 1]
                count = np.minimum(sizes - 1, sizes // 2 + 1)
                at = np.repeat(offsets[first], count) + segments(count)
                key = mix(flat[at] * np.uint64(0x9E3779B97F4A7C15) + flat[at + 1])
                owner = np.repeat(np.arange(len(ids)), count)
                band = np.floor(np.log(sizes) / np.log(BAND_RATIO)).astype(np.int16)
                bucket = (key % np.uint64(n_buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                key, owner, bucket = key[order], owner[order], bucket[order]
                cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
                rows = {"bucket": [], "keys": [], "ids": [], "bands": [], "counts": []}
                for a, b in zip(cuts, np.append(cuts[1:], len(bucket))):
                    own, many = np.unique(owner[a:b], return_counts=True)
                    for name, value in (("bucket", int(bucket[a])), ("keys", key[a:b].tobytes()), ("ids", ids[own].tobytes()),
                                        ("bands", band[own].tobytes()), ("counts", many.astype(np.int32).tobytes())):
                        rows[name].append(value)
                yield pa.record_batch({k: pa.array(v, pa.int32() if k == "bucket" else pa.binary()) for k, v in rows.items()})

    def gather(bucket: pa.Table) -> pa.Table:
        key, ids, bands, counts = (np.frombuffer(b"".join(bucket.column(c).to_pylist()), t) for c, t in (
            ("keys", np.uint64), ("ids", np.uint64), ("bands", np.int16), ("counts", np.int32)))
        owner = np.repeat(np.arange(len(ids)), counts)
        order = np.argsort(key)
        key, owner = key[order], owner[order]
        same = key[1:] == key[:-1]
        shared = np.append(same, False) | np.append(False, same)
        key, owner = key[shared], owner[shared]
        key, member, band = np.tile(key, 2), np.tile(ids[owner], 2), np.concatenate([bands[owner], bands[owner] + 1])
        order = np.lexsort((member, band, key))
        key, member, band = key[order], member[order], band[order]
        group = np.append(True, (key[1:] != key[:-1]) | (band[1:] != band[:-1])) if len(key) else np.zeros(0, bool)
        least = member[group][np.cumsum(group) - 1]
        pairs = np.unique(np.stack([least, member], axis=1)[least != member], axis=0).view(np.int64)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    packed = docs.select("doc_id", "text").mapInArrow(keys, "bucket int, keys binary, ids binary, bands binary, counts binary")
    return packed.groupBy("bucket").applyInArrow(gather, "a long, b long").distinct()


def _groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of equal ``key`` in a sorted stream; a run is held whole (the callers bound it)."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.asarray(batch.column(key))
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if held and values[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = values[a]
    if held:
        yield pa.Table.from_batches(held)


def _pair_batch(a, b) -> pa.RecordBatch:
    a, b = np.asarray(a, np.int64), np.asarray(b, np.int64)
    return pa.record_batch({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})


def within_bounds(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of set ids whose sizes and bitmaps leave room for a link."""
    def side(name: str) -> DataFrame:
        return sets.select(F.col("set_id").alias(name), F.col("n").alias(f"n_{name}"), F.col("bitmap").alias(f"bitmap_{name}"))

    def test(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            differing = []
            for x, y in zip(batch.column("bitmap_a").to_pylist(), batch.column("bitmap_b").to_pylist()):
                words = min(len(x), len(y)) // 8
                differing.append(int(np.bitwise_count(_folded(x, words) ^ _folded(y, words)).sum()))
            sizes = (np.asarray(batch.column(c), np.int64) for c in ("n_a", "n_b"))
            passed = pa.array(_may_link(*sizes, np.array(differing, np.int64)), pa.bool_())
            yield batch.select(["a", "b"]).filter(passed)

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "bitmap_a", "bitmap_b").mapInArrow(
        test, "a long, b long")


def set_arrays(wanted: DataFrame, docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(set_id, shingles) of the sets in ``wanted``, and of some others.

    The texts are read again, and a filter of fixed size on doc_id tells which to make arrays of; those it
    lets pass by chance find no partner.
    """
    spark = docs.sparkSession
    needed = materialize(wanted.select("set_id").distinct().join(sets.select("set_id", "rep"), "set_id").select(
        "set_id", F.col("rep").alias("doc_id")), "needed-sets")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).cast("int")
    # At most FILTER_BITS / 64 rows come to the driver.
    words = (needed.select(place.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, bit & 63))").alias("bits")).collect())
    bitmap = np.zeros(FILTER_BITS // 64, np.int64)
    bitmap[[w["word"] for w in words]] = [w["bits"] for w in words]
    shared = spark.sparkContext.broadcast(bitmap)

    def shingle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = np.asarray(batch.column("bit"))
            wanted = (shared.value[bit >> 6] >> (bit & 63)) & 1 == 1
            for piece in pieces(batch.filter(pa.array(wanted))):
                flat, offsets = shingle_sets(piece.column("text"), SHINGLE_WORDS)
                data = flat.tobytes()
                yield pa.record_batch({
                    "set_id": pa.array(_class_of(flat, offsets).view(np.int64)),
                    "shingles": pa.array([data[8 * a:8 * b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], pa.binary())})

    texts = docs.select(place.alias("bit"), "text")
    return texts.mapInArrow(shingle, "set_id long, shingles binary").dropDuplicates(["set_id"])


def verify(pairs: DataFrame, docs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links among the pairs (a, b) of set ids, by intersection of their sorted shingle arrays.

    Pairs that the links found by the same task already connect are passed over, so the links
    returned connect all that the pairs' links connect; ``link_counts`` counts every link.

    Each set is sent to the tasks of its hubs (the a sides), a hub to one task per ``BLOCK`` partners.
    """
    hubs = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")
    routes = pairs.join(hubs, "a").select(F.col("b").alias("set_id"), "a", part.alias("part"), F.lit(False).alias("hub")).union(
        hubs.select(F.col("a").alias("set_id"), "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)), F.lit(True)))
    routes = materialize(routes, "set-routes")
    sent = set_arrays(routes, docs, sets).join(routes, "set_id").withColumn("task", F.xxhash64("a", "part"))

    def intersect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Links that this task's earlier ones imply need no test: they cannot join anything more.
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        for group in _groups(batches, "task"):
            if len(parent) > FOREST_NODES:
                parent.clear()
            ids, hubs, targets = (group.column(c).to_pylist() for c in ("set_id", "hub", "a"))
            data = [np.frombuffer(s, np.uint64) for s in group.column("shingles").to_pylist()]
            own = {i: x for i, hub, x in zip(ids, hubs, data) if hub}
            linked = []
            for b, hub, a, y in zip(ids, hubs, targets, data):
                if not hub and a in own and root(a) != root(b):
                    x = own[a]
                    if 7 * len(np.intersect1d(x, y, assume_unique=True)) >= 3 * (len(x) + len(y)):
                        linked.append((a, b))
                        parent[root(b)] = root(a)
            if linked:
                yield _pair_batch(*zip(*linked))

    return sent.repartition("task").sortWithinPartitions("task").mapInArrow(intersect, "a long, b long")


def linked_groups(links: DataFrame) -> DataFrame:
    """(set_id, group) of all linked sets: the least set id within two links, or three by way of the least."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    around = both.join(low.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("low").alias("near"))
    return around.join(low, "a").select(F.col("a").alias("set_id"), F.least("near", "low").alias("group"))


def link_components(links: DataFrame) -> DataFrame:
    """(set_id, component) of all linked sets; the groups that links lead down to are joined first."""
    groups = materialize(linked_groups(links), "link-groups")

    def ends(side: str) -> DataFrame:
        return groups.select(F.col("set_id").alias(side), F.col("group").alias(f"g{side}"))

    between = (links.join(ends("a"), "a", "left").join(ends("b"), "b")
               .select(F.coalesce("ga", "a").alias("a"), F.col("gb").alias("b")).where("a <> b").distinct())
    joined = components(between).withColumnRenamed("node", "group")
    # A group's least set has no row of its own where it is no link's greater end.
    tops = groups.select(F.col("group").alias("set_id")).distinct().join(groups.select("set_id"), "set_id", "left_anti")
    every = groups.select("set_id", "group").union(tops.select("set_id", F.col("set_id").alias("group")))
    return every.join(joined, "group", "left").select("set_id", F.coalesce("component", "group").alias("component"))


def _tile_rows(star: DataFrame, links: DataFrame) -> DataFrame:
    """Members of all tiles of one least member, with their groups; ``inner`` are those of its own group."""
    groups = materialize(linked_groups(links), "linked-groups")
    return (star.select(F.col("a").alias("tile"), F.col("b").alias("set_id")).join(groups, "set_id", "left")
            .join(groups.select(F.col("set_id").alias("tile"), F.col("group").alias("main")), "tile", "left")
            .select("tile", "set_id", F.coalesce("group", "set_id").alias("component"), F.coalesce("main", "tile").alias("main"))
            .withColumn("inner", F.col("component") == F.col("main")))


def second_pairs(star: DataFrame, links: DataFrame) -> DataFrame:
    """Pairs (hub, member) of each tile's ``SECOND_HUBS`` drawn members with those outside its least member's group.

    A member of a large group of near copies that does not link with the least one most often links with
    one of these, so that few are left for ``open_pairs``. As many pairs as members, times a constant.
    """
    rows = _tile_rows(star, links)
    drawn = rows.groupBy("tile").agg(*[
        F.min(F.struct(F.xxhash64("set_id", F.lit(k)), "set_id"))["set_id"].alias(f"hub{k}") for k in range(SECOND_HUBS)])
    hubs = F.array_distinct(F.array(*[F.col(f"hub{k}") for k in range(SECOND_HUBS)]))
    return (rows.where(~F.col("inner")).join(drawn, "tile").select(F.explode(hubs).alias("a"), F.col("set_id").alias("b"))
            .where("a <> b").distinct())


def open_pairs(star: DataFrame, links: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs that share a least member, are not known to be connected, and may link by their bounds.

    All tiles of one least member are compared together, so a pair of near copies that shares many
    tiles comes up once. Known to be connected are sets whose links lead, in one or two
    steps, to one least member. Tiles within one such group have nothing to add; the others are compared
    in blocks of ``BLOCK`` members, those of the least member's own group never among themselves.
    """
    rows = _tile_rows(star, links)
    of_tile = rows.groupBy("tile").agg(F.count(F.lit(1)).alias("m"), F.count_if("inner").alias("n_inner"))
    of_tile = of_tile.where("n_inner < m AND m > 1").select(
        "tile", "m", F.ceil(F.col("n_inner") / BLOCK).cast("int").alias("inner_blocks"),
        F.ceil((F.col("m") - F.col("n_inner")) / BLOCK).cast("int").alias("outer_blocks"))
    whole = F.col("m") <= BLOCK

    def block(name: str):
        return F.pmod(F.xxhash64("set_id", F.lit(7)), F.col(name)).cast("int")

    def each(name: str, job):
        return F.transform(F.slice(F.sequence(F.lit(0), F.col(name)), F.lit(1), F.col(name)), job)

    jobs = F.when(whole, F.array(F.struct(F.lit("o").alias("kind"), F.lit(0).alias("i"), F.lit(0).alias("j")))).when(
        F.col("inner"), each("outer_blocks", lambda o: F.struct(F.lit("d").alias("kind"), o.alias("i"), block("inner_blocks").alias("j")))
    ).otherwise(F.concat(
        each("inner_blocks", lambda d: F.struct(F.lit("d").alias("kind"), block("outer_blocks").alias("i"), d.alias("j"))),
        each("outer_blocks", lambda o: F.struct(F.lit("o").alias("kind"), F.least(block("outer_blocks"), o).alias("i"),
                                                F.greatest(block("outer_blocks"), o).alias("j")))))
    dealt = (rows.join(of_tile, "tile").withColumn("job", F.explode(jobs))
             .select(F.xxhash64("tile", "job").alias("job"), "set_id", "component")
             .join(sets.select("set_id", "n", "bitmap"), "set_id"))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "job"):
            ids, parts, sizes = (np.asarray(group.column(c), np.int64) for c in ("set_id", "component", "n"))
            maps = group.column("bitmap").to_pylist()
            words = min(map(len, maps)) // 8
            bits = np.stack([_folded(m, words) for m in maps])
            step = max(1, (1 << 22) // max(1, bits.size))
            for a in range(0, len(ids), step):
                b = min(len(ids), a + step)
                apart = (parts[a:b, None] != parts[None, :]) & (ids[a:b, None] < ids[None, :])
                if not apart.any():
                    continue
                differing = np.bitwise_count(bits[a:b, None, :] ^ bits[None, :, :]).sum(axis=2, dtype=np.int64)
                i, j = np.nonzero(apart & _may_link(sizes[a:b, None], sizes[None, :], differing))
                if len(i):
                    yield _pair_batch(ids[a + i], ids[j])

    return dealt.repartition("job").sortWithinPartitions("job").mapInArrow(compare, "a long, b long").distinct()


def shared_counts(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Number of common values of every two rows; ``flat`` has each row's distinct values one row after the other.

    Values of many rows are counted by products of dense incidences, the others pair by pair.
    """
    m = len(sizes)
    owner = np.repeat(np.arange(m), sizes)
    _, column, counts = np.unique(flat, return_inverse=True, return_counts=True)
    out = np.zeros((m, m), np.int64)
    heavy = np.flatnonzero(counts >= DENSE)
    place = np.full(len(counts), -1)
    place[heavy] = np.arange(len(heavy))
    for start in range(0, len(heavy), DENSE_COLUMNS):
        at = place[column] - start
        inside = (at >= 0) & (at < DENSE_COLUMNS)
        dense = np.zeros((m, min(DENSE_COLUMNS, len(heavy) - start)), np.float32)
        dense[owner[inside], at[inside]] = 1
        out += (dense @ dense.T).astype(np.int64)
    light = (counts[column] > 1) & (counts[column] < DENSE)
    order = np.argsort(column[light], kind="stable")
    column, owner = column[light][order], owner[light][order]
    for lag in range(1, DENSE - 1):
        same = np.flatnonzero(column[lag:] == column[:-lag])
        if not len(same):
            break
        # Rows of one value ascend, so these fall above the diagonal.
        both = np.bincount(owner[same] * m + owner[same + lag], minlength=m * m).reshape(m, m)
        out += both + both.T
    return out


def _fresh(group: pa.Table) -> np.ndarray:
    """Pairs (the first before the second) that a job compares: of its two blocks, and of no lesser tile."""
    tile = group.column("tile")[0].as_py()
    block = np.asarray(group.column("block"))
    tiles = [np.frombuffer(t, np.int64) for t in group.column("tiles").to_pylist()]
    lesser = [t[t < tile] for t in tiles]
    fresh = shared_counts(np.concatenate(lesser), np.array([len(t) for t in lesser])) == 0
    if group.column("crossed")[0].as_py():
        fresh &= block[:, None] != block[None, :]
    return np.triu(fresh, 1)


def pair_members(star: DataFrame, sets: DataFrame) -> DataFrame:
    """Members of the jobs that count links: job, tile, crossed, block, set_id and the packed ``tiles`` of the set.

    Linked sets are both members of some tile's least member (or one is that member), so every pair of
    such members is compared, in the least of the tiles that both are in and nowhere else. A tile is cut into
    blocks of about ``PAIR_BLOCK`` members and ``PAIR_SHINGLES`` shingles, a job has two blocks
    (``crossed``) or one. Members whose sizes and bitmaps leave room for a link with none in the job are left out.
    """
    own = star.select("a").distinct()
    rows = star.select(F.col("a").alias("tile"), F.col("b").alias("set_id")).union(own.select("a", "a"))
    listed = rows.groupBy("set_id").agg(F.collect_set("tile").alias("tiles"))
    known = materialize(listed.join(sets.select("set_id", "n", "bitmap"), "set_id"), "tile-lists")
    parts = known.select(F.explode("tiles").alias("tile"), "n").groupBy("tile").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / PAIR_BLOCK), F.ceil(F.sum("n") / PAIR_SHINGLES)).cast("int").alias("parts"))
    block = F.pmod(F.xxhash64("set_id", F.lit(7)), F.col("parts")).cast("int")
    dealt = (rows.join(parts, "tile").withColumn("block", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select(F.xxhash64("tile", F.least("block", "other"), F.greatest("block", "other")).alias("job"), "tile",
                     (F.col("block") != F.col("other")).alias("crossed"), "block", "set_id")
             .join(known, "set_id"))

    def bound(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "job"):
            packed = pa.array([np.array(t, np.int64).tobytes() for t in group.column("tiles").to_pylist()], pa.binary())
            group = group.set_column(group.schema.get_field_index("tiles"), "tiles", packed)
            first, second = np.nonzero(_fresh(group))
            sizes, maps = np.asarray(group.column("n"), np.int64), group.column("bitmap").to_pylist()
            words = min(map(len, maps)) // 8
            bits = np.stack([_folded(m, words) for m in maps])
            found = np.zeros(len(maps), bool)
            step = max(1, (1 << 20) // words)
            for at in range(0, len(first), step):
                i, j = first[at:at + step], second[at:at + step]
                differing = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1, dtype=np.int64)
                passed = _may_link(sizes[i], sizes[j], differing)
                found[i[passed]] = found[j[passed]] = True
            if found.any():
                group = group.filter(pa.array(found)).select(["job", "tile", "crossed", "block", "set_id", "tiles"])
                yield from group.combine_chunks().to_batches()

    return dealt.repartition("job").sortWithinPartitions("job").mapInArrow(
        bound, "job long, tile long, crossed boolean, block int, set_id long, tiles binary")


def link_counts(star: DataFrame, docs: DataFrame, sets: DataFrame, weights: DataFrame) -> DataFrame:
    """(set_id, linked) of the sets that link with others: the summed ``weight`` of those, each link counted once.

    Every pair of ``pair_members`` is tested by its exact intersection, also where other links imply a link or
    connect its ends, so a group of m near copies costs m * m / 2 tests; they leave a task as one sum per member.
    """
    members = materialize(pair_members(star, sets), "pair-members")
    sent = members.join(set_arrays(members, docs, sets), "set_id").join(weights, "set_id")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "job"):
            data = [np.frombuffer(s, np.uint64) for s in group.column("shingles").to_pylist()]
            sizes = np.array([len(x) for x in data])
            linked = _fresh(group) & (7 * shared_counts(np.concatenate(data), sizes) >= 3 * (sizes[:, None] + sizes[None, :]))
            total = (linked | linked.T) @ np.asarray(group.column("weight"), np.int64)
            yield pa.record_batch({"set_id": group.column("set_id").combine_chunks(), "linked": pa.array(total)}).filter(pa.array(total > 0))

    counted = sent.repartition("job").sortWithinPartitions("job").mapInArrow(count, "set_id long, linked long")
    return counted.groupBy("set_id").agg(F.sum("linked").alias("linked"))


def similar_documents(docs: DataFrame, count_links: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links of every document, for sets of five-word shingles.

    A set has the distinct shingles of the whole lower-cased text (of a shorter text, the whole
    sequence). Documents link when 100 * intersection >= 75 * union; component_id is the least doc_id
    reachable, n_links the number of other documents linked with directly, equal ones among them
    (rows of one doc_id and set count as one document). Without ``count_links`` that column is
    left out, and with it the tests that components do not need. Texts that are NULL, empty or without words have size 0 and link with nothing. NULL
    doc_ids get no component and link with nothing; repeated rows repeat; an empty table gives
    no rows. Sets are told apart by 64-bit hashes of shingles and of sets.

    Equal sets are one node. Nodes that share a tile are candidates; first each with the
    tile's least member, then those left over with a few drawn members, then, in tiles whose members
    are not all connected by then, every pair from different groups. So all links are found that could join components, while a
    large group of near copies costs its size, not its square; counting its links does cost that. Every intermediate result that is
    used twice is a written table.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    known = docs.where("doc_id IS NOT NULL")
    signed = materialize(set_signatures(docs), "set-signatures")
    documents = signed.where("n > 0 AND doc_id IS NOT NULL")
    sets = materialize(documents.groupBy("set_id").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bitmap").alias("bitmap")), "sets")
    star = materialize(tiles(known), "star-pairs")
    links = materialize(verify(materialize(within_bounds(star, sets), "bounded-pairs"), known, sets), "star-links")
    second = materialize(second_pairs(star, links), "second-pairs")
    if not second.isEmpty():
        links = links.union(materialize(verify(materialize(within_bounds(second, sets), "bounded-pairs"), known, sets), "second-links"))
    tested = second.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    rest = materialize(open_pairs(star, links, sets).join(tested, ["a", "b"], "left_anti"), "open-pairs")
    links = links.union(materialize(verify(rest, known, sets), "open-links")) if not rest.isEmpty() else links
    groups = materialize(link_components(links), "link-components")

    by_set = sets.select("set_id", "rep").join(groups, "set_id", "left").withColumn(
        "component", F.coalesce("component", "set_id"))
    least = by_set.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_set = by_set.join(least, "component").select("set_id", "component_id")
    if count_links:
        weights = materialize(documents.select("set_id", "doc_id").distinct().groupBy("set_id").agg(
            F.count(F.lit(1)).alias("weight")), "set-weights")
        counts = materialize(link_counts(star, known, sets, weights), "link-counts")
        by_set = by_set.join(weights, "set_id").join(counts, "set_id", "left").select(
            "set_id", "component_id", (F.col("weight") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    by_set = materialize(by_set, "set-components")
    linkable = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return signed.join(by_set, "set_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(linkable, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        *([F.when(linkable, F.col("n_links")).otherwise(0).alias("n_links")] if count_links else []))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents that are the least of their component (all rows of that doc_id); NULL doc_ids stay."""
    found = similar_documents(docs, count_links=False).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(docs.columns)


@query("op3_ngram_join")
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"))

"""Sums of column products of wide tables, in tiles of two column blocks.

The products of p columns are p x p cells. Cut into tiles of ``TILE`` columns each way, every task
adds up its rows' share of the tiles, the shares of one tile meet under its number, and the sums are
rows of a table: no task holds more than ``STRIPE_CELLS`` cells or adds more than one tile's shares.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns of a block; a tile has TILE x TILE cells (0.5 MB).
TILE = 256
#: Cells a task holds at a time (256 MB); more tiles are made in further passes over the rows.
STRIPE_CELLS = 1 << 25
#: Sums of one tile kept apart while per-task shares are added up.
MERGE_GROUPS = 256
#: Up to this many columns the means are built-in aggregates; beyond, Arrow batches.
BUILTIN_MEANS = 64

Tile = tuple[int, int]


def blocks_of(size: int, tile: int) -> list[slice]:
    return [slice(at, min(at + tile, size)) for at in range(0, size, tile)]


def tile_passes(size: int, tile: int, layers: int, stripe: int = STRIPE_CELLS) -> list[list[Tile]]:
    """The upper tiles of a size x size matrix, in groups that a task can hold."""
    n = len(blocks_of(size, tile))
    per_pass = max(1, stripe // (layers * min(tile, size) ** 2))
    tiles = [(i, j) for i in range(n) for j in range(i, n)]
    return [tiles[at:at + per_pass] for at in range(0, len(tiles), per_pass)]


def column_means(values: DataFrame) -> tuple[int, np.ndarray]:
    """Row count and column means over present values; the means only have to be near the data's middle."""
    size = len(values.columns)
    if size <= BUILTIN_MEANS:
        row = values.agg(F.count(F.lit(1)).alias("rows"), *[F.avg(c).alias(c) for c in values.columns]).first()
        return row["rows"], np.array([row[c] or 0.0 for c in values.columns])

    def kernel(batches):
        import numpy as np
        import pyarrow as pa
        held = np.zeros(1 + 2 * size)
        for batch in batches:
            held[0] += batch.num_rows
            for i, column in enumerate(batch.columns):
                x = column.to_numpy(zero_copy_only=False)
                here = ~np.isnan(x)
                held[1 + i] += x[here].sum()
                held[1 + size + i] += here.sum()
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([0], pa.int32()), pa.array([held])], ["i", "j", "cells"])

    found = add_up(values.mapInArrow(kernel, "i int, j int, cells array<double>")).first()
    if found is None:
        return 0, np.zeros(size)
    cells = np.array(found["cells"])
    counts = cells[1 + size:]
    return round(cells[0]), np.divide(cells[1:1 + size], counts, out=np.zeros(size), where=counts > 0)


def add_up(shares: DataFrame) -> DataFrame:
    """Sums of the shares (i, j, cells) of every tile: ``i, j, cells``.

    In two levels: the first spreads a tile's shares over MERGE_GROUPS sums, so that the last one adds
    that many at most, however many tasks there were.
    """
    vectors = shares.select("i", "j", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("g"), array_to_vector("cells").alias("v"))
    halfway = vectors.groupBy("i", "j", "g").agg(Summarizer.sum(F.col("v")).alias("v"))
    return halfway.groupBy("i", "j").agg(Summarizer.sum(F.col("v")).alias("v")).select("i", "j", vector_to_array("v").alias("cells"))


def _shares(values: DataFrame, products, size: int, tile: int, layers: int, stripe: int) -> DataFrame:
    """Each task's share of all tiles: ``products`` gives, of a batch's matrix, the layers of one tile."""
    cuts = blocks_of(size, tile)

    def one_pass(tiles: Sequence[Tile]) -> DataFrame:
        def kernel(batches):
            import numpy as np
            import pyarrow as pa
            held: dict[Tile, np.ndarray] = {}
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = np.empty((batch.num_rows, batch.num_columns))
                for i, column in enumerate(batch.columns):
                    x[:, i] = column.to_numpy(zero_copy_only=False)
                for (i, j), part in products(x, [(t, cuts[t[0]], cuts[t[1]]) for t in tiles]):
                    if (i, j) in held:
                        held[i, j] += part
                    else:
                        held[i, j] = part
            for (i, j), part in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([part.ravel()])], ["i", "j", "cells"])

        return values.mapInArrow(kernel, "i int, j int, cells array<double>")

    return reduce(DataFrame.union, [one_pass(t) for t in tile_passes(size, tile, layers, stripe)])


def complete_products(values: DataFrame, shift: np.ndarray, tile: int = TILE, stripe: int = STRIPE_CELLS) -> DataFrame:
    """Tiles of the products of all columns less ``shift``, with a column of ones before them, over complete rows."""
    def products(x, tiles):
        import numpy as np
        z = np.ones((len(x), x.shape[1] + 1))
        z[:, 1:] = x - shift
        z = z[~np.isnan(z).any(axis=1)]
        for t, a, b in tiles:
            yield t, z[:, a].T @ z[:, b]

    return add_up(_shares(values, products, len(shift) + 1, tile, 1, stripe))


#: What ``pairwise_products`` adds up for a column a of one block and b of the other, over rows that have both.
PAIR_LAYERS = ("count", "a", "b", "aa", "bb", "ab")


def pairwise_products(values: DataFrame, shift: np.ndarray, tile: int = TILE, stripe: int = STRIPE_CELLS) -> DataFrame:
    """Tiles of ``PAIR_LAYERS``, each pair of columns over the rows in which both are present."""
    def products(x, tiles):
        import numpy as np
        x = x - shift
        here = (~np.isnan(x)).astype(float)
        x[here == 0] = 0.0
        squares = x * x
        for t, a, b in tiles:
            yield t, np.stack([here[:, a].T @ here[:, b], x[:, a].T @ here[:, b], here[:, a].T @ x[:, b],
                               squares[:, a].T @ here[:, b], here[:, a].T @ squares[:, b], x[:, a].T @ x[:, b]])

    return add_up(_shares(values, products, len(shift), tile, len(PAIR_LAYERS), stripe))


def assemble(tiles: DataFrame, size: int, tile: int = TILE, layers: int = 1) -> np.ndarray | None:
    """The tiles as layers x size x size numbers, filled above the diagonal blocks only; None without rows.

    For what is solved on the driver: 8 bytes a cell, the number of columns alone decides how many.
    """
    cuts = blocks_of(size, tile)
    full, rows = np.zeros((layers, size, size)), 0
    for batch in tiles.toArrow().to_batches():
        for i, j, cells in zip(batch.column("i").to_pylist(), batch.column("j").to_pylist(), batch.column("cells")):
            a, b = cuts[i], cuts[j]
            full[:, a, b] = cells.values.to_numpy().reshape(layers, a.stop - a.start, b.stop - b.start)
            rows += 1
    return full if rows else None


def mirrored(upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """A matrix from the cells on and above the diagonal, and those that belong below it, transposed."""
    return np.triu(upper) + np.triu(lower, 1).T

"""Most frequent values, exact, without grouping all values.

A mergeable summary of bounded size finds the values that may be frequent, with a bound on what it can have
missed; one more pass counts only those exactly. Where the bound does not settle the answer the summary
grows, and at last the values are grouped by digests of 16 bytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import quoted

#: Values that a summary tracks, attempt by attempt; 8 bytes each per task and column.
TRACKED = (1 << 12, 1 << 16, 1 << 19)
#: A summary that tracks m values counts none of n rows wrong by more than ERROR * n / m.
ERROR = 3.5


def digests(value: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes by which values are told apart."""
    return F.xxhash64(value), F.xxhash64(F.lit(7), value)


def _text(column: str) -> Column:
    return quoted(column).cast("string")


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, h1, h2) of the non-null values; texts themselves are not multiplied."""
    pairs = df.select(*[F.when(_text(c).isNotNull(), F.struct(*[h.alias(a) for h, a in zip(digests(_text(c)), ("h1", "h2"))])).alias(c)
                        for c in columns])
    return pairs.unpivot([], [quoted(c) for c in columns], "column", "d").where("d IS NOT NULL").select("column", "d.h1", "d.h2")


def _candidates(df: DataFrame, columns: Sequence[str], tracked: int) -> dict[str, tuple[int, list[int]]]:
    """Per column: its number of values, and first hashes that hold every value of more than twice the error bound."""
    hashed = df.select(*[F.when(_text(c).isNotNull(), digests(_text(c))[0]).alias(f"h{i}") for i, c in enumerate(columns)])
    found = hashed.agg(*[a for i in range(len(columns)) for a in (
        F.count(f"h{i}").alias(f"n{i}"), F.expr(f"approx_top_k(h{i}, {tracked}, {tracked})").alias(f"t{i}"))]).first()
    return {c: (found[f"n{i}"], [t["item"] for t in (found[f"t{i}"] or []) if t["item"] is not None]) for i, c in enumerate(columns)}


def frequent_values(df: DataFrame, columns: Sequence[str], n: int = 1, tracked: Sequence[int] = TRACKED) -> DataFrame:
    """Per column the ``n`` most frequent values with their exact counts: ``column, value, freq``.

    Values are compared as text; NULLs do not count; equal frequencies go to the smallest value. A column
    with fewer distinct values gives those it has, an empty one none.

    The first pass makes a summary per task and adds them up: a value that it does not list occurs at most
    2 * ERROR / tracked of the rows. The second pass counts the listed values and nothing else, so one
    small partial row per listed value and task is shuffled. If the n-th count is above that bound, no
    other value can come before it. Otherwise the next, larger summary is tried, and for columns without
    frequent values at last all are grouped, by digest.
    """
    spark = df.sparkSession
    result, left = None, list(columns)
    for size in [*tracked, None]:
        if not left:
            break
        long, bounds = _long(df, left), dict.fromkeys(left, 0.0)
        if size is not None:
            listed = _candidates(df, left, size)
            # No more rows than the summary tracks values: all are listed.
            bounds = {c: 2 * ERROR * rows / size if rows > size else 0.0 for c, (rows, _) in listed.items()}
            rows = [(c, h) for c, (_, items) in listed.items() for h in items]
            # At most columns x tracked pairs of a name and a number.
            long = long.join(F.broadcast(spark.createDataFrame(rows, "column string, h1 long")), ["column", "h1"], "left_semi")
        counts = long.groupBy("column", "h1", "h2").agg(F.count(F.lit(1)).alias("freq"))
        settled, open_columns = [], []
        for c in left:
            top = counts.where(F.col("column") == c).orderBy(F.desc("freq")).limit(n).select("freq").collect()
            least = top[-1]["freq"] if len(top) == n else 0
            if least > bounds[c] or bounds[c] == 0.0:
                settled.append((c, max(least, 1)))
            else:
                open_columns.append(c)
        for c, least in settled:
            winners = counts.where((F.col("column") == c) & (F.col("freq") >= least)).select("h1", "h2", "freq")
            # Above the bound, or among so few rows, are fewer values than the summary tracks.
            part = _named(df, c, winners if size is None else F.broadcast(winners), n)
            result = part if result is None else result.union(part)
        left = open_columns
    return result if result is not None else spark.createDataFrame([], "column string, value string, freq long")


def _named(df: DataFrame, column: str, counts: DataFrame, n: int) -> DataFrame:
    """The n first of the counted digests of a column, with their values."""
    one, two = digests(_text(column))
    rows = df.select(_text(column).alias("value"), one.alias("h1"), two.alias("h2")).join(counts, ["h1", "h2"])
    return rows.select(F.lit(column).alias("column"), "value", "freq").distinct().orderBy(F.desc("freq"), "value").limit(n)


def text_tops(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column with values: ``column, unique, freq, top``, all exact; equal frequencies go to the smallest value.

    Distinct values are counted by digest, 16 bytes in the shuffle whatever the texts' length. Their texts
    are looked up afterwards: the one of the winner, or of the winners where frequencies are equal.
    """
    spark = df.sparkSession
    counts = _long(df, columns).groupBy("column", "h1", "h2").agg(F.count(F.lit(1)).alias("freq"))
    # Per frequency: how many digests have it, and one of them where it is the only one.
    by_freq = counts.groupBy("column", "freq").agg(F.count(F.lit(1)).alias("n"), F.min("h1").alias("h1"), F.min("h2").alias("h2"))
    found = by_freq.groupBy("column").agg(F.sum("n").alias("unique"), F.max("freq").alias("freq"),
                                          *[F.max_by(a, "freq").alias(a) for a in ("n", "h1", "h2")]).collect()
    tops = None
    for row in found:
        c = row["column"]
        one, two = digests(_text(c))
        values = df.select(_text(c).alias("top"), one.alias("h1"), two.alias("h2")).where("top IS NOT NULL")
        if row["n"] == 1:
            values = values.where((F.col("h1") == row["h1"]) & (F.col("h2") == row["h2"])).limit(1)
        elif row["n"] < row["unique"]:
            equal = _long(df, [c]).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") == row["freq"])
            values = values.join(equal.select("h1", "h2"), ["h1", "h2"], "left_semi")
        part = values.select(F.lit(c).alias("column"), F.lit(row["unique"]).alias("unique"), F.lit(row["freq"]).alias("freq"), "top").orderBy("top").limit(1)
        tops = part if tops is None else tops.union(part)
    return tops if tops is not None else spark.createDataFrame([], "column string, unique long, freq long, top string")

"""Frequent values, allowed values, exact splits with repeated keys."""

import collections
import math
import random

import pytest
from pyspark.sql import functions as F

from tablewright.operators import frequent, membership, profile, quality, split
from tablewright.operators.quality import Expectation


def brute_tops(values, n):
    counts = collections.Counter(v for v in values if v is not None)
    return sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:n]


@pytest.mark.parametrize("tracked", [(4, 16), frequent.TRACKED])
def test_frequent_values_are_exact(spark, tracked):
    rnd = random.Random(1)
    skewed = [rnd.choice("aabbbbbcé") if rnd.random() < 0.6 else f"rare {k}" for k in range(3000)]
    few = [rnd.choice(["x", "y", None]) for _ in range(3000)]
    distinct = [f"v{k}" for k in range(3000)]
    rows = list(zip(skewed, few, distinct, [None] * 3000))
    frame = spark.createDataFrame(rows, "skewed string, few string, `dis.tinct` string, empty string").repartition(5)
    for n in (1, 3):
        got = collections.defaultdict(list)
        for r in frequent.frequent_values(frame, frame.columns, n, tracked).collect():
            got[r["column"]].append((r["value"], r["freq"]))
        for i, c in enumerate(frame.columns):
            assert sorted(got[c], key=lambda x: (-x[1], x[0])) == brute_tops([r[i] for r in rows], n)


def test_only_listed_values_are_counted(spark):
    """With a frequent value the grouping of all values is never run."""
    frame = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("v"))
    listed = frequent._candidates(frame, ["v"], 4096)["v"]
    assert listed[0] == 200_000 and len(listed[1]) < 10
    row = frequent.frequent_values(frame, ["v"], tracked=(4096,)).collect()
    assert [tuple(r) for r in row] == [("v", "hot", 66_667)]


def test_text_tops_without_sorted_aggregation(spark):
    rows = [("b", "x", None), ("a", "x", None), ("b", "y", None), ("a", "z", None), (None, "w" * 70_000, None)]
    frame = spark.createDataFrame(rows, "tie string, one string, none string")
    got = {r["column"]: (r["unique"], r["freq"], r["top"]) for r in frequent.text_tops(frame, frame.columns).collect()}
    assert got == {"tie": (2, 2, "a"), "one": (4, 2, "x")}
    plan = frequent.text_tops(frame, ["tie", "one"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    whole = {r["column"]: r for r in profile.summary(frame).collect()}
    assert (whole["none"]["unique"], whole["none"]["top"], whole["tie"]["top"]) == (0, None, "a")


def test_top_labels_by_summary(spark):
    frame = spark.createDataFrame([("['a'; 'b']",), ("['b'; 'c']",), ("['d'; 'b']",), (None,)], "l string")
    for few in (True, False):
        assert [tuple(r) for r in profile.top_labels(frame, "l", 2, few=few).orderBy(F.desc("count"), "label").collect()] == [("b", 3), ("a", 1)]


# --- allowed values ------------------------------------------------------------------------

def test_allowed_values_in_the_report(spark):
    frame = spark.createDataFrame([("a", 1, 1.0), ("b", 2, float("nan")), (None, 3, 2.5), ("c", None, 9.0), ("c", 2, None)], "s string, i int, x double")
    tables = {"s": spark.createDataFrame([("a", "more"), ("b", ""), (None, "")], "v string, note string"),
              "i": spark.createDataFrame([(1,), (2,)], "v long"), "x": spark.createDataFrame([("1.0",), ("2.5",), ("odd",)], "v string")}
    lists = {"s": ["a", "b"], "i": [1, 2], "x": [1.0, 2.5]}
    for allowed in (tables, lists):
        report = quality.validate(frame, [Expectation(c, required=False, allowed=allowed[c]) for c in "six"])
        assert {c: d.get("not_allowed") for c, d in report.details.items()} == {"s": 2, "i": 1, "x": 1}
        assert "Column 's' has 2 values that are not allowed" in report.errors and report.result == "fail"
        assert {r["column"]: r["not_allowed"] for r in report.table(spark).collect()} == {"s": 2, "i": 1, "x": 1}
        assert report.document(spark).first()["details"]["i"]["not_allowed"] == 1
    missing = quality.validate(frame, [Expectation("gone", allowed=tables["s"]), Expectation("s", "int", allowed=tables["s"])])
    assert len(missing.errors) == 2 and "not_allowed" not in missing.details["s"]


def test_allowed_values_by_configuration(spark, tmp_path):
    spark.createDataFrame([("a",)], "v string").write.parquet(str(tmp_path / "allowed"))
    frame = spark.createDataFrame([("a",), ("b",)], "s string")
    for value in (["a"], str(tmp_path / "allowed")):
        config = {"data_validation": {"schema": {"columns": [{"name": "s", "dtype": "str", "allowed_values": value}]}}}
        assert quality.validate_config(frame, config).details["s"]["not_allowed"] == 1
    plain = quality.validate_config(frame, {"data_validation": {"schema": {"columns": [{"name": "s"}]}}})
    assert "not_allowed" not in plain.table(spark).columns


@pytest.mark.parametrize("most", [1, 1 << 20])
def test_membership_of_many_values(spark, monkeypatch, most):
    """Exact whatever the filter lets through; with enough blocks it lets few through."""
    monkeypatch.setattr(membership, "MOST_BLOCKS", most)
    allowed = spark.range(0, 30_000, 3).toDF("v")
    frame = spark.range(40_000).select(F.when(F.col("id") % 5 == 0, F.lit(1)).otherwise(F.col("id")).alias("v"))
    values = [1 if k % 5 == 0 else k for k in range(40_000)]
    assert membership.count_not_in(frame, "v", allowed) == sum(v % 3 != 0 or v >= 30_000 for v in values)
    assert membership.count_not_in(frame, "v", allowed.limit(0)) == 40_000 and membership.count_not_in(frame.limit(0), "v", allowed) == 0
    if most > 1:
        blocks = 512
        hashed = allowed.select(F.xxhash64(F.col("v").cast("string")).alias("h"))
        bloom = membership.bloom_filter(hashed, blocks)
        seen = membership.may_hold(hashed, bloom, blocks).where("possible").count()
        other = membership.may_hold(spark.range(10**6, 10**6 + 10_000).select(F.xxhash64(F.col("id").cast("string")).alias("h")), bloom, blocks)
        assert seen == 10_000 and other.where("possible").count() < 500


# --- splits --------------------------------------------------------------------------------

def test_repeated_keys_are_split_exactly(spark):
    rows = [("hot", 7, None)] * 300 + [("hot", k, "x") for k in range(100)] + [(f"k{k % 40}", k, "y") for k in range(500)] + [(None, 1, None)] * 50
    frame = spark.createDataFrame(rows, "key string, v int, t string")
    whole = collections.Counter(rows)
    results = []
    for size in (0.001, 0.1, 0.37, 0.5, 0.8, 0.999, 1.0):
        for parts in (3, 8):
            rest, part = split.split_rows(frame.repartition(parts), "key", size)
            got = collections.Counter(tuple(r) for r in part.collect())
            left = collections.Counter(tuple(r) for r in rest.collect())
            assert sum(got.values()) == math.ceil(len(rows) * size) and got + left == whole
            results.append((size, got))
    for (size, a), (_, b) in zip(results[::2], results[1::2]):
        assert a == b, size
    rest, part = split.holdout(frame, "key", 0.3, whole_keys=False)
    assert part.count() == math.ceil(0.3 * len(rows))
    train, test = split.train_test(frame, "key", 0.25, whole_keys=False)
    assert test.count() == math.ceil(0.25 * len(rows)) and train.count() == len(rows) - test.count()
    empty = split.split_rows(frame.limit(0), "key", 0.5)
    assert empty[0].count() == empty[1].count() == 0
    # Unique keys: the same rows as the split by whole keys.
    unique = spark.range(200)
    assert split.split_rows(unique, "id", 0.2)[1].exceptAll(split.split_exact(unique, "id", 0.2)[1]).count() == 0

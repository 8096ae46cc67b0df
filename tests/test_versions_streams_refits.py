"""Concurrent versions, quality of streams over restarts, refits that read one version."""

import threading

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright.operators import incremental, quality, regression
from tablewright.operators.quality import Expectation
from tablewright.sources import sinks
from tablewright.streaming.quality import stream_report, watch_quality
from tablewright.streaming.scoring import open_stream


def test_concurrent_writers_get_different_versions(spark, tmp_path):
    root, found, errors = str(tmp_path), {}, []

    def write(k):
        try:
            found[k] = sinks.publish(spark.range(k * 10, k * 10 + 10), root, "data")
        except Exception as error:  # noqa: BLE001 - looked at below
            errors.append(error)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and sorted(found.values()) == [1, 2, 3, 4, 5, 6]
    for k, version in found.items():
        rows = sinks.read_dataset(spark, root, f"data:{version}").collect()
        assert sorted(r["id"] for r in rows) == list(range(k * 10, k * 10 + 10))


@pytest.mark.parametrize("local", [True, False])
def test_a_lost_race_is_tried_again(spark, tmp_path, monkeypatch, local):
    """Another writer takes the number between looking and claiming; both ways of claiming."""
    root = str(tmp_path)
    if not local:
        monkeypatch.setattr(sinks.os, "link", None)
        claim = sinks._claim

        def renamed(spark, folder, number, data):
            files, ours = sinks._files(spark, f"{folder}/{sinks.MANIFESTS}/.{data}")
            out = files.create(ours, True)
            out.write(data.encode())
            out.close()
            target = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{sinks.MANIFESTS}/{number}")
            return sinks._rename_new(spark, files, ours, target)

        assert claim is not renamed
        monkeypatch.setattr(sinks, "_claim", renamed)
    assert sinks.publish(spark.range(1), root, "d") == 1
    looked = sinks._numbers
    monkeypatch.setattr(sinks, "_numbers", lambda *a: looked(*a) - {1} if not getattr(looked, "done", False) and not setattr(looked, "done", True) else looked(*a))
    assert sinks.publish(spark.range(2), root, "d") == 2
    assert [sinks.read_dataset(spark, root, f"d:{v}").count() for v in (1, 2)] == [1, 2]


def test_unfinished_versions_are_not_seen(spark, tmp_path):
    root = str(tmp_path)
    spark.range(5).write.parquet(f"{root}/d/data-crashed")
    assert sinks.dataset_versions(spark, root, "d") == []
    with pytest.raises(FileNotFoundError):
        sinks.read_dataset(spark, root, "d")
    (tmp_path / "d" / sinks.MANIFESTS).mkdir()
    (tmp_path / "d" / sinks.MANIFESTS / ".data-half").write_text("dat")
    assert sinks.publish(spark.range(3), root, "d") == 1 and sinks.read_dataset(spark, root, "d:latest").count() == 3


def test_only_the_last_versions_stay(spark, tmp_path):
    root = str(tmp_path)
    for k in range(1, 5):
        assert sinks.publish(spark.range(k), root, "d", keep=2) == k
    assert sinks.dataset_versions(spark, root, "d") == [3, 4]
    assert sinks.read_dataset(spark, root, "d:3").count() == 3 and len(list((tmp_path / "d").glob("data-*"))) == 2
    with pytest.raises(FileNotFoundError):
        sinks.read_dataset(spark, root, "d:1")
    with pytest.raises(ValueError):
        sinks.publish(spark.range(1), root, "d", keep=0)


# --- streams -------------------------------------------------------------------------------

EXPECT = [Expectation("id", "int", min=3), Expectation("x", "float", max=5.0, required=False), Expectation("s", "str", allowed=["a", "b"]),
          Expectation("gone", "str"), Expectation("s2", "int")]


def part(spark, first, n):
    return spark.range(first, first + n).select(
        F.col("id"), F.when(F.col("id") % 4 != 0, F.col("id") / 2.0).alias("x"), F.element_at(F.array(*map(F.lit, "abc")), (F.col("id") % 3 + 1).cast("int")).alias("s"),
        F.lit("t").alias("s2"))


def test_stream_counts_equal_the_batch_report_over_restarts(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    template = part(spark, 0, 0)
    assert stream_report(spark, out, template, EXPECT)[1] == 0
    for step, (first, n) in enumerate(((0, 10), (10, 7), (17, 13))):
        part(spark, first, n).repartition(2).write.mode("append").parquet(source)
        stream = open_stream(spark, source, template.schema, maxFilesPerTrigger=1)
        watch_quality(stream, EXPECT, out, checkpoint).awaitTermination()
        report, rows = stream_report(spark, out, template, EXPECT)
        whole = quality.validate(spark.read.parquet(source), EXPECT)
        assert rows == first + n and report.details == whole.details and report.errors == whole.errors and report.warnings == whole.warnings
    # Nothing new: the counts stay.
    watch_quality(open_stream(spark, source, template.schema), EXPECT, out, checkpoint).awaitTermination()
    assert stream_report(spark, out, template, EXPECT)[1] == 30
    with pytest.raises(ValueError):
        watch_quality(stream, [Expectation("s", allowed=spark.range(1))], out, checkpoint)


def test_a_failed_batch_counts_once(spark, tmp_path, monkeypatch):
    """The sink fails after the state has moved on; the restarted query writes the same batch again."""
    from pyspark.errors import StreamingQueryException
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    part(spark, 0, 12).coalesce(1).write.parquet(source)
    stream = open_stream(spark, source, part(spark, 0, 0).schema)
    broken = "/proc/none/out"
    with pytest.raises(StreamingQueryException):
        watch_quality(stream, EXPECT, broken, checkpoint).awaitTermination()
    watch_quality(stream, EXPECT, out, checkpoint).awaitTermination()
    report, rows = stream_report(spark, out, stream, EXPECT)
    assert rows == 12 and report.details == quality.validate(spark.read.parquet(source), EXPECT).details


# --- refits --------------------------------------------------------------------------------

def data(n, seed, offset=0.0):
    rng = np.random.default_rng(seed)
    x = pd.DataFrame(rng.normal(size=(n, 4)) + offset, columns=list("abcd"))
    x["y"] = 2 * x["a"] - x["b"] + rng.normal(size=n)
    x.loc[rng.random(n) < 0.05, "c"] = np.nan
    return x


def test_moments_add_and_take_away(spark):
    parts = [regression.moments(spark.createDataFrame(data(n, s, o)), list("abcdy")) for n, s, o in ((200, 1, 0), (50, 2, 1e5), (300, 3, -10))]
    whole = regression.moments(spark.createDataFrame(pd.concat([data(200, 1), data(50, 2, 1e5), data(300, 3, -10)])), list("abcdy"))
    total = incremental.add(incremental.add(parts[0], parts[1]), parts[2])
    assert (total.n, total.rows_dropped) == (whole.n, whole.rows_dropped)
    assert np.allclose(total.mean, whole.mean) and np.allclose(total.comoment, whole.comoment, rtol=1e-9)
    back = incremental.take_away(total, parts[1])
    other = incremental.add(parts[0], parts[2])
    assert (back.n, back.rows_dropped) == (other.n, other.rows_dropped)
    assert np.allclose(back.mean, other.mean, rtol=1e-9, atol=1e-8)
    assert np.allclose(back.comoment, other.comoment, rtol=1e-4, atol=1e-2)
    none = incremental.take_away(parts[0], parts[0])
    assert none.n == 0 and incremental.add(none, parts[1]).n == parts[1].n and incremental.take_away(parts[0], none).n == parts[0].n
    stored = incremental.moments_from_frame(incremental.moments_frame(spark, total))
    assert stored.columns == total.columns and np.array_equal(stored.comoment, total.comoment) and np.array_equal(stored.mean, total.mean)
    with pytest.raises(ValueError):
        incremental.take_away(parts[1], parts[0])
    with pytest.raises(ValueError):
        incremental.add(parts[0], regression.moments(spark.createDataFrame(data(9, 1)), ["a", "y"]))


def test_refit_reads_one_version_more(spark, tmp_path):
    root, state = str(tmp_path / "sets"), str(tmp_path / "state")
    frames = [data(150, s, s / 10) for s in range(4)]
    for k, frame in enumerate(frames[:3]):
        sinks.publish(spark.createDataFrame(frame), root, "rows")
    model, read = incremental.refit(spark, root, "rows", "y", list("abcd"), state)
    assert read == [1, 2, 3]
    sinks.publish(spark.createDataFrame(frames[3]), root, "rows")
    model, read = incremental.refit(spark, root, "rows", "y", list("abcd"), state)
    assert read == [4]
    whole = regression.train(regression.moments(spark.createDataFrame(pd.concat(frames)), [*"abcd", "y"]), "y", list("abcd"))
    assert model.features == whole.features and model.n == whole.n
    assert np.allclose(model.coefficients, whole.coefficients, rtol=1e-9) and np.allclose(model.p_values(), whole.p_values(), rtol=1e-6)
    part, read = incremental.refit(spark, root, "rows", "y", list("abcd"), state, versions=[2, 4], select=False)
    want = regression.fit(regression.moments(spark.createDataFrame(pd.concat([frames[1], frames[3]])), [*"abcd", "y"]), "y", list("abcd"))
    assert read == [] and np.allclose(part.coefficients, want.coefficients, rtol=1e-9)
    with pytest.raises(FileNotFoundError):
        incremental.refit(spark, root, "none", "y", ["a"], state)

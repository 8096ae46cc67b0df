import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.prep import ColumnTransform, Preprocessor
from tablewright.schema import TRACK_SCHEMA, with_row_key
from tablewright.session import materialize, shared_folder
from tablewright.sources import sinks, tables


def write_csv(tmp_path, text, name="t.csv"):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_quoted_fields_and_missing_spellings(spark, tmp_path):
    path = write_csv(tmp_path, 'a,b,c\n1,"x, y",1.5\n2,"say ""hi""",NaN\n3,N/A,\n')
    rows = tables.read_delimited(spark, path).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(1, "x, y", 1.5), (2, 'say "hi"', None), (3, None, None)]


def test_other_delimiter_without_header(spark, tmp_path):
    path = write_csv(tmp_path, "1;x\n2;y\n")
    df = tables.read_delimited(spark, path, delimiter=";", header=None)
    assert df.count() == 2 and len(df.columns) == 2


@pytest.mark.parametrize("path", ["", None])
def test_no_path(spark, path):
    with pytest.raises(ValueError):
        tables.read_delimited(spark, path)


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_delimited(spark, str(tmp_path / "none.csv"))


def test_load_table_resolves_against_base_dir(spark, tmp_path):
    write_csv(tmp_path, "a,b\n1,2\n", "raw.csv")
    config = {"data_source": {"type": "csv", "raw_path": "raw.csv"}}
    assert tables.load_table(spark, config, base_dir=str(tmp_path)).collect()[0].asDict() == {"a": 1, "b": 2}


@pytest.mark.parametrize("source", [{"type": "json", "raw_path": "x"}, {"type": "csv"}, {}])
def test_load_table_bad_config(spark, source):
    with pytest.raises(ValueError):
        tables.load_table(spark, {"data_source": source})


def test_load_config_yaml_and_json(tmp_path):
    (tmp_path / "c.json").write_text('{"target": "y"}')
    assert tables.load_config(str(tmp_path / "c.json")) == {"target": "y"}
    pytest.importorskip("yaml")
    (tmp_path / "c.yaml").write_text("target: y\n")
    assert tables.load_config(str(tmp_path / "c.yaml")) == {"target": "y"}


def test_track_schema_has_19_columns():
    assert len(TRACK_SCHEMA) == 19 and TRACK_SCHEMA["track_popularity"].dataType.simpleString() == "int"


def test_versions_and_latest(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        sinks.read_dataset(spark, root, "raw:latest")
    assert sinks.publish(spark.range(3), root, "raw") == 1
    assert sinks.publish(spark.range(5), root, "raw") == 2
    (tmp_path / "raw" / "version=3").mkdir()          # an unfinished write does not count
    assert sinks.read_dataset(spark, root, "raw:latest").count() == 5
    assert sinks.read_dataset(spark, root, "raw:v1").count() == 3
    with pytest.raises(FileNotFoundError):
        sinks.read_dataset(spark, root, "raw:9")


def test_column_list_keeps_order(spark, tmp_path):
    names = ["z", "a", "m_pow2"]
    path = sinks.write_column_list(spark, names, str(tmp_path / "list"))
    assert sinks.read_column_list(spark, path) == names


def test_metrics_document_keeps_undefined(spark, tmp_path):
    frame = sinks.metrics_frame(spark, {"mse": 1.5, "adj_r2": float("nan")})
    path = sinks.write_document(frame, str(tmp_path / "m"))
    assert spark.read.json(path, schema=frame.schema).first().asDict() == {"mse": 1.5, "adj_r2": None}


def test_parameter_store_roundtrip(spark, tmp_path):
    fitted = Preprocessor((ColumnTransform("b", 1.0, 2.0, 3.0), ColumnTransform("a", None, 0.0, 1.0)))
    path = sinks.write_table(fitted.frame(spark), str(tmp_path / "p"))
    assert Preprocessor.from_frame(spark.read.parquet(path)) == fitted


def test_stored_columns_check(spark, tmp_path):
    path = sinks.write_table(spark.range(2).withColumn("x", F.lit(1.0)), str(tmp_path / "f"))
    sinks.require_columns_stored(spark, path, ["x"])
    with pytest.raises(ValueError, match="y"):
        sinks.require_columns_stored(spark, path, ["x", "y"])


def test_shared_folder_reads_the_session_setting(spark, shared):
    a, b = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert a.startswith(shared) and a != b


class _Session:
    """Stands in for a session with the given settings."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, key, default):
        return self.settings.get(key.rpartition(".")[2] if key == "spark.master" else "dir", default)


def test_shared_folder_refuses_local_fallback_on_a_cluster():
    with pytest.raises(RuntimeError):
        shared_folder(_Session(master="spark://host:7077"), "x")
    assert shared_folder(_Session(master="local[4]"), "x")


def test_materialize_keeps_rows_and_schema(spark):
    df = spark.range(10).withColumn("s", F.lit(None).cast("string"))
    copy = materialize(df)
    assert copy.schema.simpleString() == df.schema.simpleString() and copy.count() == 10


def test_row_key_depends_on_content_only(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, 1.5), (1, "a", None)], "i int, s string, d double")
    one = sorted(r.row_key for r in with_row_key(df.repartition(1)).collect())
    many = sorted(r.row_key for r in with_row_key(df.repartition(3)).collect())
    assert one == many and len(set(one)) == 2


def test_publish_goes_on_after_a_crashed_write(spark, tmp_path):
    root = str(tmp_path)
    table = spark.range(3)
    assert sinks.publish(table, root, "data") == 1
    # A write that never committed leaves its folder, here and where no version is committed yet.
    for name, version in (("data", 2), ("fresh", 1)):
        table.write.parquet(f"{root}/{name}/version={version}")
        (tmp_path / name / f"version={version}" / "_SUCCESS").unlink()
    assert sinks.publish(table, root, "data") == 3
    assert sinks.publish(table, root, "fresh") == 2
    assert sinks.read_dataset(spark, root, "fresh").count() == 3
    with pytest.raises(FileNotFoundError):
        sinks.read_dataset(spark, root, "data:2")


def test_types_are_found_after_missing_spellings(spark, tmp_path):
    path = write_csv(tmp_path, "a,b,c,d,e,f,g\n1.5,NA,true,2020-01-02,x,9999999999,1\nNA,3,False,NULL,7,1,\n2.5,4,n/a,2021-03-04,,2,\n")
    df = tables.read_delimited(spark, path)
    assert [f.dataType.simpleString() for f in df.schema] == ["double", "int", "boolean", "date", "string", "bigint", "int"]
    assert [r["a"] for r in df.collect()] == [1.5, None, 2.5]


def test_bad_fields_stop_become_null_or_are_named(spark, tmp_path):
    path = write_csv(tmp_path, "a,b\n1,x\noops,y\nNA,z\n3.5,w\n")
    schema = T.StructType().add("a", "integer").add("b", "string")
    with pytest.raises(Exception, match="oops|3.5"):
        tables.read_delimited(spark, path, schema=schema).collect()
    assert [r["a"] for r in tables.read_delimited(spark, path, schema=schema, bad_fields="null").collect()] == [1, None, None, None]
    named = tables.read_delimited(spark, path, schema=schema, bad_fields="column")
    assert [r[tables.BAD_FIELDS] for r in named.collect()] == [[], ["a"], [], ["a"]]
    assert [tuple(r) for r in tables.count_bad_fields(named).collect()] == [("a", 2)]


def test_a_bad_field_stops_whatever_is_read(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,2\noops,3\n")
    schema = "a long, b long"
    kinds = spark.createDataFrame([], schema).schema
    table = tables.read_delimited(spark, str(tmp_path / "t.csv"), schema=kinds)
    for use in (lambda: table.count(), lambda: table.select("b").collect(), lambda: table.where("b > 2").select("b").collect(),
                lambda: table.agg({"b": "max"}).collect(), lambda: table.collect()):
        with pytest.raises(Exception, match="column 'a' of type bigint has the field: oops"):
            use()
    (tmp_path / "t.csv").write_text("a,b\n1,2\nNA,3\n")
    fine = tables.read_delimited(spark, str(tmp_path / "t.csv"), schema=kinds)
    assert fine.count() == 2 and sorted(r["b"] for r in fine.select("b").collect()) == [2, 3]

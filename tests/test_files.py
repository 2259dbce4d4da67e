import datetime as dt

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F, types as T

from zoneferry.operators import reports
from zoneferry.session import delete_path, fresh_dir, shared_dir, stage, staged
from zoneferry.sources import files

NESTED = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("at", T.TimestampType(), True, {"note": "kept"}),
        T.StructField("who", T.StructType([T.StructField("name", T.StringType(), False)]), False),
        T.StructField("tags", T.ArrayType(T.StringType(), False), False),
        T.StructField(
            "lines",
            T.ArrayType(T.StructType([T.StructField("n", T.IntegerType(), False)]), False),
            False,
        ),
        T.StructField("more", T.MapType(T.StringType(), T.StringType(), False), False),
    ]
)


def test_relax_primitive_fields_only():
    relaxed = files.relax(NESTED)
    assert relaxed["id"].nullable and relaxed["at"] == NESTED["at"]
    assert not relaxed["who"].nullable and relaxed["who"].dataType["name"].nullable
    assert relaxed["tags"] == NESTED["tags"] and relaxed["more"] == NESTED["more"]
    assert not relaxed["lines"].nullable and not relaxed["lines"].dataType.containsNull
    assert relaxed["lines"].dataType.elementType["n"].nullable
    assert files.relax(relaxed) == relaxed


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_old_and_new_files_read_as_one(spark, fmt):
    old, new = fresh_dir(spark, "old"), fresh_dir(spark, "new")
    spark.createDataFrame([(1, "a")], "id long, s string").write.format(fmt).save(old)
    spark.createDataFrame([(2, "b", 3)], "id long, s string, added int").write.format(fmt).save(new)
    schema = T.StructType(
        [
            T.StructField("added", T.IntegerType(), False),
            T.StructField("id", T.LongType(), False),
            T.StructField("s", T.StringType(), False),
        ]
    )
    rows = files.read_conformed(spark, [old, new], schema, fmt).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(None, 1, "a"), (3, 2, "b")]


def test_conform_by_name(spark):
    schema = T.StructType(
        [T.StructField("n", T.IntegerType()), T.StructField("d", T.DateType()), T.StructField("s", T.StringType())]
    )
    df = spark.createDataFrame([("2024-01-02", "7")], "D string, n string")
    got = files.conform(df, schema)
    assert got.schema == schema
    assert tuple(got.first()) == (7, dt.date(2024, 1, 2), None)


def test_odd_names_and_untyped_nulls(spark):
    df = spark.createDataFrame([("7", 1)], "`a.b` string, `c d` int").withColumn("e.f", F.lit(None))
    schema = T.StructType([T.StructField("c d", T.LongType()), T.StructField("a.b", T.IntegerType())])
    assert tuple(files.conform(df.drop("e.f"), schema).first()) == (1, 7)
    with staged(df) as copy:
        assert tuple(copy.first()) == ("7", 1, None)


def test_conform_refuses_what_does_not_fit(spark):
    number = T.StructType([T.StructField("n", T.IntegerType())])
    with pytest.raises(PySparkException):
        files.conform(spark.createDataFrame([("x",)], "n string"), number).collect()
    required = T.StructType([T.StructField("n", T.IntegerType(), False)])
    with pytest.raises(AnalysisException):
        files.conform(spark.createDataFrame([(1,)], "m int"), required)


def test_two_key_csv_with_quotes(spark):
    path = fresh_dir(spark, "keys")
    with_header = ["k1,k2", '"a,1",2', " b , 3 ", '"say ""hi""",4']
    spark.createDataFrame([(l,) for l in with_header], "l string").coalesce(1).write.text(path)
    got = {tuple(r) for r in files.read_keys(spark, path, ["k1", "k2"], "csv").collect()}
    assert got == {("a,1", "2"), ("b", "3"), ('say "hi"', "4")}


def test_csv_keys_come_back_as_they_were(spark):
    keys = ["a\nb", "a\r\nb", "\\N", "\\\\N", "\\n", "\\\n", 'q"', "a,b", "x y", "", "\\", "c:\\new", None]
    path = fresh_dir(spark, "keys")
    reports.export_keys(spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, n int"), path, "csv")
    back = files.read_keys(spark, path, ["k", "n"], "csv").collect()
    assert [r.k for r in sorted(back, key=lambda r: int(r.n))] == keys


def test_staged_copy_is_removed_and_stage_is_not(spark):
    df = spark.range(3)
    with staged(df) as copy:
        path = copy.inputFiles()[0].rsplit("/", 1)[0]
        assert path.startswith("file://" + shared_dir(spark).removeprefix("file:"))
        assert copy.count() == 3
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)
    kept = stage(df)
    assert kept.count() == 3
    delete_path(spark, kept.inputFiles()[0].rsplit("/", 1)[0])


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


class NoSharedFolder:
    """A session that names no shared folder."""

    class conf:
        @staticmethod
        def get(key, default):
            return default

    def __init__(self, master):
        self.sparkContext = type("Context", (), {"master": master})


@pytest.mark.parametrize("master", ["yarn", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(NoSharedFolder(master))


def test_a_single_process_falls_back_to_one_temporary_folder():
    first = shared_dir(NoSharedFolder("local[2]"))
    assert first == shared_dir(NoSharedFolder("local")) and "zoneferry" in first

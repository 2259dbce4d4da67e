import datetime as dt
import glob

import pytest
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import functions as F

from zoneferry.operators import reports
from zoneferry.plans import jobs
from zoneferry.plans.scratch import scratch
from zoneferry.session import fresh_dir, setting
from zoneferry.sources import files


def parts(path):
    return sorted(glob.glob(path + "/part-*"))


def text(path):
    return "".join(open(p).read() for p in parts(path))


def test_report_is_one_quoted_file_without_header(spark):
    path = fresh_dir(spark, "report")
    df = spark.createDataFrame([(1, ' a "q", b '), (2, None)], "n int, t string").repartition(4)
    for _ in range(2):
        assert reports.write_report(df, path, ["n"]) == 2
    assert len(parts(path)) == 1
    assert text(path) == '"1"," a ""q"", b "\n"2",""\n'


def test_large_report_is_several_files_in_order(spark, monkeypatch):
    monkeypatch.setattr(reports, "FILE_BYTES", (reports.FILE_BYTES[0], "20k"))
    df = spark.range(0, 20_000, 1, 4).select("id", F.sha1(F.col("id").cast("string")).alias("h"))
    path = fresh_dir(spark, "report")
    with setting(spark, "spark.sql.adaptive.coalescePartitions.minPartitionSize", "10k"):
        assert reports.write_report(df, path, ["id"]) == 20_000
    assert len(parts(path)) > 1
    ids = [int(line.split('"')[1]) for line in text(path).splitlines()]
    assert ids == list(range(20_000))


def test_unordered_report_is_one_file_and_empty_report_has_no_rows(spark):
    path = fresh_dir(spark, "report")
    assert reports.write_report(spark.range(0, 100, 1, 8), path) == 100
    assert len(parts(path)) == 1
    assert reports.write_report(spark.range(0), path) == 0
    assert text(path) == ""


@pytest.mark.parametrize("n", [1, 2, 11])
def test_bundle_manifest(spark, n):
    folder = fresh_dir(spark, "bundle")
    specs = [reports.Report(f"r{i}.csv", f"SELECT * FROM range({i})") for i in range(n)]
    entries = jobs.burst_reports(
        spark, specs, folder, control_file="control",
        start=F.lit("2024-01-01").cast("date"), end=F.lit("2024-01-31").cast("date"),
    )
    day = dt.date(2024, 1, 1)
    assert [tuple(r) for r in entries.orderBy("position").collect()] == [
        (f"r{i}.csv", i + 1, i, day, day.replace(day=31)) for i in range(n)
    ]
    names = ",".join(f"r{i}.csv" for i in range(n))
    assert text(folder + "/control") == f"file_names: {names}\nstrt_date: 2024-01-01\nend_date: 2024-01-31\n"


def test_bundle_without_control_file(spark):
    folder = fresh_dir(spark, "bundle")
    assert jobs.burst_reports(spark, [reports.Report("a", "SELECT 1")], folder) is None
    with pytest.raises(ValueError):
        jobs.burst_reports(spark, [], folder, control_file="c")


KEYS = [("",), (None,), ('a"b,c',), (" x ",), ("o'k",), ("o'k",)]


def test_csv_keys_survive(spark):
    path = fresh_dir(spark, "keys")
    reports.export_keys(spark.createDataFrame(KEYS, "k string"), path, "csv")
    assert all(open(p).readline() == "k\n" for p in parts(path))
    got = {r.k for r in files.read_keys(spark, path, ["k"], "csv").collect()}
    assert got == {"", None, 'a"b,c', "x", "o'k"}


def test_parquet_keys_are_exact(spark):
    path = fresh_dir(spark, "keys")
    reports.export_keys(spark.createDataFrame(KEYS, "k string"), path)
    assert {r.k for r in files.read_keys(spark, path, ["k"]).collect()} == {k for k, in KEYS}


def test_empty_key_list(spark):
    for fmt in ("csv", "parquet"):
        path = fresh_dir(spark, "keys")
        reports.export_keys(spark.createDataFrame([], "k string"), path, fmt)
        assert files.read_keys(spark, path, ["k"], fmt).isEmpty()


def test_adhoc_select_insert_and_ddl(spark):
    with scratch(spark, "adhoc") as s:
        folder = s.path("results")
        s.sink("t", "x bigint")
        insert = "INSERT INTO {db}.t SELECT id FROM range(:n)"
        assert reports.adhoc_query(spark, insert, folder, "r1", {"db": s.db}, {"n": 3}) is None
        path = reports.adhoc_query(spark, "SELECT * FROM {db}.t ORDER BY x", folder, "r2", {"db": s.db})
        assert text(path) == "0\n1\n2\n"
        with pytest.raises(AnalysisException):
            reports.adhoc_query(spark, "SELECT 1", folder, "r2")
        with pytest.raises((AnalysisException, ParseException)):
            reports.adhoc_query(spark, "SELEC 1", folder, "r3")
        assert reports.adhoc_query(spark, "DROP TABLE {db}.t", folder, "r4", {"db": s.db}) is None


def test_ties_in_the_order_are_spread(spark):
    df = spark.range(0, 40_000, 1, 8).select(
        (F.col("id") % 2 * 0).alias("k"), F.lit("copy").alias("v")
    )
    path = fresh_dir(spark, "report")
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        assert reports.write_report(df, path, ["k"]) == 40_000
    assert len([p for p in parts(path) if open(p).read()]) > 2
    assert text(path).count("\n") == 40_000

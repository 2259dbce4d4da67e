import pytest
from pyspark.sql import functions as F

from zoneferry.operators import quality, writes
from zoneferry.plans import jobs
from zoneferry.plans.scratch import scratch
from zoneferry.sources import files


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def s(spark):
    with scratch(spark, "jobs") as made:
        yield made


def test_map_zone_writes_in_order_and_archives_last(spark, s):
    s.sink("a", "x int")
    s.sink("n", "n bigint")
    s.sink("h", "x int, day string", "day")
    jobs.map_zone(
        spark,
        "SELECT x + :add AS x FROM zj_two",
        [
            "INSERT INTO {db}.a SELECT * FROM mappedOutputTable",
            "INSERT INTO {db}.n SELECT count(*) FROM {db}.a",
        ],
        views={"zj_one": "SELECT 1 AS x", "zj_two": "SELECT x FROM zj_one UNION ALL SELECT 5"},
        archive="INSERT INTO {db}.h PARTITION (day) SELECT x, 'd1' FROM mappedOutputTable",
        binding=jobs.Binding({"db": s.db}, {"add": 1}),
    )
    assert rows(spark.table(f"{s.db}.a")) == [(2,), (6,)]
    assert rows(spark.table(f"{s.db}.n")) == [(2,)]
    assert rows(spark.table(f"{s.db}.h")) == [(2, "d1"), (6, "d1")]


def test_map_zone_stops_at_a_failing_write(spark, s):
    s.sink("a", "x int")
    statements = ["INSERT INTO {db}.nowhere SELECT * FROM mappedOutputTable", "INSERT INTO {db}.a SELECT 1"]
    with pytest.raises(Exception):
        jobs.map_zone(spark, "SELECT 1 AS x", statements, binding=jobs.Binding({"db": s.db}))
    assert spark.table(f"{s.db}.a").isEmpty()


def test_associations_need_a_view(spark):
    with pytest.raises(ValueError):
        jobs.map_zone(spark, "SELECT 1 AS x", [], associations=True)


def test_append_zone_exports_keys(spark, s):
    s.sink("loads", "n bigint")
    table = s.sink("t", "k int, v string")
    added = jobs.append_zone(
        spark,
        "SELECT * FROM VALUES (1, 'a'), (1, 'b'), (2, NULL) AS t(k, v)",
        table,
        "INSERT INTO {db}.loads SELECT count(*) FROM mappedOutputTable",
        keys_sql="SELECT k FROM {db}.t",
        keys_path=s.path("keys"),
        binding=jobs.Binding({"db": s.db}),
    )
    assert added == 3
    assert rows(files.read_keys(spark, s.path("keys"), ["k"])) == [(1,), (2,)]
    assert rows(spark.table(f"{s.db}.loads")) == [(3,)]


@pytest.mark.parametrize("due", ["k < 2", "true", "false"])
def test_rebuild_zone_keeps_every_row(spark, s, due):
    table = s.sink("t", "k int, v string")
    spark.sql(f"INSERT INTO {table} VALUES (1, 'a'), (2, 'b')")
    for run in ("r1", "r2"):
        jobs.rebuild_zone(
            spark,
            f"SELECT 'done' AS v, k FROM {{db}}.t WHERE {due}",
            "SELECT k, v FROM {db}.t WHERE k NOT IN (SELECT k FROM ctr_sts_modified_records)",
            table,
            s.path("versions"),
            run,
            jobs.Binding({"db": s.db}),
        )
        assert spark.table(table).count() == 2
    done = {"k < 2": {1}, "true": {1, 2}, "false": set()}[due]
    assert {r.k for r in spark.table(table).where("v = 'done'").collect()} == done


def test_upsert_zone_exports_deletes_and_appends(spark):
    with scratch(spark, "upsert") as s:
        plain = s.sink("plain", "k int, v string")
        by_v = s.sink("by_v", "k int, v string", "v")
        for table in (plain, by_v):
            writes.append(spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string"), table)
        sql = "SELECT * FROM VALUES (2, 'new'), (3, 'c') AS t(k, v)"
        with pytest.raises(ValueError):
            jobs.upsert_zone(spark, sql, plain, ["k"])
        twice = f"{sql} UNION ALL {sql}"
        with pytest.raises(quality.DuplicateKeys):
            jobs.upsert_zone(spark, twice, plain, ["k"], base=s.path("versions"), run_id="r0")
        for run in ("r1", "r2"):
            assert jobs.upsert_zone(spark, sql, plain, ["k"], keys_path=s.path(run), base=s.path("versions"), run_id=run) == 2
        found = sorted(map(tuple, spark.table(plain).collect()), key=repr)
        assert found == sorted([(1, "a"), (2, "new"), (3, "c"), (None, "n")], key=repr)
        assert {r.k for r in spark.read.parquet(s.path("r1")).collect()} == {2, 3}
        jobs.upsert_zone(spark, "SELECT 2 AS k, 'b' AS v", by_v, ["k", "v"])
        assert spark.table(by_v).count() == 3


def test_drill_rule_records_the_keys_that_differ(spark):
    spark.range(100).withColumn("v", F.col("id") % 3).createOrReplaceTempView("drill_raw")
    job = jobs.ReconJob("daily", "sales", "2024-01-31 06:00:00", "r1")
    rule = job.drill_rule("rows", "SELECT * FROM drill_raw", "SELECT id, IF(id = 7, -1, v) AS v FROM drill_raw WHERE id <> 9", ["id"], ["v"])
    found = {(r.f1_name, r.f1_value, r.f2_value, r.f5_value) for r in rule.build(spark).collect()}
    assert found == {("id", '{"id":7}', "changed", "v"), ("id", '{"id":9}', "missing", "")}

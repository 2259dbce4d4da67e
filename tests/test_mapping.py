import datetime as dt

import pytest
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import functions as F

from zoneferry.functions.columns import where_not
from zoneferry.operators import mapping
from zoneferry.sources.catalog import bind_names, run_sql


def test_names_are_quoted_and_other_braces_stay():
    text = bind_names("SELECT * FROM {db}.t, {other} WHERE a = '{x}'", {"db": "raw", "other": "a.b"})
    assert text == "SELECT * FROM `raw`.t, `a`.`b` WHERE a = '{x}'"


def test_a_name_cannot_carry_sql(spark):
    with pytest.raises((AnalysisException, ParseException)):
        run_sql(spark, "SELECT * FROM {t}", {"t": "x; DROP TABLE y"})


def test_values_are_parameters(spark):
    row = run_sql(spark, "SELECT :v AS v", values={"v": "it's; --"}).first()
    assert row["v"] == "it's; --"


def test_view_chain_keeps_each_name(spark):
    last = mapping.view_chain(
        spark,
        {"zt_a": "SELECT 1 AS x", "zt_b": "SELECT x + 1 AS y FROM zt_a", "zt_c": "SELECT y + 1 AS z FROM zt_b"},
    )
    assert last.first()["z"] == 3
    assert spark.table("zt_a").first()["x"] == 1


def test_staged_view_is_computed_once(spark):
    mapping.view_chain(spark, {"zt_r": "SELECT rand() AS x"}, stage_views={"zt_r"})
    assert spark.table("zt_r").first() == spark.table("zt_r").first()


def test_view_chain_stops_on_error(spark):
    with pytest.raises(AnalysisException):
        mapping.view_chain(spark, {"zt_bad": "SELECT nothing FROM nowhere"})
    with pytest.raises(ValueError):
        mapping.view_chain(spark, {})


def test_mapped_view_preview(spark, capsys):
    mapping.mapped_view(spark, "SELECT 42 AS answer", "zt_preview", preview=2)
    assert "42" in capsys.readouterr().out
    mapping.mapped_view(spark, "SELECT 42 AS answer", "zt_preview")
    assert capsys.readouterr().out == ""


def test_batch_rows(spark):
    df = spark.createDataFrame([(1, "b1"), (2, "b2"), (3, None)], "id int, batch string")
    assert [r["id"] for r in mapping.batch_rows(df, "batch", "b2").collect()] == [2]
    assert mapping.batch_rows(df, "batch", None).count() == 3


def test_pack_payload(spark):
    df = spark.createDataFrame([(1, "x", None)], "id int, `a.b` string, c double")
    packed = mapping.pack_payload(df)
    assert packed.columns == ["id", "payload"]
    assert packed.first()["payload"].asDict() == {"a.b": "x", "c": None}


def test_pack_payload_refuses_clash_and_single_column(spark):
    with pytest.raises(ValueError):
        mapping.pack_payload(spark.createDataFrame([(1, 2)], "id int, payload int"))
    with pytest.raises(ValueError):
        mapping.pack_payload(spark.createDataFrame([(1,)], "id int"))


def test_collect_distinct(spark):
    df = spark.createDataFrame(
        [("a", "2"), ("a", "1"), ("a", "2"), ("a", None), ("b", None), (None, "3")],
        "crm_object_id string, associations string",
    )
    got = {r[0]: r[1] for r in mapping.collect_distinct(df, ["crm_object_id"], "associations").collect()}
    assert got == {"a": ["1", "2"], "b": [], None: ["3"]}


def test_collect_distinct_spreads_a_hot_key(spark):
    df = spark.range(0, 10_000, 1, 8).select(F.lit("hot").alias("k"), (F.col("id") % 50).alias("v"))
    gathered = mapping.collect_distinct(df, ["k"], "v")
    plan = gathered._jdf.queryExecution().sparkPlan().toString()
    assert "collect_list" in plan
    assert gathered.first()["v"] == list(range(50))


def test_where_not_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert {r["x"] for r in df.where(where_not("x = 1")).collect()} == {2, None}

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from zoneferry.operators import keyed, writes
from zoneferry.plans.scratch import scratch
from zoneferry.session import setting

COLUMNS = "k int, v string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def frame(spark, data, schema=COLUMNS):
    return spark.createDataFrame(data, schema)


@pytest.fixture
def s(spark):
    with scratch(spark, "test") as made:
        yield made


def test_append_matches_by_name_casts_and_counts(spark, s):
    table = s.sink("t", COLUMNS)
    assert writes.append(frame(spark, [("a", "1"), ("b", "2")], "v string, k string"), table) == 2
    assert writes.append(frame(spark, []), table) == 0
    assert rows(spark.table(table)) == [(1, "a"), (2, "b")]


def test_append_fills_absent_nullable_columns(spark, s):
    table = s.sink("t", COLUMNS)
    writes.append(frame(spark, [(1,)], "k int"), table)
    assert rows(spark.table(table)) == [(1, None)]


def test_record_only_when_rows_arrived(spark, s):
    table, record = s.sink("t", COLUMNS), s.sink("r", "n bigint")
    statement = "INSERT INTO {db}.r SELECT count(*) FROM {db}.t"
    writes.append_with_record(frame(spark, []), table, statement, names={"db": s.db})
    assert spark.table(record).count() == 0
    writes.append_with_record(frame(spark, [(1, "a")]), table, statement, names={"db": s.db})
    assert rows(spark.table(record)) == [(1,)]


def test_fan_out_computes_the_rows_once(spark, s):
    for sink in ("a", "b"):
        s.sink(sink, "x double")
    mapped = spark.range(20).select(F.rand().alias("x"))
    insert = "INSERT INTO {db}.%s SELECT * FROM zt_mapped"
    writes.fan_out(mapped, "zt_mapped", [insert % "a", insert % "b"], {"db": s.db})
    assert rows(spark.table(f"{s.db}.a")) == rows(spark.table(f"{s.db}.b"))


def test_fan_out_takes_untyped_nulls_and_may_write_its_own_source(spark, s):
    table = s.sink("t", COLUMNS)
    writes.append(frame(spark, [(1, "a")]), table)
    mapped = spark.table(table).select("k", F.lit(None).alias("v"))
    insert = "INSERT INTO {db}.t SELECT * FROM zt_mapped"
    writes.fan_out(mapped, "zt_mapped", [insert, insert], {"db": s.db})
    assert rows(spark.table(table)) == [(1, "a"), (1, None), (1, None)]


def test_archive_keeps_earlier_snapshots(spark, s):
    table = s.sink("h", COLUMNS + ", day string", "day")
    writes.archive(frame(spark, [(1, "a")]), table, "day", "d1")
    writes.archive(frame(spark, [(2, "b")]), table, "day", "d2")
    assert rows(spark.table(table)) == [(1, "a", "d1"), (2, "b", "d2")]


def test_overwrite_partitions_twice_is_once(spark, s):
    table = s.sink("p", COLUMNS, "v")
    writes.overwrite_partitions(frame(spark, [(1, "a"), (2, "b")]), table)
    for _ in range(2):
        assert writes.overwrite_partitions(frame(spark, [(9, "a")]), table) == 1
    assert rows(spark.table(table)) == [(2, "b"), (9, "a")]


def test_hot_partition_is_split_over_files(spark, s):
    table = s.sink("p", "x bigint, part string", "part")
    df = spark.range(0, 200_000, 1, 8).select(
        F.xxhash64("id").alias("x"), F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("part")
    )
    with setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k"):
        writes.append(df, table)
    files = [f for f in os.listdir(s.path("p") + "/part=hot") if f.endswith(".parquet")]
    assert len(files) > 1
    assert spark.table(table).count() == 200_000


UP = "k int, v string, day string"


def test_upsert_partitions_touches_only_its_partitions(spark, s):
    table = s.sink("p", UP, "day")
    writes.append(frame(spark, [(1, "a", "d1"), (2, "b", "d2"), (3, "c", "d2"), (4, "n", None)], UP), table)
    untouched = sorted(os.listdir(s.path("p") + "/day=d1"))
    change = frame(spark, [(2, "B", "d2"), (5, "e", "d3")], UP)
    for _ in range(2):
        writes.upsert_partitions(change, table, ["k", "day"])
        assert rows(spark.table(table)) == [
            (1, "a", "d1"), (2, "B", "d2"), (3, "c", "d2"), (4, "n", None), (5, "e", "d3")
        ]
    assert sorted(os.listdir(s.path("p") + "/day=d1")) == untouched


def test_upsert_partitions_loses_no_row_of_the_null_partition(spark, s):
    table = s.sink("p", UP, "day")
    writes.append(frame(spark, [(1, "a", None), (2, "b", "d2")], UP), table)
    writes.upsert_partitions(frame(spark, [(3, "c", None), (4, "d", ""), (2, "B", "d2")], UP), table, ["k", "day"])
    assert rows(spark.table(table)) == [(1, "a", None), (2, "B", "d2"), (3, "c", None), (4, "d", None)]


@pytest.mark.parametrize("day", ["", None])
def test_upsert_into_the_null_partition_can_be_repeated(spark, s, day):
    table = s.sink("p", UP, "day")
    for _ in range(2):
        writes.upsert_partitions(frame(spark, [(1, "a", day)], UP), table, ["k", "day"])
    assert rows(spark.table(table)) == [(1, "a", None)]


def test_statements_keep_partitions_they_do_not_write(spark, s):
    table = s.sink("p", UP, "day")
    writes.append(frame(spark, [(1, "a", "d1"), (2, "b", "d2")], UP), table)
    change = frame(spark, [(3, "c", "d2")], UP)
    statement = f"INSERT OVERWRITE TABLE {table} SELECT k, v, day FROM zt_change"
    writes.fan_out(change, "zt_change", [statement])
    assert rows(spark.table(table)) == [(1, "a", "d1"), (3, "c", "d2")]


def test_upsert_partitions_needs_the_partition_in_the_key(spark, s):
    table = s.sink("p", UP, "day")
    with pytest.raises(ValueError):
        writes.upsert_partitions(frame(spark, [], UP), table, ["k"])
    with pytest.raises(ValueError):
        writes.upsert_partitions(frame(spark, []), s.sink("u", COLUMNS), ["k"])


def test_replace_table_may_read_itself_and_survives_a_failed_write(spark, s):
    table = s.sink("t", COLUMNS)
    writes.append(frame(spark, [(1, "a"), (2, "b")]), table)
    broken = spark.table(table).withColumn("k", F.raise_error(F.lit("stop")).cast("int"))
    with pytest.raises(PySparkException):
        writes.replace_table(broken, table, s.path("versions"), "v1")
    assert rows(spark.table(table)) == [(1, "a"), (2, "b")]
    for run in ("v1", "v2"):
        kept = keyed.delete_by_keys(spark.table(table), frame(spark, [(2, "b")]), ["k"])
        writes.replace_table(kept, table, s.path("versions"), run)
        assert rows(spark.table(table)) == [(1, "a")]
    with pytest.raises(ValueError):
        writes.replace_table(spark.table(table), table, s.path("versions"), "v2")


def test_replace_partitioned_table_drops_old_partitions(spark, s):
    table = s.sink("p", COLUMNS, "v")
    writes.append(frame(spark, [(1, "a"), (2, "b")]), table)
    changed = spark.table(table).where("v = 'b'").unionByName(frame(spark, [(3, "c")]))
    writes.replace_table(changed, table, s.path("versions"), "v-1")
    assert rows(spark.table(table)) == [(2, "b"), (3, "c")]
    assert writes.partition_columns(spark, table) == ["v"]
    assert rows(spark.sql(f"SHOW PARTITIONS {table}")) == [("v=b",), ("v=c",)]
    writes.append(frame(spark, [(4, "d")]), table)
    assert rows(spark.table(table)) == [(2, "b"), (3, "c"), (4, "d")]


def test_a_broken_swap_can_be_repeated(spark, s, monkeypatch):
    table = s.sink("p", COLUMNS, "v")
    writes.append(frame(spark, [(1, "a"), (2, "b")]), table)
    new = frame(spark, [(3, "c")])
    real = writes.table_name

    def lost(which):
        if which == f"{table}_zf_new_v1" and not spark.catalog.tableExists(table):
            raise RuntimeError("lost")
        return real(which)

    monkeypatch.setattr(writes, "table_name", lost)
    with pytest.raises(RuntimeError):
        writes.replace_table(new, table, s.path("versions"), "v1")
    assert not spark.catalog.tableExists(table)
    monkeypatch.undo()
    writes.restore(spark, table)
    assert rows(spark.table(table)) == [(1, "a"), (2, "b")]
    writes.replace_table(new, table, s.path("versions"), "v1")
    assert rows(spark.table(table)) == [(3, "c")]


def test_repair_finds_new_directories(spark, s):
    frame(spark, [(1, "a"), (2, "b")]).write.partitionBy("v").parquet(s.path("p"))
    table = s.sink("p", COLUMNS, "v")
    assert spark.table(table).count() == 0
    writes.repair(spark, table)
    assert rows(spark.table(table)) == [(1, "a"), (2, "b")]


def test_batch_record(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "batch int, at string")
    assert rows(writes.batch_record(df, "batch", "at")) == [("1", 2, "b"), ("2", 1, "c")]
    assert writes.batch_record(df.limit(0), "batch", "at").isEmpty()


def test_upsert_partitions_computes_its_rows_once(spark, s):
    table = s.sink("p", "k int, part int", "part")
    writes.append(spark.createDataFrame([(i, i % 50) for i in range(500)], "k int, part int"), table)
    moving = spark.range(20).select(
        (F.col("id") + 1_000).cast("int").alias("k"), (F.rand() * 50).cast("int").alias("part")
    )
    writes.upsert_partitions(moving, table, ["k", "part"])
    assert spark.table(table).count() == 520


def test_a_failed_fan_out_leaves_a_usable_view(spark, s):
    mapped = spark.range(2)
    with pytest.raises(PySparkException):
        writes.fan_out(mapped, "zt_left", ["SELECT * FROM nowhere", "SELECT 1"])
    assert spark.table("zt_left").count() == 2


def test_locations_may_hold_quotes(spark, s):
    table = s.sink("t", COLUMNS)
    writes.replace_table(frame(spark, [(1, "a")]), table, s.path("it's"), "v1")
    assert rows(spark.table(table)) == [(1, "a")]


def test_upsert_partitions_scans_only_the_touched(spark, s):
    table = s.sink("p", UP, "day")
    writes.append(frame(spark, [(i, "v", f"d{i}") for i in range(6)] + [(9, "n", None)], UP), table)
    touched = frame(spark, [("d2", 1), ("d4", 1)], f"day string, {writes.ROWS} long")
    with writes.staged(touched) as listed:
        read = writes._in_partitions(spark.table(table), listed, ["day"])
        assert sorted(r.k for r in read.collect()) == [2, 4]
        assert "dynamicpruning" in read._jdf.queryExecution().executedPlan().toString()


def files_of(spark, table):
    return {f.split("/by_day/")[-1] for f in spark.table(table).inputFiles()}


def test_sync_rewrites_only_partitions_with_a_change(spark, s):
    """Rows come, go, change and move; the null partition and a text one empty out."""
    table = s.sink("by_day", f"{COLUMNS}, day string", "day")
    schema = f"{COLUMNS}, day string"
    old = [(1, "a", "x"), (2, "b", "x"), (3, "c", "y"), (4, "d", "z'q"), (5, "e", None), (6, "f", "w")]
    writes.overwrite_partitions(frame(spark, old, schema), table)
    before = files_of(spark, table)
    new = [(1, "a", "x"), (2, "B", "x"), (3, "c", "y"), (4, "d", "x"), (6, "f", "w"), (7, "g", "v")]
    counts = writes.sync_partitions(frame(spark, new, schema), table, ["k"])
    assert counts == {"new": 1, "changed": 2, "same": 3, "gone": 1}
    assert rows(spark.table(table)) == sorted(new, key=repr) == rows(s.rows("by_day"))
    after = files_of(spark, table)
    assert {f for f in before if f.startswith(("day=y", "day=w"))} <= after
    assert not {f for f in before if f.startswith("day=x")} & after
    assert {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()} == {"day=x", "day=y", "day=w", "day=v"}
    again = writes.sync_partitions(frame(spark, new, schema), table, ["k"])
    assert again == {"new": 0, "changed": 0, "same": 6, "gone": 0} and files_of(spark, table) == after
    assert writes.sync_partitions(frame(spark, [], schema), table, ["k"])["gone"] == 6
    assert spark.table(table).count() == 0
    with pytest.raises(ValueError):
        writes.sync_partitions(frame(spark, []), s.sink("plain", COLUMNS), ["k"])


def routed(spark, s, sinks, data, load=1):
    for sink in sinks:
        if not spark.catalog.tableExists(f"{s.db}.{sink}"):
            s.sink(sink, "k int, v string, load int", "load")
    conditions = {f"{s.db}.{sink}": condition for sink, condition in sinks.items()}
    counts = writes.route(data, conditions, {"load": load}, s.path("routed"))
    return {table.rpartition(".")[2]: n for table, n in counts.items()}


def test_route_deals_rows_in_one_write(spark, s):
    sinks = {"all_": "true", "big": "k > 1", "none_": "k > 9", "null_": "v = 'b'"}
    data = frame(spark, [(1, "a"), (2, "b"), (3, None)])
    assert routed(spark, s, sinks, data) == {"all_": 3, "big": 2, "none_": 0, "null_": 1}
    assert rows(spark.table(f"{s.db}.all_")) == [(1, "a", 1), (2, "b", 1), (3, None, 1)]
    assert rows(spark.table(f"{s.db}.big")) == [(2, "b", 1), (3, None, 1)]
    assert spark.table(f"{s.db}.none_").isEmpty()
    assert rows(spark.table(f"{s.db}.null_")) == [(2, "b", 1)]
    assert routed(spark, s, {"big": "true"}, frame(spark, [(7, "z")]), load=2) == {"big": 1}
    assert rows(spark.table(f"{s.db}.big")) == [(2, "b", 1), (3, None, 1), (7, "z", 2)]


def test_route_computes_rows_once_and_takes_no_rows(spark, s):
    data = spark.range(20).select(F.col("id").cast("int").alias("k"), F.rand().cast("string").alias("v"))
    routed(spark, s, {"a": "true", "b": "true"}, data)
    assert rows(spark.table(f"{s.db}.a")) == rows(spark.table(f"{s.db}.b"))
    assert routed(spark, s, {"c": "true"}, frame(spark, [])) == {"c": 0}


def test_route_refuses_a_held_partition_and_other_columns(spark, s):
    data = frame(spark, [(1, "a")])
    routed(spark, s, {"a": "true"}, data)
    with pytest.raises(ValueError):
        routed(spark, s, {"b": "true", "a": "true"}, data)
    assert spark.table(f"{s.db}.b").isEmpty()
    s.sink("other", "k bigint, load int", "load")
    with pytest.raises(ValueError):
        routed(spark, s, {"a": "true", "other": "true"}, data, load=3)
    s.sink("flat", "k int, v string")
    with pytest.raises(ValueError):
        routed(spark, s, {"flat": "true"}, data, load=4)


def test_a_failed_route_detaches_what_it_attached(spark, s, monkeypatch):
    data = frame(spark, [(1, "a")])
    sinks = {"a": "true", "b": "true"}
    for sink in sinks:
        s.sink(sink, "k int, v string, load int", "load")
    run, calls = type(spark).sql, []

    def failing(self, text, *args, **kwargs):
        if "ADD PARTITION" in text:
            calls.append(text)
            if len(calls) == 2:
                raise RuntimeError("catalog gone")
        return run(self, text, *args, **kwargs)

    with monkeypatch.context() as patched:
        patched.setattr(type(spark), "sql", failing)
        with pytest.raises(RuntimeError):
            routed(spark, s, sinks, data)
    assert spark.table(f"{s.db}.a").isEmpty()
    assert routed(spark, s, sinks, data) == {"a": 1, "b": 1}

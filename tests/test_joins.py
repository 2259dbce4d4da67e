"""Joins under skew: right rows, whole results, and plans that can be split."""

import random

import pytest
from pyspark.sql import functions as F

from zoneferry.operators import joins
from zoneferry.session import setting

NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
    "spark.sql.shuffle.partitions": "32",
}


@pytest.fixture
def shuffled(spark):
    before = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def third_on_one_key(spark, rows=150_000):
    return spark.range(0, rows, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("x")
    )


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def same_rows(a, b):
    return sorted(a.collect(), key=repr) == sorted(b.collect(), key=repr)


def test_anti_join_splits_hot_target_key(shuffled):
    target = third_on_one_key(shuffled)
    keys = shuffled.range(0, 60_000, 1, 8).select((F.col("id") - F.col("id") % 2).alias("k"))
    kept = joins.anti_join(target, keys, ["k"])
    assert "skew=true" in final_plan(kept)
    assert kept.count() == target.where("NOT (k < 60000 AND k % 2 = 0)").count()


def test_left_join_splits_hot_left_key_against_grouped_right(shuffled):
    left = third_on_one_key(shuffled)
    right = left.groupBy("k").agg(F.count("*").alias("n"))
    joined = joins.left_join(left, right, ["k"], unique_right=True).select("r.x", "a.n")
    assert "skew=true" in final_plan(joined)
    assert joined.count() == left.count()
    assert joined.where("n IS NULL").isEmpty()


def test_two_unique_sides_are_joined_without_another_shuffle(shuffled):
    grouped = third_on_one_key(shuffled).groupBy("k").agg(F.count("*").alias("n"))
    other = third_on_one_key(shuffled, 90_000).groupBy("k").agg(F.max("x").alias("x"))
    joined = joins.left_join(grouped, other, ["k"], unique_left=True, unique_right=True)
    assert final_plan(joined.select("r.n", "a.x")).count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("from_a_join", [False, True])
def test_left_join_splits_hot_keys_of_both_sides(shuffled, from_a_join):
    left = shuffled.range(0, 100).select(
        F.when(F.col("id") < 5, F.lit(None)).otherwise(F.col("id") - 5).alias("k"), "id"
    )
    right = third_on_one_key(shuffled)
    if from_a_join:
        names = shuffled.range(0, 150_000).select(F.col("id").alias("k"), F.lit("n").alias("name"))
        right = right.join(names, "k").select("k", "x")
    joined = joins.left_join(left, right, ["k"]).select("r.k", "r.id", "a.x")
    assert "skew=true" in final_plan(joined)
    assert same_rows(joined, left.join(right, "k", "left").select("k", "id", "x"))


def test_left_join_two_keys_and_odd_names(spark):
    left = spark.createDataFrame([(1, "a", 10), (1, "b", 20), (2, None, 30)], "`my key` int, k2 string, v int")
    right = spark.createDataFrame([(1, "a", 7), (1, "a", 8), (2, None, 9)], "`my key` int, k2 string, w int")
    joined = joins.left_join(left, right, ["my key", "k2"]).select("r.v", "a.w")
    assert sorted(map(tuple, joined.collect()), key=repr) == [(10, 7), (10, 8), (20, None), (30, None)]


def test_left_join_on_names_with_dots_and_blanks(spark):
    left = spark.range(3).toDF("a.b c")
    right = spark.range(0, 12, 1, 4).select((F.col("id") % 2).alias("a.b c"), F.col("id").alias("x"))
    joined = joins.left_join(left, right, ["a.b c"])
    got = sorted(map(tuple, joined.select("r.`a.b c`", "a.x").collect()), key=repr)
    assert got == sorted([(i % 2, i) for i in range(12)] + [(2, None)], key=repr)


@pytest.mark.parametrize("null_safe, kept", [(False, {2, None}), (True, {2})])
def test_anti_join_and_null_keys(spark, null_safe, kept):
    target = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    keys = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    rows = joins.anti_join(target, keys, ["k"], null_safe).collect()
    assert {r["k"] for r in rows} == kept


def test_anti_join_plan(spark):
    target = spark.range(10).withColumnRenamed("id", "k")
    plan = joins.anti_join(target, target, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan


def test_setting_is_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(RuntimeError), setting(spark, "spark.sql.shuffle.partitions", "3"):
        raise RuntimeError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_joins_need_keys(spark):
    df = spark.range(2)
    with pytest.raises(ValueError):
        joins.left_join(df, df, [])
    with pytest.raises(ValueError):
        joins.anti_join(df, df, [])


@pytest.mark.parametrize("seed", range(4))
def test_left_join_against_brute_force(spark, seed):
    """Random sides with repeated, missing, null and hot keys."""
    chance = random.Random(seed)
    keys = [None, 0, 0, 0, 1, 2, 3, 4]
    left = [(chance.choice(keys), i) for i in range(chance.randrange(25))]
    right = [(chance.choice(keys), i) for i in range(chance.randrange(60))]
    expected = []
    for k, x in left:
        matches = [(k, x, y) for rk, y in right if k is not None and rk == k]
        expected += matches or [(k, x, None)]
    joined = joins.left_join(
        spark.createDataFrame(left, "k int, x int"),
        spark.createDataFrame(right, "k int, y int").repartition(5),
        ["k"],
    ).select("r.k", "r.x", "a.y")
    assert sorted(map(tuple, joined.collect()), key=repr) == sorted(expected, key=repr)


def test_left_join_salts_hot_right_keys_in_one_join(shuffled, tmp_path):
    """Two scans, one join, and the hot key's rows over many tasks."""
    left_path, right_path = str(tmp_path / "left"), str(tmp_path / "right")
    shuffled.range(0, 5_000).select((F.col("id") - 10).alias("k"), "id").write.parquet(left_path)
    third_on_one_key(shuffled).withColumn("k", F.when(F.col("x") % 50 == 1, None).otherwise(F.col("k"))).write.parquet(right_path)
    left, right = shuffled.read.parquet(left_path), shuffled.read.parquet(right_path)
    hot = {r[joins.ITEM]: r[joins.SALTS] for r in joins.hot_keys(right, ["k"]).collect()}
    assert set(hot) == {'{"k0":"0"}'} and hot['{"k0":"0"}'] >= 4
    joined = joins.left_join(left, right, ["k"])
    assert joined.columns == ["k", "id", "k", "x"]
    plan = final_plan(joined.select("r.k", "r.id", "a.x"))
    assert plan.count("Scan parquet") == 2 and plan.count("SortMergeJoin") == 1
    assert same_rows(joined.select("r.k", "r.id", "a.x"), left.join(right, "k", "left").select("k", "id", "x"))
    with setting(shuffled, "spark.sql.adaptive.enabled", "false"):
        per_task = joins.left_join(left, right, ["k"]).where("r.k = 0").groupBy(F.spark_partition_id()).count()
        assert max(r["count"] for r in per_task.collect()) < 0.5 * right.where("k = 0").count()


@pytest.mark.parametrize("seed", range(4))
def test_left_join_equals_the_plain_one(spark, seed, monkeypatch):
    """Two keys, nulls, ties, hot keys on both sides, keys in one side only."""
    monkeypatch.setattr(joins.hot_keys, "__defaults__", (2,))
    chance = random.Random(seed)

    def rows(n):
        keys = [None, 0, 0, 0, 1, 2, chance.randrange(30)]
        texts = [None, "", "a", "a", 'q"\\', "b"]
        return [(chance.choice(keys), chance.choice(texts), chance.randrange(5), {"m": 1}) for _ in range(n)]

    schema = "k int, t string, x int, m map<string,int>"
    left, right = spark.createDataFrame(rows(60), schema), spark.createDataFrame(rows(150), schema)
    got = joins.left_join(left, right, ["k", "t"]).select("r.k", "r.t", "r.x", F.col("a.x").alias("y"))
    both = left.alias("l").join(right.alias("a"), (F.col("l.k") == F.col("a.k")) & (F.col("l.t") == F.col("a.t")), "left")
    assert joins.hot_keys(right, ["k", "t"]) is not None
    assert same_rows(got, both.select("l.k", "l.t", "l.x", F.col("a.x").alias("y")))
    empty = joins.left_join(left, right.limit(0), ["k", "t"])
    assert empty.count() == 60 and joins.left_join(left.limit(0), right, ["k", "t"]).count() == 0
    doubles = [d.withColumn("k", F.col("k").cast("double")) for d in (left, right)]
    assert same_rows(joins.left_join(*doubles, ["k"]).select("r.k", "a.x"), doubles[0].join(doubles[1].select("k", F.col("x").alias("y")), "k", "left").select("k", "y"))

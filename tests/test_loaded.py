import pytest
from pyspark.sql import functions as F

from zoneferry.operators import loaded
from zoneferry.operators.quality import DuplicateKeys
from zoneferry.plans import jobs
from zoneferry.plans.scratch import scratch


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plain(delta, target):
    return sorted(
        [(*k, delta.count(k), target.count(k)) for k in set(delta) if k in set(target)], key=repr
    )


@pytest.mark.parametrize("words", [1, 4, loaded.FILTER_WORDS])
def test_same_as_by_hand_at_any_size_of_filter(spark, words):
    target = [(i % 97 if i % 11 else None, f"v{i % 13}") for i in range(900)]
    delta = [(i % 150 if i % 7 else None, f"v{i % 17}") for i in range(300)]
    schema = "k int, v string"
    found = loaded.already_loaded(
        spark.createDataFrame(delta, schema), spark.createDataFrame(target, schema), ["k", "v"], words
    )
    assert rows(found) == plain(delta, target)


def test_keys_take_the_types_of_the_target(spark):
    delta = spark.createDataFrame([("1", 0), ("x", 0)], "k string, rows int")
    target = spark.createDataFrame([(1,), (1,), (2,)], "k bigint")
    found = loaded.already_loaded(delta.where("k = '1'"), target, ["k"])
    assert rows(found) == [(1, 1, 2)]


def test_empty_sides_and_zeros(spark):
    some, none = spark.range(3).toDF("k"), spark.range(0).toDF("k")
    assert rows(loaded.already_loaded(none, some, ["k"])) == []
    assert rows(loaded.already_loaded(some, none, ["k"])) == []
    minus = spark.createDataFrame([(-0.0,), (float("nan"),)], "k double")
    plus = spark.createDataFrame([(0.0,), (float("nan"),)], "k double")
    assert loaded.already_loaded(minus, plus, ["k"]).count() == 2


def test_few_rows_without_a_partner_pass(spark):
    """The filter is small, holds every key and lets about one stranger in a hundred through."""
    n = 40_000
    keys, strangers = spark.range(n).toDF("k"), spark.range(n, 11 * n).toDF("k")
    words = loaded.filter_words(n)
    held = loaded.key_filter(keys, ["k"], words)
    assert words <= n // 2 and held.count() <= words
    assert loaded.maybe_held(keys, held, ["k"], words).count() == n
    assert loaded.maybe_held(strangers, held, ["k"], words).count() < 0.02 * 10 * n


def test_the_target_is_not_shuffled_before_the_filter(spark):
    """A hot key of the target is counted before its rows move."""
    target = spark.range(200_000).select((F.col("id") % 3).alias("k"))
    held = loaded.key_filter(spark.range(1).toDF("k"), ["k"], 1)
    hits = loaded.maybe_held(target, held, ["k"], 1).groupBy("k").count()
    plan = hits._jdf.queryExecution().executedPlan().toString()
    moved, below = plan.split("Exchange hashpartitioning(k", 1)
    assert "HashAggregate" in moved
    assert below.index("HashAggregate") < below.index("BroadcastHashJoin")


@pytest.mark.parametrize("keys, words", [(0, 1), (1, 1), (4, 1), (5, 2), (9, 4), (10**9, loaded.FILTER_WORDS)])
def test_words_of_a_filter(keys, words):
    assert loaded.filter_words(keys) == words


def test_gate_and_job(spark):
    record = "INSERT INTO {db}.r SELECT count(*) FROM mappedOutputTable"
    with scratch(spark, "gate") as s:
        table, log = s.sink("t", "k int, v string"), s.sink("r", "n bigint")

        def load(values):
            return jobs.append_zone(
                spark,
                f"SELECT * FROM VALUES {values} AS t(k, v)",
                table,
                record,
                unique_by=["k"],
                binding=jobs.Binding({"db": s.db}),
            )

        assert load("(1, 'a'), (2, 'b')") == 2
        for refused in ("(3, 'c'), (3, 'd')", "(2, 'x'), (4, 'y')"):
            with pytest.raises(DuplicateKeys):
                load(refused)
        assert load("(3, 'c')") == 1
        assert rows(spark.table(table)) == [(1, "a"), (2, "b"), (3, "c")]
        assert rows(spark.table(log)) == [(1,), (2,)]

"""Keyed changes against plain Python over the same rows."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from zoneferry.operators import keyed

TARGET = "k int, v string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (2, "bb"), (3, "c"), (None, "n")], TARGET)


def test_delete_by_text_keys(spark, target):
    keys = spark.createDataFrame([("2",), ("2",), ("9",), (None,)], "k string")
    assert rows(keyed.delete_by_keys(target, keys, ["k"])) == [(1, "a"), (3, "c"), (None, "n")]


def test_no_keys_no_deletes(spark, target):
    keys = spark.createDataFrame([], "k string")
    assert rows(keyed.delete_by_keys(target, keys, ["k"])) == rows(target)


def test_delete_by_two_keys_needs_both(spark, target):
    keys = spark.createDataFrame([(2, "b"), (1, "x")], "k int, v string")
    assert rows(keyed.delete_by_keys(target, keys, ["k", "v"])) == [(1, "a"), (2, "bb"), (3, "c"), (None, "n")]


def test_keys_with_quotes_and_commas(spark):
    target = spark.createDataFrame([("o'x",), ('a,"b"',), ("",), (" p ",)], "k string")
    keys = spark.createDataFrame([("o'x",), ('a,"b"',), ("",)], "k string")
    assert rows(keyed.delete_by_keys(target, keys, ["k"])) == [(" p ",)]


def test_upsert_keeps_all_new_rows_and_matches_columns_by_name(spark, target):
    new = spark.createDataFrame([("x", 2), ("y", 2), ("z", 7)], "v string, k int")
    assert rows(keyed.upsert(target, new, ["k"])) == [
        (1, "a"), (2, "x"), (2, "y"), (3, "c"), (7, "z"), (None, "n")
    ]


def test_upsert_with_separate_key_list(spark, target):
    new = spark.createDataFrame([(5, "e")], TARGET)
    keys = spark.createDataFrame([(1,), (3,)], "k int")
    assert rows(keyed.upsert(target, new, ["k"], keys)) == [(2, "b"), (2, "bb"), (5, "e"), (None, "n")]


def test_upsert_null_key_only_when_asked(spark, target):
    new = spark.createDataFrame([(None, "m")], TARGET)
    assert (None, "n") in rows(keyed.upsert(target, new, ["k"]))
    assert (None, "n") not in rows(keyed.upsert(target, new, ["k"], null_safe=True))


def test_refresh_keeps_rows_the_predicate_does_not_decide(spark, target):
    new = spark.createDataFrame([(8, "h")], TARGET)
    assert rows(keyed.refresh(target, new, "k < 3")) == [(3, "c"), (8, "h"), (None, "n")]
    assert rows(keyed.refresh(target, new)) == [(8, "h")]


def test_refresh_batch_twice_is_once(spark, target):
    new = spark.createDataFrame([(2, "q")], TARGET)
    once = keyed.refresh_batch(target, new, "k", 2)
    twice = keyed.refresh_batch(once, new, "k", 2)
    assert rows(once) == rows(twice) == [(1, "a"), (2, "q"), (3, "c"), (None, "n")]


def test_rebuild_matches_by_name_and_takes_empty_halves(spark):
    changed = spark.createDataFrame([(1, "x")], TARGET)
    unchanged = spark.createDataFrame([("y", 2)], "v string, k int")
    assert rows(keyed.rebuild(changed, unchanged)) == [(1, "x"), (2, "y")]
    assert rows(keyed.rebuild(changed.limit(0), unchanged)) == [(2, "y")]
    assert rows(keyed.rebuild(changed, unchanged.limit(0))) == [(1, "x")]


pairs = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from("abc")), max_size=8)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=pairs, new=pairs)
def test_upsert_property(spark, old, new):
    target, change = spark.createDataFrame(old, TARGET), spark.createDataFrame(new, TARGET)
    changed = {k for k, _ in new if k is not None}
    expected = [r for r in old if r[0] not in changed] + new
    once = keyed.upsert(target, change, ["k"])
    assert rows(once) == sorted(expected, key=repr)
    if all(k is not None for k, _ in new):
        assert rows(keyed.upsert(once, change, ["k"])) == rows(once)


def test_change_classes(spark):
    schema = "k int, v string, m map<string,int>, p int"
    current = spark.createDataFrame([(1, "a", {"x": 1}, 5), (2, "b", None, 5), (3, "c", {}, 6), (None, "n", None, 6)], schema)
    state = spark.createDataFrame([(1, "a", {"x": 1}, 5), (2, "b", {"y": 1}, 5), (None, "n", None, 7), (9, None, None, 5)], schema)
    found = keyed.change_classes(current, state, ["k"], ["p"])
    got = {(r.k, r["class"], r.before and r.before.p, r.after and r.after.p) for r in found.collect()}
    assert got == {(1, "same", 5, 5), (2, "changed", 5, 5), (3, "gone", 6, None), (None, "changed", 6, 7), (9, "new", None, 5)}
    assert {r["class"] for r in keyed.change_classes(current, current.limit(0), ["k"]).collect()} == {"gone"}
    assert {r["class"] for r in keyed.change_classes(current.limit(0), state, ["k"]).collect()} == {"new"}

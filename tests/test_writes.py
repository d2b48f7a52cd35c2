import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from scholarmart.operators import writes


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_updates_only_the_listed_columns(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, a string, b int")
    new = spark.createDataFrame([(2, "B", 99), (3, "c", 30)], "k int, a string, b int")
    assert rows(writes.upsert(old, new, ["k"], ["a"])) == [(1, "a", 10), (2, "B", 20), (3, "c", 30)]
    assert rows(writes.upsert(old, new, ["k"])) == [(1, "a", 10), (2, "B", 99), (3, "c", 30)]


def test_upsert_writes_nulls(spark):
    old = spark.createDataFrame([(1, "a")], "k int, a string")
    new = spark.createDataFrame([(1, None)], "k int, a string")
    assert rows(writes.upsert(old, new, ["k"])) == [(1, None)]


def test_touch_only_on_change(spark):
    old = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, a string, t int")
    new = spark.createDataFrame([(1, "a", 5), (2, "x", 5), (3, "n", 5)], "k int, a string, t int")
    assert rows(writes.upsert(old, new, ["k"], ["a"], touch=("t", F.lit(7)))) == [(1, "a", 0), (2, "x", 7), (3, "n", 5)]


def test_additive_upsert(spark):
    old = spark.createDataFrame([("d", 27)], "k string, n int")
    assert rows(writes.upsert_add(old, spark.createDataFrame([("d", 3), ("e", 1)], "k string, n int"), ["k"], ["n"])) == [("d", 30), ("e", 1)]


@pytest.mark.parametrize("seed", range(3))
def test_additive_upsert_of_any_split_equals_one_load(spark, seed):
    rng = random.Random(seed)
    events = [(rng.randint(1, 4),) for _ in range(60)]
    whole = spark.createDataFrame(events, "k int").groupBy("k").agg(F.count("*").alias("n"))
    cuts = sorted(rng.sample(range(1, 59), 3))
    target = whole.limit(0)
    for a, b in zip([0, *cuts], [*cuts, 60]):
        part = spark.createDataFrame(events[a:b], "k int").groupBy("k").agg(F.count("*").alias("n"))
        target = writes.upsert_add(target, part, ["k"], ["n"])
    assert rows(target) == rows(whole)


def test_insert_ignore(spark):
    old = spark.createDataFrame([(1, "a")], "k int, a string")
    new = spark.createDataFrame([(1, "z"), (2, "b")], "k int, a string")
    assert rows(writes.insert_ignore(old, new, ["k"])) == [(1, "a"), (2, "b")]


def test_update_from_needs_a_unique_source(spark):
    df = spark.createDataFrame([(1, "a")], "k int, a string")
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "k int, a string")
    with pytest.raises(writes.DuplicateKeys):
        writes.update_from(df, twice, ["k"], ["a"])
    equal = spark.createDataFrame([(1, "x"), (1, "x")], "k int, a string")
    assert rows(writes.update_from(df, equal, ["k"], ["a"])) == [(1, "x")]


def test_soft_delete_and_purge(spark):
    dim = spark.createDataFrame([(4521, False, None), (7, False, None)], "id_documento int, is_deleted boolean, deleted_at date")
    day = dt.date(2026, 5, 4)
    assert rows(writes.soft_delete(dim, F.col("id_documento") == 4521, F.lit(day)).filter("is_deleted")) == [(4521, True, day)]
    fact = spark.createDataFrame([(4521, 1), (7, 2), (4521, 3)], "id_documento int, n int")
    left = writes.purge(fact, spark.createDataFrame([(4521,)], "id_documento int"), ["id_documento"])
    assert rows(left) == [(7, 2)]
    assert tuple(writes.before_after(fact, left, F.count("*"), "hechos").first()) == (3, 1)


def test_parents_removed(spark):
    children = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, p int")
    gone = spark.createDataFrame([(10,)], "id int")
    assert {r["id"] for r in writes.cascade(children, gone, "p", "id").collect()} == {2, 3}
    assert {(r["id"], r["p"]) for r in writes.set_null(children, gone, "p", "id").collect()} == {(1, None), (2, 20), (3, None)}
    assert rows(writes.restricted(gone, children, "id", "p")) == [(10, 1)]

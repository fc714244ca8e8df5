"""The key filter keeps every row of its keys, few others, and has a bounded size."""

import pytest
from pyspark.sql import functions as F

from supplyloom.operators import membership
from supplyloom.operators.joins import fan_out
from supplyloom.plans import dashboard


def test_no_row_of_a_key_is_lost(spark):
    ids = spark.range(0, 30_000, 3).select(F.col("id").alias("k"))
    child = spark.range(0, 30_000).select(F.col("id").alias("k"), F.lit("x").alias("_word"), F.lit("y").alias("_v"))
    found = membership.key_filter(ids, "k")
    kept = found.keep(child.withColumnRenamed("_word", "w"), "k")
    assert kept.columns == ["k", "w", "_v"]
    numbers = {r.k for r in kept.collect()}
    assert set(range(0, 30_000, 3)) <= numbers
    others = len(numbers) - 10_000
    assert others < 20_000 * 0.2
    assert found.words.count() * membership.WORD_BITS <= found.n_bits <= 1 << 18


def test_types_nulls_and_repeated_keys(spark):
    ids = spark.createDataFrame([(1,), (1,), (None,), (70_000,)], "k long")
    found = membership.key_filter(ids, "k")
    child = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (70_000, "d")], "k int, v string")
    assert sorted(r.v for r in found.keep(child, "k").collect()) == ["a", "b", "d"]
    names = spark.createDataFrame([("x",), ("ü",)], "k string")
    assert membership.key_filter(names, "k").keep(names, "k").count() == 2
    nothing = membership.key_filter(ids.filter("false"), "k")
    assert nothing.keep(child, "k").count() == 0


def test_too_many_keys_fall_back_to_semi_joins(spark, monkeypatch):
    ids = spark.range(1000).select(F.col("id").alias("k"))
    assert membership.key_filter(ids, "k", most_words=8) is None
    assert membership.key_filter(ids, "k", most_words=64).n_bits <= 64 * 64
    child = spark.range(500, 1500).select(F.col("id").alias("k"))
    monkeypatch.setattr(membership, "key_filter", lambda *_: None)
    reduced = membership.reduce_children({"c": child, "d": child}, ("c",), ids, "k")
    assert reduced["c"].count() == 500 and reduced["d"].count() == 1000


def test_children_are_filtered_before_their_shuffle(spark):
    ids = spark.range(10).select(F.col("id").alias("k"))
    child = spark.createDataFrame([(i, i % 7) for i in range(1000)], "k long, v long")
    reduced = membership.reduce_children({"c": child}, ("c",), ids, "k")["c"].groupBy("k").agg(F.sum("v"))
    plan = reduced._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.index("BroadcastHashJoin") and "SortMergeJoin" not in plan


@pytest.mark.parametrize("counted", [False, True])
def test_fan_out_counts_keys_before_lookups(spark, counted):
    left = spark.range(4).select(F.col("id"), F.lit("l").alias("side"))
    raw = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 50), (None, 51)], "id long, child long")
    got = fan_out(left, raw, "id", "child", rows_per_task=8, counted=raw.select("id") if counted else None)
    rows = sorted((r.id, r.child is not None) for r in got.collect())
    assert rows == [(0, False)] + [(1, True)] * 50 + [(2, True), (3, False)]


def test_fan_out_without_hot_keys_leaves_rows_where_they_lie(spark, rows):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "id int, x string").repartition(3, "id")
    right = spark.createDataFrame([(1, 10), (1, 11), (None, 12)], "id int, child int")
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = fan_out(left, right, "id", "child", keep_salt=True)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "_salt" not in "".join(line for line in plan.splitlines() if "hashpartitioning" in line)
        assert rows(got.select("id", "x", "child", "_salt")) == rows(left.join(right, "id", "left").selectExpr("id", "x", "child", "0"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)


def test_lookups_meet_wide_rows_by_number(spark, rows):
    requests = spark.createDataFrame([(0, 1, 5, "w"), (1, 1, 6, "x"), (2, None, None, "y")], "_row long, id int, fk int, wide string")
    names = spark.createDataFrame([(5, "a"), (5, "b"), (6, "c")], "pk int, name string")
    found = requests.join(names, requests.fk == names.pk, "left").drop("pk")
    got = dashboard._beside(requests, found, found.withColumnRenamed("name", "other").filter("other is null or other <> 'b'"))
    assert rows(got) == [(None, None, "y", None, None), (1, 5, "w", "a", "a"), (1, 5, "w", "b", "a"), (1, 6, "x", "c", "c")]
    # of the looked-up rows, only number and name reach the join with the wide rows
    steps = dashboard._beside(requests, found)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert len([step for step in steps if "Project" in step and "wide#" in step and "name#" in step]) == 1


def test_rest_of_a_filter_are_the_rows_it_drops(spark):
    ids = spark.range(0, 3_000, 3).select(F.col("id").alias("k"))
    child = spark.range(0, 3_000).select(F.col("id").alias("k")).unionByName(spark.createDataFrame([(None,)], "k long"))
    found = membership.key_filter(ids, "k")
    kept, rest = ([r.k for r in part.collect()] for part in (found.keep(child, "k"), found.rest(child, "k")))
    assert None in rest and sorted([*kept, *[k for k in rest if k is not None]]) == list(range(3_000))
    assert not any(k is not None and k % 3 == 0 for k in rest)

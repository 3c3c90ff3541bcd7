"""Keyed state against brute force, with one key holding a third of all rows."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from clinlake.functions.keys import packed_id, unpacked_id
from clinlake.operators.current import among_repeated, change_feed, latest_per_key, merge_upsert, scd1, scd2, with_previous


def skewed(spark, n=3000):
    rng = random.Random(5)
    order = list(range(n))
    rng.shuffle(order)
    rows = [("hot" if i % 3 == 0 else f"k{rng.randrange(200)}", t, rng.choice("abc")) for i, t in enumerate(order)]
    return spark.createDataFrame(rows, "k string, t long, v string")


def as_set(df, *cols):
    return sorted(map(str, df.select(*cols).collect()))


def test_with_previous_equals_lag(spark):
    df = skewed(spark)
    w = Window.partitionBy("k").orderBy("t")
    want = df.withColumn("p", F.lag("v").over(w)).withColumn("n", F.lead("v").over(w))
    got = with_previous(df, ["k"], "t", ["v"], slices=16)
    assert as_set(got, "k", "t", "v", F.col("prev_v").alias("p")) == as_set(want, "k", "t", "v", "p")
    got = with_previous(df, ["k"], "t", ["v"], "next_", slices=16, following=True)
    assert as_set(got, "k", "t", "v", F.col("next_v").alias("n")) == as_set(want, "k", "t", "v", "n")


def test_with_previous_keeps_null_keys_and_values(spark):
    df = spark.createDataFrame([(None, i, None if i % 2 else "x") for i in range(40)], "k string, t long, v string")
    got = {r.t: (r.prev_exists, r.prev_v) for r in with_previous(df, ["k"], "t", ["v"], slices=8).collect()}
    assert got[0] == (False, None)
    assert all(got[i] == (True, None if (i - 1) % 2 else "x") for i in range(1, 40))


def test_scd1_ties_do_not_depend_on_order(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n")]
    first = scd1(spark.createDataFrame(rows, "k string, s int, v string"), ["k"], "s")
    second = scd1(spark.createDataFrame(rows[::-1], "k string, s int, v string").repartition(3), ["k"], "s")
    assert as_set(first, "k", "s", "v") == as_set(second, "k", "s", "v")


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 5), st.sampled_from("xyz")), min_size=2, max_size=12), st.integers(1, 11))
def test_scd1_over_any_split_equals_batch(spark, rows, cut):
    schema = "k string, s int, v string"
    df = spark.createDataFrame(rows, schema)
    parts = [p for p in (rows[:cut], rows[cut:]) if p]
    state = None
    for p in parts:
        step = spark.createDataFrame(p, schema)
        state = scd1(step if state is None else state.unionByName(step), ["k"], "s")
    assert as_set(state, "k", "s", "v") == as_set(scd1(df, ["k"], "s"), "k", "s", "v")


def test_change_feed_images(spark):
    log = spark.createDataFrame(
        [("a", 1, "x", False), ("a", 2, "y", False), ("a", 3, None, True), ("a", 4, None, True), ("a", 5, "z", False), ("b", 2, "q", True)],
        "k string, ver long, v string, gone boolean",
    )
    rows = change_feed(log, ["k"], "ver", "gone").collect()
    assert sorted((r.k, r._commit_version, r._change_type, r.v) for r in rows) == [
        ("a", 1, "insert", "x"), ("a", 2, "update_postimage", "y"), ("a", 2, "update_preimage", "x"),
        ("a", 3, "delete", "y"), ("a", 5, "insert", "z"),
    ]
    later = change_feed(log, ["k"], "ver", "gone", from_version=3).collect()
    assert {r._commit_version for r in later} == {3, 5}


def test_scd2_opens_only_on_tracked_changes(spark):
    rows = [("p", 1, "S", "x"), ("p", 3, "M", "y"), ("p", 2, "S", "z"), ("p", 4, "M", "w"), ("p", 5, None, "u")]
    out = scd2(spark.createDataFrame(rows, "k string, t long, m string, o string"), ["k"], "t", ["m"]).collect()
    assert sorted((r.valid_from, r.valid_to, r.m) for r in out) == [(1, 3, "S"), (3, 5, "M"), (5, None, None)]


def test_merge_updates_only_listed_columns(spark):
    schema = "k string, a int, b int"
    base = spark.createDataFrame([("x", 1, 1), ("y", 2, 2)], schema)
    stage = spark.createDataFrame([("y", 9, 9), ("z", 3, 3)], schema)
    assert as_set(merge_upsert(base, stage, ["k"], ["a"]), "*") == as_set(spark.createDataFrame([("x", 1, 1), ("y", 9, 2), ("z", 3, 3)], schema), "*")
    assert merge_upsert(None, stage, ["k"], ["a"]).count() == 2


def test_newest_row_is_limited_before_the_shuffle(spark):
    plan = scd1(skewed(spark), ["k"], "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_merge_keeps_rows_without_a_key(spark):
    shape = "k string, keep string, v string"
    base = spark.createDataFrame([("a", "keep", "1"), (None, "keep", "x")], shape)
    stage = spark.createDataFrame([("a", "other", "2"), ("b", "new", "3"), (None, "staged", "y")], shape)
    got = sorted(map(str, [tuple(r) for r in merge_upsert(base, stage, ["k"], ["v"]).collect()]))
    assert got == sorted(map(str, [("a", "keep", "2"), ("b", "new", "3"), (None, "keep", "x"), (None, "staged", "y")]))


def test_packed_ids_are_equal_where_the_texts_are(spark):
    texts = ["ab" * 32, "AB" * 32, "ab" * 32 + "\n", "ab" * 16, "x", "", "é" * 16, None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("p", packed_id(F.col("t")))
    got = rows.select("t", "p", unpacked_id(F.col("p")).alias("back")).collect()
    assert [r.back for r in got] == texts
    assert len({bytes(r.p) for r in got if r.p is not None}) == len(texts) - 1
    assert len(got[0].p) == 32


@pytest.mark.parametrize("most", [0, 1, 10])
def test_rows_alone_under_their_key_are_not_shuffled(spark, most):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("c", 5), ("c", 4), (None, 1), (None, 2), ("d", 7)], "k string, n int")

    def newest(df):
        return latest_per_key(df, ["k"], [F.desc("n")])

    got = among_repeated(rows, "k", newest, most).collect()
    assert sorted(got, key=str) == sorted(newest(rows).collect(), key=str)
    once = rows.where("k IN ('b', 'd')")
    assert "Exchange" not in among_repeated(once, "k", newest, most)._jdf.queryExecution().executedPlan().toString()


def test_gold_shuffles_neither_key_hashes_nor_single_versions(spark):
    from clinlake import queries

    plan = queries.spec_gold(spark, "/root/testdata/sf0.001", "condition_gold").drop("resource")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(condition_natural_key" not in plan
    assert "hashpartitioning(condition_uuid" not in plan and "hashpartitioning(_key_text" in plan

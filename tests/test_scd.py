from datetime import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierstone.functions.hashing import change_hash
from tierstone.operators.scd import dedup_latest, first_versions, scd2_from_snapshots, scd2_merge, upsert

T = [dt(2000 + i, 1, 1) for i in range(6)]


def snapshot(spark, rows):
    df = spark.createDataFrame(rows, "k string, v string, w string")
    return df.withColumn("change_hash", change_hash("v", "w"))


def versions(df):
    columns = ("k", "v", "w", "valid_from", "valid_to", "is_current")
    return sorted(tuple(str(x) for x in r) for r in df.select(*columns).collect())


def test_new_changed_unchanged_absent_and_back_again(spark):
    loads = [
        [("a", "1", "x"), ("b", "1", "x"), ("c", "1", "x")],
        [("a", "2", "x"), ("b", "1", "x"), ("d", "1", None)],
        [("a", "1", "x"), ("b", "1", "x"), ("d", None, "1")],
    ]
    table = first_versions(snapshot(spark, loads[0]), T[0])
    for ts, rows in zip(T[1:], loads[1:]):
        table = scd2_merge(table, snapshot(spark, rows), "k", ts)
    got = versions(table)
    assert [g for g in got if g[0] == "a"] == [
        ("a", "1", "x", "1900-01-01 00:00:00", str(T[1]), "False"),
        ("a", "1", "x", str(T[2]), "9999-12-31 00:00:00", "True"),
        ("a", "2", "x", str(T[1]), str(T[2]), "False"),
    ]
    assert [g[5] for g in got if g[0] in "bc"] == ["True", "True"]
    assert len([g for g in got if g[0] == "d"]) == 2  # a NULL that moves is a change


def test_same_snapshot_again_changes_nothing(spark):
    table = first_versions(snapshot(spark, [("a", "1", None)]), T[0])
    again = scd2_merge(table, snapshot(spark, [("a", "1", None)]), "k", T[1])
    assert versions(again) == versions(table)


def test_corrected_snapshot_replaces_its_own_version(spark):
    table = first_versions(snapshot(spark, [("a", "1", "x")]), T[0])
    table = scd2_merge(table, snapshot(spark, [("a", "2", "x")]), "k", T[1])
    table = scd2_merge(table, snapshot(spark, [("a", "3", "x")]), "k", T[1])
    assert [(r.v, r.is_current) for r in table.orderBy("valid_from").collect()] == [("1", False), ("3", True)]


def test_new_column_in_snapshot(spark):
    table = first_versions(snapshot(spark, [("a", "1", "x"), ("b", "1", "x")]), T[0])
    wider = snapshot(spark, [("a", "2", "x")]).withColumn("extra", F.lit(7))
    rows = {(r.k, r.v): r.extra for r in scd2_merge(table, wider, "k", T[1]).collect()}
    assert rows == {("a", "1"): None, ("a", "2"): 7, ("b", "1"): None}


keys = st.sampled_from("abc")
values = st.sampled_from(["1", "2", None])
loads_strategy = st.lists(st.dictionaries(keys, st.tuples(values, values), max_size=3), min_size=1, max_size=4)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(loads=loads_strategy)
def test_folded_merges_equal_the_batch_form(spark, loads):
    rows = [(k, v, w, T[i]) for i, load in enumerate(loads) for k, (v, w) in load.items()]
    stamped = spark.createDataFrame(rows, "k string, v string, w string, ts timestamp")
    batch = scd2_from_snapshots(stamped, "k", ["v", "w"], "ts")
    table = None
    for i, load in enumerate(loads):
        snap = snapshot(spark, [(k, v, w) for k, (v, w) in load.items()])
        table = first_versions(snap, T[i]) if table is None else scd2_merge(table, snap, "k", T[i])
    got = versions(batch)
    assert got == versions(table)
    for key in {g[0] for g in got}:
        spans = sorted((g[3], g[4], g[5]) for g in got if g[0] == key)
        assert [s[2] for s in spans].count("True") == 1
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))  # no gap, no overlap


def test_dedup_same_key_ties_and_nulls(spark):
    rows = [(1, "2020", 5), (1, "2021", 1), (1, "2021", 3), (2, None, 1), (2, "2019", 2)]
    df = spark.createDataFrame(rows, "k int, d string, n int")
    got = dedup_latest(df, ["k"], [F.col("d").desc_nulls_last(), F.col("n").desc()])
    assert sorted(map(tuple, got.collect())) == [(1, "2021", 3), (2, "2019", 2)]


def test_dedup_reduces_before_the_shuffle(spark):
    df = spark.range(1000).select(F.floor(F.col("id") / 500).alias("k"), "id")
    plan = dedup_latest(df, ["k"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange hashpartitioning") == 1


def test_upsert_with_new_column(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    updates = spark.createDataFrame([(2, "c", 9), (3, "d", 9)], "k int, v string, n int")
    got = sorted(map(tuple, upsert(target, updates, "k").collect()))
    assert got == [(1, "a", None), (2, "c", 9), (3, "d", 9)]


@pytest.mark.parametrize("first_from, opens", [(None, "2000-01-01 00:00:00"), ("1950-01-01 00:00:00", "1950-01-01 00:00:00")])
def test_first_version_opens_where_told(spark, first_from, opens):
    row = first_versions(snapshot(spark, [("a", "1", "x")]), T[0], first_from).first()
    assert str(row.valid_from) == opens

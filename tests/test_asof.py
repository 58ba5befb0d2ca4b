"""As-of join against brute force and the equi-join; late snapshots against sorted loads."""

import random
from datetime import datetime as dt
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tierstone.functions.hashing import change_hash
from tierstone.operators.asof import as_of_join
from tierstone.operators.joins import point_in_time_join
from tierstone.operators.scd import HISTORY_FLOOR, first_versions, scd2_from_snapshots, scd2_merge, splice_late
from tierstone.plans.checks import check_no_overlap, check_single_current, check_valid_window

START = dt(2000, 1, 1)


def history(rng, keys):
    rows = []
    for key, n in keys.items():
        at = START + timedelta(days=rng.randint(0, 50))
        for v in range(n):
            end = at + timedelta(days=rng.randint(1, 9))
            if rng.random() < 0.9:  # some stretches have no version
                rows.append((key, at, end, f"{key}{v}", None if rng.random() < 0.2 else v))
            at = end
    return rows


@pytest.fixture
def frames(spark):
    rng = random.Random(6)
    versions = history(rng, {"a": 300, "b": 20, "c": 1, "d": 0})
    versions.append(("c", START, START, "empty interval", 1))
    events = [(i, rng.choice("aaaaaabcde") if i % 50 else None, None if i % 77 == 0 else START + timedelta(days=rng.randint(-10, 1500))) for i in range(3000)]
    events += events[:20]
    return (
        spark.createDataFrame(events, "id int, k string, ts timestamp"),
        spark.createDataFrame(versions, "k string, valid_from timestamp, valid_to timestamp, name string, v int"),
    )


@pytest.mark.parametrize("share", [None, 0.2])
def test_same_rows_as_the_equi_join(frames, share):
    fact, dimension = frames
    columns = {"name": "name_then", "v": "v"}
    want = sorted(map(str, point_in_time_join(fact, dimension, "k", "ts", columns).collect()))
    got = as_of_join(fact, dimension, "k", "ts", columns, hot_share=share, hot_parts=7)
    assert got.columns == ["id", "k", "ts", "name_then", "v"] and sorted(map(str, got.collect())) == want
    inner = as_of_join(fact, dimension, "k", "ts", columns, how="inner", hot_share=share)
    assert sorted(map(str, inner.collect())) == sorted(map(str, point_in_time_join(fact, dimension, "k", "ts", columns, how="inner").collect()))


def test_dates_meet_timestamps_and_empty_sides(spark, frames):
    fact, dimension = frames
    dated = fact.withColumn("ts", F.to_date("ts"))
    assert sorted(map(str, as_of_join(dated, dimension, "k", "ts", ["v"]).collect())) == sorted(map(str, point_in_time_join(dated, dimension, "k", "ts", ["v"]).collect()))
    assert as_of_join(fact.limit(0), dimension, "k", "ts", ["v"]).collect() == []
    assert as_of_join(fact, dimension.limit(0), "k", "ts", ["v"]).filter("v is not null").isEmpty()
    with pytest.raises(ValueError):
        as_of_join(fact, dimension, "k", "ts", ["v"], how="full")


def test_a_key_with_many_versions_has_no_join_of_versions_and_events(spark, base):
    versions = spark.range(10_000).select(
        F.lit("k").alias("k"), F.timestamp_seconds("id").alias("valid_from"), F.timestamp_seconds(F.col("id") + 1).alias("valid_to"), F.col("id").alias("v")
    )
    events = spark.range(100_000).select(F.lit("k").alias("k"), F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(10_000))).alias("ts"), "id")
    for name, df in (("events", events), ("versions", versions)):  # stored, so that the key is no literal
        df.write.parquet(f"{base}/{name}")
    events, versions = (spark.read.parquet(f"{base}/{name}") for name in ("events", "versions"))
    joined = as_of_join(events, versions, "k", "ts", ["v"], how="inner", hot_share=0.3)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan and "Window" in plan
    assert joined.filter(F.col("v") == F.unix_seconds("ts")).count() == 100_000
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:  # stretches of time spread the key over tasks
        parts = [r.n for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set(name, "true")
    assert len(parts) >= 2


@pytest.mark.parametrize("first_from", [None, HISTORY_FLOOR])
@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_arrival_equals_the_sorted_history(spark, base, first_from, seed):
    rng = random.Random(seed)
    times = [dt(2000 + i, 1, 1) for i in range(5)]
    data = {t: [(f"k{k}", rng.choice(["A", "A", "B", None]), rng.randrange(1000)) for k in range(50) if rng.random() < 0.7] for t in times}
    ddl = "k string, v string, untracked int"
    rows = spark.createDataFrame([(*r, t) for t in times for r in data[t]], f"{ddl}, seen_at timestamp").withColumn("change_hash", change_hash("v"))
    columns = ("k", "v", "untracked", "valid_from", "valid_to", "is_current")
    whole = scd2_from_snapshots(rows.drop("change_hash"), "k", ["v"], "seen_at", first_from)
    want = sorted(map(str, whole.select(*columns).collect()))
    order = rng.sample(times, len(times))
    table, loaded = None, []
    for n, t in enumerate([*order, order[0]]):  # the first one once more, late or not
        snapshot = rows.filter(F.col("seen_at") == F.lit(t)).drop("seen_at")
        if table is None:
            table = first_versions(snapshot, t, first_from)
        elif t > max(loaded):
            table = scd2_merge(table, snapshot, "k", t, first_from)
        else:
            table = splice_late(table, snapshot, rows.filter(F.col("seen_at").isin(loaded)), "k", t, first_from=first_from)
        table.write.parquet(f"{base}/{n}")
        table = spark.read.parquet(f"{base}/{n}")
        loaded.append(t)
    assert sorted(map(str, table.select(*columns).collect())) == want
    for check in (check_valid_window(table), check_no_overlap(table, "k"), check_single_current(table, "k")):
        assert check.isEmpty()


@pytest.mark.parametrize("hot_share", [None, 0.2])
def test_events_are_computed_once(spark, base, frames, hot_share):
    """The undated events of a left join come out of the same pass over the events."""
    fact, dimension = frames
    fact.write.parquet(f"{base}/events")
    stored = spark.read.parquet(f"{base}/events")
    joined = as_of_join(stored, dimension, "k", "ts", {"name": "name", "v": "v"}, hot_share=hot_share)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [id") == 1
    plain = point_in_time_join(fact, dimension, "k", "ts", {"name": "name", "v": "v"})
    assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()
    undated = stored.filter("k is null or ts is null")
    assert as_of_join(undated, dimension, "k", "ts", ["v"], hot_share=hot_share).filter("v is null").count() == undated.count() > 60

"""Layout along a curve, and compaction of small files."""

import random

import pytest
from pyspark.sql import functions as F

from tierstone.operators.scd import first_versions, scd2_changes
from tierstone.functions.hashing import change_hash
from tierstone.sources import clustering, tables


def woven(ranks, bits):
    key = 0
    for bit in reversed(range(bits)):
        for r in ranks:
            key = key << 1 | (r >> bit & 1)
    return key


def test_curve_key_interleaves_ranks_of_any_type(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(1000), rng.choice("abcdefgh") * 3, rng.random()) for _ in range(500)] + [(None, None, None), (5, "ccc", 0.5)]
    df = spark.createDataFrame(rows, "a int, b string, c double")
    bounds = clustering.quantile_bounds(df, ("a", "b", "c"), bits=3)
    assert all(v == sorted(set(v)) and len(v) <= 7 for v in bounds.values())
    got = df.withColumn("key", clustering.curve_key(bounds, bits=3)).collect()
    for r in got:
        ranks = [0 if v is None else sum(b <= v for b in bounds[c]) for c, v in zip("abc", r)]
        assert r.key == woven(ranks, 3)


def test_a_hot_value_and_an_empty_table_have_bounds(spark):
    hot = spark.range(1000).select(F.when(F.col("id") < 900, 7).otherwise(F.col("id")).alias("a"))
    assert clustering.quantile_bounds(hot, ("a",), bits=4)["a"][0] == 7
    empty = clustering.quantile_bounds(hot.limit(0), ("a",))
    assert empty == {"a": []}
    assert hot.select(clustering.curve_key(empty)).distinct().first()[0] == 0


def test_the_second_column_skips_files_too(spark, base):
    df = spark.range(40_000).select("id", F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"), F.pmod(F.hash("id"), F.lit(1000)).alias("b"))
    linear = tables.write_table(df, base, "linear", cluster_by=("a", "b"), files=64)
    curved = tables.write_table(df, base, "curved", cluster_by=("a", "b"), curve=True, files=64)
    assert not tables.path_exists(spark, f"{base}/curved/_unsorted")
    for low in (0, 333, 950):
        one = clustering.files_to_open(linear, "b", low, low + 10)
        two = clustering.files_to_open(curved, "b", low, low + 10)
        assert one >= 60 and two <= one / 2
        part = (F.col("b") >= low) & (F.col("b") <= low + 10)
        assert sorted(curved.filter(part).collect()) == sorted(df.filter(part).collect())
    depth = {r.column_name: (r.files, r.mean_open) for r in clustering.clustering_depth(curved, ("a", "b")).collect()}
    assert all(files == 64 and mean <= 32 for files, mean in depth.values())
    flat = {r.column_name: r.mean_open for r in clustering.clustering_depth(linear, ("a", "b")).collect()}
    assert flat["a"] <= 3 and flat["b"] >= 60 / 2
    plan = curved.filter("b = 5")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(b), EqualTo(b,5)]" in plan


def mean_open_by_pairs(ranges):
    lows = [a for a, _ in ranges]
    return sum(sum(a <= x <= b for a, b in ranges) for x in lows) / len(lows)


def test_depth_counts_the_open_files_of_each_lowest_value(spark, base):
    rng = random.Random(4)
    rows = [(i % 9, rng.randrange(30)) for i in range(200)]
    table = tables.write_table(spark.createDataFrame(rows, "p int, v int"), base, "t", ("p",))
    ranges = [(r.lowest, r.highest) for r in clustering.file_ranges(table, "v").collect()]
    depth = clustering.clustering_depth(table, ("v",)).first()
    assert depth.files == len(ranges) and depth.mean_open == pytest.approx(mean_open_by_pairs(ranges))


def test_many_loads_end_in_few_files(spark, base):
    snapshot = lambda i: spark.createDataFrame([(k, f"{k}-{i if k % 3 == i % 3 else 0}") for k in range(30)], "k int, v string").withColumn("change_hash", change_hash("v"))
    table = tables.write_versions(first_versions(snapshot(0), "2000-01-01 00:00:00"), base, "t")
    for i in range(1, 14):
        changes = scd2_changes(table, snapshot(i), "k", f"20{i:02d}-01-01 00:00:00")
        table = tables.write_versions(changes, base, "t")
    before, files = sorted(map(str, table.collect())), clustering.file_ranges(table, "k").count()
    assert files >= 14
    assert tables.compact(spark, base, "t", cluster_by=("k",))
    table = tables.read_table(spark, base, "t")
    assert sorted(map(str, table.collect())) == before and clustering.file_ranges(table, "k").count() <= 2  # current and closed rows
    assert not tables.compact(spark, base, "t", cluster_by=("k",))  # nothing left to gather
    changes = scd2_changes(table, snapshot(20), "k", "2020-01-01 00:00:00")
    after = tables.write_versions(changes, base, "t")
    assert after.filter("not is_current").count() > table.filter("not is_current").count()


def test_compaction_of_a_partitioned_table(spark, base):
    rows = spark.range(400).select("id", (F.col("id") % 4).alias("p"))
    rows.repartition(40).write.parquet(f"{base}/scattered")
    tables.write_table(spark.read.parquet(f"{base}/scattered"), base, "t")
    spark.read.parquet(f"{base}/scattered").repartition(30).write.mode("overwrite").parquet(f"{tables.current_version(spark, base, 't')}")
    assert tables.compact(spark, base, "t", target_bytes=1 << 20)
    table = tables.read_table(spark, base, "t")
    assert len(table.inputFiles()) == 1 and sorted(map(tuple, table.collect())) == [(i, i % 4) for i in range(400)]


def test_curve_key_is_woven_bit_by_bit_without_a_loop_per_row(spark):
    rows = [(i, None if i % 9 == 0 else f"k{i * 7 % 13:02d}") for i in range(80)] + [(None, "k05")]
    df = spark.createDataFrame(rows, "a int, b string")
    bounds = {"a": list(range(5, 68)), "b": ["k02", "k05", "k09"]}
    keyed = df.withColumn("key", clustering.curve_key(bounds))

    def woven(row):
        ranks = [0 if value is None else sum(cut <= value for cut in cuts) for value, cuts in zip((row.a, row.b), bounds.values())]
        return sum((rank >> bit & 1) << (bit * 2 + 1 - place) for bit in range(clustering.BITS) for place, rank in enumerate(ranks))

    assert all(r.key == woven(r) for r in keyed.collect())
    assert "lambda" not in keyed._jdf.queryExecution().analyzed().toString()

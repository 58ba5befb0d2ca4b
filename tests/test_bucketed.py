"""Tables kept by key: joins and sums without an exchange."""

import random
from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierstone.operators.joins import fk_flag, point_in_time_join
from tierstone.sources.bucketed import read_bucketed, write_bucketed
from tierstone.sources.tables import read_table, write_table


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_joins_on_the_kept_key_have_no_exchange(spark, base, no_broadcast):
    rng = random.Random(1)
    facts = spark.createDataFrame([(i, rng.choice(["a", "b", "c", "d", None]), dt(2000, rng.randint(1, 12), 1)) for i in range(300)], "id int, k string, ts timestamp")
    versions = spark.createDataFrame(
        [(k, dt(2000, m, 1), dt(2000, m + 3, 1), m) for k in "abc" for m in (1, 4, 7)], "k string, valid_from timestamp, valid_to timestamp, v int"
    )
    kept = write_bucketed(facts, base, "facts", "k", 4, ("ts",))
    dimension = write_bucketed(versions, base, "versions", "k", 4)
    keys = write_bucketed(versions.select("k").distinct(), base, "keys", "k", 4)

    def joined(f, d, k):
        return point_in_time_join(fk_flag(f, "k", k, "known"), d, "k", "ts", ["v"])

    got = joined(kept, dimension, keys)
    assert sorted(map(str, got.collect())) == sorted(map(str, joined(facts, versions, versions.select("k").distinct()).collect()))
    summed = got.groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("v"))
    for df in (got, summed):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    plain = joined(write_table(facts, base, "f"), write_table(versions, base, "v"), write_table(versions.select("k").distinct(), base, "k"))
    assert "Exchange" in plain._jdf.queryExecution().executedPlan().toString()


def test_versions_and_plain_readers(spark, base):
    first = write_bucketed(spark.range(100).select("id", (F.col("id") % 7).alias("k")), base, "t", "k", 3)
    assert first.count() == 100 and len(first.inputFiles()) <= 3
    write_bucketed(spark.range(10).select("id", (F.col("id") % 7).alias("k")), base, "t", "k", 5)
    assert read_bucketed(spark, base, "t").count() == read_table(spark, base, "t").count() == 10
    other = spark.newSession()  # a session that has never seen the table
    assert read_bucketed(other, base, "t").count() == 10
    assert write_bucketed(spark.range(0).select("id", F.col("id").alias("k")), base, "none", "k", 2).count() == 0
    write_table(spark.range(3), base, "plain")
    with pytest.raises(ValueError):
        read_bucketed(spark, base, "plain")

import random
from datetime import datetime as dt

from pyspark.sql import functions as F

from tierstone.operators import joins, skew, windows

DIM = [
    ("a", dt(2000, 1, 1), dt(2001, 1, 1), False, 1),
    ("a", dt(2001, 1, 1), dt(9999, 12, 31), True, 2),
    ("b", dt(2000, 6, 1), dt(9999, 12, 31), True, 3),
    ("c", dt(2000, 1, 1), dt(2000, 2, 1), False, 4),
]


def dimension(spark):
    return spark.createDataFrame(DIM, "k string, valid_from timestamp, valid_to timestamp, is_current boolean, v int")


def events(spark):
    rng = random.Random(7)
    rows = [(i, "a" if i % 3 else rng.choice(["a", "b", "c", "d", None]), dt(2000, rng.randint(1, 12), 1))
            for i in range(300)]
    rows += [(1000, "a", dt(2001, 1, 1)), (1001, "a", dt(1999, 12, 31)), (1002, "b", dt(2000, 6, 1)),
             (1003, "c", dt(2000, 2, 1)), (1004, None, dt(2000, 7, 1)), (1005, "a", None)]
    return rows, spark.createDataFrame(rows, "id int, k string, ts timestamp")


def brute_force(rows):
    return {
        i: next((v for key, lo, hi, _, v in DIM if key == k and ts is not None and lo <= ts < hi), None)
        for i, k, ts in rows
    }


def test_point_in_time_join_equals_brute_force_with_and_without_splitting(spark):
    rows, df = events(spark)
    want = brute_force(rows)
    for share in (None, 0.2):
        got = joins.point_in_time_join(df, dimension(spark), "k", "ts", {"v": "version"}, hot_share=share)
        assert got.columns == ["id", "k", "ts", "version"]
        assert [(r.id, r.version) for r in got.orderBy("id").collect()] == sorted(want.items())


def test_orphans_are_the_unmatched(spark):
    rows, df = events(spark)
    got = {r.id for r in joins.orphans(df, dimension(spark), "k", "ts").collect()}
    assert got == {i for i, v in brute_force(rows).items() if v is None}


def test_fk_flags_agree(spark):
    rows, df = events(spark)
    keys = joins.current_keys(dimension(spark), "k")
    want = sorted((i, k in ("a", "b")) for i, k, _ in rows)
    missing = joins.missing_keys(df, "k", keys)
    assert {r.k for r in missing.collect()} == {"c", "d"}
    for flagged in (
        joins.fk_flag(df, "k", keys, "ok"),
        joins.fk_flag(df, "k", keys, "ok", hot_share=0.3, hot_parts=4),
        joins.fk_flag_by_missing(df, "k", missing, "ok"),
    ):
        assert sorted((r.id, r.ok) for r in flagged.collect()) == want
        assert flagged.columns == ["id", "k", "ts", "ok"]


def test_hot_keys_are_bounded_and_found(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    assert [r.k for r in skew.hot_keys(df, "k", 0.1).collect()] == [-1]


def test_null_keys_spread_over_all_salts(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 10 >= 6, F.col("id")).alias("k"), "id")
    small = spark.range(500).select(F.col("id").alias("s"))
    left, _ = skew.split_hot_keys(df, small, "k", "s", 0.5, 8)
    sizes = {r[skew.SALT]: r["count"] for r in left.filter("k is null").groupBy(skew.SALT).count().collect()}
    assert set(sizes) == set(range(8)) and max(sizes.values()) < 600 / 4


def test_orphans_with_hot_keys_split(spark):
    fact = spark.range(300).select(F.when(F.col("id") % 3 > 0, F.lit("a")).alias("k"), F.lit("2020-06-01").cast("timestamp").alias("ts"), "id")
    fact = fact.unionByName(fact.limit(5).withColumn("k", F.lit("zz")))
    plain = joins.orphans(fact, dimension(spark), "k", "ts")
    split = joins.orphans(fact, dimension(spark), "k", "ts", hot_share=0.2, hot_parts=4)
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect())) and plain.columns == split.columns


def test_hot_key_rows_spread_over_salts(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), "id")
    small = spark.createDataFrame([("hot",), ("cold",)], "s string")
    left, right = skew.split_hot_keys(df, small, "k", "s", 0.5, 8)
    sizes = [r["count"] for r in left.groupBy(skew.SALT).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 250
    assert right.count() == 8 + 1


def test_rank_by_counts_equals_rank(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["x", "y", None]), rng.choice([None, 1, 2, 2, 3]), i) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, n int, id int")
    got = windows.with_rank(df, ["g"], "n", "r").select("id", F.col("r").cast("int"))
    want = df.select("id", windows.rank_in(["g"], "n").alias("r"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_period_columns(spark):
    rows = [("a", 1, 10), ("a", 2, 0), ("a", 5, 5), ("a", 6, 7), ("b", 1, 4)]
    df = spark.createDataFrame(rows, "k string, m int, n int")
    w = windows.periods(["k"], ["m"])
    got = df.withColumns(
        {
            "p": windows.prior("n", w),
            "s": windows.rolling(F.sum, "n", w, 3),
            "c": windows.cumulative(F.sum, "n", w),
        }
    ).withColumns({"pct": windows.pct_change("n", "p"), "d": windows.delta("n", "p", 0)})
    assert [tuple(r)[2:] for r in got.orderBy("k", "m").collect()] == [
        (10, None, 10, 10, None, None),
        (0, 10, 10, 10, -100.0, -10),
        (5, 0, 15, 15, None, 5),
        (7, 5, 12, 22, 40.0, 2),
        (4, None, 4, 4, None, None),
    ]


def test_period_windows_share_one_shuffle(spark):
    df = spark.createDataFrame([("a", 1, 10)], "k string, m int, n int")
    w = windows.periods(["k"], ["m"])
    plan = df.withColumns(
        {"p": windows.prior("n", w), "s": windows.rolling(F.sum, "n", w, 3), "c": windows.cumulative(F.sum, "n", w)}
    )._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_days_meet_instants_without_a_conversion_per_pair(spark):
    """Bounds within a day: the day belongs to the version that is valid as it begins."""
    bounds = ["2020-01-01 00:00:00", "2020-01-02 10:30:00", "2020-01-04 00:00:00", "2020-01-04 00:00:01", "9999-12-31 00:00:00", None]
    versions = [("k", i, a, b) for i, (a, b) in enumerate(zip(bounds, bounds[1:]))]
    versions = spark.createDataFrame(versions, "key string, n int, a string, b string")
    days = [("k", d) for d in ("2019-12-31", "2020-01-01", "2020-01-02", "2020-01-03", "2020-01-04", "2020-01-05", "9999-12-31", None)]
    for kind in ("timestamp", "timestamp_ntz"):
        dim = versions.select("key", "n", F.col("a").cast(kind).alias("valid_from"), F.col("b").cast(kind).alias("valid_to"))
        fact = spark.createDataFrame(days, "key string, d string").withColumn("day", F.col("d").cast("date"))
        joined = joins.point_in_time_join(fact, dim, "key", "day", ["n"])
        assert {r.d: r.n for r in joined.collect()} == {
            "2019-12-31": None, "2020-01-01": 0, "2020-01-02": 0, "2020-01-03": 1, "2020-01-04": 2, "2020-01-05": 3, "9999-12-31": None, None: None
        }
        assert {r.d for r in joins.orphans(fact, dim, "key", "day").collect()} == {"2019-12-31", "9999-12-31", None}
        for df in (joined, joins.orphans(fact, dim, "key", "day")):
            found = [line for line in df._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join Left" in line]
            assert len(found) == 1 and "cast(" not in found[0]

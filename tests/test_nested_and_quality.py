import pytest
from pyspark.sql import functions as F

from tierstone.operators import nested, quality
from tierstone.plans import checks, silver
from tierstone.plans.monitoring import SourceFrames, ingestion_metrics, quarantine_alerts
from tierstone.sources.bronze import SCHEMAS


def test_hours(spark):
    rows = [("9:0-22:30",), ("0:0-0:0",), (None,), ("closed",)]
    df = spark.createDataFrame(rows, "m string").select(F.struct(F.col("m").alias("Monday")).alias("hours"))
    flat = nested.flatten_hours(df, "hours", ("Monday",))
    assert [tuple(r) for r in flat.collect()] == [(9, 22), (0, 0), (None, None), (None, None)]


def test_attributes(spark):
    ddl = "attributes struct<RestaurantsPriceRange2:string,WiFi:string,HasTV:string,Alcohol:string,NoiseLevel:string>"
    spec = {k: nested.ATTRIBUTE_SPEC[k] for k in ("price_range", "wifi", "has_tv", "alcohol", "noise_level")}
    rows = [
        (("2", "u'free'", "True", "u'full_bar'", "u'average'"),),
        (("None", "'paid'", "false", "'beer_and_wine'", "'quiet'"),),
        ((None, None, None, None, None),),
    ]
    flat = nested.flatten_attributes(spark.createDataFrame(rows, ddl), "attributes", spec)
    assert [tuple(r) for r in flat.collect()] == [
        (2, "free", True, "full_bar", "average"),
        (None, "paid", False, "beer_and_wine", "quiet"),
        (None, "none", False, "none", ""),
    ]


def test_explode_delimited(spark):
    df = spark.createDataFrame([(1, "A, B"), (2, None), (3, ""), (4, "A,,B"), (5, "A, A")], "k int, c string")
    got = nested.explode_delimited(df, ["k"], "c", "category")
    assert sorted(map(tuple, got.collect())) == [(1, "A"), (1, "B"), (4, "A"), (4, "B"), (5, "A")]
    kept = nested.explode_delimited(df, ["k"], "c", "category", distinct=False)
    assert kept.filter("k = 5").count() == 2


def test_explode_events_keeps_total_and_position(spark):
    df = spark.createDataFrame([("a", "x, y,"), ("b", None), ("c", "z")], "k string, d string")
    got = nested.explode_events(df, ["k"], "d", "event", "total", "pos")
    assert sorted(map(tuple, got.collect())) == [("a", 2, 0, "x"), ("a", 2, 1, "y"), ("c", 1, 0, "z")]


def test_explode_array_drops_bad_elements(spark):
    df = spark.createDataFrame([(1, ["2019", "x", None]), (2, None), (3, [])], "k int, a array<string>")
    assert [tuple(r) for r in nested.explode_array(df, ["k"], "a", "y", "int").collect()] == [(1, 2019)]


def test_unparseable_split(spark):
    df = spark.createDataFrame([("2018-07-07 22:09:11",), ("garbage",), ("2018-07-07",), (None,)], "raw string")
    good, bad = quality.split_unparseable(df, "raw", "at")
    assert good.count() == 1 and {r.raw for r in bad.collect()} == {"garbage", "2018-07-07", None}


def test_first_failing_rule_names_the_row(spark):
    df = spark.createDataFrame([(None, None), (1, None), (1, 9), (1, 3)], "id int, stars int")
    rules = [
        ("null_id", F.col("id").isNull()),
        ("bad_stars", F.col("stars").isNull() | ~F.col("stars").between(1, 5)),
    ]
    tagged = quality.tag_rejects(df, rules)
    assert [r.reject_reason for r in tagged.collect()] == ["null_id", "bad_stars", "bad_stars", None]
    clean, rejected = quality.split_rejects(tagged)
    assert (clean.count(), rejected.count()) == (1, 3) and "reject_reason" not in clean.columns


def business_row(spark, **changes):
    row = {"business_id": "b", "name": "n", "latitude": 1.0, "longitude": 2.0, "stars": 4.0, "review_count": 3}
    df = spark.createDataFrame([{**row, **changes}], SCHEMAS["business"])
    return silver.tag_business(df).first()


@pytest.mark.parametrize(
    "changes, reason",
    [
        ({}, None),
        ({"business_id": None}, "null_business_id"),
        ({"name": None, "latitude": None}, "null_name"),
        ({"longitude": None}, "null_coordinates"),
        ({"stars": 5.5}, "invalid_stars"),
        ({"stars": None}, "invalid_stars"),
    ],
)
def test_business_rules(spark, changes, reason):
    assert business_row(spark, **changes).reject_reason == reason


def test_category_count_ignores_blanks(spark):
    assert business_row(spark, categories=None).category_count == 0
    assert business_row(spark, categories=" , A, B").category_count == 2


def test_user_shape(spark):
    df = spark.createDataFrame(
        [
            {"user_id": "u", "name": " Ann ", "member_since": "2010-05-01 10:00:00", "review_count": 10, "fans": 1,
             "average_stars": 3.5, "friends": ["x", "y"], "elite": ["2019", "20,x"], "compliment_hot": 2},
            {"user_id": "v", "name": "Bo", "member_since": "bad", "review_count": 30, "fans": 0},
        ],
        SCHEMAS["user"],
    )
    first, second = silver.tag_users(df, 2019).orderBy("user_id").collect()
    assert (first.user_name, first.friend_count, first.total_compliments, first.years_on_platform) == ("Ann", 2, 2, 9)
    assert first.is_currently_elite and first.user_tier == "elite" and first.engagement_score == 30 + 2 + 2 + 2
    assert second.reject_reason == "null_member_since" and second.is_currently_elite is False


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, valid_from timestamp, valid_to timestamp, is_current boolean")


def test_version_checks_pass_and_fail(spark):
    from datetime import datetime as dt

    good = frame(spark, [("a", dt(2000, 1, 1), dt(2001, 1, 1), False), ("a", dt(2001, 1, 1), dt(2010, 1, 1), True)])
    bad = frame(spark, [("a", dt(2000, 1, 1), dt(2002, 1, 1), True), ("a", dt(2001, 1, 1), dt(2001, 1, 1), True)])
    for check, args in (
        (checks.check_single_current, ("k",)), (checks.check_no_overlap, ("k",)), (checks.check_valid_window, ()),
    ):
        assert check(good, *args).isEmpty()
        assert not check(bad, *args).isEmpty()


def test_column_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, None), (None, "z")], "i int, s string")
    assert checks.check_not_null(df, "i").count() == 2
    assert [tuple(r) for r in checks.check_unique(df, "i").collect()] == [(1, 2)]
    assert [tuple(r) for r in checks.check_accepted(df, "s", ("a", "b")).collect()] == [("z", 1)]
    found = checks.column_violations(df, ("i",), {"s": ("a", "b")}).collect()
    assert [(r.test, r.column_name, r.violations) for r in found] == [
        ("not_null", "i", 2), ("accepted_values", "s", 1),
    ]


def test_explode_guard(spark):
    packed = spark.createDataFrame([(2,), (3,)], "n int")
    checks.explode_guard(packed, "n", spark.range(5))
    with pytest.raises(ValueError, match="4 rows, expected 5"):
        checks.explode_guard(packed, "n", spark.range(4))
    checks.explode_guard(packed.limit(0), "n", spark.range(0))


def test_count_preserved_with_rejects(spark):
    good = spark.createDataFrame([("a", 3), ("a", 3), ("b", 1)], "k string, total int")
    bad = spark.createDataFrame([("a", 3)], "k string, total int")
    assert [r.k for r in checks.check_count_preserved(good, "k", "total").collect()] == ["a"]
    assert checks.check_count_preserved(good, "k", "total", bad).isEmpty()


def test_metrics_and_alert_threshold(spark):
    sources = {
        "at": SourceFrames(spark.range(100), spark.range(95), spark.range(5)),
        "above": SourceFrames(spark.range(9999), spark.range(1), spark.range(501)),
        "empty": SourceFrames(spark.range(0), spark.range(0), None),
        "absent": SourceFrames(None, None, None),
    }
    metrics = ingestion_metrics(spark, sources, "r").cache()
    rates = {r.source_name: r.quarantine_rate_pct for r in metrics.collect()}
    assert rates == {"at": 5.0, "above": 5.01, "empty": 0.0, "absent": None}
    assert [r.source_name for r in quarantine_alerts(metrics).collect()] == ["above"]


def test_counts_taken_while_writing_cost_no_scan(spark):
    sources = {"known": SourceFrames(100, 95, 5), "partly": SourceFrames(None, spark.range(3), 7)}
    metrics = ingestion_metrics(spark, sources, "r")
    got = {r.source_name: (r.bronze_row_count, r.silver_row_count, r.quarantine_count, r.quarantine_rate_pct) for r in metrics.collect()}
    assert got == {"known": (100, 95, 5, 5.0), "partly": (None, 3, 7, None)}
    plan = ingestion_metrics(spark, {"known": sources["known"]}, "r")._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and "FileScan" not in plan


def test_column_tests_read_a_table_once(spark, base):
    rows = [("a", 1, "x"), ("a", 2, None), ("b", None, "y"), (None, 1, "x"), (None, 1, "z")]
    spark.createDataFrame(rows, "k string, i int, s string").write.parquet(f"{base}/t")
    found = checks.column_violations(spark.read.parquet(f"{base}/t"), ("k", "i"), {"s": ("x", "y")}, "k")
    assert {(r.test, r.column_name): r.violations for r in found.collect()} == {
        ("not_null", "k"): 2, ("not_null", "i"): 1, ("accepted_values", "s"): 1, ("unique", "k"): 1,
    }
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1

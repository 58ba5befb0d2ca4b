"""The lazy one-call forms of the silver jobs."""

import re

from pyspark.sql import functions as F

from tierstone.operators.joins import current_keys
from tierstone.operators.quality import tag_rejects
from tierstone.operators.scd import current_only, dedup_latest
from tierstone.plans import facts, silver
from tierstone.plans.checks import check_unique
from tierstone.sources.bronze import SCHEMAS

T0, T1 = "2020-01-01 00:00:00", "2021-01-01 00:00:00"


def bronze(spark, entity, rows):
    return spark.createDataFrame(rows, SCHEMAS[entity])


def business(spark, **changes):
    row = {"business_id": "b", "name": "n", "latitude": 1.0, "longitude": 2.0, "stars": 4.0, "review_count": 3,
           "categories": "A, B"}
    return bronze(spark, "business", [{**row, **changes}, {**row, "business_id": None}])


def users(spark, **changes):
    row = {"user_id": "u", "name": "n", "member_since": "2015-01-01", "review_count": 3, "fans": 1, "elite": ["2019"]}
    return bronze(spark, "user", [{**row, **changes}])


def dimension(spark, key, value):
    return spark.createDataFrame([(value, True)], f"{key} string, is_current boolean")


def dims(spark):
    return silver.silver_business(business(spark), None, T0)[0], silver.silver_users(users(spark), None, 2019, T0)[0]


def test_business_job_merges(spark):
    first, categories, rejected = silver.silver_business(business(spark), None, T0)
    assert first.count() == 1 and categories.count() == 2
    assert [r.reject_reason for r in rejected.collect()] == ["null_business_id"]
    second, _, _ = silver.silver_business(business(spark, stars=5.0), first, T1)
    rows = second.orderBy("valid_from").collect()
    assert [(r.stars, r.is_current, str(r.loaded_at)) for r in rows] == [(4.0, False, T0), (5.0, True, T1)]
    assert str(rows[0].valid_to) == str(rows[1].valid_from) == T1


def test_duplicate_keys_in_a_snapshot_give_one_version(spark):
    twice = business(spark).unionByName(business(spark, review_count=9))
    loaded = silver.silver_business(twice, None, T0)[0]
    assert [r.review_count for r in loaded.collect()] == [9]


def test_user_job_tracks_the_tier(spark):
    first, elite, _ = silver.silver_users(users(spark), None, 2019, T0)
    assert [tuple(r) for r in elite.collect()] == [("u", 2019)]
    second = silver.silver_users(users(spark), first, 2020, T1)[0]  # no longer elite this year
    assert [r.user_tier for r in second.orderBy("valid_from").collect()] == ["elite", "newcomer"]
    assert current_only(second).count() == 1


def test_review_job_with_target(spark):
    b, u = dims(spark)
    row = {"review_id": "r", "business_id": "b", "user_id": "u", "stars": 4.5, "text": "a b", "date": "2020-02-03"}
    first, rejected = silver.silver_reviews(bronze(spark, "review", [row, {**row, "user_id": None}]), b, u)
    got = first.first()
    assert (got.stars, got.text_word_count, got.total_votes, got.sentiment_proxy) == (4, 2, 0, "positive")
    assert [(r.reject_reason, r.text) for r in rejected.collect()] == [("orphan_user_id", "a b")]
    newer = bronze(spark, "review", [{**row, "stars": 1.0}, {**row, "review_id": "s"}])
    second, _ = silver.silver_reviews(newer, b, u, target=first)
    assert {(r.review_id, r.stars) for r in second.collect()} == {("r", 1), ("s", 4)}


def test_text_is_not_shuffled_unless_asked_for(spark, tmp_path):
    b, u = dims(spark)
    row = {"review_id": "r", "business_id": "b", "user_id": "u", "stars": 4.0, "text": "x", "date": "2020-02-03"}
    bronze(spark, "review", [row]).write.parquet(str(tmp_path / "r"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        clean, rejected = silver.silver_reviews(spark.read.parquet(str(tmp_path / "r")), b, u)
        with_text = re.compile(r"\btext#")
        sorted_rows = [line for line in plan(clean).splitlines() if "Project [review_id" in line]
        assert sorted_rows and not any(with_text.search(line.split("length(")[0]) for line in sorted_rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "text" in rejected.columns and "text" not in clean.columns


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tip_job(spark):
    b, u = dims(spark)
    row = {"business_id": "b", "user_id": "u", "text": "go", "date": "2020-02-03 10:00:00", "compliment_count": 5}
    tips, rejected = silver.silver_tips(
        bronze(spark, "tip", [row, {**row, "date": "2020-02-03 09:00:00"}, {**row, "text": "\n"}]), b, u
    )
    assert [(r.compliment_count, r.is_popular_tip, r.tip_year) for r in tips.collect()] == [(5, True, 2020)]
    assert [r.reject_reason for r in rejected.collect()] == ["empty_text"]


def test_tips_with_days_that_do_not_parse_stay_apart(spark):
    b, u = dims(spark)
    row = {"business_id": "b", "user_id": "u", "text": "go", "compliment_count": 1}
    days = ("soon", "later", "2018", "2018-07", "2018-07-07 garbage", "2018-07-07", "2018-07-07 10:00:00", None)
    tips, rejected = silver.silver_tips(bronze(spark, "tip", [{**row, "date": d} for d in days]), b, u)
    assert sorted(str(r.tip_date) for r in tips.collect()) == ["2018-07-07"] + ["None"] * 6
    assert rejected.isEmpty()


def test_hot_share_gives_the_same_rows(spark):
    b, u = dims(spark)
    tip = {"business_id": "b", "user_id": "u", "text": "go", "date": "2020-02-03", "compliment_count": 1}
    rows = [{**tip, "date": f"2020-02-{d:02d}", "business_id": [None, "b", "x"][d % 3]} for d in range(1, 28)]
    for job, entity, data in (
        (lambda df, **o: silver.silver_tips(df, b, u, **o), "tip", rows),
        (lambda df, **o: silver.silver_photos(df, b, **o), "photo", [{"photo_id": str(i), "business_id": r["business_id"]} for i, r in enumerate(rows)]),
        (lambda df, **o: silver.silver_reviews(df, b, u, **o), "review", [{"review_id": str(i), "stars": 3.0, "user_id": "u", **r} for i, r in enumerate(rows)]),
    ):
        df = spark.createDataFrame([{k: v for k, v in r.items() if k in SCHEMAS[entity]} for r in data], SCHEMAS[entity])
        for plain, split in zip(job(df), job(df, hot_share=0.2)):
            assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))


def test_photo_job_and_distribution(spark):
    b, _ = dims(spark)
    rows = [{"photo_id": "p", "business_id": "b", "label": " Food"}, {"photo_id": "q", "business_id": "x"}]
    photos, rejected = silver.silver_photos(bronze(spark, "photo", rows), b)
    assert [tuple(r) for r in silver.label_distribution(photos).collect()] == [("food", 1)]
    assert [r.reject_reason for r in rejected.collect()] == ["orphan_business_id"]


def test_checkin_job(spark):
    rows = [{"business_id": "b", "date": "2018-01-06 11:00:00, bad"}]
    good, bad = silver.silver_checkins(bronze(spark, "checkin", rows))
    got = good.first()
    assert (got.checkin_year, got.checkin_dow, got.is_weekend, got.total_checkins_for_business) == (2018, 7, True, 2)
    assert [r.checkin_ts_raw for r in bad.select(F.col("checkin_ts_raw")).collect()] == ["bad"]


def test_texts_are_fetched_for_the_very_line(spark):
    """Two lines that differ only in which key is NULL are told apart, one of them rejected."""
    b, u = dimension(spark, "business_id", "x"), dimension(spark, "user_id", "x")
    tip = {"business_id": "x", "user_id": None, "text": "go", "date": "2020-02-03", "compliment_count": 1}
    raw = bronze(spark, "tip", [tip, {**tip, "business_id": None, "user_id": "x"}, {**tip, "user_id": "x"}])
    review = {"review_id": "x", "business_id": "x", "user_id": None, "stars": 3.0, "text": "go", "date": "2020-02-03", "useful": 1, "funny": 1, "cool": 1}
    reviews = bronze(spark, "review", [review, {**review, "business_id": None, "user_id": "x"}, {**review, "user_id": "x"}])
    for rows, rules in ((raw, silver.tip_rules()), (reviews, silver.review_rules())):
        tagged = tag_rejects(silver.flag_keys(silver.metrics_only(rows), current_keys(b, "business_id"), current_keys(u, "user_id")), rules)
        rejected = tagged.filter("reject_reason is not null")
        one = rejected.filter("user_id is null")
        assert [(r.business_id, r.user_id, r.text) for r in silver.with_text(rows, one).collect()] == [("x", None, "go")]
        both = silver.with_text(rows, rejected).collect()
        assert len(both) == 2 and len({r.reject_reason for r in both}) == 2


def test_ties_in_which_column_is_null_do_not_depend_on_order(spark):
    rows = [("b", "n", "a", None), ("b", "n", None, "a")]
    kept = []
    for some in (rows, rows[::-1]):
        df = spark.createDataFrame(some, "business_id string, business_name string, city string, state string")
        kept.append(dedup_latest(df.coalesce(1), ["business_id"], [silver._content_order(df)]).collect())
    assert kept[0] == kept[1]


def test_tips_without_a_parsed_day_have_ids_of_their_own(spark):
    b, u = dimension(spark, "business_id", "b"), dimension(spark, "user_id", "u")
    tip = {"business_id": "b", "user_id": "u", "text": "go", "compliment_count": 1}
    tips, _ = silver.silver_tips(bronze(spark, "tip", [{**tip, "date": d} for d in ("soon", "later", "2020-02-03", None)]), b, u)
    keyed = tips.withColumn("tip_id", facts.surrogate_key("business_id", "user_id", "tip_day"))
    assert {r.tip_day for r in keyed.collect()} == {"soon", "later", "2020-02-03", None}
    assert check_unique(keyed, "tip_id").isEmpty()


def test_stored_rejects_meet_their_texts_without_a_shuffle(spark, base):
    rows = bronze(spark, "tip", [{"business_id": "x", "user_id": None, "text": f"go {i}", "date": "2020-02-03"} for i in range(50)])
    rows.write.parquet(f"{base}/raw")
    raw = spark.read.parquet(f"{base}/raw")
    silver.metrics_only(raw).filter("text_char_len = 4").withColumn("reject_reason", F.lit("r")).write.parquet(f"{base}/few")
    plan = silver.with_text(raw, spark.read.parquet(f"{base}/few"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    text_side = plan[plan.index("FileScan parquet [business_id"):] if "text" in plan else ""
    assert "hashpartitioning(_line" not in text_side


def test_rejects_are_shuffled_once_to_meet_their_texts(spark, base):
    """Repeats are dropped and texts are met by the same keys; repeated lines come back as often as they are, nulls and all."""
    review = {"review_id": "x", "business_id": "x", "user_id": None, "stars": 3.5, "text": "go", "date": "2020-02-03"}
    lines = [review, review, {**review, "business_id": None}, {**review, "text": None}, {**review, "text": "no", "stars": None}, {**review, "stars": -0.0}]
    raw = bronze(spark, "review", lines)
    few = silver.metrics_only(raw).filter("text_char_len = 2 and business_id is not null").withColumn("reject_reason", F.lit("r"))
    few.write.parquet(f"{base}/few")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = silver.with_text(raw, spark.read.parquet(f"{base}/few"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.schema[:9] == raw.schema[:9]
        assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 2
        got = sorted((r.business_id, r.user_id, r.text, str(r.stars), r.reject_reason) for r in found.collect())
        assert got == [("x", None, "go", s, "r") for s in ("-0.0", "3.5", "3.5")] + [("x", None, "no", "None", "r")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)

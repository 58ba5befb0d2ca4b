import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tierstone.functions import expressions as e
from tierstone.functions import features as ft
from tierstone.functions.hashing import change_hash, surrogate_key


def column(spark, expression, rows, ddl):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(expression).collect()]


@pytest.mark.parametrize(
    "expression, values, expected",
    [
        (ft.rating_tier, [5.0, 4.5, 4.4, 4.0, 3.5, 3.0, 2.9, None],
         ["exceptional", "exceptional", "great", "great", "good", "average", "below_average", "below_average"]),
        (ft.popularity_tier, [1000.0, 999.0, 200.0, 199.0, 50.0, 49.0, 10.0, 9.0, None],
         ["very_popular", "popular", "popular", "established", "established", "growing", "growing", "new", "new"]),
        (ft.price_tier, [1.0, 2.0, 3.0, 4.0, 5.0, None],
         ["budget", "moderate", "upscale", "fine_dining", "unknown", "unknown"]),
        (ft.sentiment, [5.0, 4.0, 3.0, 2.0, None], ["positive", "positive", "neutral", "negative", "negative"]),
    ],
)
def test_tiers_at_their_bounds(spark, expression, values, expected):
    assert column(spark, expression("v"), [(v,) for v in values], "v double") == expected


def test_user_tier_order_and_rank(spark):
    rows = [(True, 0, 0), (False, 100, 50), (False, 100, 49), (False, 25, 90), (False, 24, 90), (None, None, None)]
    tiers = column(spark, ft.user_tier("e", "r", "f"), rows, "e boolean, r int, f int")
    assert tiers == ["elite", "veteran", "active", "active", "newcomer", "newcomer"]
    ranks = column(spark, ft.tier_rank("t"), [(t,) for t in tiers] + [("other",)], "t string")
    assert ranks == [4, 3, 2, 2, 1, 1, 1]


def test_time_features_at_the_edges(spark):
    stamps = [datetime(2022, 1, 2, h) for h in (5, 6, 11, 12, 16, 17, 18, 21, 22)]
    df = spark.createDataFrame([(s,) for s in stamps], "ts timestamp").select(
        *[c.alias(n) for n, c in ft.time_features("ts", "x").items()]
    )
    rows = df.collect()
    assert [r.time_of_day for r in rows] == [
        "night", "morning", "morning", "afternoon", "afternoon", "evening", "evening", "evening", "night",
    ]
    assert [r.is_peak_hour for r in rows] == [False, False, True, True, False, False, True, True, False]
    assert rows[0].x_dow == 1 and rows[0].is_weekend and rows[0].x_date == date(2022, 1, 2)


def test_word_count_ignores_outer_whitespace(spark):
    texts = ["a b", "\na  b\t c ", " ", "", None, "één twee"]
    assert column(spark, ft.word_count("t"), [(t,) for t in texts], "t string") == [2, 3, 0, 0, None, 2]


def test_ratios(spark):
    rows = [(1, 3), (0, 5), (5, 0), (None, 2)]
    assert column(spark, e.safe_pct("a", "b"), rows, "a int, b int") == [33.3, 0.0, None, None]
    assert column(spark, e.safe_ratio("a", "b", 2), rows, "a int, b int") == [0.33, 0.0, None, None]
    assert column(spark, e.safe_pct("a", "b"), [(1, 1), (0, 1)], "a int, b int") == [100.0, 0.0]


def test_null_safe_sum_and_labels(spark):
    assert column(spark, e.null_safe_sum("a", "b"), [(1, None), (None, None)], "a int, b int") == [1, 0]
    labels = [(" Food ",), ("MENU",), ("other",), (None,)]
    assert column(spark, e.normalize_label("l", ("food", "menu")), labels, "l string") == [
        "food", "menu", "unknown", "unknown",
    ]


def test_captions(spark):
    df = spark.createDataFrame([(" a b ",), ("  ",), (None,)], "c string")
    rows = df.select(*[c.alias(n) for n, c in ft.caption_features("c").items()]).collect()
    assert [tuple(r) for r in rows] == [("a b", True, 3), ("", False, 0), ("", False, 0)]


def test_validity_is_half_open(spark):
    rows = [(1, 1, 2), (2, 1, 2), (0, 1, 2), (None, 1, 2)]
    assert column(spark, e.valid_at("t", "f", "u"), rows, "t int, f int, u int") == [True, False, False, None]


def test_hash_tells_null_positions_apart(spark):
    rows = [("a", None, "b"), ("a", "b", None)]
    ddl = "x string, y string, z string"
    marked = column(spark, change_hash("x", "y", "z"), rows, ddl)
    plain = column(spark, change_hash("x", "y", "z", null_token=None), rows, ddl)
    assert marked[0] != marked[1] and plain[0] == plain[1]
    full = [("a", "b", "c")]
    assert column(spark, change_hash("x", "y", "z"), full, ddl) == column(
        spark, change_hash("x", "y", "z", null_token=None), full, ddl
    )
    keys = column(spark, surrogate_key("x", "y"), rows, ddl)
    assert len(set(keys)) == 2 and len(keys[0]) == 32


def test_count_when_skips_null(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "p boolean")
    assert df.agg(e.count_when(F.col("p"))).first()[0] == 1


def test_words_are_counted_in_one_pass(spark):
    texts = ["a", " \x0b\f\r\n\t ", "a" * 30 + " " * 30, "\r\na\x0bb\fc\u00a0d\u2003e", "w ww $1 \\", "\ud83d\ude00 \x01"]
    texts = [t.encode("utf-16", "surrogatepass").decode("utf-16") for t in texts]
    expected = [len([w for w in re.split("[ \t\n\x0b\f\r]+", t) if w]) for t in texts]
    assert column(spark, ft.word_count("t"), [(t,) for t in texts], "t string") == expected
    plan = spark.createDataFrame([("a b",)], "t string").select(ft.word_count("t").alias("n"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_replace(") == 1


def test_words_of_batches_are_those_of_the_expression(spark):
    texts = ["", None, " ", "a", " a", "a ", "\na  b\t c ", "b\x0bc\fd\re f g", "één", None, "", "x y"] * 7
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(3)
    both = rows.select("t", ft.word_count("t").alias("a"), ft.batched_word_count("t").alias("b")).collect()
    assert len(both) == len(texts) and all(r.a == r.b for r in both)


def test_reviews_and_tips_count_words_in_batches(spark):
    from tierstone.plans.silver import measure_text

    measured = measure_text(spark.createDataFrame([("a b", 1), (None, 2), (" ", 3)], "text string, i int"))
    assert [tuple(r) for r in measured.select("text_char_len", "text_word_count").orderBy("i").collect()] == [(3, 2), (None, None), (1, 0)]
    assert "regexp_replace" not in measured._jdf.queryExecution().optimizedPlan().toString()

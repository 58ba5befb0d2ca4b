"""Incremental monthly trends against full rebuilds."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tierstone.plans import aggregates, refresh
from tierstone.sources import clustering
from tierstone.sources.tables import read_table, write_table

FACT = (
    "review_id string, business_id string, business_name string, city string, state string, stars int, text_word_count int, total_votes int, useful int, "
    "sentiment_proxy string, is_high_quality boolean, reviewer_segment string, review_date date, review_year int, review_month int"
)
TIPS = "business_id string, tip_year int, tip_month int, compliment_count int, is_popular_tip boolean"


def review(rng, i, year=None):
    b, day = rng.randrange(8), date(year or rng.randint(2010, 2014), rng.randint(1, 12), rng.randint(1, 28))
    stars = rng.randint(1, 5)
    return (f"r{i}", f"b{b}", f"B{b}", "ab"[b % 2], "s", stars, rng.randint(1, 99), rng.randint(0, 9), 1, "positive" if stars > 3 else "negative", b > 3, "x", day, day.year, day.month)


def build(spark, base, fact, tips):
    monthly = write_table(aggregates.reviews_monthly(fact), base, "gold/reviews_monthly", ("review_year",))
    return write_table(aggregates.monthly_trends(monthly, aggregates.tips_monthly(tips)), base, "gold/agg_business_monthly", ("review_year",))


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def files_of(spark, base, name):
    per_file = clustering.file_ranges(read_table(spark, base, name), "review_month").select("file").collect()
    return {r.file for r in per_file}


@pytest.mark.parametrize("seed,only", [(1, None), (2, 2013)])
def test_refresh_equals_a_rebuild_and_leaves_other_years_alone(spark, base, seed, only):
    rng = random.Random(seed)
    before = {i: review(rng, i) for i in range(250)}
    tips = spark.createDataFrame([(f"b{rng.randrange(8)}", rng.randint(2010, 2014), rng.randint(1, 12), rng.randint(0, 9), True) for _ in range(60)], TIPS)
    after = dict(before)
    for i in rng.sample(sorted(before), 12):
        if only is None or before[i][-2] >= only:
            after[i] = review(rng, i, only)  # moved to another month, perhaps another business
    for i in rng.sample(sorted(before), 5):
        if only is None or before[i][-2] >= only:
            del after[i]
    after[999] = review(rng, 999, only)
    old, new = (spark.createDataFrame(list(x.values()), FACT) for x in (before, after))
    build(spark, f"{base}/kept", old, tips)
    whole = build(spark, f"{base}/whole", new, tips)
    files = files_of(spark, f"{base}/kept", "gold/agg_business_monthly")
    moved = [r[-14:-13] + r[-2:] for i in set(before) | set(after) for r in (before.get(i), after.get(i)) if r and before.get(i) != after.get(i)]
    changed = spark.createDataFrame(moved, "business_id string, review_year int, review_month int")
    years = refresh.refresh_business_monthly(f"{base}/kept", new, tips, changed)
    got = read_table(spark, f"{base}/kept", "gold/agg_business_monthly")
    assert rows_of(got) == rows_of(whole)
    assert rows_of(read_table(spark, f"{base}/kept", "gold/reviews_monthly")) == rows_of(read_table(spark, f"{base}/whole", "gold/reviews_monthly"))
    same = {f for f in files if not any(f"review_year={y}/" in f for y in years)}
    assert same <= files_of(spark, f"{base}/kept", "gold/agg_business_monthly")
    if only:
        assert years and min(years) >= only and same
    assert refresh.refresh_business_monthly(f"{base}/kept", new, tips, changed.limit(0)) == []


def test_a_year_that_is_gone_loses_its_folder(spark, base):
    rng = random.Random(5)
    rows = [review(rng, i, 2010 + i % 2) for i in range(40)] + [review(rng, 100, 2014)]
    tips = spark.createDataFrame([], TIPS)
    fact = spark.createDataFrame(rows, FACT)
    build(spark, base, fact, tips)
    less = fact.filter("review_year < 2014")
    changed = fact.filter("review_year = 2014").select(*refresh.MONTH)
    assert refresh.refresh_business_monthly(base, less, tips, changed) == [2014]
    assert {r.review_year for r in read_table(spark, base, "gold/agg_business_monthly").collect()} == {2010, 2011}


def plain_stale(present, changed, reach):
    out = set()
    for key, when in changed:
        later = sorted(p for k, p in present if k == key and p >= when)
        steps = later if reach is None else later[: reach + (1 if later and later[0] == when else 0)]
        out |= {(key, p) for p in steps}
    return out


@pytest.mark.parametrize("reach", [0, 1, 2, None])
def test_stale_periods_match_brute_force(spark, reach):
    rng = random.Random(7)
    for _ in range(4):
        present = {(rng.choice("abc"), rng.randrange(15)) for _ in range(25)}
        changed = {(rng.choice("abcd"), rng.randrange(15)) for _ in range(4)}
        frames = [spark.createDataFrame(sorted(x), "k string, p int") for x in (present, changed)]
        got = {tuple(r) for r in refresh.stale_periods(*frames, "k", ["p"], reach).collect()}
        assert got == plain_stale(present, changed, reach)


def test_longest_look_back():
    assert refresh.longest({"a": 1, "b": 2}) == 2 and refresh.longest({"a": 1, "b": None}) is None
    assert refresh.longest(refresh.LOOK_BACK) is None


def test_changed_months_hold_old_and_new_places(spark):
    rng = random.Random(8)
    a, b = review(rng, 1, 2010), review(rng, 2, 2011)
    moved = (*a[:-3], date(2012, 5, 5), 2012, 5)
    months = refresh.changed_months(spark.createDataFrame([a, b], FACT), spark.createDataFrame([moved], FACT))
    assert {(r.review_year, r.review_month) for r in months.collect()} == {a[-2:], (2012, 5)}
    assert months.filter(F.col("review_year") == 2011).isEmpty()


def test_incremental_query_stores_one_copy_of_the_facts(spark, monkeypatch):
    from tierstone.workload import queries
    from tierstone.workload.frames import Frames

    names, stored = [], Frames.stored
    monkeypatch.setattr(Frames, "stored", lambda self, name, df: (names.append(name), stored(self, name, df))[1])
    assert not queries.QUERIES["incremental_business_monthly"](spark, "/root/testdata/sf0.001").isEmpty()
    assert [n for n in names if n.endswith("/fact_reviews")] == ["now/fact_reviews"]

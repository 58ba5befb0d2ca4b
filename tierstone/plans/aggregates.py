"""Gold aggregates.

All three reduce the fact to small partial sums *before* any join or window, so
a business, user or city that holds a large share of the rows costs one partial
row per map task and period, and every window runs over at most one row per
calendar period or per entry of a fixed vocabulary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import bucket, count_when, safe_pct, safe_ratio
from ..operators.windows import cumulative, delta, pct_change, periods, prior, rank_in, rolling, with_rank
from .silver import Stamp, stamp

# --- fixed values: thresholds of the trend labels ---
TREND_STEP = 0.1


def _rows() -> Column:
    return F.count(F.lit(1))


def tips_monthly(fact_tips: DataFrame) -> DataFrame:
    """A4: tips per business and month."""
    return fact_tips.groupBy("business_id", "tip_year", "tip_month").agg(
        _rows().alias("tip_count"),
        F.sum("compliment_count").alias("total_tip_compliments"),
        count_when(F.col("is_popular_tip")).alias("popular_tip_count"),
    )


def reviews_monthly(fact_reviews: DataFrame) -> DataFrame:
    """A5: one row per business and month, described as at its last review of the month.

    First pass: hash aggregation per description, on fixed-width buffers only.
    Second pass, over those few rows: combine a month's descriptions.
    """
    month = ["business_id", "review_year", "review_month"]
    described = ["business_name", "city", "state"]
    partial = fact_reviews.groupBy(*month, *described).agg(
        _rows().alias("review_count"),
        F.sum("stars").alias("_stars"),
        F.sum("text_word_count").alias("_words"),
        F.sum("total_votes").alias("total_votes"),
        F.sum("useful").alias("useful_votes"),
        count_when(F.col("sentiment_proxy") == "positive").alias("positive_reviews"),
        count_when(F.col("sentiment_proxy") == "negative").alias("negative_reviews"),
        count_when(F.col("is_high_quality")).alias("high_quality_reviews"),
        count_when(F.col("reviewer_segment") == "elite_reviewer").alias("elite_reviewer_count"),
        F.max("review_date").alias("_last"),
    )
    sums = (
        "review_count", "_stars", "_words", "total_votes", "useful_votes", "positive_reviews",
        "negative_reviews", "high_quality_reviews", "elite_reviewer_count",
    )
    combined = partial.groupBy(*month).agg(
        F.max_by(F.struct(*described), "_last").alias("_as_described"), *[F.sum(c).alias(c) for c in sums]
    )
    return combined.select(
        *month,
        "_as_described.*",
        "review_count",
        safe_ratio("_stars", "review_count", 2).alias("avg_stars"),
        safe_ratio("_words", "review_count", 0).alias("avg_review_length"),
        *sums[3:],
        safe_pct("positive_reviews", "review_count").alias("positive_pct"),
    )


def agg_business_monthly(
    fact_reviews: DataFrame,
    fact_tips: DataFrame,
    rank_keys: Sequence[str] = ("city",),
    load_ts: Stamp | None = None,
) -> DataFrame:
    """M7: monthly performance per business, with trend, rolling, running and rank columns."""
    return monthly_trends(reviews_monthly(fact_reviews), tips_monthly(fact_tips), rank_keys, load_ts)


def monthly_trends(
    reviews: DataFrame, tips: DataFrame, rank_keys: Sequence[str] = ("city",), load_ts: Stamp | None = None
) -> DataFrame:
    """M7 from :func:`reviews_monthly` and :func:`tips_monthly`.

    Months without reviews are not in the result, and "previous" means the
    previous month present. ``rank_keys`` sets who competes within a month.
    ``reviews`` is read twice, for the trends and for the rank counts: hand in a
    written table where the fact behind it is large.
    """
    trended = business_trends(reviews, tips)
    ranked = with_rank(
        trended, [*rank_keys, "review_year", "review_month"], "review_count", "city_monthly_rank", counted=reviews
    )
    return stamp(ranked, "aggregated_at", load_ts)


def business_trends(reviews: DataFrame, tips: DataFrame) -> DataFrame:
    """M7 without the rank: every column that looks at one business only."""
    same_month = (
        (reviews["business_id"] == tips["business_id"])
        & (reviews["review_year"] == tips["tip_year"])
        & (reviews["review_month"] == tips["tip_month"])
    )
    tip_columns = ("tip_count", "total_tip_compliments", "popular_tip_count")
    base = reviews.join(tips, same_month, "left").select(
        reviews["*"], *[F.coalesce(tips[c], F.lit(0)).alias(c) for c in tip_columns]
    )
    base = base.withColumn("total_engagement", F.col("review_count") + F.col("tip_count"))
    by_month = periods(["business_id"], ["review_year", "review_month"])
    # Decimal, because a mean of doubles that ends in a 5 could round either way.
    two_digits = F.col("avg_stars").cast("decimal(10,2)")
    return base.withColumns(
        {
            "prior_month_reviews": prior("review_count", by_month),
            "prior_month_avg_stars": prior("avg_stars", by_month),
            "rolling_3m_avg_stars": F.round(rolling(F.avg, two_digits, by_month, 3), 2).cast("double"),
            "cumulative_reviews": cumulative(F.sum, "review_count", by_month),
            "rolling_3m_tip_count": rolling(F.sum, "tip_count", by_month, 3),
        }
    ).withColumns(
        {
            "review_count_mom_pct": pct_change("review_count", "prior_month_reviews"),
            "stars_mom_delta": delta("avg_stars", "prior_month_avg_stars"),
            "rating_trend": rating_trend("avg_stars", "prior_month_avg_stars"),
        }
    )


def rating_trend(stars: str, previous: str) -> Column:
    """Direction of the rating against the previous period."""
    stars, previous = F.col(stars), F.col(previous)
    return bucket(
        [("improving", stars > previous + TREND_STEP), ("declining", stars < previous - TREND_STEP)], "stable"
    )


def growth_label(change: str) -> Column:
    """Size of the yearly change; the steeper decline is tested first."""
    change = F.col(change)
    return bucket(
        [
            ("fast_growing", change > 20),
            ("growing", change > 5),
            ("fast_declining", change < -20),
            ("declining", change < -5),
        ],
        "stable",
    )


def agg_city_category(
    fact_reviews: DataFrame,
    categories: DataFrame,
    rank_keys: Sequence[str] = ("city",),
    load_ts: Stamp | None = None,
) -> DataFrame:
    """M8: yearly review performance per city and category.

    Reviews are summed per business and year before they fan out by category.
    Review ids are unique in the fact and (business, category) pairs in the
    bridge, so counting rows counts distinct reviews.
    """
    per_business = fact_reviews.groupBy("business_id", "review_year", "city", "state").agg(
        _rows().alias("review_count"),
        F.sum("stars").alias("_stars"),
        F.sum("total_votes").alias("total_votes"),
        count_when(F.col("sentiment_proxy") == "positive").alias("positive_reviews"),
        count_when(F.col("sentiment_proxy") == "negative").alias("negative_reviews"),
        count_when(F.col("is_high_quality")).alias("high_quality_reviews"),
    )
    sums = (
        "review_count", "_stars", "total_votes", "positive_reviews", "negative_reviews", "high_quality_reviews",
    )
    named = categories.filter(F.col("category") != "")
    yearly = (
        per_business.join(named, "business_id")
        .groupBy("review_year", "city", "state", "category")
        .agg(*[F.sum(c).alias(c) for c in sums])
        .withColumns(
            {
                "avg_stars": safe_ratio("_stars", "review_count", 2),
                "positive_pct": safe_pct("positive_reviews", "review_count"),
            }
        )
        .drop("_stars")
    )
    by_year = periods(["city", "state", "category"], ["review_year"])
    compared = yearly.withColumns(
        {
            "prior_year_reviews": prior("review_count", by_year),
            "_prior_stars": prior("avg_stars", by_year),
            "cumulative_reviews": cumulative(F.sum, "review_count", by_year),
        }
    ).withColumns(
        {
            "review_count_yoy_pct": pct_change("review_count", "prior_year_reviews"),
            "stars_yoy_delta": delta("avg_stars", "_prior_stars"),
            # at most one row per category (and state) competes in a city and year
            "category_rank_in_city": rank_in(["review_year", *rank_keys], "review_count"),
        }
    )
    labelled = compared.withColumn("growth_label", growth_label("review_count_yoy_pct")).drop("_prior_stars")
    return stamp(labelled, "aggregated_at", load_ts)


def agg_user_cohort(fact_reviews: DataFrame, dim_user: DataFrame, load_ts: Stamp | None = None) -> DataFrame:
    """M9: activity per join-year cohort and year, with retention against year zero.

    Reviews are summed per user and year first. Each user then is one row per
    year, and review ids are unique in the fact (Q2), which turns both distinct
    counts into plain sums.
    """
    per_user = fact_reviews.groupBy("user_id", "review_year").agg(
        _rows().alias("total_reviews"),
        F.sum("stars").alias("_stars"),
        F.sum("text_word_count").alias("_words"),
        count_when(F.col("is_high_quality")).alias("high_quality_reviews"),
        count_when(F.col("sentiment_proxy") == "positive").alias("positive_reviews"),
    )
    members = dim_user.filter(F.col("is_current")).select(
        "user_id", F.col("member_join_year").alias("cohort_year"), (F.col("user_tier") == "elite").alias("_elite")
    )
    active = per_user.join(members, "user_id").filter(F.col("review_year") >= F.col("cohort_year"))
    yearly = (
        active.groupBy("cohort_year", "review_year")
        .agg(
            _rows().alias("active_users"),
            *[F.sum(c).alias(c) for c in ("total_reviews", "high_quality_reviews", "positive_reviews")],
            F.sum("_stars").alias("_stars"),
            F.sum("_words").alias("_words"),
            F.coalesce(F.sum(F.when(F.col("_elite"), F.col("total_reviews"))), F.lit(0)).alias("elite_user_reviews"),
            count_when(F.col("_elite")).alias("_elite_users"),
        )
        .withColumn("years_since_joining", F.col("review_year") - F.col("cohort_year"))
    )
    cohort = Window.partitionBy("cohort_year")
    at_start = F.col("years_since_joining") == 0
    measured = yearly.withColumns(
        {
            "reviews_per_active_user": safe_ratio("total_reviews", "active_users", 2),
            "avg_stars": safe_ratio("_stars", "total_reviews", 2),
            "avg_review_length": safe_ratio("_words", "total_reviews", 0),
            "high_quality_pct": safe_pct("high_quality_reviews", "total_reviews"),
            "positive_pct": safe_pct("positive_reviews", "total_reviews"),
            "elite_user_pct": safe_pct("_elite_users", "active_users"),
        }
    )
    compared = measured.withColumns(
        {
            "cohort_size_year_0": F.max(F.when(at_start, F.col("active_users"))).over(cohort),
            "baseline_avg_stars": F.max(F.when(at_start, F.col("avg_stars"))).over(cohort),
        }
    ).withColumns(
        {
            "retention_pct": safe_pct("active_users", "cohort_size_year_0"),
            "stars_vs_baseline": delta("avg_stars", "baseline_avg_stars"),
        }
    )
    return stamp(compared.drop("_stars", "_words", "_elite_users"), "aggregated_at", load_ts)

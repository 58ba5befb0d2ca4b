"""Gold facts: silver events joined to the dimension versions valid at event time.

``hot_share`` splits join keys that hold at least that share of the fact rows,
for sessions where the adaptive planner's own skew handling is off. ``join`` is
``point_in_time_join``, or ``as_of_join`` for dimensions with many versions a key; the rows are the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import at_least, at_most, bucket
from ..functions.features import HIGH_QUALITY_WORDS
from ..functions.hashing import surrogate_key
from ..operators.joins import point_in_time_join
from .silver import Stamp, stamp

Join = Callable[..., DataFrame]


def review_type(stars: str = "stars", words: str = "text_word_count") -> Column:
    """Tone and length of a review."""
    good, bad = F.col(stars) >= 4, F.col(stars) <= 2
    long, short = F.col(words) >= HIGH_QUALITY_WORDS, F.col(words) < HIGH_QUALITY_WORDS
    return bucket(
        [
            ("detailed_positive", good & long),
            ("brief_positive", good & short),
            ("detailed_negative", bad & long),
            ("brief_negative", bad & short),
        ],
        "neutral",
    )


def reviewer_segment(was_elite: str, tier: str) -> Column:
    """Who wrote the review."""
    return bucket(
        [("elite_reviewer", F.col(was_elite)), ("veteran_reviewer", F.col(tier) == "veteran")],
        "standard_reviewer",
    )


def tip_engagement_tier(compliments: str = "compliment_count") -> Column:
    return at_least(compliments, [(10, "viral"), (5, "popular"), (1, "engaged")], "no_engagement")


def tip_length_tier(words: str = "text_word_count") -> Column:
    return at_most(words, [(10, "very_brief"), (30, "brief"), (60, "detailed")], "very_detailed")


def fact_reviews(
    reviews: DataFrame,
    dim_business: DataFrame,
    dim_user: DataFrame,
    load_ts: Stamp | None = None,
    hot_share: float | None = None,
    join: Join = point_in_time_join,
) -> DataFrame:
    """M4: one row per review."""
    with_business = join(
        reviews,
        dim_business,
        "business_id",
        "review_date",
        {
            "business_key": "business_key",
            "business_name": "business_name",
            "city": "city",
            "state": "state",
            "stars": "business_stars_at_review_time",
            "price_tier": "price_tier",
            "status": "business_status_at_review_time",
            "category_count": "category_count",
        },
        hot_share=hot_share,
    )
    with_user = join(
        with_business,
        dim_user,
        "user_id",
        "review_date",
        {
            "user_key": "user_key",
            "user_tier": "user_tier_at_review_time",
            "is_currently_elite": "user_was_elite_at_review_time",
            "review_count": "user_total_reviews_at_review_time",
            "engagement_score": "user_engagement_at_review_time",
        },
        hot_share=hot_share,
    )
    classified = with_user.withColumns(
        {
            "review_type": review_type(),
            "reviewer_segment": reviewer_segment("user_was_elite_at_review_time", "user_tier_at_review_time"),
        }
    )
    return stamp(classified, "gold_loaded_at", load_ts)


def fact_tips(
    tips: DataFrame,
    dim_business: DataFrame,
    dim_user: DataFrame,
    load_ts: Stamp | None = None,
    hot_share: float | None = None,
    join: Join = point_in_time_join,
) -> DataFrame:
    """M5: one row per tip. The id takes the day as text, so tips whose day does not parse have ids of their own."""
    with_business = join(
        tips,
        dim_business,
        "business_id",
        "tip_date",
        {
            "business_key": "business_key",
            "business_name": "business_name",
            "city": "city",
            "state": "state",
            "price_tier": "price_tier",
            "rating_tier": "rating_tier",
            "status": "business_status_at_tip_time",
        },
        hot_share=hot_share,
    )
    with_user = join(
        with_business,
        dim_user,
        "user_id",
        "tip_date",
        {
            "user_key": "user_key",
            "user_tier": "user_tier_at_tip_time",
            "is_currently_elite": "user_was_elite_at_tip_time",
        },
        hot_share=hot_share,
    )
    classified = with_user.withColumns(
        {
            "tip_id": surrogate_key("business_id", "user_id", "tip_day"),
            "tip_engagement_tier": tip_engagement_tier(),
            "tip_length_tier": tip_length_tier(),
        }
    )
    return stamp(classified, "gold_loaded_at", load_ts)


def fact_checkins(
    checkins: DataFrame,
    dim_business: DataFrame,
    load_ts: Stamp | None = None,
    hot_share: float | None = None,
    join: Join = point_in_time_join,
) -> DataFrame:
    """M6: one row per check-in. The id includes the position in the packed source
    string, so two check-ins in the same second stay apart."""
    with_business = join(
        checkins,
        dim_business,
        "business_id",
        "checkin_at",
        {
            "business_key": "business_key",
            "business_name": "business_name",
            "city": "city",
            "state": "state",
            "price_tier": "price_tier",
            "status": "business_status",
        },
        hot_share=hot_share,
    )
    keyed = with_business.withColumn(
        "checkin_id", surrogate_key("business_id", "checkin_at", "checkin_ordinal")
    )
    return stamp(keyed, "gold_loaded_at", load_ts)

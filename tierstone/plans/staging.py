"""Staging projections over the silver tables.

Lazy projections; register them as views with ``createOrReplaceTempView``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.nested import ATTRIBUTE_SPEC, WEEKDAYS

# --- fixed values: the staging column contracts ---
_VERSION = ("valid_from", "valid_to", "is_current", "change_hash", "loaded_at")
_HOURS = tuple(f"{day[:3].lower()}_{edge}" for day in WEEKDAYS for edge in ("open", "close"))
BUSINESS = (
    "business_id", "business_name", "address", "city", "state", "postal_code", "latitude", "longitude",
    "stars", "review_count", "is_open", "categories", "category_count",
    *ATTRIBUTE_SPEC, *_HOURS, *_VERSION,
)
USERS = (
    "user_id", "user_name", "member_since", "review_count", "average_stars", "fans", "friend_count",
    "total_compliments", "votes_useful_given", "votes_funny_given", "votes_cool_given", "engagement_score",
    "user_tier", "is_currently_elite", "total_elite_years", "years_on_platform", *_VERSION,
)
REVIEWS = (
    "review_id", "business_id", "user_id", "review_date", "review_year", "review_month", "stars", "useful",
    "funny", "cool", "total_votes", "text_char_len", "text_word_count", "sentiment_proxy", "is_high_quality",
    "loaded_at",
)
CHECKINS = (
    "business_id", "checkin_at", "checkin_ordinal", "checkin_date", "checkin_year", "checkin_month",
    "checkin_hour", "checkin_dow", "is_weekend", "time_of_day", "is_peak_hour", "total_checkins_for_business",
    "loaded_at",
)
TIPS = (
    "business_id", "user_id", "tip_day", "tip_date", "tip_year", "tip_month", "compliment_count", "text_char_len",
    "text_word_count", "is_popular_tip", "loaded_at",
)


def _stage(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    # Load time is absent from frames built without a run, as in tests.
    return df.select(*[c for c in columns if c != "loaded_at" or c in df.columns])


def stg_business(silver: DataFrame) -> DataFrame:
    return _stage(silver, BUSINESS)


def stg_users(silver: DataFrame) -> DataFrame:
    return _stage(silver, USERS)


def stg_reviews(silver: DataFrame) -> DataFrame:
    return _stage(silver, REVIEWS)


def stg_checkins(silver: DataFrame) -> DataFrame:
    return _stage(silver, CHECKINS)


def stg_tips(silver: DataFrame) -> DataFrame:
    return _stage(silver, TIPS)

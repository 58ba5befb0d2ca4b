"""Gold dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import bucket
from ..functions.features import WEEKEND_DAYS, popularity_tier, price_tier, rating_tier, tier_rank
from ..functions.hashing import surrogate_key
from ..operators.spine import date_spine


def dim_business(staged: DataFrame) -> DataFrame:
    """M1: versioned business dimension; the key names one version, not one business."""
    full_service = F.col("delivery") & F.col("takeout") & F.col("reservations")
    return staged.select(
        surrogate_key("business_id", "valid_from").alias("business_key"),
        "*",
        bucket([("open", F.col("is_open"))], "closed").alias("status"),
        price_tier("price_range").alias("price_tier"),
        (F.col("sat_open").isNotNull() | F.col("sun_open").isNotNull()).alias("is_open_weekends"),
        F.coalesce(full_service, F.lit(False)).alias("is_full_service"),
        rating_tier("stars").alias("rating_tier"),
        popularity_tier("review_count").alias("popularity_tier"),
    )


def dim_user(staged: DataFrame) -> DataFrame:
    """M2: versioned user dimension."""
    return staged.select(
        surrogate_key("user_id", "valid_from").alias("user_key"),
        "*",
        F.year("member_since").alias("member_join_year"),
        tier_rank("user_tier").alias("tier_rank"),
    )


def calendar_columns(day: str = "calendar_date") -> dict:
    """The 18 derived calendar columns of M3."""
    d = F.col(day)
    dow = F.dayofweek(d)
    return {
        "date_key": F.date_format(d, "yyyyMMdd").cast("int"),
        "year": F.year(d),
        "quarter_num": F.quarter(d),
        "quarter_label": F.concat(F.lit("Q"), F.quarter(d).cast("string")),
        "month_num": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "month_abbr": F.date_format(d, "MMM"),
        "week_of_year": F.weekofyear(d),
        "day_name": F.date_format(d, "EEEE"),
        "day_abbr": F.date_format(d, "EEE"),
        "day_of_week": dow,
        "day_of_month": F.dayofmonth(d),
        "day_of_year": F.dayofyear(d),
        "is_weekend": dow.isin(*WEEKEND_DAYS),
        "last_day_of_month": F.last_day(d),
        "week_start_date": F.date_trunc("week", d),
        "month_start_date": F.date_trunc("month", d),
        "quarter_start_date": F.date_trunc("quarter", d),
    }


def dim_date(spark: SparkSession, start: str = "2004-01-01", end: str = "2022-12-31") -> DataFrame:
    """M3: one row per day of the range, both ends included."""
    return date_spine(spark, start, end).withColumns(calendar_columns())

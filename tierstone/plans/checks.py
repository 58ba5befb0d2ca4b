"""Data-quality checks. Each returns the violating rows or keys; empty means passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import orphans
from ..operators.scd import current_only
from ..operators.windows import periods


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Q1."""
    return df.filter(F.col(column).isNull())


def check_unique(df: DataFrame, *columns: str) -> DataFrame:
    """Q2: keys that occur more than once, with their count."""
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("occurrences"))
    present = [F.col(c).isNotNull() for c in columns]
    for test in present:
        counts = counts.filter(test)
    return counts.filter(F.col("occurrences") > 1)


def check_accepted(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Q3: values outside the list, with their count. NULL is left to Q1."""
    outside = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
    return outside.groupBy(column).agg(F.count(F.lit(1)).alias("occurrences"))


def check_single_current(dimension: DataFrame, key: str) -> DataFrame:
    """Q4: keys with more than one current version."""
    counts = current_only(dimension).groupBy(key).agg(F.count(F.lit(1)).alias("current_version_count"))
    return _fail(counts.filter(F.col("current_version_count") > 1), "more than one current version")


def check_count_preserved(
    exploded: DataFrame, key: str | Sequence[str], total: str, rejected: DataFrame | None = None
) -> DataFrame:
    """Q5: packed rows, by ``key``, whose exploded rows, good and rejected together, differ from the packed total."""
    keys = [key] if isinstance(key, str) else list(key)
    rows = exploded.select(*keys, total)
    if rejected is not None:
        rows = rows.unionByName(rejected.select(*keys, total))
    counts = rows.groupBy(*keys).agg(F.max(total).alias("expected_count"), F.count(F.lit(1)).alias("actual_count"))
    return _fail(
        counts.filter(F.col("expected_count") != F.col("actual_count")), "exploded rows differ from packed total"
    )


def check_no_orphans(fact: DataFrame, dimension: DataFrame, key: str, ts: str) -> DataFrame:
    """Q6: events without a dimension version at their time."""
    return _fail(orphans(fact, dimension, key, ts), "no dimension version at event time")


def check_valid_window(dimension: DataFrame) -> DataFrame:
    """Q10: versions that do not end after they begin."""
    return _fail(dimension.filter(F.col("valid_from") >= F.col("valid_to")), "version does not end after it begins")


def check_no_overlap(dimension: DataFrame, key: str) -> DataFrame:
    """Q11: versions that begin before an earlier version of the key has ended."""
    before = periods([key], ["valid_from", "valid_to"]).rowsBetween(Window.unboundedPreceding, -1)
    ended = dimension.withColumn("previous_valid_to", F.max("valid_to").over(before))
    return _fail(ended.filter(F.col("previous_valid_to") > F.col("valid_from")), "begins before an earlier version ends")


def _fail(violations: DataFrame, reason: str) -> DataFrame:
    return violations.withColumn("failure_reason", F.lit(reason))


def explode_counts(packed: DataFrame, sizes: str, exploded: DataFrame) -> DataFrame:
    """Q7/A2: one row with the rows an explode should give and the rows it gave."""
    expected = packed.agg(F.coalesce(F.sum(sizes), F.lit(0)).alias("expected_rows"))
    actual = exploded.agg(F.count(F.lit(1)).alias("actual_rows"))
    stacked = expected.unionByName(actual, allowMissingColumns=True)
    return stacked.agg(
        F.max("expected_rows").alias("expected_rows"), F.max("actual_rows").alias("actual_rows")
    ).withColumn("matches", F.col("expected_rows") == F.col("actual_rows"))


def explode_guard(packed: DataFrame, sizes: str, exploded: DataFrame) -> None:
    """Q7: raise unless the explode gave exactly the packed number of rows."""
    row = explode_counts(packed, sizes, exploded).first()
    explode_matches(row.expected_rows, row.actual_rows)


def explode_matches(expected: int, actual: int) -> None:
    """Q7 by counts taken while both sides were written."""
    if expected != actual:
        raise ValueError(f"explode gave {actual} rows, expected {expected}")


# --- fixed values: the declared column tests, by table ---
NOT_NULL: Mapping[str, tuple[str, ...]] = {
    "silver/business": ("business_id", "is_current", "change_hash"),
    "silver/users": ("user_id",),
    "silver/reviews": ("review_id", "stars"),
    "silver/checkins": ("business_id", "checkin_at"),
    "silver/tips": ("business_id", "user_id"),
    "silver/business_categories": ("business_id", "category"),
    "silver/user_elite_years": ("user_id", "elite_year"),
    "gold/dim_business": ("business_key", "business_id", "is_current", "valid_from", "stars", "status"),
    "gold/dim_user": ("user_key", "user_id", "user_tier", "tier_rank", "is_current"),
    "gold/dim_date": ("date_key", "calendar_date", "is_weekend"),
    "gold/fact_reviews": (
        "review_id", "business_key", "user_key", "review_date", "stars", "sentiment_proxy", "review_type",
        "reviewer_segment",
    ),
    "gold/fact_checkins": ("checkin_id", "business_id", "checkin_at", "time_of_day"),
    "gold/fact_tips": (
        "tip_id", "business_key", "user_key", "tip_date", "tip_engagement_tier", "tip_length_tier",
    ),
    "gold/agg_business_monthly": ("business_id", "review_year", "review_month"),
    "gold/agg_city_category": ("review_year", "city", "category"),
    "gold/agg_user_cohort": ("cohort_year", "review_year", "active_users"),
}
UNIQUE: Mapping[str, tuple[str, ...]] = {
    "silver/reviews": ("review_id",),
    "gold/dim_business": ("business_key",),
    "gold/dim_user": ("user_key",),
    "gold/dim_date": ("date_key", "calendar_date"),
    "gold/fact_reviews": ("review_id",),
    "gold/fact_checkins": ("checkin_id",),
    "gold/fact_tips": ("tip_id",),
}
ACCEPTED: Mapping[str, Mapping[str, tuple]] = {
    "silver/reviews": {"stars": (1, 2, 3, 4, 5)},
    "gold/dim_business": {
        "status": ("open", "closed"),
        "price_tier": ("budget", "moderate", "upscale", "fine_dining", "unknown"),
        "rating_tier": ("exceptional", "great", "good", "average", "below_average"),
        "popularity_tier": ("very_popular", "popular", "established", "growing", "new"),
    },
    "gold/dim_user": {"user_tier": ("elite", "veteran", "active", "newcomer")},
    "gold/fact_reviews": {
        "stars": (1, 2, 3, 4, 5),
        "sentiment_proxy": ("positive", "neutral", "negative"),
        "review_type": (
            "detailed_positive", "brief_positive", "detailed_negative", "brief_negative", "neutral",
        ),
        "reviewer_segment": ("elite_reviewer", "veteran_reviewer", "standard_reviewer"),
    },
    "gold/fact_checkins": {"time_of_day": ("morning", "afternoon", "evening", "night")},
    "gold/fact_tips": {
        "tip_engagement_tier": ("viral", "popular", "engaged", "no_engagement"),
        "tip_length_tier": ("very_brief", "brief", "detailed", "very_detailed"),
    },
    "gold/agg_business_monthly": {"rating_trend": ("improving", "declining", "stable")},
    "gold/agg_city_category": {
        "growth_label": ("fast_growing", "growing", "stable", "declining", "fast_declining"),
    },
}


def column_violations(
    df: DataFrame, not_null: Sequence[str], accepted: Mapping[str, Sequence], unique: str | None = None
) -> DataFrame:
    """All not-null and accepted-values tests of one table, and one uniqueness test, in one pass over it.

    One row per failed test: ``test, column_name, violations``. With ``unique`` rows are counted per value of that column,
    combined before the shuffle, and the other tests' counts ride along.
    """
    tests = {}
    for column in not_null:
        tests["not_null", column] = F.count_if(F.col(column).isNull())
    for column, values in accepted.items():
        tests["accepted_values", column] = F.count_if(~F.col(column).isin(list(values)))
    names = [f"t{i}" for i in range(len(tests))]
    counts = [expr.alias(name) for name, expr in zip(names, tests.values())]
    if unique is None:
        counted = df.agg(*counts)
    else:
        per_value = df.groupBy(F.col(unique).alias("value")).agg(*counts, F.count(F.lit(1)).alias("n"))
        doubled = F.count_if(F.col("value").isNotNull() & (F.col("n") > 1)).alias("doubled")
        counted = per_value.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in names], doubled)
        tests["unique", unique] = None
        names.append("doubled")
    lines = [
        F.struct(F.lit(kind).alias("test"), F.lit(column).alias("column_name"), F.col(name).alias("violations"))
        for (kind, column), name in zip(tests, names)
    ]
    return counted.select(F.inline(F.array(*lines))).filter(F.col("violations") > 0)


def run_column_tests(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Q1–Q3 over every declared table present: one row per failed test. A table is read once, and once
    more for each further unique column."""
    results = []
    for name, df in tables.items():
        first, *others = UNIQUE.get(name, ()) or (None,)
        if name in NOT_NULL:
            found = column_violations(df, NOT_NULL[name], ACCEPTED.get(name, {}), first)
            results.append(found.select(F.lit(name).alias("table_name"), "*"))
        for column in others:
            duplicates = column_violations(df, (), {}, column)
            results.append(duplicates.select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, results)


def run_table_tests(tables: Mapping[str, DataFrame], rejected_checkins: DataFrame | None = None) -> DataFrame:
    """Q4, Q5, Q6, Q10, Q11 over the built tables: one row per failed test."""
    business, users = tables["gold/dim_business"], tables["gold/dim_user"]
    found = {
        ("gold/dim_business", "single_current"): check_single_current(business, "business_id"),
        ("gold/dim_user", "single_current"): check_single_current(users, "user_id"),
        ("gold/dim_business", "valid_window"): check_valid_window(business),
        ("gold/dim_user", "valid_window"): check_valid_window(users),
        ("gold/dim_business", "no_overlap"): check_no_overlap(business, "business_id"),
        ("gold/dim_user", "no_overlap"): check_no_overlap(users, "user_id"),
        ("gold/fact_reviews", "no_orphans"): check_no_orphans(
            tables["gold/fact_reviews"], business, "business_id", "review_date"
        ),
        ("gold/fact_tips", "no_orphans"): check_no_orphans(
            tables["gold/fact_tips"], business, "business_id", "tip_date"
        ),
        ("gold/fact_checkins", "count_preserved"): check_count_preserved(
            tables["gold/fact_checkins"], "business_id", "total_checkins_for_business", rejected_checkins
        ),
    }
    out = None
    for (table, test), violations in found.items():
        line = violations.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(table).alias("table_name"), F.lit(test).alias("test"), F.lit("").alias("column_name"), "violations"
        )
        line = line.filter(F.col("violations") > 0)
        out = line if out is None else out.unionByName(line)
    return out

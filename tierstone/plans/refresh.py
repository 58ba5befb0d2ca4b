"""Incremental refresh of gold: which periods a change reaches, and only those recomputed.

A monthly row looks back: at the month before (lag), at the two before (rolling) or at all before (running sums), and sideways
at the others of its city and month (rank). So a change reaches forward by the longest look-back of the
columns, and sideways within its months. Partitions no reached row lies in are not touched.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.windows import with_rank
from ..sources.tables import read_table, rewrite_partitions, write_table
from . import aggregates
from .silver import Stamp, stamp

MONTH = ("business_id", "review_year", "review_month")
#: Periods a column of the monthly trends looks back; None: all of them.
LOOK_BACK: Mapping[str, int | None] = {
    "prior_month_reviews": 1, "prior_month_avg_stars": 1, "review_count_mom_pct": 1, "stars_mom_delta": 1, "rating_trend": 1,
    "rolling_3m_avg_stars": 2, "rolling_3m_tip_count": 2, "cumulative_reviews": None,
}


def longest(look_back: Mapping[str, int | None]) -> int | None:
    return None if None in look_back.values() else max(look_back.values(), default=0)


def stale_periods(present: DataFrame, changed: DataFrame, key: str, period: Sequence[str], reach: int | None) -> DataFrame:
    """(key, period) of ``present`` that a change in ``changed`` reaches: its own period, and the ``reach`` present
    periods after it, or all after it.

    A changed period need not be present any more: what followed it is reached all the same. Distances are counted
    in present periods, as lag and rolling frames do.
    """
    names = [key, *period]
    here = present.select(*names).distinct().withColumn("_here", F.lit(1))
    moved = changed.select(*names).distinct().withColumn("_moved", F.lit(True))
    every = here.join(moved, names, "full_outer").select(*names, F.coalesce("_here", F.lit(0)).alias("_here"), F.coalesce("_moved", F.lit(False)).alias("_moved"))
    upto = Window.partitionBy(key).orderBy(*period).rowsBetween(Window.unboundedPreceding, 0)
    numbered = every.withColumn("_n", F.sum("_here").over(upto))
    since = F.col("_n") - F.max(F.when(F.col("_moved"), F.col("_n"))).over(upto)
    reached = numbered.withColumn("_since", since).filter((F.col("_here") == 1) & F.col("_since").isNotNull())
    return (reached if reach is None else reached.filter(F.col("_since") <= reach)).select(*names)


def changed_months(fact: DataFrame, updates: DataFrame, key: str = "review_id") -> DataFrame:
    """(business, year, month) whose reviews change when ``updates`` replace rows of ``fact``: where rows go, and where they were."""
    before = fact.select(key, *MONTH).join(updates.select(key), key, "left_semi").select(*MONTH)
    return before.unionByName(updates.select(*MONTH)).distinct()


def refresh_business_monthly(
    base: str,
    fact_reviews: DataFrame,
    fact_tips: DataFrame,
    changed: DataFrame,
    rank_keys: Sequence[str] = ("city",),
    load_ts: Stamp | None = None,
) -> list[int]:
    """M7 after a change: ``gold/reviews_monthly`` and ``gold/agg_business_monthly`` brought up to date; the years rewritten.

    The facts are the new ones, ``changed`` has the (business, year, month) whose reviews or tips differ from
    those the tables were built from. Months are recomputed for the changed keys, trends for their businesses, ranks in the years
    that are rewritten; rows of other businesses keep their trends. The result is that of a full rebuild, but for the load time
    of rows that stayed. Years without a reached row keep their files. The driver gets the list of years.
    """
    spark = changed.sparkSession
    changed = write_table(changed.select(*MONTH).distinct(), base, "staging/changed_months")
    years_changed = _years(changed)
    if not years_changed:
        return []
    old = read_table(spark, base, "gold/reviews_monthly")
    was_there = _of(old.filter(F.col("review_year").isin(years_changed)), changed, MONTH, "left_anti")
    again = aggregates.reviews_monthly(_of(fact_reviews.filter(F.col("review_year").isin(years_changed)), changed, MONTH))
    monthly = rewrite_partitions(was_there.unionByName(again.select(*was_there.columns)), base, "gold/reviews_monthly", "review_year", years_changed)

    businesses = changed.select("business_id").distinct()
    own = write_table(_of(monthly, businesses, ("business_id",)), base, "staging/changed_business_months")
    reached = stale_periods(own, changed, "business_id", MONTH[1:], longest(LOOK_BACK))
    # a month that is gone may have left others of its city and month with another rank
    years = sorted(set(_years(reached)) | set(years_changed))
    inside = F.col("review_year").isin(years)
    tips = aggregates.tips_monthly(_of(fact_tips, businesses, ("business_id",)))
    trends = aggregates.business_trends(own, tips).filter(inside)
    stored = read_table(spark, base, "gold/agg_business_monthly")
    trends = stamp(trends, "aggregated_at", load_ts)
    others = _of(stored.filter(inside), businesses, ("business_id",), "left_anti").drop("city_monthly_rank")
    rows = others.unionByName(trends, allowMissingColumns=True)
    ranked = with_rank(rows, [*rank_keys, "review_year", "review_month"], "review_count", "city_monthly_rank", counted=monthly.filter(inside))
    rewrite_partitions(ranked.select(*stored.columns), base, "gold/agg_business_monthly", "review_year", years)
    return years


def _of(df: DataFrame, keys: DataFrame, on: Sequence[str], how: str = "left_semi") -> DataFrame:
    return df.join(keys.select(*on), list(on), how)


def _years(df: DataFrame) -> list[int]:
    return sorted(r.review_year for r in df.select("review_year").distinct().collect() if r.review_year is not None)  # one row a year

"""Registered queries: every operator of the library over the whole test tables.

Each takes ``(spark, sf_dir)``. Dates and instants are returned as text: the
open end of a validity interval lies outside the range of nanosecond clocks.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import avg_round, count_when, safe_pct
from ..functions.features import sentiment, text_features, vote_features
from ..functions.hashing import change_hash, surrogate_key
from ..operators.asof import as_of_join
from ..operators.joins import current_keys, fk_flag, orphans, point_in_time_join
from ..operators.distinct import distinct_counts, distinct_partials, number_keys
from ..operators.nested import explode_delimited, explode_events, flatten_attributes, flatten_hours
from ..operators.nested import explode_wide_events as explode_wide_events_of
from ..operators.quality import REASON, split_rejects, tag_rejects
from ..operators.scd import current_only, dedup_latest, first_versions, refuse_late_load, scd2_changes, scd2_merge, splice_late, upsert
from ..operators.spine import date_spine_of
from ..operators.windows import cumulative, delta, pct_change, periods, prior, rank_in, rolling, with_rank
from ..plans import aggregates, checks, dimensions, facts, silver, staging
from ..plans.monitoring import SourceFrames, ingestion_metrics, quarantine_alerts
from ..plans.pipeline import Catalog, define_gold, flag_by_stored_keys
from ..plans.refresh import changed_months, refresh_business_monthly
from ..sources.bronze import EXTRA, drift_report, read_bronze
from ..sources.bucketed import write_bucketed
from ..sources.tables import Tally, append_log, append_quarantine, compact, read_quarantine, read_log, read_table, table_exists, upsert_partitions, write_table, write_versions
from .frames import PAGE_LANGUAGES, Frames, cents

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(build: Callable[[Frames], DataFrame]) -> Callable[[Frames], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: as_text(build(Frames(spark, sf_dir)))
    return build


# Whole numbers that can be NULL; returned as double, the one notation both engines' clients share for them.
NULLABLE_COUNTS = frozenset(
    (
        "price_range", "price_range_then", "sat_open", "sat_close", "sun_open", "sun_close", "category_count",
        "user_total_reviews_at_review_time", "user_engagement_at_review_time", "prior_month_reviews",
        "prior_year_reviews", "prior_lines", "orders_then", "cents_then", "mom_delta", "cohort_size_year_0", "bronze_row_count",
    )
)


def as_text(df: DataFrame) -> DataFrame:
    """Dates and instants as text, in the same notation the check SQL uses."""
    formats = {"timestamp": "yyyy-MM-dd HH:mm:ss", "timestamp_ntz": "yyyy-MM-dd HH:mm:ss", "date": "yyyy-MM-dd"}
    columns = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind in formats:
            column = F.date_format(name, formats[kind]).alias(name)
        elif name in NULLABLE_COUNTS:
            column = column.cast("double").alias(name)
        columns.append(column)
    return df.select(*columns)


def unhashed(df: DataFrame) -> DataFrame:
    """Without the hash of the version: it covers doubles, whose text differs between engines."""
    return df.drop("change_hash")


# ------------------------------------------------------------ gold


@register
def flagship_business_monthly(f: Frames) -> DataFrame:
    """M7 on top of M4, M5, B1–B3, B5: from raw tables to monthly trends."""
    monthly = f.stored("gold/reviews_monthly", aggregates.reviews_monthly(f.fact_reviews()))
    return aggregates.monthly_trends(monthly, aggregates.tips_monthly(f.fact_tips()))


@register
def incremental_business_monthly(f: Frames) -> DataFrame:
    """M7 built without some reviews and with others as they were before, then refreshed for the months that change."""
    base, fact = f.scratch(), f.stored("now/fact_reviews", f.fact_reviews())
    tips = f.stored("now/fact_tips", f.fact_tips())
    late = (F.col("review_year") >= 1997) & (F.col("business_id").cast("int") % 3 == 0)
    again = (F.col("review_year") == 1995) & (F.col("business_id").cast("int") % 7 == 1) & (F.col("review_month") > 6)
    # before: late reviews are missing, and some had other stars a month earlier
    before = fact.filter(~late).withColumn("stars", F.when(again, 1).otherwise(F.col("stars")))
    before = before.withColumn("review_month", F.when(again, F.col("review_month") - 1).otherwise(F.col("review_month")))
    monthly = write_table(aggregates.reviews_monthly(before), base, "gold/reviews_monthly", ("review_year",))
    write_table(aggregates.monthly_trends(monthly, aggregates.tips_monthly(tips)), base, "gold/agg_business_monthly", ("review_year",))
    changed = changed_months(before, fact.filter(late | again))
    refresh_business_monthly(base, fact, tips, changed)
    return read_table(f.spark, base, "gold/agg_business_monthly")


@register
def category_city_yearly(f: Frames) -> DataFrame:
    """M8."""
    return aggregates.agg_city_category(f.fact_reviews(), f.categories())


@register
def customer_cohort_retention(f: Frames) -> DataFrame:
    """M9."""
    return aggregates.agg_user_cohort(f.fact_reviews(), f.dim_user())


@register
def reviews_monthly(f: Frames) -> DataFrame:
    """A5, A7, A8, A9, A12."""
    return aggregates.reviews_monthly(f.fact_reviews())


@register
def tips_monthly(f: Frames) -> DataFrame:
    """A4."""
    return aggregates.tips_monthly(f.fact_tips())


@register
def pit_join_two_dims(f: Frames) -> DataFrame:
    """M4: J3 twice, review type and reviewer segment."""
    return f.fact_reviews()


@register
def as_of_join_two_dims(f: Frames) -> DataFrame:
    """M4 by merging versions and reviews in time order instead of an equi-join with a validity test."""
    return facts.fact_reviews(staging.stg_reviews(f.reviews()), f.dim_business(), f.dim_user(), join=as_of_join)


@register
def tip_tiers_documents(f: Frames) -> DataFrame:
    """M5 over whole document texts."""
    return f.fact_tips()


@register
def event_time_features(f: Frames) -> DataFrame:
    """M6: P17 and a point-in-time join on timestamps."""
    return f.fact_checkins()


@register
def supplier_profile_tiers(f: Frames) -> DataFrame:
    """M1."""
    return unhashed(f.dim_business())


@register
def customer_tiers(f: Frames) -> DataFrame:
    """M2 on B2."""
    return unhashed(f.dim_user())


@register
def date_dimension(f: Frames) -> DataFrame:
    """Calendar over the range of order dates."""
    return date_spine_of(f.table("orders"), "o_orderdate").withColumns(dimensions.calendar_columns())


# ------------------------------------------------------------ versions


@register
def scd2_supplier_history(f: Frames) -> DataFrame:
    """Batch type-2 history of B1."""
    return unhashed(f.business_versions().drop("categories_list"))


@register
def scd2_customer_history(f: Frames) -> DataFrame:
    """Batch type-2 history of B2."""
    return unhashed(f.user_versions())


@register
def scd2_merge_snapshots(f: Frames) -> DataFrame:
    """One merge per snapshot; each reads the current versions the last one left and
    writes current and newly closed ones, so closed versions are written once."""
    clean, _ = split_rejects(silver.tag_business(f.business_snapshots(), carry=("snapshot_ts",)))
    base, target = f.scratch(), None
    staged = write_table(
        clean.withColumn("change_hash", change_hash(*silver.BUSINESS_TRACKED)),
        base, "snapshots", partition_by=("snapshot_ts",),
    )
    # one row per snapshot: the list of loads, not data
    loads = [r.snapshot_ts for r in staged.select("snapshot_ts").distinct().orderBy("snapshot_ts").collect()]
    for load_ts in loads:
        snapshot = staged.filter(F.col("snapshot_ts") == F.lit(load_ts)).drop("snapshot_ts")
        if target is None:
            changes = first_versions(snapshot, load_ts, first_from=None)
        else:
            refuse_late_load(target, load_ts)
            changes = scd2_changes(target, snapshot, "business_id", load_ts, first_from=None)
        target = write_versions(changes, base, "business")
    return unhashed(target.drop("categories_list"))


@register
def scd2_late_snapshots(f: Frames) -> DataFrame:
    """J9/J10 out of order: yearly snapshots loaded every other year first, then the years between.

    Snapshots newer than the table are merged, older ones spliced in; the history is that of the sorted loads.
    """
    clean, _ = split_rejects(silver.tag_business(f.business_snapshots(), carry=("snapshot_ts",)))
    base, target = f.scratch(), None
    staged = write_table(
        clean.withColumn("change_hash", change_hash(*silver.BUSINESS_TRACKED)).withColumnRenamed("snapshot_ts", "seen_at"),
        base, "snapshots", partition_by=("seen_at",),
    )
    # one row per snapshot: the list of loads, not data
    times = [r.seen_at for r in staged.select("seen_at").distinct().orderBy("seen_at").collect()]
    loaded: list = []
    for load_ts in times[1::2] + times[::2][::-1]:
        snapshot = staged.filter(F.col("seen_at") == F.lit(load_ts)).drop("seen_at")
        if target is None:
            changed = first_versions(snapshot, load_ts, first_from=None)
        elif load_ts > max(loaded):
            changed = scd2_merge(target, snapshot, "business_id", load_ts, first_from=None)
        else:
            seen = staged.filter(F.col("seen_at").isin(loaded))
            changed = splice_late(target, snapshot, seen, "business_id", load_ts, first_from=None)
        target = write_table(changed, base, "business")
        loaded.append(load_ts)
    return unhashed(target.drop("categories_list"))


@register
def compacted_history(f: Frames) -> DataFrame:
    """One load per snapshot, each leaving files of its own, then gathered into one."""
    clean, _ = split_rejects(silver.tag_business(f.business_snapshots(), carry=("snapshot_ts",)))
    base, target = f.scratch(), None
    staged = write_table(clean.withColumn("change_hash", change_hash(*silver.BUSINESS_TRACKED)), base, "snapshots", partition_by=("snapshot_ts",))
    # one row per snapshot: the list of loads, not data
    for load_ts in [r.snapshot_ts for r in staged.select("snapshot_ts").distinct().orderBy("snapshot_ts").collect()]:
        snapshot = staged.filter(F.col("snapshot_ts") == F.lit(load_ts)).drop("snapshot_ts")
        changes = first_versions(snapshot, load_ts, None) if target is None else scd2_changes(target, snapshot, "business_id", load_ts, None)
        target = write_versions(changes, base, "business")
    compact(f.spark, base, "business", cluster_by=("business_id",))
    return unhashed(read_table(f.spark, base, "business").drop("categories_list"))


@register
def current_versions(f: Frames) -> DataFrame:
    """S3, J2, A11."""
    return current_keys(f.business_versions(), "business_id")


@register
def upsert_orders(f: Frames) -> DataFrame:
    """Order totals replaced by the sums of their line items."""
    target = f.table("orders").select(
        "o_orderkey", "o_orderstatus", cents("o_totalprice").alias("total_cents"), F.lit("order").alias("origin")
    )
    updates = (
        f.table("lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum(cents("l_extendedprice")).alias("total_cents"), F.max("l_linestatus").alias("o_orderstatus"))
        .withColumn("origin", F.lit("lines"))
    )
    return upsert(target, updates, "o_orderkey")


@register
def upsert_partitioned_reviews(f: Frames) -> DataFrame:
    """J11 on a written table: urgent orders' reviews are resubmitted a year later."""
    base = f.scratch()
    columns = ("review_id", "stars", "review_year", "origin")
    rows = f.reviews().withColumn("origin", F.lit("first"))
    stored = write_table(rows.select(*columns, "user_id"), base, "reviews", ("review_year",), ("review_id",))
    urgent = (
        f.table("orders")
        .filter(F.col("o_orderpriority") == "1-URGENT")
        .select(F.col("o_custkey").cast("string").alias("user_id"))
        .distinct()
    )
    again = stored.join(urgent, "user_id", "left_semi").select(
        "review_id", F.lit(5).alias("stars"), (F.col("review_year") + 1).alias("review_year"),
        F.lit("again").alias("origin"), "user_id",
    )
    again = write_table(again, base, "updates")
    return upsert_partitions(again, base, "reviews", "review_id", ("review_year",), ("review_id",)).select(*columns)


@register
def dedup_latest_lineitem(f: Frames) -> DataFrame:
    """Newest shipment per order line."""
    order = [F.col("l_shipdate").desc(), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_extendedprice"),
             F.col("l_quantity"), F.col("l_discount"), F.col("l_tax"), F.col("l_returnflag"), F.col("l_linestatus")]
    return dedup_latest(f.table("lineitem"), ["l_orderkey", "l_linenumber"], order)


# ------------------------------------------------------------ joins and validation


@register
def pit_join_lineitem_supplier(f: Frames) -> DataFrame:
    """J3/P9."""
    return _rated(f, None)


@register
def pit_join_hot_keys_split(f: Frames) -> DataFrame:
    """J3 with keys above half a percent of the rows split over salts; same rows as the plain join."""
    return _rated(f, 0.005)


def _rated(f: Frames, hot_share: float | None) -> DataFrame:
    lines = f.table("lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").cast("string").alias("business_id"),
        F.to_date("l_shipdate").alias("ship_date"), cents("l_extendedprice").alias("price_cents"),
    )
    columns = {"stars": "stars_then", "price_range": "price_range_then", "categories": "categories_then"}
    return point_in_time_join(lines, f.business(), "business_id", "ship_date", columns, hot_share=hot_share)


@register
def as_of_join_many_versions(f: Frames) -> DataFrame:
    """J3 for keys with thousands of versions: every line with the day's totals of its order priority.

    Five priorities, a version for every day with orders; a third of the lines or more may share a key.
    """
    totals = f.table("orders").groupBy("o_orderpriority", F.col("o_orderdate").cast("timestamp").alias("valid_from")).agg(
        F.count(F.lit(1)).alias("orders_then"), F.sum(cents("o_totalprice")).alias("cents_then")
    )
    following = F.lead("valid_from").over(periods(["o_orderpriority"], ["valid_from"]))
    versions = totals.withColumn("valid_to", F.coalesce(following, F.lit("9999-12-31 00:00:00").cast("timestamp")))
    lines = f.table("lineitem").join(f.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    lines = lines.select("l_orderkey", "l_linenumber", "o_orderpriority", F.col("l_shipdate").cast("date").alias("ship_date"))
    columns = ("orders_then", "cents_then")
    return as_of_join(lines, versions, "o_orderpriority", "ship_date", columns, hot_share=0.1)


@register
def pit_join_by_buckets(f: Frames) -> DataFrame:
    """J1, J3 on tables kept by business: lines are dealt out once, then flagged, joined and summed without a shuffle."""
    base, buckets = f.scratch(), 8
    lines = f.table("lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").cast("string").alias("business_id"),
        F.to_date("l_shipdate").alias("ship_date"), cents("l_extendedprice").alias("price_cents"),
    )
    kept = write_bucketed(lines, base, "lines", "business_id", buckets, ("ship_date",))
    versions = write_bucketed(f.business(), base, "business", "business_id", buckets, ("valid_from",))
    keys = write_bucketed(current_keys(f.business(), "business_id"), base, "keys", "business_id", buckets)
    columns = {"stars": "stars_then", "price_range": "price_range_then", "categories": "categories_then"}
    flagged = fk_flag(kept, "business_id", keys, "known")
    return point_in_time_join(flagged, versions, "business_id", "ship_date", columns)


@register
def orphan_lineitems(f: Frames) -> DataFrame:
    """J8/Q6."""
    found = checks.check_no_orphans(f.reviews(), f.business(), "business_id", "review_date")
    return found.select("review_id", "business_id", "review_date", "failure_reason")


@register
def orphan_tips(f: Frames) -> DataFrame:
    """J8/Q6 for tips, with hot keys split over salts."""
    found = orphans(f.tips(), f.business(), "business_id", "tip_date", hot_share=0.05)
    return found.select("business_id", "user_id", "tip_date", "compliment_count")


@register
def fk_flag_reject_tagging(f: Frames) -> DataFrame:
    """Every review with its flags and reason."""
    return f.tagged_reviews().select(
        "review_id", "business_id", "user_id", "stars", "useful", "biz_valid", "usr_valid", "date",
        F.coalesce(REASON, F.lit("clean")).alias(REASON),
    )


@register
def fk_flag_hot_keys_split(f: Frames) -> DataFrame:
    """J1 with hot keys split over salts: line items per flag."""
    lines = f.table("lineitem").withColumn("business_id", F.col("l_suppkey").cast("string"))
    flagged = fk_flag(lines, "business_id", f.business_keys(), "known", hot_share=0.005)
    return flagged.groupBy("known").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(cents("l_extendedprice")).alias("cents")
    )


@register
def reject_reason_counts(f: Frames) -> DataFrame:
    """P6, A1, A3 over reviews, tips, photos, businesses and users."""
    tagged = {
        "reviews": f.tagged_reviews(),
        "tips": f.tagged_tips(),
        "photos": f.tagged_photos(),
        "business": silver.tag_business(f.business_snapshots()),
        "users": silver.tag_users(f.user_snapshots(), F.year("snapshot_ts"), carry=("snapshot_ts",)),
    }
    parts = [
        df.groupBy(F.coalesce(REASON, F.lit("clean")).alias(REASON))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(source).alias("source_name"), "*")
        for source, df in tagged.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@register
def silver_review_features(f: Frames) -> DataFrame:
    """P13, P14, P12, W1."""
    return f.reviews()


@register
def silver_tip_features(f: Frames) -> DataFrame:
    """B5 over whole document texts."""
    return f.tips()


# ------------------------------------------------------------ nested data


@register
def explode_part_categories(f: Frames) -> DataFrame:
    """G1, P5."""
    listed = F.concat_ws(", ", "p_type", "p_brand", F.replace("p_name", F.lit(" "), F.lit(", ")))
    parts = f.table("part").select("p_partkey", listed.alias("categories"))
    return explode_delimited(parts, ["p_partkey"], "categories", "category")


@register
def business_category_bridge(f: Frames) -> DataFrame:
    """G1 on clean businesses only."""
    return f.categories()


@register
def explode_event_times(f: Frames) -> DataFrame:
    """Every packed stamp with its position and the packed total."""
    return explode_events(f.bronze_checkins(), ["business_id", "day"], "date", "stamp", "total", "ordinal")


@register
def explode_wide_events(f: Frames) -> DataFrame:
    """G2 for long strings: all stamps of a user in one line, cut into chunks that several tasks explode."""
    packed = f.table("events").groupBy("user_id").agg(F.sort_array(F.collect_list(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))).alias("stamps"))
    lines = packed.select(F.col("user_id").cast("string").alias("user_id"), F.array_join("stamps", ", ").alias("packed"))
    return explode_wide_events_of(lines, ["user_id"], "packed", "stamp", "total", "ordinal", chunk_chars=500)


@register
def unparseable_split(f: Frames) -> DataFrame:
    """The rejected stamps."""
    return f.checkins()[1].drop("checkin_at")


@register
def explode_count_guard(f: Frames) -> DataFrame:
    """Q7, A2."""
    packed = f.bronze_checkins()
    sizes = packed.select(F.size(silver.split_items("date")).alias("size"))
    return checks.explode_counts(sizes, "size", f.exploded_checkins())


@register
def checkin_count_preserved(f: Frames) -> DataFrame:
    """Q5/A10: good rows alone do not add up to the packed total where stamps were rejected."""
    good, _ = f.checkins()
    return checks.check_count_preserved(good, ("business_id", "day"), "total_checkins_for_business")


@register
def elite_years_bridge(f: Frames) -> DataFrame:
    """(customer, elite year) pairs over all snapshots."""
    clean, _ = split_rejects(silver.tag_users(f.user_snapshots(), F.year("snapshot_ts"), carry=("snapshot_ts",)))
    return silver.user_elite_years(clean).distinct()


@register
def hours_flatten(f: Frames) -> DataFrame:
    """P2."""
    return flatten_hours(f.business_snapshots().select("business_id", "snapshot_ts", "hours"))


@register
def attributes_flatten(f: Frames) -> DataFrame:
    """P3."""
    rows = f.business_snapshots().select("business_id", "snapshot_ts", "attributes")
    return flatten_attributes(rows)


# ------------------------------------------------------------ features


@register
def text_features_documents(f: Frames) -> DataFrame:
    """P13 over whole documents."""
    return f.table("documents").select("doc_id", *[c.alias(n) for n, c in text_features("text").items()])


@register
def vote_and_sentiment_features(f: Frames) -> DataFrame:
    """Votes and sentiment of raw reviews, summed per label."""
    rows = f.bronze_reviews().select(
        sentiment(F.col("stars").try_cast("int")).alias("sentiment_proxy"),
        *[c.alias(n) for n, c in vote_features("useful", "funny", "cool").items()],
    )
    return rows.groupBy("sentiment_proxy").agg(
        *[F.sum(c).alias(c) for c in ("useful", "funny", "cool", "total_votes")],
        F.max("total_votes").alias("most_votes"),
    )


@register
def page_label_captions(f: Frames) -> DataFrame:
    """Captions and labels of all pages, before the key check."""
    return silver.finish_photos(silver.clean_labels(f.bronze_photos(), PAGE_LANGUAGES))


@register
def label_distribution(f: Frames) -> DataFrame:
    """B6, A3, O2."""
    return silver.label_distribution(f.photos())


@register
def surrogate_and_change_hash(f: Frames) -> DataFrame:
    """H1, H2, H3, with NULLs among the hashed values."""
    orders = f.table("orders")
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderstatus"))
    return orders.select(
        "o_orderkey",
        surrogate_key("o_custkey", F.to_date("o_orderdate")).alias("order_key"),
        change_hash("o_orderstatus", urgent, cents("o_totalprice")).alias("change_hash"),
        change_hash("o_orderstatus", urgent, cents("o_totalprice"), null_token=None).alias("plain_hash"),
    )


# ------------------------------------------------------------ aggregates and windows


@register
def nation_month_revenue_windows(f: Frames) -> DataFrame:
    """Monthly line items per supplier nation."""
    lines = (
        f.table("lineitem")
        .groupBy("l_suppkey", F.trunc("l_shipdate", "month").alias("month"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
            count_when(F.col("l_returnflag") == "R").alias("returned"),
        )
    )
    monthly = (
        lines.join(f.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey", "month")
        .agg(
            F.sum("n").alias("lines"),
            F.sum("quantity").alias("quantity"),
            F.sum("returned").alias("returned"),
            avg_round("n", 2).alias("avg_lines_per_supplier"),
        )
    )
    by_month = periods(["s_nationkey"], ["month"])
    return monthly.withColumns(
        {
            "returned_pct": safe_pct("returned", "lines"),
            "prior_lines": prior("lines", by_month),
            "rolling_3m_lines": rolling(F.sum, "lines", by_month, 3),
            "rolling_3m_avg": F.round(rolling(F.avg, "lines", by_month, 3), 2),
            "cumulative_lines": cumulative(F.sum, "lines", by_month),
            "nation_rank": rank_in(["month"], "lines"),
        }
    ).withColumns(
        {"mom_pct": pct_change("lines", "prior_lines"), "mom_delta": delta("lines", "prior_lines", 0)}
    )


@register
def rank_by_value_counts(f: Frames) -> DataFrame:
    """W7 for groups of any size: line items ranked by quantity within their month."""
    lines = f.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", F.date_format("l_shipdate", "yyyy-MM").alias("month")
    )
    return with_rank(lines, ["month"], "l_quantity", "quantity_rank")


# ------------------------------------------------------------ monitoring

REVIEW_COLUMNS = (
    "review_id", "business_id", "user_id", "date", "stars", "useful", "funny", "cool", "text_char_len",
    "text_word_count",
)
TIP_COLUMNS = ("business_id", "user_id", "date", "compliment_count", "text_char_len", "text_word_count")


def _sources(f: Frames) -> dict[str, SourceFrames]:
    """What a load leaves behind: tagged rows and silver rows stored once each, and counted as they are written."""

    def written(name: str, df: DataFrame, **counts: Column) -> tuple[DataFrame, Tally]:
        tally = Tally(**counts)
        return write_table(df, f.scratch(), f"run/{name}", tally=tally), tally

    rows, bad = F.count(F.lit(1)), F.count_if(F.col(REASON).isNotNull())

    def side(name: str, tagged: DataFrame, columns: tuple[str, ...], finish: Callable[[DataFrame], DataFrame] | None) -> SourceFrames:
        stored, seen = written(name, tagged.select(*columns, REASON), rows=rows, bad=bad)
        if finish is None:
            return SourceFrames(seen["rows"], seen["rows"] - seen["bad"], seen["bad"])
        _, kept = written(f"{name}_silver", finish(split_rejects(stored)[0]), rows=rows)
        return SourceFrames(seen["rows"], kept["rows"], seen["bad"])

    def versions(name: str, tagged: DataFrame, key: str, table: DataFrame) -> SourceFrames:
        _, seen = written(name, tagged.select(key, REASON), rows=rows, bad=bad)
        return SourceFrames(seen["rows"], f.current[name]["rows"], seen["bad"])

    users = silver.tag_users(f.user_snapshots(), F.year("snapshot_ts"), carry=("snapshot_ts",))
    good, rejected = f.checkins()
    exploded = Tally(rows=rows, bad=F.count_if(F.col("checkin_at").isNull()))
    write_table(good.select("checkin_at").unionByName(rejected.select("checkin_at")), f.scratch(), "run/checkins", tally=exploded)
    return {
        "business": versions("business", silver.tag_business(f.business_snapshots()), "business_id", f.business()),
        "users": versions("users", users, "user_id", f.users()),
        "reviews": side("reviews", f.tagged_reviews(), REVIEW_COLUMNS, silver.finish_reviews),
        "tips": side("tips", f.tagged_tips(), TIP_COLUMNS, silver.finish_tips),
        "photos": side("photos", f.tagged_photos(), ("photo_id",), None),
        "checkins": SourceFrames(exploded["rows"], exploded["rows"] - exploded["bad"], exploded["bad"]),
        # not sources of the load: they stand for one without rejects and one without bronze, and are counted by scans
        "labels": SourceFrames(f.table("labels"), f.table("labels"), None),
        "regions": SourceFrames(None, f.table("region"), None),
    }


@register
def ingestion_run_metrics(f: Frames) -> DataFrame:
    """B7, Q8, A1, S9, S14, U1, with a source without rejects and one without bronze."""
    return ingestion_metrics(f.spark, _sources(f), "run-1")


@register
def quarantine_alert_sources(f: Frames) -> DataFrame:
    """Q9."""
    return quarantine_alerts(ingestion_metrics(f.spark, _sources(f), "run-1"))


# ------------------------------------------------------------ checks


@register
def quality_not_null(f: Frames) -> DataFrame:
    """Q1: facts without a business key."""
    return checks.check_not_null(f.fact_reviews(), "business_key").select("review_id", "business_id", "review_date")


@register
def quality_unique_violations(f: Frames) -> DataFrame:
    """Q2."""
    return checks.check_unique(f.table("lineitem"), "l_orderkey", "l_linenumber")


@register
def quality_accepted_values(f: Frames) -> DataFrame:
    """Q3."""
    return checks.check_accepted(f.table("orders"), "o_orderstatus", ("F", "O"))


@register
def quality_column_tests(f: Frames) -> DataFrame:
    """Q1, Q2, Q3 as declared, over every declared table: one row per failed test.

    Each table is stored once and read once by the tests. Reviews with one star stand in silver/reviews a second time,
    with nine stars, so that a unique and an accepted-values test fail.
    """
    f = Frames(f.spark, f.sf_dir, keep=True)
    reviews, fact, tips = f.reviews(), f.fact_reviews(), f.fact_tips()
    per_month = f.stored("gold/reviews_monthly", aggregates.reviews_monthly(fact))
    clean, _ = split_rejects(silver.tag_users(f.user_snapshots(), F.year("snapshot_ts"), carry=("snapshot_ts",)))
    calendar = date_spine_of(f.table("orders"), "o_orderdate").withColumns(dimensions.calendar_columns())
    tables = {
        "silver/business": f.business(),
        "silver/users": f.users(),
        "silver/reviews": reviews.unionByName(reviews.filter("stars = 1").withColumn("stars", F.lit(9))),
        "silver/checkins": f.checkins()[0],
        "silver/tips": f.tips(),
        "silver/business_categories": f.categories(),
        "silver/user_elite_years": silver.user_elite_years(clean).distinct(),
        "gold/dim_business": f.dim_business(),
        "gold/dim_user": f.dim_user(),
        "gold/dim_date": f.stored("gold/dim_date", calendar),
        "gold/fact_reviews": fact,
        "gold/fact_checkins": f.fact_checkins(),
        "gold/fact_tips": tips,
        "gold/agg_business_monthly": aggregates.monthly_trends(per_month, aggregates.tips_monthly(tips)),
        "gold/agg_city_category": aggregates.agg_city_category(fact, f.categories()),
        "gold/agg_user_cohort": aggregates.agg_user_cohort(fact, f.dim_user()),
    }
    return checks.run_column_tests(tables)


def _doubled(f: Frames) -> DataFrame:
    """Versions plus a copy of every current one that begins 30 days early and ends where it begins."""
    rows = f.business().select("business_id", "valid_from", "valid_to", "is_current")
    early = current_only(rows).select(
        "business_id",
        (F.col("valid_from") - F.expr("interval 30 days")).alias("valid_from"),
        (F.col("valid_from") - F.expr("interval 30 days")).alias("valid_to"),
        "is_current",
    )
    return rows.unionByName(early)


@register
def quality_single_current(f: Frames) -> DataFrame:
    """Q4 on versions with seeded duplicates."""
    return checks.check_single_current(_doubled(f), "business_id")


@register
def quality_valid_window(f: Frames) -> DataFrame:
    """Q10 on versions with seeded empty intervals."""
    return checks.check_valid_window(_doubled(f))


@register
def quality_no_overlap(f: Frames) -> DataFrame:
    """Q11 on versions with seeded overlaps: one long version of each business spans all others."""
    rows = f.business().select("business_id", "valid_from", "valid_to", "is_current")
    spanning = current_only(rows).withColumn("valid_from", F.lit("1900-01-01 00:00:00").cast("timestamp"))
    return checks.check_no_overlap(rows.unionByName(spanning.withColumn("is_current", F.lit(False))), "business_id")


# ------------------------------------------------------------ sources and sinks

# JSON lines name every field in every row; Spark reads them back by the files' suffix.
JSON_CODEC = "gzip"


@register
def bronze_json_roundtrip(f: Frames) -> DataFrame:
    """Reviews written as JSON lines, read by schema, staged without the text, flagged by
    stored missing keys; rejects kept per run, with the text."""
    base = f.scratch()
    f.bronze_reviews().write.json(f"{base}/review.json", compression=JSON_CODEC)
    raw = read_bronze(f.spark, base, "review")
    rows = write_table(silver.metrics_only(raw), base, "staging/reviews")
    lookups = {"business_id": ("biz_valid", f.business()), "user_id": ("usr_valid", f.users())}
    staged = tag_rejects(flag_by_stored_keys(base, "reviews", rows, lookups), silver.review_rules())
    clean, rejected = split_rejects(staged)
    rejected = silver.with_text(raw, write_table(rejected, base, "staging/rejects"))
    rejected = write_table(rejected, base, "staging/rejected_lines")  # read by both runs; the texts are fetched once
    append_quarantine(rejected, base, "reviews", "run-1")
    append_quarantine(rejected, base, "reviews", "run-1")  # a rerun replaces its own rows
    kept = clean.agg(
        F.count(F.lit(1)).alias("rows"), F.sum("useful").alias("useful"), F.sum("text_char_len").alias("chars")
    )
    bad = read_quarantine(f.spark, base, "reviews").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("useful").alias("useful"), F.sum(F.length("text")).alias("chars")
    )
    return kept.select(F.lit("clean").alias("side"), "*").unionByName(bad.select(F.lit("rejected").alias("side"), "*"))


@register
def partitioned_clustered_roundtrip(f: Frames) -> DataFrame:
    """Line items by ship year, clustered, read back in two partition ranges."""
    rows = f.table("lineitem").withColumn("ship_year", F.year("l_shipdate"))
    write_table(rows, f.scratch(), "lines", ("ship_year",), ("l_suppkey", "l_shipdate"))
    stored = read_table(f.spark, f.scratch(), "lines")

    def summed(part: DataFrame) -> DataFrame:
        return part.groupBy("ship_year", "l_suppkey").agg(
            F.count(F.lit(1)).alias("lines"), F.sum(cents("l_extendedprice")).alias("cents")
        )

    return summed(stored.filter("ship_year < 1998")).unionByName(summed(stored.filter("ship_year >= 1998")))


@register
def clustered_by_second_column(f: Frames) -> DataFrame:
    """Lines laid out along a curve over supplier and ship date, read by the second of the two."""
    stored = write_table(f.table("lineitem"), f.scratch(), "lines", cluster_by=("l_suppkey", "l_shipdate"), curve=True, files=16)
    quarter = stored.filter((F.col("l_shipdate") >= "1995-04-01") & (F.col("l_shipdate") < "1995-07-01"))
    return quarter.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(cents("l_extendedprice")).alias("cents"), F.min("l_shipdate").alias("first_day")
    )


@register
def staging_views(f: Frames) -> DataFrame:
    """Staging projections registered as views and queried by name."""
    views = {
        "stg_business": staging.stg_business(f.business()),
        "stg_users": staging.stg_users(f.users()),
        "stg_reviews": staging.stg_reviews(f.stored("silver/reviews", f.reviews())),
        "stg_tips": staging.stg_tips(f.stored("silver/tips", f.tips())),
        "stg_checkins": staging.stg_checkins(f.checkins()[0].drop("day")),
    }
    rows = {
        "stg_business": ("business_id", "valid_from", "review_count"),
        "stg_users": ("user_id", "valid_from", "engagement_score"),
        "stg_reviews": ("review_id", "review_date", "total_votes"),
        "stg_tips": ("user_id", "tip_date", "text_char_len"),
        "stg_checkins": ("business_id", "checkin_at", "checkin_ordinal"),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    parts = [
        f.spark.sql(
            f"SELECT '{name}' AS view_name, {key} AS row_key, date_format({at}, 'yyyy-MM-dd HH:mm:ss') AS row_time, "
            f"cast({measure} AS double) AS measure FROM {name}"
        )
        for name, (key, at, measure) in rows.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _as_json(f: Frames, entity: str, rows: DataFrame) -> DataFrame:
    """Rows written as JSON lines and read back by the declared schema."""
    base = f.scratch()
    rows.write.json(f"{base}/{entity}.json", compression=JSON_CODEC)
    return read_bronze(f.spark, base, entity)


@register
def json_business(f: Frames) -> DataFrame:
    """S1 with nested structs, P1–P3: every business row, hours and attributes flattened."""
    raw = _as_json(f, "business", f.business_snapshots().drop("snapshot_ts"))
    return silver.shape_business(raw).drop("categories_list")


@register
def json_users(f: Frames) -> DataFrame:
    """S1 with arrays: every user row."""
    raw = _as_json(f, "user", f.user_snapshots().drop("snapshot_ts"))
    shaped = silver.shape_users(raw, 2000)
    return shaped.drop("elite", "is_currently_elite", "user_tier", "years_on_platform")


@register
def json_checkins(f: Frames) -> DataFrame:
    """Every packed stamp, a user's days as one source row each."""
    raw = _as_json(f, "checkin", f.bronze_checkins().drop("day"))
    return explode_events(raw, ["business_id"], "date", "stamp", "total", "ordinal")


@register
def json_tips(f: Frames) -> DataFrame:
    """Every tip over whole document texts, measured after the round trip."""
    measured = silver.measure_text(_as_json(f, "tip", f.bronze_tips())).drop("text")
    return measured.withColumn("compliment_count", F.col("compliment_count").cast("double"))


@register
def json_photos(f: Frames) -> DataFrame:
    """Every photo row."""
    return _as_json(f, "photo", f.bronze_photos())


def _drifting_reviews(f: Frames) -> DataFrame:
    """Reviews with fields that are not declared: one of them an object, one of two types."""
    rows = f.bronze_reviews()
    number = F.split("review_id", "-")[1].cast("int")
    extras = F.struct(
        F.when(F.col("useful") >= 8, F.col("useful") * 10).alias("boosts"),
        F.when(number == 1, F.struct(F.col("funny").alias("level"), F.lit("web").alias("via"))).alias("device"),
        F.when(number == 2, F.lit("two")).alias("grade"),
    )
    line = F.to_json(F.struct(*rows.columns, "boosts", "device", "grade"))
    mixed = F.when(number == 3, F.replace(line, F.lit('"review_id"'), F.lit('"grade":3,"review_id"'))).otherwise(line)
    return rows.withColumn("x", extras).select(*rows.columns, "x.*").select(mixed.alias("value"))


@register
def json_schema_drift(f: Frames) -> DataFrame:
    """Fields outside the declared schema, by name, rows and type, from JSON lines."""
    base = f.scratch()
    _drifting_reviews(f).write.text(f"{base}/review.json", compression=JSON_CODEC)
    return drift_report(read_bronze(f.spark, base, "review", keep_extra=True), "review")


@register
def json_extra_fields(f: Frames) -> DataFrame:
    """Every line with undeclared fields, and the fields themselves."""
    base = f.scratch()
    _drifting_reviews(f).write.text(f"{base}/review.json", compression=JSON_CODEC)
    found = read_bronze(f.spark, base, "review", keep_extra=True).filter(F.col(EXTRA).isNotNull())
    value = lambda path, kind: F.try_variant_get(F.col(EXTRA), path, kind)
    return found.select(
        "review_id", "stars", value("$.boosts", "double").alias("boosts"), value("$.device.level", "double").alias("device_level"),
        value("$.device.via", "string").alias("device_via"), value("$.grade", "string").alias("grade"),
    )


@register
def yearly_distinct_from_monthly(f: Frames) -> DataFrame:
    """Distinct customers per nation and year from stored monthly bitmaps, and over all years, facts read once."""
    lines = f.table("lineitem").join(f.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    lines = lines.join(f.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    rows = write_table(
        lines.select("s_nationkey", F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"), "o_custkey"), f.scratch(), "rows"
    )
    early = rows.filter("year < 1995")
    ids = write_table(number_keys(early, "o_custkey"), f.scratch(), "ids")
    # customers of later loads get ids above those of earlier ones
    ids = ids.unionByName(write_table(number_keys(rows, "o_custkey", ids), f.scratch(), "later_ids"))
    monthly = write_table(
        distinct_partials(rows.join(ids, "o_custkey"), ["s_nationkey", "year", "month"]), f.scratch(), "monthly", ("year",)
    )
    yearly = distinct_counts(monthly, ["s_nationkey", "year"], "customers")
    ever = distinct_counts(monthly, ["s_nationkey"], "customers").withColumn("year", F.lit(0))
    return yearly.unionByName(ever)


@register
def model_graph(f: Frames) -> DataFrame:
    """Gold models built in the order their inputs ask for, with inputs, level and the rows each came out with."""
    catalog = Catalog(f.spark, f.scratch())
    define_gold(catalog)
    for name, df in (
        ("silver/business", f.business()), ("silver/users", f.users()), ("silver/reviews", f.reviews()), ("silver/tips", f.tips()),
        ("silver/checkins", f.checkins()[0].drop("day")), ("silver/business_categories", f.categories()),
    ):
        catalog.save(name, df)
    levels, inputs = catalog.levels(), catalog.inputs()
    for name in catalog.order():
        catalog.build(name)
    edges = [(name, needed, levels[name], catalog.counts[name]["silver"]["count"]) for name in inputs for needed in inputs[name] or [None]]
    return f.spark.createDataFrame(edges, "model string, input string, level int, model_rows long")


@register
def log_grows_a_column(f: Frames) -> DataFrame:
    """Three runs appended to a log, the last with a further column, one run repeated."""
    base = f.scratch()
    counts = f.table("orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("row_count"))
    append_log(counts.withColumn("run_id", F.lit("run-1")), base, "run-1")
    append_log(counts.withColumn("run_id", F.lit("run-2")), base, "run-2")
    append_log(counts.withColumn("run_id", F.lit("run-2")), base, "run-2")
    totals = f.table("orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(cents("o_totalprice")).cast("double").alias("total_cents")
    )
    append_log(totals.withColumn("run_id", F.lit("run-3")), base, "run-3")
    return read_log(f.spark, base).select("run_id", "o_orderstatus", "row_count", "total_cents")


@register
def load_modes(f: Frames) -> DataFrame:
    """A table that exists is merged into, one that does not is built, and a full load drops history.

    All snapshots, cut at the middle of their years; a load sees the latest of each business on its side.
    The result holds the versions seen after each of three loads.
    """
    base, seen = f.scratch(), []
    clean, _ = split_rejects(silver.tag_business(f.business_snapshots(), carry=("snapshot_ts",)))
    year = F.year("snapshot_ts")
    stored = write_table(clean.withColumn("year", year), base, "snapshots", ("year",))
    span = stored.agg(F.min("year").alias("first"), F.max("year").alias("last")).first()  # two numbers
    late = F.col("year") * 2 > span.first + span.last
    for number, (mode, side) in enumerate((("merge", ~late), ("merge", late), ("full", late)), 1):
        rows = stored.filter(side)
        load_ts = f"{rows.agg(F.max('year')).first()[0]}-12-31 00:00:00"  # one number
        rows = dedup_latest(rows, ["business_id"], [F.desc("snapshot_ts")]).drop("snapshot_ts", "year")
        known = read_table(f.spark, base, "business") if mode == "merge" and table_exists(f.spark, base, "business") else None
        changes = silver.finish_business(rows, known, load_ts, first_from=None)
        versions = write_versions(changes, base, "business", keep_history=mode == "merge")
        seen.append(
            versions.select(F.lit(number).alias("load_number"), "business_id", "stars", "review_count", "valid_from", "valid_to", "is_current")
        )
    return reduce(DataFrame.unionByName, seen)


@register
def catalog_names(f: Frames) -> DataFrame:
    """A gold model asked for by name; its inputs are found by theirs, written or computed."""
    catalog = Catalog(f.spark, f.scratch())
    define_gold(catalog)
    # the stored versions: reviews and tips look their keys up in them, so the histories are computed once
    catalog.save("silver/business", f.business())
    catalog.save("silver/users", f.users())
    catalog.save("silver/reviews", f.reviews())
    catalog.save("silver/tips", f.tips())
    for name in ("gold/fact_reviews", "gold/fact_tips"):
        catalog.build(name)
    return catalog.table("gold/agg_business_monthly")

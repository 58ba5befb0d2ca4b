"""Bronze-shaped frames derived from the TPC-H-like test tables.

The tables stand in for the review domain: a supplier is a business, described
by one snapshot per shipping year; a customer is a user, described by one
snapshot per ordering year; a line item is a review; an event is a check-in,
packed with the others of its user and day; a document is a tip; a web page is a photo. All
events, documents, pages, line items and orders take part; a supplier without a line
item and a customer without an order have no snapshot. Prices are turned into whole cents before they
are summed, so sums do not depend on row order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import current_keys
from ..operators.quality import split_rejects, split_unparseable, tag_rejects
from ..plans import dimensions, facts, silver, staging
from ..session import configure, shared_dir
from ..sources.bronze import COMPLIMENTS
from ..sources.tables import Tally, write_table

# --- fixed values of the derivation; the check SQL repeats them ---
BUSINESS_SNAPSHOT_MONTH = 7
USER_SNAPSHOT_MONTH = 1
ELITE_CENTS = 60_000_000
REVIEWS_PER_ORDER = 10
PAGE_LANGUAGES = ("en", "fr", "de")


# Frames a load writes as tables; instances with ``keep`` store them, so that later frames read them.
KEPT = frozenset(("reviews", "tips", "categories", "dim_business", "dim_user", "fact_reviews", "fact_tips", "fact_checkins"))


def cents(price: str) -> Column:
    return F.round(F.col(price) * 100).cast("bigint")


def day_time(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def once(build: Callable[[Frames], Any]) -> Callable[[Frames], Any]:
    """Build at most once per instance; what is built goes with the instance."""
    name = build.__name__

    @wraps(build)
    def get(self: Frames) -> Any:
        if name not in self._built:
            built = build(self)
            self._built[name] = self.stored(f"kept/{name}", built) if self.keep and name in KEPT else built
        return self._built[name]

    return get


class Frames:
    """Frames over one data folder, built lazily; with ``keep``, each of KEPT is computed once and stored."""

    def __init__(self, spark: SparkSession, sf_dir: str, keep: bool = False):
        self.spark, self.sf_dir, self.keep = configure(spark), sf_dir.rstrip("/"), keep
        self._built: dict[str, Any] = {}
        #: Current versions, counted as the versioned tables are written.
        self.current = {name: Tally(rows=F.count_if("is_current")) for name in ("business", "users")}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @once
    def scratch(self) -> str:
        """A fresh folder under the shared one, for tables a query writes."""
        return f"{shared_dir(self.spark)}/tierstone-{uuid.uuid4()}"

    # ------------------------------------------------------------ bronze

    @once
    def business_snapshots(self) -> DataFrame:
        """One row per supplier and shipping year, in the bronze business shape."""
        yearly = (
            self.table("lineitem")
            .groupBy("l_suppkey", F.year("l_shipdate").alias("year"))
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
                F.sum(cents("l_extendedprice")).alias("cents"),
                F.count_if(F.col("l_linestatus") == "O").alias("open_lines"),
                F.count_if(F.col("l_returnflag") == "R").alias("returned_lines"),
                F.count_if(F.col("l_quantity") >= 45).alias("bulk_lines"),
            )
        )
        suppliers = (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )
        balance, n = F.col("s_acctbal"), F.col("n")
        price_range = F.least(F.lit(4), F.floor(F.col("cents") / (n * 1_000_000))).cast("int")
        weekday = F.concat(
            (F.col("r_regionkey") + 5).cast("string"),
            F.lit(":0-"),
            (F.col("r_regionkey") + 17).cast("string"),
            F.lit(":30"),
        )
        hours = F.struct(
            *[weekday.alias(d) for d in ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday")],
            F.when(balance > 5000, F.lit("10:0-16:0")).alias("Saturday"),
            F.when(balance < 2000, F.lit("closed")).alias("Sunday"),
        )
        attributes = F.struct(
            F.when(balance > 1000, price_range.cast("string")).otherwise(F.lit("None")).alias("RestaurantsPriceRange2"),
            F.when(balance > 7000, F.lit("u'free'")).when(balance > 4000, F.lit("'paid'")).alias("WiFi"),
            F.when(balance > 5000, F.lit("True")).when(balance > 2500, F.lit("False")).alias("OutdoorSeating"),
            F.when(F.col("n_nationkey") > 12, F.lit("true")).alias("HasTV"),
            F.when(F.col("r_regionkey") > 1, F.lit("True")).alias("RestaurantsDelivery"),
            F.when(F.col("r_regionkey") > 2, F.lit("True")).otherwise(F.lit("None")).alias("RestaurantsTakeOut"),
            F.when(balance > 3000, F.lit("True")).alias("RestaurantsReservations"),
            F.when(balance > 6000, F.lit("False")).otherwise(F.lit("True")).alias("GoodForKids"),
            F.when(F.col("n_nationkey") > 16, F.lit("u'full_bar'"))
            .when(F.col("n_nationkey") > 8, F.lit("'beer_and_wine'"))
            .alias("Alcohol"),
            F.when(balance > 8000, F.lit("u'loud'")).when(balance > 500, F.lit("'average'")).alias("NoiseLevel"),
            F.when(F.col("r_regionkey") > 0, F.lit("u'casual'")).otherwise(F.lit("dressy")).alias("RestaurantsAttire"),
        )
        categories = F.concat_ws(
            ", ",
            F.when(F.col("returned_lines") * 3 >= n, F.lit("Returns")),
            F.when(F.col("open_lines") * 2 >= n, F.lit("Open orders")),
            F.when(F.col("bulk_lines") * 8 >= n, F.lit("Bulk")),
            F.lit("General"),
        )
        return yearly.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select(
            F.make_timestamp(
                "year", F.lit(BUSINESS_SNAPSHOT_MONTH), F.lit(1), F.lit(0), F.lit(0), F.lit(0)
            ).alias("snapshot_ts"),
            F.col("s_suppkey").cast("string").alias("business_id"),
            F.col("s_name").alias("name"),
            F.concat(F.col("n_name"), F.lit(" street")).alias("address"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.col("n_nationkey").cast("string").alias("postal_code"),
            F.when(balance >= 0, F.col("n_nationkey").cast("double")).alias("latitude"),
            F.col("r_regionkey").cast("double").alias("longitude"),
            (F.round(F.col("quantity") * 2 / (n * 10)) / 2).alias("stars"),
            (F.floor(n / 50) * 50).cast("int").alias("review_count"),
            (F.col("open_lines") * 5 >= n * 2).cast("int").alias("is_open"),
            categories.alias("categories"),
            attributes.alias("attributes"),
            hours.alias("hours"),
        )

    @once
    def user_snapshots(self) -> DataFrame:
        """One row per customer and ordering year, in the bronze user shape."""
        priorities = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
        yearly = (
            self.table("orders")
            .groupBy("o_custkey", F.year("o_orderdate").alias("year"))
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.sum(cents("o_totalprice")).alias("cents"),
                F.min("o_orderdate").alias("first_order"),
                F.collect_set("o_orderpriority").alias("friends"),
                *[
                    F.count_if(F.col("o_orderpriority") == p).cast("int").alias(f"p{i}")
                    for i, p in enumerate(priorities)
                ],
            )
        )
        so_far = Window.partitionBy("o_custkey").orderBy("year")
        always = Window.partitionBy("o_custkey")
        elite_year = F.when(F.col("cents") >= ELITE_CENTS, F.col("year").cast("string"))
        yearly = yearly.withColumns(
            {
                "orders_so_far": F.sum("n").over(so_far),
                "elite": F.collect_list(elite_year).over(so_far),
                "joined": F.min("first_order").over(always),
            }
        )
        balance = F.col("c_acctbal")
        given = dict(zip(COMPLIMENTS, [F.nullif(F.col(f"p{i}"), F.lit(0)) for i in range(5)]))
        return yearly.join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey")).select(
            F.make_timestamp(
                "year", F.lit(USER_SNAPSHOT_MONTH), F.lit(1), F.lit(0), F.lit(0), F.lit(0)
            ).alias("snapshot_ts"),
            F.col("c_custkey").cast("string").alias("user_id"),
            F.when(balance >= 0, F.concat(F.lit(" "), F.col("c_name"), F.lit(" "))).alias("name"),
            day_time("joined").alias("member_since"),
            (F.col("orders_so_far") * REVIEWS_PER_ORDER).cast("int").alias("review_count"),
            F.least(F.lit(5.0), F.greatest(F.lit(1.0), (F.floor(balance / 2000) + 1).cast("double"))).alias(
                "average_stars"
            ),
            F.greatest(F.lit(0), F.floor(balance / 100)).cast("int").alias("fans"),
            F.col("n").cast("int").alias("useful"),
            F.lit(None).cast("int").alias("funny"),
            F.col("p0").alias("cool"),
            "friends",
            "elite",
            *[given.get(c, F.lit(None)).cast("int").alias(c) for c in COMPLIMENTS],
        )

    @once
    def bronze_reviews(self) -> DataFrame:
        """One row per line item, in the bronze review shape."""
        words = F.floor(F.col("l_extendedprice") / F.col("l_quantity") / 100).cast("int")
        return (
            self.table("lineitem")
            .join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber")).alias("review_id"),
                F.col("l_suppkey").cast("string").alias("business_id"),
                F.col("o_custkey").cast("string").alias("user_id"),
                (F.col("l_quantity") / 10).alias("stars"),
                F.round(F.col("l_discount") * 100).cast("int").alias("useful"),
                F.round(F.col("l_tax") * 100).cast("int").alias("funny"),
                F.nullif(F.col("l_linenumber") - 1, F.lit(0)).alias("cool"),
                F.repeat(F.concat(F.col("l_returnflag"), F.lit("\n")), words).alias("text"),
                day_time("l_shipdate").alias("date"),
            )
        )

    @once
    def bronze_checkins(self) -> DataFrame:
        """One row per event user and day: the stamps of all its events, packed into one string.

        A row is as long as one user's day. An error event's stamp is written in a
        format that does not parse. ``day`` tells the rows of a user apart.
        """
        stamp = F.when(F.col("event_type") == "error", F.date_format("ts", "yyyy/MM/dd HH:mm")).otherwise(day_time("ts"))
        packed = (
            self.table("events")
            .groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))
            .agg(F.sort_array(F.collect_list(stamp)).alias("stamps"))
        )
        return packed.select(
            F.col("user_id").cast("string").alias("business_id"), F.array_join("stamps", ", ").alias("date"), "day"
        )

    @once
    def bronze_tips(self) -> DataFrame:
        """One row per document, attached to the order of the same number."""
        return self._tips_of(self.table("documents"), "text")

    @once
    def measured_tips(self) -> DataFrame:
        """The same with metrics in place of the text, taken on the scan."""
        measured = silver.measure_text(self.table("documents").select("doc_id", "text")).drop("text")
        return self._tips_of(measured, "text_char_len", "text_word_count")

    def _tips_of(self, documents: DataFrame, *columns: str) -> DataFrame:
        lead_supplier = self.table("lineitem").groupBy("l_orderkey").agg(F.min("l_suppkey").alias("l_suppkey"))
        return (
            documents.join(self.table("labels"), "doc_id", "left")
            .join(self.table("orders"), F.col("doc_id") == F.col("o_orderkey"), "left")
            .join(lead_supplier, F.col("doc_id") == F.col("l_orderkey"), "left")
            .select(
                F.col("l_suppkey").cast("string").alias("business_id"),
                F.col("o_custkey").cast("string").alias("user_id"),
                *columns,
                day_time("o_orderdate").alias("date"),
                (F.col("quality") * 4 + F.col("toxic") * 8).cast("int").alias("compliment_count"),
            )
        )

    @once
    def bronze_photos(self) -> DataFrame:
        """One row per web page; its title is the caption, its language segment the label."""
        language = F.regexp_extract("url", r"^https?://[^/]+/([a-z]+)/", 1)
        title = F.regexp_extract("html", r"<title>([^<]*)</title>", 1)
        return self.table("pages").select(
            F.col("page_id").cast("string").alias("photo_id"),
            F.col("page_id").cast("string").alias("business_id"),
            F.nullif(title, F.lit("")).alias("caption"),
            F.concat(F.lit(" "), F.upper(language), F.lit(" ")).alias("label"),
        )

    # ------------------------------------------------------------ silver

    @once
    def business_versions(self) -> DataFrame:
        """Supplier versions; a supplier has none before its first snapshot."""
        return silver.business_history(self.business_snapshots(), "snapshot_ts", first_from=None)

    @once
    def user_versions(self) -> DataFrame:
        return silver.user_history(self.user_snapshots(), "snapshot_ts", first_from=None)

    @once
    def business(self) -> DataFrame:
        """The versions as a written table, as the load keeps them: facts read it
        several times, and the planner knows its size."""
        return write_table(self.business_versions(), self.scratch(), "silver/business", tally=self.current["business"])

    @once
    def users(self) -> DataFrame:
        return write_table(self.user_versions(), self.scratch(), "silver/users", tally=self.current["users"])

    @once
    def business_keys(self) -> DataFrame:
        """Valid keys as a written table, so that key checks are plain joins of two scans."""
        return self.stored("silver/business_keys", current_keys(self.business(), "business_id"))

    @once
    def user_keys(self) -> DataFrame:
        return self.stored("silver/user_keys", current_keys(self.users(), "user_id"))

    @once
    def tagged_reviews(self) -> DataFrame:
        rows = silver.measure_text(self.bronze_reviews())
        return tag_rejects(silver.flag_keys(rows, self.business_keys(), self.user_keys()), silver.review_rules())

    @once
    def reviews(self) -> DataFrame:
        return silver.finish_reviews(split_rejects(self.tagged_reviews())[0])

    @once
    def tagged_tips(self) -> DataFrame:
        rows = self.measured_tips()
        return tag_rejects(silver.flag_keys(rows, self.business_keys(), self.user_keys()), silver.tip_rules())

    @once
    def tips(self) -> DataFrame:
        return silver.finish_tips(split_rejects(self.tagged_tips())[0])

    @once
    def checkins(self) -> tuple[DataFrame, DataFrame]:
        """Good and rejected check-ins, from one stored explode."""
        parsed, rejected = split_unparseable(self.exploded_checkins(), "checkin_ts_raw", "checkin_at")
        return silver.finish_checkins(parsed), rejected

    @once
    def exploded_checkins(self) -> DataFrame:
        return self.stored("staging/checkins", silver.expand_checkins(self.bronze_checkins(), carry=("day",)))

    @once
    def tagged_photos(self) -> DataFrame:
        rows = silver.clean_labels(self.bronze_photos(), PAGE_LANGUAGES)
        return tag_rejects(silver.flag_keys(rows, self.business_keys()), silver.photo_rules())

    @once
    def photos(self) -> DataFrame:
        return silver.finish_photos(split_rejects(self.tagged_photos())[0])

    @once
    def categories(self) -> DataFrame:
        """Distinct (business, category) pairs over all snapshots."""
        clean, _ = split_rejects(silver.tag_business(self.business_snapshots()))
        return silver.business_categories(clean).distinct()

    # ------------------------------------------------------------ gold

    @once
    def dim_business(self) -> DataFrame:
        return dimensions.dim_business(staging.stg_business(self.business()))

    @once
    def dim_user(self) -> DataFrame:
        return dimensions.dim_user(staging.stg_users(self.users()))

    @once
    def fact_reviews(self) -> DataFrame:
        return facts.fact_reviews(staging.stg_reviews(self.reviews()), self.dim_business(), self.dim_user())

    @once
    def fact_tips(self) -> DataFrame:
        return facts.fact_tips(staging.stg_tips(self.tips()), self.dim_business(), self.dim_user())

    @once
    def fact_checkins(self) -> DataFrame:
        return facts.fact_checkins(staging.stg_checkins(self.checkins()[0].drop("day")), self.dim_business())

    def stored(self, name: str, df: DataFrame) -> DataFrame:
        """A frame as a written table, for results that read it more than once."""
        return write_table(df, self.scratch(), name)

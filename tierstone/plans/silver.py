"""Silver jobs: bronze rows to typed, validated, deduplicated, versioned tables.

Each job has two halves. ``tag_*`` shapes every bronze row and names the first
rule it breaks; ``finish_*`` turns the clean rows into the silver table. The
``silver_*`` functions chain both lazily. The pipeline writes the tagged frame
in between, so the JSON is parsed once for the clean and the rejected side.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions.expressions import normalize_label, null_safe_sum
from ..functions.features import (
    POPULAR_TIP_COMPLIMENTS,
    batched_word_count,
    caption_features,
    engagement_score,
    high_quality,
    sentiment,
    text_features,
    time_features,
    user_tier,
    vote_features,
)
from ..functions.hashing import change_hash, row_hash
from ..operators.joins import current_keys, fk_flag
from ..operators.nested import (
    attribute_columns,
    cast_elements,
    explode_array,
    explode_delimited,
    explode_events,
    hour_columns,
    split_items,
)
from ..operators.quality import split_rejects, split_unparseable, tag_rejects
from ..operators.scd import (
    HISTORY_FLOOR,
    as_timestamp,
    dedup_latest,
    first_versions,
    scd2_from_snapshots,
    scd2_changes,
    upsert,
)
from ..sources.bronze import COMPLIMENTS, CORRUPT

Stamp = str | datetime | Column

LINE = "_line"

# --- fixed values: columns whose change opens a new version, photo vocabulary ---
BUSINESS_TRACKED = ("stars", "review_count", "is_open", "city", "state", "categories", "price_range")
USER_TRACKED = ("user_tier", "review_count", "fans", "average_stars", "is_currently_elite")
PHOTO_LABELS = ("food", "drink", "menu", "inside", "outside")


def parse_date(text: str) -> Column:
    """Date from ``yyyy-MM-dd``, with or without ``HH:mm:ss``; NULL when the text is neither."""
    with_time = F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))
    return F.coalesce(with_time, F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))).cast("date")


def corrupt_rule(bronze: DataFrame) -> list[tuple[str, Column]]:
    """Lines that were not valid JSON come first, if the reader kept them."""
    return [("corrupt_record", F.col(CORRUPT).isNotNull())] if CORRUPT in bronze.columns else []


def _carried(bronze: DataFrame, carry: tuple[str, ...]) -> tuple[str, ...]:
    return (*carry, CORRUPT) if CORRUPT in bronze.columns else carry


def _content_order(df: DataFrame) -> Column:
    return row_hash(df.columns)


# ---------------------------------------------------------------- business


def shape_business(bronze: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """P1, P2, P3 and category features of B1, in one projection. ``carry`` keeps extra columns."""
    items = split_items("categories")
    return bronze.select(
        *carry,
        "business_id",
        F.col("name").alias("business_name"),
        "address",
        "city",
        "state",
        "postal_code",
        *[F.col(c).cast("double").alias(c) for c in ("latitude", "longitude", "stars")],
        F.col("review_count").cast("int").alias("review_count"),
        F.col("is_open").cast("boolean").alias("is_open"),
        "categories",
        *hour_columns("hours"),
        *attribute_columns("attributes"),
        items.alias("categories_list"),
        F.size(items).alias("category_count"),
    )


def business_rules() -> list[tuple[str, Column]]:
    stars = F.col("stars")
    return [
        ("null_business_id", F.col("business_id").isNull()),
        ("null_name", F.col("business_name").isNull()),
        ("null_coordinates", F.col("latitude").isNull() | F.col("longitude").isNull()),
        ("invalid_stars", stars.isNull() | ~stars.between(1, 5)),
    ]


def tag_business(bronze: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    return tag_rejects(shape_business(bronze, _carried(bronze, carry)), corrupt_rule(bronze) + business_rules())


def finish_business(
    clean: DataFrame, target: DataFrame | None, load_ts: Stamp, first_from: str | None = HISTORY_FLOOR
) -> DataFrame:
    """Current and newly closed versions; ``target=None`` rebuilds from this snapshot alone.

    With a target, closed versions it already has are not among the result.
    """
    return _version(business_snapshot(clean, load_ts), target, "business_id", load_ts, first_from)


def business_snapshot(clean: DataFrame, load_ts: Stamp) -> DataFrame:
    """One row per business, with its change hash: what a load compares and a late load is spliced in by."""
    clean = clean.drop(CORRUPT)
    unique = dedup_latest(clean, ["business_id"], [F.col("review_count").desc(), _content_order(clean)])
    return _stamped(unique, BUSINESS_TRACKED, load_ts)


def business_categories(clean: DataFrame) -> DataFrame:
    """G1: one row per valid business and distinct category."""
    return explode_delimited(clean, ["business_id"], "categories", "category")


def silver_business(
    bronze: DataFrame, target: DataFrame | None, load_ts: Stamp, first_from: str | None = HISTORY_FLOOR
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """B1: ``(business, categories, rejected)``."""
    clean, rejected = split_rejects(tag_business(bronze))
    return _whole(finish_business(clean, target, load_ts, first_from), target), business_categories(clean), rejected


def business_history(snapshots: DataFrame, ts: str, first_from: str | None = HISTORY_FLOOR) -> DataFrame:
    """Versioned business table out of many dated snapshots in one pass (history load)."""
    clean, _ = split_rejects(tag_business(snapshots, carry=(ts,)))
    return scd2_from_snapshots(clean, "business_id", BUSINESS_TRACKED, ts, first_from)


def _whole(changes: DataFrame, target: DataFrame | None) -> DataFrame:
    """The full type-2 table: what was closed before, and what a load leaves."""
    if target is None:
        return changes
    return target.filter(~F.col("is_current")).unionByName(changes, allowMissingColumns=True)


def _stamped(unique: DataFrame, tracked: tuple[str, ...], load_ts: Stamp) -> DataFrame:
    return unique.withColumns({"change_hash": change_hash(*tracked), "loaded_at": as_timestamp(load_ts)})


def _version(snapshot: DataFrame, target: DataFrame | None, key: str, load_ts: Stamp, first_from: str | None) -> DataFrame:
    if target is None:
        return first_versions(snapshot, load_ts, first_from)
    return scd2_changes(target, snapshot, key, load_ts, first_from)


# ---------------------------------------------------------------- users


def shape_users(bronze: DataFrame, snapshot_year: int | Column, carry: tuple[str, ...] = ()) -> DataFrame:
    """P1, P15, G5, G6, P16, P18 and the tier of B2."""
    year = snapshot_year if isinstance(snapshot_year, Column) else F.lit(snapshot_year)
    elite_years = cast_elements("elite", "int")
    core = bronze.select(
        *carry,
        "user_id",
        F.trim("name").alias("user_name"),
        parse_date("member_since").alias("member_since"),
        F.col("review_count").cast("int").alias("review_count"),
        F.col("average_stars").cast("double").alias("average_stars"),
        F.col("fans").cast("int").alias("fans"),
        *[
            F.coalesce(F.col(vote), F.lit(0)).cast("int").alias(f"votes_{vote}_given")
            for vote in ("useful", "funny", "cool")
        ],
        F.coalesce(F.array_size("friends"), F.lit(0)).alias("friend_count"),
        null_safe_sum(*COMPLIMENTS).cast("int").alias("total_compliments"),
        F.coalesce(F.array_contains(elite_years, year), F.lit(False)).alias("is_currently_elite"),
        F.size(elite_years).alias("total_elite_years"),
        (year - F.year(parse_date("member_since"))).cast("int").alias("years_on_platform"),
        "elite",
    )
    return core.withColumns(
        {
            "user_tier": user_tier("is_currently_elite", "review_count", "fans"),
            "engagement_score": engagement_score(),
        }
    )


def user_rules() -> list[tuple[str, Column]]:
    return [
        ("null_user_id", F.col("user_id").isNull()),
        ("null_name", F.col("user_name").isNull()),
        ("null_member_since", F.col("member_since").isNull()),
    ]


def tag_users(bronze: DataFrame, snapshot_year: int | Column, carry: tuple[str, ...] = ()) -> DataFrame:
    shaped = shape_users(bronze, snapshot_year, _carried(bronze, carry))
    return tag_rejects(shaped, corrupt_rule(bronze) + user_rules())


def finish_users(
    clean: DataFrame, target: DataFrame | None, load_ts: Stamp, first_from: str | None = HISTORY_FLOOR
) -> DataFrame:
    """Current and newly closed versions, as :func:`finish_business`."""
    return _version(user_snapshot(clean, load_ts), target, "user_id", load_ts, first_from)


def user_snapshot(clean: DataFrame, load_ts: Stamp) -> DataFrame:
    """One row per user, as :func:`business_snapshot`."""
    rows = clean.drop("elite", CORRUPT)
    unique = dedup_latest(rows, ["user_id"], [F.col("review_count").desc(), _content_order(rows)])
    return _stamped(unique, USER_TRACKED, load_ts)


def user_elite_years(clean: DataFrame) -> DataFrame:
    """One row per valid user and elite year."""
    return explode_array(clean, ["user_id"], "elite", "elite_year", "int")


def silver_users(
    bronze: DataFrame,
    target: DataFrame | None,
    snapshot_year: int | Column,
    load_ts: Stamp,
    first_from: str | None = HISTORY_FLOOR,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """B2: ``(users, elite_years, rejected)``."""
    clean, rejected = split_rejects(tag_users(bronze, snapshot_year))
    return _whole(finish_users(clean, target, load_ts, first_from), target), user_elite_years(clean), rejected


def user_history(
    snapshots: DataFrame, ts: str, first_from: str | None = HISTORY_FLOOR
) -> DataFrame:
    """Versioned user table out of many dated snapshots in one pass (history load)."""
    clean, _ = split_rejects(tag_users(snapshots, F.year(ts), carry=(ts,)))
    return scd2_from_snapshots(clean.drop("elite"), "user_id", USER_TRACKED, ts, first_from)


# ---------------------------------------------------------------- reviews


def measure_text(bronze: DataFrame) -> DataFrame:
    """P13 on the scan itself, so that whoever does not ask for the text never has it shuffled."""
    return bronze.withColumns({**text_features("text"), "text_word_count": batched_word_count("text")})


def metrics_only(bronze: DataFrame) -> DataFrame:
    """P13 with a content hash of the row, ``_line``, in place of the text.

    The rows go through joins and tables without the text; :func:`with_text` fetches it
    for the few that need it.
    """
    return measure_text(hashed_lines(bronze)).drop("text")


def hashed_lines(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn(LINE, row_hash(bronze.columns))


def with_text(bronze: DataFrame, few: DataFrame) -> DataFrame:
    """Bronze rows, text included, of the lines in ``few``, with what ``few`` adds to them.

    Lines meet by their hash and by every plain column both sides have, so only lines that are equal in all
    of them and in the hash of the text count as one; such lines share flags and reason.
    """
    added = [c for c in few.columns if c not in bronze.columns and not c.startswith("text_") and c != LINE]
    shared = [c for c in bronze.columns if c in few.columns]
    # two columns that are both the key of the repeats and of the join, so that ``few`` is shuffled once; NULL fields are
    # equal, and doubles stand as text, because Spark puts them into another form for a join and would shuffle again
    floating = [c for c in shared if isinstance(bronze.schema[c].dataType, (FloatType, DoubleType))]
    row = [F.struct(*[F.col(c).cast("string").alias(c) if c in floating else F.col(c) for c in shared])] if shared else []
    wanted = few.select(F.col(LINE).alias("_wanted"), *[r.alias("_wanted_row") for r in row], *added)
    wanted = wanted.dropDuplicates(["_wanted", "_wanted_row"][: 1 + len(row)])
    lines = hashed_lines(bronze).select("*", *[r.alias("_row") for r in row])
    same = reduce(Column.__and__, [F.col("_row") == F.col("_wanted_row") for _ in row], F.col(LINE) == F.col("_wanted"))
    return lines.join(wanted, same).select(*[F.col(f"_row.{c}") if c in shared and c not in floating else c for c in bronze.columns], *added)


def flag_keys(
    rows: DataFrame, business_keys: DataFrame, user_keys: DataFrame | None = None, hot_share: float | None = None
) -> DataFrame:
    """``biz_valid`` and ``usr_valid`` against one-column frames of distinct keys."""
    rows = fk_flag(rows, "business_id", business_keys, "biz_valid", hot_share)
    return rows if user_keys is None else fk_flag(rows, "user_id", user_keys, "usr_valid", hot_share)


def _flag_current(
    rows: DataFrame, business: DataFrame, users: DataFrame | None, hot_share: float | None
) -> DataFrame:
    """J2, J1 against the current versions of the silver tables."""
    user_keys = None if users is None else current_keys(users, "user_id")
    return flag_keys(rows, current_keys(business, "business_id"), user_keys, hot_share)


def no_words() -> Column:
    return F.coalesce("text_word_count", F.lit(0)) == 0


def review_rules() -> list[tuple[str, Column]]:
    stars = F.col("stars")
    return [
        ("null_review_id", F.col("review_id").isNull()),
        ("orphan_business_id", ~F.col("biz_valid")),
        ("orphan_user_id", ~F.col("usr_valid")),
        ("invalid_stars", stars.isNull() | ~stars.between(1, 5)),
        ("empty_text", no_words()),
    ]


def tag_reviews(
    bronze: DataFrame, business: DataFrame, users: DataFrame, hot_share: float | None = None
) -> DataFrame:
    """P13, J2, J1 twice, P6. ``business`` and ``users`` are the versioned silver tables."""
    flagged = _flag_current(measure_text(bronze), business, users, hot_share)
    return tag_rejects(flagged, corrupt_rule(bronze) + review_rules())


def finish_reviews(clean: DataFrame, load_ts: Stamp | None = None) -> DataFrame:
    """P14, P12 and W1. The order is total: rows that still tie are equal in every column."""
    narrow = clean.select(
        "review_id",
        "business_id",
        "user_id",
        "date",
        F.col("stars").try_cast("int").alias("stars"),
        *[c.alias(n) for n, c in vote_features("useful", "funny", "cool").items()],
        "text_char_len",
        "text_word_count",
    )
    newest = [F.col("date").desc_nulls_last()]
    ties = [F.col(c).desc_nulls_last() for c in ("stars", "useful", "funny", "cool")]
    ties += [F.col(c) for c in ("business_id", "user_id", "text_char_len", "text_word_count")]
    latest = dedup_latest(narrow, ["review_id"], newest + ties)
    enriched = latest.withColumn("review_date", parse_date("date")).withColumns(
        {
            "review_year": F.year("review_date"),
            "review_month": F.month("review_date"),
            "sentiment_proxy": sentiment("stars"),
            "is_high_quality": high_quality("text_word_count", "total_votes"),
        }
    )
    return stamp(enriched.drop("date"), "loaded_at", load_ts)


def silver_reviews(
    bronze: DataFrame,
    business: DataFrame,
    users: DataFrame,
    target: DataFrame | None = None,
    load_ts: Stamp | None = None,
    hot_share: float | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(reviews, rejected)``; with a target, resubmitted reviews replace their old rows.

    ``hot_share`` splits keys that hold at least that share of the rows: here the key lists
    are aggregations, which the adaptive planner does not split against.
    """
    clean, rejected = split_rejects(tag_reviews(bronze, business, users, hot_share))
    reviews = finish_reviews(clean, load_ts)
    return (reviews if target is None else upsert(target, reviews, "review_id")), rejected


# ---------------------------------------------------------------- check-ins


def expand_checkins(bronze: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per packed check-in, total and position kept. ``carry`` keeps columns of the packed row."""
    return explode_events(
        bronze, ["business_id", *carry], "date", "checkin_ts_raw", "total_checkins_for_business", "checkin_ordinal"
    )


def finish_checkins(parsed: DataFrame, load_ts: Stamp | None = None) -> DataFrame:
    """P17."""
    return stamp(
        parsed.withColumns(time_features("checkin_at", "checkin")).drop("checkin_ts_raw"), "loaded_at", load_ts
    )


def silver_checkins(
    bronze: DataFrame, load_ts: Stamp | None = None, carry: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """``(checkins, rejected)``; rejected rows are single unparseable stamps."""
    parsed, rejected = split_unparseable(expand_checkins(bronze, carry), "checkin_ts_raw", "checkin_at")
    return finish_checkins(parsed, load_ts), rejected


# ---------------------------------------------------------------- tips


def tip_rules() -> list[tuple[str, Column]]:
    return [
        ("null_business_id", F.col("business_id").isNull()),
        ("null_user_id", F.col("user_id").isNull()),
        ("orphan_business_id", ~F.col("biz_valid")),
        ("orphan_user_id", ~F.col("usr_valid")),
        ("empty_text", no_words()),
    ]


def tag_tips(
    bronze: DataFrame, business: DataFrame, users: DataFrame, hot_share: float | None = None
) -> DataFrame:
    flagged = _flag_current(measure_text(bronze), business, users, hot_share)
    return tag_rejects(flagged, corrupt_rule(bronze) + tip_rules())


def finish_tips(clean: DataFrame, load_ts: Stamp | None = None) -> DataFrame:
    """P12 and W1 on the parsed day: one tip per business, user and day.

    A day that does not parse counts as the text it is, so such tips stay apart. ``tip_day`` keeps
    that day, parsed or not, as part of the tip's key.
    """
    narrow = clean.select(
        "business_id",
        "user_id",
        "date",
        parse_date("date").alias("tip_date"),
        F.coalesce("compliment_count", F.lit(0)).cast("int").alias("compliment_count"),
        "text_char_len",
        "text_word_count",
    )
    order = [F.col(c).desc_nulls_last() for c in ("date", "compliment_count", "text_char_len", "text_word_count")]
    day = F.coalesce(F.col("tip_date").cast("string"), F.col("date"))
    latest = dedup_latest(narrow.withColumn("tip_day", day), ["business_id", "user_id", "tip_day"], order).drop("date")
    return stamp(
        latest.withColumns(
            {
                "tip_year": F.year("tip_date"),
                "tip_month": F.month("tip_date"),
                "is_popular_tip": F.col("compliment_count") >= POPULAR_TIP_COMPLIMENTS,
            }
        ),
        "loaded_at",
        load_ts,
    )


def silver_tips(
    bronze: DataFrame,
    business: DataFrame,
    users: DataFrame,
    load_ts: Stamp | None = None,
    hot_share: float | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(tips, rejected)``. ``hot_share``: see :func:`silver_reviews`."""
    clean, rejected = split_rejects(tag_tips(bronze, business, users, hot_share))
    return finish_tips(clean, load_ts), rejected


# ---------------------------------------------------------------- photos


def clean_labels(bronze: DataFrame, vocabulary: tuple[str, ...] = PHOTO_LABELS) -> DataFrame:
    """P10."""
    return bronze.withColumn("label_clean", normalize_label("label", vocabulary))


def photo_rules() -> list[tuple[str, Column]]:
    return [
        ("null_photo_id", F.col("photo_id").isNull()),
        ("null_business_id", F.col("business_id").isNull()),
        ("orphan_business_id", ~F.col("biz_valid")),
    ]


def tag_photos(
    bronze: DataFrame,
    business: DataFrame,
    vocabulary: tuple[str, ...] = PHOTO_LABELS,
    hot_share: float | None = None,
) -> DataFrame:
    flagged = _flag_current(clean_labels(bronze, vocabulary), business, None, hot_share)
    return tag_rejects(flagged, corrupt_rule(bronze) + photo_rules())


def finish_photos(clean: DataFrame, load_ts: Stamp | None = None) -> DataFrame:
    """P11."""
    shaped = clean.select(
        "photo_id",
        "business_id",
        F.col("label_clean").alias("label"),
        *[c.alias(n) for n, c in caption_features("caption").items()],
    )
    return stamp(shaped, "loaded_at", load_ts)


def silver_photos(
    bronze: DataFrame,
    business: DataFrame,
    vocabulary: tuple[str, ...] = PHOTO_LABELS,
    load_ts: Stamp | None = None,
    hot_share: float | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(photos, rejected)``. ``hot_share``: see :func:`silver_reviews`."""
    clean, rejected = split_rejects(tag_photos(bronze, business, vocabulary, hot_share))
    return finish_photos(clean, load_ts), rejected


def label_distribution(photos: DataFrame) -> DataFrame:
    """A3/O2: photos per label."""
    return photos.groupBy("label").agg(F.count(F.lit(1)).alias("photo_count")).orderBy("label")


def stamp(df: DataFrame, column: str, load_ts: Stamp | None) -> DataFrame:
    """Add a load-time column: one literal per run, so all tables of a run agree."""
    return df if load_ts is None else df.withColumn(column, as_timestamp(load_ts))

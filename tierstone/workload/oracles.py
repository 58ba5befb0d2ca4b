"""Check SQL: the same results from the raw tables in plain SQL, for another engine.

The statements are written independently of the DataFrame plans: joins before
grouping, conditional counts over whole rows, ``count(distinct ...)``, plain
``rank()``. Common parts are named once and put together by dependency.
"""

from __future__ import annotations

from ..plans.checks import ACCEPTED, NOT_NULL, UNIQUE

# name -> (names it builds on, body)
PARTS: dict[str, tuple[tuple[str, ...], str]] = {}
ORACLES: dict[str, str] = {}


def part(name: str, needs: tuple[str, ...], body: str) -> None:
    PARTS[name] = (needs, body)


def oracle(
    name: str, needs: tuple[str, ...], select: str, dates: tuple[str, ...] = (), counts: tuple[str, ...] = ()
) -> None:
    """Register check SQL; ``dates`` are returned as text, ``counts`` that can be NULL as double."""
    changed = [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dates] + [f"cast({c} AS double) AS {c}" for c in counts]
    if changed:
        select = f"SELECT * REPLACE ({', '.join(changed)}) FROM ({select})"
    ordered: list[str] = []

    def visit(item: str) -> None:
        for below in PARTS[item][0]:
            visit(below)
        if item not in ordered:
            ordered.append(item)

    for need in needs:
        visit(need)
    parts = ",\n".join(f"{item} AS ({PARTS[item][1]})" for item in ordered)
    ORACLES[name] = f"WITH {parts}\n{select}" if parts else select


def ts(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {column}"


def rnd(expression: str, digits: int) -> str:
    """Half-up rounding on the decimal value, as double."""
    return f"cast(round(cast({expression} AS decimal(38, 10)), {digits}) AS double)"


# ------------------------------------------------------------ bronze

part("business_snap", (), """
    SELECT make_timestamp(yr, 7, 1, 0, 0, 0.0) AS snapshot_ts,
           cast(s_suppkey AS varchar) AS business_id, s_name AS business_name,
           n_name || ' street' AS address, n_name AS city, r_name AS state,
           cast(n_nationkey AS varchar) AS postal_code,
           CASE WHEN s_acctbal >= 0 THEN cast(n_nationkey AS double) END AS latitude,
           cast(r_regionkey AS double) AS longitude,
           round(q * 2 / (n * 10)) / 2 AS stars,
           cast(floor(n / 50) * 50 AS int) AS review_count,
           open_lines * 5 >= n * 2 AS is_open,
           concat_ws(', ', CASE WHEN returned_lines * 3 >= n THEN 'Returns' END,
                     CASE WHEN open_lines * 2 >= n THEN 'Open orders' END,
                     CASE WHEN bulk_lines * 8 >= n THEN 'Bulk' END, 'General') AS categories,
           1 + cast(returned_lines * 3 >= n AS int) + cast(open_lines * 2 >= n AS int)
             + cast(bulk_lines * 8 >= n AS int) AS category_count,
           r_regionkey + 5 AS wd_open, r_regionkey + 17 AS wd_close,
           CASE WHEN s_acctbal > 5000 THEN 10 END AS sat_open,
           CASE WHEN s_acctbal > 5000 THEN 16 END AS sat_close,
           CASE WHEN s_acctbal > 1000 THEN cast(least(4, floor(c / (n * 1000000))) AS int) END AS price_range,
           CASE WHEN s_acctbal > 7000 THEN 'free' WHEN s_acctbal > 4000 THEN 'paid' ELSE 'none' END AS wifi,
           s_acctbal > 5000 AS outdoor_seating,
           n_nationkey > 12 AS has_tv,
           r_regionkey > 1 AS delivery,
           r_regionkey > 2 AS takeout,
           s_acctbal > 3000 AS reservations,
           s_acctbal <= 6000 AS good_for_kids,
           CASE WHEN n_nationkey > 16 THEN 'full_bar' WHEN n_nationkey > 8 THEN 'beer_and_wine'
                ELSE 'none' END AS alcohol,
           CASE WHEN s_acctbal > 8000 THEN 'loud' WHEN s_acctbal > 500 THEN 'average' ELSE '' END AS noise_level,
           CASE WHEN r_regionkey > 0 THEN 'casual' ELSE 'dressy' END AS attire
    FROM (SELECT l_suppkey, year(l_shipdate) AS yr, count(*) AS n,
                 cast(sum(cast(l_quantity AS bigint)) AS bigint) AS q,
                 cast(sum(cast(round(l_extendedprice * 100) AS bigint)) AS bigint) AS c,
                 count(*) FILTER (WHERE l_linestatus = 'O') AS open_lines,
                 count(*) FILTER (WHERE l_returnflag = 'R') AS returned_lines,
                 count(*) FILTER (WHERE l_quantity >= 45) AS bulk_lines
          FROM lineitem GROUP BY ALL)
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey""")

part("business_tagged", ("business_snap",), """
    SELECT *, CASE WHEN business_id IS NULL THEN 'null_business_id'
                   WHEN business_name IS NULL THEN 'null_name'
                   WHEN latitude IS NULL OR longitude IS NULL THEN 'null_coordinates'
                   WHEN stars IS NULL OR stars < 1 OR stars > 5 THEN 'invalid_stars' END AS reject_reason
    FROM business_snap""")

part("business", ("business_tagged",), """
    SELECT * EXCLUDE (tracked, before, rn, reject_reason, snapshot_ts),
           snapshot_ts AS valid_from,
           coalesce(lead(snapshot_ts) OVER (PARTITION BY business_id ORDER BY snapshot_ts),
                    TIMESTAMP '9999-12-31 00:00:00') AS valid_to,
           lead(snapshot_ts) OVER (PARTITION BY business_id ORDER BY snapshot_ts) IS NULL AS is_current
    FROM (SELECT *, lag(tracked) OVER (PARTITION BY business_id ORDER BY snapshot_ts) AS before,
                 row_number() OVER (PARTITION BY business_id ORDER BY snapshot_ts) AS rn
          FROM (SELECT *, row(stars, review_count, is_open, city, state, categories, price_range) AS tracked
                FROM business_tagged WHERE reject_reason IS NULL))
    WHERE rn = 1 OR tracked IS DISTINCT FROM before""")

_HOURS = ", ".join(
    f"wd_open AS {d}_open, wd_close AS {d}_close" for d in ("mon", "tue", "wed", "thu", "fri")
) + ", sat_open, sat_close, cast(NULL AS int) AS sun_open, cast(NULL AS int) AS sun_close"
_ATTRIBUTES = (
    "price_range, wifi, outdoor_seating, has_tv, delivery, takeout, reservations, good_for_kids, alcohol, "
    "noise_level, attire"
)
_BUSINESS = (
    "business_id, business_name, address, city, state, postal_code, latitude, longitude, stars, review_count, "
    f"is_open, categories, category_count, {_ATTRIBUTES}, {_HOURS}"
)
_BUSINESS_COUNTS = ("price_range", "sat_open", "sat_close", "sun_open", "sun_close", "category_count")
_VALIDITY = f"{ts('valid_from')}, {ts('valid_to')}, is_current"

part("user_snap", (), """
    SELECT make_timestamp(yr, 1, 1, 0, 0, 0.0) AS snapshot_ts, cast(c_custkey AS varchar) AS user_id,
           CASE WHEN c_acctbal >= 0 THEN c_name END AS user_name,
           cast(joined AS date) AS member_since,
           cast(orders_so_far * 10 AS int) AS review_count,
           least(5.0::double, greatest(1.0::double, floor(c_acctbal / 2000) + 1)) AS average_stars,
           cast(greatest(0, floor(c_acctbal / 100)) AS int) AS fans,
           cast(n AS int) AS votes_useful_given, cast(0 AS int) AS votes_funny_given,
           cast(urgent AS int) AS votes_cool_given,
           cast(kinds AS int) AS friend_count, cast(n AS int) AS total_compliments,
           spent >= 60000000 AS is_currently_elite,
           cast(elite_so_far AS int) AS total_elite_years,
           cast(yr - year(joined) AS int) AS years_on_platform,
           yr
    FROM (SELECT *, sum(n) OVER so_far AS orders_so_far,
                 count(*) FILTER (WHERE spent >= 60000000) OVER so_far AS elite_so_far,
                 min(first_order) OVER (PARTITION BY o_custkey) AS joined
          FROM (SELECT o_custkey, year(o_orderdate) AS yr, count(*) AS n,
                       cast(sum(cast(round(o_totalprice * 100) AS bigint)) AS bigint) AS spent,
                       min(o_orderdate) AS first_order, count(DISTINCT o_orderpriority) AS kinds,
                       count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent
                FROM orders GROUP BY ALL)
          WINDOW so_far AS (PARTITION BY o_custkey ORDER BY yr))
    JOIN customer ON o_custkey = c_custkey""")

part("user_tagged", ("user_snap",), """
    SELECT *, CASE WHEN is_currently_elite THEN 'elite'
                   WHEN review_count >= 100 AND fans >= 50 THEN 'veteran'
                   WHEN review_count >= 25 THEN 'active' ELSE 'newcomer' END AS user_tier,
           review_count * 3 + fans * 2 + friend_count + total_compliments AS engagement_score,
           CASE WHEN user_id IS NULL THEN 'null_user_id' WHEN user_name IS NULL THEN 'null_name'
                WHEN member_since IS NULL THEN 'null_member_since' END AS reject_reason
    FROM user_snap""")

part("users", ("user_tagged",), """
    SELECT * EXCLUDE (tracked, before, rn, reject_reason, snapshot_ts, yr),
           snapshot_ts AS valid_from,
           coalesce(lead(snapshot_ts) OVER (PARTITION BY user_id ORDER BY snapshot_ts),
                    TIMESTAMP '9999-12-31 00:00:00') AS valid_to,
           lead(snapshot_ts) OVER (PARTITION BY user_id ORDER BY snapshot_ts) IS NULL AS is_current
    FROM (SELECT *, lag(tracked) OVER (PARTITION BY user_id ORDER BY snapshot_ts) AS before,
                 row_number() OVER (PARTITION BY user_id ORDER BY snapshot_ts) AS rn
          FROM (SELECT *, row(user_tier, review_count, fans, average_stars, is_currently_elite) AS tracked
                FROM user_tagged WHERE reject_reason IS NULL))
    WHERE rn = 1 OR tracked IS DISTINCT FROM before""")

_USERS = (
    "user_id, user_name, member_since, review_count, average_stars, fans, votes_useful_given, votes_funny_given, "
    "votes_cool_given, friend_count, total_compliments, is_currently_elite, total_elite_years, years_on_platform, "
    "user_tier, engagement_score"
)

part("reviews_raw", (), r"""
    SELECT concat_ws('-', l_orderkey, l_linenumber) AS review_id,
           cast(l_suppkey AS varchar) AS business_id, cast(o_custkey AS varchar) AS user_id,
           l_quantity / 10 AS stars, cast(round(l_discount * 100) AS int) AS useful,
           cast(round(l_tax * 100) AS int) AS funny, nullif(l_linenumber - 1, 0) AS cool,
           repeat(l_returnflag || chr(10), cast(floor(l_extendedprice / l_quantity / 100) AS int)) AS text,
           strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")

part("valid_business", ("business",), "SELECT DISTINCT business_id AS b FROM business WHERE is_current")
part("valid_user", ("users",), "SELECT DISTINCT user_id AS u FROM users WHERE is_current")

part("reviews_tagged", ("reviews_raw", "valid_business", "valid_user"), r"""
    SELECT r.*, b IS NOT NULL AS biz_valid, u IS NOT NULL AS usr_valid,
           CASE WHEN review_id IS NULL THEN 'null_review_id'
                WHEN b IS NULL THEN 'orphan_business_id'
                WHEN u IS NULL THEN 'orphan_user_id'
                WHEN stars IS NULL OR stars < 1 OR stars > 5 THEN 'invalid_stars'
                WHEN text IS NULL OR NOT regexp_matches(text, '\S') THEN 'empty_text' END AS reject_reason
    FROM reviews_raw r LEFT JOIN valid_business ON business_id = b LEFT JOIN valid_user ON user_id = u""")

_WORDS = r"len(string_split_regex(regexp_replace(text, '^\s+|\s+$', '', 'g'), '\s+'))"

part("reviews", ("reviews_tagged",), f"""
    SELECT * EXCLUDE (date), useful + funny + cool AS total_votes,
           cast(date[:10] AS date) AS review_date,
           cast(year(cast(date[:10] AS date)) AS int) AS review_year,
           cast(month(cast(date[:10] AS date)) AS int) AS review_month,
           CASE WHEN stars >= 4 THEN 'positive' WHEN stars = 3 THEN 'neutral' ELSE 'negative' END AS sentiment_proxy,
           text_word_count >= 50 AND useful + funny + cool >= 3 AS is_high_quality
    FROM (SELECT review_id, business_id, user_id, date, cast(trunc(stars) AS int) AS stars,
                 coalesce(useful, 0) AS useful, coalesce(funny, 0) AS funny, coalesce(cool, 0) AS cool,
                 cast(length(text) AS int) AS text_char_len, cast({_WORDS} AS int) AS text_word_count
          FROM reviews_tagged WHERE reject_reason IS NULL)
    QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY date DESC, stars DESC, useful DESC, funny DESC,
        cool DESC, business_id, user_id, text_char_len, text_word_count) = 1""")

part("checkins_packed", (), """
    SELECT cast(user_id AS varchar) AS business_id, day, list(stamp ORDER BY stamp) AS stamps
    FROM (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day,
                 CASE WHEN event_type = 'error' THEN strftime(ts, '%Y/%m/%d %H:%M')
                      ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS stamp
          FROM events)
    GROUP BY user_id, day""")

part("checkin_rows", ("checkins_packed",), """
    SELECT business_id, day, unnest(stamps) AS stamp, cast(len(stamps) AS int) AS total,
           cast(unnest(range(len(stamps))) AS int) AS ordinal
    FROM checkins_packed""")

part("checkins", ("checkin_rows",), """
    SELECT business_id, day, total, ordinal, try_strptime(stamp, '%Y-%m-%d %H:%M:%S') AS checkin_at
    FROM checkin_rows WHERE try_strptime(stamp, '%Y-%m-%d %H:%M:%S') IS NOT NULL""")

part("tips_tagged", ("valid_business", "valid_user"), r"""
    SELECT t.*, CASE WHEN business_id IS NULL THEN 'null_business_id'
                     WHEN user_id IS NULL THEN 'null_user_id'
                     WHEN b IS NULL THEN 'orphan_business_id'
                     WHEN u IS NULL THEN 'orphan_user_id'
                     WHEN text IS NULL OR NOT regexp_matches(text, '\S') THEN 'empty_text' END AS reject_reason
    FROM (SELECT cast(l_suppkey AS varchar) AS business_id, cast(o_custkey AS varchar) AS user_id, text,
                 strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS date, quality * 4 + toxic * 8 AS compliment_count
          FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
          LEFT JOIN orders ON d.doc_id = o_orderkey
          LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY ALL)
            ON d.doc_id = l_orderkey) t
    LEFT JOIN valid_business ON business_id = b LEFT JOIN valid_user ON user_id = u""")

part("tips", ("tips_tagged",), f"""
    SELECT business_id, user_id, date[:10] AS tip_day, tip_date, compliment_count, text_char_len, text_word_count,
           cast(year(tip_date) AS int) AS tip_year, cast(month(tip_date) AS int) AS tip_month,
           compliment_count >= 5 AS is_popular_tip
    FROM (SELECT business_id, user_id, date, cast(date[:10] AS date) AS tip_date,
                 cast(coalesce(compliment_count, 0) AS int) AS compliment_count,
                 cast(length(text) AS int) AS text_char_len, cast({_WORDS} AS int) AS text_word_count
          FROM tips_tagged WHERE reject_reason IS NULL)
    QUALIFY row_number() OVER (PARTITION BY business_id, user_id, tip_date
        ORDER BY date DESC, compliment_count DESC, text_char_len DESC, text_word_count DESC) = 1""")

part("photos_raw", (), """
    SELECT cast(page_id AS varchar) AS photo_id, cast(page_id AS varchar) AS business_id,
           nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS caption,
           regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) AS lang
    FROM pages""")

part("photos_tagged", ("photos_raw", "valid_business"), """
    SELECT *, CASE WHEN photo_id IS NULL THEN 'null_photo_id' WHEN business_id IS NULL THEN 'null_business_id'
                   WHEN b IS NULL THEN 'orphan_business_id' END AS reject_reason,
           CASE WHEN lang IN ('en', 'fr', 'de') THEN lang ELSE 'unknown' END AS label
    FROM photos_raw LEFT JOIN valid_business ON business_id = b""")

part("categories", ("business_tagged",), """
    SELECT DISTINCT business_id, trim(category) AS category
    FROM (SELECT business_id, unnest(string_split(categories, ',')) AS category
          FROM business_tagged WHERE reject_reason IS NULL)
    WHERE trim(category) <> ''""")

# ------------------------------------------------------------ gold

part("dim_business", ("business",), """
    SELECT *, md5(concat_ws('-', business_id, strftime(valid_from, '%Y-%m-%d %H:%M:%S'))) AS business_key,
           CASE WHEN is_open THEN 'open' ELSE 'closed' END AS status,
           CASE price_range WHEN 1 THEN 'budget' WHEN 2 THEN 'moderate' WHEN 3 THEN 'upscale'
                WHEN 4 THEN 'fine_dining' ELSE 'unknown' END AS price_tier,
           sat_open IS NOT NULL AS is_open_weekends,
           delivery AND takeout AND reservations AS is_full_service,
           CASE WHEN stars >= 4.5 THEN 'exceptional' WHEN stars >= 4 THEN 'great' WHEN stars >= 3.5 THEN 'good'
                WHEN stars >= 3 THEN 'average' ELSE 'below_average' END AS rating_tier,
           CASE WHEN review_count >= 1000 THEN 'very_popular' WHEN review_count >= 200 THEN 'popular'
                WHEN review_count >= 50 THEN 'established' WHEN review_count >= 10 THEN 'growing'
                ELSE 'new' END AS popularity_tier
    FROM business""")

part("dim_user", ("users",), """
    SELECT *, md5(concat_ws('-', user_id, strftime(valid_from, '%Y-%m-%d %H:%M:%S'))) AS user_key,
           cast(year(member_since) AS int) AS member_join_year,
           CASE user_tier WHEN 'elite' THEN 4 WHEN 'veteran' THEN 3 WHEN 'active' THEN 2 ELSE 1 END AS tier_rank
    FROM users""")

part("fact_reviews", ("reviews", "dim_business", "dim_user"), """
    SELECT r.*, b.business_key, b.business_name, b.city, b.state, b.stars AS business_stars_at_review_time,
           b.price_tier, b.status AS business_status_at_review_time, b.category_count,
           u.user_key, u.user_tier AS user_tier_at_review_time, u.is_currently_elite AS user_was_elite_at_review_time,
           u.review_count AS user_total_reviews_at_review_time, u.engagement_score AS user_engagement_at_review_time,
           CASE WHEN r.stars >= 4 AND text_word_count >= 50 THEN 'detailed_positive'
                WHEN r.stars >= 4 AND text_word_count < 50 THEN 'brief_positive'
                WHEN r.stars <= 2 AND text_word_count >= 50 THEN 'detailed_negative'
                WHEN r.stars <= 2 AND text_word_count < 50 THEN 'brief_negative' ELSE 'neutral' END AS review_type,
           CASE WHEN u.is_currently_elite THEN 'elite_reviewer' WHEN u.user_tier = 'veteran' THEN 'veteran_reviewer'
                ELSE 'standard_reviewer' END AS reviewer_segment
    FROM reviews r
    LEFT JOIN dim_business b ON r.business_id = b.business_id
         AND r.review_date >= b.valid_from AND r.review_date < b.valid_to
    LEFT JOIN dim_user u ON r.user_id = u.user_id AND r.review_date >= u.valid_from AND r.review_date < u.valid_to""")

part("fact_tips", ("tips", "dim_business", "dim_user"), """
    SELECT t.*, b.business_key, b.business_name, b.city, b.state, b.price_tier, b.rating_tier,
           b.status AS business_status_at_tip_time, u.user_key, u.user_tier AS user_tier_at_tip_time,
           u.is_currently_elite AS user_was_elite_at_tip_time,
           md5(concat_ws('-', t.business_id, t.user_id, tip_day)) AS tip_id,
           CASE WHEN compliment_count >= 10 THEN 'viral' WHEN compliment_count >= 5 THEN 'popular'
                WHEN compliment_count >= 1 THEN 'engaged' ELSE 'no_engagement' END AS tip_engagement_tier,
           CASE WHEN text_word_count <= 10 THEN 'very_brief' WHEN text_word_count <= 30 THEN 'brief'
                WHEN text_word_count <= 60 THEN 'detailed' ELSE 'very_detailed' END AS tip_length_tier
    FROM tips t
    LEFT JOIN dim_business b ON t.business_id = b.business_id
         AND t.tip_date >= b.valid_from AND t.tip_date < b.valid_to
    LEFT JOIN dim_user u ON t.user_id = u.user_id AND t.tip_date >= u.valid_from AND t.tip_date < u.valid_to""")

part("tips_monthly", ("fact_tips",), """
    SELECT business_id, tip_year, tip_month, count(*) AS tip_count,
           cast(sum(compliment_count) AS bigint) AS total_tip_compliments,
           count(*) FILTER (WHERE is_popular_tip) AS popular_tip_count
    FROM fact_tips GROUP BY ALL""")

part("reviews_monthly", ("fact_reviews",), f"""
    SELECT business_id, review_year, review_month,
           arg_max_null(business_name, review_date) AS business_name,
           arg_max_null(city, review_date) AS city, arg_max_null(state, review_date) AS state,
           count(*) AS review_count, {rnd('avg(stars)', 2)} AS avg_stars,
           {rnd('avg(text_word_count)', 0)} AS avg_review_length,
           cast(sum(total_votes) AS bigint) AS total_votes, cast(sum(useful) AS bigint) AS useful_votes,
           count(*) FILTER (WHERE sentiment_proxy = 'positive') AS positive_reviews,
           count(*) FILTER (WHERE sentiment_proxy = 'negative') AS negative_reviews,
           count(*) FILTER (WHERE is_high_quality) AS high_quality_reviews,
           count(*) FILTER (WHERE reviewer_segment = 'elite_reviewer') AS elite_reviewer_count,
           {rnd("100.0::double * count(*) FILTER (WHERE sentiment_proxy = 'positive') / count(*)", 1)} AS positive_pct
    FROM fact_reviews GROUP BY business_id, review_year, review_month""")

oracle("reviews_monthly", ("reviews_monthly",), "SELECT * FROM reviews_monthly")
oracle("tips_monthly", ("tips_monthly",), "SELECT * FROM tips_monthly")

part("monthly_base", ("reviews_monthly", "tips_monthly"), """
    SELECT r.*, coalesce(tip_count, 0) AS tip_count, coalesce(total_tip_compliments, 0) AS total_tip_compliments,
           coalesce(popular_tip_count, 0) AS popular_tip_count, review_count + coalesce(tip_count, 0) AS total_engagement
    FROM reviews_monthly r
    LEFT JOIN tips_monthly t ON r.business_id = t.business_id AND review_year = tip_year AND review_month = tip_month""")

oracle("flagship_business_monthly", ("monthly_base",), f"""
    SELECT * EXCLUDE (roll_avg), {rnd('roll_avg', 2)} AS rolling_3m_avg_stars,
           {rnd('100.0::double * (review_count - prior_month_reviews) / nullif(prior_month_reviews, 0)', 1)}
             AS review_count_mom_pct,
           {rnd('avg_stars - prior_month_avg_stars', 2)} AS stars_mom_delta,
           CASE WHEN avg_stars > prior_month_avg_stars + 0.1::double THEN 'improving'
                WHEN avg_stars < prior_month_avg_stars - 0.1::double THEN 'declining' ELSE 'stable' END AS rating_trend
    FROM (SELECT *, lag(review_count) OVER m AS prior_month_reviews, lag(avg_stars) OVER m AS prior_month_avg_stars,
                 avg(avg_stars) OVER (m ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS roll_avg,
                 cast(sum(review_count) OVER (m ROWS UNBOUNDED PRECEDING) AS bigint) AS cumulative_reviews,
                 cast(sum(tip_count) OVER (m ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS bigint)
                   AS rolling_3m_tip_count,
                 rank() OVER (PARTITION BY city, review_year, review_month ORDER BY review_count DESC)
                   AS city_monthly_rank
          FROM monthly_base WINDOW m AS (PARTITION BY business_id ORDER BY review_year, review_month))""", counts=("prior_month_reviews",))

oracle("category_city_yearly", ("fact_reviews", "categories"), f"""
    SELECT * EXCLUDE (prior_stars), {rnd('avg_stars - prior_stars', 2)} AS stars_yoy_delta,
           CASE WHEN review_count_yoy_pct > 20 THEN 'fast_growing' WHEN review_count_yoy_pct > 5 THEN 'growing'
                WHEN review_count_yoy_pct < -20 THEN 'fast_declining' WHEN review_count_yoy_pct < -5 THEN 'declining'
                ELSE 'stable' END AS growth_label
    FROM (SELECT *,
             {rnd('100.0::double * (review_count - prior_year_reviews) / nullif(prior_year_reviews, 0)', 1)}
               AS review_count_yoy_pct
          FROM (SELECT *, lag(review_count) OVER y AS prior_year_reviews, lag(avg_stars) OVER y AS prior_stars,
                       cast(sum(review_count) OVER (y ROWS UNBOUNDED PRECEDING) AS bigint) AS cumulative_reviews,
                       cast(rank() OVER (PARTITION BY review_year, city ORDER BY review_count DESC) AS int)
                         AS category_rank_in_city
                FROM (SELECT review_year, city, state, category, count(DISTINCT review_id) AS review_count,
                             {rnd('avg(stars)', 2)} AS avg_stars,
                             cast(sum(total_votes) AS bigint) AS total_votes,
                             count(*) FILTER (WHERE sentiment_proxy = 'positive') AS positive_reviews,
                             count(*) FILTER (WHERE sentiment_proxy = 'negative') AS negative_reviews,
                             count(*) FILTER (WHERE is_high_quality) AS high_quality_reviews,
                             {rnd("100.0::double * count(*) FILTER (WHERE sentiment_proxy = 'positive') / count(*)", 1)}
                               AS positive_pct
                      FROM fact_reviews JOIN categories USING (business_id)
                      GROUP BY review_year, city, state, category)
                WINDOW y AS (PARTITION BY city, state, category ORDER BY review_year)))""", counts=("prior_year_reviews",))

part("cohort_joined", ("fact_reviews", "dim_user"), """
        SELECT r.*, u.member_join_year AS cohort_year, u.user_tier, r.review_year - u.member_join_year AS age
        FROM fact_reviews r JOIN dim_user u ON r.user_id = u.user_id
        WHERE u.is_current AND r.review_year >= u.member_join_year""")

part("cohort_yearly", ("cohort_joined",), f"""
        SELECT cohort_year, review_year, age AS years_since_joining, count(DISTINCT user_id) AS active_users,
               count(DISTINCT review_id) AS total_reviews,
               {rnd('count(DISTINCT review_id) / count(DISTINCT user_id)', 2)} AS reviews_per_active_user,
               {rnd('avg(stars)', 2)} AS avg_stars, {rnd('avg(text_word_count)', 0)} AS avg_review_length,
               count(*) FILTER (WHERE is_high_quality) AS high_quality_reviews,
               {rnd('100.0::double * count(*) FILTER (WHERE is_high_quality) / count(*)', 1)} AS high_quality_pct,
               count(*) FILTER (WHERE sentiment_proxy = 'positive') AS positive_reviews,
               {rnd("100.0::double * count(*) FILTER (WHERE sentiment_proxy = 'positive') / count(*)", 1)} AS positive_pct,
               count(*) FILTER (WHERE user_tier = 'elite') AS elite_user_reviews,
               {rnd("100.0::double * count(DISTINCT CASE WHEN user_tier = 'elite' THEN user_id END) / count(DISTINCT user_id)", 1)}
                 AS elite_user_pct
        FROM cohort_joined GROUP BY ALL""")

oracle("customer_cohort_retention", ("cohort_yearly",), f"""    SELECT y.*, cohort_size_year_0, baseline_avg_stars,
           {rnd('100.0::double * active_users / nullif(cohort_size_year_0, 0)', 1)} AS retention_pct,
           {rnd('avg_stars - baseline_avg_stars', 2)} AS stars_vs_baseline
    FROM cohort_yearly y
    LEFT JOIN (SELECT cohort_year, active_users AS cohort_size_year_0, avg_stars AS baseline_avg_stars
               FROM cohort_yearly WHERE years_since_joining = 0) USING (cohort_year)""", counts=("cohort_size_year_0",))

oracle("pit_join_two_dims", ("fact_reviews",), "SELECT * FROM fact_reviews", dates=("review_date",), counts=("category_count", "user_total_reviews_at_review_time", "user_engagement_at_review_time"))

oracle("tip_tiers_documents", ("fact_tips",), "SELECT * FROM fact_tips", dates=("tip_date",))

oracle("event_time_features", ("checkins", "dim_business"), """
    SELECT md5(concat_ws('-', c.business_id, strftime(checkin_at, '%Y-%m-%d %H:%M:%S'), ordinal)) AS checkin_id,
           c.business_id, business_key, business_name, city, state, price_tier, status AS business_status,
           strftime(checkin_at, '%Y-%m-%d %H:%M:%S') AS checkin_at, ordinal AS checkin_ordinal,
           cast(checkin_at AS date) AS checkin_date, cast(year(checkin_at) AS int) AS checkin_year,
           cast(month(checkin_at) AS int) AS checkin_month, cast(hour(checkin_at) AS int) AS checkin_hour,
           cast(dayofweek(checkin_at) + 1 AS int) AS checkin_dow, dayofweek(checkin_at) IN (0, 6) AS is_weekend,
           CASE WHEN hour(checkin_at) BETWEEN 6 AND 11 THEN 'morning'
                WHEN hour(checkin_at) BETWEEN 12 AND 16 THEN 'afternoon'
                WHEN hour(checkin_at) BETWEEN 17 AND 21 THEN 'evening' ELSE 'night' END AS time_of_day,
           hour(checkin_at) BETWEEN 11 AND 13 OR hour(checkin_at) BETWEEN 18 AND 21 AS is_peak_hour,
           total AS total_checkins_for_business
    FROM checkins c LEFT JOIN dim_business b ON c.business_id = b.business_id
         AND checkin_at >= valid_from AND checkin_at < valid_to""", dates=("checkin_date",))

oracle("supplier_profile_tiers", ("dim_business",), f"""
    SELECT business_key, {_BUSINESS}, {_VALIDITY}, status, price_tier, is_open_weekends, is_full_service,
           rating_tier, popularity_tier FROM dim_business""", counts=_BUSINESS_COUNTS)

oracle("customer_tiers", ("dim_user",), f"""
    SELECT user_key, {_USERS}, member_join_year, tier_rank, {_VALIDITY} FROM dim_user""", dates=("member_since",))

oracle("date_dimension", (), """
    SELECT cast(strftime(d, '%Y%m%d') AS int) AS date_key, d AS calendar_date, cast(year(d) AS int) AS year,
           cast(quarter(d) AS int) AS quarter_num, 'Q' || quarter(d) AS quarter_label,
           cast(month(d) AS int) AS month_num, strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_abbr,
           cast(weekofyear(d) AS int) AS week_of_year, strftime(d, '%A') AS day_name, strftime(d, '%a') AS day_abbr,
           cast(dayofweek(d) + 1 AS int) AS day_of_week, cast(day(d) AS int) AS day_of_month,
           cast(dayofyear(d) AS int) AS day_of_year, dayofweek(d) IN (0, 6) AS is_weekend,
           last_day(d) AS last_day_of_month,
           strftime(date_trunc('week', d), '%Y-%m-%d %H:%M:%S') AS week_start_date,
           strftime(date_trunc('month', d), '%Y-%m-%d %H:%M:%S') AS month_start_date,
           strftime(date_trunc('quarter', d), '%Y-%m-%d %H:%M:%S') AS quarter_start_date
    FROM (SELECT cast(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS date) AS d
          FROM orders)""", dates=("calendar_date", "last_day_of_month",))

# ------------------------------------------------------------ versions

oracle("scd2_supplier_history", ("business",), f"SELECT {_BUSINESS}, {_VALIDITY} FROM business", counts=_BUSINESS_COUNTS)

oracle("scd2_customer_history", ("users",), f"SELECT {_USERS}, {_VALIDITY} FROM users", dates=("member_since",))

ORACLES["scd2_merge_snapshots"] = ORACLES["scd2_supplier_history"]
oracle("current_versions", ("business",), "SELECT DISTINCT business_id FROM business WHERE is_current")

oracle("upsert_orders", (), """
    WITH updates AS (
        SELECT l_orderkey AS o_orderkey, max(l_linestatus) AS o_orderstatus,
               cast(sum(cast(round(l_extendedprice * 100) AS bigint)) AS bigint) AS total_cents, 'lines' AS origin
        FROM lineitem GROUP BY l_orderkey)
    SELECT o_orderkey, coalesce(u.o_orderstatus, o.o_orderstatus) AS o_orderstatus,
           coalesce(u.total_cents, cast(round(o_totalprice * 100) AS bigint)) AS total_cents,
           coalesce(origin, 'order') AS origin
    FROM orders o FULL JOIN updates u USING (o_orderkey)""")

oracle("upsert_partitioned_reviews", ("reviews",), """
    SELECT review_id, CASE WHEN again THEN 5 ELSE stars END AS stars,
           review_year + cast(again AS int) AS review_year, CASE WHEN again THEN 'again' ELSE 'first' END AS origin
    FROM (SELECT *, user_id IN (SELECT cast(o_custkey AS varchar) FROM orders WHERE o_orderpriority = '1-URGENT') AS again
          FROM reviews)""")

oracle("dedup_latest_lineitem", (), """
    SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate) FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY lineitem.l_shipdate DESC, l_partkey,
        l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) = 1""")

# ------------------------------------------------------------ joins and validation

oracle("pit_join_lineitem_supplier", ("business",), """
    SELECT l_orderkey, l_linenumber, cast(l_suppkey AS varchar) AS business_id, cast(l_shipdate AS date) AS ship_date,
           cast(round(l_extendedprice * 100) AS bigint) AS price_cents, stars AS stars_then,
           price_range AS price_range_then, categories AS categories_then
    FROM lineitem LEFT JOIN business ON cast(l_suppkey AS varchar) = business_id
         AND l_shipdate >= valid_from AND l_shipdate < valid_to""", dates=("ship_date",), counts=("price_range_then",))

ORACLES["pit_join_hot_keys_split"] = ORACLES["pit_join_lineitem_supplier"]

oracle("orphan_lineitems", ("reviews", "business"), """
    SELECT review_id, r.business_id, review_date, 'no dimension version at event time' AS failure_reason
    FROM reviews r LEFT JOIN business b ON r.business_id = b.business_id
         AND review_date >= valid_from AND review_date < valid_to
    WHERE b.business_id IS NULL""", dates=("review_date",))

oracle("orphan_tips", ("tips", "business"), """
    SELECT t.business_id, user_id, tip_date, compliment_count
    FROM tips t LEFT JOIN business b ON t.business_id = b.business_id AND tip_date >= valid_from AND tip_date < valid_to
    WHERE b.business_id IS NULL""", dates=("tip_date",))

oracle("fk_flag_reject_tagging", ("reviews_tagged",), """
    SELECT review_id, business_id, user_id, stars, useful, biz_valid, usr_valid, date,
           coalesce(reject_reason, 'clean') AS reject_reason FROM reviews_tagged""")

oracle("fk_flag_hot_keys_split", ("valid_business",), """
    SELECT b IS NOT NULL AS known, count(*) AS lines,
           cast(sum(cast(round(l_extendedprice * 100) AS bigint)) AS bigint) AS cents
    FROM lineitem LEFT JOIN valid_business ON cast(l_suppkey AS varchar) = b GROUP BY 1""")

oracle("reject_reason_counts", ("reviews_tagged", "tips_tagged", "photos_tagged", "business_tagged", "user_tagged"),
       " UNION ALL ".join(
    f"SELECT '{name}' AS source_name, coalesce(reject_reason, 'clean') AS reject_reason, count(*) AS row_count "
    f"FROM {table} GROUP BY 2"
    for name, table in (("reviews", "reviews_tagged"), ("tips", "tips_tagged"), ("photos", "photos_tagged"),
                        ("business", "business_tagged"), ("users", "user_tagged"))))

oracle("silver_review_features", ("reviews",), "SELECT * FROM reviews", dates=("review_date",))

oracle("silver_tip_features", ("tips",), "SELECT * FROM tips", dates=("tip_date",))

# ------------------------------------------------------------ nested data

oracle("explode_part_categories", (), """
    SELECT DISTINCT p_partkey, trim(category) AS category
    FROM (SELECT p_partkey, unnest(string_split(concat_ws(', ', p_type, p_brand, replace(p_name, ' ', ', ')), ','))
            AS category FROM part)
    WHERE trim(category) <> ''""")
oracle("business_category_bridge", ("categories",), "SELECT * FROM categories")
oracle("explode_event_times", ("checkin_rows",), "SELECT business_id, day, stamp, total, ordinal FROM checkin_rows")
oracle("unparseable_split", ("checkin_rows",), """
    SELECT business_id, day, stamp AS checkin_ts_raw, total AS total_checkins_for_business, ordinal AS checkin_ordinal
    FROM checkin_rows WHERE try_strptime(stamp, '%Y-%m-%d %H:%M:%S') IS NULL""")
oracle("explode_count_guard", ("checkins_packed", "checkin_rows"), """
    SELECT expected_rows, actual_rows, expected_rows = actual_rows AS matches
    FROM (SELECT cast(sum(len(stamps)) AS bigint) AS expected_rows FROM checkins_packed),
         (SELECT count(*) AS actual_rows FROM checkin_rows)""")
oracle("checkin_count_preserved", ("checkins",), """
    SELECT business_id, day, max(total) AS expected_count, count(*) AS actual_count,
           'exploded rows differ from packed total' AS failure_reason
    FROM checkins GROUP BY business_id, day HAVING max(total) <> count(*)""")
oracle("elite_years_bridge", ("user_tagged",), """
    SELECT DISTINCT a.user_id, cast(b.yr AS int) AS elite_year FROM user_tagged a
    JOIN user_tagged b ON a.user_id = b.user_id AND b.yr <= a.yr AND b.is_currently_elite
    WHERE a.reject_reason IS NULL""")
oracle("hours_flatten", ("business_snap",), f"SELECT business_id, {ts('snapshot_ts')}, {_HOURS} FROM business_snap", counts=_BUSINESS_COUNTS[1:5])

oracle("attributes_flatten", ("business_snap",),
       f"SELECT business_id, {ts('snapshot_ts')}, {_ATTRIBUTES} FROM business_snap", counts=_BUSINESS_COUNTS[:1])

# ------------------------------------------------------------ features

oracle("text_features_documents", (), f"""
    SELECT doc_id, cast(length(text) AS int) AS text_char_len, cast({_WORDS} AS int) AS text_word_count
    FROM documents""")
oracle("vote_and_sentiment_features", ("reviews_raw",), """
    SELECT CASE WHEN trunc(stars) >= 4 THEN 'positive' WHEN trunc(stars) = 3 THEN 'neutral' ELSE 'negative' END
             AS sentiment_proxy,
           cast(sum(useful) AS bigint) AS useful, cast(sum(funny) AS bigint) AS funny,
           cast(sum(coalesce(cool, 0)) AS bigint) AS cool,
           cast(sum(useful + funny + coalesce(cool, 0)) AS bigint) AS total_votes,
           max(useful + funny + coalesce(cool, 0)) AS most_votes
    FROM reviews_raw GROUP BY 1""")
oracle("page_label_captions", ("photos_raw",), """
    SELECT photo_id, business_id, CASE WHEN lang IN ('en', 'fr', 'de') THEN lang ELSE 'unknown' END AS label,
           trim(coalesce(caption, ''), ' ') AS caption, length(trim(coalesce(caption, ''), ' ')) > 0 AS has_caption,
           cast(length(trim(coalesce(caption, ''), ' ')) AS int) AS caption_length
    FROM photos_raw""")
oracle("label_distribution", ("photos_tagged",), """
    SELECT label, count(*) AS photo_count FROM photos_tagged WHERE reject_reason IS NULL GROUP BY label""")
oracle("surrogate_and_change_hash", (), """
    SELECT o_orderkey, md5(concat_ws('-', o_custkey, strftime(o_orderdate, '%Y-%m-%d'))) AS order_key,
           sha256(concat_ws('|', o_orderstatus, coalesce(urgent, '<null>'), cents)) AS change_hash,
           sha256(concat_ws('|', o_orderstatus, urgent, cents)) AS plain_hash
    FROM (SELECT *, CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderstatus END AS urgent,
                 cast(round(o_totalprice * 100) AS bigint) AS cents FROM orders)""")

# ------------------------------------------------------------ aggregates and windows

oracle("nation_month_revenue_windows", (), f"""
    WITH per_supplier AS (
        SELECT l_suppkey, cast(date_trunc('month', l_shipdate) AS date) AS month, count(*) AS n,
               sum(cast(l_quantity AS bigint)) AS quantity, count(*) FILTER (WHERE l_returnflag = 'R') AS returned
        FROM lineitem GROUP BY ALL),
    monthly AS (
        SELECT s_nationkey, month, cast(sum(n) AS bigint) AS lines, cast(sum(quantity) AS bigint) AS quantity,
               cast(sum(returned) AS bigint) AS returned, {rnd('avg(n)', 2)} AS avg_lines_per_supplier
        FROM per_supplier JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)
    SELECT * EXCLUDE (roll), {rnd('roll', 2)} AS rolling_3m_avg,
           {rnd('100.0::double * (lines - prior_lines) / nullif(prior_lines, 0)', 1)} AS mom_pct,
           lines - prior_lines AS mom_delta
    FROM (SELECT *, {rnd('100.0::double * returned / lines', 1)} AS returned_pct,
                 lag(lines) OVER m AS prior_lines,
                 cast(sum(lines) OVER (m ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS bigint) AS rolling_3m_lines,
                 avg(lines) OVER (m ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS roll,
                 cast(sum(lines) OVER (m ROWS UNBOUNDED PRECEDING) AS bigint) AS cumulative_lines,
                 cast(rank() OVER (PARTITION BY month ORDER BY lines DESC) AS int) AS nation_rank
          FROM monthly WINDOW m AS (PARTITION BY s_nationkey ORDER BY month))""", dates=("month",), counts=("prior_lines", "mom_delta"))

oracle("rank_by_value_counts", (), """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, strftime(l_shipdate, '%Y-%m') AS month,
           rank() OVER (PARTITION BY strftime(l_shipdate, '%Y-%m') ORDER BY l_quantity DESC) AS quantity_rank
    FROM lineitem""")

# ------------------------------------------------------------ monitoring

_SIDES = {
    "business": ("(SELECT count(*) FROM business_snap)", "(SELECT count(*) FROM business WHERE is_current)",
                 "(SELECT count(*) FROM business_tagged WHERE reject_reason IS NOT NULL)"),
    "reviews": ("(SELECT count(*) FROM reviews_raw)", "(SELECT count(*) FROM reviews)",
                "(SELECT count(*) FROM reviews_tagged WHERE reject_reason IS NOT NULL)"),
    "tips": ("(SELECT count(*) FROM documents)", "(SELECT count(*) FROM tips)",
             "(SELECT count(*) FROM tips_tagged WHERE reject_reason IS NOT NULL)"),
    "photos": ("(SELECT count(*) FROM pages)", "(SELECT count(*) FROM photos_tagged WHERE reject_reason IS NULL)",
               "(SELECT count(*) FROM photos_tagged WHERE reject_reason IS NOT NULL)"),
    "checkins": ("(SELECT count(*) FROM checkin_rows)", "(SELECT count(*) FROM checkins)",
                 "(SELECT count(*) FROM checkin_rows) - (SELECT count(*) FROM checkins)"),
    "users": ("(SELECT count(*) FROM user_snap)", "(SELECT count(*) FROM users WHERE is_current)",
              "(SELECT count(*) FROM user_tagged WHERE reject_reason IS NOT NULL)"),
    "labels": ("(SELECT count(*) FROM labels)", "(SELECT count(*) FROM labels)", "0"),
    "regions": ("cast(NULL AS bigint)", "(SELECT count(*) FROM region)", "0"),
}
part("metrics", ("reviews", "business", "tips", "photos_tagged", "checkins"),
     "SELECT *, " + rnd("100.0::double * quarantine_count / greatest(bronze_row_count, 1)", 2)
     + " AS quarantine_rate_pct, 'run-1' AS pipeline_run_id FROM (" + " UNION ALL ".join(
         f"SELECT '{name}' AS source_name, {b} AS bronze_row_count, {s} AS silver_row_count, "
         f"cast({q} AS bigint) AS quarantine_count" for name, (b, s, q) in _SIDES.items()) + ")")
_METRICS = (
    "source_name, bronze_row_count, silver_row_count, quarantine_count, pipeline_run_id, "
    "CASE WHEN bronze_row_count IS NOT NULL THEN quarantine_rate_pct END AS quarantine_rate_pct"
)
oracle("ingestion_run_metrics", ("metrics",), f"SELECT {_METRICS} FROM metrics", counts=("bronze_row_count",))

oracle("quarantine_alert_sources", ("metrics",),
       f"SELECT * FROM (SELECT {_METRICS} FROM metrics) WHERE quarantine_rate_pct > 5.0", counts=("bronze_row_count",))

# ------------------------------------------------------------ checks

oracle("quality_not_null", ("fact_reviews",),
       "SELECT review_id, business_id, review_date FROM fact_reviews WHERE business_key IS NULL", dates=("review_date",))

oracle("quality_unique_violations", (), """
    SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
oracle("quality_accepted_values", (), """
    SELECT o_orderstatus, count(*) AS occurrences FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1""")
part("seeded_reviews", ("reviews",), """
    SELECT * FROM reviews UNION ALL SELECT * REPLACE (9 AS stars) FROM reviews WHERE stars = 1""")
part("dim_date", (), ORACLES["date_dimension"])
part("elite_years", ("user_tagged",), """
    SELECT DISTINCT a.user_id, cast(b.yr AS int) AS elite_year FROM user_tagged a
    JOIN user_tagged b ON a.user_id = b.user_id AND b.yr <= a.yr AND b.is_currently_elite
    WHERE a.reject_reason IS NULL""")
part("agg_monthly", (), ORACLES["flagship_business_monthly"])
part("agg_city", (), ORACLES["category_city_yearly"])
part("agg_cohort", (), ORACLES["customer_cohort_retention"])
part("fact_checkins", (), ORACLES["event_time_features"])
_TESTED = {
    "silver/business": "business", "silver/users": "users", "silver/reviews": "seeded_reviews",
    "silver/checkins": "checkins", "silver/tips": "tips", "silver/business_categories": "categories",
    "silver/user_elite_years": "elite_years", "gold/dim_business": "dim_business", "gold/dim_user": "dim_user",
    "gold/dim_date": "dim_date", "gold/fact_reviews": "fact_reviews", "gold/fact_checkins": "fact_checkins",
    "gold/fact_tips": "fact_tips", "gold/agg_business_monthly": "agg_monthly", "gold/agg_city_category": "agg_city",
    "gold/agg_user_cohort": "agg_cohort",
}


def _column_tests() -> str:
    """Every declared test, each as a query of its own."""
    found = []

    def add(table: str, test: str, column: str, count: str) -> None:
        found.append(
            f"SELECT * FROM (SELECT '{table}' AS table_name, '{test}' AS test, '{column}' AS column_name, "
            f"({count}) AS violations) WHERE violations > 0"
        )

    for table, part_name in _TESTED.items():
        for column in NOT_NULL.get(table, ()):
            if column != "change_hash":  # not formed in this SQL; a hash of non-NULL text
                add(table, "not_null", column, f"SELECT count(*) FROM {part_name} WHERE {column} IS NULL")
        for column in UNIQUE.get(table, ()):
            inner = f"SELECT {column} FROM {part_name} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
            add(table, "unique", column, f"SELECT count(*) FROM ({inner})")
        for column, values in ACCEPTED.get(table, {}).items():
            listed = ", ".join(repr(v) for v in values)
            add(table, "accepted_values", column, f"SELECT count(*) FROM {part_name} WHERE {column} NOT IN ({listed})")
    return " UNION ALL ".join(found)


oracle("quality_column_tests", tuple(_TESTED.values()), _column_tests())

part("doubled", ("business",), """
    SELECT business_id, valid_from, valid_to, is_current FROM business
    UNION ALL
    SELECT business_id, valid_from - INTERVAL 30 DAY, valid_from - INTERVAL 30 DAY, is_current
    FROM business WHERE is_current""")
oracle("quality_single_current", ("doubled",), """
    SELECT business_id, count(*) AS current_version_count, 'more than one current version' AS failure_reason
    FROM doubled WHERE is_current GROUP BY business_id HAVING count(*) > 1""")
oracle("quality_valid_window", ("doubled",), f"""
    SELECT business_id, {_VALIDITY}, 'version does not end after it begins' AS failure_reason
    FROM doubled WHERE valid_from >= valid_to""")
part("spanned", ("business",), """
    SELECT business_id, valid_from, valid_to, is_current FROM business
    UNION ALL SELECT business_id, TIMESTAMP '1900-01-01 00:00:00', valid_to, false FROM business WHERE is_current""")
oracle("quality_no_overlap", ("spanned",), f"""
    SELECT business_id, {_VALIDITY}, {ts('previous_valid_to')}, 'begins before an earlier version ends' AS failure_reason
    FROM (SELECT a.*, (SELECT max(b.valid_to) FROM spanned b
                       WHERE b.business_id = a.business_id
                         AND (b.valid_from < a.valid_from OR b.valid_from = a.valid_from AND b.valid_to < a.valid_to))
                 AS previous_valid_to
          FROM spanned a)
    WHERE previous_valid_to > from_column""".replace("from_column", "valid_from"))

# ------------------------------------------------------------ sources and sinks

oracle("bronze_json_roundtrip", ("reviews_tagged",), """
    SELECT CASE WHEN reject_reason IS NULL THEN 'clean' ELSE 'rejected' END AS side, count(*) AS rows,
           cast(sum(useful) AS bigint) AS useful, cast(sum(length(text)) AS bigint) AS chars FROM reviews_tagged GROUP BY 1""")
oracle("partitioned_clustered_roundtrip", (), """
    SELECT cast(year(l_shipdate) AS int) AS ship_year, l_suppkey, count(*) AS lines,
           cast(sum(cast(round(l_extendedprice * 100) AS bigint)) AS bigint) AS cents
    FROM lineitem GROUP BY ALL""")
oracle("staging_views", ("reviews", "business", "users", "tips", "checkins"), " UNION ALL ".join(
    f"SELECT 'stg_{name}' AS view_name, {key} AS row_key, strftime(cast({at} AS timestamp), '%Y-%m-%d %H:%M:%S') AS row_time, "
    f"cast({measure} AS double) AS measure FROM {name}"
    for name, key, at, measure in (
        ("business", "business_id", "valid_from", "review_count"), ("users", "user_id", "valid_from", "engagement_score"),
        ("reviews", "review_id", "review_date", "total_votes"), ("tips", "user_id", "tip_date", "text_char_len"),
        ("checkins", "business_id", "checkin_at", "ordinal"))))

oracle("json_business", ("business_snap",), f"SELECT {_BUSINESS} FROM business_snap", counts=_BUSINESS_COUNTS)
oracle("json_users", ("user_tagged",), """
    SELECT user_id, user_name, member_since, review_count, average_stars, fans, votes_useful_given, votes_funny_given,
           votes_cool_given, friend_count, total_compliments, total_elite_years, engagement_score
    FROM user_tagged""", dates=("member_since",))
oracle("json_checkins", ("checkin_rows",), "SELECT business_id, stamp, total, ordinal FROM checkin_rows")
oracle("json_tips", ("tips_tagged",), f"""
    SELECT business_id, user_id, date, cast(compliment_count AS double) AS compliment_count,
           cast(length(text) AS int) AS text_char_len, cast({_WORDS} AS int) AS text_word_count
    FROM tips_tagged""")
oracle("json_photos", ("photos_raw",), """
    SELECT photo_id, business_id, caption, ' ' || upper(lang) || ' ' AS label FROM photos_raw""")
oracle("log_grows_a_column", (), """
    SELECT run_id, o_orderstatus, row_count, CASE WHEN run_id = 'run-3' THEN total_cents END AS total_cents
    FROM (SELECT o_orderstatus, count(*) AS row_count,
                 cast(sum(cast(round(o_totalprice * 100) AS bigint)) AS double) AS total_cents
          FROM orders GROUP BY 1), (SELECT unnest(['run-1', 'run-2', 'run-3']) AS run_id)""")
part("halves", ("business_tagged",), """
    SELECT * EXCLUDE (rn), make_timestamp(last_year, 12, 31, 0, 0, 0.0) AS load_ts
    FROM (SELECT *, max(year(snapshot_ts)) OVER (PARTITION BY half) AS last_year,
                 row_number() OVER (PARTITION BY half, business_id ORDER BY snapshot_ts DESC) AS rn
          FROM (SELECT *, year(snapshot_ts) * 2 > min(year(snapshot_ts)) OVER () + max(year(snapshot_ts)) OVER () AS half
                FROM business_tagged WHERE reject_reason IS NULL))
    WHERE rn = 1""")
oracle("load_modes", ("halves",), f"""
    WITH early AS (SELECT * FROM halves WHERE NOT half), late AS (SELECT * FROM halves WHERE half),
    paired AS (
        SELECT e.business_id AS old_id, l.business_id AS new_id, e.stars AS old_stars, l.stars AS new_stars,
               e.review_count AS old_count, l.review_count AS new_count,
               row(e.stars, e.review_count, e.is_open, e.city, e.state, e.categories, e.price_range)
                 IS NOT DISTINCT FROM
               row(l.stars, l.review_count, l.is_open, l.city, l.state, l.categories, l.price_range) AS same
        FROM early e FULL JOIN late l ON e.business_id = l.business_id),
    loads AS (SELECT (SELECT max(load_ts) FROM early) AS t1, (SELECT max(load_ts) FROM late) AS t2, TIMESTAMP '9999-12-31 00:00:00' AS t3),
    versions AS (
        SELECT 1 AS load_number, business_id, stars, review_count, t1 AS valid_from, t3 AS valid_to, true AS is_current FROM early, loads
        UNION ALL SELECT 3, business_id, stars, review_count, t2, t3, true FROM late, loads
        UNION ALL SELECT 2, old_id, old_stars, old_count, t1, t3, true FROM paired, loads
                  WHERE old_id IS NOT NULL AND (new_id IS NULL OR same)
        UNION ALL SELECT 2, old_id, old_stars, old_count, t1, t2, false FROM paired, loads
                  WHERE old_id IS NOT NULL AND new_id IS NOT NULL AND NOT same
        UNION ALL SELECT 2, new_id, new_stars, new_count, t2, t3, true FROM paired, loads
                  WHERE new_id IS NOT NULL AND (old_id IS NULL OR NOT same))
    SELECT load_number, business_id, stars, review_count, {ts('valid_from')}, {ts('valid_to')}, is_current
    FROM versions""".replace("WITH early", "SELECT * FROM (WITH early", 1) + ")")
ORACLES["catalog_names"] = ORACLES["flagship_business_monthly"]
ORACLES["scd2_late_snapshots"] = ORACLES["scd2_supplier_history"]
ORACLES["compacted_history"] = ORACLES["scd2_supplier_history"]
oracle("as_of_join_many_versions", (), """
    SELECT l_orderkey, l_linenumber, l.o_orderpriority, strftime(l.ship_date, '%Y-%m-%d') AS ship_date,
           cast(orders_then AS double) AS orders_then, cast(cents_then AS double) AS cents_then
    FROM (SELECT l_orderkey, l_linenumber, o_orderpriority, cast(l_shipdate AS date) AS ship_date
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey) l
    ASOF LEFT JOIN (SELECT o_orderpriority, cast(o_orderdate AS date) AS day, count(*) AS orders_then,
                           sum(cast(round(o_totalprice * 100) AS bigint)) AS cents_then
                    FROM orders GROUP BY ALL) v
      ON l.o_orderpriority = v.o_orderpriority AND l.ship_date >= v.day""")
oracle("clustered_by_second_column", (), """
    SELECT l_suppkey, count(*) AS lines, cast(sum(cast(round(l_extendedprice * 100) AS bigint)) AS bigint) AS cents,
           strftime(min(l_shipdate), '%Y-%m-%d %H:%M:%S') AS first_day
    FROM lineitem WHERE l_shipdate >= '1995-04-01' AND l_shipdate < '1995-07-01' GROUP BY l_suppkey""")

part("drifting", ("reviews_raw",), """
    SELECT *, cast(split_part(review_id, '-', 2) AS int) AS number FROM reviews_raw""")
oracle("json_schema_drift", ("drifting",), """
    SELECT 'review' AS entity, 'boosts' AS field, count(*) AS row_count, 'BIGINT' AS type FROM drifting WHERE useful >= 8
    UNION ALL SELECT 'review', 'device', count(*), 'OBJECT<level: BIGINT, via: STRING>' FROM drifting WHERE number = 1
    UNION ALL SELECT 'review', 'grade', count(*), 'VARIANT' FROM drifting WHERE number IN (2, 3)""")
oracle("json_extra_fields", ("drifting",), """
    SELECT review_id, stars, CASE WHEN useful >= 8 THEN cast(useful * 10 AS double) END AS boosts,
           CASE WHEN number = 1 THEN cast(funny AS double) END AS device_level, CASE WHEN number = 1 THEN 'web' END AS device_via,
           CASE number WHEN 2 THEN 'two' WHEN 3 THEN '3' END AS grade
    FROM drifting WHERE useful >= 8 OR number IN (1, 2, 3)""")
oracle("yearly_distinct_from_monthly", (), """
    WITH facts AS (SELECT s_nationkey, cast(year(l_shipdate) AS int) AS year, o_custkey
                   FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey)
    SELECT s_nationkey, year, count(DISTINCT o_custkey) AS customers FROM facts GROUP BY ALL
    UNION ALL SELECT s_nationkey, 0, count(DISTINCT o_custkey) FROM facts GROUP BY ALL""")
_GRAPH = {
    "dim_business": (0, ("silver/business",)), "dim_user": (0, ("silver/users",)), "dim_date": (0, (None,)),
    "fact_reviews": (1, ("silver/reviews", "gold/dim_business", "gold/dim_user")),
    "fact_tips": (1, ("silver/tips", "gold/dim_business", "gold/dim_user")),
    "fact_checkins": (1, ("silver/checkins", "gold/dim_business")),
    "reviews_monthly": (2, ("gold/fact_reviews",)), "agg_business_monthly": (3, ("gold/reviews_monthly", "gold/fact_tips")),
    "agg_city_category": (2, ("gold/fact_reviews", "silver/business_categories")),
    "agg_user_cohort": (2, ("gold/fact_reviews", "gold/dim_user")),
}
# 19 years of days from 2004 on
_GRAPH_ROWS = {"dim_date": "date_diff('day', DATE '2004-01-01', DATE '2022-12-31') + 1", "agg_business_monthly": "count(*) FROM agg_monthly",
               "agg_city_category": "count(*) FROM agg_city", "agg_user_cohort": "count(*) FROM agg_cohort"}
oracle("model_graph", ("dim_business", "dim_user", "fact_reviews", "fact_tips", "fact_checkins", "reviews_monthly", "agg_monthly", "agg_city", "agg_cohort"),
       " UNION ALL ".join(
           f"SELECT 'gold/{model}' AS model, {'NULL' if needed is None else repr(needed)} AS input, {level} AS level, "
           f"cast((SELECT {_GRAPH_ROWS.get(model, f'count(*) FROM {model}')}) AS bigint) AS model_rows"
           for model, (level, inputs) in _GRAPH.items() for needed in inputs))
oracle("explode_wide_events", (), """
    SELECT cast(user_id AS varchar) AS user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp,
           cast(count(*) OVER (PARTITION BY user_id) AS int) AS total,
           cast(row_number() OVER (PARTITION BY user_id ORDER BY strftime(ts, '%Y-%m-%d %H:%M:%S')) - 1 AS int) AS ordinal
    FROM events""")
ORACLES["incremental_business_monthly"] = ORACLES["flagship_business_monthly"]
oracle("pit_join_by_buckets", ("valid_business",), f"""
    SELECT p.*, b IS NOT NULL AS known FROM ({ORACLES["pit_join_lineitem_supplier"]}) p LEFT JOIN valid_business ON business_id = b""")
ORACLES["as_of_join_two_dims"] = ORACLES["pit_join_two_dims"]

"""The whole load: bronze files to silver and gold tables, metrics and checks.

Steps run in dependency order: the versioned dimensions first, then the event
tables that are validated against them, then staging, gold and checks. Every
step reads tables the previous one has written to the shared base folder, so a
lost executor costs the tasks it ran, never an earlier step.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import current_keys, fk_flag_by_missing, missing_keys, point_in_time_join
from ..operators.quality import REASON, split_unparseable, tag_rejects
from ..operators.scd import HISTORY_FLOOR, first_versions, refuse_late_load, scd2_changes, splice_late
from ..session import configure
from ..sources.bronze import CORRUPT, bronze_path, read_bronze
from ..sources.tables import (
    Tally,
    append_log,
    append_quarantine,
    path_exists,
    read_quarantine,
    read_table,
    table_exists,
    upsert_partitions,
    write_table,
    write_versions,
)
from . import aggregates, checks, dimensions, facts, silver, staging
from .monitoring import SourceFrames, ingestion_metrics, quarantine_alerts

# --- fixed values: physical layout of the tables ---
PARTITIONS = {
    "silver/business": ("state",),
    "silver/reviews": ("review_year", "review_month"),
    "silver/checkins": ("checkin_year", "checkin_month"),
    "silver/tips": ("tip_year", "tip_month"),
    "silver/photos": ("label",),
    "gold/fact_reviews": ("review_year",),
    "gold/fact_checkins": ("checkin_year",),
    "gold/fact_tips": ("tip_year",),
    "gold/reviews_monthly": ("review_year",),
    "gold/agg_business_monthly": ("review_year",),
}
CLUSTERS = {
    "silver/business": ("city", "stars"),
    "silver/users": ("user_tier", "review_count"),
    "silver/reviews": ("business_id", "review_date"),
    "silver/checkins": ("business_id", "checkin_at"),
    "gold/dim_date": ("calendar_date",),
    "gold/agg_city_category": ("review_year", "city"),
    "gold/agg_user_cohort": ("cohort_year", "years_since_joining"),
}
# Metrics name -> (bronze entity, silver table, counts current versions only)
SOURCES = {
    "business": ("business", "silver/business", True),
    "reviews": ("review", "silver/reviews", False),
    "users": ("user", "silver/users", True),
    "checkins": ("checkin", "silver/checkins", False),
    "tips": ("tip", "silver/tips", False),
    "photos": ("photo", "silver/photos", False),
}


def rows() -> Column:
    return F.count(F.lit(1))


class Catalog:
    """Table name -> frame, read from the base folder once built.

    ``define`` registers how a model is computed from other names; ``table``
    returns the written table if there is one and the computed frame otherwise,
    so a model can be queried with its inputs resolved by name. Names a model asks for are remembered: they give
    the order models are built in, and what a changed table makes stale.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base
        #: silver table -> counts taken while it was written: ``bronze``, ``silver``, ``quarantine``
        self.counts: dict[str, dict[str, Tally]] = {}
        self._models: dict[str, Callable[[Catalog], DataFrame]] = {}
        self._inputs: dict[str, list[str]] = {}
        self._open: list[str] = []

    def define(self, name: str, build: Callable[[Catalog], DataFrame]) -> None:
        self._models[name] = build
        self._inputs.pop(name, None)

    def exists(self, name: str) -> bool:
        return table_exists(self.spark, self.base, name)

    def table(self, name: str) -> DataFrame:
        if self._open:
            self._inputs[self._open[-1]].append(name)
        if self.exists(name) or name not in self._models:
            return read_table(self.spark, self.base, name)
        return self._compute(name)

    def _compute(self, name: str) -> DataFrame:
        """The model's frame; names it asks for meanwhile are its inputs."""
        if name in self._open:
            raise ValueError(f"models need each other: {' -> '.join([*self._open[self._open.index(name):], name])}")
        self._inputs[name] = []
        self._open.append(name)
        try:
            return self._models[name](self)
        finally:
            self._open.pop()

    def inputs(self) -> dict[str, list[str]]:
        """Model -> the names it asks for, distinct, as seen when its frame was made; none is written or run for it.

        What no model defines must exist as a table.
        """
        for name in self._models:
            if name not in self._inputs:
                self._compute(name)
        return {name: list(dict.fromkeys(self._inputs[name])) for name in self._models}

    def levels(self) -> dict[str, int]:
        """Model -> the longest chain of models below it; models of a level do not need each other."""
        inputs, found = self.inputs(), {}

        def level(name: str, above: tuple[str, ...] = ()) -> int:
            if name in above:
                raise ValueError(f"models need each other: {' -> '.join([*above[above.index(name):], name])}")
            if name not in found:
                found[name] = max((level(n, (*above, name)) + 1 for n in inputs[name] if n in inputs), default=0)
            return found[name]

        return {name: level(name) for name in inputs}

    def order(self) -> list[str]:
        """Models so that each comes after those it needs."""
        levels = self.levels()
        return sorted(levels, key=lambda name: levels[name])

    def downstream(self, name: str) -> list[str]:
        """Models that need ``name``, directly or not, in order."""
        inputs, touched = self.inputs(), {name}
        for model in self.order():
            if touched & set(inputs[model]):
                touched.add(model)
        return [model for model in self.order() if model in touched - {name}]

    def rebuild(self, name: str) -> list[str]:
        """Build what is downstream of a table that has changed; the models built."""
        models = self.downstream(name)
        for model in models:
            self.build(model)
        return models

    def save(self, name: str, df: DataFrame) -> DataFrame:
        """Materialise under the table's declared layout."""
        tally = self._tally(name, "silver", rows())
        return write_table(df, self.base, name, PARTITIONS.get(name, ()), CLUSTERS.get(name, ()), curve=True, tally=tally)

    def save_versions(self, name: str, changes: DataFrame, keep_history: bool = True) -> DataFrame:
        """S12 for a type-2 table: its closed versions stay where they are."""
        tally = self._tally(name, "silver", F.count_if("is_current"))
        return write_versions(
            changes, self.base, name, PARTITIONS.get(name, ()), CLUSTERS.get(name, ()), keep_history, True, tally
        )

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """Columnar copy of parsed rows, so several readers share one parse."""
        tally = self._tally(f"silver/{name}", "bronze", rows())
        return write_table(df, self.base, f"staging/{name}", tally=tally)

    def quarantine(self, entity: str, rejected: DataFrame, run_id: str) -> None:
        append_quarantine(rejected, self.base, entity, run_id, self._tally(f"silver/{entity}", "quarantine", rows()))

    def _tally(self, name: str, side: str, count: Column) -> Tally:
        taken = Tally(count=count)
        self.counts.setdefault(name, {})[side] = taken
        return taken

    def build(self, name: str) -> DataFrame:
        return self.save(name, self._compute(name))


def define_gold(
    catalog: Catalog,
    load_ts: str | None = None,
    calendar: tuple[str, str] = ("2004-01-01", "2022-12-31"),
    hot_share: float | None = None,
    join: facts.Join = point_in_time_join,
) -> None:
    """M1–M9 as models over the silver tables. ``hot_share``, ``join``: see ``plans.facts``."""
    gold = {
        "gold/dim_business": lambda c: dimensions.dim_business(staging.stg_business(c.table("silver/business"))),
        "gold/dim_user": lambda c: dimensions.dim_user(staging.stg_users(c.table("silver/users"))),
        "gold/dim_date": lambda c: dimensions.dim_date(c.spark, *calendar),
        "gold/fact_reviews": lambda c: facts.fact_reviews(
            staging.stg_reviews(c.table("silver/reviews")), c.table("gold/dim_business"), c.table("gold/dim_user"),
            load_ts, hot_share, join,
        ),
        "gold/fact_tips": lambda c: facts.fact_tips(
            staging.stg_tips(c.table("silver/tips")), c.table("gold/dim_business"), c.table("gold/dim_user"),
            load_ts, hot_share, join,
        ),
        "gold/fact_checkins": lambda c: facts.fact_checkins(
            staging.stg_checkins(c.table("silver/checkins")), c.table("gold/dim_business"), load_ts, hot_share, join
        ),
        "gold/reviews_monthly": lambda c: aggregates.reviews_monthly(c.table("gold/fact_reviews")),
        "gold/agg_business_monthly": lambda c: aggregates.monthly_trends(
            c.table("gold/reviews_monthly"), aggregates.tips_monthly(c.table("gold/fact_tips")), load_ts=load_ts
        ),
        "gold/agg_city_category": lambda c: aggregates.agg_city_category(
            c.table("gold/fact_reviews"), c.table("silver/business_categories"), load_ts=load_ts
        ),
        "gold/agg_user_cohort": lambda c: aggregates.agg_user_cohort(
            c.table("gold/fact_reviews"), c.table("gold/dim_user"), load_ts
        ),
    }
    for name, build in gold.items():
        catalog.define(name, build)


@dataclass
class RunResult:
    """Frames a run leaves to its caller; all are scans or small aggregates."""

    catalog: Catalog
    metrics: DataFrame
    alerts: DataFrame
    failed_tests: DataFrame
    tables: dict[str, DataFrame] = field(default_factory=dict)


def quarantine_rejects(
    catalog: Catalog, entity: str, tagged: DataFrame, run_id: str, bronze: DataFrame | None = None
) -> DataFrame:
    """Append the rejects of a stored, tagged frame and return its clean rows.

    ``bronze``: where the texts of rejects are fetched, if the stored frame is without them. The rejects are stored
    first: where they are few, the planner knows it, and the source's texts are met where they are read, not shuffled.
    """
    rejected = tagged.filter(F.col(REASON).isNotNull())
    if bronze is not None:
        rejected = silver.with_text(bronze, write_table(rejected, catalog.base, f"staging/{entity}_rejects"))
    catalog.quarantine(entity, rejected, run_id)
    return tagged.filter(F.col(REASON).isNull()).drop(REASON)


def flag_by_stored_keys(
    base: str, entity: str, rows: DataFrame, lookups: dict[str, tuple[str, DataFrame]]
) -> DataFrame:
    """J1 for a stored frame, by way of stored lists of the keys that are missing.

    ``lookups`` maps a key column to the flag to add and the versioned table to look in.
    """
    for key, (flag, dimension) in lookups.items():
        missing = missing_keys(rows, key, current_keys(dimension, key))
        stored = write_table(missing, base, f"staging/{entity}_missing_{key}")
        rows = fk_flag_by_missing(rows, key, stored, flag)
    return rows


def store_reviews(
    parsed: DataFrame,
    base: str,
    business: DataFrame,
    users: DataFrame,
    load_ts: str,
    run_id: str,
    merging: bool = True,
    catalog: Catalog | None = None,
) -> None:
    """B3 with its tables: stage, flag, quarantine, then upsert or rebuild. Safe to repeat."""
    name = "silver/reviews"
    catalog = catalog or Catalog(parsed.sparkSession, base)
    rows = catalog.stage("reviews", silver.metrics_only(parsed))
    lookups = {"business_id": ("biz_valid", business), "user_id": ("usr_valid", users)}
    rules = silver.corrupt_rule(parsed) + silver.review_rules()
    tagged = tag_rejects(flag_by_stored_keys(base, "reviews", rows, lookups), rules)
    reviews = silver.finish_reviews(quarantine_rejects(catalog, "reviews", tagged, run_id, parsed), load_ts)
    if merging and catalog.exists(name):
        # The upsert reads its input several times, so it gets a written one.
        updates = write_table(reviews, base, "staging/reviews_updates")
        upsert_partitions(updates, base, name, "review_id", PARTITIONS[name], CLUSTERS[name])
    else:
        catalog.save(name, reviews)


def save_snapshot(
    catalog: Catalog,
    name: str,
    key: str,
    snapshot: DataFrame,
    load_ts: str,
    merging: bool,
    first_from: str | None,
    late: str,
) -> DataFrame:
    """B1, B2 with their tables: merge, rebuild, or splice in a load that arrives late.

    ``late="splice"`` keeps each load's rows under ``seen/``, one folder a load, since a version does not tell when
    its key was last seen. A spliced load rewrites the table.
    """
    spark, seen = catalog.spark, f"{catalog.base}/seen/{name}"
    known = catalog.table(name) if merging and catalog.exists(name) else None
    if late == "splice":
        if known is not None and not path_exists(spark, seen):
            raise ValueError(f"{name} was begun without late='splice', so its sightings are not known")
        rows = snapshot.withColumn("seen_at", F.lit(load_ts).cast("timestamp"))
        mode = "static" if known is None else "dynamic"  # a new table forgets old loads, a repeated load replaces its own
        dated = rows.withColumn("load", F.lit(load_ts))
        dated.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("load").parquet(seen)
        sightings = spark.read.schema(rows.schema).parquet(seen)
        newer = sightings.filter(F.col("seen_at") > F.lit(load_ts).cast("timestamp"))
        if known is not None and not newer.isEmpty():
            table = splice_late(known, snapshot, sightings, key, load_ts, first_from=first_from)
            return catalog.save_versions(name, table, keep_history=False)
    if known is not None:
        refuse_late_load(known, load_ts)
    changes = first_versions(snapshot, load_ts, first_from) if known is None else scd2_changes(known, snapshot, key, load_ts, first_from)
    return catalog.save_versions(name, changes, merging)


def run_silver(
    spark: SparkSession,
    bronze: str,
    base: str,
    load_ts: str,
    run_id: str,
    snapshot_year: int,
    load_mode: str = "merge",
    rename: dict[str, dict[str, str]] | None = None,
    first_from: str | None = HISTORY_FLOOR,
    late: str = "refuse",
) -> Catalog:
    """B1–B6. ``load_mode="merge"`` versions and upserts, ``"full"`` rebuilds without history.

    ``late``: whether a load older than the newest is refused or spliced into the history (see :func:`save_snapshot`).
    """
    if load_mode not in ("merge", "full") or late not in ("refuse", "splice"):
        raise ValueError("load_mode is 'merge' or 'full', late is 'refuse' or 'splice'")
    catalog = Catalog(spark, base)
    merging = load_mode == "merge"

    def read(entity: str) -> DataFrame:
        return read_bronze(spark, bronze, entity, (rename or {}).get(entity), keep_corrupt=True)

    clean = quarantine_rejects(catalog, "business", catalog.stage("business", silver.tag_business(read("business"))), run_id)
    snapshot = silver.business_snapshot(clean, load_ts)
    business = save_snapshot(catalog, "silver/business", "business_id", snapshot, load_ts, merging, first_from, late)
    catalog.save("silver/business_categories", silver.business_categories(clean).distinct())

    clean = quarantine_rejects(catalog, "users", catalog.stage("users", silver.tag_users(read("user"), snapshot_year)), run_id)
    snapshot = silver.user_snapshot(clean, load_ts)
    users = save_snapshot(catalog, "silver/users", "user_id", snapshot, load_ts, merging, first_from, late)
    catalog.save("silver/user_elite_years", silver.user_elite_years(clean).distinct())

    store_reviews(read("review"), base, business, users, load_ts, run_id, merging, catalog)

    packed = Tally(events=F.sum(F.size(silver.split_items("date"))))
    lines = write_table(read("checkin"), base, "staging/checkin_lines", tally=packed)
    # a line that is no JSON is one row without a stamp, and so one of the rejects
    corrupt = lines.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)
    exploded = silver.expand_checkins(lines)
    both = exploded.unionByName(corrupt, allowMissingColumns=True)
    found = Tally(events=F.count_if(F.col(CORRUPT).isNull()), count=rows())
    events = write_table(both, base, "staging/checkins", tally=found)
    catalog.counts.setdefault("silver/checkins", {})["bronze"] = found
    checks.explode_matches(packed["events"], found["events"])
    parsed, rejected = split_unparseable(events, "checkin_ts_raw", "checkin_at")
    catalog.quarantine("checkins", rejected, run_id)
    catalog.save("silver/checkins", silver.finish_checkins(parsed.drop(CORRUPT), load_ts))

    tips = read("tip")
    staged = catalog.stage("tips", silver.metrics_only(tips))
    lookups = {"business_id": ("biz_valid", business), "user_id": ("usr_valid", users)}
    rules = silver.corrupt_rule(tips) + silver.tip_rules()
    tagged = tag_rejects(flag_by_stored_keys(base, "tips", staged, lookups), rules)
    clean = quarantine_rejects(catalog, "tips", tagged, run_id, tips)
    catalog.save("silver/tips", silver.finish_tips(clean, load_ts))

    staged = catalog.stage("photos", silver.clean_labels(read("photo")))
    lookups = {"business_id": ("biz_valid", business)}
    rules = silver.corrupt_rule(staged) + silver.photo_rules()
    tagged = tag_rejects(flag_by_stored_keys(base, "photos", staged, lookups), rules)
    clean = quarantine_rejects(catalog, "photos", tagged, run_id)
    catalog.save("silver/photos", silver.finish_photos(clean, load_ts))
    return catalog


def run_metrics(catalog: Catalog, bronze: str, run_id: str, run_timestamp: str) -> DataFrame:
    """B7 over the tables of a run.

    Counts come from the writes of the run's own catalog. What it has not written is counted: an upserted table, whose rows
    were there before, by its files' footers, and a source of another run by the copy that was staged
    (one row per source row, per event for check-ins, as for their rejects), or by the source file.
    """
    spark, base = catalog.spark, catalog.base
    found = {}
    for source, (entity, table, current) in SOURCES.items():
        taken = {side: tally["count"] for side, tally in catalog.counts.get(table, {}).items()}
        loaded = catalog.table(table) if "silver" not in taken and catalog.exists(table) else None
        raw = None
        if "bronze" not in taken and catalog.exists(f"staging/{source}"):
            raw = catalog.table(f"staging/{source}")
        elif "bronze" not in taken and path_exists(spark, bronze_path(bronze, entity)):
            raw = read_bronze(spark, bronze, entity)
            raw = silver.expand_checkins(raw) if source == "checkins" else raw
        has_rejects = "quarantine" not in taken and path_exists(spark, f"{base}/rejected/{source}/run_id={run_id}")
        found[source] = SourceFrames(
            bronze=taken.get("bronze", raw),
            silver=taken.get("silver", loaded.filter(F.col("is_current")) if current and loaded is not None else loaded),
            quarantine=taken.get("quarantine", read_quarantine(spark, base, source, run_id) if has_rejects else None),
        )
    return ingestion_metrics(spark, found, run_id, run_timestamp)


def run_pipeline(
    spark: SparkSession,
    bronze: str,
    base: str,
    load_ts: str,
    run_id: str,
    snapshot_year: int,
    load_mode: str = "merge",
    rename: dict[str, dict[str, str]] | None = None,
    first_from: str | None = HISTORY_FLOOR,
    hot_share: float | None = None,
    late: str = "refuse",
) -> RunResult:
    """B1–B7, M1–M9 and all checks, in dependency order. One run at a time per base folder."""
    configure(spark)
    catalog = run_silver(spark, bronze, base, load_ts, run_id, snapshot_year, load_mode, rename, first_from, late)
    define_gold(catalog, load_ts, hot_share=hot_share)
    gold = catalog.order()
    for name in gold:
        catalog.build(name)
    append_log(run_metrics(catalog, bronze, run_id, load_ts), base, run_id)
    metrics = spark.read.parquet(f"{base}/pipeline_run_log/run={run_id}")
    silver_names = [table for _, table, _ in SOURCES.values()]
    silver_names += ["silver/business_categories", "silver/user_elite_years"]
    tables = {name: catalog.table(name) for name in [*silver_names, *gold]}
    rejected = read_quarantine(spark, base, "checkins", run_id)
    failed = checks.run_column_tests(tables).unionByName(checks.run_table_tests(tables, rejected))
    return RunResult(catalog, metrics, quarantine_alerts(metrics), failed, tables)

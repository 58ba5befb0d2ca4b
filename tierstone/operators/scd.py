"""Deduplication, upsert and type-2 versioning as plain DataFrame functions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import change_hash

# --- fixed values: open end of a validity interval, default start of a first version ---
OPEN_END = "9999-12-31 00:00:00"
HISTORY_FLOOR = "1900-01-01 00:00:00"

VALIDITY = ("valid_from", "valid_to", "is_current")


def as_timestamp(value: str | datetime | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp")


def current_only(df: DataFrame) -> DataFrame:
    """S3: current versions; the filter reaches the parquet scan."""
    return df.filter(F.col("is_current"))


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key in ``order``, which must be a total order.

    The rank filter is applied per map task before the shuffle as well, so a key
    repeated in a third of the rows sends one row per task, not all of them.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") == 1).drop("_rn")


def upsert(target: DataFrame, updates: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``updates`` replace the target rows with the same key; new keys are added.

    ``updates`` must be unique on ``key``. Columns present on one side only are
    NULL on the other.
    """
    keys = [key] if isinstance(key, str) else list(key)
    kept = target.join(updates.select(*keys), keys, "left_anti")
    return kept.unionByName(updates, allowMissingColumns=True)


def first_versions(
    snapshot: DataFrame, load_ts: str | datetime | Column, first_from: str | None = HISTORY_FLOOR
) -> DataFrame:
    """First load: every row opens a current version.

    It opens at ``first_from`` rather than at load time, so events older than
    the first load still find a version; ``None`` opens at ``load_ts``.
    """
    return snapshot.select(
        "*",
        as_timestamp(load_ts if first_from is None else first_from).alias("valid_from"),
        as_timestamp(OPEN_END).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def scd2_merge(
    target: DataFrame,
    snapshot: DataFrame,
    key: str,
    load_ts: str | datetime | Column,
    first_from: str | None = HISTORY_FLOOR,
) -> DataFrame:
    """Merge a snapshot into a versioned table; returns the new table content.

    The closed versions of ``target`` and :func:`scd2_changes`.
    """
    history = target.filter(~F.col("is_current"))
    return history.unionByName(scd2_changes(target, snapshot, key, load_ts, first_from), allowMissingColumns=True)


def scd2_changes(
    target: DataFrame,
    snapshot: DataFrame,
    key: str,
    load_ts: str | datetime | Column,
    first_from: str | None = HISTORY_FLOOR,
) -> DataFrame:
    """All current versions after merging a snapshot, and the versions it closes.

    * key unknown so far: a new current version is opened,
    * ``change_hash`` differs: the current version is closed at ``load_ts`` and a
      new one opens at the same instant (no gap, no overlap),
    * hash equal, or key absent from the snapshot: the version stays as it is.

    Merging the same snapshot again changes nothing. ``snapshot`` must be unique
    on ``key``. Only current versions are joined, once: each key pair yields an
    array of the one or two versions it leaves behind. A snapshot merged again
    under the ``load_ts`` of an existing version replaces that version. ``load_ts`` must
    not lie before a current ``valid_from`` (see :func:`refuse_late_load`).
    """
    load_at = as_timestamp(load_ts)
    first_at = load_at if first_from is None else as_timestamp(first_from)
    current = current_only(target)

    fields = list(target.columns) + [c for c in snapshot.columns if c not in target.columns]
    types = {**{f.name: f.dataType for f in snapshot.schema}, **{f.name: f.dataType for f in target.schema}}

    def version(side: DataFrame, alias: str, **overrides: Column) -> Column:
        values = []
        for name in fields:
            if name in overrides:
                value = overrides[name]
            elif name in side.columns:
                value = F.col(f"{alias}.{name}")
            else:
                value = F.lit(None)
            values.append(value.cast(types[name]).alias(name))
        return F.struct(*values)

    known, seen = F.col(f"c.{key}").isNotNull(), F.col(f"s.{key}").isNotNull()
    changed = known & seen & ~F.col("c.change_hash").eqNullSafe(F.col("s.change_hash"))
    same_load = changed & (F.col("c.valid_from") == load_at)
    closed = version(current, "c", valid_to=load_at, is_current=F.lit(False))
    opened = version(
        snapshot,
        "s",
        valid_from=F.when(known, load_at).otherwise(first_at),
        valid_to=as_timestamp(OPEN_END),
        is_current=F.lit(True),
    )
    left_behind = F.array(
        F.when(known & ~changed, version(current, "c")).when(changed & ~same_load, closed),
        F.when(changed | ~known, opened),
    )
    return (
        current.alias("c")
        .join(snapshot.alias("s"), F.col(f"c.{key}") == F.col(f"s.{key}"), "full_outer")
        .select(F.explode(F.filter(left_behind, lambda v: v.isNotNull())).alias("v"))
        .select("v.*")
    )


def refuse_late_load(target: DataFrame, load_ts: str | datetime) -> None:
    """Raise if a current version began after ``load_ts``: it would be closed before it began."""
    newest = current_only(target).agg(F.max("valid_from").alias("newest"))
    late = newest.filter(F.col("newest") > as_timestamp(load_ts)).first()  # one row at most
    if late:
        raise ValueError(f"load of {load_ts} is older than a version of {late.newest}")


def splice_late(
    versions: DataFrame,
    snapshot: DataFrame,
    seen: DataFrame,
    key: str,
    load_ts: str | datetime | Column,
    seen_at: str = "seen_at",
    first_from: str | None = HISTORY_FLOOR,
) -> DataFrame:
    """J9/J10 out of order: the table as if ``snapshot`` had been loaded in its turn.

    ``versions`` is a whole type-2 table, ``snapshot`` the late one (unique on ``key``, with ``change_hash``), ``seen`` the rows
    of all other snapshots loaded so far with their times in ``seen_at``: a version alone does not tell when its
    key was next seen, and that is where the late version ends. For each key of the snapshot:

    * the version open at the late time has the same hash: it stays (before the first sighting its
      row is the late one, from which it opens now),
    * else it is closed there, the late row holds until the key's next sighting, and from there on the old version goes on
      with the row of that sighting,
    * if that sighting opened a version with the late hash, the late version takes its place,
    * a key not known by then opens at the late time, or at ``first_from`` if no sighting came before.

    One join of the snapshot's keys with their versions, and one with their sightings after the late time. Rows of other keys and
    other versions pass through. Loading the same late snapshot again changes nothing.
    """
    at = as_timestamp(load_ts)
    names, types = versions.columns, {f.name: f.dataType for f in versions.schema}
    content = [c for c in names if c not in VALIDITY]

    def row_of(df: DataFrame) -> Column:
        return F.struct(*[(F.col(c) if c in df.columns else F.lit(None)).cast(types[c]).alias(c) for c in content])

    late = snapshot.select(F.col(key).alias("_key"), row_of(snapshot).alias("_late"))
    after = F.col(seen_at) > at
    sightings = seen.filter(F.col(seen_at) != at).select(F.col(key).alias("_key"), F.col(seen_at).alias("_seen"), after.alias("_after"), row_of(seen).alias("_row"))
    sightings = sightings.join(late.select("_key"), "_key", "left_semi").groupBy("_key").agg(
        F.min_by(F.when(F.col("_after"), F.struct("_seen", "_row")), F.when(F.col("_after"), F.col("_seen"))).alias("_next"),
        F.coalesce(F.bool_or(~F.col("_after")), F.lit(False)).alias("_earlier"),
    )
    each = F.struct(*[F.col(c) for c in names])
    begins, ends = F.col("valid_from"), F.col("valid_to")
    touched = versions.join(late.select(F.col("_key").alias(key)), key, "left_semi").groupBy(F.col(key).alias("_key")).agg(
        F.max_by(F.when((begins <= at) & (ends > at), each), F.when((begins <= at) & (ends > at), begins)).alias("_open"),
        F.min_by(F.when(begins > at, each), F.when(begins > at, begins)).alias("_then"),
    )
    met = late.join(touched, "_key", "left").join(sightings, "_key", "left")
    met = met.withColumn("_first", ~F.coalesce("_earlier", F.lit(False)))
    start = at if first_from is None else F.when(F.col("_first"), as_timestamp(first_from)).otherwise(at)
    now, then = F.col("_open"), F.col("_then")
    same_now = F.col("_late.change_hash").eqNullSafe(now["change_hash"])
    same_then = F.col("_late.change_hash").eqNullSafe(then["change_hash"])
    following = F.col("_next._seen")

    def version(row: Column, begin: Column, end: Column, current: Column) -> Column:
        given = {"valid_from": begin, "valid_to": end, "is_current": current}
        return F.struct(*[given.get(c, row[c]).cast(types[c]).alias(c) for c in names])

    open_end, no, yes = as_timestamp(OPEN_END), F.lit(False), F.lit(True)
    row, next_row = F.col("_late"), F.col("_next._row")
    known = now.isNotNull()
    # the version that was open is the first one, and it was first seen only after the late time
    unseen = known & F.col("_first") & following.isNotNull()
    takes_over = then.isNotNull() & (following == then["valid_from"]) & same_then
    late_end = F.when(following.isNull(), F.when(known, now["valid_to"]).otherwise(open_end)).when(takes_over, then["valid_to"]).otherwise(following)
    late_current = F.when(following.isNull(), F.when(known, now["is_current"]).otherwise(yes)).when(takes_over, then["is_current"]).otherwise(no)
    goes_on = known & following.isNotNull() & (following < now["valid_to"])
    unchanged = known & same_now & ~unseen
    made = F.filter(
        F.array(
            F.when(unchanged, now),
            F.when(known & same_now & unseen, version(row, now["valid_from"], now["valid_to"], now["is_current"])),
            F.when(known & ~same_now & ~unseen & (now["valid_from"] < at), version(now, now["valid_from"], at, no)),
            F.when(~(known & same_now), version(row, start, late_end, late_current)),
            F.when(known & ~same_now & goes_on, version(next_row, following, now["valid_to"], now["is_current"])),
            F.when(then.isNotNull() & ~((~(known & same_now)) & takes_over), then),
        ),
        lambda v: v.isNotNull(),
    )
    # the open and the following version of the snapshot's keys are replaced by what is made of them
    marks = touched.select(F.col("_key").alias("_touched"), F.explode(F.filter(F.array("_open.valid_from", "_then.valid_from"), lambda v: v.isNotNull())).alias("_begin"))
    rest = versions.join(marks, (F.col(key) == F.col("_touched")) & (begins == F.col("_begin")), "left_anti")
    return rest.unionByName(met.select(F.explode(made).alias("v")).select("v.*"))


def scd2_from_snapshots(
    snapshots: DataFrame,
    key: str,
    tracked: Sequence[str],
    ts: str,
    first_from: str | None = HISTORY_FLOOR,
    null_token: str | None = "<null>",
) -> DataFrame:
    """Versions out of many snapshots at once; equals folding :func:`scd2_merge` over them.

    One shuffle by key; a key has at most one row per snapshot, so no window
    partition grows with the data. ``ts`` is the snapshot time column.
    """
    by_time = Window.partitionBy(key).orderBy(ts)
    hashed = snapshots.withColumn("change_hash", change_hash(*tracked, null_token=null_token))
    starts = hashed.withColumn("_previous", F.lag("change_hash").over(by_time)).filter(
        F.col("_previous").isNull() | (F.col("_previous") != F.col("change_hash"))
    )
    opens = F.col(ts).cast("timestamp")
    if first_from is not None:
        opens = F.when(F.col("_previous").isNull(), as_timestamp(first_from)).otherwise(opens)
    following = F.lead(F.col(ts).cast("timestamp")).over(by_time)
    return (
        starts.withColumn("valid_from", opens)
        .withColumn("_next", following)
        .withColumn("valid_to", F.coalesce("_next", as_timestamp(OPEN_END)))
        .withColumn("is_current", F.col("_next").isNull())
        .drop("_previous", "_next", ts)
    )

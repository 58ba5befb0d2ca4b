"""Foreign-key flags, point-in-time joins and orphan detection.

No join here carries a broadcast hint on table data: the planner broadcasts a
side when its measured size is under the session's threshold and shuffles both
sides otherwise, splitting hot partitions at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType

from ..functions.expressions import valid_at
from .scd import current_only
from .skew import SALT, split_hot_keys


def current_keys(dimension: DataFrame, key: str) -> DataFrame:
    """Distinct keys of the current versions."""
    return current_only(dimension).select(key).distinct()


def fk_flag(
    df: DataFrame,
    key: str,
    valid_keys: DataFrame,
    flag: str,
    hot_share: float | None = None,
    hot_parts: int = 16,
) -> DataFrame:
    """Boolean ``flag``, true where ``key`` occurs in the one-column ``valid_keys``.

    ``valid_keys`` must be distinct (see :func:`current_keys`), so no row is
    multiplied. The adaptive planner splits hot keys only where both sides are
    shuffled directly, not where one is the output of an aggregation: hand in a
    written table of keys, or set ``hot_share`` to split keys that hold at least
    that share of the rows, whatever the planner does.
    """
    probe = valid_keys.select(F.col(valid_keys.columns[0]).alias("_probe"))
    on = F.col(key) == F.col("_probe")
    if hot_share is not None:
        df, probe = split_hot_keys(df, probe, key, "_probe", hot_share, hot_parts)
        probe = probe.withColumnRenamed(SALT, "_probe_salt")
        on = on & (F.col(SALT) == F.col("_probe_salt"))
    return (
        df.join(probe, on, "left")
        .withColumn(flag, F.col("_probe").isNotNull())
        .drop("_probe", SALT, "_probe_salt")
    )


def missing_keys(df: DataFrame, key: str, valid_keys: DataFrame) -> DataFrame:
    """Distinct non-NULL keys of ``df`` that are not among the one-column ``valid_keys``.

    Only the key column is read, and repeated keys are combined on the map side
    before anything is shuffled. Written as a table, the result is the input of
    :func:`fk_flag_by_missing`.
    """
    name = valid_keys.columns[0]
    found = df.select(F.col(key).alias(name)).filter(F.col(name).isNotNull()).distinct()
    return found.join(valid_keys, name, "left_anti")


def fk_flag_by_missing(df: DataFrame, key: str, missing: DataFrame, flag: str) -> DataFrame:
    """J1 against the keys known to be missing instead of all valid ones; same flags as :func:`fk_flag`.

    Orphans are few where keys are sound, so the stored key list has a file size
    under the session's broadcast threshold and the wide rows are flagged where
    they are read, without a shuffle. Where it is larger than the threshold, the
    planner shuffles both sides and splits hot partitions.
    """
    probe = missing.select(F.col(missing.columns[0]).alias("_probe"))
    flagged = df.join(probe, F.col(key) == F.col("_probe"), "left")
    return flagged.withColumn(flag, F.col(key).isNotNull() & F.col("_probe").isNull()).drop("_probe")


def first_day(at: Column, kind: DataType) -> Column:
    """The first day that begins at or after an instant of type ``kind``."""
    day = at.cast("date")
    return F.when(day.cast(kind) >= at, day).otherwise(F.date_add(day, 1))


def _bounds(fact: DataFrame, ts: str, dimension: DataFrame) -> list[Column]:
    """Validity bounds as ``_pit_from`` and ``_pit_to``: for events dated by day, as days, converted once a version.

    A day compared with an instant would be turned into one for each pair of an event and a version of its key.
    """
    bounds = []
    for name, out in (("valid_from", "_pit_from"), ("valid_to", "_pit_to")):
        kind, bound = dimension.schema[name].dataType, F.col(name)
        if isinstance(fact.schema[ts].dataType, DateType) and isinstance(kind, (TimestampType, TimestampNTZType)):
            bound = first_day(bound, kind)
        bounds.append(bound.alias(out))
    return bounds


def point_in_time_join(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    ts: str,
    columns: Sequence[str] | Mapping[str, str],
    how: str = "left",
    hot_share: float | None = None,
    hot_parts: int = 16,
) -> DataFrame:
    """Attach the dimension version valid at the event time.

    ``columns`` lists the dimension columns to attach, optionally renamed
    (``{dimension column: output column}``). The equality on ``key`` drives the
    join; the half-open validity test is a residual condition on it. Versions of
    a key do not overlap (Q11), so a fact row matches at most once.
    """
    renames = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    versions = dimension.select(
        F.col(key).alias("_pit_key"),
        *_bounds(fact, ts, dimension),
        *[F.col(source).alias(out) for source, out in renames.items()],
    )
    on = F.col(key) == F.col("_pit_key")
    if hot_share is not None:
        fact, versions = split_hot_keys(fact, versions, key, "_pit_key", hot_share, hot_parts)
        versions = versions.withColumnRenamed(SALT, "_pit_salt")
        on = on & (F.col(SALT) == F.col("_pit_salt"))
    on = on & valid_at(ts, "_pit_from", "_pit_to")
    return fact.join(versions, on, how).drop("_pit_key", "_pit_from", "_pit_to", "_pit_salt", SALT)


def orphans(
    fact: DataFrame, dimension: DataFrame, key: str, ts: str, hot_share: float | None = None, hot_parts: int = 16
) -> DataFrame:
    """Fact rows without a dimension version at the event time, as an anti-join.

    ``hot_share`` splits keys that hold at least that share of the fact rows.
    """
    versions = dimension.select(F.col(key).alias("_pit_key"), *_bounds(fact, ts, dimension))
    on = F.col(key) == F.col("_pit_key")
    if hot_share is not None:
        fact, versions = split_hot_keys(fact, versions, key, "_pit_key", hot_share, hot_parts)
        versions = versions.withColumnRenamed(SALT, "_pit_salt")
        on = on & (F.col(SALT) == F.col("_pit_salt"))
    return fact.join(versions, on & valid_at(ts, "_pit_from", "_pit_to"), "left_anti").drop(SALT)

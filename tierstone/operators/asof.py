"""As-of join: versions and events merged in time order, for keys with many versions.

An equi-join on the key with a validity test lets every event of a key meet every version of it. Here each event
looks at one row: the version before it. Cost is a sort, however many versions a key has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import hot_keys, stored

_KEY, _AT, _KIND, _PART, _EVENT, _VERSION, _CUTS, _HOT, _APART = (
    f"_asof_{n}" for n in ("key", "at", "kind", "part", "event", "version", "cuts", "hot", "apart")
)


def as_of_join(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    ts: str,
    columns: Sequence[str] | Mapping[str, str],
    how: str = "left",
    hot_share: float | None = None,
    hot_parts: int = 16,
) -> DataFrame:
    """The dimension version valid at the event time; same rows as :func:`joins.point_in_time_join`.

    ``dimension`` has ``key``, ``valid_from`` and ``valid_to``; versions of a key do not overlap. Both sides go through one shuffle
    by key and one sort by time, and the last version seen is carried forward to the events after it. Events with
    a NULL key or time match nothing; they go along in groups of their own, one a task they come from, so that ``fact`` is
    computed once. ``how`` is ``left`` or ``inner``.

    With ``hot_share``, keys that hold at least that share of the events are cut into ``hot_parts`` stretches of time
    with about equally many events each; a version enters every stretch it reaches into, so that each begins with the version
    that is open there.
    """
    if how not in ("left", "inner"):
        raise ValueError("how is 'left' or 'inner'")
    renames = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    at = F.col(ts).cast("timestamp")
    dated = F.col(key).isNotNull() & at.isNotNull()
    whole = F.struct(*[F.col(c) for c in fact.columns])
    taken = fact.filter(dated) if how == "inner" else fact
    apart = F.lit(-1) if how == "inner" else F.when(dated, F.lit(-1)).otherwise(F.spark_partition_id())
    events = taken.select(
        F.when(dated, F.col(key)).alias(_KEY), at.alias(_AT), F.lit(1).alias(_KIND), whole.alias(_EVENT), apart.alias(_APART)
    )
    ends = F.col("valid_to").cast("timestamp")
    found = F.struct(ends.alias("ends"), *[F.col(c).alias(n) for c, n in renames.items()])
    versions = dimension.filter(F.col(key).isNotNull() & (F.col("valid_from") < F.col("valid_to"))).select(
        F.col(key).alias(_KEY), F.col("valid_from").cast("timestamp").alias(_AT), F.lit(0).alias(_KIND), found.alias(_VERSION),
        F.lit(-1).alias(_APART),
    )
    by = [_KEY, _APART]
    if hot_share is not None:
        cuts = F.broadcast(_cuts(events.filter(F.col(_KEY).isNotNull()), hot_share, hot_parts))  # at most 1 / hot_share rows
        events, versions = _in_stretches(events, versions, cuts)
        by.append(_PART)
    merged = events.unionByName(versions, allowMissingColumns=True)
    before = Window.partitionBy(*by).orderBy(_AT, _KIND).rowsBetween(Window.unboundedPreceding, 0)
    carried = merged.withColumn(_VERSION, F.last(_VERSION, ignorenulls=True).over(before)).filter(F.col(_KIND) == 1)
    valid = F.col(_AT) < F.col(f"{_VERSION}.ends")
    if how == "inner":
        carried = carried.filter(valid)
    return carried.select(f"{_EVENT}.*", *[F.when(valid, F.col(f"{_VERSION}.{n}")).alias(n) for n in renames.values()])


def _cuts(events: DataFrame, share: float, parts: int) -> DataFrame:
    """(key, cuts) of the hot keys: times that part their events into about equal stretches."""
    hot = F.broadcast(hot_keys(events, _KEY, share).select(F.col(_KEY).alias(_HOT)))
    shares = [i / parts for i in range(1, parts)]
    of_hot = events.join(hot, F.col(_KEY) == F.col(_HOT))
    cuts = F.array_distinct(F.percentile_approx(_AT, F.array(*[F.lit(s) for s in shares]), F.lit(10_000)))
    return stored(of_hot.groupBy(_HOT).agg(cuts.alias(_CUTS)))


def _part(at: Column) -> Column:
    """Number of cuts at or before a time; keys that are not hot have one stretch."""
    return F.coalesce(F.size(F.filter(_CUTS, lambda c: c <= at)), F.lit(0))


def _in_stretches(events: DataFrame, versions: DataFrame, cuts: DataFrame) -> tuple[DataFrame, DataFrame]:
    on = F.col(_KEY) == F.col(_HOT)
    cut_events = events.join(cuts, on, "left").withColumn(_PART, _part(F.col(_AT))).drop(_HOT, _CUTS)
    ends = F.col(f"{_VERSION}.ends")
    reached = F.sequence(_part(F.col(_AT)), _part(ends))
    cut_versions = versions.join(cuts, on, "left").withColumn(_PART, F.explode(reached)).drop(_HOT, _CUTS)
    return cut_events, cut_versions

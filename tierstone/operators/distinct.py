"""Distinct counts that can be merged exactly: numbered keys as bits, stored per period, OR-ed across periods.

A count of distinct keys cannot be added up over months. Bitmaps of them can be merged: a year's count comes
from twelve stored months without reading facts again, and stays exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ids of one bitmap; the width of Spark's own bitmap functions.
BITS = 32768


def number_keys(keys: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """(key, id) of distinct non-NULL keys; with ``known`` (key, id), of the new ones only, above all known ids.

    Ids run on within a task and each task begins a bitmap of its own, so bitmaps are well filled and no task
    numbers all keys. Store the result: ids must not be computed twice.
    """
    found = keys.select(key).filter(F.col(key).isNotNull()).distinct()
    base = 0
    if known is not None:
        found = found.join(known.select(key), key, "left_anti")
        highest = known.agg(F.max("id")).first()[0]  # one number
        base = 0 if highest is None else (highest // BITS + 1) * BITS
    return found.select(key, (F.monotonically_increasing_id() + F.lit(base).cast("long")).alias("id"))


def distinct_partials(events: DataFrame, groups: Sequence[str], id_column: str = "id") -> DataFrame:
    """(groups, bucket, members): one bitmap per group and stretch of ids; 4 KB each, whatever it holds.

    Events without an id count for nothing. Bits are set on the map side, so a group with a third of all events costs
    one bitmap per task and stretch.
    """
    id_ = F.col(id_column)
    cut = events.filter(id_.isNotNull()).select(*groups, F.bitmap_bucket_number(id_).alias("bucket"), F.bitmap_bit_position(id_).alias("_bit"))
    return cut.groupBy(*groups, "bucket").agg(F.bitmap_construct_agg("_bit").alias("members"))


def merge_partials(partials: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Partials of coarser groups, which may be merged again."""
    return partials.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("members").alias("members"))


def distinct_counts(partials: DataFrame, groups: Sequence[str], name: str = "distinct_count") -> DataFrame:
    """Exact distinct counts of the groups, from partials as fine or finer."""
    merged = merge_partials(partials, groups)
    return merged.groupBy(*groups).agg(F.sum(F.bitmap_count("members")).alias(name))

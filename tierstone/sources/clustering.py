"""Layout on several columns at once, and what a layout is worth: files a filter must open.

A linear sort narrows the files on its first column only. Here every cluster column is cut at its
quantiles, and the bits of the ranks are interleaved, so that rows near in all columns get
near keys and a range of keys is narrow in each column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CURVE = "_curve"
BITS = 6
SAMPLE_ROWS = 20_000


def quantile_bounds(df: DataFrame, columns: Sequence[str], bits: int = BITS, sample_rows: int = SAMPLE_ROWS) -> dict[str, list]:
    """At most ``2 ** bits - 1`` ascending cut points per column, of any sortable type, from a bounded sample.

    Reads the cluster columns alone, once to count and once to sample. The driver gets the cut points.
    The sample shapes the layout only: it has no bearing on rows. A hot value is one cut point.
    """
    narrow = df.select(*columns)
    rows = narrow.count()
    share = min(1.0, sample_rows / rows) if rows else 1.0
    sample = narrow if share == 1.0 else narrow.sample(share, seed=17)
    parts = 1 << bits

    def cuts(column: str) -> Column:
        ordered = F.sort_array(F.collect_list(column))
        places = F.transform(F.sequence(F.lit(1), F.lit(parts - 1)), lambda i: F.floor(i * F.size(ordered) / parts).cast("int"))
        return F.when(F.size(ordered) > 0, F.array_distinct(F.transform(places, lambda p: F.get(ordered, p)))).alias(column)

    found = sample.agg(*[cuts(c) for c in columns]).first()
    return {c: list(found[c] or []) for c in columns}


def rank_among(column: str, bounds: Sequence) -> Column:
    """Number of bounds at or below the value, by binary search in plain comparisons; NULL counts as lowest."""
    value = F.col(column)

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value >= F.lit(bounds[middle]), search(middle + 1, high)).otherwise(search(low, middle))

    return F.when(value.isNull(), F.lit(0)).otherwise(search(0, len(bounds)))


def curve_key(bounds: Mapping[str, Sequence], bits: int = BITS) -> Column:
    """The ranks' bits interleaved, the highest bits of all columns first: one look-up a column, by its rank."""
    key = F.lit(0).cast("long")
    for place, (column, cuts) in enumerate(bounds.items()):
        spread = [F.lit(_spread(rank, place, len(bounds), bits)).cast("long") for rank in range(len(cuts) + 1)]
        key = key.bitwiseOR(F.get(F.array(*spread), rank_among(column, cuts)))
    return key


def _spread(rank: int, place: int, columns: int, bits: int) -> int:
    """The bits of a rank where they stand in the key; a long has 64 places."""
    key = 0
    for bit in range(bits):
        key |= (rank >> bit & 1) << (bit * columns + columns - 1 - place) % 64
    return key - (1 << 64) if key >> 63 else key


def file_ranges(table: DataFrame, column: str) -> DataFrame:
    """(file, rows, lowest, highest): what each file's statistics say about a column."""
    per_file = table.select(F.col("_metadata.file_path").alias("file"), F.col(column))
    return per_file.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.min(column).alias("lowest"), F.max(column).alias("highest"))


def files_to_open(table: DataFrame, column: str, low, high) -> int:
    """Files that min and max cannot exclude for ``low <= column <= high``."""
    ranges = file_ranges(table, column)
    return ranges.filter((F.col("highest") >= F.lit(low)) & (F.col("lowest") <= F.lit(high))).count()


def clustering_depth(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, files, mean_open): files a lookup of a value opens on average, values weighted by files' ends.

    A point is each file's lowest value; a file is opened for it if its range holds the point. Two rows per file
    are swept in order, in one task: meant for a table's files, not its rows.
    """
    parts = []
    for c in columns:
        ranges = file_ranges(table, c).filter(F.col("lowest").isNotNull())
        # sweep: +1 where a file's range opens, -1 after it closes; at equal values, opens come first
        ends = ranges.select(F.explode(F.array(
            F.struct(F.col("lowest").alias("at"), F.lit(0).alias("closes")), F.struct(F.col("highest").alias("at"), F.lit(1).alias("closes"))
        )).alias("e")).select("e.*")
        per_value = ends.groupBy("at").agg(F.count_if(F.col("closes") == 0).alias("opens"), F.count_if(F.col("closes") == 1).alias("closes"))
        before = F.sum(F.col("opens") - F.col("closes")).over(Window.orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
        open_now = F.coalesce(before, F.lit(0)) + F.col("opens")
        depth = per_value.withColumn("open_now", open_now).agg(
            F.lit(c).alias("column_name"), F.sum("opens").alias("files"), (F.sum(F.col("open_now") * F.col("opens")) / F.sum("opens")).alias("mean_open")
        )
        parts.append(depth)
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out

"""Period-over-period, rolling, cumulative and ranking columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.expressions import ColumnOrName, as_column


def periods(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    """Window over the periods of one key. Use on rows already aggregated to one
    per key and period, so a partition is never longer than the calendar."""
    return Window.partitionBy(*keys).orderBy(*order)


def prior(value: ColumnOrName, window: WindowSpec) -> Column:
    """Value of the previous period present."""
    return F.lag(as_column(value), 1).over(window)


def pct_change(value: ColumnOrName, previous: ColumnOrName, digits: int = 1) -> Column:
    """Percent change against an already computed previous value; NULL if that is 0 or NULL."""
    value, previous = as_column(value), as_column(previous)
    return F.round(F.lit(100.0) * (value - previous) / F.nullif(previous, F.lit(0)), digits)


def delta(value: ColumnOrName, previous: ColumnOrName, digits: int = 2) -> Column:
    """Rounded difference to the previous value."""
    return F.round(as_column(value) - as_column(previous), digits)


def rolling(aggregate: Callable[[Column], Column], value: ColumnOrName, window: WindowSpec, rows: int) -> Column:
    """Aggregate over the current and the ``rows - 1`` preceding rows."""
    return aggregate(as_column(value)).over(window.rowsBetween(-(rows - 1), Window.currentRow))


def cumulative(aggregate: Callable[[Column], Column], value: ColumnOrName, window: WindowSpec) -> Column:
    """Running aggregate up to the current row."""
    return aggregate(as_column(value)).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def rank_in(group: Sequence[str], value: ColumnOrName) -> Column:
    """``rank()`` by descending value inside a group of bounded size."""
    return F.rank().over(Window.partitionBy(*group).orderBy(as_column(value).desc()))


def with_rank(
    df: DataFrame, group: Sequence[str], value: str, out: str, counted: DataFrame | None = None
) -> DataFrame:
    """W7 for groups of any size: ``rank()`` by descending ``value``, exactly.

    A rank is one plus the number of rows with a greater value. Rows are first
    counted per (group, value), combining on the map side, so the window runs
    over the distinct values of a group instead of its rows (for a count metric
    that sums to N, fewer than sqrt(2N) values). The rank is then joined back.
    NULL values rank last, as in SQL ``desc``. ``counted`` may name an earlier,
    cheaper frame that holds the same (group, value) rows to count.
    """
    source = df if counted is None else counted
    counts = source.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    above = Window.partitionBy(*group).orderBy(F.col(value).desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.select(
        *[F.col(c).alias(f"_r{i}") for i, c in enumerate([*group, value])],
        (F.coalesce(F.sum("_n").over(above), F.lit(0)) + 1).alias(out),
    )
    on = [F.col(c).eqNullSafe(F.col(f"_r{i}")) for i, c in enumerate([*group, value])]
    condition = on[0]
    for part in on[1:]:
        condition = condition & part
    return df.join(ranks, condition, "left").drop(*[f"_r{i}" for i in range(len(on))])

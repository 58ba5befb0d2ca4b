"""Column builders: tiers, safe ratios, conditional counts, validity tests."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def bucket(rules: Sequence[tuple[str, Column]], default: str | None) -> Column:
    """Label of the first rule that holds, else ``default``.

    A NULL predicate does not hold, so NULL inputs fall through to the default.
    """
    labels = [F.when(predicate, F.lit(label)) for label, predicate in rules]
    return F.coalesce(*labels, F.lit(default))


def at_least(value: ColumnOrName, steps: Sequence[tuple[float, str]], default: str) -> Column:
    """P12 special case: descending lower bounds, ``[(1000, "very_popular"), ...]``."""
    value = as_column(value)
    return bucket([(label, value >= bound) for bound, label in steps], default)


def at_most(value: ColumnOrName, steps: Sequence[tuple[float, str]], default: str) -> Column:
    """P12 special case: ascending upper bounds, ``[(10, "very_brief"), ...]``."""
    value = as_column(value)
    return bucket([(label, value <= bound) for bound, label in steps], default)


def count_when(predicate: Column) -> Column:
    """Number of rows where the predicate is true (not false, not NULL)."""
    return F.count_if(predicate)


def safe_ratio(num: ColumnOrName, den: ColumnOrName, digits: int, scale: float = 1.0) -> Column:
    """``round(scale * num / den, digits)`` as double; NULL for a zero denominator."""
    den = as_column(den)
    quotient = F.lit(scale) * as_column(num).cast("double") / F.nullif(den, F.lit(0))
    return F.round(quotient, digits)


def safe_pct(num: ColumnOrName, den: ColumnOrName, digits: int = 1) -> Column:
    """Percentage form of :func:`safe_ratio`."""
    return safe_ratio(num, den, digits, scale=100.0)


def avg_round(value: ColumnOrName, digits: int) -> Column:
    """Rounded mean."""
    return F.round(F.avg(as_column(value)), digits)


def null_safe_sum(*columns: ColumnOrName) -> Column:
    """Sum of columns, NULL counting as zero."""
    return reduce(lambda a, b: a + b, (F.coalesce(as_column(c), F.lit(0)) for c in columns))


def valid_at(ts: ColumnOrName, valid_from: ColumnOrName, valid_to: ColumnOrName) -> Column:
    """``valid_from <= ts < valid_to``."""
    ts = as_column(ts)
    return (ts >= as_column(valid_from)) & (ts < as_column(valid_to))


def normalize_label(value: ColumnOrName, vocabulary: Sequence[str], default: str = "unknown") -> Column:
    """P10: trimmed lower-case label if it is in the vocabulary, else ``default``."""
    label = F.trim(F.lower(as_column(value)))
    return F.when(label.isin(list(vocabulary)), label).otherwise(F.lit(default))

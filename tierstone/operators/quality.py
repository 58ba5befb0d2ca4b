"""Row validation: ordered reject reasons and the clean/rejected split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import ColumnOrName, as_column

REASON = "reject_reason"


def tag_rejects(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """Add ``reject_reason``, the name of the first failing rule (NULL when clean)."""
    return df.withColumn(REASON, F.coalesce(*[F.when(failed, F.lit(name)) for name, failed in rules]))


def split_rejects(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(clean, rejected)``; only the rejected side keeps the reason.

    Both sides share one lineage. Jobs that write both go through a written
    staging table (see ``plans.pipeline``), so the source is parsed once.
    """
    clean = tagged.filter(F.col(REASON).isNull()).drop(REASON)
    return clean, tagged.filter(F.col(REASON).isNotNull())


def parse_timestamp(raw: ColumnOrName) -> Column:
    """ANSI-safe ``yyyy-MM-dd HH:mm:ss`` parse: NULL instead of an error."""
    return F.try_to_timestamp(as_column(raw), F.lit("yyyy-MM-dd HH:mm:ss"))


def split_unparseable(df: DataFrame, raw: str, parsed: str) -> tuple[DataFrame, DataFrame]:
    """Parse ``raw`` into ``parsed``; return ``(parsed rows, unparseable rows)``."""
    with_parsed = df.withColumn(parsed, parse_timestamp(raw))
    return with_parsed.filter(F.col(parsed).isNotNull()), with_parsed.filter(F.col(parsed).isNull())

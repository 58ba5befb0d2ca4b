"""Date spine and densified periods."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def date_spine(spark: SparkSession, start: str, end: str, out: str = "calendar_date") -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias(out))


def date_spine_of(df: DataFrame, date: str, out: str = "calendar_date") -> DataFrame:
    """Spine from the first to the last date present in a frame."""
    span = df.agg(F.min(F.to_date(date)).alias("_lo"), F.max(F.to_date(date)).alias("_hi"))
    return span.select(F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 day"))).alias(out))

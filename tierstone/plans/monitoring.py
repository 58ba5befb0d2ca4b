"""Row counts and quarantine rates per source, and the alert filter."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import safe_pct

# --- fixed value: percentage above which a source is reported ---
ALERT_PCT = 5.0


@dataclass(frozen=True)
class SourceFrames:
    """What one source left behind in a run; ``None`` marks a table that does not exist.

    A number is a count that was taken while the table was written.
    """

    bronze: DataFrame | int | None
    silver: DataFrame | int | None
    quarantine: DataFrame | int | None


def quarantine_rate(rejects: str = "quarantine_count", bronze: str = "bronze_row_count") -> Column:
    """Q8: rejects per hundred bronze rows; an empty bronze counts as one row, an absent one gives NULL."""
    rows = F.when(F.col(bronze).isNotNull(), F.greatest(F.col(bronze), F.lit(1)))
    return safe_pct(rejects, rows, 2)


def ingestion_metrics(
    spark: SparkSession,
    sources: Mapping[str, SourceFrames],
    run_id: str,
    run_timestamp: str | None = None,
) -> DataFrame:
    """One row per source.

    Counts taken while writing (``write_counted``) are rows of a local frame and cost no scan. Others are
    counted in the returned frame's own job, one-row frames brought together by the source's name. Only absence is
    guarded (S14): a table that exists but cannot be read still fails.
    """
    known, scanned = [], []
    for source, frames in sources.items():
        sides = {"bronze_row_count": frames.bronze, "silver_row_count": frames.silver, "quarantine_count": frames.quarantine}
        if frames.quarantine is None:
            sides["quarantine_count"] = 0
        known.append((source, *[side if isinstance(side, int) else None for side in sides.values()]))
        for name, side in sides.items():
            if isinstance(side, DataFrame):
                scanned.append(side.agg(F.count(F.lit(1)).alias(name)).select(F.lit(source).alias("source_name"), name))
    counts = ("bronze_row_count", "silver_row_count", "quarantine_count")
    given = spark.createDataFrame(known, f"source_name string, {', '.join(f'{c} long' for c in counts)}")
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scanned, given)
    metrics = (
        stacked.groupBy("source_name")
        .agg(*[F.max(c).alias(c) for c in counts])
        .withColumn("quarantine_rate_pct", quarantine_rate())
        .withColumn("pipeline_run_id", F.lit(run_id))
    )
    if run_timestamp is not None:
        metrics = metrics.withColumns({"run_timestamp": F.lit(run_timestamp), "logged_at": F.lit(run_timestamp)})
    return metrics


def quarantine_alerts(metrics: DataFrame, threshold: float = ALERT_PCT) -> DataFrame:
    """Q9: sources above the threshold."""
    return metrics.filter(F.col("quarantine_rate_pct") > threshold)

"""Incremental review loads as a file stream.

The keyed merge of an incremental load, driven by new bronze files instead of a
re-read of the whole folder: each micro-batch goes through the same function as
the batch load. Repeating a batch after a failure leaves the table unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.pipeline import store_reviews
from ..sources.bronze import SCHEMAS
from ..sources.tables import read_table


def stream_reviews(
    spark: SparkSession, incoming: str, base: str, load_ts: str, checkpoint: str, name: str = "reviews"
) -> StreamingQuery:
    """Process all new JSON files under ``incoming`` and stop. ``checkpoint`` is a shared folder."""

    def merge(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        business, users = (read_table(session, base, f"silver/{table}") for table in ("business", "users"))
        store_reviews(batch, base, business, users, load_ts, f"{name}-{number}")

    stream = spark.readStream.schema(SCHEMAS["review"]).json(incoming)
    return (
        stream.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(merge)
        .start()
    )

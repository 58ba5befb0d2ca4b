"""Splitting of hot keys for joins, beyond what the adaptive planner does on its own."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir

HOT = "_hot"
SALT = "_salt"


def hot_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """Non-NULL keys that hold at least ``share`` of all rows, as a stored one-column table.

    At most ``1 / share`` keys can qualify, which bounds the result whatever the
    size of ``df``; that is what makes it safe to broadcast. One scan of the key
    column counts the keys, combined on the map side, so one hot key costs one row
    per task; total and list come from the stored counts.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be in (0, 1]")
    counts = stored(df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")))
    total = counts.agg(F.sum("_n")).first()[0] or 0  # one number
    return stored(counts.filter(F.col(key).isNotNull() & (F.col("_n") >= share * total)).select(key))


def stored(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read back: computed once, its real size known to the planner."""
    path = f"{shared_dir(df.sparkSession)}/tierstone-hot-{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_hot_keys(
    big: DataFrame, small: DataFrame, key: str, small_key: str, share: float, parts: int
) -> tuple[DataFrame, DataFrame]:
    """Add a salt to both sides: hot rows of ``big`` spread over ``parts`` salts.

    Rows with a NULL key match nothing and are spread in any case. Rows of ``small``
    are repeated once per salt for the hot keys only. Joining
    on key *and* salt gives exactly the rows of a join on key alone. The salt is
    a hash of the row's content, so a recomputed task yields the same rows.
    """
    hot = F.broadcast(hot_keys(big, key, share).select(F.col(key).alias(HOT)))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.lit(parts)).cast("int")
    left = (
        big.join(hot, F.col(key) == F.col(HOT), "left")
        .withColumn(SALT, F.when(F.col(HOT).isNotNull() | F.col(key).isNull(), spread).otherwise(F.lit(0)))
        .drop(HOT)
    )
    every = F.sequence(F.lit(0), F.lit(parts - 1))
    right = (
        small.join(hot, F.col(small_key) == F.col(HOT), "left")
        .withColumn(SALT, F.explode(F.when(F.col(HOT).isNotNull(), every).otherwise(F.array(F.lit(0)))))
        .drop(HOT)
    )
    return left, right

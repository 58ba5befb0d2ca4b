"""Tables kept by key: bucketed and sorted on the join key, so that joins and sums on it need no shuffle.

Facts and dimensions that are joined on one key again and again are dealt out once, when they are written, into the same number of
buckets. Spark then joins bucket with bucket. A key with a large share of all rows makes its bucket as
large, and no planner can split it: keep such keys in plain tables and join them with ``hot_share``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .tables import complete_version, next_version, stored_facts, store_facts


def write_bucketed(df: DataFrame, base: str, name: str, key: str, buckets: int, sort_by: Sequence[str] = ()) -> DataFrame:
    """Write a new version of the table in ``buckets`` files by ``key``, sorted within by key and ``sort_by``, and return its scan.

    One shuffle, and one file a bucket. Tables that are to be joined without a shuffle need the same number of buckets and a key of
    the same type.
    """
    spark, target = df.sparkSession, next_version(df.sparkSession, base, name)
    store_facts(spark, target, df.schema, buckets=buckets, key=key, sort_by=list(sort_by))
    writer = df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key, *sort_by)
    writer.option("path", target).saveAsTable(_session_name(target))
    return read_bucketed(spark, base, name)


def read_bucketed(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Scan of the current version that knows its buckets, in whatever session; the files are plain Parquet to others."""
    path = complete_version(spark, base, name)
    schema, facts = stored_facts(spark, path)
    if "buckets" not in facts:
        raise ValueError(f"{name} is not kept by key")
    table = _session_name(path)
    if not spark.catalog.tableExists(table):
        columns = spark.createDataFrame([], schema)._jdf.schema().toDDL()
        order = ", ".join(f"`{c}`" for c in [facts["key"], *facts["sort_by"]])
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{facts['key']}`) SORTED BY ({order}) "
            f"INTO {facts['buckets']} BUCKETS LOCATION '{path}'"
        )
    return spark.table(table)


def _session_name(path: str) -> str:
    return f"tierstone_{hashlib.md5(path.encode()).hexdigest()}"

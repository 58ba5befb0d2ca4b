"""Columnar tables: versioned writes, reads, appends, layout.

A table is a folder with one sub-folder per written version. A version counts
from the moment Spark has put its ``_SUCCESS`` marker there, so readers keep the
previous version while a new one is being written, and a failed write leaves no
trace in the data that readers see. The one exception is a keyed upsert, which
swaps partitions inside the current version: do not read the table meanwhile,
and repeat an upsert that failed.

Each version's schema is stored beside it and reading goes by it, so a table
without rows is a table, and partition values keep the type they were written
with. Old versions stay until ``drop_old_versions``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators.scd import upsert
from .clustering import CURVE, curve_key, quantile_bounds

VERSION = "version"
_PREFIX = f"{VERSION}="


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def _versions(spark: SparkSession, path: str) -> dict[int, bool]:
    """Version number -> whether its write completed."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return {}
    found = {}
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(_PREFIX):
            done = fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))
            found[int(name.removeprefix(_PREFIX))] = done
    return found


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jvm_path)


def current_version(spark: SparkSession, base: str, name: str) -> str | None:
    """Path of the newest complete version, or None."""
    path = table_path(base, name)
    complete = [number for number, done in _versions(spark, path).items() if done]
    return f"{path}/{_PREFIX}{max(complete):06d}" if complete else None


def table_exists(spark: SparkSession, base: str, name: str) -> bool:
    """Decides between merging into a table and building it."""
    return current_version(spark, base, name) is not None


def _hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a file or folder."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def _delete(spark: SparkSession, path: str) -> None:
    fs, jvm_path = _hadoop_path(spark, path)
    fs.delete(jvm_path, True)


def _facts_path(version_path: str) -> str:
    table, version = version_path.rsplit("/", 1)
    return f"{table}/_schemas/{version}.json"


def _put_facts(spark: SparkSession, version_path: str, schema: StructType, **more) -> None:
    fs, path = _hadoop_path(spark, _facts_path(version_path))
    out = fs.create(path, True)
    fields = [StructField(f.name, f.dataType, True) for f in schema]
    out.write(bytearray(json.dumps({"schema": StructType(fields).jsonValue(), **more}).encode()))
    out.close()


def _get_facts(spark: SparkSession, version_path: str) -> dict:
    _, path = _hadoop_path(spark, _facts_path(version_path))
    return json.loads("".join(r.value for r in spark.read.text(path.toString(), wholetext=True).collect()))  # one small file


def next_version(spark: SparkSession, base: str, name: str) -> str:
    path = table_path(base, name)
    return f"{path}/{_PREFIX}{max(_versions(spark, path), default=0) + 1:06d}"


def complete_version(spark: SparkSession, base: str, name: str) -> str:
    path = current_version(spark, base, name)
    if path is None:
        raise FileNotFoundError(f"no complete version of {name} under {base}")
    return path


def store_facts(spark: SparkSession, version_path: str, schema: StructType, **more) -> None:
    _put_facts(spark, version_path, schema, **more)


def stored_facts(spark: SparkSession, version_path: str) -> tuple[StructType, dict]:
    """Schema of a version, and what else was stored with it."""
    facts = _get_facts(spark, version_path)
    return StructType.fromJson(facts["schema"]), facts


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Scan of the current version, with the history of a type-2 table (see ``write_versions``)."""
    schema, facts = stored_facts(spark, path := complete_version(spark, base, name))
    if "since" not in facts:
        return spark.read.schema(schema).parquet(path)
    root = table_path(base, name)
    complete = sorted(n for n, done in _versions(spark, root).items() if done and n >= facts["since"])
    every = spark.read.schema(StructType([*schema.fields, StructField(VERSION, IntegerType(), True)])).parquet(root)
    number = F.col(VERSION)
    shown = F.col("is_current") & (number == complete[-1]) | ~F.col("is_current") & number.isin(complete)
    return every.filter(shown).drop(VERSION)


class Tally:
    """Counts of the rows of one write, taken by the tasks that write them, so that no table is read to be counted.

    ``counts`` are aggregates by name. They are observed right before the writer, where a lost executor repeats
    nothing that was counted. A tally serves one write; its numbers are there once that has ended.
    """

    def __init__(self, **counts: Column):
        self.counts, self.seen = counts, Observation(uuid.uuid4().hex)

    def on(self, df: DataFrame) -> DataFrame:
        return df.observe(self.seen, *[F.coalesce(c, F.lit(0)).alias(n) for n, c in self.counts.items()])

    def __getitem__(self, name: str) -> int:
        return self.seen.get[name]


def lay_out(
    df: DataFrame,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    curve: bool = False,
    files: int | None = None,
) -> DataFrame:
    """Arrange rows for the write.

    With ``cluster_by``, rows are range-partitioned on partition *and* cluster
    columns and sorted inside each task: files get narrow min/max ranges for
    skipping, and a hot partition value is cut into several tasks wherever its
    cluster columns differ; a content hash as the last range column cuts it even
    where they do not. With ``partition_by`` alone, the rebalance hint groups
    rows by partition value and lets the adaptive planner split oversized groups
    and join small ones, by their measured size.
    """
    if cluster_by:
        spread = F.xxhash64(*[F.col(c) for c in df.columns])
        ranges = [*partition_by, *cluster_by]
        if curve and len(cluster_by) > 1:
            df = df.withColumn(CURVE, curve_key(quantile_bounds(df, cluster_by)))
            ranges = [*partition_by, CURVE, *cluster_by]
        number = () if files is None else (files,)
        return df.repartitionByRange(*number, *ranges, spread).sortWithinPartitions(*ranges).drop(CURVE)
    if partition_by:
        return df.hint("rebalance", *[F.col(c) for c in partition_by])
    return df


def write_table(
    df: DataFrame,
    base: str,
    name: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    curve: bool = False,
    files: int | None = None,
    tally: Tally | None = None,
) -> DataFrame:
    """Write a new version of the table and return its scan.

    With ``curve`` the rows are stored first and laid out from there, so that a costly
    frame is computed once, not once for its quantiles, once for its ranges and once to be written.
    """
    return _write_version(df, base, name, partition_by, cluster_by, curve, files, tally)


def _write_version(
    df: DataFrame, base: str, name: str, partition_by: Sequence[str], cluster_by: Sequence[str],
    curve: bool = False, files: int | None = None, tally: Tally | None = None, **facts
) -> DataFrame:
    spark = df.sparkSession
    path = table_path(base, name)
    target = next_version(spark, base, name)
    curve, staged = curve and len(cluster_by) > 1, f"{path}/_unsorted"
    if curve:
        df.write.mode("overwrite").parquet(staged)
        df = spark.read.schema(df.schema).parquet(staged)
    rows = lay_out(df, partition_by, cluster_by, curve, files)
    writer = (rows if tally is None else tally.on(rows)).write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    _put_facts(spark, target, df.schema, **facts)
    writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(target)
    if curve:
        _delete(spark, staged)
    return read_table(spark, base, name)


def write_versions(
    changes: DataFrame,
    base: str,
    name: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    keep_history: bool = True,
    curve: bool = False,
    tally: Tally | None = None,
) -> DataFrame:
    """A type-2 table after a load, without touching its history.

    ``changes`` holds all current versions and those this load has closed (see
    ``operators.scd.scd2_changes``). They become one version of the table,
    partitioned by ``is_current`` first. Readers see the current rows of the newest
    version and the closed rows of it and all before, so closed rows are
    written once. ``keep_history=False`` begins anew.
    """
    spark, path = changes.sparkSession, table_path(base, name)
    number = max(_versions(spark, path), default=0) + 1
    before = current_version(spark, base, name) if keep_history else None
    since = _get_facts(spark, before).get("since", number) if before else number
    return _write_version(changes, base, name, ("is_current", *partition_by), cluster_by, curve, None, tally, since=since)


def drop_old_versions(spark: SparkSession, base: str, name: str, keep: int = 2) -> None:
    """Delete all but the newest ``keep`` versions; of a type-2 table only what readers no longer see."""
    path = table_path(base, name)
    complete = sorted(number for number, done in _versions(spark, path).items() if done)
    since = _get_facts(spark, current_version(spark, base, name)).get("since") if complete else None
    for number in complete[:-keep] if keep > 0 else []:
        folder = f"{path}/{_PREFIX}{number:06d}"
        _delete(spark, folder if since is None or number < since else f"{folder}/is_current=true")


def compact(
    spark: SparkSession,
    base: str,
    name: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    target_bytes: int = 128 << 20,
    slack: int = 2,
) -> bool:
    """Rewrite the table into files of about ``target_bytes``, if it has more than ``slack`` times as many.

    Sizes are the files' own, one row a file summed where they are; the driver gets two numbers. The rewrite is a new
    version, so readers keep the old one until it is complete and see the same rows. For a type-2 table
    it gathers the closed versions that loads have left in many folders, and later readers go back no further.
    """
    table = read_table(spark, base, name)
    facts = _get_facts(spark, current_version(spark, base, name))
    per_file = table.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.max("_metadata.file_size").alias("bytes"))
    found = per_file.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    wanted = max(1, -(-found.bytes // target_bytes))
    # a partition or cluster range with rows is a file at least; ranges are cut by number, so partitions add few
    if found.files <= slack * wanted:
        return False
    ranges = tuple(cluster_by) or tuple(c for c in table.columns if c not in partition_by)[:1]
    if "since" in facts:
        number = max(_versions(spark, table_path(base, name)), default=0) + 1
        partition_by = ("is_current", *[c for c in partition_by if c != "is_current"])
        _write_version(table, base, name, partition_by, ranges, False, wanted, None, since=number)
    else:
        _write_version(table, base, name, partition_by, ranges, False, wanted)
    return True


def replace_partitions(
    changed: DataFrame, base: str, name: str, partition_by: Sequence[str], cluster_by: Sequence[str] = ()
) -> DataFrame:
    """Replace, inside the current version, exactly the partitions ``changed`` has rows for.

    Spark stages the new files next to the table and swaps the touched
    partitions when the whole job has succeeded, so ``changed`` may be derived
    from the table itself. A reader during the swap may see some partitions old
    and some new.
    """
    spark = changed.sparkSession
    path = current_version(spark, base, name)
    known = StructType.fromJson(_get_facts(spark, path)["schema"])
    _put_facts(spark, path, StructType([*known.fields, *[f for f in changed.schema if f.name not in known.names]]))
    (
        lay_out(changed, partition_by, cluster_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    return read_table(spark, base, name)


def rewrite_partitions(
    rows: DataFrame, base: str, name: str, column: str, values: Sequence, cluster_by: Sequence[str] = ()
) -> DataFrame:
    """Make ``rows`` the whole content of the partitions ``column`` in ``values``; other folders stay as they are.

    ``rows`` may be derived from the table. A partition that is left without rows loses its folder.
    """
    spark = rows.sparkSession
    stored = _hadoop_scratch(rows, base, name)
    found = {r[0] for r in stored.select(column).distinct().collect()}  # one row a partition
    table = replace_partitions(stored, base, name, (column,), cluster_by) if found else read_table(spark, base, name)
    path = current_version(spark, base, name)
    empty = [v for v in values if v not in found and path_exists(spark, f"{path}/{column}={v}")]
    for value in empty:
        _delete(spark, f"{path}/{column}={value}")
    _delete(spark, f"{table_path(base, name)}/_rewrite")
    return read_table(spark, base, name) if empty else table


def _hadoop_scratch(rows: DataFrame, base: str, name: str) -> DataFrame:
    """The rows stored beside the table, so that what is read and what is replaced are not the same files."""
    path = f"{table_path(base, name)}/_rewrite"
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def upsert_partitions(
    updates: DataFrame,
    base: str,
    name: str,
    key: str,
    partition_by: Sequence[str],
    cluster_by: Sequence[str] = (),
) -> DataFrame:
    """J11 on a partitioned table: rewrite only the partitions an update touches.

    A first pass over key, partition columns and file names finds the folders of the
    touched partitions: those with rows to be replaced, and those that get rows.
    The driver collects one row per touched partition. The rewrite then reads just those
    folders. A partition whose rows all move elsewhere gets no new files; its folder is
    deleted after the swap.
    """
    spark = updates.sparkSession
    path, target = current_version(spark, base, name), read_table(spark, base, name)
    hits = updates.select(F.col(key).alias("_hit"))
    rows = target.select(key, *partition_by, F.col("_metadata.file_path").alias("_file"))
    per_partition = (
        rows.join(hits, F.col(key) == F.col("_hit"), "left")
        .groupBy(*partition_by)
        .agg(F.count("_hit").alias("_replaced"), F.count(F.lit(1)).alias("_rows"), F.min("_file").alias("_file"))
    )
    incoming = updates.select(*[F.col(c).alias(f"_in_{c}") for c in partition_by]).distinct().withColumn("_gets", F.lit(True))
    same = [F.col(c).eqNullSafe(F.col(f"_in_{c}")) for c in partition_by]
    touched = per_partition.join(incoming, same, "left").filter("_replaced > 0 or _gets")
    found = touched.select("_file", (F.coalesce("_gets", F.lit(False)) | (F.col("_replaced") < F.col("_rows"))).alias("_stays")).collect()
    folders = {unquote(r._file).rsplit("/", 1)[0]: r._stays for r in found}
    old = spark.read.schema(target.schema).option("basePath", path).parquet(*sorted(folders)) if folders else target.limit(0)
    result = replace_partitions(upsert(old, updates, key), base, name, partition_by, cluster_by)
    for folder, stays in folders.items():
        if not stays:
            _delete(spark, folder)
    return result if all(folders.values()) else read_table(spark, base, name)


def append_quarantine(df: DataFrame, base: str, entity: str, run_id: str, tally: Tally | None = None) -> None:
    """Rejects of one run, in the run's own partition: a rerun replaces them."""
    (df if tally is None else tally.on(df)).write.mode("overwrite").parquet(f"{table_path(base, 'rejected')}/{entity}/run_id={run_id}")


def read_quarantine(spark: SparkSession, base: str, entity: str, run_id: str | None = None) -> DataFrame:
    """Rejects of one run, or of all runs with ``run_id`` as a column."""
    path = f"{table_path(base, 'rejected')}/{entity}"
    reader = spark.read.option("mergeSchema", "true").option("basePath", path)
    return reader.parquet(path if run_id is None else f"{path}/run_id={run_id}")


def append_log(df: DataFrame, base: str, run_id: str, name: str = "pipeline_run_log") -> None:
    """Append the rows of one run; columns may be added over time."""
    df.write.mode("overwrite").parquet(f"{table_path(base, name)}/run={run_id}")


def read_log(spark: SparkSession, base: str, name: str = "pipeline_run_log") -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(table_path(base, name)).drop("run")

"""Helpers shared by the corpus operators: tables, scratch tables, words, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from tierstone.session import shared_dir

#: White space of the word contracts, as a character class for Java patterns.
SPACE_CLASS = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors.

    The planner then knows the table's real size, so it broadcasts it only if it is
    under the session's threshold.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def extended(schema: StructType, **types: str | DataType) -> StructType:
    """A new schema with further columns."""
    out = StructType(list(schema.fields))
    for name, kind in types.items():
        out.add(name, kind)
    return out


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column of `df` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. `lower` does the same on pure ASCII and is much cheaper."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def count_words(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in a text; 0 for null."""
    parts = F.split(text, f"{SPACE_CLASS}+")
    edges = (F.element_at(parts, 1) == "").cast("long") + (F.element_at(parts, -1) == "").cast("long")
    # one empty part is both the first and the last
    return F.coalesce(F.greatest(F.size(parts).cast("long") - edges, F.lit(0).cast("long")), F.lit(0).cast("long"))


def crc_fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo the number of folds; null for a null id."""
    return F.crc32(doc_id.cast("string")) % folds


def texts(batch: pa.RecordBatch, column: str = "text") -> Iterator[str | None]:
    """The texts of a batch one by one, so that only one is a Python object at a time."""
    for value in batch.column(column):
        yield value.as_py()


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, for operators that return texts: only so many are in memory a second time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)

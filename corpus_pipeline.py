"""The corpus pipeline: five stages, each written as Parquet and read as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.llm import decontamination, langid, mixing, pii, simhash
from tierstone.llm.common import free_name, scratch, table

#: Texts whose best language scores lower are rejected as no language that was learned.
MIN_LANGUAGE_SCORE = 0.4
#: The operators' outcomes are not expressible in SQL (kernel model, seeded permutation).
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of a learned language stay; the rest is rejected: null and empty texts, no letters, a low score.

    Repeated rows share their fate; columns stay, whatever their names; no rows, or no labels to learn from, give no rows.
    """
    names = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    found = langid.predict(docs, langid.train(docs), names)
    good = (F.col(names[0]) != langid.UNKNOWN) & (F.col(names[1]) >= MIN_LANGUAGE_SCORE)
    return found.filter(good).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: the one with the smallest id, null ids last, ties by text hash.

    Of repeated rows one stays; null and empty texts are one component; an empty table gives no rows.
    """
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window stay, repeated rows and those without words too; no rows give no rows."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, with personal data masked in the text; null texts and repeated rows stay as they are."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, with size, target and taken (their words in it, repeats counted).

    Null and empty texts are not in it; of repeated rows each has a share of its own, of rows without a source too;
    no rows give no rows.
    """
    return mixing.mixed_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

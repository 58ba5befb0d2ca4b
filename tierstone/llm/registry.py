"""Registered queries of the corpus operators and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.llm import balltree, chat, decontamination, langid, licences, mixing, pii, quality_rules, runs, simhash, site_quality, substrings, tokens
from tierstone.llm.check_sql import CHAT_SQL, CONTAMINATION_SQL, RANKED_SQL, REPEATED_SQL, licence_sql
from tierstone.llm.common import SPACE_CLASS, table

DIRECTORY_IDS = 100


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, own or inherited, in a tree source/lang/hundred of ids."""
    docs = table(spark, sf_dir, "documents")
    hundred = F.floor(F.col("doc_id") / DIRECTORY_IDS).cast("string")
    path = F.concat_ws("/", "source", "lang", hundred, F.col("doc_id").cast("string"))
    found = licences.scan(docs.select(F.col("doc_id").alias("key"), path.alias("path"), "text"))
    return found.withColumnRenamed("key", "doc_id")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), near=True)
    digest = lambda ids: F.sha2(F.array_join(ids, ","), 256)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", digest("item_ids").alias("items_sha256"), "contaminated",
        F.size("near_items").cast("long").alias("n_near_items"), digest("near_items").alias("near_items_sha256"),
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that says control strings, read back from the formatted text."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    values = {"conv_id": F.lit(-1), "turn": F.col("id"), "role": role, "text": F.lit(said)}
    extra = spark.range(2).select(*[values[f.name].cast(f.dataType).alias(f.name) for f in turns.schema])
    back = chat.read_back(chat.format_conversations(turns.unionByName(extra)))
    newline = F.lit("\n")
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], newline, t["text"], newline)), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    base = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select(*base, "votes", F.round("quality", 6).alias("quality"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"))


def op9_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by source (host) and language within the source (path)."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return site_quality.assess(docs, labels, F.col("source"), F.col("lang"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.digest(F.col("base")), 256).alias("base_sha256"), pii.digest(F.col("spans")).alias("spans"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; in a tenth of the documents the words from a place on repeat with a period."""
    number = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", f"{SPACE_CLASS}+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", number.alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    n, g = F.size("words").cast("long"), F.floor(F.col("h") / 10)
    start = F.when(n > 0, g % n)
    period = F.lit(1) + F.floor((n - start) / (F.lit(3) + g % 8))
    rows = rows.withColumn("start", start).withColumn("period", period)
    place = lambda i: F.when(i < F.col("start"), i).otherwise(F.col("start") + (i - F.col("start")) % F.col("period"))
    again = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get("words", place(i).cast("int")))
    return rows.select("doc_id", F.when(F.col("start").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    # runs come by start and period, so that of equal exponents the first one stays
    more = lambda best, r: best["length"].isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    found = found.withColumn("best", F.aggregate("runs", none, lambda best, r: F.when(more(best, r), r).otherwise(best)))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n"))))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.find_repeated(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    kept = F.coalesce(F.sha2("kept_text", 256), "words_sha256")
    return found.select("doc_id", "n_words", removed.alias("n_removed"), kept.alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_license_scan, op2_decontamination, op3_simhash, op4_language_id, op5_mixing, op6_chat_format, op7_quality_rules, op8_token_counts, op9_site_quality, op10_pii, op11_ranked_search, op12_periodic_runs, op13_substring_dedup)
}
ORACLES: dict[str, str] = {"op1_license_scan": licence_sql(DIRECTORY_IDS), "op2_decontamination": CONTAMINATION_SQL, "op6_chat_format": CHAT_SQL, "op11_ranked_search": RANKED_SQL, "op13_substring_dedup": REPEATED_SQL}

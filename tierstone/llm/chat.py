"""Chat formatting with Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, NEXT, END = "<|", "|>", "<|next|>", "<|end|>"
#: Openings of control strings: of this template, and of common instruction templates.
#: In an escaped text `\e`, `\l`, `\b` stand for a backslash and the two openings.
ANGLE = r"<(?=\||/?s>|<?/?SYS>>)"
BRACKET = r"\[(?=/?INST\])"


def escape(text: Column) -> Column:
    """No control string is left in the result; `unescape` gives the text back."""
    out = F.replace(text, F.lit("\\"), F.lit("\\e"))
    return F.regexp_replace(F.regexp_replace(out, ANGLE, r"\\l"), BRACKET, r"\\b")


def unescape(text: Column) -> Column:
    """Every backslash of an escaped text starts an escape, so the order is free but for the last."""
    out = F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("["))
    return F.replace(out, F.lit("\\e"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("|"), F.lit("\\p")), F.lit("<"), F.lit("\\l"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\p"), F.lit("|")))


def format_conversations(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss_spans, per conversation.

    `<|role|>text<|next|>text<|end|>`: adjacent turns of one role share a block, with a
    mark between the texts. `loss_spans` holds (start, end) code points of the trained
    role's texts in `formatted`, marks not included.

    Turns are sorted by (turn, role, text), null turns first; repeated rows stay. Null text
    and null role are empty. Null conv_id is a conversation of its own. Other columns are
    ignored; texts of any length stay whole; an empty table gives no rows. A conversation, that of null ids too, is one row of
    the result and so of one task.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    sorted_turns = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    # try_element_at(0) is an error, so the array gets a first element that is never read
    padded = sorted_turns.withColumn("turns", F.concat(F.array(F.struct(F.lit(None).cast(turns.schema["turn"].dataType).alias("turn"), F.lit(None).cast("string").alias("role"), F.lit("").alias("text"))), "turns"))

    def padded_piece(t: Column, i: Column) -> Column:
        return piece_at(t, F.try_element_at("turns", i + 1), F.try_element_at("turns", i + 3))

    def piece_at(t: Column, earlier: Column, later: Column) -> Column:
        joined = F.coalesce(earlier["role"] == t["role"], F.lit(False))
        before = F.when(joined, F.lit(NEXT)).otherwise(F.concat(F.lit(OPEN), escape_role(t["role"]), F.lit(CLOSE)))
        after = F.when(F.coalesce(later["role"] == t["role"], F.lit(False)), F.lit("")).otherwise(F.lit(END))
        return F.struct(t["role"].alias("role"), before.alias("before"), escape(t["text"]).alias("body"), after.alias("after"))

    pieces = padded.select("conv_id", F.transform(F.slice("turns", 2, F.size("turns")), padded_piece).alias("pieces"))
    span = "array<struct<start:long,end:long>>"
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(span).alias("spans"))

    def placed(acc: Column, p: Column) -> Column:
        begins = acc["at"] + F.char_length(p["before"])
        ends = begins + F.char_length(p["body"])
        own = F.struct(begins.cast("long").alias("start"), ends.cast("long").alias("end"))
        spans = F.when(p["role"] == trained_role, F.concat(acc["spans"], F.array(own))).otherwise(acc["spans"])
        return F.struct((ends + F.char_length(p["after"])).cast("long").alias("at"), spans.alias("spans"))

    formatted = F.array_join(F.transform("pieces", lambda p: F.concat(p["before"], p["body"], p["after"])), "")
    return pieces.select("conv_id", formatted.alias("formatted"), F.aggregate("pieces", start, placed)["spans"].alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role, text) and loss_texts, parsed from `formatted` and `loss_spans` alone."""
    blocks = F.slice(F.split("formatted", r"<\|end\|>"), 1, F.size(F.split("formatted", r"<\|end\|>")) - 1)

    def turns_of(block: Column) -> Column:
        close = F.instr(block, CLOSE)
        role = unescape_role(F.substring(block, F.lit(3), close - 3))
        body = F.substring(block, close + 2, F.char_length(block))
        return F.transform(F.split(body, r"<\|next\|>"), lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    masked = F.transform("loss_spans", lambda s: unescape(F.substring("formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return formatted.select("conv_id", "formatted", F.flatten(F.transform(blocks, turns_of)).alias("turns"), masked.alias("loss_texts"))

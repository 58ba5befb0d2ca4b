"""Flattening of structs and generators over delimited and array columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import ColumnOrName, as_column
from .skew import stored

# --- fixed values: layout of opening hours and attribute strings ---
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
OPEN_HOUR = r"^(\d+):\d+-"
CLOSE_HOUR = r"-(\d+):\d+$"
TRUTHY = r"(?i)true"
# A bare token, optionally quoted and prefixed the Python-2 way: u'average' -> average
TOKEN = r"^(?:u?')?(\w+)'?$"


def hour_columns(hours: str, days: Sequence[str] = WEEKDAYS) -> list[Column]:
    """``mon_open, mon_close, ...`` as ints from ``"9:0-22:30"`` strings, NULL if absent."""
    out = []
    for day in days:
        text = F.col(f"{hours}.{day}")
        short = day[:3].lower()
        for name, pattern in ((f"{short}_open", OPEN_HOUR), (f"{short}_close", CLOSE_HOUR)):
            out.append(F.regexp_extract(text, pattern, 1).try_cast("int").alias(name))
    return out


def flatten_hours(df: DataFrame, hours: str = "hours", days: Sequence[str] = WEEKDAYS) -> DataFrame:
    """Replace the hours struct by its open/close hour columns, in one projection."""
    kept = [F.col(c) for c in df.columns if c != hours]
    return df.select(*kept, *hour_columns(hours, days))


def flag(value: Column) -> Column:
    """Python-style truth text as boolean; NULL is false."""
    return F.coalesce(value.rlike(TRUTHY), F.lit(False))


def one_of(value: Column, options: Sequence[str], default: str = "none") -> Column:
    """The first option contained in the text."""
    found = [F.when(value.contains(option), F.lit(option)) for option in options]
    return F.coalesce(*found, F.lit(default))


def token(value: Column) -> Column:
    """The bare word inside optional quotes; empty text when absent."""
    return F.regexp_extract(F.coalesce(value, F.lit("")), TOKEN, 1)


def integer(value: Column) -> Column:
    return value.try_cast("int")


# Output column -> (attribute field, how to read it)
ATTRIBUTE_SPEC = {
    "price_range": ("RestaurantsPriceRange2", integer),
    "wifi": ("WiFi", lambda v: one_of(v, ("free", "paid"))),
    "outdoor_seating": ("OutdoorSeating", flag),
    "has_tv": ("HasTV", flag),
    "delivery": ("RestaurantsDelivery", flag),
    "takeout": ("RestaurantsTakeOut", flag),
    "reservations": ("RestaurantsReservations", flag),
    "good_for_kids": ("GoodForKids", flag),
    "alcohol": ("Alcohol", lambda v: one_of(v, ("full_bar", "beer_and_wine"))),
    "noise_level": ("NoiseLevel", token),
    "attire": ("RestaurantsAttire", token),
}


def attribute_columns(attributes: str, spec: Mapping = ATTRIBUTE_SPEC) -> list[Column]:
    return [read(F.col(f"{attributes}.{field}")).alias(name) for name, (field, read) in spec.items()]


def flatten_attributes(df: DataFrame, attributes: str = "attributes", spec: Mapping = ATTRIBUTE_SPEC) -> DataFrame:
    """Replace the attribute struct by typed columns, in one projection."""
    kept = [F.col(c) for c in df.columns if c != attributes]
    return df.select(*kept, *attribute_columns(attributes, spec))


def split_items(text: ColumnOrName, separator: str = ",") -> Column:
    """Trimmed non-blank items of a delimited string; an empty array for NULL."""
    parts = F.split(F.coalesce(as_column(text), F.lit("")), separator)
    return F.filter(F.transform(parts, lambda item: F.trim(item)), lambda item: item != "")


def explode_delimited(
    df: DataFrame, keys: Sequence[str], text: str, out: str, separator: str = ",", distinct: bool = True
) -> DataFrame:
    """G1: one row per key and distinct item of a delimited string.

    Repeated items are removed inside the row's own array, so no shuffle is
    needed as long as ``keys`` identify the row.
    """
    items = split_items(text, separator)
    if distinct:
        items = F.array_distinct(items)
    return df.select(*keys, F.explode(items).alias(out))


def explode_events(
    df: DataFrame, keys: Sequence[str], text: str, out: str, total: str, ordinal: str, separator: str = ","
) -> DataFrame:
    """One row per event of a packed string, with its position and the packed total.

    The total is taken from the array before the explode, so the explode guard
    can compare it with the rows that come out.
    """
    events = split_items(text, separator)
    packed = df.select(*keys, events.alias("_events"))
    return packed.select(
        *keys, F.size("_events").alias(total), F.posexplode("_events").alias(ordinal, out)
    )


def explode_wide_events(
    df: DataFrame,
    keys: Sequence[str],
    text: str,
    out: str,
    total: str,
    ordinal: str,
    separator: str = ",",
    chunk_chars: int = 1 << 20,
) -> DataFrame:
    """G2 for strings too long for one task: the rows of :func:`explode_events`, in two levels.

    A string is first cut, where it is read, into chunks of about ``chunk_chars`` characters that end at a separator; the chunks
    are stored and dealt out, and exploded by as many tasks as they need. Positions go on from the chunks before: items are
    counted per chunk, and one narrow row a chunk carries the sum of those before it and the packed total.
    ``separator`` is one character.
    """
    if len(separator) != 1:
        raise ValueError("separator is one character")
    mark = "\\" + separator if not separator.isalnum() else separator
    pattern = f"(?s).{{1,{chunk_chars}}}[^{mark}]*(?:{mark}|\\z)"
    lines = df.select(*keys, F.coalesce(as_column(text), F.lit("")).alias("_text")).withColumn("_line", F.monotonically_increasing_id())
    chunks = lines.select(*keys, "_line", F.posexplode(F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))).alias("_chunk", "_part"))
    chunks = stored(chunks.hint("rebalance", F.col("_line"), F.col("_chunk")))
    sizes = chunks.select("_line", "_chunk", F.size(split_items("_part", mark)).alias("_n"))
    before = Window.partitionBy("_line").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_line")
    placed = sizes.select("_line", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(whole).cast("int").alias(total))
    items = chunks.join(placed, ["_line", "_chunk"]).select(*keys, total, "_before", F.posexplode(split_items("_part", mark)).alias("_place", out))
    return items.select(*keys, total, (F.col("_before") + F.col("_place")).cast("int").alias(ordinal), out)


def cast_elements(array: ColumnOrName, element_type: str) -> Column:
    """Array with every element cast, bad elements becoming NULL; empty for a NULL array."""
    source = F.coalesce(as_column(array), F.array().cast("array<string>"))
    return F.transform(source, lambda item: item.try_cast(element_type))


def explode_array(df: DataFrame, keys: Sequence[str], array: str, out: str, element_type: str) -> DataFrame:
    """One row per key and castable array element."""
    elements = F.filter(cast_elements(array, element_type), lambda item: item.isNotNull())
    return df.select(*keys, F.explode(elements).alias(out))

"""Bronze sources: newline-delimited JSON with an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

# --- fixed values: field names and types of the six source files ---
_ATTRIBUTES = (
    "RestaurantsPriceRange2 string, WiFi string, OutdoorSeating string, HasTV string, "
    "RestaurantsDelivery string, RestaurantsTakeOut string, RestaurantsReservations string, "
    "GoodForKids string, Alcohol string, NoiseLevel string, RestaurantsAttire string"
)
_HOURS = (
    "Monday string, Tuesday string, Wednesday string, Thursday string, Friday string, "
    "Saturday string, Sunday string"
)
COMPLIMENTS = (
    "compliment_hot", "compliment_more", "compliment_profile", "compliment_cute", "compliment_list",
    "compliment_note", "compliment_plain", "compliment_cool", "compliment_funny", "compliment_writer",
    "compliment_photos",
)
SCHEMAS = {
    "business": (
        "business_id string, name string, address string, city string, state string, postal_code string, "
        "latitude double, longitude double, stars double, review_count int, is_open int, categories string, "
        f"attributes struct<{_ATTRIBUTES.replace(' string', ':string')}>, "
        f"hours struct<{_HOURS.replace(' string', ':string')}>"
    ),
    "user": (
        "user_id string, name string, member_since string, review_count int, average_stars double, fans int, "
        "useful int, funny int, cool int, friends array<string>, elite array<string>, "
        + ", ".join(f"{name} int" for name in COMPLIMENTS)
    ),
    "review": (
        "review_id string, business_id string, user_id string, stars double, useful int, funny int, cool int, "
        "text string, date string"
    ),
    "checkin": "business_id string, date string",
    "tip": "business_id string, user_id string, text string, date string, compliment_count int",
    "photo": "photo_id string, business_id string, caption string, label string",
}
CORRUPT = "_corrupt_record"
EXTRA = "_extra"


def bronze_path(base: str, entity: str) -> str:
    return f"{base.rstrip('/')}/{entity}.json"


def read_bronze(
    spark: SparkSession,
    base: str,
    entity: str,
    rename: dict[str, str] | None = None,
    keep_corrupt: bool = False,
    keep_extra: bool = False,
) -> DataFrame:
    """One JSON object per line, read with the declared schema.

    The declared schema saves the inference pass over the files, turns fields
    absent from a load into NULL and limits parsing to the columns a query uses.
    ``rename`` maps a source field name to the declared one, for files that name
    a field differently, e.g. ``{"joined_on": "member_since"}``.
    ``keep_corrupt`` adds ``_corrupt_record`` with lines that are not valid JSON. ``keep_extra`` adds ``_extra``, a
    VARIANT object of a line's top-level fields that are not declared, NULL where there are none (see
    :func:`drift_report`). Lines are then read as text; those with such fields are parsed a second time.
    """
    rename = rename or {}
    declared = StructType.fromDDL(SCHEMAS[entity])
    unknown = set(rename.values()) - set(declared.names)
    if unknown:
        raise ValueError(f"{entity} has no field {', '.join(sorted(unknown))}")
    source_of = {field: source for source, field in rename.items()}
    fields = StructType([StructField(source_of.get(f.name, f.name), f.dataType) for f in declared])
    reader = spark.read
    if keep_corrupt:
        fields = fields.add(CORRUPT, "string")
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if keep_extra:
        df = _with_extra(spark.read.text(bronze_path(base, entity)), fields, keep_corrupt)
    else:
        df = reader.schema(fields).option("mode", "PERMISSIVE").json(bronze_path(base, entity))
    return df.withColumnsRenamed(rename)


def _with_extra(lines: DataFrame, fields: StructType, keep_corrupt: bool) -> DataFrame:
    options = {"mode": "PERMISSIVE", **({"columnNameOfCorruptRecord": CORRUPT} if keep_corrupt else {})}
    known = F.array(*[F.lit(f.name) for f in fields if f.name != CORRUPT])
    unknown = F.size(F.array_except(F.json_object_keys("value"), known)) > 0
    others = F.map_filter(F.from_json("value", "map<string,variant>"), lambda name, _: ~F.array_contains(known, name))
    extra = F.when(unknown, F.parse_json(F.to_json(others)))
    rows = lines.filter(F.trim("value") != "").select(F.from_json("value", fields, options).alias("r"), extra.alias(EXTRA))
    return rows.select("r.*", EXTRA)


def drift_report(df: DataFrame, entity: str) -> DataFrame:
    """(entity, field, row_count, type): fields outside the declared schema, with the type that holds all their values.

    ``df`` has ``_extra``. One pass; fields whose values differ in type come out as VARIANT.
    """
    each = df.sparkSession.sql(f"SELECT field.key AS field, field.value AS value FROM {{rows}}, LATERAL variant_explode({EXTRA}) AS field", rows=df.filter(F.col(EXTRA).isNotNull()).select(EXTRA))
    return each.groupBy("field").agg(F.count(F.lit(1)).alias("row_count"), F.schema_of_variant_agg("value").alias("type")).select(F.lit(entity).alias("entity"), "*")

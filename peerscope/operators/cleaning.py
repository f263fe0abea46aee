"""Contract-driven cleaners for the raw tables (PRJ1-PRJ9, STR1-STR7, JSN1, JON2, WIN1).

Each cleaner is one projection over an all-STRING raw frame (as read by
:func:`peerscope.sources.files.read_raw_csv`); text normalisation of label columns goes
through the distinct-value dictionary of :func:`peerscope.functions.text.normalize_columns`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peerscope.functions import text as T
from peerscope.operators.summaries import SUMMARY_METRICS


@dataclass(frozen=True)
class Field:
    name: str
    type: str  # integer | float | string | boolean | date | geojson
    nullable: bool = True
    source: tuple[str, ...] = ()


@dataclass(frozen=True)
class Contract:
    name: str
    primary_key: tuple[str, ...]
    fields: tuple[Field, ...]

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]


SPARK_TYPES = {"integer": "bigint", "float": "double", "string": "string", "boolean": "boolean", "date": "date",
               "geojson": "string"}

# Raw listing headers -> contract names, and the contract field order.
LISTING_RENAMES = {
    "Listings id": "listing_id", "Last year reviews": "reviews_last_twelve_months", "Host since": "host_since",
    "Host number of listings": "host_listing_count", "Neighbourhood": "neighbourhood_name",
    "Beds number": "beds_count", "Bedrooms number": "bedrooms_count", "Property type": "room_type",
    "Maximum allowed guests": "accommodates_count", "Price": "nightly_price", "Total reviews": "total_reviews",
    "Rating score": "rating_score", "Accuracy score": "accuracy_score", "Cleanliness score": "cleanliness_score",
    "Checkin score": "checkin_score", "Communication score": "communication_score",
    "Location score": "location_score", "Value for money score": "value_score",
    "Reviews per month": "reviews_per_month", "City": "city_name", "Season": "period_label",
    "Bathrooms number": "bathrooms_count", "Bathrooms type": "bathroom_type", "Date of scraping": "snapshot_date",
}
LISTING_FIELDS = (
    Field("listing_id", "integer", False), Field("reviews_last_twelve_months", "integer"), Field("host_since", "date"),
    Field("is_superhost", "boolean"), Field("host_listing_count", "integer"), Field("neighbourhood_name", "string"),
    Field("beds_count", "integer"), Field("bedrooms_count", "integer"), Field("room_type", "string"),
    Field("accommodates_count", "integer"), Field("nightly_price", "float"), Field("total_reviews", "integer"),
    Field("rating_score", "float"), Field("accuracy_score", "float"), Field("cleanliness_score", "float"),
    Field("checkin_score", "float"), Field("communication_score", "float"), Field("location_score", "float"),
    Field("value_score", "float"), Field("reviews_per_month", "float"), Field("city_name", "string", False),
    Field("period_label", "string", False), Field("bathrooms_count", "float"), Field("bathroom_type", "string"),
    Field("latitude", "float"), Field("longitude", "float"), Field("snapshot_date", "date", False),
)
LISTING_CONTRACT = Contract("listing_snapshot", ("listing_id", "snapshot_date"), LISTING_FIELDS)
LISTING_TEXT_COLUMNS = ["city_name", "neighbourhood_name", "room_type", "bathroom_type"]


def _metric_fields() -> tuple[Field, ...]:
    out = []
    for m in SUMMARY_METRICS:
        out += [Field(f"{m}_median", "float", source=(f"{m}_median",)),
                Field(f"{m}_median_abs_deviation", "float", source=(f"{m}_median_abs_deviation",))]
    return tuple(out)


CITY_SUMMARY_CONTRACT = Contract(
    "city_period_summary", ("city_name", "period_label"),
    (Field("city_name", "string", False, ("place",)), Field("period_label", "string", False, ("period",)),
     Field("dominant_neighbourhood", "string", source=("neighbourhood_mode",)),
     Field("neighbourhood_entropy", "float", source=("neighbourhood_shannon_entropy",)),
     Field("dominant_room_type", "string", source=("room_type_mode",)),
     Field("room_type_entropy", "float", source=("room_type_shannon_entropy",))) + _metric_fields(),
)
NEIGHBOURHOOD_SUMMARY_CONTRACT = Contract(
    "neighbourhood_period_summary", ("city_name", "neighbourhood_name", "period_label"),
    (Field("city_name", "string", False, ("place",)), Field("neighbourhood_name", "string", False, ("neighbourhood",)),
     Field("period_label", "string", False, ("period",)),
     Field("dominant_room_type", "string", source=("room_type_mode",)),
     Field("room_type_entropy", "float", source=("room_type_shannon_entropy",))) + _metric_fields(),
)
REFERENCE_CONTRACT = Contract(
    "neighbourhood_reference", ("city_name", "neighbourhood_name"),
    (Field("city_name", "string", False), Field("neighbourhood_name", "string", False),
     Field("neighbourhood_group_name", "string")),
)
BOUNDARY_CONTRACT = Contract(
    "neighbourhood_boundary", ("boundary_id",),
    (Field("boundary_id", "string", False), Field("city_name", "string", False),
     Field("neighbourhood_name", "string", False), Field("neighbourhood_group_name", "string"),
     Field("geometry_type", "string", False), Field("geometry", "geojson", False)),
)


# Text that counts as a number or a date (Java's suffixes and trailing text do not).
NUMBER_TEXT = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"
DATE_TEXT = r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?\s*$"


def to_integer(col: Column) -> Column:
    """PRJ4: bad text -> NULL, half-even rounding, BIGINT."""
    return F.bround(to_float(col)).try_cast("bigint")


def to_float(col: Column) -> Column:
    """PRJ5: bad text -> NULL, NaN -> NULL (it is no NUMBER_TEXT)."""
    text = col.cast("string")
    return F.when(text.rlike(NUMBER_TEXT), F.trim(text)).try_cast("double")


def to_date(col: Column) -> Column:
    """PRJ6: bad text -> NULL (ISO date, optionally followed by a time)."""
    text = col.cast("string")
    day = F.when(text.rlike(DATE_TEXT), F.substring(F.trim(text), 1, 10))
    return F.call_function("try_to_date", day, F.lit("yyyy-MM-dd"))


def reorder_to_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """PRJ3: contract order; missing columns become typed NULLs."""
    return df.select(*[
        F.col(f.name).cast(SPARK_TYPES[f.type]).alias(f.name) if f.name in df.columns
        else F.lit(None).cast(SPARK_TYPES[f.type]).alias(f.name)
        for f in contract.fields
    ])


def clean_listing_snapshot(raw: DataFrame, contract: Contract = LISTING_CONTRACT) -> DataFrame:
    """PRJ7: rename, normalise labels, parse coordinates and flag, coerce types, reorder."""
    df = raw.withColumnsRenamed({k: v for k, v in LISTING_RENAMES.items() if k in raw.columns})
    text_cols = [c for c in LISTING_TEXT_COLUMNS + ["period_label"] if c in df.columns]
    extra = [c for c in ("Coordinates", "Host is superhost") if c in df.columns]
    df = T.normalize_columns(df, text_cols + extra)
    if "Coordinates" in df.columns:
        df = T.with_coordinates(df, "Coordinates")
    if "Host is superhost" in df.columns:
        df = df.withColumn("is_superhost", T.superhost_flag(F.col("Host is superhost")))
    if "city_name" in df.columns:
        df = df.withColumn("city_name", T.city_label(F.col("city_name")))
    if "period_label" in df.columns:
        df = df.withColumn("period_label", T.period_label(F.col("period_label")))
    for f in contract.fields:
        if f.name not in df.columns or f.name in ("latitude", "longitude", "is_superhost"):
            continue
        c = F.col(f.name)
        if f.type == "integer":
            df = df.withColumn(f.name, to_integer(c))
        elif f.type == "float":
            df = df.withColumn(f.name, to_float(c))
        elif f.type == "date":
            df = df.withColumn(f.name, to_date(c))
    return reorder_to_contract(df, contract)


def clean_grouped_summary(raw: DataFrame, contract: Contract) -> DataFrame:
    """PRJ8 (+PRJ2): rename single-source fields, canonical labels, text normalisation,
    numeric coercion of *_median / *_median_abs_deviation / *_entropy columns."""
    renames = {f.source[0]: f.name for f in contract.fields if len(f.source) == 1 and f.source[0] in raw.columns}
    df = raw.withColumnsRenamed(renames)
    texts = [c for c in df.columns if dict(df.dtypes)[c] == "string" and not _numeric_name(c)]
    df = T.normalize_columns(df, texts)
    if "city_name" in df.columns:
        df = df.withColumn("city_name", T.city_label(F.col("city_name")))
    if "period_label" in df.columns:
        df = df.withColumn("period_label", T.period_label(F.col("period_label")))
    for c in df.columns:
        if _numeric_name(c) and c not in ("city_name", "period_label"):
            df = df.withColumn(c, to_float(F.col(c)))
    return reorder_to_contract(df, contract)


def _numeric_name(c: str) -> bool:
    return c.endswith("_median") or c.endswith("_median_abs_deviation") or c.endswith("_entropy")


def clean_reference(raw: DataFrame) -> DataFrame:
    """PRJ9: rename, canonical city, normalised neighbourhood and group."""
    df = raw.withColumnsRenamed({"city": "city_name", "neighbourhood": "neighbourhood_name",
                                 "neighbourhood_group": "neighbourhood_group_name"})
    df = T.normalize_columns(df, ["city_name", "neighbourhood_name", "neighbourhood_group_name"])
    df = df.withColumn("city_name", T.city_label(F.col("city_name")))
    return reorder_to_contract(df, REFERENCE_CONTRACT)


def clean_boundaries(features: DataFrame, reference: DataFrame) -> DataFrame:
    """JON2 + WIN1 + JSN1: boundary features (raw_feature_index, neighbourhood,
    neighbourhood_group, geometry_type, geometry text) -> boundary table with ids.

    The reference is joined on the neighbourhood name only, keeping its first row per
    name (``ref_order`` gives that order; without it, by city and group); the group falls
    back to the reference's.
    Ids are slug(city)_slug(neighbourhood)[_slug(group)]_NNN, NNN numbering features
    that share a slug in feature order.
    """
    f = T.normalize_columns(features, ["neighbourhood", "neighbourhood_group"])
    f = f.withColumnsRenamed({"neighbourhood": "neighbourhood_name", "neighbourhood_group": "_own_group"})
    order = F.col("ref_order") if "ref_order" in reference.columns else F.struct("city_name", "neighbourhood_group_name")
    ref = (
        reference.withColumn("_o", order)
        .withColumn("_rn", F.row_number().over(Window.partitionBy("neighbourhood_name").orderBy("_o")))
        .where("_rn = 1")
        .select("neighbourhood_name", "city_name", F.col("neighbourhood_group_name").alias("_ref_group"))
    )
    j = f.join(ref, "neighbourhood_name", "left").withColumn(
        "neighbourhood_group_name", F.coalesce("_own_group", "_ref_group")
    )
    j = T.slug_columns(j, {"city_name": "_s_city", "neighbourhood_name": "_s_nb", "neighbourhood_group_name": "_s_gr"})
    base = T.boundary_base_slug(F.col("_s_city"), F.col("_s_nb"), F.col("neighbourhood_group_name"), F.col("_s_gr"))
    j = j.withColumn("_slug", base)
    ordinal = F.row_number().over(Window.partitionBy("_slug").orderBy("raw_feature_index"))
    j = j.withColumn("boundary_id", F.concat(F.col("_slug"), F.lit("_"), F.format_string("%03d", ordinal)))
    if "geometry" in j.columns:
        j = j.withColumn("geometry", T.canonical_json(F.col("geometry")))
    return reorder_to_contract(j, BOUNDARY_CONTRACT)

"""Raw-data profiling (TYP1, TYP2, AGG18-AGG21): per-field statistics of an all-STRING
frame, candidate-key duplicates and label coverage, each as one distributed aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peerscope.functions.scalars import attach_one_row
from peerscope.functions.text import collapse_types, primitive_type

UNIQUE_SAMPLE_LIMIT = 20
SAMPLE_SIZE = 5


def field_profile(df: DataFrame, order_by: str, categorical_hints: tuple[str, ...] = ()) -> DataFrame:
    """AGG18: one row per field of ``df`` (values read as trimmed text).

    ``order_by`` fixes the input order used for "first seen" samples.  The frame is
    unpivoted to (field, ordinal, text); distinct values are counted per field, and the
    first five distinct values are those with the smallest first ordinal (a per-field
    top-k, pre-limited before the shuffle).
    """
    fields = df.columns
    long = df.select(
        F.col(order_by).alias("_ord"),
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("field"), F.trim(F.col(f"`{c}`").cast("string")).alias("text")) for c in fields
        ])).alias("_v"),
    ).select("_ord", "_v.field", "_v.text")
    present = F.col("text").isNotNull() & (F.col("text") != "")
    stats = long.groupBy("field").agg(
        F.count_if(present).alias("non_empty_count"),
        F.count_if(~present | F.col("text").isNull()).alias("null_count"),
        F.collect_set(primitive_type(F.col("text"))).alias("_types"),
        F.countDistinct(F.when(present, F.col("text"))).alias("_distinct"),
    )
    first_seen = long.where(present).groupBy("field", "text").agg(F.min("_ord").alias("_first"))
    w = Window.partitionBy("field").orderBy("_first", "text")
    samples = (
        first_seen.withColumn("_rk", F.row_number().over(w))
        .where(F.col("_rk") <= SAMPLE_SIZE)
        .groupBy("field")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rk", "text"))), lambda s: s["text"]), "|").alias("sample_values"))
    )
    inferred = collapse_types(F.col("_types"))
    truncated = F.col("_distinct") > UNIQUE_SAMPLE_LIMIT
    out = stats.join(samples, "field", "left").select(
        "field",
        inferred.alias("inferred_type"),
        (F.col("null_count") > 0).alias("nullable"),
        "non_empty_count",
        "null_count",
        F.coalesce("sample_values", F.lit("")).alias("sample_values"),
        (F.col("field").isin(list(categorical_hints)) | ((inferred == "string") & ~truncated)).alias("likely_categorical"),
        F.col("_distinct").alias("unique_values_observed"),
        truncated.alias("unique_values_truncated"),
    )
    return out


def candidate_keys(df: DataFrame, key_sets: list[list[str]]) -> DataFrame:
    """AGG19: per key set, rows minus distinct blank-stripped key tuples."""
    parts = []
    for keys in key_sets:
        k = F.struct(*[F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")).alias(c) for c in keys])
        parts.append(df.agg((F.count(F.lit(1)) - F.countDistinct(k)).alias("duplicate_key_count")).select(
            F.lit(",".join(keys)).alias("columns"), "duplicate_key_count",
            (F.col("duplicate_key_count") == 0).alias("is_unique")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def coverage(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """AGG20: sorted distinct non-blank values per coverage kind ({kind: column}), '|'-joined."""
    aggs = []
    for kind, c in columns.items():
        t = F.trim(F.col(c).cast("string"))
        aggs.append(F.array_join(F.array_sort(F.collect_set(F.when(t != "", t))), "|").alias(kind))
    return df.agg(*aggs)


def geojson_profile(features: DataFrame, properties: str = "properties") -> DataFrame:
    """AGG21: one row per property of a feature frame: feature count, sorted geometry types, and the
    property's inferred type, non-empty and null counts (a feature without the property counts as null)."""
    whole = features.agg(
        F.count(F.lit(1)).alias("feature_count"),
        F.array_join(F.array_sort(F.collect_set("geometry_type")), "|").alias("geometry_types"),
    )
    if properties not in features.columns:
        return whole
    value = F.trim(F.col("value"))
    present = F.col("value").isNotNull() & (value != "")
    per = features.select(F.explode(properties).alias("property", "value")).groupBy("property").agg(
        F.count_if(present).alias("non_empty_count"),
        collapse_types(F.collect_set(primitive_type(value))).alias("inferred_type"),
    )
    return attach_one_row(per, whole).withColumn("null_count", F.col("feature_count") - F.col("non_empty_count"))

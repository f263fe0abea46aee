"""Price-decision record and serving queries (DEC3-DEC6, FLT2, FLT3, TOP4, TOP5, AGG31, JSN2, PRJ12).

The reference answers one listing per call; here a *requests* table goes in and a
decisions table comes out, so every step is a join or a projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DateType, DoubleType, FloatType, StructType, TimestampType

from peerscope.functions.scalars import attach_one_row
from peerscope.operators.benchmark import positioning_label
from peerscope.roles import Roles

# Fixed values of the decision payload.
PRIMARY_DECISION_SIGNAL = "benchmark_range"
DECISION_POLICY = "benchmark_led_positioning"
DECISION_SIGNAL_SUMMARY = (
    "The benchmark range is the primary decision signal. "
    "The model price estimate is retained as a supporting signal."
)
MODEL_ESTIMATE_ROLE = "supporting_signal"
AGREEMENT_MEDIUM_MAX_RATIO = 0.25
INSIDE_SUMMARY = "Model estimate sits inside the benchmark range."
BROWSE_DEFAULT_LIMIT = 25
BROWSE_MAX_LIMIT = 100


def _with_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach a one-row table to every row (scalar subquery, no join)."""
    return attach_one_row(df, one_row)


def model_estimate_interval(df: DataFrame, estimate: str, calibration: DataFrame | None) -> DataFrame:
    """DEC3: estimate + residual quantiles, always containing the estimate, lower >= 0.

    ``calibration`` is a one-row table (``interval_calibration``) or None.
    """
    est = F.col(estimate).cast("double")
    if calibration is None:
        return df.select(
            "*",
            est.alias("model_estimate_lower_bound"),
            est.alias("model_estimate_upper_bound"),
            F.lit(None).cast("double").alias("model_estimate_interval_confidence_level"),
            F.lit("unavailable").alias("model_estimate_interval_source"),
        )
    cal = calibration.select(
        F.col("lower_residual_quantile").alias("_lq"), F.col("upper_residual_quantile").alias("_uq"),
        F.col("confidence_level").alias("_lvl"), F.col("source").alias("_src"),
    )
    j = _with_one_row(df, cal)
    raw_lo, raw_hi = est + F.col("_lq"), est + F.col("_uq")
    return j.select(
        *df.columns,
        F.greatest(F.lit(0.0), F.least(raw_lo, raw_hi, est)).alias("model_estimate_lower_bound"),
        F.greatest(raw_lo, raw_hi, est).alias("model_estimate_upper_bound"),
        F.col("_lvl").alias("model_estimate_interval_confidence_level"),
        F.col("_src").alias("model_estimate_interval_source"),
    )


def model_benchmark_agreement(estimate: Column, lower: Column, upper: Column) -> list[Column]:
    """DEC4: strong inside the range, else medium/weak by gap / max(width, 1)."""
    inside = (lower <= estimate) & (estimate <= upper)
    below = estimate < lower
    gap = F.when(inside, F.lit(0.0)).when(below, lower - estimate).otherwise(estimate - upper)
    ratio = F.when(inside, F.lit(0.0)).otherwise(gap / F.greatest(upper - lower, F.lit(1.0)))
    label = F.when(inside, F.lit("strong")).when(ratio <= AGREEMENT_MEDIUM_MAX_RATIO, F.lit("medium")).otherwise(F.lit("weak"))
    note = F.when(label == "medium", F.lit("close to")).otherwise(F.lit("far from"))
    direction = F.when(below, F.lit("below")).otherwise(F.lit("above"))
    summary = F.when(inside, F.lit(INSIDE_SUMMARY)).otherwise(
        F.concat(F.lit("Model estimate is "), note, F.lit(" the benchmark range and sits "), direction, F.lit(" it."))
    )
    return [
        label.alias("model_benchmark_agreement_label"),
        gap.alias("model_benchmark_gap_amount"),
        ratio.alias("model_benchmark_gap_ratio"),
        summary.alias("model_benchmark_agreement_summary"),
    ]


def resolve_requests(frame: DataFrame, requests: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """FLT3 + TOP4: each request (entity, optional snapshot) -> the matching row, or the
    entity's latest snapshot when no date is given; ``status`` is 'found' / 'not_found'."""
    r = roles
    latest = frame.groupBy(r.entity).agg(F.max(r.snapshot).alias("_latest"))
    req = requests.select(F.col(r.entity).alias("request_id"), F.col(r.snapshot).alias("request_date"))
    resolved = req.join(latest, req.request_id == latest[r.entity], "left").select(
        "request_id", "request_date", F.coalesce("request_date", "_latest").alias("_date")
    )
    rows = frame.select(*r.key).withColumn("_hit", F.lit(True))
    out = resolved.join(
        rows, (resolved.request_id == rows[r.entity]) & (resolved["_date"] == rows[r.snapshot]), "left"
    )
    return out.select(
        "request_id", "request_date",
        F.col(r.entity), F.col(r.snapshot),
        F.when(F.col("_hit"), F.lit("found")).otherwise(F.lit("not_found")).alias("status"),
    )


def decision_records(
    targets: DataFrame,
    ranges: DataFrame,
    estimates: DataFrame,
    calibration: DataFrame | None,
    models: DataFrame,
    roles: Roles = Roles(),
) -> DataFrame:
    """DEC5 (flat part): range, label, model interval, agreement and the fixed policy fields.

    ``estimates`` has (entity, snapshot, estimated_market_price); ``ranges`` comes from
    ``benchmark_ranges``; ``models`` is the one-row champion choice.
    """
    r = roles
    rng = ranges.select(*r.key, "benchmark_lower_bound", "benchmark_upper_bound", "benchmark_source", "fallback_used")
    t = targets.select(*r.key, r.city, r.period, F.col(r.price).cast("double").alias(r.price))
    j = t.join(rng, r.key).join(estimates.select(*r.key, "estimated_market_price"), r.key, "left")
    j = _with_one_row(model_estimate_interval(j, "estimated_market_price", calibration), models)
    est = F.col("estimated_market_price").cast("double")
    lo, hi = F.col("benchmark_lower_bound"), F.col("benchmark_upper_bound")
    return j.select(
        *r.key, r.city, r.period, r.price,
        F.lit(PRIMARY_DECISION_SIGNAL).alias("primary_decision_signal"),
        F.lit(DECISION_POLICY).alias("decision_policy"),
        F.lit(DECISION_SIGNAL_SUMMARY).alias("decision_signal_summary"),
        "benchmark_lower_bound", "benchmark_upper_bound",
        positioning_label(F.col(r.price), lo, hi).alias("price_positioning_label"),
        "benchmark_source",
        est.alias("estimated_market_price"),
        "model_estimate_lower_bound", "model_estimate_upper_bound",
        "model_estimate_interval_confidence_level", "model_estimate_interval_source",
        F.lit(MODEL_ESTIMATE_ROLE).alias("model_estimate_role"),
        *model_benchmark_agreement(est, lo, hi),
        "champion_model_name",
        "fallback_model_name",
        "fallback_used",
    )


def attach_comparables(records: DataFrame, comparables: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """DEC5 (nested part): ``selected_comparables`` as an array of structs in rank order,
    plus the comparable median price (AGG37, own price when there is none).  A target has
    at most top-N comparables, which bounds the array."""
    r = roles
    tkey = [f"target_{r.entity}", f"target_{r.snapshot}"]
    item = F.struct(
        F.col("comparable_rank"), F.col(r.entity), F.col(r.snapshot).cast("string").alias(r.snapshot),
        F.col(r.city), F.col(r.neighbourhood), F.col(r.category), F.col(r.price),
        F.col("distance_km"), F.col("similarity_score"), F.col("used_city_fallback"),
    )
    packed = comparables.groupBy(*tkey).agg(
        F.array_sort(F.collect_list(item)).alias("selected_comparables"),
        F.median(r.price).alias("_cmp_median"),
    )
    packed = packed.withColumnRenamed(tkey[0], r.entity).withColumnRenamed(tkey[1], r.snapshot)
    out = records.join(packed, r.key, "left")
    return out.withColumn(
        "selected_comparables", F.coalesce("selected_comparables", F.array().cast(packed.schema["selected_comparables"].dataType))
    ).withColumn("comparable_median_price", F.coalesce("_cmp_median", F.col(r.price))).drop("_cmp_median")


def attach_explanations(records: DataFrame, explained: DataFrame, source_model_name: str = "linear_baseline",
                        roles: Roles = Roles()) -> DataFrame:
    """DEC5: the struct ``local_explanation`` of source model, both driver lists and the comparable
    median price.  ``explained`` has the key, ``upward`` and ``downward`` (modeling.driver_lists)."""
    kind = "array<struct<feature:string,contribution:double>>"
    out = records.join(explained.select(*roles.key, "upward", "downward"), roles.key, "left")
    none = F.array().cast(kind)
    return out.withColumn("local_explanation", F.struct(
        F.lit(source_model_name).alias("source_model_name"),
        F.coalesce("upward", none).alias("top_upward_drivers"),
        F.coalesce("downward", none).alias("top_downward_drivers"),
        F.col("comparable_median_price").cast("double").alias("comparable_median_price"),
    )).drop("upward", "downward", "comparable_median_price")


def json_safe(col: Column, kind: DataType) -> Column:
    """JSN2: NaN -> NULL at every depth, dates as ISO text."""
    if isinstance(kind, (DoubleType, FloatType)):
        return F.when(~F.isnan(col), col)
    if isinstance(kind, (DateType, TimestampType)):
        return col.cast("string")
    if isinstance(kind, ArrayType):
        return F.transform(col, lambda x: json_safe(x, kind.elementType))
    if isinstance(kind, StructType):
        made = F.struct(*[json_safe(col[f.name], f.dataType).alias(f.name) for f in kind.fields])
        return F.when(col.isNotNull(), made)
    return col


def to_payload_json(records: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """JSN2: one JSON document per decision; dates as ISO text, NaN and NULL as null."""
    body = F.struct(*[json_safe(F.col(f.name), f.dataType).alias(f.name) for f in records.schema.fields])
    return records.select(*roles.key, F.to_json(body, {"ignoreNullFields": "false"}).alias("payload_json"))


def listing_browse(frame: DataFrame, roles: Roles = Roles(), city: str | None = None, period: str | None = None,
                   limit: int = BROWSE_DEFAULT_LIMIT, columns: list[str] | None = None) -> DataFrame:
    """FLT2 + TOP5 + PRJ12: optional filters, ordered page of at most ``limit`` (1..100) rows."""
    if not 1 <= limit <= BROWSE_MAX_LIMIT:
        raise ValueError(f"limit must be within 1..{BROWSE_MAX_LIMIT}")
    r = roles
    df = frame
    if city is not None:
        df = df.where(F.col(r.city) == city)
    if period is not None:
        df = df.where(F.col(r.period) == period)
    cols = columns or df.columns
    return df.select(*cols).orderBy(r.city, r.period, r.entity, r.snapshot).limit(limit)


def serving_metadata(frame: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """AGG31: row count and the sorted distinct cities / periods (as '|'-joined text)."""
    r = roles
    return frame.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.array_join(F.array_sort(F.collect_set(r.city)), "|").alias("cities"),
        F.array_join(F.array_sort(F.collect_set(r.period)), "|").alias("periods"),
    )

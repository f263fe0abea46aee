"""Grouped split and evaluation of any prediction column (MLT1, SET1, MTH5, AGG32-AGG36,
SMP1, MLT8, MLT11).

All metrics are aggregations over a *scored* table (target, prediction and slice columns),
so they work for any model, including Spark ML pipelines (``model.transform``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerscope.functions.scalars import attach_one_row
from peerscope.operators.benchmark import positioning_label
from peerscope.operators.quantiles import exact_quantiles
from peerscope.roles import Roles
from peerscope.session import cut_lineage

# Fixed values of the reference's training configuration.
RANDOM_STATE = 42
TRAIN_SIZE = 0.70
VALIDATION_SIZE = 0.15
INTERVAL_CONFIDENCE = 0.80
INTERVAL_SOURCE = "heldout_residual_quantiles"
CHAMPION_MAE_IMPROVEMENT = 0.05
CHAMPION_CITY_TOLERANCE = 0.10
PRICE_BANDS = ["lower", "middle", "upper"]
FORBIDDEN_TRAINING_SUBSTRINGS = ["nightly_price_median", "nightly_price_median_abs_deviation", "price_median",
                                 "price_positioning"]


def split_bucket(entity: Column, seed: int = RANDOM_STATE) -> Column:
    """A reproducible uniform number in [0, 1) per entity: first 32 bits of md5(id:seed)."""
    digest = F.md5(F.concat(entity.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def group_split(frame: DataFrame, roles: Roles = Roles(), seed: int = RANDOM_STATE,
                train: float = TRAIN_SIZE, validation: float = VALIDATION_SIZE) -> DataFrame:
    """MLT1: adds ``split`` in {train, validation, test}; all rows of an entity share it."""
    u = split_bucket(F.col(roles.entity), seed)
    return frame.withColumn(
        "split",
        F.when(u < train, F.lit("train")).when(u < train + validation, F.lit("validation")).otherwise(F.lit("test")),
    )


def restrict_to(frame: DataFrame, entities: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """JON10: rows of ``frame`` whose entity appears in ``entities`` (a left semi join; the
    entity list is never collected)."""
    ids = entities.select(F.col(roles.entity)).where(F.col(roles.entity).isNotNull())
    return frame.join(ids, roles.entity, "left_semi")


def refit_rows(split_frame: DataFrame) -> DataFrame:
    """SET1: train and validation rows together, for the final refit."""
    return split_frame.where(F.col("split") == "train").unionByName(split_frame.where(F.col("split") == "validation"))


def leakage_findings(columns: list[str]) -> list[str]:
    """MLT11: feature names that contain a forbidden price-aggregate substring."""
    out = []
    for c in columns:
        low = c.lower()
        for bad in FORBIDDEN_TRAINING_SUBSTRINGS:
            if bad in low:
                out.append(f"Feature `{c}` contains forbidden substring `{bad}`.")
                break
    return out


def with_errors(scored: DataFrame, target: str, prediction: str = "prediction") -> DataFrame:
    """MTH5: absolute error and absolute percentage error (NULL unless target > 0)."""
    err = F.abs(F.col(target) - F.col(prediction))
    return scored.withColumn("absolute_error", err).withColumn(
        "absolute_percentage_error", F.when(F.col(target) > 0, err / F.col(target))
    )


def model_metrics(scored: DataFrame, target: str, prediction: str = "prediction") -> DataFrame:
    """AGG32: MAE, RMSE and MAPE (percent, over rows with a percentage error)."""
    e = with_errors(scored, target, prediction)
    return e.agg(
        F.avg("absolute_error").alias("mae"),
        F.sqrt(F.avg(F.pow(F.col(target) - F.col(prediction), 2))).alias("rmse"),
        (F.avg("absolute_percentage_error") * 100).alias("mape"),
        F.count(F.lit(1)).alias("row_count"),
    )


def sliced_mae(scored: DataFrame, target: str, slices: list[str], prediction: str = "prediction") -> DataFrame:
    """AGG33: MAE per value of each slice column, as a long table (slice, value, mae)."""
    e = with_errors(scored, target, prediction)
    stacked = e.select(
        "absolute_error",
        F.explode(F.array(*[F.struct(F.lit(s).alias("slice"), F.col(s).cast("string").alias("value")) for s in slices])).alias("_s"),
    )
    return (
        stacked.where(F.col("_s.value").isNotNull())
        .groupBy(F.col("_s.slice").alias("slice"), F.col("_s.value").alias("value"))
        .agg(F.avg("absolute_error").alias("mae"), F.count(F.lit(1)).alias("row_count"))
    )


def price_bands(scored: DataFrame, target: str) -> DataFrame:
    """AGG34: terciles of the target; (lo, hi] bands with the first one closed."""
    edges = exact_quantiles(scored, target, [1.0 / 3.0, 2.0 / 3.0], out="_e").select("_e")
    j = attach_one_row(scored, edges)
    x, e1, e2 = F.col(target), F.col("_e")[0], F.col("_e")[1]
    band = (
        F.when(x.isNull(), F.lit(None))
        .when(x <= e1, F.lit(PRICE_BANDS[0]))
        .when(x <= e2, F.lit(PRICE_BANDS[1]))
        .otherwise(F.lit(PRICE_BANDS[2]))
    )
    return j.withColumn("price_band", band).drop("_e")


def interval_calibration(scored: DataFrame, target: str, prediction: str = "prediction",
                         confidence: float = INTERVAL_CONFIDENCE) -> DataFrame:
    """AGG35: residual quantiles at (1-c)/2 and 1-(1-c)/2 and their empirical coverage."""
    c = min(max(float(confidence), 0.01), 0.99)
    tail = (1.0 - c) / 2.0
    res = scored.select(F.col(target).cast("double").alias("_y"), F.col(prediction).cast("double").alias("_p")).withColumn(
        "_r", F.col("_y") - F.col("_p")
    )
    q = exact_quantiles(res, "_r", [tail, 1.0 - tail], out="_q").select("_q")
    j = attach_one_row(res, q)
    inside = (F.col("_y") >= F.col("_p") + F.col("_q")[0]) & (F.col("_y") <= F.col("_p") + F.col("_q")[1])
    cover = j.agg(F.avg(inside.cast("double")).alias("empirical_coverage_rate"))
    return attach_one_row(cover, q).select(
        F.lit(INTERVAL_SOURCE).alias("source"),
        F.lit(c).alias("confidence_level"),
        F.col("_q")[0].alias("lower_residual_quantile"),
        F.col("_q")[1].alias("upper_residual_quantile"),
        "empirical_coverage_rate",
    )


def benchmark_diagnostics(ranges: DataFrame, predictions: DataFrame, roles: Roles = Roles(),
                          prediction: str = "prediction") -> DataFrame:
    """AGG36 over every scored target (no sample): inside-range rate, label agreement rate
    and MAE per observed label, as a long table (metric, key, value)."""
    r = roles
    j = ranges.join(predictions.select(*r.key, prediction), r.key)
    lo, hi = F.col("benchmark_lower_bound"), F.col("benchmark_upper_bound")
    j = j.select(
        positioning_label(F.col(r.price), lo, hi).alias("observed"),
        positioning_label(F.col(prediction), lo, hi).alias("predicted"),
        F.abs(F.col(r.price) - F.col(prediction)).alias("absolute_error"),
    )
    # the joined rows are read once: all figures come from the sums of at most nine pairs of labels
    sums = cut_lineage(j.groupBy("observed", "predicted").agg(
        F.count(F.lit(1)).alias("n"), F.sum("absolute_error").alias("e"), F.count("absolute_error").alias("k")), "label-sums")

    def share(of: Column) -> Column:
        return F.sum(F.when(of, F.col("n")).otherwise(F.lit(0))) / F.sum("n")

    rates = sums.agg(
        share(F.col("predicted") == "aligned").alias("inside"), share(F.col("predicted") == F.col("observed")).alias("agree")
    ).select(
        F.explode(F.array(
            F.struct(F.lit("model_prediction_inside_benchmark_rate").alias("metric"), F.col("inside").alias("value")),
            F.struct(F.lit("model_positioning_agreement_rate").alias("metric"), F.col("agree").alias("value")),
        )).alias("s")
    ).select(F.col("s.metric").alias("metric"), F.lit(None).cast("string").alias("key"), F.col("s.value").alias("value"))
    by_label = sums.groupBy("observed").agg(F.try_divide(F.sum("e"), F.sum("k")).alias("value")).select(
        F.lit("benchmark_positioning_mae").alias("metric"), F.col("observed").alias("key"), "value"
    )
    return rates.unionByName(by_label)


def champion_choice(metrics: DataFrame, baseline: str, improvement: float = CHAMPION_MAE_IMPROVEMENT,
                    city_tolerance: float = CHAMPION_CITY_TOLERANCE) -> DataFrame:
    """MLT8 over a long metrics table (model, slice, value, mae): ``slice = 'overall'`` rows
    carry each model's MAE, ``slice = 'city_name'`` rows the per-city MAE.

    A challenger is eligible when its MAE <= baseline x (1 - improvement) and no city of
    the baseline is missing or worse than baseline x (1 + tolerance); the eligible one with
    the lowest MAE wins, else the baseline.  Fallback: the baseline when a challenger wins,
    otherwise the best other model.
    """
    overall = metrics.where(F.col("slice") == "overall").select("model", "mae")
    city = metrics.where(F.col("slice") == "city_name").select("model", F.col("value").alias("city"), "mae")
    base_city = city.where(F.col("model") == baseline).select("city", F.col("mae").alias("_bc"))
    # A challenger keeps every baseline city within tolerance <=> its count of such cities
    # equals the baseline's city count (a missing city is simply not counted).
    kept = (
        city.where(F.col("model") != baseline)
        .join(base_city, "city")
        .where(F.col("mae") <= F.col("_bc") * (1.0 + city_tolerance))
        .groupBy("model")
        .agg(F.count(F.lit(1)).alias("_kept"))
    )
    ref = _one_row(
        overall.where(F.col("model") == baseline).select(F.col("mae").alias("_base")),
        base_city.agg(F.count(F.lit(1)).alias("_cities")),
    )
    others = overall.where(F.col("model") != baseline)
    eligible = (
        _attach(others.join(kept, "model", "left"), ref)
        .where((F.coalesce("_kept", F.lit(0)) == F.col("_cities")) & (F.col("mae") <= F.col("_base") * (1.0 - improvement)))
    )
    winner = eligible.agg(F.min_by("model", F.struct("mae", "model")).alias("_w"))
    best_other = others.agg(F.min_by("model", F.struct("mae", "model")).alias("_o"))
    return _attach(winner, best_other).select(
        F.coalesce("_w", F.lit(baseline)).alias("champion_model_name"),
        F.when(F.col("_w").isNotNull(), F.lit(baseline)).otherwise(F.col("_o")).alias("fallback_model_name"),
    )


def _attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach a one-row table to every row of ``df`` (scalar subquery, no join)."""
    return attach_one_row(df, one_row)


def _one_row(a: DataFrame, b: DataFrame) -> DataFrame:
    return _attach(a, b)

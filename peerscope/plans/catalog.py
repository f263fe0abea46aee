"""Registered queries: each is a Spark DataFrame builder over the driver's tables plus
(where SQL can express it) the DuckDB oracle text that must return the same rows.

Every query reads whole tables; nothing is sampled or capped except where the cap is
the feature itself (a top-k report, a page of listings).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.plans import oracle as sql
from peerscope.roles import ComparableSearch, Roles
from peerscope.session import cut_lineage
from peerscope.sources import testdata


def market_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bound listing table, written once to the checkpoint folder (read many times)."""
    return cut_lineage(testdata.market_frame(spark, sf_dir))


def sparse_market_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_lineage(testdata.sparse_market_frame(spark, sf_dir))

DIGITS = 6


@dataclass
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None = None
    doubles: list[str] = field(default_factory=list)

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(spark, sf_dir)
        return df.select(*[F.round(c, DIGITS).alias(c) if c in self.doubles else F.col(c) for c in df.columns])

    def oracle_sql(self) -> str | None:
        return None if self.oracle is None else sql.rounded(self.oracle, self.doubles, DIGITS)


REGISTRY: dict[str, Query] = {}


def register(name: str, oracle: str | None = None, doubles: list[str] | tuple = ()):
    def deco(fn):
        REGISTRY[name] = Query(fn, oracle, list(doubles))
        return fn

    return deco


# Sparse binding: summary tables that lack these named groups, so that every rung is reached.
SPARSE_NB_LEFT_OUT = "neighbourhood_name IN ('NATION_0', 'NATION_1', 'NATION_2')"
SPARSE_CT_LEFT_OUT = "city_name = 'AFRICA'"
ROLES = Roles()

# ---------------------------------------------------------------- comparables / benchmark
from peerscope.operators.benchmark import benchmark_ranges, price_positioning  # noqa: E402
from peerscope.operators.comparables import comparable_lists, listed, select_comparables  # noqa: E402
from peerscope.operators.summaries import city_period_summary, neighbourhood_period_summary, price_summaries  # noqa: E402

COMP_DOUBLES = ["nightly_price", "distance_km", "similarity_score"]


@register("comparables_topn", sql.comparables_sql(sql.MARKET), COMP_DOUBLES)
def q_comparables_topn(spark, d):
    return select_comparables(market_frame(spark, d))


@register("comparables_sparse", sql.comparables_sql(sql.SPARSE_MARKET), COMP_DOUBLES)
def q_comparables_sparse(spark, d):
    return select_comparables(sparse_market_frame(spark, d))


@register("comparables_grid", sql.comparables_sql(sql.MARKET), COMP_DOUBLES)
def q_comparables_grid(spark, d):
    """The large-pool search on its own: every pool is cut into cells."""
    return select_comparables(market_frame(spark, d), ROLES, ComparableSearch(direct_pool_limit=0))


@register("medians_bucketed", sql.med_mad_sql(sql.MARKET, ["city_name", "period_label"], sql.SUMMARY_METRICS_BOUND),
          sql._stat_cols(sql.SUMMARY_METRICS_BOUND))
def q_medians_bucketed(spark, d):
    """The large-group quantiles on their own: every group is narrowed by sketch, counts and brackets."""
    from peerscope.operators.summaries import median_and_mad

    return median_and_mad(market_frame(spark, d), ["city_name", "period_label"], sql.SUMMARY_METRICS_BOUND, "narrowed")


SUMMARY_DOUBLES = ["neighbourhood_entropy", "room_type_entropy"] + sql._stat_cols(sql.SUMMARY_METRICS_BOUND)


@register("city_period_summary", sql.city_summary_sql(sql.MARKET), SUMMARY_DOUBLES)
def q_city_period_summary(spark, d):
    return city_period_summary(market_frame(spark, d))


@register("neighbourhood_period_summary", sql.neighbourhood_summary_sql(sql.MARKET),
          [c for c in SUMMARY_DOUBLES if c != "neighbourhood_entropy"])
def q_neighbourhood_period_summary(spark, d):
    return neighbourhood_period_summary(market_frame(spark, d))


RANGE_DOUBLES = ["nightly_price", "benchmark_lower_bound", "benchmark_upper_bound"]


def _ranges(m: DataFrame, top_n: int = 10, nb_left_out: str = "FALSE", ct_left_out: str = "FALSE") -> DataFrame:
    comps = comparable_lists(m, ROLES, ComparableSearch(top_n=top_n))
    nb, ct = price_summaries(m)
    return benchmark_ranges(m, comps, nb.where(f"NOT ({nb_left_out})"), ct.where(f"NOT ({ct_left_out})"))


@register("benchmark_range", sql.benchmark_sql(sql.MARKET), RANGE_DOUBLES)
def q_benchmark_range(spark, d):
    return _ranges(market_frame(spark, d))


@register("benchmark_range_sparse",
          sql.benchmark_sql(sql.SPARSE_MARKET, nb_left_out=SPARSE_NB_LEFT_OUT, ct_left_out=SPARSE_CT_LEFT_OUT),
          RANGE_DOUBLES)
def q_benchmark_range_sparse(spark, d):
    return _ranges(sparse_market_frame(spark, d), nb_left_out=SPARSE_NB_LEFT_OUT, ct_left_out=SPARSE_CT_LEFT_OUT)


@register("benchmark_range_iqr", sql.benchmark_sql(sql.MARKET, top_n=20), RANGE_DOUBLES)
def q_benchmark_range_iqr(spark, d):
    return _ranges(market_frame(spark, d), top_n=20)


@register("price_positioning", sql.benchmark_sql(sql.MARKET, with_label=True), RANGE_DOUBLES)
def q_price_positioning(spark, d):
    return price_positioning(_ranges(market_frame(spark, d)))


# ---------------------------------------------------------------- features
from peerscope.operators import decisions as dec  # noqa: E402
from peerscope.operators import eda  # noqa: E402
from peerscope.operators import evaluation as ev  # noqa: E402
from peerscope.operators import features as feat  # noqa: E402
from peerscope.plans import oracle_reports as rep  # noqa: E402


def _model_input(spark, d):
    return feat.model_input(market_frame(spark, d), testdata.neighbourhood_reference(spark, d),
                            max_price=rep.MAX_PRICE, zone_city=rep.ZONE_CITY)


def _feature_frame(spark, d):
    m = _model_input(spark, d)
    # the binding has columns for some of the features only; the distances are derived
    bound = [c for c in feat.model_feature_columns() if c in m.columns or c.startswith("distance_to_")]
    return cut_lineage(feat.feature_frame(m, features=bound), "feature_frame")


@register("model_input", rep.MODEL_INPUT, ["nightly_price", "rating_score", "latitude", "longitude"])
def q_model_input(spark, d):
    return _model_input(spark, d)


@register("model_input_profile", rep.MODEL_INPUT_PROFILE, ["null_rate_after_join"])
def q_model_input_profile(spark, d):
    return feat.model_input_profile(market_frame(spark, d), testdata.neighbourhood_reference(spark, d),
                                    max_price=rep.MAX_PRICE, zone_city=rep.ZONE_CITY)


@register("feature_frame", rep.FEATURE_FRAME,
          ["nightly_price", "rating_score", "latitude", "longitude", "distance_to_city_center_km",
           "distance_to_neighbourhood_center_km"])
def q_feature_frame(spark, d):
    return _feature_frame(spark, d)


# ---------------------------------------------------------------- EDA
@register("rows_by_city", rep.ROWS_BY_CITY)
def q_rows_by_city(spark, d):
    return eda.rows_by_city(market_frame(spark, d))


@register("rows_by_city_period", rep.ROWS_BY_CITY_PERIOD)
def q_rows_by_city_period(spark, d):
    return eda.rows_by_city_and_period(market_frame(spark, d))


@register("room_type_share", rep.ROOM_TYPE_SHARE, ["share"])
def q_room_type_share(spark, d):
    return eda.room_type_share(market_frame(spark, d))


@register("median_by_city", rep.median_by(["city_name"]), ["median_nightly_price"])
def q_median_by_city(spark, d):
    return eda.median_price_by(market_frame(spark, d), ["city_name"])


@register("median_by_city_period", rep.MEDIAN_BY_CITY_PERIOD, rep.PERIODS)
def q_median_by_city_period(spark, d):
    return eda.median_price_by_city_and_period(market_frame(spark, d))


@register("median_by_room_type", rep.median_by(["room_type"]), ["median_nightly_price"])
def q_median_by_room_type(spark, d):
    return eda.median_price_by(market_frame(spark, d), ["room_type"])


@register("median_by_band", rep.MEDIAN_BY_BAND, ["median_nightly_price"])
def q_median_by_band(spark, d):
    return eda.median_price_by_capacity_band(market_frame(spark, d))


@register("price_extremes", rep.PRICE_EXTREMES, ["median_nightly_price"])
def q_price_extremes(spark, d):
    return eda.neighbourhood_price_extremes(market_frame(spark, d))


@register("price_extremes_display", rep.PRICE_EXTREMES_DISPLAY, ["median_nightly_price"])
def q_price_extremes_display(spark, d):
    return eda.extremes_in_display_order(eda.neighbourhood_price_extremes(market_frame(spark, d)))


@register("reference_cardinality", rep.REFERENCE_CARDINALITY)
def q_reference_cardinality(spark, d):
    """JON1's check on a reference table that the market has at a finer grain (by room type and capacity)."""
    finer = ["city_name", "neighbourhood_name", "room_type", "accommodates_count"]
    return feat.repeated_reference_keys(market_frame(spark, d).select(*finer).distinct())


@register("price_histogram", rep.PRICE_HISTOGRAM, ["bin_lower", "bin_upper"])
def q_price_histogram(spark, d):
    return eda.price_histogram(market_frame(spark, d))


@register("price_boxplot", rep.PRICE_BOXPLOT, ["q1", "median", "q3", "lower_whisker", "upper_whisker"])
def q_price_boxplot(spark, d):
    return eda.price_boxplot(market_frame(spark, d))


@register("heatmap_scale", rep.HEATMAP_SCALE, ["min_value", "max_value"])
def q_heatmap_scale(spark, d):
    return eda.heatmap_scale(market_frame(spark, d))


@register("data_profile", rep.DATA_PROFILE, ["value"])
def q_data_profile(spark, d):
    return eda.data_profile(market_frame(spark, d))


# ---------------------------------------------------------------- evaluation
def _split_frame(spark, d):
    return ev.group_split(_feature_frame(spark, d))


def _predict(split_frame: DataFrame, keys: list[str], rows: DataFrame | None = None) -> DataFrame:
    """Baseline predictor of the binding: train-split median price per group, else the train median.
    The medians come from ``split_frame`` and go to ``rows`` (the same ones unless given)."""
    from peerscope.functions.scalars import attach_one_row
    from peerscope.operators.quantiles import exact_median

    # written: every pass of the medians reads the columns it needs, and none computes the split again
    train = cut_lineage(split_frame.where(F.col("split") == "train").select(*keys, "nightly_price"), "train")
    per_group = exact_median(train, "nightly_price", keys, "_g")
    overall = exact_median(train, "nightly_price", None, "_all")
    j = attach_one_row((split_frame if rows is None else rows).join(per_group, keys, "left"), overall)
    return j.withColumn("prediction", F.coalesce("_g", "_all")).drop("_g", "_all")


def _scored(spark, d, keys=rep.BASE_KEYS):
    return _predict(_split_frame(spark, d), keys).where(F.col("split") == "test")


@register("group_split", rep.GROUP_SPLIT)
def q_group_split(spark, d):
    return _split_frame(spark, d).select("listing_id", "snapshot_date", "split")


@register("model_metrics", rep.MODEL_METRICS, ["mae", "rmse", "mape"])
def q_model_metrics(spark, d):
    return ev.model_metrics(_scored(spark, d), "nightly_price")


@register("sliced_mae", rep.SLICED_MAE, ["mae"])
def q_sliced_mae(spark, d):
    return ev.sliced_mae(_scored(spark, d), "nightly_price", ["city_name", "period_label", "room_type"])


@register("price_band_mae", rep.PRICE_BAND_MAE, ["mae"])
def q_price_band_mae(spark, d):
    banded = ev.price_bands(_scored(spark, d), "nightly_price")
    return ev.sliced_mae(banded, "nightly_price", ["price_band"]).select(
        F.col("value").alias("price_band"), "mae", "row_count")


@register("interval_calibration", rep.CALIBRATION,
          ["confidence_level", "lower_residual_quantile", "upper_residual_quantile", "empirical_coverage_rate"])
def q_interval_calibration(spark, d):
    return ev.interval_calibration(_scored(spark, d), "nightly_price")


def _fm_ranges(spark, d, fm: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    comps = comparable_lists(fm, ROLES, ComparableSearch(), targets=targets)
    t = fm if targets is None else targets
    return benchmark_ranges(t, comps, *price_summaries(fm))


@register("benchmark_diagnostics", rep.BENCHMARK_DIAGNOSTICS, ["value"])
def q_benchmark_diagnostics(spark, d):
    fm = _feature_frame(spark, d)
    scored = cut_lineage(_predict(ev.group_split(fm), rep.BASE_KEYS).where(F.col("split") == "test"), "scored")
    ranges = _fm_ranges(spark, d, fm, scored.drop("split", "prediction"))
    return ev.benchmark_diagnostics(ranges, scored)


def _predictions(split_frame: DataFrame) -> DataFrame:
    """Every model's prediction beside the rows (``pred_<model>``), written once."""
    out = split_frame
    for name, keys in rep.MODELS.items():
        out = _predict(split_frame, keys, out).withColumnRenamed("prediction", f"pred_{name}")
    return cut_lineage(out, "predictions")


def _metrics_long(predictions: DataFrame) -> DataFrame:
    """(model, slice, value, mae) of all models on the test rows, from one grouped sum of errors."""
    test = predictions.where(F.col("split") == "test")
    models = F.array(*[F.struct(F.lit(n).alias("model"), F.col(f"pred_{n}").alias("p")) for n in rep.MODELS])
    sums = test.select("city_name", "nightly_price", F.explode(models).alias("m")).groupBy(
        F.col("m.model").alias("model"), "city_name"
    ).agg(F.sum(F.abs(F.col("nightly_price") - F.col("m.p"))).alias("e"), F.count("m.p").alias("n"))
    city = sums.where(F.col("city_name").isNotNull()).select(
        "model", F.lit("city_name").alias("slice"), F.col("city_name").alias("value"), (F.col("e") / F.col("n")).alias("mae"))
    overall = sums.groupBy("model").agg((F.sum("e") / F.sum("n")).alias("mae")).select(
        "model", F.lit("overall").alias("slice"), F.lit(None).cast("string").alias("value"), "mae")
    return overall.unionByName(city)


@register("champion_choice", rep.CHAMPION_CHOICE)
def q_champion_choice(spark, d):
    return ev.champion_choice(_metrics_long(_predictions(_split_frame(spark, d))), rep.BASELINE_MODEL)


# ---------------------------------------------------------------- decisions
@register("model_interval", rep.MODEL_INTERVAL,
          ["estimated_market_price", "model_estimate_lower_bound", "model_estimate_upper_bound",
           "model_estimate_interval_confidence_level"])
def q_model_interval(spark, d):
    scored = cut_lineage(_scored(spark, d), "scored")
    cal = ev.interval_calibration(scored, "nightly_price")
    out = dec.model_estimate_interval(
        scored.select("listing_id", "snapshot_date", F.col("prediction").cast("double").alias("estimated_market_price")),
        "estimated_market_price", cal)
    return out


@register("model_agreement", rep.MODEL_AGREEMENT,
          ["estimated_market_price", "benchmark_lower_bound", "benchmark_upper_bound", "model_benchmark_gap_amount",
           "model_benchmark_gap_ratio"])
def q_model_agreement(spark, d):
    fm = _feature_frame(spark, d)
    scored = cut_lineage(_predict(ev.group_split(fm), rep.BASE_KEYS).where(F.col("split") == "test"), "scored")
    ranges = _fm_ranges(spark, d, fm, scored.drop("split", "prediction"))
    j = scored.select("listing_id", "snapshot_date", F.col("prediction").cast("double").alias("estimated_market_price")).join(
        ranges.select("listing_id", "snapshot_date", "benchmark_lower_bound", "benchmark_upper_bound"),
        ["listing_id", "snapshot_date"])
    return j.select("*", *dec.model_benchmark_agreement(
        F.col("estimated_market_price"), F.col("benchmark_lower_bound"), F.col("benchmark_upper_bound")))


DECISION_DOUBLES = ["nightly_price", "benchmark_lower_bound", "benchmark_upper_bound", "estimated_market_price",
                    "model_estimate_lower_bound", "model_estimate_upper_bound", "model_estimate_interval_confidence_level",
                    "model_benchmark_gap_amount", "model_benchmark_gap_ratio"]


def _decisions(spark, d) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    fm = _feature_frame(spark, d)
    split = ev.group_split(fm)
    req = dec.resolve_requests(fm, testdata.listing_requests(spark, d))
    found = cut_lineage(req.where(F.col("status") == "found").select("listing_id", "snapshot_date").join(
        fm, ["listing_id", "snapshot_date"]), "targets")
    comps = cut_lineage(comparable_lists(fm, ROLES, ComparableSearch(), targets=found), "comparables")
    ranges = benchmark_ranges(found, comps, *price_summaries(fm))
    predictions = _predictions(split)
    base = F.col("pred_" + next(n for n, keys in rep.MODELS.items() if list(keys) == list(rep.BASE_KEYS)))
    estimates = predictions.select("listing_id", "snapshot_date", base.alias("estimated_market_price"))
    scored = predictions.where(F.col("split") == "test").withColumn("prediction", base)
    cal = ev.interval_calibration(scored, "nightly_price")
    models = cut_lineage(ev.champion_choice(_metrics_long(predictions), rep.BASELINE_MODEL), "champion")
    records = dec.decision_records(found, ranges, estimates, cal, models)
    return req, records, listed(comps), fm


@register("price_decisions", rep.PRICE_DECISIONS, DECISION_DOUBLES)
def q_price_decisions(spark, d):
    req, records, _, _ = _decisions(spark, d)
    return req.select("request_id", "request_date", "status", "listing_id", "snapshot_date").join(
        records, ["listing_id", "snapshot_date"], "left")


# A fixed coefficient table, so that SQL can check the explanation arithmetic.
FIXED_TERMS = [
    ("accommodates_count", None, 12.5, 3.0, 1.5, 2.0), ("rating_score", None, -7.25, 4.0, 0.5, 4.5),
    ("latitude", None, 3.0, 45.0, 10.0, 44.0), ("longitude", None, -2.0, 10.0, 5.0, 11.0),
    ("distance_to_city_center_km", None, -1.5, 2000.0, 1000.0, 1500.0),
    ("room_type", "AUTOMOBILE", 9.0, 0.0, 1.0, "BUILDING"), ("room_type", "BUILDING", -4.0, 0.0, 1.0, "BUILDING"),
    ("room_type", "FURNITURE", 2.5, 0.0, 1.0, "BUILDING"), ("is_superhost", "true", 6.0, 0.0, 1.0, "false"),
    ("is_superhost", "false", -6.0, 0.0, 1.0, "false"), ("season_peak_flag", "true", 5.5, 0.0, 1.0, "false"),
]


def _fixed_terms():
    from peerscope.operators.modeling import LinearTerm

    return [LinearTerm(*t) for t in FIXED_TERMS]


@register("price_decision_payload", rep.decision_payload_sql(FIXED_TERMS), ["comparable_median_price"])
def q_price_decision_payload(spark, d):
    """The nested record and its JSON text, read back as flat columns: comparables in rank order,
    driver lists, comparable median, and whether a NaN is left in the text."""
    from peerscope.operators.modeling import driver_lists

    _, records, comps, frame = _decisions(spark, d)
    full = cut_lineage(dec.attach_explanations(dec.attach_comparables(records, comps), driver_lists(frame, _fixed_terms())), "payload")
    # only what is read from the text is joined back, and sorted: its size can't be told from the columns' types
    text = dec.to_payload_json(full).select(
        "listing_id", "snapshot_date", F.col("payload_json").contains("NaN").alias("has_nan"),
        (F.get_json_object("payload_json", "$.local_explanation.source_model_name") == "linear_baseline").alias("in_json"))
    out = full.join(text.hint("merge"), ["listing_id", "snapshot_date"])

    def names(col):
        return F.array_join(F.transform(col, lambda x: x["feature"]), "|")

    ids = F.transform("selected_comparables", lambda c: F.concat_ws("@", c["listing_id"].cast("string"), c["snapshot_date"]))
    return out.select(
        "listing_id", "snapshot_date", F.array_join(ids, "|").alias("comparables"),
        names(F.col("local_explanation.top_upward_drivers")).alias("upward_drivers"),
        names(F.col("local_explanation.top_downward_drivers")).alias("downward_drivers"),
        F.col("local_explanation.comparable_median_price").alias("comparable_median_price"),
        F.col("local_explanation.source_model_name").alias("source_model_name"),
        "has_nan", "in_json",
    )


@register("listing_browse", rep.LISTING_BROWSE, ["nightly_price", "rating_score", "latitude", "longitude"])
def q_listing_browse(spark, d):
    return dec.listing_browse(_model_input(spark, d), city="EUROPE")


@register("serving_metadata", rep.SERVING_METADATA)
def q_serving_metadata(spark, d):
    return dec.serving_metadata(_feature_frame(spark, d))


# ---------------------------------------------------------------- cleaning, profiling, validation
from peerscope.functions import text as txt  # noqa: E402
from peerscope.operators import cleaning as cl  # noqa: E402
from peerscope.operators import profiling as prof  # noqa: E402
from peerscope.operators import validation as val  # noqa: E402
from peerscope.sources import files  # noqa: E402
from peerscope.operators.boosting import ordered_statistics  # noqa: E402
from peerscope.session import ensure_checkpoint_dir  # noqa: E402


@register("coerce_types", rep.COERCE_TYPES, ["nightly_price", "rating_score", "latitude", "longitude"])
def q_coerce_types(spark, d):
    return cl.clean_listing_snapshot(testdata.raw_listing_export(market_frame(spark, d)))


@register("slug", rep.SLUG)
def q_slug(spark, d):
    part = testdata.table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    out = txt.slug_columns(part, {"p_name": "name_slug", "p_brand": "brand_slug", "p_type": "type_slug"})
    return out.select("p_partkey", "name_slug", "brand_slug", "type_slug")


@register("clean_text", rep.CLEAN_TEXT)
def q_clean_text(spark, d):
    """STR1 over every whole document (its characters have no compatibility forms, so SQL's NFC will do)."""
    docs = testdata.table(spark, d, "documents").select("doc_id", "text")
    out = txt.normalize_columns(docs.withColumn("clean_text", F.col("text")), ["clean_text"])
    return out.select("doc_id", "clean_text", F.length("clean_text").alias("clean_chars"))


@register("canonical_json", rep.CANONICAL_JSON)
def q_canonical_json(spark, d):
    ev_ = testdata.table(spark, d, "events")
    return ev_.select("event_id", txt.canonical_json(F.col("props")).alias("props_json"))


@register("boundary_ids", rep.BOUNDARY_IDS)
def q_boundary_ids(spark, d):
    ref = testdata.neighbourhood_reference(spark, d)
    return cl.clean_boundaries(testdata.boundary_features(spark, d), ref)


@register("field_profile", rep.FIELD_PROFILE)
def q_field_profile(spark, d):
    return prof.field_profile(testdata.table(spark, d, "events"), order_by="event_id")


@register("candidate_keys", rep.CANDIDATE_KEYS)
def q_candidate_keys(spark, d):
    return prof.candidate_keys(testdata.table(spark, d, "events"), [["event_id"], ["user_id", "event_type"]])


@register("coverage", rep.COVERAGE)
def q_coverage(spark, d):
    return prof.coverage(market_frame(spark, d),
                         {"cities": "city_name", "periods": "period_label", "snapshot_dates": "snapshot_date"})


def _missing_columns(contract: cl.Contract, own: list[str]) -> list[str]:
    """Contract columns that the binding's summary lacks: ``own`` and the bound statistics are there."""
    have = {*own, "city_name", "period_label", "dominant_room_type", "room_type_entropy",
            *sql._stat_cols(sql.SUMMARY_METRICS_BOUND)}
    return [n for n in contract.names if n not in have]


VALIDATED = ["listing_snapshot", "city_period_summary", "neighbourhood_period_summary", "neighbourhood_reference",
             "neighbourhood_boundary"]
VALIDATION_SQL = rep.validation_sql(
    _missing_columns(cl.CITY_SUMMARY_CONTRACT, ["dominant_neighbourhood", "neighbourhood_entropy"]),
    _missing_columns(cl.NEIGHBOURHOOD_SUMMARY_CONTRACT, ["neighbourhood_name"]),
)


def _manifest(df: DataFrame, name: str, columns: list[str]) -> DataFrame:
    return df.agg(F.lit(name).alias("dataset_name"), F.count(F.lit(1)).alias("row_count"), F.lit("|".join(columns)).alias("columns"))


@register("validation_findings", VALIDATION_SQL)
def q_validation_findings(spark, d):
    """All five tables.  The listing comes with the manifest of another table (the market without repeated
    keys), the boundaries with their own."""
    raw = cut_lineage(testdata.market_frame(spark, d, dedupe=False), "bound")
    listing = cut_lineage(cl.clean_listing_snapshot(testdata.raw_listing_export(raw)), "listing")
    market = cut_lineage(testdata.one_per_snapshot(raw))
    ref = testdata.neighbourhood_reference(spark, d)
    boundaries = cut_lineage(cl.clean_boundaries(testdata.boundary_features(spark, d), ref), "boundaries")
    tables = dict(zip(VALIDATED, (
        (listing, cl.LISTING_CONTRACT),
        (city_period_summary(market), cl.CITY_SUMMARY_CONTRACT),
        (neighbourhood_period_summary(market), cl.NEIGHBOURHOOD_SUMMARY_CONTRACT),
        (ref, cl.REFERENCE_CONTRACT),
        (boundaries, cl.BOUNDARY_CONTRACT),
    )))
    manifests = {"listing_snapshot": _manifest(market, "listing_export", market.columns),
                 "neighbourhood_boundary": _manifest(boundaries, "neighbourhood_boundary", boundaries.columns)}
    return val.validate(tables, manifests=manifests).unionByName(val.cross_dataset_findings(boundaries, ref))


@register("validation_status", rep.validation_status_sql(VALIDATION_SQL, VALIDATED))
def q_validation_status(spark, d):
    """AGG29: passed or failed for each of the five tables and for all of them."""
    return val.validation_status(cut_lineage(q_validation_findings(spark, d), "findings"), VALIDATED)


@register("file_manifest")
def q_file_manifest(spark, d):
    """SRC7 over every table file of the fixture (rows-only: content hashes need the bytes)."""
    return files.file_manifest(spark, d, "*.parquet")


@register("sink_roundtrip", sql.rounded(sql.MARKET, []), ["nightly_price", "rating_score", "latitude", "longitude"])
def q_sink_roundtrip(spark, d):
    """SNK1 write (Parquet + CSV + manifest), then SRC6 read-back of the CSV with the contract."""
    m = market_frame(spark, d)
    root = ensure_checkpoint_dir(spark).rstrip("/") + "/peerscope/sink-" + __import__("uuid").uuid4().hex
    files.write_processed(m, "market", root, ["orders", "customer", "nation", "region", "lineitem"],
                          sort_keys=["listing_id", "snapshot_date"])
    contract = cl.Contract("market", ("listing_id", "snapshot_date"), tuple(
        cl.Field(f.name, {"bigint": "integer", "double": "float", "date": "date", "boolean": "boolean"}.get(
            f.dataType.simpleString(), "string")) for f in m.schema.fields))
    return files.read_csv_with_contract(spark, f"{root}/csv/market", contract)


# ---------------------------------------------------------------- modelling (rows-only checks)
from peerscope.operators import modeling as mdl  # noqa: E402

NUMERIC = ["accommodates_count", "beds_count", "bedrooms_count", "rating_score", "latitude", "longitude",
           "host_tenure_days", "distance_to_city_center_km", "distance_to_neighbourhood_center_km"]
CATEGORICAL = ["room_type", "is_superhost", "season_peak_flag", "season_shoulder_flag", "venezia_group_name"]
RICH = ["city_name", "period_label", "neighbourhood_name"]


def _splits(spark, d):
    s = cut_lineage(ev.group_split(_feature_frame(spark, d)), "split")
    problems = ev.leakage_findings(NUMERIC + CATEGORICAL)  # MLT11 guard
    if problems:
        raise ValueError("; ".join(problems))
    return s.where("split = 'train'"), s.where("split = 'validation'"), s.where("split = 'test'")


def _linear(spark, d):
    """The linear learner, fitted to training and validation rows as a final fit is (SET1)."""
    train, valid, test = _splits(spark, d)
    return mdl.fit_linear(train.unionByName(valid), "nightly_price", NUMERIC, CATEGORICAL), test


@register("linear_model")
def q_linear_model(spark, d):
    m, test = _linear(spark, d)
    return mdl.evaluation_record(m.name, m.predict(test), "nightly_price")


@register("tree_model")
def q_tree_model(spark, d):
    train, valid, test = _splits(spark, d)
    m = mdl.fit_boosting(train.unionByName(valid), "nightly_price", NUMERIC, CATEGORICAL)
    return mdl.evaluation_record(m.name, m.predict(test), "nightly_price")


@register("categorical_model")
def q_categorical_model(spark, d):
    train, valid, test = _splits(spark, d)
    m = mdl.fit_boosting(train.unionByName(valid), "nightly_price", NUMERIC, CATEGORICAL + RICH, mdl.BASE_CANDIDATES[0],
                         encode="ordered", name="catboost_challenger")
    return mdl.evaluation_record(m.name, m.predict(test), "nightly_price")


@register("ordered_statistics", rep.ORDERED_STATISTICS)
def q_ordered_statistics(spark, d):
    """MLT4: each training row's categories as the mean price (thousandths of a cent) of the rows before it in the hash order."""
    train, _, _ = _splits(spark, d)
    columns = ["room_type", "neighbourhood_name", "is_superhost"]
    cents = train.withColumn("_cents", F.round(F.col("nightly_price") * 100))
    out = ordered_statistics(cents, "_cents", columns, ["listing_id", "snapshot_date"], prior=rep.ORDERED_PRIOR,
                             block_rows=2_000)
    names = dict(zip(columns, ("room_type_value", "neighbourhood_value", "superhost_value")))
    return out.select("listing_id", "snapshot_date", *[F.floor(F.col(f"_ts_{c}") * 1000.0).cast("long").alias(n) for c, n in names.items()])


@register("tuned_model")
def q_tuned_model(spark, d):
    """MLT5: search the whole candidate grid on validation, refit the winner on train+validation
    (SET1), report the search table and the refit model's test metrics."""
    train, valid, test = _splits(spark, d)
    best, table = mdl.validation_search(train, valid, "nightly_price", NUMERIC, CATEGORICAL + RICH)
    refit = mdl.fit_boosting(ev.refit_rows(train.unionByName(valid)), "nightly_price", NUMERIC, CATEGORICAL + RICH, best,
                             encode="ordered", name="catboost_tuned")
    met = ev.model_metrics(refit.predict(test), "nightly_price").select(
        F.col("mae").alias("test_mae"), F.col("rmse").alias("test_rmse"))
    from peerscope.functions.scalars import attach_one_row

    return attach_one_row(table, met)


@register("training_run")
def q_training_run(spark, d):
    """MLT7, MLT10, MLT12: leak guard, three fits (one searched over the whole grid), evaluation records with
    importance and benchmark diagnostics, champion; saved as a bundle and read back: its record, the champion's and
    the fallback's names, and the test error of the champion that was loaded from the bundle again."""
    split = cut_lineage(ev.group_split(_feature_frame(spark, d)), "split")
    test = split.where("split = 'test'")
    ranges = cut_lineage(_fm_ranges(spark, d, split.drop("split"), test.drop("split")), "ranges")
    run = mdl.train_models(split, "nightly_price", NUMERIC, CATEGORICAL, RICH, benchmark_ranges=ranges)
    path = ensure_checkpoint_dir(spark).rstrip("/") + "/peerscope/bundle-" + __import__("uuid").uuid4().hex
    mdl.save_training_bundle(run, path, "v1", "nightly_price")
    again = mdl.load_bundle_model(spark, path)
    met = ev.model_metrics(again.predict(test), "nightly_price")
    meta = spark.read.parquet(f"{path}/metadata")
    reloaded = met.select(F.lit(again.name).alias("model"), F.lit("mae_of_the_reloaded_champion").alias("metric"),
                          F.lit(None).cast("string").alias("slice"), F.col("mae").alias("value"))
    names = meta.select(F.explode(F.array(*[
        F.struct(F.col(f"{role}_model_name").alias("model"), F.lit(role).alias("metric")) for role in ("champion", "fallback")
    ])).alias("s")).select("s.model", "s.metric", F.lit(None).cast("string").alias("slice"), F.lit(None).cast("double").alias("value"))
    return spark.read.parquet(f"{path}/record").unionByName(names).unionByName(reloaded)


@register("permutation_importance")
def q_permutation_importance(spark, d):
    m, test = _linear(spark, d)
    return mdl.permutation_importance(m, test, "nightly_price", NUMERIC + CATEGORICAL)


@register("local_explanation", rep.local_explanation_sql(FIXED_TERMS), ["contribution"])
def q_local_explanation(spark, d):
    """EXP1 + TOP3 for every listing, with a fixed coefficient table."""
    return mdl.local_explanations(_feature_frame(spark, d), _fixed_terms(), ["listing_id", "snapshot_date"],
                                  zone_city=rep.ZONE_CITY)


@register("model_explanation")
def q_model_explanation(spark, d):
    """EXP1 + TOP3 for every listing, with the terms of the fitted linear model."""
    m, _ = _linear(spark, d)
    frame = _feature_frame(spark, d)
    terms = mdl.linear_terms(m, frame, NUMERIC, CATEGORICAL)
    return mdl.local_explanations(frame, terms, ["listing_id", "snapshot_date"], zone_city=rep.ZONE_CITY)


@register("model_bundle")
def q_model_bundle(spark, d):
    """MLT12: save the linear model and its calibration/metric metadata; read the metadata back."""
    m, test = _linear(spark, d)
    scored = m.predict(test)
    from peerscope.functions.scalars import attach_one_row

    meta = attach_one_row(ev.interval_calibration(scored, "nightly_price"), ev.model_metrics(scored, "nightly_price")).select(
        F.lit(m.name).alias("model_name"), F.lit(",".join(m.features)).alias("feature_columns"), "*")
    path = ensure_checkpoint_dir(spark).rstrip("/") + "/peerscope/bundle-" + __import__("uuid").uuid4().hex
    return mdl.save_bundle(m, path, meta)

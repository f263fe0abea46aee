"""Model input and feature frame (JON1, DAT1, DAT2, CND1, FLT1, AGG30, SRT1, AGG1, JON3,
JON4, DED1, PRJ10, PRJ11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peerscope.functions.geo import haversine_km
from peerscope.operators.quantiles import wide_quantiles
from peerscope.roles import Roles

# Fixed values of the feature registry (names and order as in the reference contracts).
TARGET_COLUMN = "nightly_price"
IDENTIFIER_COLUMNS = ["listing_id", "snapshot_date", "city_name", "period_label", "neighbourhood_name"]
NUMERIC_MODEL_FEATURES = [
    "accommodates_count", "beds_count", "bedrooms_count", "bathrooms_count", "host_listing_count",
    "total_reviews", "reviews_last_twelve_months", "reviews_per_month", "rating_score", "accuracy_score",
    "cleanliness_score", "checkin_score", "communication_score", "location_score", "value_score",
    "latitude", "longitude", "host_tenure_days", "distance_to_city_center_km",
    "distance_to_neighbourhood_center_km",
]
CATEGORICAL_MODEL_FEATURES = [
    "room_type", "bathroom_type", "is_superhost", "season_peak_flag", "season_shoulder_flag", "venezia_group_name",
]
RICH_CATEGORICAL_FEATURES = ["city_name", "period_label", "neighbourhood_name"]
PEAK_PERIODS = ["Early Summer", "Early Autumn"]
SHOULDER_PERIODS = ["Early Spring", "Early Winter"]
MAX_MODELING_NIGHTLY_PRICE = 1500.0
ZONE_CITY = "Venezia"


def model_feature_columns() -> list[str]:
    return [*NUMERIC_MODEL_FEATURES, *CATEGORICAL_MODEL_FEATURES]


def rich_feature_columns(include_local_market_categoricals: bool = False) -> list[str]:
    """PRJ11: feature list of the categorical-aware learner, optionally with local-market columns."""
    cats = list(CATEGORICAL_MODEL_FEATURES)
    if include_local_market_categoricals:
        cats += RICH_CATEGORICAL_FEATURES
    return [*NUMERIC_MODEL_FEATURES, *cats]


def joined_with_reference(listings: DataFrame, reference: DataFrame, roles: Roles = Roles(),
                          zone_city: str = ZONE_CITY) -> DataFrame:
    """JON1 + DAT1 + DAT2 + CND1 before the price filter (one output row per match)."""
    r = roles
    ref = reference.select(
        F.col(r.city).alias("_ref_city"), F.col(r.neighbourhood).alias("_ref_nbhd"),
        F.col("neighbourhood_group_name").alias("_ref_group"),
    )
    base = listings.drop("neighbourhood_group_name") if "neighbourhood_group_name" in listings.columns else listings
    cond = base[r.city].eqNullSafe(ref["_ref_city"]) & base[r.neighbourhood].eqNullSafe(ref["_ref_nbhd"])
    j = base.join(ref, cond, "left").drop("_ref_city", "_ref_nbhd").withColumnRenamed("_ref_group", "neighbourhood_group_name")
    days = F.datediff(F.col(r.snapshot), F.col("host_since"))
    return (
        j.withColumn("venezia_group_name", F.when(F.col(r.city) == zone_city, F.col("neighbourhood_group_name")))
        .withColumn("host_tenure_days", F.when(days.isNotNull(), F.greatest(days, F.lit(0))))
        .withColumn("season_peak_flag", F.coalesce(F.col(r.period).isin(PEAK_PERIODS), F.lit(False)))
        .withColumn("season_shoulder_flag", F.coalesce(F.col(r.period).isin(SHOULDER_PERIODS), F.lit(False)))
    )


def repeated_reference_keys(reference: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """JON1's cardinality check: (city, neighbourhood) keys that the reference has more than once and
    that would therefore multiply listing rows, with their number of rows."""
    keys = [roles.city, roles.neighbourhood]
    return reference.groupBy(*keys).agg(F.count(F.lit(1)).alias("reference_rows")).where("reference_rows > 1")


def model_input(listings: DataFrame, reference: DataFrame, roles: Roles = Roles(),
                max_price: float = MAX_MODELING_NIGHTLY_PRICE, zone_city: str = ZONE_CITY) -> DataFrame:
    """Listing rows with reference group, tenure, season flags and zone, price <= max_price.

    A NULL price fails the filter (as in the reference).  Rows are not globally sorted:
    (entity, snapshot) order is applied within partitions when the table is written.
    """
    return joined_with_reference(listings, reference, roles, zone_city).where(F.col(roles.price) <= max_price)


def model_input_profile(listings: DataFrame, reference: DataFrame, roles: Roles = Roles(),
                        max_price: float = MAX_MODELING_NIGHTLY_PRICE, zone_city: str = ZONE_CITY) -> DataFrame:
    """AGG30 in one pass: kept rows, rows removed by the price ceiling, post-join NULL rate."""
    j = joined_with_reference(listings, reference, roles, zone_city)
    kept = F.col(roles.price) <= max_price
    return j.agg(
        F.count_if(kept).alias("row_count"),
        (F.count(F.lit(1)) - F.count_if(kept)).alias("rows_removed_for_high_price_outliers"),
        F.lit(float(max_price)).alias("max_modeling_nightly_price"),
        (F.count_if(kept & F.col("neighbourhood_group_name").isNull()) / F.count_if(kept)).alias(
            "null_rate_after_join"
        ),
    )


def centroids(frame: DataFrame, keys: list[str], roles: Roles = Roles()) -> DataFrame:
    """AGG1: median latitude / longitude per group; NULL keys are dropped."""
    both = {"centroid_latitude": roles.latitude, "centroid_longitude": roles.longitude}
    return wide_quantiles(frame, both, [0.5], keys).select(*keys, *[F.col(c)[0].alias(c) for c in both])


def attach_distance_features(frame: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """JON3/JON4 + GEO1: distance to the city and neighbourhood centroids."""
    r = roles
    city = centroids(frame, [r.city], r).withColumnRenamed("centroid_latitude", "_city_lat").withColumnRenamed(
        "centroid_longitude", "_city_lon"
    )
    nb = centroids(frame, [r.city, r.neighbourhood], r).withColumnRenamed("centroid_latitude", "_nb_lat").withColumnRenamed(
        "centroid_longitude", "_nb_lon"
    )
    out = frame.join(city, [r.city], "left").join(nb, [r.city, r.neighbourhood], "left")
    return out.withColumn(
        "distance_to_city_center_km", haversine_km(r.latitude, r.longitude, "_city_lat", "_city_lon")
    ).withColumn(
        "distance_to_neighbourhood_center_km", haversine_km(r.latitude, r.longitude, "_nb_lat", "_nb_lon")
    ).drop("_city_lat", "_city_lon", "_nb_lat", "_nb_lon")


def feature_frame(model_input_df: DataFrame, roles: Roles = Roles(), features: list[str] | None = None) -> DataFrame:
    """PRJ10 + DED1: identifiers, target and the model features (typed NULLs for those the input
    lacks), one row per key."""
    r = roles
    df = attach_distance_features(model_input_df, r)
    wanted = features or model_feature_columns()
    missing = {c: "string" if c in rich_feature_columns(True) and c not in NUMERIC_MODEL_FEATURES else "double"
               for c in wanted if c not in df.columns}
    df = df.withColumns({c: F.lit(None).cast(t) for c, t in missing.items()})
    feats = list(wanted)
    ids = [c for c in IDENTIFIER_COLUMNS if c in df.columns]
    cols = ids + [TARGET_COLUMN] + feats
    w = Window.partitionBy(*r.key).orderBy(*[F.col(c).asc_nulls_first() for c in cols if c not in r.key])
    return df.select(*cols).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")

"""Reading the driver's parquet tables and binding them to the listing role.

The driver's tables are TPC-H-like.  ``market_frame`` turns them into a listing
panel (one row per customer and order date) so that every operator can run on
them; the same binding is written as SQL in :mod:`peerscope.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Fixed values of the binding: quarter -> coarse period label.
PERIOD_BY_QUARTER = {1: "Early Spring", 2: "Early Summer", 3: "Early Autumn", 4: "Early Winter"}

MARKET_COLUMNS = [
    "listing_id", "snapshot_date", "row_key", "city_name", "neighbourhood_name", "period_label",
    "fine_period_label", "room_type", "nightly_price", "accommodates_count", "beds_count",
    "bedrooms_count", "rating_score", "is_superhost", "latitude", "longitude", "host_since",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _period_label(quarter: Column) -> Column:
    expr = None
    for q, label in PERIOD_BY_QUARTER.items():
        expr = F.when(quarter == q, F.lit(label)) if expr is None else expr.when(quarter == q, F.lit(label))
    return expr


def market_frame(spark: SparkSession, sf_dir: str, dedupe: bool = True) -> DataFrame:
    """Listing-role view of orders x customer x nation x region (+ line-item aggregates)."""
    # sent by order once: both steps of the distinct count then find an order's lines in one place
    li = (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_linestatus", "l_quantity")
        .repartition("l_orderkey")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.countDistinct("l_linestatus").alias("n_status"),
            F.sum("l_quantity").alias("qty"),
        )
    )
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    joined = (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .join(li, li.l_orderkey == o.o_orderkey, "left")
    )
    snapshot = F.to_date("o_orderdate")
    quarter = F.quarter("o_orderdate")
    custkey = F.col("o_custkey")
    bound = joined.select(
        custkey.alias("listing_id"),
        snapshot.alias("snapshot_date"),
        F.col("o_orderkey").alias("row_key"),
        F.col("r_name").alias("city_name"),
        F.col("n_name").alias("neighbourhood_name"),
        _period_label(quarter).alias("period_label"),
        F.concat(F.year("o_orderdate").cast("string"), F.lit("-Q"), quarter.cast("string")).alias(
            "fine_period_label"
        ),
        F.col("c_mktsegment").alias("room_type"),
        F.col("o_totalprice").alias("nightly_price"),
        F.col("n_lines").alias("accommodates_count"),
        F.floor(F.col("qty") / 50).cast("bigint").alias("beds_count"),
        F.col("n_status").alias("bedrooms_count"),
        ((F.col("c_acctbal") + 1000) / 2200).alias("rating_score"),
        (F.col("c_acctbal") > 5000).alias("is_superhost"),
        ((custkey % 3600).cast("double") / 10000 + 45).alias("latitude"),
        (((custkey * 7) % 3600).cast("double") / 10000 + 9).alias("longitude"),
        F.date_add(F.lit("1994-06-01").cast("date"), (custkey % 1500).cast("int")).alias("host_since"),
    )
    return one_per_snapshot(bound) if dedupe else bound


def one_per_snapshot(bound: DataFrame) -> DataFrame:
    """One row per (listing, snapshot): keep the smallest order key (keep-first dedupe)."""
    w = Window.partitionBy("listing_id", "snapshot_date").orderBy("row_key")
    return bound.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def sparse_market_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole market with the snapshot month as period: small pools, so targets
    reach the city-pool widening and the summary rungs of the benchmark ladder."""
    m = market_frame(spark, sf_dir)
    return m.withColumn("period_label", F.date_format("snapshot_date", "yyyy-MM"))


def neighbourhood_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference table of the binding: every (region, nation) with a group named by rule
    ('ZONE_' + nation key div 5)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("r_name").alias("city_name"),
        F.col("n_name").alias("neighbourhood_name"),
        F.concat(F.lit("ZONE_"), F.floor(F.col("n_nationkey") / 5).cast("string")).alias("neighbourhood_group_name"),
    )


def listing_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision requests of the binding: every customer, no date (= latest snapshot)."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("listing_id"), F.lit(None).cast("date").alias("snapshot_date")
    )


# Raw header names of the listing export, for the columns the binding provides.
RAW_HEADERS = {
    "listing_id": "Listings id", "snapshot_date": "Date of scraping", "city_name": "City",
    "period_label": "Season", "neighbourhood_name": "Neighbourhood", "room_type": "Property type",
    "nightly_price": "Price", "accommodates_count": "Maximum allowed guests", "beds_count": "Beds number",
    "bedrooms_count": "Bedrooms number", "rating_score": "Rating score", "host_since": "Host since",
}


def raw_listing_export(market: DataFrame) -> DataFrame:
    """The bound listings as a raw all-text export (raw headers, 'lat, lon' coordinates,
    superhost as text), the input of the listing cleaner."""
    cols = [F.col(c).cast("string").alias(h) for c, h in RAW_HEADERS.items()]
    cols.append(F.when(F.col("is_superhost"), F.lit("Superhost")).when(~F.col("is_superhost"), F.lit("Host"))
                .alias("Host is superhost"))
    cols.append(F.concat(F.col("latitude").cast("string"), F.lit(", "), F.col("longitude").cast("string"))
                .alias("Coordinates"))
    return market.select(*cols)


def boundary_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boundary features of the binding: one per nation, in nation-key order, no own group."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("raw_feature_index"),
        F.col("n_name").alias("neighbourhood"),
        F.lit(None).cast("string").alias("neighbourhood_group"),
        F.lit(None).cast("string").alias("geometry_type"),
        F.lit(None).cast("string").alias("geometry"),
    )

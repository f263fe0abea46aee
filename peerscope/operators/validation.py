"""Contract and semantic validation of cleaned tables (AGG22-AGG29, JON8, JON9, SET3, SET4).

Schema checks read only metadata; data checks are single aggregations whose results are
turned into finding rows (dataset, check_name, severity, message).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.functions.scalars import attach_one_row
from peerscope.operators.cleaning import Contract

# Canonical vocabularies of the reference.
CANONICAL_CITIES = ["Firenze", "Milano", "Napoli", "Roma", "Venezia"]
CANONICAL_PERIODS = ["Early Spring", "Early Summer", "Early Autumn", "Early Winter"]
BOUNDARY_GEOMETRY_TYPES = ["Polygon", "MultiPolygon"]
# Check names and message texts below are fixed values that must equal the reference's.
FINDING_SCHEMA = "dataset string, check_name string, severity string, message string"


def _findings(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, FINDING_SCHEMA)


def contract_column_findings(df: DataFrame, contract: Contract) -> DataFrame:
    """AGG28: missing / unexpected / misordered columns (schema only)."""
    expected, actual = contract.names, df.columns
    rows = []
    missing = [c for c in expected if c not in actual]
    unexpected = [c for c in actual if c not in expected]
    if missing:
        rows.append((contract.name, "missing_contract_columns", "error", f"Missing required columns: {', '.join(missing)}."))
    if unexpected:
        rows.append((contract.name, "unexpected_columns", "error", f"Unexpected columns present: {', '.join(unexpected)}."))
    if not missing and not unexpected and actual != expected:
        rows.append((contract.name, "column_order", "error", "Columns do not match the contract order."))
    return _findings(df.sparkSession, rows)


def _finding(dataset: str, check: str, message: Column) -> Column:
    return F.struct(F.lit(dataset).alias("dataset"), F.lit(check).alias("check_name"), F.lit("error").alias("severity"),
                    message.alias("message"))


def _explode_findings(agg: DataFrame, items: list[tuple[Column, Column]]) -> DataFrame:
    """``items`` = (condition, finding struct) evaluated on a one-row aggregate."""
    arr = F.filter(F.array(*[F.when(cond, f) for cond, f in items]), lambda x: x.isNotNull())
    return agg.select(F.explode(arr).alias("f")).select("f.*")


def non_nullable_findings(df: DataFrame, contract: Contract) -> DataFrame:
    """AGG22: NULL counts of non-nullable fields, one aggregation for all of them."""
    fields = [f.name for f in contract.fields if not f.nullable and f.name in df.columns]
    if not fields:
        return _findings(df.sparkSession, [])
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in fields])
    items = [
        (F.col(c) > 0, _finding(contract.name, "non_nullable_fields", F.format_string(
            "Field `%s` contains `%d` null values but is non-nullable.", F.lit(c), F.col(c))))
        for c in fields
    ]
    return _explode_findings(agg, items)


def primary_key_findings(df: DataFrame, contract: Contract) -> DataFrame:
    """AGG23: every row after the first per key counts as a duplicate (NULL keys equal)."""
    pk = list(contract.primary_key)
    missing = [c for c in pk if c not in df.columns]
    if missing:
        return _findings(df.sparkSession, [(contract.name, "primary_key_columns", "error",
                                            f"Primary key columns missing from dataset: {', '.join(missing)}.")])
    dup = df.groupBy(*pk).agg(F.count(F.lit(1)).alias("_n")).agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_d"))
    item = (F.col("_d") > 0, _finding(contract.name, "primary_key_uniqueness", F.format_string(
        "Primary key `%s` contains `%d` duplicate rows.", F.lit(", ".join(pk)), F.col("_d"))))
    return _explode_findings(dup, [item])


def _invalid_labels(col: str, vocabulary: list[str]) -> Column:
    bad = F.when(F.col(col).isNotNull() & ~F.col(col).isin(vocabulary), F.col(col))
    return F.array_join(F.array_sort(F.collect_set(bad)), ", ")


def listing_semantic_findings(df: DataFrame, dataset: str = "listing_snapshot", cities: list[str] = CANONICAL_CITIES,
                              periods: list[str] = CANONICAL_PERIODS) -> DataFrame:
    """AGG24 + JON8: label vocabularies, non-positive price, coordinate and rating bounds."""
    needed = {"city_name", "period_label", "nightly_price", "latitude", "longitude", "rating_score"}
    if not needed.issubset(df.columns):  # SET4
        return _findings(df.sparkSession, [])
    lat, lon, rating = F.col("latitude"), F.col("longitude"), F.col("rating_score")
    agg = df.agg(
        _invalid_labels("city_name", cities).alias("_cities"),
        _invalid_labels("period_label", periods).alias("_periods"),
        F.count_if(F.col("nightly_price") <= 0).alias("_price"),
        F.count_if((lat < -90) | (lat > 90) | (lon < -180) | (lon > 180)).alias("_coord"),
        F.count_if((rating < 0) | (rating > 5)).alias("_rating"),
    )
    items = [
        (F.col("_cities") != "", _finding(dataset, "canonical_city_labels",
                                          F.concat(F.lit("Unexpected city labels found: "), F.col("_cities"), F.lit(".")))),
        (F.col("_periods") != "", _finding(dataset, "canonical_period_labels",
                                           F.concat(F.lit("Unexpected period labels found: "), F.col("_periods"), F.lit(".")))),
        (F.col("_price") > 0, _finding(dataset, "positive_nightly_price", F.format_string(
            "`nightly_price` contains `%d` non-positive values.", F.col("_price")))),
        (F.col("_coord") > 0, _finding(dataset, "coordinate_bounds", F.format_string(
            "`latitude` or `longitude` is out of bounds in `%d` rows.", F.col("_coord")))),
        (F.col("_rating") > 0, _finding(dataset, "rating_bounds", F.format_string(
            "`rating_score` is outside the expected range [0, 5] in `%d` rows.", F.col("_rating")))),
    ]
    return _explode_findings(agg, items)


def grouped_semantic_findings(df: DataFrame, dataset: str, cities: list[str] = CANONICAL_CITIES,
                              periods: list[str] = CANONICAL_PERIODS) -> DataFrame:
    """AGG25: label vocabularies of a summary table."""
    if not {"city_name", "period_label"}.issubset(df.columns):
        return _findings(df.sparkSession, [])
    agg = df.agg(_invalid_labels("city_name", cities).alias("_c"), _invalid_labels("period_label", periods).alias("_p"))
    return _explode_findings(agg, [
        (F.col("_c") != "", _finding(dataset, "canonical_city_labels",
                                     F.concat(F.lit("Unexpected city labels found: "), F.col("_c"), F.lit(".")))),
        (F.col("_p") != "", _finding(dataset, "canonical_period_labels",
                                     F.concat(F.lit("Unexpected period labels found: "), F.col("_p"), F.lit(".")))),
    ])


def boundary_semantic_findings(df: DataFrame, dataset: str = "neighbourhood_boundary",
                               cities: list[str] = CANONICAL_CITIES) -> DataFrame:
    """AGG26: city labels and Polygon/MultiPolygon geometry types."""
    agg = df.agg(_invalid_labels("city_name", cities).alias("_c"),
                 _invalid_labels("geometry_type", BOUNDARY_GEOMETRY_TYPES).alias("_g"))
    return _explode_findings(agg, [
        (F.col("_c") != "", _finding(dataset, "canonical_city_labels",
                                     F.concat(F.lit("Unexpected city labels found: "), F.col("_c"), F.lit(".")))),
        (F.col("_g") != "", _finding(dataset, "geometry_type_values",
                                     F.concat(F.lit("Unexpected geometry types found: "), F.col("_g"), F.lit(".")))),
    ])


def cross_dataset_findings(boundaries: DataFrame, reference: DataFrame) -> DataFrame:
    """JON9 + SET3: boundary neighbourhoods absent from the reference, one finding per name."""
    b = boundaries.select("neighbourhood_name").where(F.col("neighbourhood_name").isNotNull()).distinct()
    missing = b.join(reference.select("neighbourhood_name").distinct(), "neighbourhood_name", "left_anti")
    text = F.concat(F.lit("Boundary neighbourhoods missing from reference vocabulary: "), "neighbourhood_name", F.lit("."))
    return missing.select(_finding("neighbourhood_boundary", "boundary_reference_alignment", text).alias("f")).select("f.*")


def manifest_findings(df: DataFrame, contract: Contract, manifest: DataFrame) -> DataFrame:
    """AGG27: manifest name, row count and column list agree with the table."""
    m = attach_one_row(manifest, df.agg(F.count(F.lit(1)).alias("_rows")))
    cols = "|".join(df.columns)
    return _explode_findings(m, [
        (~F.col("dataset_name").eqNullSafe(contract.name), _finding(contract.name, "manifest_dataset_name", F.concat(
            F.lit("Manifest dataset_name is `"), F.coalesce("dataset_name", F.lit("None")), F.lit(f"` instead of `{contract.name}`.")))),
        (~F.col("row_count").eqNullSafe(F.col("_rows")), _finding(contract.name, "manifest_row_count", F.format_string(
            "Manifest row_count is `%d` but dataset has `%d` rows.", F.col("row_count"), F.col("_rows")))),
        (~F.col("columns").eqNullSafe(cols), _finding(contract.name, "manifest_columns",
                                            F.lit("Manifest column list does not match the actual dataset columns."))),
    ])


def validation_status(findings: DataFrame, datasets: list[str]) -> DataFrame:
    """AGG29: (dataset, status, findings) for each dataset and, as ``overall``, for all of them."""
    spark = findings.sparkSession
    names = spark.createDataFrame([(n,) for n in datasets], "dataset string")
    counted = findings.groupBy("dataset").agg(F.count(F.lit(1)).alias("findings"))
    per = names.join(counted, "dataset", "left").select("dataset", F.coalesce("findings", F.lit(0)).alias("findings"))
    every = findings.agg(F.count(F.lit(1)).alias("findings")).select(F.lit("overall").alias("dataset"), "findings")
    return per.unionByName(every).select(
        "dataset", F.when(F.col("findings") > 0, F.lit("failed")).otherwise(F.lit("passed")).alias("status"), "findings"
    )


def validate(tables: dict[str, tuple[DataFrame, Contract]], cities: list[str] = CANONICAL_CITIES,
             periods: list[str] = CANONICAL_PERIODS, manifests: dict[str, DataFrame] | None = None) -> DataFrame:
    """AGG29: every check for every table, unioned (``manifests``: the tables' one-row manifests, where
    there are any); :func:`validation_status` sums the findings up."""
    parts = []
    for name, (df, contract) in tables.items():
        if manifests and name in manifests:
            parts.append(manifest_findings(df, contract, manifests[name]))
        parts += [contract_column_findings(df, contract), non_nullable_findings(df, contract),
                  primary_key_findings(df, contract)]
        if name == "listing_snapshot":
            parts.append(listing_semantic_findings(df, name, cities, periods))
        elif name in ("city_period_summary", "neighbourhood_period_summary"):
            parts.append(grouped_semantic_findings(df, name, cities, periods))
        elif name == "neighbourhood_boundary":
            parts.append(boundary_semantic_findings(df, name, cities))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

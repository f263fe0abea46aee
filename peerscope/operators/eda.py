"""Descriptive summaries behind the EDA charts (AGG2-AGG14, TOP2, MTH3, MTH4, SRT2, STR8, SET2).

Counts are one grouped aggregation; medians and quantiles are exact and distributed
(:mod:`peerscope.operators.quantiles`), so no task holds a whole (hot) group or the whole
column.  ``approx=True`` switches the global quantiles to ``percentile_approx``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peerscope.functions.scalars import attach_one_row
from peerscope.operators.quantiles import exact_median, exact_quantiles, wide_quantiles
from peerscope.roles import Roles

# Display orders of the reference's charts.
PERIOD_ORDER = ["Early Spring", "Early Summer", "Early Autumn", "Early Winter"]
ROOM_TYPE_ORDER = ["Entire home", "Private room", "Hotel room", "Shared room"]
ACCOMMODATES_BAND_ORDER = ["1-2 guests", "3-4 guests", "5-6 guests", "7+ guests"]
HISTOGRAM_BINS = 40
HISTOGRAM_CLIP_QUANTILE = 0.99


def display_rank(col: Column, order: list[str]) -> Column:
    """SRT2: position in a known list (1-based), unknown values after all known ones."""
    pos = F.array_position(F.array(*[F.lit(v) for v in order]), col)
    return F.when(pos > 0, pos).otherwise(F.lit(len(order) + 1))


def rows_by_city(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    return df.where(F.col(roles.city).isNotNull()).groupBy(roles.city).agg(F.count(F.lit(1)).alias("row_count"))


def _period_values(df: DataFrame, roles: Roles, known: list[str]) -> list[str]:
    # The pivot needs its column list: known periods first, then any other label (a
    # small vocabulary, read with one distinct query).
    others = sorted(
        r[0] for r in df.select(roles.period).where(F.col(roles.period).isNotNull()).distinct().collect()
        if r[0] not in known
    )
    return known + others


def rows_by_city_and_period(df: DataFrame, roles: Roles = Roles(), periods: list[str] | None = None) -> DataFrame:
    """AGG3: zero-filled counts, one column per period in display order."""
    values = periods or _period_values(df, roles, PERIOD_ORDER)
    return (
        df.where(F.col(roles.city).isNotNull())
        .groupBy(roles.city)
        .agg(*[F.count_if(F.col(roles.period) == v).alias(v) for v in values])
    )


def room_type_share(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """AGG4: share of each category among non-NULL categories, with display rank."""
    counts = df.where(F.col(roles.category).isNotNull()).groupBy(roles.category).agg(F.count(F.lit(1)).alias("_n"))
    return counts.select(
        roles.category,
        (F.col("_n") / F.sum("_n").over(Window.partitionBy())).alias("share"),
        display_rank(F.col(roles.category), ROOM_TYPE_ORDER).alias("display_rank"),
    )


def median_price_by(df: DataFrame, keys: list[str], roles: Roles = Roles()) -> DataFrame:
    """Median price per group; groups whose prices are all NULL keep a NULL median."""
    med = wide_quantiles(df, {"median_nightly_price": roles.price}, [0.5], keys)
    return med.select(*keys, F.col("median_nightly_price")[0].alias("median_nightly_price"))


def median_price_by_city_and_period(df: DataFrame, roles: Roles = Roles(), periods: list[str] | None = None) -> DataFrame:
    """AGG6: one column per period (NULL where the city has no row in that period)."""
    values = periods or _period_values(df, roles, PERIOD_ORDER)
    cells = median_price_by(df, [roles.city, roles.period], roles)
    cities = df.where(F.col(roles.city).isNotNull()).select(roles.city).distinct()
    wide = cells.groupBy(roles.city).agg(
        *[F.max(F.when(F.col(roles.period) == v, F.col("median_nightly_price"))).alias(v) for v in values]
    )
    return cities.join(wide, roles.city, "left")


def capacity_band(capacity: Column) -> Column:
    """MTH3: right-closed bands [0,2] (2,4] (4,6] (6,inf); negatives and NULL -> NULL."""
    return (
        F.when(capacity < 0, F.lit(None))
        .when(capacity <= 2, F.lit(ACCOMMODATES_BAND_ORDER[0]))
        .when(capacity <= 4, F.lit(ACCOMMODATES_BAND_ORDER[1]))
        .when(capacity <= 6, F.lit(ACCOMMODATES_BAND_ORDER[2]))
        .when(capacity > 6, F.lit(ACCOMMODATES_BAND_ORDER[3]))
    )


def median_price_by_capacity_band(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """AGG8: bands without rows (or with only NULL prices) are dropped."""
    banded = df.withColumn("accommodates_band", capacity_band(F.col(roles.capacity)))
    return (
        median_price_by(banded, ["accommodates_band"], roles)
        .where(F.col("median_nightly_price").isNotNull())
        .withColumn("display_rank", display_rank(F.col("accommodates_band"), ACCOMMODATES_BAND_ORDER))
    )


def neighbourhood_price_extremes(df: DataFrame, roles: Roles = Roles(), min_listing_rows: int = 200,
                                 top_n: int = 5, bottom_n: int = 5) -> DataFrame:
    """AGG9 + FLT4 + TOP2 + STR8 + SET2: the top and bottom neighbourhoods by median price."""
    r = roles
    g = df.where(F.col(r.city).isNotNull() & F.col(r.neighbourhood).isNotNull())
    rows = g.groupBy(r.city, r.neighbourhood).agg(F.count(r.entity).alias("listing_rows"))
    grouped = (
        rows.where(F.col("listing_rows") >= min_listing_rows)
        .join(exact_median(g, r.price, [r.city, r.neighbourhood], "median_nightly_price"), [r.city, r.neighbourhood], "left")
        .withColumn("label", F.concat_ws("\n", r.city, r.neighbourhood))
    )
    top = grouped.orderBy(F.col("median_nightly_price").desc_nulls_last(), r.city, r.neighbourhood).limit(top_n)
    bottom = grouped.orderBy(F.col("median_nightly_price").asc_nulls_last(), r.city, r.neighbourhood).limit(bottom_n)
    return top.withColumn("segment", F.lit("Top priced")).unionByName(
        bottom.withColumn("segment", F.lit("Lower priced"))
    )


def extremes_in_display_order(extremes: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """SRT3: the extremes (ten rows) ordered by median for display, with ``display_rank``."""
    w = Window.orderBy(F.col("median_nightly_price").asc_nulls_last(), roles.city, roles.neighbourhood, "segment")
    return extremes.withColumn("display_rank", F.row_number().over(w)).orderBy("display_rank")


def _global_quantiles(df: DataFrame, col: str, probs: list[float], approx: bool) -> DataFrame:
    """One-row table with ``_q`` (array) and ``n``."""
    if approx:
        return df.agg(F.percentile_approx(col, probs, 100000).alias("_q"), F.count(col).alias("n"))
    return exact_quantiles(df, col, probs, out="_q")


def _with_stats(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach a one-row statistics table to every row (scalar subquery, no join)."""
    return attach_one_row(df, stats)


def price_histogram(df: DataFrame, roles: Roles = Roles(), bins: int = HISTOGRAM_BINS, approx: bool = False) -> DataFrame:
    """AGG10/AGG11 + MTH4: equal-width histogram of prices clipped at the 99th percentile.

    Bin i (1-based) covers [lo + (i-1)w, lo + iw), the last bin is closed; when all values
    are equal the range is widened to +/- 0.5 (as numpy does).
    """
    p = df.select(F.col(roles.price).cast("double").alias("x")).where(F.col("x").isNotNull())
    cap = _global_quantiles(p, "x", [HISTOGRAM_CLIP_QUANTILE], approx).select(F.col("_q")[0].alias("cap"))
    clipped = _with_stats(p, cap).select(F.least("x", "cap").alias("x"))
    rng = clipped.agg(F.min("x").alias("lo0"), F.max("x").alias("hi0")).select(
        F.when(F.col("lo0") == F.col("hi0"), F.col("lo0") - 0.5).otherwise(F.col("lo0")).alias("lo"),
        F.when(F.col("lo0") == F.col("hi0"), F.col("hi0") + 0.5).otherwise(F.col("hi0")).alias("hi"),
    )
    idx = F.least(F.floor((F.col("x") - F.col("lo")) * (F.lit(float(bins)) / (F.col("hi") - F.col("lo")))), F.lit(bins - 1))
    counts = _with_stats(clipped, rng).groupBy(idx.alias("_b")).agg(F.count(F.lit(1)).alias("row_count"))
    all_bins = rng.select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("_b"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return all_bins.join(counts, "_b", "left").select(
        (F.col("_b") + 1).alias("bin"),
        (F.col("lo") + F.col("_b") * width).alias("bin_lower"),
        (F.col("lo") + (F.col("_b") + 1) * width).alias("bin_upper"),
        F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
    )


def price_boxplot(df: DataFrame, roles: Roles = Roles(), approx: bool = False) -> DataFrame:
    """AGG12: quartiles and whiskers clamped to the data range."""
    x = F.col(roles.price).cast("double")
    q = _with_stats(
        _global_quantiles(df, roles.price, [0.25, 0.5, 0.75], approx).select("_q"),
        df.where(x.isNotNull()).agg(F.min(x).alias("_min"), F.max(x).alias("_max")),
    )
    q1, med, q3 = F.col("_q")[0], F.col("_q")[1], F.col("_q")[2]
    iqr = q3 - q1
    return q.select(
        q1.alias("q1"), med.alias("median"), q3.alias("q3"),
        F.greatest(F.col("_min"), q1 - 1.5 * iqr).alias("lower_whisker"),
        F.least(F.col("_max"), q3 + 1.5 * iqr).alias("upper_whisker"),
    )


def heatmap_scale(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """AGG13: min and max over the city x period median cells (long form: no pivot needed)."""
    cells = median_price_by(df, [roles.city, roles.period], roles)
    return cells.agg(F.min("median_nightly_price").alias("min_value"), F.max("median_nightly_price").alias("max_value"))


def data_profile(df: DataFrame, roles: Roles = Roles(), approx: bool = False) -> DataFrame:
    """AGG14 as a long table (metric, key, value): overall statistics plus counts per city
    and per period, one aggregate each (medians need their own grouping)."""
    r = roles
    x = F.col(r.price).cast("double")
    counts = df.agg(
        F.count(F.lit(1)).cast("double").alias("row_count"),
        F.avg(x).alias("target_mean"),
    )
    distinct_ids = df.select(r.entity).where(F.col(r.entity).isNotNull()).distinct().agg(
        F.count(F.lit(1)).cast("double").alias("unique_listing_count"))
    quart = _global_quantiles(df, r.price, [0.25, 0.5, 0.75], approx).select("_q")
    overall = _with_stats(_with_stats(counts, distinct_ids), quart).select(
        F.explode(F.array(
            F.struct(F.lit("row_count").alias("metric"), F.col("row_count").alias("value")),
            F.struct(F.lit("unique_listing_count").alias("metric"), F.col("unique_listing_count").alias("value")),
            F.struct(F.lit("target_median").alias("metric"), F.col("_q")[1].alias("value")),
            F.struct(F.lit("target_mean").alias("metric"), F.col("target_mean").alias("value")),
            F.struct(F.lit("target_q1").alias("metric"), F.col("_q")[0].alias("value")),
            F.struct(F.lit("target_q3").alias("metric"), F.col("_q")[2].alias("value")),
        )).alias("s")
    ).select(F.col("s.metric").alias("metric"), F.lit(None).cast("string").alias("key"), F.col("s.value").alias("value"))
    by = (
        df.groupBy(F.col(r.city).alias("_c"), F.col(r.period).alias("_p"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    city = by.where(F.col("_c").isNotNull()).groupBy("_c").agg(F.sum("_n").alias("_n")).select(
        F.lit("city_count").alias("metric"), F.col("_c").alias("key"), F.col("_n").cast("double").alias("value"))
    period = by.where(F.col("_p").isNotNull()).groupBy("_p").agg(F.sum("_n").alias("_n")).select(
        F.lit("period_count").alias("metric"), F.col("_p").alias("key"), F.col("_n").cast("double").alias("value"))
    return overall.unionByName(city).unionByName(period)

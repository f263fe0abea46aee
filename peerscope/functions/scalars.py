"""Attaching one-row statistics to every row through a scalar subquery (no join)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of ``one_row`` (exactly one row, e.g. a global aggregate) to ``df``.

    The statistics run once as a scalar subquery and are inlined as a constant struct, so
    no join (and no broadcast of anything data-sized) is involved.
    """
    cols = one_row.columns
    packed = one_row.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_s")).scalar()
    out = df.withColumn("_one_row", packed)
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col("_one_row")[c].alias(c) for c in cols])

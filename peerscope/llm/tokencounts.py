"""Exact length histogram (operator 2).

Documents are aggregated by encoded length; the histogram (one row per distinct length) and its
suffix sums answer every question about a context limit without another pass over the texts:
documents and tokens at or beyond a limit, tokens kept when each text is cut at the limit, and the
limit that a given share of the documents fits into.

The suffix sums run in blocks of lengths: a window inside each block, plus the totals of the blocks
above it.  No window spans the whole histogram.

Defined results: null and empty texts have length 0; an empty table has an empty histogram.  Repeated
rows count each time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Lengths per block of the two-level suffix sums.
BLOCK = 256


def length_histogram(df: DataFrame, length: Column) -> DataFrame:
    """(length, n_docs): exact counts; partial counts merge before the shuffle."""
    return df.select(F.coalesce(length, F.lit(0)).cast("long").alias("length")).groupBy("length").agg(
        F.count("*").alias("n_docs")
    )


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For each distinct length L: documents and tokens at or beyond it and the totals under limit L.

    Columns: length, n_docs, docs_from, tokens_from (documents at least that long and their tokens),
    docs_within, tokens_within (documents at most that long), tokens_cut (all tokens when texts are
    cut at L), share_within (of the documents).
    """
    h = histogram.withColumn("_block", F.floor(F.col("length") / BLOCK)).withColumn(
        "_tokens", F.col("length") * F.col("n_docs")
    )
    blocks = h.groupBy("_block").agg(F.sum("n_docs").alias("_bd"), F.sum("_tokens").alias("_bt"))
    # totals of the blocks above: an array of one entry per block, (longest text / BLOCK) entries
    above = blocks.agg(F.collect_list(F.struct("_block", "_bd", "_bt")).alias("_all"))
    down = W.partitionBy("_block").orderBy(F.col("length").desc()).rowsBetween(W.unboundedPreceding, 0)
    h = h.withColumn("_d", F.sum("n_docs").over(down)).withColumn("_t", F.sum("_tokens").over(down))
    h = h.withColumn("_all", above.select("_all").scalar())

    def total(field: str, condition) -> Column:
        return F.aggregate(
            F.filter("_all", condition), F.lit(0).cast("long"), lambda acc, x: acc + x[field]
        )

    higher = lambda x: x["_block"] > F.col("_block")
    every = lambda x: F.lit(True)
    h = h.withColumns(
        {
            "docs_from": F.col("_d") + total("_bd", higher),
            "tokens_from": F.col("_t") + total("_bt", higher),
            "_docs": total("_bd", every),
            "_tok": total("_bt", every),
        }
    )
    return h.select(
        "length",
        "n_docs",
        "docs_from",
        "tokens_from",
        (F.col("_docs") - F.col("docs_from") + F.col("n_docs")).alias("docs_within"),
        (F.col("_tok") - F.col("tokens_from") + F.col("_tokens")).alias("tokens_within"),
        (F.col("_tok") - F.col("tokens_from") + F.col("length") * F.col("docs_from")).alias("tokens_cut"),
        ((F.col("_docs") - F.col("docs_from") + F.col("n_docs")) / F.col("_docs")).alias("share_within"),
    )


def at_limits(sums: DataFrame, limits: DataFrame) -> DataFrame:
    """Answers for any context limits (column ``context``), also between two distinct lengths.

    Of the lengths above a limit only the next one matters: tokens_cut = tokens_cut(next) minus what
    the texts from there on lose between the limit and the next length.  ``limits`` is the question
    asked (a short list); each row of ``sums`` meets each limit once, and the next length is a
    minimum that aggregates before the shuffle.
    """
    wide = sums.join(F.broadcast(limits.select("context")), F.col("length") >= F.col("context"), "right")
    best = wide.groupBy("context").agg(
        F.min_by(F.struct("length", "docs_from", "tokens_cut"), "length").alias("s")
    )
    whole = sums.agg(F.sum(F.col("length") * F.col("n_docs")).alias("t")).select("t").scalar()
    return best.select(
        "context",
        F.coalesce("s.docs_from", F.lit(0)).alias("docs_from"),
        F.when(F.col("s").isNull(), F.coalesce(whole, F.lit(0)))
        .otherwise(F.col("s.tokens_cut") - (F.col("s.length") - F.col("context")) * F.col("s.docs_from"))
        .alias("tokens_cut"),
    )


def quantile_lengths(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the smallest length that at least that share of the documents fits into."""
    return sums.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(s).alias("share"), F.when(F.col("share_within") >= s, F.col("length")).alias("length"))
                    for s in shares
                ]
            )
        ).alias("q")
    ).groupBy(F.col("q.share").alias("share")).agg(F.min("q.length").alias("length"))

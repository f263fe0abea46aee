"""The corpus pipeline: toxicity, n-gram Jaccard join, repeated passages, decontamination, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and
reread as the next stage's ``docs``.  Stages decide about rows: documents whose ids repeat or are null are
judged like all others, each by its own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.llm import bpe, decontaminate, jaccard, repeats, toxicity
from peerscope.llm.common import bounded_batches, fresh_name, numbered, saved, table
from peerscope.llm.queries import WORD_BPE

#: No stage can be written as SQL as a whole (scores, components, byte spans, token ids).
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under one half."""
    bounded_batches(spark)
    score = fresh_name(docs, "toxicity")
    scored = toxicity.scored_documents(docs, table(spark, sf_dir, "labels"), out=score)
    return scored.where(F.col(score) < 0.5).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id (null ids last; ties: any one row)."""
    bounded_batches(spark)
    rows, row = numbered(docs, "row_number")
    groups = saved(jaccard.jaccard_join(rows, key=row).where("n_shingles > 0"), "jaccard-groups")
    groups = groups.select(F.col("doc_id").alias(row), F.col("component_id").alias("_group"))
    ranked = rows.select(row, F.struct(F.col("doc_id").isNull(), "doc_id", row).alias("_rank")).join(groups, row)
    first = ranked.groupBy("_group").agg(F.min("_rank").alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    gone = groups.join(first, "_group").where(F.col(row) != F.col("_first")[row]).select(row)
    return rows.join(gone, row, "left_anti").select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of strings of 100 bytes that also start earlier; n_chars follows."""
    bounded_batches(spark)
    out = repeats.shortened(docs)
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.lit(0).cast("long")))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold benchmark passages in a twentieth of their words or more."""
    bounded_batches(spark)
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and the decoded texts."""
    bounded_batches(spark)
    return bpe.round_trip(docs, bpe.load(spark, WORD_BPE))


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard", one_of_each_group),
    ("repeats", cut_repeats),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

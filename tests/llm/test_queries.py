"""Registered queries against their SQL on the smallest fixture, and the pipeline's stages."""
import pytest

import corpus_pipeline
from peerscope.llm import queries
from peerscope.plans.check import compare
from tests.conftest import SMALL
from tests.llm import brute

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    res = compare(queries.QUERIES[name](spark, SMALL).toPandas(), con.execute(queries.ORACLES[name]).df())
    assert res["match"], res


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_returns_a_row_per_document(spark, name):
    rows = queries.QUERIES[name](spark, SMALL).toPandas()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert (rows["n_docs"].sum() if "n_docs" in rows else len(rows)) == docs


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "jaccard", "repeats", "decontamination", "bpe"]

    def rows(df):
        return sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())

    clean = steps["toxicity"](spark, docs, SMALL).cache()
    assert clean.columns == docs.columns
    truth = {r[0]: r[1] for r in spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "toxic").collect()}
    kept = {d for d, _ in rows(clean)}
    wrong = [d for d, y in truth.items() if (d in kept) == bool(y)]
    assert len(wrong) <= 0.06 * len(truth)  # about 70 labelled texts to learn from

    one = steps["jaccard"](spark, clean, SMALL).cache()
    assert rows(one) == sorted((d, t) for d, t in rows(clean) if d in {c for _, _, c in brute.jaccard(rows(clean))})

    cut = steps["repeats"](spark, one, SMALL).cache()
    want = sorted((d, k.decode("utf-8", "ignore")) for d, _, _, _, k in brute.repeats(rows(one)))
    assert cut.columns == docs.columns and rows(cut) == want
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect())

    bench = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    pure = steps["decontamination"](spark, cut, SMALL).cache()
    bad = {r[0] for r in brute.contamination(rows(cut), bench) if r[4]}
    assert rows(pure) == [r for r in rows(cut) if r[0] not in bad]

    coded = steps["bpe"](spark, pure, SMALL).collect()
    assert sorted(r["doc_id"] for r in coded) == [d for d, _ in rows(pure)]
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SMALL).collect()) == sorted(tuple(r) for r in coded)


def test_stages_pass_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame(
        [(None, None, None, None, None, 1, "a", 2.5, "x"), (1, "", "en", "s", 0, 2, "b", 0.0, "y"),
         (None, "a b c d e f g", None, None, 3, 3, "c", 1.0, "z")],
        # the last four clash with names that operators use
        "doc_id long, text string, lang string, source string, n_chars long, doc int, twin string, toxicity double, spans string",
    )
    for data, n in ((docs, 3), (docs.where("n_chars = 99"), 0)):
        for name, stage in corpus_pipeline.STAGES:
            data = stage(spark, data, SMALL)
            assert data.count() == n, name
            if name != "bpe":
                assert data.columns == docs.columns
                assert sorted(r["doc"] for r in data.collect()) == [1, 2, 3][:n]

"""Pipeline stages decide by row: repeated and null ids lose no document and hide none."""
import corpus_pipeline
from tests.conftest import SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
A = " ".join(f"alpha{i}" for i in range(60))
B = " ".join(f"beta{i}" for i in range(60))
C = " ".join(f"gamma{i}" for i in range(60))


def stage(spark, name, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).repartition(3)
    return sorted(((r["doc_id"], r["text"]) for r in dict(corpus_pipeline.STAGES)[name](spark, docs, SMALL).collect()), key=str)


def test_one_of_each_group_keeps_unique_texts_of_repeated_ids(spark):
    rows = [(7, A), (8, A), (8, B), (9, C), (9, C), (None, C + " more"), (None, "a text of its own"), (None, None), (3, ""), (3, "")]
    want = [(7, A), (8, B), (9, C), (None, "a text of its own"), (None, None), (3, ""), (3, "")]
    assert stage(spark, "jaccard", rows) == sorted(want, key=str)
    assert stage(spark, "jaccard", [(None, A), (None, A), (5, A + " tail")]) == [(5, A + " tail")]


def test_contaminated_rows_go_by_their_own_text(spark):
    item = next(r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect() if len((r["text"] or "").split()) >= 13)
    rows = [(1, item), (1, A), (None, item), (None, B), (2, C)]
    assert stage(spark, "decontamination", rows) == sorted([(1, A), (None, B), (2, C)], key=str)

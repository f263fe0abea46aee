"""Repeated and null ids: components over ids, removed bytes against SQL."""
import duckdb
import pytest

from peerscope.llm import capfilters, jaccard, oracles, repeats
from peerscope.plans.check import compare

A = " ".join(f"alpha{i}" for i in range(40))
B = " ".join(f"beta{i}" for i in range(40))
NEAR_A = A + " tail"


def sql(text, **tables):
    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(name, frame)
    return con.execute(text).df()


@pytest.mark.parametrize("rows", [
    [(7, A), (8, A), (8, B), (9, B)],
    [(5, A), (4, NEAR_A), (4, B), (3, B), (3, ""), (2, None), (2, "lone words of a text"), (11, "lone words of a text")],
    [(1, A), (1, A), (2, B)],
])
def test_jaccard_components_are_over_ids(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert compare(jaccard.jaccard_join(df).toPandas(), sql(oracles.JACCARD, documents=df.toPandas()))["match"]


def test_cap_components_are_over_ids(spark):
    x, y, z = [1.0, 0.0, 0.0, 0.0] * 4, [0.0, 1.0, 0.0, 0.0] * 4, [0.0, 0.0, 1.0, 0.0] * 4
    for rows in ([(1, x), (2, x), (2, y), (5, y)], [(1, x), (1, y), (2, x), (5, y), (9, z)], [(4, z), (3, x), (4, None), (3, z), (None, x)]):
        df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, label int").repartition(3)
        got = {(r["vec_id"], r["component_id"], r["kept"]) for r in capfilters.near_duplicates(df).collect() if r["vec_id"] is not None}
        want = {i: min(j for j, _ in rows if j is not None) for i, _ in rows if i is not None}
        if (9, z) in rows:
            want[9] = 9
        assert got == {(i, c, i == c) for i, c in want.items()}


def test_repeats_of_repeated_and_null_ids_match_the_sql(spark):
    shared = " ".join(f"shared{i}" for i in range(30))
    rows = [(1, "one " + shared), (1, "one " + shared), (1, "other " + shared), (3, shared + " three"), (None, "null " + shared),
            (None, "null " + shared), (None, "more " + shared)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = repeats.remove_repeats(df).selectExpr("doc AS doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256) AS kept_sha256").toPandas()
    assert compare(got, sql(oracles.REPEATS, documents=df.toPandas().astype({"doc_id": "Int64"})))["match"]

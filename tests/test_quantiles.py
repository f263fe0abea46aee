import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from peerscope.operators.quantiles import exact_quantiles, wide_quantiles


@pytest.mark.parametrize("method, accuracy", [("in_task", 10_000), ("narrowed", 20), ("narrowed", 10_000)])
def test_exact_quantiles_match_pandas_with_hot_group_and_ties(spark, method, accuracy):
    rng = np.random.default_rng(7)
    n = 20000
    g = np.where(rng.random(n) < 0.4, "hot", rng.choice(list("abcde"), n))
    x = np.round(rng.lognormal(4, 1, n), 1)
    x[rng.random(n) < 0.05] = np.nan
    x[:3000] = 55.5
    pdf = pd.DataFrame({"g": g, "x": x})
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0, 1 / 3]
    got = exact_quantiles(spark.createDataFrame(pdf), "x", probs, ["g"], method=method, accuracy=accuracy).toPandas()
    for _, r in got.iterrows():
        want = pdf[pdf.g == r.g].x.dropna().quantile(probs).to_numpy()
        assert np.allclose(np.array(r.quantiles, dtype=float), want), r.g
    overall = exact_quantiles(spark.createDataFrame(pdf), "x", probs, method=method, accuracy=accuracy).toPandas()
    assert np.allclose(np.array(overall.quantiles[0], dtype=float), pdf.x.dropna().quantile(probs).to_numpy())


def test_exact_quantiles_empty_input(spark):
    df = spark.createDataFrame([(1.0,)], "x double").where("x < 0")
    row = exact_quantiles(df, "x", [0.5], method="narrowed").collect()[0]
    assert row.n == 0 and row.quantiles is None


@pytest.mark.parametrize("method", ["in_task", "narrowed"])
def test_wide_quantiles_of_several_columns_null_keys_and_empty_groups(spark, method):
    rng = np.random.default_rng(3)
    n = 5000
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", "none"], n), "x": rng.normal(0, 1e6, n), "y": np.round(rng.exponential(2, n))})
    df = spark.createDataFrame(pdf).withColumn("g", F.when(F.col("g") != "none", F.col("g")))
    df = df.unionByName(spark.createDataFrame([("empty", None, None)], "g string, x double, y double"))
    got = {r["g"]: r for r in wide_quantiles(df, {"qx": "x", "qy": -F.col("y")}, [0.1, 0.5], ["g"], method=method, accuracy=50).collect()}
    assert set(got) == {"a", "b", "empty"}
    assert (got["empty"]["qx"], got["empty"]["qx_n"]) == (None, 0)
    for g in "ab":
        part = pdf[pdf.g == g]
        assert np.allclose(got[g]["qx"], part.x.quantile([0.1, 0.5])) and np.allclose(got[g]["qy"], (-part.y).quantile([0.1, 0.5]))
        assert got[g]["qx_n"] == len(part)


@pytest.mark.parametrize("shift", [-1, 1])
def test_ranks_outside_the_sketched_bracket_are_still_found(spark, monkeypatch, shift):
    """The counts decide, not the sketch: brackets far from the wanted ranks are opened."""
    sketch = F.percentile_approx
    monkeypatch.setattr(F, "percentile_approx", lambda c, probs, acc: sketch(c, [min(max(p + shift * 0.3, 0.0), 1.0) for p in probs], acc))
    df = spark.range(1001).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("x"))
    got = {r["g"]: r["quantiles"] for r in exact_quantiles(df, "x", [0.25, 0.5], ["g"], method="narrowed").collect()}
    for g in range(3):
        assert np.allclose(got[g], pd.Series(range(1001))[lambda s, g=g: s % 3 == g].quantile([0.25, 0.5]))


def test_rows_of_a_group_do_not_meet_in_one_task(spark):
    """A few groups are sent to the rows: no shuffle of whole rows by their group, no sort of one."""
    from pyspark.sql import functions as F

    from peerscope.operators import quantiles as q

    df = spark.range(20_000).select((F.col("id") % 3).cast("string").alias("g"), F.rand(3).alias("x"))
    seen, real = [], q._by_keys
    q._by_keys = lambda *a: seen.append(real(*a)) or seen[-1]
    try:
        q.wide_quantiles(df, {"m": "x"}, [0.5], ["g"], method="narrowed").collect()
    finally:
        q._by_keys = real
    plans = [x._jdf.queryExecution().executedPlan().toString() for x in seen]
    assert len(plans) == 3 and not any("SortMergeJoin" in p for p in (plans[0], plans[2]))

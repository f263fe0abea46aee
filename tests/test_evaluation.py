from pyspark.sql import functions as F

from peerscope.operators import evaluation as ev


def _metrics(spark, rows):
    return spark.createDataFrame(rows, "model string, slice string, value string, mae double")


def test_champion_improves_and_keeps_cities(spark):
    m = _metrics(spark, [("base", "overall", None, 100.0), ("tree", "overall", None, 98.0), ("cat", "overall", None, 88.0),
                         ("base", "city_name", "Roma", 100.0), ("tree", "city_name", "Roma", 98.0),
                         ("cat", "city_name", "Roma", 90.0)])
    r = ev.champion_choice(m, "base").collect()[0]
    assert (r.champion_model_name, r.fallback_model_name) == ("cat", "base")


def test_city_regression_keeps_baseline(spark):
    m = _metrics(spark, [("base", "overall", None, 100.0), ("tree", "overall", None, 80.0),
                         ("base", "city_name", "Milano", 105.0), ("tree", "city_name", "Milano", 125.0)])
    r = ev.champion_choice(m, "base").collect()[0]
    assert (r.champion_model_name, r.fallback_model_name) == ("base", "tree")


def test_group_split_isolates_listings(spark):
    df = spark.createDataFrame([(i, s) for i in range(40) for s in (1, 2)], "listing_id long, snap int")
    out = ev.group_split(df)
    per_id = out.groupBy("listing_id").agg({"split": "count"}).count()
    assert per_id == 40
    assert out.select("listing_id", "split").distinct().count() == 40


def test_leakage_guard():
    assert ev.leakage_findings(["rating_score", "city_nightly_price_median"]) == [
        "Feature `city_nightly_price_median` contains forbidden substring `nightly_price_median`."]


def test_restrict_to_semi_join(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "listing_id long, v string")
    ids = spark.createDataFrame([(1,), (3,), (3,), (None,)], "listing_id long")
    assert sorted(r.v for r in ev.restrict_to(df, ids).collect()) == ["a", "b", "d"]


def test_benchmark_diagnostics_reads_rows_once(spark):
    rows = [(i, "2024-06-15", p, lo, hi, pred) for i, (p, lo, hi, pred) in enumerate([
        (100.0, 90.0, 110.0, 100.0), (50.0, 90.0, 110.0, 80.0), (200.0, 90.0, 110.0, 100.0), (100.0, 90.0, 110.0, 150.0),
        (100.0, 90.0, 110.0, None)])]
    df = spark.createDataFrame(rows, "listing_id long, snapshot_date string, nightly_price double, lo double, hi double, "
                                     "prediction double")
    found = ev.benchmark_diagnostics(
        df.withColumnsRenamed({"lo": "benchmark_lower_bound", "hi": "benchmark_upper_bound"}).drop("prediction"),
        df.select("listing_id", "snapshot_date", "prediction"))
    assert {(r.metric, r.key): r.value for r in found.collect()} == {
        ("model_prediction_inside_benchmark_rate", None): 0.6, ("model_positioning_agreement_rate", None): 0.6,
        ("benchmark_positioning_mae", "aligned"): 25.0, ("benchmark_positioning_mae", "underpriced"): 30.0,
        ("benchmark_positioning_mae", "overpriced"): 100.0}
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_benchmark_diagnostics_of_no_rows(spark):
    none = spark.createDataFrame([], "listing_id long, snapshot_date string, nightly_price double, benchmark_lower_bound double, "
                                     "benchmark_upper_bound double, prediction double")
    out = ev.benchmark_diagnostics(none.drop("prediction"), none.select("listing_id", "snapshot_date", "prediction")).collect()
    assert [(r.key, r.value) for r in out] == [(None, None), (None, None)]


def test_medians_read_the_split_once(spark):
    from peerscope.plans.catalog import _predict

    seen = spark.sparkContext.accumulator(0)
    split = F.udf(lambda x: (seen.add(1), "train" if x % 4 else "test")[1], "string")
    df = spark.createDataFrame([(i, "AB"[i % 2], float(i)) for i in range(40)], "listing_id long, city_name string, nightly_price double")
    out = _predict(df.localCheckpoint().withColumn("split", split("listing_id")), ["city_name"])
    assert seen.value == 40
    got = {r.listing_id: r.prediction for r in out.collect()}
    assert got == {i: 20.0 for i in range(40)}

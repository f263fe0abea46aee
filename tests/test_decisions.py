import pytest
from pyspark.sql import functions as F

from peerscope.operators.decisions import model_benchmark_agreement, model_estimate_interval


def test_interval_with_and_without_calibration(spark):
    df = spark.createDataFrame([(122.69608,)], "estimate double")
    cal = spark.createDataFrame([("heldout_residual_quantiles", 0.8, -62.99731, 58.26724)],
                                "source string, confidence_level double, lower_residual_quantile double, upper_residual_quantile double")
    r = model_estimate_interval(df, "estimate", cal).collect()[0]
    assert r.model_estimate_lower_bound == pytest.approx(59.69877, abs=1e-4)
    assert r.model_estimate_upper_bound == pytest.approx(180.96332, abs=1e-4)
    r = model_estimate_interval(spark.createDataFrame([(125.0,)], "estimate double"), "estimate", None).collect()[0]
    assert (r.model_estimate_lower_bound, r.model_estimate_upper_bound) == (125.0, 125.0)
    assert r.model_estimate_interval_source == "unavailable" and r.model_estimate_interval_confidence_level is None


@pytest.mark.parametrize("est,label,gap,ratio", [(121.0, "medium", 1.0, 0.05), (75.0, "weak", 25.0, 1.25), (110.0, "strong", 0.0, 0.0)])
def test_agreement(spark, est, label, gap, ratio):
    df = spark.createDataFrame([(est, 100.0, 120.0)], "e double, lo double, hi double")
    r = df.select(*model_benchmark_agreement(F.col("e"), F.col("lo"), F.col("hi"))).collect()[0]
    assert r.model_benchmark_agreement_label == label
    assert r.model_benchmark_gap_amount == pytest.approx(gap)
    assert r.model_benchmark_gap_ratio == pytest.approx(ratio)

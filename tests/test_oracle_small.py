"""Registered queries against their DuckDB oracle on the smallest fixture."""
import pytest

from peerscope.plans.catalog import REGISTRY
from peerscope.plans.check import compare, duckdb_connection
from tests.conftest import SMALL

FAST = ["comparables_topn", "benchmark_range_sparse", "city_period_summary", "feature_frame", "rows_by_city_period",
        "price_histogram", "data_profile", "champion_choice", "model_agreement"]


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SMALL)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    q = REGISTRY[name]
    got = q.run(spark, SMALL).toPandas()
    want = con.execute(q.oracle_sql()).df()
    res = compare(got, want)
    assert res["match"], res

"""Sources, sinks and the summary and reference cleaners."""
import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from peerscope.operators import cleaning as cl
from peerscope.operators import features as feat
from peerscope.sources import files


def test_load_sources_and_tables(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name\n1,"x, y"\n2,NA\n')
    geo = {"type": "FeatureCollection", "features": [
        {"properties": {"neighbourhood": "N1", "neighbourhood_group": None}, "geometry": {"type": "Point", "coordinates": [1.0, 2.5]}}]}
    (tmp_path / "g.geojson").write_text(json.dumps(geo))
    spark.range(3).write.parquet(str(tmp_path / "p"))
    made = files.load_sources(spark, [
        files.SourceDescriptor("a", str(tmp_path / "a.csv"), "csv"), files.SourceDescriptor("g", str(tmp_path / "g.geojson"), "geojson"),
        files.SourceDescriptor("p", str(tmp_path / "p"), "parquet")])
    assert [tuple(r) for r in made["a"].orderBy("id").collect()] == [("1", "x, y"), ("2", None)]
    assert made["g"].first()["geometry_type"] == "Point" and made["p"].count() == 3
    with pytest.raises(ValueError):
        files.load_sources(spark, [files.SourceDescriptor("z", "z", "xml")])
    assert files.read_tables(spark, {"p": str(tmp_path / "p")})["p"].count() == 3
    with pytest.raises(FileNotFoundError, match="gone"):
        files.read_tables(spark, {"p": str(tmp_path / "p"), "q": str(tmp_path / "gone")})


def test_versioned_and_joint_writes(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "id long, name string")
    manifest = files.write_versioned(df, "t", str(tmp_path), "v2", ["raw"], sort_keys=["id"]).first()
    assert (manifest["dataset_name"], manifest["row_count"], manifest["columns"]) == ("t", 2, "id|name")
    assert spark.read.parquet(str(tmp_path / "v2/parquet/t")).count() == 2
    assert files.write_versioned(df, "t", str(tmp_path), None, ["raw"]).count() == 1
    both = files.write_tables({"t": df, "u": df.limit(1)}, str(tmp_path / "all"), {"t": ["raw"]})
    assert {(r.dataset_name, r.row_count) for r in both.collect()} == {("t", 2), ("u", 1)}


def test_file_manifest_has_provenance(spark, tmp_path):
    import hashlib

    (tmp_path / "one.csv").write_text("a\n1\n")
    d = files.SourceDescriptor("one", str(tmp_path / "one.csv"), "csv", steward="data team", known_limitations="none known")
    r = files.provenance_manifest(spark, [d]).first()
    assert (r["dataset_name"], r["file_format"], r["steward"], r["known_limitations"]) == ("one", "csv", "data team", "none known")
    assert r["canonical_path"] == str(tmp_path / "one.csv") and r["original_filename"] == "one.csv" and r["size_bytes"] == 4
    assert r["sha256"] == hashlib.sha256(b"a\n1\n").hexdigest()


def test_summary_and_reference_cleaners(spark):
    contract = cl.Contract("s", ("city_name", "period_label"), (
        cl.Field("city_name", "string", False, ("City",)), cl.Field("period_label", "string", False, ("Season",)),
        cl.Field("nightly_price_median", "float", True, ("Price median",)), cl.Field("room_type_entropy", "float", True, ("Room entropy",))))
    raw = spark.createDataFrame([(" roma ", "early  spring", "12.5", "x")], "City string, Season string, `Price median` string, `Room entropy` string")
    assert tuple(cl.clean_grouped_summary(raw, contract).first()) == ("Roma", "Early Spring", 12.5, None)
    ref = spark.createDataFrame([("milano", " Duomo ", None, 1)], "city string, neighbourhood string, neighbourhood_group string, extra int")
    assert tuple(cl.clean_reference(ref).first()) == ("Milano", "Duomo", None)


def test_wanted_features_that_are_missing_come_as_nulls(spark):
    df = spark.createDataFrame([(1, "2024-01-01", "Roma", "P", "N", 10.0, 41.0, 12.0)],
        "listing_id long, snapshot_date string, city_name string, period_label string, neighbourhood_name string, nightly_price double, latitude double, longitude double")
    out = feat.feature_frame(df)
    assert set(feat.model_feature_columns()) <= set(out.columns)
    assert dict(out.dtypes)["beds_count"] == "double" and out.first()["beds_count"] is None
    assert set(feat.rich_feature_columns(True)) > set(feat.rich_feature_columns())
    assert out.select(F.count("latitude")).first()[0] == 1


def test_outputs_are_in_global_order(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("id")).repartition(7)
    files.write_processed(df, "t", str(tmp_path), ["raw"], sort_keys=["id"])
    parts = sorted((tmp_path / "csv" / "t").glob("part-*.csv"))
    lines = [x for p in parts for x in p.read_text().split()[1:]]
    assert len(lines) == 5000 and [int(x) for x in lines] == list(range(5000))
    parts = sorted((tmp_path / "parquet" / "t").glob("part-*.parquet"))
    assert [x for p in parts for x in pq.read_table(p)["id"].to_pylist()] == list(range(5000))


def test_published_versions_survive_a_run_that_stops(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    first = spark.createDataFrame([(2, "b"), (1, "a")], "id long, name string")
    row = files.publish(first, "t", root, ["raw"], ["id"]).first()
    assert row["row_count"] == 2 and [r.id for r in files.read_published(spark, "t", root).collect()] == [1, 2]

    def stop(value):
        raise ValueError("stopped")

    broken = first.withColumn("id", F.udf(stop, "long")("id"))
    with pytest.raises(Exception, match="stopped"):
        files.publish(broken, "t", root, ["raw"], ["id"])
    # stopped behind the data, ahead of the last write
    with monkeypatch.context() as m:
        m.setattr(files.F, "current_timestamp", lambda: stop(None))
        with pytest.raises(ValueError):
            files.publish(first.where("id = 1"), "t", root, ["raw"])
    assert [r.id for r in files.read_published(spark, "t", root).collect()] == [1, 2]
    files.publish(first.where("id = 2"), "t", root, ["raw"])
    assert [r.id for r in files.read_published(spark, "t", root).collect()] == [2]
    assert files.published_versions(spark, "t", root).count() == 2


def test_hashes_of_files_above_one_chunk(spark, tmp_path):
    import hashlib

    data = bytes(range(256)) * (files.HASH_CHUNK // 256 + 3)
    (tmp_path / "big file%1.bin").write_bytes(data)
    (tmp_path / "empty.bin").write_bytes(b"")
    got = {r["file_name"]: (r["size_bytes"], r["sha256"]) for r in files.file_manifest(spark, str(tmp_path)).collect()}
    assert got == {"big file%1.bin": (len(data), hashlib.sha256(data).hexdigest())}  # empty files are not listed


def test_market_sends_lines_by_order_once(spark, tmp_path):
    import datetime as dt

    from peerscope.sources import testdata

    day = dt.datetime(1995, 5, 1)
    made = {"lineitem": ([(1, "F", 30.0), (1, "O", 30.0), (1, "O", 1.0), (1, None, None), (2, None, 5.0), (None, "F", 1.0)],
                         "l_orderkey long, l_linestatus string, l_quantity double"),
            "orders": ([(1, 7, day, 10.0), (2, 7, day + dt.timedelta(1), 11.0), (3, 7, day + dt.timedelta(2), 12.0)],
                       "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double"),
            "customer": ([(7, 1, 100.0, "BUILDING")], "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string"),
            "nation": ([(1, "N", 1)], "n_nationkey int, n_name string, n_regionkey int"),
            "region": ([(1, "R")], "r_regionkey int, r_name string")}
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    df = testdata.market_frame(spark, str(tmp_path))
    got = {r.row_key: (r.accommodates_count, r.beds_count, r.bedrooms_count) for r in df.collect()}
    assert got == {1: (4, 1, 2), 2: (1, 0, 0), 3: (None, None, None)}
    plan = testdata.market_frame(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    sent = [line for line in plan.splitlines() if "Exchange hashpartitioning(l_" in line]
    assert len(sent) == 1 and "l_linestatus" not in sent[0].split("]")[0].split("),")[0], plan

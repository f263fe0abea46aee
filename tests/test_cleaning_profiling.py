import json

from pyspark.sql import functions as F

from peerscope.functions import text as T
from peerscope.operators import cleaning as cl
from peerscope.operators import profiling as prof
from peerscope.operators import validation as val
from peerscope.sources import files


def test_text_golden_vectors(spark):
    vectors = {
        "PARCO BOSCO IN CITT\x85": "PARCO BOSCO IN CITTÀ", "PARCO BOSCO IN CITTÂ…": "PARCO BOSCO IN CITTÀ",
        "VII San Giovanni/CinecittÃ\xa0": "VII San Giovanni/Cinecittà", "cafÃ©  du\x1ccoin": "café du coin",
        "Ã?": "Ã?", "\ufeff ": None, "ﬁn\u3000 a": "fin a", "plain": "plain", None: None,
    }
    rows = spark.createDataFrame([(k, v) for k, v in vectors.items()], "raw string, want string")
    for r in T.normalize_columns(rows.withColumn("got", F.col("raw")), ["got"]).collect():
        assert r.got == r.want, r
    slugs = T.slug_columns(spark.createDataFrame([("VII San Giovanni/Cinecittà",), (None,), ("—",)], "s string"), {"s": "o"})
    assert [r.o for r in slugs.collect()] == ["vii_san_giovanni_cinecitta", "unknown", "unknown"]
    df = spark.createDataFrame(
        [(" roma ", "early spring", "Superhost", "43.77709, 11.25216", "VII San Giovanni/Cinecittà"),
         ("﻿Milano\t", "Early  Summer", "Host", "bad-value", "  Duomo  "),
         (None, "   ", "Unknown", "1, 2, 3", None)],
        "c string, p string, f string, xy string, s string")
    df = T.normalize_columns(df, ["c", "p", "f", "xy"])
    df = T.with_coordinates(df, "xy")
    df = T.slug_columns(df, {"s": "slug"})
    rows = df.select(T.city_label(F.col("c")).alias("c"), T.period_label(F.col("p")).alias("p"),
                     T.superhost_flag(F.col("f")).alias("f"), "latitude", "longitude", "slug").collect()
    assert [tuple(r) for r in rows] == [
        ("Roma", "Early Spring", True, 43.77709, 11.25216, "vii_san_giovanni_cinecitta"),
        ("Milano", "Early Summer", False, None, None, "duomo"),
        (None, None, None, None, None, "unknown"),
    ]


def test_coordinates_and_contract_numbers_refuse_type_suffixes(spark, tmp_path):
    vectors = {"45.1d, 9.2": (None, None), "45.1f, 9f": (None, None), "0x1p3, 9": (None, None), "45.1, ": (None, None),
               "45.1": (None, None), " 45.1 ,9": (45.1, 9.0), "+4.5e1,-1_0.5": (45.0, -10.5), None: (None, None)}
    rows = T.with_coordinates(spark.createDataFrame([(k,) for k in vectors], "xy string"), "xy").collect()
    assert {r.xy: (r.latitude, r.longitude) for r in rows} == vectors
    (tmp_path / "t.csv").write_text("id,x\n1,12d\n2,12.5\n3,nan\n4,\n")
    contract = cl.Contract("t", ("id",), (cl.Field("id", "integer", False, ("id",)), cl.Field("x", "float", True, ("x",))))
    read = files.read_csv_with_contract(spark, str(tmp_path / "t.csv"), contract)
    assert sorted(map(tuple, read.collect())) == [(1, None), (2, 12.5), (3, None), (4, None)]


def test_primitive_types(spark):
    vals = ["", "12", "1_000", "-3.5e2", "nan", "2024-06-15", "2024-02-30", "abc", ".5"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r.t for r in df.select(T.primitive_type(F.col("v")).alias("t")).collect()]
    assert got == ["empty", "integer", "integer", "float", "float", "date", "string", "string", "float"]


def test_boundary_ids(spark):
    feats = spark.createDataFrame(
        [(0, "Centro Storico", None, "MultiPolygon", '{"type": "MultiPolygon", "coordinates": [[[11.250, 43.7]]]}'),
         (1, "Duomo", None, "MultiPolygon", '{"coordinates": [], "type": "MultiPolygon"}')],
        "raw_feature_index long, neighbourhood string, neighbourhood_group string, geometry_type string, geometry string")
    ref = spark.createDataFrame([("Firenze", "Centro Storico", "Centro Storico"), ("Firenze", "Duomo", "Centro Storico")],
                                "city_name string, neighbourhood_name string, neighbourhood_group_name string")
    rows = {r.neighbourhood_name: r for r in cl.clean_boundaries(feats, ref).collect()}
    assert rows["Centro Storico"].boundary_id == "firenze_centro_storico_centro_storico_001"
    assert rows["Duomo"].boundary_id == "firenze_duomo_centro_storico_001"
    assert rows["Duomo"].geometry == '{"coordinates":[],"type":"MultiPolygon"}'


RAW_HEADER = ["Listings id", "City", "Season", "Date of scraping", "Price", "Coordinates", "Host is superhost"]


def _raw_csv(tmp_path):
    p = tmp_path / "listings.csv"
    p.write_text(",".join(f'"{h}"' for h in RAW_HEADER) + "\n"
                 '1,Firenze,Early Spring,2024-03-15,120.5,"43.77, 11.25",Superhost\n'
                 '1,firenze,early summer,2024-06-15,NA,"43.78, 11.26",Host\n', encoding="utf-8")
    return str(p)


def test_listing_cleaner_and_profile(spark, tmp_path):
    raw = files.read_raw_csv(spark, _raw_csv(tmp_path))
    clean = cl.clean_listing_snapshot(raw).collect()
    assert [r.city_name for r in clean] == ["Firenze", "Firenze"]
    assert [r.nightly_price for r in clean] == [120.5, None]
    assert clean[0].latitude == 43.77 and clean[1].is_superhost is False
    profile = {r.field: r for r in prof.field_profile(raw.withColumn("_ord", F.monotonically_increasing_id()), "_ord").collect()}
    assert profile["Price"].inferred_type == "float" and profile["Price"].null_count == 1
    assert profile["Listings id"].inferred_type == "integer"
    cov = prof.coverage(cl.clean_listing_snapshot(raw), {"cities": "city_name", "periods": "period_label",
                                                         "dates": "snapshot_date"}).collect()[0]
    assert (cov.cities, cov.periods, cov.dates) == ("Firenze", "Early Spring|Early Summer", "2024-03-15|2024-06-15")
    keys = prof.candidate_keys(raw, [["Listings id", "Date of scraping"], ["Listings id"]]).collect()
    assert [(k.columns, k.duplicate_key_count) for k in keys] == [("Listings id,Date of scraping", 0), ("Listings id", 1)]


def test_geojson_source_and_profile(spark, tmp_path):
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"neighbourhood": "Centro Storico", "neighbourhood_group": None},
         "geometry": {"type": "MultiPolygon", "coordinates": [[[[11.25, 43.77], [11.26, 43.78]]]]}},
        {"type": "Feature", "properties": {"neighbourhood": "Duomo"},
         "geometry": {"type": "MultiPolygon", "coordinates": []}}]}
    p = tmp_path / "b.geojson"
    p.write_text(json.dumps(doc), encoding="utf-8")
    feats = files.read_geojson_features(spark, str(p))
    rows = feats.orderBy("raw_feature_index").collect()
    assert [r.neighbourhood for r in rows] == ["Centro Storico", "Duomo"]
    assert rows[0].geometry_type == "MultiPolygon" and "11.25" in rows[0].geometry
    assert json.loads(rows[0].geometry) == doc["features"][0]["geometry"]
    got = {r.property: (r.inferred_type, r.non_empty_count, r.null_count, r.feature_count, r.geometry_types)
           for r in prof.geojson_profile(feats).collect()}
    assert got == {"neighbourhood": ("string", 2, 0, 2, "MultiPolygon"), "neighbourhood_group": ("string", 0, 2, 2, "MultiPolygon")}


def test_geojson_features_without_parts(spark, tmp_path):
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": None, "geometry": None},
        {"type": "Feature", "properties": {"n": 3, "ok": True, "name": 'a } " b'}, "geometry": {"type": "Point", "coordinates": [1, 2.5]}}]}
    p = tmp_path / "c.geojson"
    p.write_text(json.dumps(doc), encoding="utf-8")
    feats = files.read_geojson_features(spark, str(p))
    rows = feats.orderBy("raw_feature_index").collect()
    assert (rows[0].properties, rows[0].geometry_type, rows[0].geometry) == (None, None, None)
    assert rows[1].properties == {"n": "3", "ok": "true", "name": 'a } " b'} and rows[1].geometry_type == "Point"
    got = {r.property: (r.inferred_type, r.non_empty_count, r.null_count) for r in prof.geojson_profile(feats).collect()}
    assert got["n"] == ("integer", 1, 1) and got["name"] == ("string", 1, 1)


def test_listing_semantic_findings(spark):
    df = spark.createDataFrame([("Torino", "Spring", 0.0, 200.0, 10.0, 6.0)],
                               "city_name string, period_label string, nightly_price double, latitude double, "
                               "longitude double, rating_score double")
    checks = sorted(r.check_name for r in val.listing_semantic_findings(df).collect())
    assert checks == ["canonical_city_labels", "canonical_period_labels", "coordinate_bounds", "positive_nightly_price",
                      "rating_bounds"]


def test_contract_null_and_key_findings(spark):
    contract = cl.REFERENCE_CONTRACT
    df = spark.createDataFrame([(None, "A", "g"), ("Roma", "B", None), ("Roma", "B", None)],
                               "city_name string, neighbourhood_name string, neighbourhood_group_name string")
    found = val.validate({"neighbourhood_reference": (df, contract)}).collect()
    by = {r.check_name: r.message for r in found}
    assert by["non_nullable_fields"] == "Field `city_name` contains `1` null values but is non-nullable."
    assert by["primary_key_uniqueness"] == "Primary key `city_name, neighbourhood_name` contains `1` duplicate rows."
    missing = val.contract_column_findings(df.drop("neighbourhood_group_name"), contract).collect()
    assert [r.check_name for r in missing] == ["missing_contract_columns"]


def test_coercion_rejects_what_is_no_number_or_date(spark):
    vals = ["12d", "1.5f", " 7 ", "2.5", "3.5", "1e3", "nan", "inf", "x", "", None, "0x10", ".5"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [(r.i, r.f) for r in df.select(cl.to_integer(F.col("v")).alias("i"), cl.to_float(F.col("v")).alias("f")).collect()]
    inf = float("inf")
    assert got == [(None, None), (None, None), (7, 7.0), (2, 2.5), (4, 3.5), (1000, 1000.0), (None, None), (None, inf),
                   (None, None), (None, None), (None, None), (None, None), (0, 0.5)]
    days = ["2024-03-15garbage", "2024-03-15", "2024-03-15T10:20:30Z", "2024-03-15 10:20", "2024-13-01", None]
    df = spark.createDataFrame([(v,) for v in days], "v string")
    got = [str(r.d) for r in df.select(cl.to_date(F.col("v")).alias("d")).collect()]
    assert got == ["None", "2024-03-15", "2024-03-15", "2024-03-15", "None", "None"]


def test_canonical_json_keeps_the_form_of_numbers(spark):
    vals = ['{"b": 12.0, "a": [1, 1.50]}', "1.0", "{bad", None, '"é"', "NaN"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    assert [r.j for r in df.select(T.canonical_json(F.col("v")).alias("j")).collect()] == [
        '{"a":[1,1.5],"b":12.0}', "1.0", None, None, '"é"', None]


def test_findings_of_every_kind(spark):
    boundary = spark.createDataFrame(
        [("b1", "Atlantis", "Nowhere", "Point"), ("b1", "Roma", "Else", "Polygon")],
        "boundary_id string, city_name string, neighbourhood_name string, geometry_type string")
    ref = spark.createDataFrame([("Roma", "Centro", None)], cl.REFERENCE_CONTRACT and "city_name string, neighbourhood_name string, neighbourhood_group_name string")
    manifest = spark.createDataFrame([("other", 5, "a|b")], "dataset_name string, row_count long, columns string")
    found = val.validate({"neighbourhood_boundary": (boundary, cl.BOUNDARY_CONTRACT), "neighbourhood_reference": (ref, cl.REFERENCE_CONTRACT)},
                         manifests={"neighbourhood_boundary": manifest})
    found = found.unionByName(val.cross_dataset_findings(boundary, ref)).cache()
    rows = {(r.check_name, r.message) for r in found.collect()}
    assert ("geometry_type_values", "Unexpected geometry types found: Point.") in rows
    assert ("canonical_city_labels", "Unexpected city labels found: Atlantis.") in rows
    assert ("boundary_reference_alignment", "Boundary neighbourhoods missing from reference vocabulary: Else.") in rows
    assert ("manifest_dataset_name", "Manifest dataset_name is `other` instead of `neighbourhood_boundary`.") in rows
    assert ("manifest_row_count", "Manifest row_count is `5` but dataset has `2` rows.") in rows
    assert ("manifest_columns", "Manifest column list does not match the actual dataset columns.") in rows
    assert any(c == "primary_key_uniqueness" for c, _ in rows) and any(c == "missing_contract_columns" for c, _ in rows)
    status = {r.dataset: r.status for r in val.validation_status(found, ["neighbourhood_boundary", "neighbourhood_reference"]).collect()}
    assert status == {"neighbourhood_boundary": "failed", "neighbourhood_reference": "passed", "overall": "failed"}


def test_geojson_properties_profile(spark):
    df = spark.createDataFrame([("Polygon", {"a": "1", "b": None}), ("Point", {"a": "2.5"})], "geometry_type string, properties map<string,string>")
    got = {r.property: (r.inferred_type, r.non_empty_count, r.null_count, r.geometry_types) for r in prof.geojson_profile(df).collect()}
    assert got == {"a": ("float", 2, 0, "Point|Polygon"), "b": ("string", 0, 2, "Point|Polygon")}


def test_listing_cleaner_is_compiled(spark, capsys):
    """The JVM interprets generated methods of more than 8,000 bytes, whatever the number of rows."""
    import re

    from peerscope.sources.testdata import RAW_HEADERS

    headers = [*RAW_HEADERS.values(), "Host is superhost", "Coordinates"]
    raw = spark.range(3).select(*[F.concat(F.lit(h), F.col("id").cast("string")).alias(h) for h in headers])
    clean = cl.clean_listing_snapshot(raw)
    assert clean._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1  # texts go to Python once
    clean.explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8_000


def test_plain_and_other_texts_are_normalised_alike(spark):
    vectors = {
        "plain text": "plain text", " a  b\t": "a b", "﻿x\r\n": "x", "": None, " \t\n": None, "﻿": None, None: None,
        "a b\x1cc": "a b c", " x ": "x", "ﬁne ①": "fine 1", "CittÃ ": "CittÃ", "perchÃ©": "perché", "Â£ 5": "£ 5",
        "PARCO BOSCO IN CITT\x85": "PARCO BOSCO IN CITTÀ", "PARCO BOSCO IN CITT  \x85": "PARCO BOSCO IN CITTÀ",
        " VII San Giovanni/CinecittÃ ": "VII San Giovanni/Cinecittà", "x \n ": "x", "Ã Ω": "Ã Ω",
    }
    df = spark.createDataFrame([(i, k) for i, k in enumerate(vectors)], "i int, x string")
    got = [r.x for r in T.normalize_columns(df, ["x"]).orderBy("i").collect()]
    assert got == list(vectors.values())

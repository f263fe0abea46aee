import datetime as dt


from peerscope.operators import eda
from peerscope.operators.features import model_input, model_input_profile


def _eda(spark):
    rows = [(1, "Roma", "Early Summer", "Entire home", 200.0, 4, "Centro"),
            (2, "Roma", "Early Winter", "Private room", 80.0, 2, "Centro"),
            (3, "Milano", "Early Summer", "Entire home", 150.0, 3, "Duomo"),
            (4, "Milano", "Early Spring", "Hotel room", 140.0, 1, "Duomo"),
            (5, "Napoli", "Early Autumn", "Shared room", 40.0, 1, "Mercato"),
            (6, "Napoli", "Early Summer", "Private room", 60.0, 6, "Mercato"),
            (7, "Roma", "Early Autumn", "Entire home", 220.0, 8, "Centro")]
    return spark.createDataFrame(rows, "listing_id long, city_name string, period_label string, room_type string, "
                                       "nightly_price double, accommodates_count long, neighbourhood_name string")


def test_counts_and_share(spark):
    df = _eda(spark)
    assert {r.city_name: r.row_count for r in eda.rows_by_city(df).collect()} == {"Roma": 3, "Milano": 2, "Napoli": 2}
    assert eda.rows_by_city_and_period(df).columns == ["city_name", *eda.PERIOD_ORDER]
    share = {r.room_type: r.share for r in eda.room_type_share(df).collect()}
    assert round(share["Entire home"], 3) == 0.429


def test_medians_and_bands(spark):
    df = _eda(spark)
    assert {r.city_name: r.median_nightly_price for r in eda.median_price_by(df, ["city_name"]).collect()} == {
        "Roma": 200.0, "Milano": 145.0, "Napoli": 50.0}
    cp = {r.city_name: r["Early Summer"] for r in eda.median_price_by_city_and_period(df).collect()}
    assert cp["Roma"] == 200.0
    bands = {r.accommodates_band: r.median_nightly_price for r in eda.median_price_by_capacity_band(df).collect()}
    assert bands == {"1-2 guests": 80.0, "3-4 guests": 175.0, "5-6 guests": 60.0, "7+ guests": 220.0}


def test_extremes(spark):
    rows = eda.neighbourhood_price_extremes(_eda(spark), min_listing_rows=1, top_n=1, bottom_n=1).collect()
    top = [r for r in rows if r.segment == "Top priced"]
    assert len(top) == 1 and top[0].label == "Roma\nCentro"
    assert len([r for r in rows if r.segment == "Lower priced"]) == 1


def test_model_input_rules(spark):
    listings = spark.createDataFrame(
        [(1, dt.date(2024, 6, 15), dt.date(2020, 6, 15), "Venezia", "San Marco", "Early Summer", 180.0),
         (2, dt.date(2024, 6, 15), dt.date(2025, 1, 1), "Venezia", "San Marco", "Early Summer", 1501.0),
         (3, dt.date(2024, 6, 15), None, "Roma", "Centro", "Early Spring", 90.0)],
        "listing_id long, snapshot_date date, host_since date, city_name string, neighbourhood_name string, "
        "period_label string, nightly_price double")
    ref = spark.createDataFrame([("Venezia", "San Marco", "Lagoon North"), ("Roma", "Centro", "Municipio I")],
                                "city_name string, neighbourhood_name string, neighbourhood_group_name string")
    rows = {r.listing_id: r for r in model_input(listings, ref).collect()}
    assert set(rows) == {1, 3}
    assert rows[1].host_tenure_days == 1461 and rows[1].venezia_group_name == "Lagoon North"
    assert rows[1].season_peak_flag is True and rows[1].season_shoulder_flag is False
    assert rows[3].host_tenure_days is None and rows[3].venezia_group_name is None
    p = model_input_profile(listings, ref).collect()[0]
    assert (p.row_count, p.rows_removed_for_high_price_outliers) == (2, 1)

import math
import random

import pytest
from pyspark.sql import functions as F

from regionscore import fixed, schemas
from regionscore.landing import computed_once, drop_landed, land, with_constants
from regionscore.operators import geo
from regionscore.operators.rent import sized_grid, sweden_rent_grid
from regionscore.plans import listings as L
from regionscore.plans import regions as R
from regionscore.plans.region_features import norway_features, sweden_features
from regionscore.plans.runs import detail_pages, scored_listings
from test_resolve_rent import dims as place_dims

SIGNALS = "listing_id string, gross_yield_pct double, price_per_sqm double, latest_price_sqm double, price_growth_1y double, debt_burden_pct double"
MACRO = {"nibor_percentile_10y": 0.8, "nibor_trend_6m": 0.5, "m3_acceleration": -1.0}


def score(spark, rows, macro=MACRO, schema=SIGNALS, **kw):
    df = spark.createDataFrame(rows, schema)
    return {r.listing_id: r for r in L.rank_listings(L.score_listings(df, macro, **kw)).collect()}


def test_scores_by_hand(spark):
    out = score(spark, [("a", 4.0, 100.0, 200.0, 1.0, 10.0), ("b", 8.0, 400.0, 200.0, 3.0, 30.0), ("c", None, 100.0, 0.0, None, None)])
    # b: best yield, worst price ratio; growth: best of the only known signal, the rest is neutral
    b = out["b"]
    assert b.yield_score == 75.0 and b.growth_score == 75.0
    risk = 0.2 * (0.4 * 0.8 + 0.3 + 0.3) + 0.2 * 0.5 + 0.15 * 0.5 + 0.1 * 0.6 + 0.15 * 1.0 + 0.2 * 0.5
    assert b.risk_score == pytest.approx(risk)
    assert b.composite_score == round(75.0 * (1 - 0.3 * risk), 1)
    # c: gaps score at the median of the column
    assert out["c"].yield_score == pytest.approx(100 * (0.75 * 0.5 + 0.25 * 0.5)) and out["c"].risk_label == "Medium"
    assert sorted(r["rank"] for r in out.values()) == [1, 2, 3]
    assert [r.recommendation for r in sorted(out.values(), key=lambda r: r["rank"])] == ["BUY", "HOLD", "AVOID"]


def test_absent_columns_and_unknown_macro_are_neutral(spark):
    df = spark.createDataFrame([("a", 1000.0, 100.0), ("b", 500.0, 100.0)], "listing_id string, estimated_annual_rent double, total_price_calc double")
    out = {r.listing_id: r for r in L.rank_listings(L.score_listings(df, {})).collect()}
    assert out["a"].gross_yield_pct == 1000.0 and out["a"].yield_score == 87.5 and out["b"].yield_score == 12.5
    assert out["a"].growth_score == 50.0
    assert out["a"].risk_score == pytest.approx(0.2 * (0.4 * 0.5 + 0.3 * 0.5) + 0.8 * 0.5)


def test_growth_3y_falls_back_to_1y(spark):
    rows = [("a", 1.0), ("b", 2.0)]
    out = score(spark, rows, schema="listing_id string, price_growth_1y double")
    assert out["b"].growth_score == pytest.approx(100 * (0.5 + 0.5 * 0.5))


def test_weights_are_normalised(spark):
    rows = [("a", 4.0, 100.0, 200.0, 1.0, 10.0), ("b", 8.0, 400.0, 200.0, 3.0, 30.0)]
    one = score(spark, rows, yield_weight=0.4, growth_weight=0.3)
    two = score(spark, rows, yield_weight=4.0, growth_weight=3.0)
    assert [r.composite_score for r in one.values()] == [r.composite_score for r in two.values()]
    assert all(r.composite_score == 0.0 for r in score(spark, rows, yield_weight=0.0, growth_weight=0.0).values())


def test_a_single_listing_is_avoided(spark):
    out = score(spark, [("a", 4.0, 100.0, 200.0, 1.0, 10.0)])
    assert (out["a"]["rank"], out["a"].recommendation, out["a"].percentile, out["a"].yield_score) == (1, "AVOID", 100.0, 50.0)


def test_score_invariants(spark):
    r = random.Random(7)
    maybe = lambda lo, hi: None if r.random() < 0.25 else r.uniform(lo, hi)
    rows = [(f"{i:04}", maybe(0, 20), maybe(1, 9e4), maybe(0, 9e4), maybe(-20, 20), maybe(0, 90)) for i in range(503)]
    out = score(spark, rows)
    ranked = sorted(out.values(), key=lambda x: x["rank"])
    assert [x["rank"] for x in ranked] == list(range(1, 504))
    assert all(0 <= x.composite_score <= 100 and 0 <= x.yield_score <= 100 and 0 <= x.growth_score <= 100 for x in ranked)
    keys = [(-x.composite_score, x.listing_id) for x in ranked]
    assert keys == sorted(keys)
    tiers = [x.recommendation for x in ranked]
    assert tiers == ["BUY"] * 100 + ["HOLD"] * 303 + ["AVOID"] * 100


@pytest.mark.parametrize("acceleration, want", [(-5.0, 1.0), (0.0, 0.5), (5.0, 0.0), (None, 0.5), (-50.0, 1.0)])
def test_tightening(acceleration, want):
    assert L.tightening(acceleration) == want


def test_radius_and_city_filters(spark, rows):
    df = spark.createDataFrame([("a", "5001", 63.43, 10.39), ("b", "0301", 59.91, 10.75), ("c", "5001", None, None)], "id string, municipality_code string, lat double, lon double")
    assert rows(L.within_radius(df, 63.43049, 10.39506, 20000.0), "id") == [("a",)]
    assert rows(L.filter_regions(df, ["5001"]), "id") == [("a",), ("c",)]


def _far(a, b, c, e):
    h = math.sin(math.radians(a - c) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(b - e) / 2) ** 2
    return math.asin(min(1.0, math.sqrt(h))) * 2 * 6_371_000.0


def _points(spark):
    r = random.Random(11)
    spots = [(r.uniform(-90, 90), r.uniform(-180, 180)) for _ in range(300)] + [(r.choice([89.9, -89.95, 0.0, 59.9]) + r.uniform(-0.1, 0.1), r.choice([180.0, -180.0, 179.9, -179.9, 10.0]) + r.uniform(-0.2, 0.2)) for _ in range(300)]
    spots = [(max(-90.0, min(90.0, a)), b) for a, b in spots] + [(90.0, 0.0), (-90.0, 5.0), (0.0, 180.0), (0.0, -180.0), (59.9, 370.1), (None, 1.0), (1.0, None)]
    return spots, spark.createDataFrame([(i, *s) for i, s in enumerate(spots)], "id int, lat double, lon double").repartition(4)


CENTRES = [(0, 89.95, 10.0, 30_000.0), (1, -89.99, 0.0, 5_000.0), (2, 0.0, 179.95, 20_000.0), (3, 0.0, -179.99, 15_000.0), (4, 59.9, 10.0, 12_000.0), (5, 10.0, 10.0, 9_000_000.0),
           (6, 0.0, 0.0, 30_000_000.0), (7, 59.9, 10.0, 0.0), (8, 60.0, 10.1, 400.0), (9, 80.0, -170.0, 2_000_000.0)]


def test_near_centres_equal_all_pairs(spark, rows):
    spots, points = _points(spark)
    centres = spark.createDataFrame([*CENTRES, (20, None, 1.0, 5.0), (21, 1.0, 1.0, None), (22, 1.0, 1.0, -3.0)], "centre_id int, lat double, lon double, metres double")
    want = sorted((i, k) for i, (a, b) in enumerate(spots) if a is not None and b is not None for k, c, e, m in CENTRES if _far(a, b, c, e) <= m)
    assert sorted(rows(L.near_centres(points, centres), "id", "centre_id")) == want
    assert L.near_centres(points, centres.limit(0)).collect() == []


def test_a_circle_around_the_whole_earth_holds_every_point(spark, rows):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, -80.0, 170.0), (3, 90.0, -180.0)], "id int, lat double, lon double")
    centres = spark.createDataFrame([("all", 0.0, 0.0, 4e7), ("point", 90.0, 12.0, 0.0)], "centre_id string, lat double, lon double, metres double")
    near = rows(L.near_centres(points, centres.filter("centre_id = 'all'")), "id", "centre_id")
    assert near == [(1, "all"), (2, "all"), (3, "all")]


def test_cells_of_a_circle_are_hardly_larger_than_it(spark):
    centres = spark.createDataFrame([("a", 60.0, 10.0, 20000.0), ("b", 0.0, 179.99, 5.0)], "centre_id string, lat double, lon double, metres double")
    area = F.pow(F.lit(40_030_174.0 / 1000) / F.pow(F.lit(2.0), F.col("_level")), F.lit(2)) * F.cos(F.radians("_lat")) / (math.pi * F.pow(F.col("metres") / 1000, F.lit(2)))
    found = geo.covering_cells(centres).groupBy("centre_id").agg(F.sum(area).alias("times"), F.count(F.lit(1)).alias("n")).collect()
    assert len(found) == 2 and all(1 <= r["times"] < 4 and r["n"] <= 100 for r in found)


def test_circles_meet_points_in_blocks_without_a_row_for_each_cell(spark, rows, monkeypatch):
    """A row moves once, in a block: wide circles land no more rows than narrow ones, and large tables are not shuffled by cell."""
    rng = random.Random(5)
    spots = [(i, rng.uniform(59, 61), rng.uniform(9, 11), "x" * (i % 3)) for i in range(300)] + [(300, math.nan, 10.0, None), (300, 60.0, 10.0, None)]
    around = [(k, rng.uniform(59, 61), rng.uniform(9, 11), 1000.0 * (1 + 20 * (k % 4))) for k in range(60)] + [(0, 60.0, 10.0, 0.0), (None, 60.0, 10.0, 500.0)]
    points = spark.createDataFrame(spots, "id int, lat double, lon double, text string")
    centres = spark.createDataFrame(around, "centre_id int, lat double, lon double, metres double")
    landed = []
    sized = geo.sized
    monkeypatch.setattr(geo, "sized", lambda df: landed.append(sized(df)) or landed[-1])
    monkeypatch.setattr(geo, "POINTS_A_BLOCK", 16)
    monkeypatch.setattr(geo, "CENTRES_A_BLOCK", 8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = L.near_centres(points, centres)
        want = sorted(((i, t, k) for i, a, b, t in spots for k, c, e, m in around if _far(a, b, c, e) <= m), key=str)
        assert found.columns == ["id", "lat", "lon", "text", "centre_id"]
        assert sorted([(r["id"], r["text"], r["centre_id"]) for r in found.collect()], key=str) == want and len(want) > 500
        assert sum(df.count() for df in landed) <= 62
        assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("centre", CENTRES)
def test_the_box_around_a_circle_loses_no_point(spark, rows, centre):
    spots, points = _points(spark)
    _, lat, lon, metres = centre
    want = sorted((i,) for i, (a, b) in enumerate(spots) if a is not None and b is not None and _far(a, b, lat, lon) <= metres)
    assert sorted(rows(L.within_radius(points, lat, lon, metres), "id")) == want


def test_the_box_is_pushed_to_the_files(spark, tmp_path):
    _points(spark)[1].write.parquet(str(tmp_path / "points"))
    plan = L.within_radius(spark.read.parquet(str(tmp_path / "points")), 59.9, 10.0, 5000.0)._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters")[1]
    assert "GreaterThanOrEqual(lat" in pushed and "LessThanOrEqual(lat" in pushed and "lon" in pushed


# ---- region model ------------------------------------------------------------------------------


def region_tables(spark):
    regions = [(c, str(i), f"R{i}") for c in ("NO", "SE") for i in range(4)]
    growth = [(c, k, n, t, float(i * 3 % 7), None, 100.0 + i) for i, (c, k, n) in enumerate(regions) for t in ("flat", "house")]
    yields = [(c, k, n, 1000.0 * i, 100.0 + i, 1.0, 3.0 + i) for i, (c, k, n) in enumerate(regions)]
    rate = [(c, k, y, (float(i) if y == "2023" else None), 1.0) for i, (c, k, _) in enumerate(regions) for y in ("2022", "2023", "2024")]
    index = [(c, k, t, str(p), float((i + 1) * (-1) ** p)) for i, (c, k, _) in enumerate(regions) for t in ("flat", "house") for p in range(3)]
    make = spark.createDataFrame
    return {
        "growth": make(growth, schemas.REGION_GROWTH), "yield": make(yields, schemas.REGION_YIELD),
        "building_rate": make(rate, schemas.REGION_BUILDING_RATE), "price_index": make(index, schemas.REGION_INDEX),
        "completion": make([("NO", "0", "2024", 1.5)], schemas.REGION_COMPLETION), "permit_momentum": make([], schemas.REGION_MOMENTUM),
    }


def test_region_model(spark):
    table = R.region_feature_table(region_tables(spark))
    rows = {(r.country, r.region_code, r.dwelling_type): r for r in table.collect()}
    assert len(rows) == 16
    one = rows["SE", "1", "flat"]
    assert one.permits_per_1000_stock == 5.0 and one.index_gap == 2.0 and one.national_avg_yield == 8.5 and one.yield_premium == -0.5
    assert rows["NO", "0", "flat"].index_gap == 7.0
    own = R.region_feature_table(region_tables(spark), gap_by_country=True)
    assert {r.index_gap for r in own.filter("country = 'NO' and region_code = '0'").collect()} == {3.0}
    scores = R.score_regions(table)
    best = {r.country: r for r in scores.filter("region_code = '3' and dwelling_type = 'flat'").collect()}
    # highest yield and premium, most building, dearest
    assert best["NO"].yield_score == 65.0 and best["NO"].yield_pct_rank == 93.8
    assert {r.country for r in R.recommend(scores, country="NO").collect()} == {"NO"}


def test_recommend(spark):
    scores = R.score_regions(R.region_feature_table(region_tables(spark)))
    out = R.recommend(scores, "yield", top_n=4).orderBy("rank").collect()
    assert [r.recommendation for r in out] == ["BUY"] * 4 + ["HOLD"] * 10 + ["AVOID"] * 2
    assert [r.yield_score for r in out] == sorted((r.yield_score for r in out), reverse=True)
    assert {r.objective for r in out} == {"YIELD"} and {r.risk_score for r in out} <= {"Low", "Medium", "High"}
    assert R.recommend(scores, min_yield=9.0, min_growth=0.0).filter("gross_yield_pct < 9").count() == 0
    assert R.recommend(scores, min_yield=0).count() == 16
    short = R.shortlist(R.recommend(scores, top_n=4), 4)
    assert short.groupBy("recommendation").count().orderBy("recommendation").collect() == [("AVOID", 2), ("BUY", 4)]


def test_scenarios(spark):
    table = R.region_feature_table(region_tables(spark))
    out = R.scenario(table)
    assert out.count() == 48 and out.filter("recommendation = 'BUY'").groupBy("scenario").count().select("count").distinct().collect() == [(5,)]
    same = R.scenario(table, {"only": (0.5, 0.5)}).orderBy("rank").select("composite_score").collect()
    assert same == R.recommend(R.score_regions(table)).orderBy("rank").select("composite_score").collect()
    with pytest.raises(ValueError):
        R.scenario(table, {"wrong": (0.5, 0.6)})
    with pytest.raises(ValueError):
        R.score_regions(table, 0.3, 0.3)


# ---- features and whole runs -------------------------------------------------------------------


def norway_tables(spark):
    make = spark.createDataFrame
    years = [str(y) for y in range(2020, 2025)]
    quarters = [f"{y}K{q}" for y in (2023, 2024) for q in range(1, 5)]
    names = {"0301": "oslo", "5001": "trondheim"}
    return {
        "price_sqm": make([(k, n, n, y, 50000.0 + 1000 * i) for k, n in names.items() for i, y in enumerate(years)],
                          "municipality_code string, municipality string, municipality_clean string, year string, price_sqm double"),
        "price_index": make([("TOTAL", "Hele landet", q, 100.0 + i) for i, q in enumerate(quarters)], "region_code string, region string, quarter string, index_value double"),
        "rent": make([("1.01", 30.0, 9000.0), ("1.01", 70.0, 13000.0), ("4.01", 30.0, 7000.0)], "zone_code string, sqm double, monthly_rent double"),
        "population": make([(k, n, 1000.0) for k, n in names.items()], "municipality_code string, municipality_clean string, population double"),
        "construction": make([("0301", "oslo", q, 5.0) for q in quarters], "municipality_code string, municipality_clean string, quarter string, permits double"),
    }


def test_norway_features_with_missing_tables(spark, rows):
    features, grid, index = norway_features(norway_tables(spark))
    assert features.columns == schemas.FEATURES_NO.names
    assert rows(features, "municipality_clean", "price_growth_1y", "permits_per_1000", "permit_momentum", "employment_hhi") == [
        ("oslo", 1.89, 20.0, 0.0, None), ("trondheim", 1.89, None, None, None)]
    assert grid is not None and index.count() == 1


def test_sweden_features_from_the_region_dimension(spark, rows):
    dim, _ = place_dims(spark, "sweden")
    make = spark.createDataFrame
    tables = {
        "housing_prices": make([("180", "2023", 100.0), ("180", "2023", 300.0), ("180", "2024", 220.0)], "municipality_code string, year string, avg_price_tkr double"),
        "population": make([("180", 10.0), ("180", 5.0)], "municipality_code string, population_half double"),
        "employment": make([("180", "A", 3.0), ("180", "A", 1.0), ("180", "B", 4.0), ("180", "C", 0.0)], "municipality_code string, industry_code string, employed double"),
        "wages": make([("0180", "2024", 12.0), ("0180", "2024", 36.0)], "municipality_code string, year string, income_tkr double"),
        "construction": make([("0180", "q1", 2.0), ("0180", "q2", 1.0), ("0180", "q2", 2.0)], "municipality_code string, quarter string, permits double"),
        "debt_burden": make([("0180", 5.0), ("0180", 7.0), ("1280", 2.0)], "municipality_code string, deduction_tkr double"),
    }
    features, index = sweden_features(tables, dim)
    assert features.columns == schemas.FEATURES_SE.names and features.count() == 3
    row = features.filter("municipality_code = '0180'").first()
    assert row.price_growth_1y == pytest.approx(10.0) and row.latest_price_sqm is None and row.population == 30.0
    assert row.employment_hhi == 0.5 and row.latest_wage == 2000.0 and row.wage_growth_1y is None
    assert row.permit_momentum == 50.0 and row.permits_per_1000 == pytest.approx(5 / 30 * 1000) and row.debt_burden_pct == 1.0
    assert rows(index) == [("01", None, pytest.approx(2.5), 0.0)]
    only = sweden_features({}, dim)
    assert only[0].count() == 3 and only[1] is None


@pytest.mark.parametrize("country", ["norway", "sweden"])
def test_pages_to_ranked_listings(spark, country):
    regions, aliases = place_dims(spark, country)
    towns = ["Oslo", "Trondheim"] if country == "norway" else ["Stockholm", "Malmö"]
    label, size = ("Prisantydning", "Bruksareal") if country == "norway" else ("Pris", "Boarea")
    html = lambda i: f"<h1>Nr {i}</h1><p>Vei {i}, 0182 12 {towns[i % 2]}</p><dl><dt>{label}</dt><dd>{i} 000 000 kr</dd><dt>{size}</dt><dd>{40 + i} m</dd></dl>"
    fetched = spark.createDataFrame([(str(i), html(i)) for i in range(1, 8)], "listing_id string, html string")
    links = spark.createDataFrame([(1, i, str(i), f"u{i}") for i in range(1, 7)], "page_no int, pos int, listing_id string, url string")
    found = detail_pages(links, fetched, 6)
    if country == "norway":
        features, grid, index = norway_features(norway_tables(spark))
        make = spark.createDataFrame
        dims = L.Dimensions(
            make([("0301", "1.01")], "municipality_code string, zone string"), make([("08", "4.01")], "rent_zone string, zone string"),
            make([("nowhere", "001")], "key string, index_region_code string"), make([("99", "002")], "key string, index_region_code string"), "zone_code")
    else:
        features, index = sweden_features({}, regions)
        grid = spark.createDataFrame([("1.01", 30.0, 9000.0), ("1.01", 90.0, 15000.0)], "rent_zone string, sqm double, monthly_rent double").withColumnRenamed("rent_zone", "grid_zone")
        dims = L.Dimensions(grid_zone="grid_zone")
    out = scored_listings(found, features, grid, index, None, aliases, regions, dims, country).orderBy("rank").collect()
    assert [r["rank"] for r in out] == [1, 2, 3, 4, 5, 6] and {r.municipality_name for r in out} == set(towns)
    assert all(r.estimated_monthly_rent > 0 and r.gross_yield_pct > 0 for r in out)
    assert out[0].recommendation == "BUY" and out[-1].recommendation == "AVOID"
    assert max(out, key=lambda r: r.gross_yield_pct).listing_id in ("1", "2")


def test_fixed_dimensions(spark, rows):
    no, se = (dict((a, (c, e)) for a, c, e in rows(fixed.places(spark, k))) for k in ("norway", "sweden"))
    assert len(no) == 183 and no["grorud"] == ("0301", True) and no["mo i rana"] == ("1833", True)
    assert se["spånga"] == ("0180", True) and se["vasastan"] == ("0180", False) and se["huvudsta"] == ("0183", False)
    dims = fixed.dimensions(spark, "norway")
    assert dims.zone_of_code.count() == 25 and dims.zone_of_generic.count() == 17
    assert dims.index_of_name.count() == 8 and fixed.dimensions(spark, "sweden").index_of_region.count() == 19


def test_rent_grids_of_both_countries(spark, rows):
    coded = spark.createDataFrame([("1.01", "1.030", 9000.0), ("1.01", "4.12", 15000.0)], "zone_code string, size_code string, monthly_rent double")
    assert rows(sized_grid(coded), "sqm") == [(120.0,), (30.0,)]
    zones = fixed.rent_zones_sweden(spark)
    rents = spark.createDataFrame([("0180", 100.0)], "code string, rent_per_sqm double")
    assert rows(sweden_rent_grid(rents, zones).filter("sqm = 30")) == [("1.01", 30.0, 3000.0)]
    assert sweden_rent_grid(None, zones).count() == sweden_rent_grid(rents.limit(0), zones).count() == 90


# ---- landing -----------------------------------------------------------------------------------


def test_landing(spark, rows):
    df = spark.createDataFrame([("0301", 1.5), (None, None)], "c string, v double")
    back = land(df)
    assert rows(back) == rows(df) and back.columns == df.columns
    one = df.agg(F.max("v").alias("m"), F.count("*").alias("n"))
    assert rows(with_constants(df, one, ["m", "n"])) == [("0301", 1.5, 1.5, 2), (None, None, 1.5, 2)]
    assert with_constants(df, one.filter("n = 9"), ["m"]).filter("m is null").count() == 2
    assert rows(computed_once(df, ["c"], {"w": F.col("v") + 1})) == [("0301", 2.5), (None, None)]


def test_landed_tables_can_be_dropped(spark):
    land(spark.range(1))
    drop_landed(spark)
    assert land(spark.range(2)).count() == 2

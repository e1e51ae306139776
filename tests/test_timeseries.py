import datetime as dt

import pytest

from regionscore.operators import aggregates, timeseries


def yearly(spark, data):
    rows = [(k, str(2000 + i), v) for k, values in data.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, y string, v double")


def test_growth(spark, rows):
    df = yearly(spark, {"a": [100.0, 110.0, 121.0, 133.1], "b": [100.0, 110.0], "c": [5.0], "z": [0.0, 4.0]})
    assert rows(timeseries.growth(df, "k", "y", "v")) == [
        ("a", 10.0, 10.0, 133.1), ("b", 10.0, None, 110.0), ("z", None, None, 4.0)]
    kept = rows(timeseries.growth(df, "k", "y", "v", min_rows=1), "k", "growth_1y")
    assert ("c", None) in kept


def test_index_signals(spark, rows):
    df = spark.createDataFrame([("a", f"2024K{i}", v) for i, v in enumerate((100.0, 110.0, 99.0), 1)] + [("b", "2024K1", 1.0), ("c", "2024K1", 1.0), ("c", "2024K2", 2.0)],
                               "region_code string, quarter string, index_value double")
    assert rows(timeseries.index_signals(df)) == [("a", -10.0, 10.0, 99.0), ("c", 100.0, None, 2.0)]


def test_macro_signals(spark):
    last = dt.date(2024, 7, 1)
    rate = [("no", "rate", last - dt.timedelta(days=181), 4.0), ("no", "rate", last - dt.timedelta(days=170), 9.9), ("no", "rate", last, 4.5)]
    months = [dt.date(2023 + (m // 12), m % 12 + 1, 1) for m in range(13)]
    money = [100.0, *[105.0] * 5, 110.0, *[111.0] * 5, 110.0]
    rows = rate + [("no", "money", d, v) for d, v in zip(months, money)] + [("no", "bond", last, 3.25), ("se", "bond", last, 2.0)]
    df = spark.createDataFrame(rows, "country string, series_key string, obs_date date, value double")
    out = {r.country: r for r in timeseries.macro_signals(df).collect()}
    no = out["no"]
    assert no.nibor_current == 4.5 and no.nibor_trend_6m == 0.5
    assert no.nibor_percentile_10y == pytest.approx(0.333)
    assert (no.m3_yoy_growth, no.m3_acceleration) == (10.0, -10.0)
    assert (no.bond_yield_10y, no.yield_curve_spread) == (3.25, -1.25)
    assert out["se"].nibor_current is None and out["se"].nibor_trend_6m is None and out["se"].yield_curve_spread is None


def test_trend_without_past_is_zero(spark):
    df = spark.createDataFrame([("no", "rate", dt.date(2024, 1, 1), 3.0)], "country string, series_key string, obs_date date, value double")
    row = timeseries.macro_signals(df).first()
    assert row.nibor_trend_6m == 0.0 and row.nibor_percentile_10y == 0.0


def test_history_is_cut_to_its_tail(spark):
    days = [dt.date(2000, 1, 1) + dt.timedelta(days=i) for i in range(130)]
    df = spark.createDataFrame([("no", "rate", d, float(i < 10) * 100 - 1.0) for i, d in enumerate(days)], "country string, series_key string, obs_date date, value double")
    assert timeseries.last_observations(df, ["country", "series_key"], "obs_date", 120).count() == 120
    assert timeseries.macro_signals(df).first().nibor_percentile_10y == 0.0


def test_mortgage_trend(spark):
    df = spark.createDataFrame([(f"2023M{i:02}", float(i)) for i in range(1, 13)], "p string, r double")
    row = timeseries.rate_trend(df, "p", "r").first()
    assert tuple(row) == (12.0, 11.0)
    assert tuple(timeseries.rate_trend(df.filter("p > '2023M01'"), "p", "r").first()) == (12.0, None)


def test_latest_periods(spark):
    df = spark.createDataFrame([("2024K1",), ("2024K2",), ("2024K2",), ("2023K4",)], "q string")
    assert sorted(r.q for r in timeseries.latest_periods(df, "q", 2).collect()) == ["2024K1", "2024K2", "2024K2"]


def test_concentration(spark, rows):
    df = spark.createDataFrame([("a", "x", 50.0), ("a", "y", 30.0), ("a", "z", 20.0), ("a", "00-99", 100.0), ("b", "x", 0.0), (None, "x", 5.0)],
                               "k string, p string, v double")
    assert rows(aggregates.concentration(df, "k", "p", "v")) == [("a", 0.38, 100.0)]


def permits(spark, values, key="a"):
    return [(key, f"{2023 + i // 4}K{i % 4 + 1}", float(v)) for i, v in enumerate(values)]


def test_permit_momentum(spark, rows):
    df = spark.createDataFrame(permits(spark, [10] * 4 + [15] * 4) + permits(spark, [0] * 4 + [7] * 4, "b"), "k string, quarter string, permits double")
    assert rows(aggregates.permit_windows(df, "k")) == [("a", 100.0, 60.0, 50.0), ("b", 28.0, 28.0, None)]
    short = df.filter("quarter < '2024K4'")
    assert rows(aggregates.permit_windows(short, "k")) == [("a", 85.0, 85.0, None), ("b", 21.0, 21.0, None)]


def test_supply_pressure(spark, rows):
    df = spark.createDataFrame(permits(spark, [10] * 4 + [15] * 4) + permits(spark, [1] * 8, "b"), "k string, quarter string, permits double")
    people = spark.createDataFrame([("a", 2000.0), ("b", 0.0)], "k string, population double")
    assert rows(aggregates.supply_pressure(df, people, "k")) == [("a", 30.0, 50.0), ("b", None, 0.0)]


def test_last_step_momentum_sums_a_quarter_first(spark, rows):
    df = spark.createDataFrame([("a", "q1", 1.0), ("a", "q1", 3.0), ("a", "q2", 5.0), ("a", "q2", 1.0), ("b", "q2", 1.0)], "k string, q string, v double")
    assert rows(aggregates.last_step_momentum(df, "k", "q", "v")) == [("a", 10.0, 50.0), ("b", 1.0, None)]


def test_latest_non_null_per_column(spark, rows):
    df = spark.createDataFrame([("n", "1", "2020", 1.0, 5.0), ("n", "1", "2021", None, 6.0), ("n", "2", "2020", None, 7.0), (None, "1", "2022", 9.0, 9.0)],
                               "c string, r string, y string, a double, b double")
    assert rows(aggregates.latest_non_null(df, ["c", "r"], "y", ["a", "b"])) == [("n", "1", 1.0, 6.0), ("n", "2", None, 7.0)]


def test_rollup_and_sums(spark, rows):
    df = spark.createDataFrame([("03", 10.0, 4.0), ("03", 20.0, 8.0), ("11", 5.0, 2.0)], "c string, l double, g double")
    assert rows(aggregates.county_rollup(df, "c", "l", "g")) == [("03", 15.0, 1.5, pytest.approx(0.7071067811865476)), ("11", 5.0, 0.5, 0.0)]
    nothing = spark.createDataFrame([("a", None)], "k string, v double")
    assert rows(aggregates.sum_by(nothing, ["k"], "v")) == [("a", 0.0)]
    assert rows(aggregates.doubled_population(spark.createDataFrame([("a", 3.0), ("a", 4.0)], "k string, v double"), "k", "v")) == [("a", 14.0)]


def test_quality_report(spark, rows):
    df = spark.createDataFrame([("0000", 1.0, None), ("0301", None, None), ("0301", 2.0, 3.0)], "municipality_code string, a double, b double")
    assert rows(aggregates.quality_report(df, ["a", "b", "absent"])) == [("a", 3, 1, 1, True), ("b", 3, 2, 1, True)]
    assert rows(aggregates.quality_report(df.filter("a is not null and b is not null"), ["a"])) == [("a", 1, 0, 0, False)]

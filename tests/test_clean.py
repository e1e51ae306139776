import pytest
from pyspark.sql import functions as F

from regionscore.functions import clean, ratios


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize("text, key", [("Trondheim - Tråante", "trondheim"), ("  Oslo (old) ", "oslo"), ("Nord-Fron", "nord-fron")])
def test_name_key(spark, text, key):
    assert one(spark, clean.name_key(F.lit(text.strip()))) == key


def test_historical_regions_are_dropped(spark):
    df = spark.createDataFrame([("Oslo (-2019)",), ("Larvik (2017-2019)",), ("Oslo",), (None,), ("Nes (Akershus)",)], "n string")
    assert [r.n for r in clean.current_regions(df, "n").collect()] == ["Oslo", None, "Nes (Akershus)"]


@pytest.mark.parametrize("raw, key", [("5.0", "5.00"), ("1.01", "1.01"), ("20.0", "20.00"), ("7", "7"), ("1.123", "1.123")])
def test_zone_key(spark, raw, key):
    assert one(spark, clean.zone_key(F.lit(raw))) == key


@pytest.mark.parametrize("text, number", [
    ("3 500 000 kr", 3500000.0), ("3 500 000 kr", 3500000.0), ("85,5 m2", 85.52), ("", None), ("1.234.567", None), ("-", None), ("-3,5", -3.5)])
def test_number_no(spark, text, number):
    assert one(spark, clean.number_no(F.lit(text))) == number


@pytest.mark.parametrize("text, number", [
    ("4 500 000 kr", 4500000.0), ("12 500 kr/mån", 12500.0), ("85 m²", 85.0), ("12 5 m", 125.0), ("okänt", None)])
def test_number_se(spark, text, number):
    assert one(spark, clean.number_se(F.lit(text))) == number


def test_codes(spark):
    assert one(spark, clean.pad_code(F.lit(301))) == "0301"
    assert one(spark, clean.pad_code(F.lit("12345"))) == "12345"
    assert one(spark, clean.county_of(F.lit("0301"))) == "03"
    assert one(spark, clean.to_number(F.lit("nan"))) is None


def test_alias_variants(spark):
    assert one(spark, clean.alias_variant_no(F.lit("Nord-Fron (gammel)"))) == "nordfron gammel"
    assert one(spark, clean.alias_variant_se(F.lit("Upplands-Bro Åäö"))) == "upplands bro aao"


@pytest.mark.parametrize("value, digits, want", [(12.25, 1, 12.2), (12.35, 1, 12.4), (-0.04, 1, 0.0), (2.5, 0, 2.0), (87.5, 1, 87.5)])
def test_rounding_goes_to_even(spark, value, digits, want):
    got = one(spark, ratios.rounded(F.lit(value), digits))
    assert got == want and str(got) == str(want)


def test_ratios(spark):
    assert one(spark, ratios.gross_yield(F.lit(120000.0), F.lit(3000000.0))) == pytest.approx(4.0)
    assert one(spark, ratios.gross_yield(F.lit(120000.0), F.lit(0.0))) is None
    assert one(spark, ratios.oversupply(F.lit(None).cast("double"))) == 0.0
    assert one(spark, ratios.oversupply(F.lit(5.0))) == 1.0
    assert one(spark, ratios.oversupply(F.lit(1.25))) == 0.25
    assert [one(spark, ratios.risk_label(F.lit(x).cast("double"))) for x in (0.1, 0.33, 0.66, None)] == ["Low", "Medium", "High", "High"]

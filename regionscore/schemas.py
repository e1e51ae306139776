"""Declared schemas of the tables at every boundary; codes are text, measures are doubles."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType(), "date": T.DateType(), "boolean": T.BooleanType(),
    "array<string>": T.ArrayType(T.StringType()), "array<double>": T.ArrayType(T.DoubleType()),
}


def table(columns: str) -> T.StructType:
    """`name type, ...` as a schema; needs no running session."""
    pairs = [c.split() for c in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SERIES = table("country string, series_key string, obs_date date, value double")
SERIES_DOC = table("dates array<string>, values array<double>, fetched_at string")
PAGE = table("listing_id string, url string, html string")
SEARCH_PAGE = table("page_no int, url string, html string")
REGION_DIM = table("code string, name string, region_code string, region_name string, rent_zone string")
ALIASES = table("alias string, code string, fuzzy_eligible boolean")
RENT_GRID = table("zone string, sqm double, monthly_rent double")
INDEX_SIGNALS = table(
    "region_code string, region string, index_momentum_qoq double, volatility_qoq double, latest_index double")
LISTING_NO = table(
    "listing_id string, url string, title string, address string, ownership_type string, property_type string, "
    "floor string, energy_rating string, asking_price double, total_price double, fellesgjeld double, "
    "common_costs_monthly double, sqm_primary double, sqm_usable double, sqm_gross double, plot_size double, "
    "sqm double, total_price_calc double, price_per_sqm double, bedrooms int, year_built int")
LISTING_SE = table(
    "listing_id string, url string, title string, address string, ownership_type string, property_type string, "
    "floor string, energy_rating string, asking_price double, sqm double, sqm_secondary double, monthly_fee double, "
    "common_costs_monthly double, operating_cost double, plot_area double, total_price_calc double, "
    "price_per_sqm double, rooms int, year_built int")
FEATURES_NO = table(
    "municipality_code string, municipality_clean string, price_growth_1y double, price_growth_3y double, "
    "latest_price_sqm double, population double, debt_burden_pct double, employment_hhi double, "
    "top3_industry_share double, mortgage_rate_current double, mortgage_rate_trend double, wage_growth_1y double, "
    "wage_growth_3y double, latest_wage double, permits_per_1000 double, permit_momentum double")
FEATURES_SE = table(
    "municipality_code string, municipality_name string, municipality_clean string, price_growth_1y double, "
    "price_growth_3y double, latest_price_sqm double, population double, employment_hhi double, latest_wage double, "
    "wage_growth_1y double, permits_per_1000 double, permit_momentum double, debt_burden_pct double")
REGION_GROWTH = table(
    "country string, region_code string, region string, dwelling_type string, growth_1Y_ann double, "
    "growth_3Y_ann double, latest_index double")
REGION_YIELD = table(
    "country string, region_code string, region string, avg_monthly_rent double, avg_price_sqm double, "
    "estimated_price double, gross_yield_pct double")
REGION_BUILDING_RATE = table(
    "country string, region_code string, year string, permits_per_1000_stock double, permits_rolling3y double")
REGION_COMPLETION = table("country string, region_code string, year string, completion_ratio double")
REGION_MOMENTUM = table("country string, region_code string, period string, momentum_yoy_pct double")
REGION_INDEX = table("country string, region_code string, dwelling_type string, period string, growth_qoq double")

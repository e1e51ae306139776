"""One row of features per region, from the sliced statistics tables of a country."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regionscore.functions.clean import county_of, pad_code
from regionscore.functions.ratios import ratio
from regionscore.landing import land, with_constants
from regionscore.operators.aggregates import (
    concentration,
    county_rollup,
    doubled_population,
    first_by_key,
    last_step_momentum,
    mean_by,
    sum_by,
    supply_pressure,
)
from regionscore.operators.normalize import minmax_unfilled
from regionscore.operators.rent import sized_grid
from regionscore.operators.timeseries import growth, index_signals, rate_trend
from regionscore.schemas import FEATURES_NO, FEATURES_SE
from regionscore.sources.tables import with_columns_in_order

def norway_features(tables: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(features, rent grid, index signals) from the slices of `SLICES_NO`; all but prices may be absent.

    Region codes join population, debt and industry; cleaned names join wages and permits, because
    their sources use other code systems.
    """
    prices = mean_by(tables["price_sqm"], ["municipality_code", "year", "municipality_clean"], "price_sqm")
    features = growth(
        prices, "municipality_code", "year", "price_sqm",
        names=("price_growth_1y", "price_growth_3y", "latest_price_sqm"), keep=("municipality_clean",),
    )
    population = None
    if "population" in tables:
        population = sum_by(tables["population"], ["municipality_code", "municipality_clean"], "population")
        features = features.join(population.select("municipality_code", "population"), "municipality_code", "left")
    if "debt_burden" in tables:
        features = features.join(tables["debt_burden"].select("municipality_code", "debt_burden_pct"), "municipality_code", "left")
    if "employment" in tables:
        shares = concentration(tables["employment"], "municipality_code", "industry_code", "employed")
        features = features.join(shares, "municipality_code", "left")
    if "mortgage_rate" in tables:
        trend = rate_trend(tables["mortgage_rate"], "period", "mortgage_rate")
        features = with_constants(features, trend, ["mortgage_rate_current", "mortgage_rate_trend"])
    if "wages" in tables:
        # positive wages only: a region whose latest wage is not positive has no wage features
        wages = mean_by(tables["wages"], ["municipality_clean", "year"], "monthly_wage")
        pay = growth(
            wages, "municipality_clean", "year", "monthly_wage",
            names=("wage_growth_1y", "wage_growth_3y", "latest_wage"),
        ).filter(F.col("latest_wage") > 0)
        features = features.join(pay, "municipality_clean", "left")
    if "construction" in tables:
        if population is None:
            people = tables["construction"].select("municipality_clean", F.lit(None).cast("double").alias("population")).distinct()
        else:
            people = first_by_key(population, "municipality_clean", "municipality_code", ["population"])
        features = features.join(supply_pressure(tables["construction"], people, "municipality_clean"), "municipality_clean", "left")
    index = index_signals(tables["price_index"], keep=("region",)) if "price_index" in tables else None
    rent = sized_grid(tables["rent"]) if "rent" in tables else None
    return land(with_columns_in_order(features, FEATURES_NO)), rent, index


def sweden_features(tables: Mapping[str, DataFrame], regions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(features, index signals) from the slices of `SLICES_SE`; the base is the region dimension."""
    padded = {k: t.withColumn("municipality_code", pad_code(F.col("municipality_code"))) for k, t in tables.items()}
    none = F.lit(None).cast("double")
    features = regions.select(
        F.col("code").alias("municipality_code"), F.col("name").alias("municipality_name"),
        F.lower(F.trim("name")).alias("municipality_clean"),
    )
    index = None
    if "housing_prices" in padded:
        yearly = mean_by(padded["housing_prices"], ["municipality_code", "year"], "avg_price_tkr")
        prices = growth(
            yearly, "municipality_code", "year", "avg_price_tkr",
            names=("price_growth_1y", "price_growth_3y", "latest_price"), min_rows=1, digits=None,
        ).select("municipality_code", "price_growth_1y", "price_growth_3y", none.alias("latest_price_sqm"))
        features = features.join(prices, "municipality_code", "left")
        counties = prices.withColumn("region_code", county_of(F.col("municipality_code")))
        index = county_rollup(counties, "region_code", "latest_price_sqm", "price_growth_1y")
    if "population" in padded:
        features = features.join(doubled_population(padded["population"], "municipality_code", "population_half"), "municipality_code", "left")
    if "employment" in padded:
        positive = padded["employment"].filter(F.col("employed") > 0)
        shares = concentration(positive, "municipality_code", "industry_code", "employed", digits=None)
        features = features.join(shares.drop("top3_industry_share"), "municipality_code", "left")
    if "wages" in padded:
        yearly = mean_by(padded["wages"], ["municipality_code", "year"], "income_tkr")
        pay = growth(
            yearly, "municipality_code", "year", "income_tkr",
            names=("wage_growth_1y", "_w3", "_latest"), min_rows=1, digits=None,
        )
        monthly = (F.col("_latest") * 1000.0 / 12.0).alias("latest_wage")  # thousands a year to units a month
        features = features.join(pay.select("municipality_code", "wage_growth_1y", monthly), "municipality_code", "left")
    if "construction" in padded:
        flows = last_step_momentum(padded["construction"], "municipality_code", "quarter", "permits")
        features = features.join(flows, "municipality_code", "left")
        if "population" in features.columns:
            per_1000 = ratio(F.col("permits_raw"), F.col("population")) * 1000.0
            features = features.withColumn("permits_per_1000", per_1000)
    if "debt_burden" in padded:
        debt = mean_by(padded["debt_burden"], ["municipality_code"], "deduction_tkr")
        debt = minmax_unfilled(debt, "deduction_tkr", "debt_burden_pct").drop("deduction_tkr")
        features = features.join(debt, "municipality_code", "left")
    return land(with_columns_in_order(features, FEATURES_SE)), index

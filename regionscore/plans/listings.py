"""Listings joined with region features, scored and ranked."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regionscore.functions.clean import strip, zone_key
from regionscore.functions.ratios import gross_yield, ratio, risk_label, rounded
from regionscore.landing import sized
from regionscore.operators.aggregates import first_by_key
from regionscore.operators.geo import near_centres, within_radius  # noqa: F401  (filters of listings)
from regionscore.operators.normalize import scaled, signal_stats
from regionscore.operators.ranking import listing_tier, ranked
from regionscore.operators.rent import estimate_rent, resolve_zone

INDEX_COLUMNS = ("index_momentum_qoq", "volatility_qoq", "latest_index")


@dataclass(frozen=True)
class ListingWeights:
    """Weights of the signals within each score."""

    gross_yield: float = 0.50
    yield_premium: float = 0.25
    affordability: float = 0.25
    growth_1y: float = 0.30
    growth_3y: float = 0.20
    index_momentum: float = 0.20
    wage_growth: float = 0.30
    rate_sensitivity: float = 0.20
    job_vulnerability: float = 0.20
    price_volatility: float = 0.15
    tightening: float = 0.10
    debt_burden: float = 0.15
    construction: float = 0.20


@dataclass(frozen=True)
class Dimensions:
    """Small code tables of a country; see `resolve_zone` and `index_region`."""

    zone_of_code: DataFrame | None = None
    zone_of_generic: DataFrame | None = None
    index_of_name: DataFrame | None = None
    index_of_region: DataFrame | None = None
    grid_zone: str = "zone"


def index_region(df: DataFrame, by_name: DataFrame, by_region: DataFrame) -> DataFrame:
    """Add `index_region_code`: by cleaned name, else by region code, else `TOTAL`."""
    names = sized(by_name).select(F.col("key").alias("municipality_clean"), F.col("index_region_code").alias("_by_name"))
    regions = sized(by_region).select(F.col("key").alias("region_code"), F.col("index_region_code").alias("_by_region"))
    joined = df.join(names, "municipality_clean", "left").join(regions, "region_code", "left")
    code = F.coalesce("_by_name", "_by_region", F.lit("TOTAL"))
    return joined.select(*df.columns, code.alias("index_region_code"))


def enrich_listings(
    listings: DataFrame,
    features: DataFrame | None,
    rent_grid: DataFrame | None,
    index: DataFrame | None,
    dims: Dimensions,
    country: str = "norway",
) -> DataFrame:
    """Listings (with resolved regions) joined with features, rent estimate, index signals and yield.

    Region tables have a known size (see `sized`): the listing side is streamed past broadcast tables
    and never shuffled, so a region that holds a third of all listings is no hot key.
    """
    out = listings
    if "municipality_clean" not in out.columns:
        out = out.withColumn("municipality_clean", F.lower(strip(F.col("municipality_name"))))
    if features is not None:
        own = set(out.columns) - {"municipality_clean"}
        extra = [c for c in features.columns if c not in own and c not in ("municipality_code", "municipality_clean")]
        unique = first_by_key(features, "municipality_clean", "municipality_code", extra)
        out = out.join(sized(unique), "municipality_clean", "left")
    if rent_grid is not None:
        grid = rent_grid.withColumn(dims.grid_zone, zone_key(F.col(dims.grid_zone)))
        out = resolve_zone(out, country, dims.zone_of_code, dims.zone_of_generic)
        out = estimate_rent(out, grid, country, grid_zone=dims.grid_zone)
    else:
        out = out.withColumn("estimated_monthly_rent", F.lit(None).cast("double"))
    out = out.withColumn("estimated_annual_rent", F.col("estimated_monthly_rent") * 12.0)
    if index is not None and dims.index_of_name is not None:
        out = index_region(out, dims.index_of_name, dims.index_of_region)
        signals = [c for c in INDEX_COLUMNS if c in index.columns]
        level = index.select(F.col("region_code").alias("index_region_code"), *signals)
        out = out.join(sized(level), "index_region_code", "left")
    return out.withColumn(
        "gross_yield_pct", rounded(gross_yield(F.col("estimated_annual_rent"), F.col("total_price_calc")), 2)
    )


def filter_regions(listings: DataFrame, codes: list[str]) -> DataFrame:
    """Listings in the given municipalities."""
    return listings.filter(F.col("municipality_code").isin(*codes))


def _known(value) -> float | None:
    return None if value is None or value != value else float(value)


def tightening(acceleration: float | None) -> float:
    """-5 % money growth acceleration or less is risk 1, +5 % or more is 0, unknown is 0.5."""
    return 0.5 if acceleration is None else max(0.0, min(1.0, (5.0 - acceleration) / 10.0))


SCORES = ["yield_score", "growth_score", "risk_score", "composite_score", "risk_label"]


def score_listings(
    listings: DataFrame,
    macro: Mapping[str, float | None],
    yield_weight: float = 0.40,
    growth_weight: float = 0.30,
    risk_penalty: float = 0.30,
    weights: ListingWeights = ListingWeights(),
) -> DataFrame:
    """Scores 0..100 and risk label of every listing: a projection, with statistics of the signals as constants.

    Missing signals score at the median of their column; absent or empty ones score 0.5. The input is read twice; only
    its signals are landed.
    """
    signals = _signals(listings)
    names = [c for c in signals.columns if c.startswith("_s_")]
    stats = signal_stats(signals, names)
    scored = _scores(signals, names, stats, macro, yield_weight, growth_weight, risk_penalty, weights)
    own = [c for c in listings.columns if c not in SCORES and c != "gross_yield_pct"]
    return scored.select(*own, "gross_yield_pct", *SCORES)


def rank_listings(scored: DataFrame, id_col: str = "listing_id") -> DataFrame:
    """Add rank, percentile and tier: by composite score, then by `id_col`, which must be unique. One sort gives all of them."""
    rows = ranked(scored, "composite_score", id_col)
    return rows.withColumn("recommendation", listing_tier(F.col("rank"), F.col("_n"))).drop("_n")


def _signals(listings: DataFrame) -> DataFrame:
    """Listings with one raw `_s_` column per signal that the input can give."""
    have = set(listings.columns)
    out = listings
    if "gross_yield_pct" not in have:
        known = {"estimated_annual_rent", "total_price_calc"} <= have
        pct = gross_yield(F.col("estimated_annual_rent"), F.col("total_price_calc")) if known else F.lit(None).cast("double")
        out = out.withColumn("gross_yield_pct", pct)
    raw = {"yield": F.col("gross_yield_pct")}
    if {"price_per_sqm", "latest_price_sqm"} <= have:
        raw["price"] = ratio(F.col("price_per_sqm"), F.col("latest_price_sqm"))
    elif "price_per_sqm" in have:
        raw["price"] = F.col("price_per_sqm")
    for name, column in (
        ("g1", "price_growth_1y"), ("g3", "price_growth_3y"), ("momentum", "index_momentum_qoq"),
        ("wage", "wage_growth_1y"), ("hhi", "employment_hhi"), ("volatility", "volatility_qoq"),
        ("debt", "debt_burden_pct"), ("permits", "permits_per_1000"),
    ):
        if column in have:
            raw[name] = F.col(column)
    return out.select("*", *[c.cast("double").alias(f"_s_{k}") for k, c in raw.items()])


def _scores(rows, names, stats, macro, yield_weight, growth_weight, risk_penalty, w: ListingWeights) -> DataFrame:
    def norm(key: str, invert: bool = False, absent: Column | None = None) -> Column:
        s = f"_s_{key}"
        if s not in names:
            return F.lit(0.5) if absent is None else absent
        low, high, mid = (F.lit(stats[f"{s}__{k}"]).cast("double") for k in ("min", "max", "median"))
        return scaled(F.coalesce(F.nanvl(F.col(s), F.lit(None)), mid), low, high, invert)

    # the premium over the median is the yield shifted by a constant, so both scale to the same value
    yields = w.gross_yield * norm("yield") + w.yield_premium * norm("yield") + w.affordability * norm("price", invert=True)
    g1 = norm("g1")
    growths = (
        w.growth_1y * g1 + w.growth_3y * norm("g3", absent=g1)
        + w.index_momentum * norm("momentum") + w.wage_growth * norm("wage")
    )
    percentile = _known(macro.get("nibor_percentile_10y"))
    rising = 1.0 if (_known(macro.get("nibor_trend_6m")) or 0.0) > 0 else 0.0
    acceleration = _known(macro.get("m3_acceleration", 0.0))
    debt = norm("debt")
    sensitivity = 0.4 * (0.5 if percentile is None else percentile) + 0.3 * rising + 0.3 * debt
    risk = (
        w.rate_sensitivity * sensitivity + w.job_vulnerability * norm("hhi") + w.price_volatility * norm("volatility")
        + w.tightening * F.lit(tightening(acceleration)) + w.debt_burden * debt + w.construction * norm("permits")
    )
    total = yield_weight + growth_weight
    total = total if total > 0 else 1.0
    raw = (yield_weight / total) * F.col("_yield") + (growth_weight / total) * F.col("_growth")
    composite = raw * (1.0 - risk_penalty * F.col("risk_score"))
    scored = rows.drop("risk_score").select("*", yields.alias("_yield"), growths.alias("_growth"), risk.alias("risk_score"))
    return scored.select(
        "*",
        rounded(F.col("_yield") * 100.0, 1).alias("yield_score"),
        rounded(F.col("_growth") * 100.0, 1).alias("growth_score"),
        rounded(composite * 100.0, 1).alias("composite_score"),
        risk_label(F.col("risk_score")).alias("risk_label"),
    ).drop("_yield", "_growth", *names)


def top_listings(scored: DataFrame, n: int = 50) -> DataFrame:
    return scored.orderBy("rank").limit(n)

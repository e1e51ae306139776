"""Region-level scores, recommendations, scenarios.

The tables here have one row per country, region and dwelling type: as many as there are regions,
however large the sources were that they were aggregated from.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regionscore.functions.ratios import oversupply, ratio, risk_label, rounded
from regionscore.landing import land, with_constants
from regionscore.operators.aggregates import latest_non_null
from regionscore.operators.normalize import minmax
from regionscore.operators.ranking import percentile_ranks, region_tier

REGION = ["country", "region_code"]
OBJECTIVES = {"yield": "yield_score", "growth": "growth_score", "balanced": "composite_score"}
SCENARIOS = {"Income (80/20)": (0.80, 0.20), "Balanced (50/50)": (0.50, 0.50), "Growth (20/80)": (0.20, 0.80)}
OUTPUT = (
    "recommendation", "country", "region", "dwelling_type", "composite_score", "yield_score", "growth_score",
    "gross_yield_pct", "growth_1Y_ann", "avg_price_sqm", "avg_monthly_rent", "permits_per_1000_stock",
    "volatility_qoq", "risk_score", "objective",
)


@dataclass(frozen=True)
class RegionWeights:
    """Weights of the signals within each score."""

    gross_yield: float = 0.45
    yield_premium: float = 0.20
    rent_pressure: float = 0.20
    affordability: float = 0.15
    growth_1y: float = 0.35
    growth_3y: float = 0.25
    supply_constraint: float = 0.20
    supply_tightening: float = 0.10
    index_gap: float = 0.10
    volatility: float = 0.60
    oversupply: float = 0.40


def region_feature_table(tables: Mapping[str, DataFrame], gap_by_country: bool = False) -> DataFrame:
    """Growth rows joined with yield, building rate, completions, permit momentum and volatility.

    Tables: `growth`, `yield`, `building_rate`, `completion`, `permit_momentum`, `price_index`. The
    index gap is measured against the highest index of all countries, or of the own one on request.
    """
    yields = tables["yield"].select(
        *REGION, "region", "avg_monthly_rent", "avg_price_sqm", "estimated_price", "gross_yield_pct"
    )
    rate = latest_non_null(tables["building_rate"], REGION, "year", ["permits_per_1000_stock", "permits_rolling3y"])
    completion = latest_non_null(tables["completion"], REGION, "year", ["completion_ratio"])
    momentum = latest_non_null(tables["permit_momentum"], REGION, "period", ["momentum_yoy_pct"])
    momentum = momentum.withColumnRenamed("momentum_yoy_pct", "permit_momentum_yoy")
    volatility = tables["price_index"].groupBy(*REGION, "dwelling_type").agg(F.stddev_samp("growth_qoq").alias("volatility_qoq"))
    # a median per country over its regions
    national = yields.groupBy("country").agg(
        F.median("avg_price_sqm").alias("national_avg_psqm"), F.median("gross_yield_pct").alias("national_avg_yield")
    )
    df = (
        tables["growth"]
        .join(yields, [*REGION, "region"], "left")
        .join(rate, REGION, "left")
        .join(completion, REGION, "left")
        .join(momentum, REGION, "left")
        .join(volatility, [*REGION, "dwelling_type"], "left")
        .join(national, "country", "left")
    )
    if gap_by_country:
        df = df.withColumn("_top_index", F.max("latest_index").over(Window.partitionBy("country")))
    else:
        df = with_constants(df, tables["growth"].agg(F.max("latest_index").alias("_top_index")), ["_top_index"])
    return df.select(
        "*",
        (F.col("gross_yield_pct") - F.col("national_avg_yield")).alias("yield_premium"),
        ratio(F.col("avg_price_sqm"), F.col("national_avg_psqm")).alias("price_vs_national"),
        (-F.col("permit_momentum_yoy")).alias("supply_tightening"),
        (F.col("_top_index") - F.col("latest_index")).alias("index_gap"),
    ).drop("_top_index")


def region_signals(features: DataFrame, weights: RegionWeights = RegionWeights()) -> DataFrame:
    """Raw yield, growth and risk scores in 0..1; independent of the objective weights."""
    rows = land(features.withColumn("_oversupply", oversupply(F.col("completion_ratio"))))
    long_growth = "growth_3Y_ann" in rows.columns and rows.filter(F.col("growth_3Y_ann").isNotNull()).limit(1).count() > 0
    signals = {
        "gross_yield_pct": False, "yield_premium": False, "permits_per_1000_stock": True, "price_vs_national": True,
        "growth_1Y_ann": False, "supply_tightening": False, "index_gap": False, "volatility_qoq": False, "_oversupply": False,
    }
    if long_growth:
        signals["growth_3Y_ann"] = False
    normed = minmax(rows, signals, by=["country"])

    def s(name: str) -> Column:
        return F.col(f"{name}_norm")

    w = weights
    supply = s("permits_per_1000_stock")
    return normed.select(
        *features.columns,
        (w.gross_yield * s("gross_yield_pct") + w.yield_premium * s("yield_premium")
         + w.rent_pressure * supply + w.affordability * s("price_vs_national")).alias("yield_score_raw"),
        (w.growth_1y * s("growth_1Y_ann") + w.growth_3y * s("growth_3Y_ann" if long_growth else "growth_1Y_ann")
         + w.supply_constraint * supply + w.supply_tightening * s("supply_tightening")
         + w.index_gap * s("index_gap")).alias("growth_score_raw"),
        (w.volatility * s("volatility_qoq") + w.oversupply * s("_oversupply")).alias("risk_score"),
    )


def check_weights(yield_weight: float, growth_weight: float, tolerance: float = 1e-6) -> None:
    if abs(yield_weight + growth_weight - 1.0) >= tolerance:
        raise ValueError("yield_weight + growth_weight must equal 1.0")


def _scaled_scores(df: DataFrame, yield_weight: Column, growth_weight: Column, risk_penalty: float) -> DataFrame:
    composite = yield_weight * F.col("yield_score_raw") + growth_weight * F.col("growth_score_raw")
    adjusted = composite * (1.0 - risk_penalty * F.col("risk_score"))
    return df.select(
        "*",
        rounded(F.col("yield_score_raw") * 100.0, 1).alias("yield_score"),
        rounded(F.col("growth_score_raw") * 100.0, 1).alias("growth_score"),
        rounded(adjusted * 100.0, 1).alias("composite_score"),
    )


def score_regions(
    features: DataFrame, yield_weight: float = 0.5, growth_weight: float = 0.5, risk_penalty: float = 0.25,
    weights: RegionWeights = RegionWeights(),
) -> DataFrame:
    """Scores 0..100 and percentile ranks within each country."""
    check_weights(yield_weight, growth_weight)
    raw = region_signals(features, weights)
    scored = land(_scaled_scores(raw, F.lit(yield_weight), F.lit(growth_weight), risk_penalty))
    return percentile_ranks(scored, {f"{name}_score": f"{name}_pct_rank" for name in ("yield", "growth", "composite")}, by=["country"])


def _recommend(df: DataFrame, objective: str, top_n: int, group: list[str]) -> DataFrame:
    score = OBJECTIVES[objective]
    ties = [F.col(c).asc() for c in ("country", "region_code", "dwelling_type") if c in df.columns]
    all_rows = Window.partitionBy(*group)
    ranked = df.select(
        "*",
        F.row_number().over(all_rows.orderBy(F.col(score).desc(), *ties)).alias("rank"),
        F.count(F.lit(1)).over(all_rows).alias("_n"),
    )
    tiers = ranked.withColumn("recommendation", region_tier(F.col("rank"), F.col("_n"), top_n))
    tiers = tiers.withColumn("objective", F.lit(objective.upper())).withColumn("risk_score", risk_label(F.col("risk_score")))
    extra = [c for c in ("region_code", "rank") if c in tiers.columns]
    return tiers.select(*[c for c in OUTPUT if c in tiers.columns], *extra, *group)


def recommend(
    scores: DataFrame, objective: str = "balanced", top_n: int = 10, country: str | None = None,
    min_yield: float | None = None, min_growth: float | None = None,
) -> DataFrame:
    """All rows that pass the filters, ranked by the objective with BUY / HOLD / AVOID.

    A threshold of None or 0 filters nothing. Ties go by country, region and dwelling type.
    """
    rows = scores
    if country:
        rows = rows.filter(F.col("country") == country)
    if min_yield:
        rows = rows.filter(F.col("gross_yield_pct") >= min_yield)
    if min_growth:
        rows = rows.filter(F.col("growth_1Y_ann") >= min_growth)
    return _recommend(rows, objective, top_n, [])


def scenario(
    features: DataFrame, scenarios: Mapping[str, tuple[float, float]] | None = None, risk_penalty: float = 0.25, top_n: int = 5,
) -> DataFrame:
    """The balanced recommendation under several weight pairs; signals are worked out once."""
    pairs = dict(scenarios or SCENARIOS)
    for yw, gw in pairs.values():
        check_weights(yw, gw)
    options = F.array(*[
        F.struct(F.lit(k).alias("scenario"), F.lit(yw).alias("scenario_yield_weight"), F.lit(gw).alias("scenario_growth_weight"))
        for k, (yw, gw) in pairs.items()
    ])
    raw = region_signals(features)
    spread = raw.select("*", F.explode(options).alias("_o")).select(*raw.columns, "_o.*")
    scored = _scaled_scores(spread, F.col("scenario_yield_weight"), F.col("scenario_growth_weight"), risk_penalty)
    return _recommend(scored, "balanced", top_n, ["scenario", "scenario_yield_weight", "scenario_growth_weight"])


def shortlist(recommendations: DataFrame, top_n: int = 10) -> DataFrame:
    """The rows a report shows: the first `top_n` BUY and the first `top_n // 2` AVOID."""
    by_rank = F.col("rank").asc()
    buys = recommendations.filter("recommendation = 'BUY'").orderBy(by_rank).limit(top_n)
    avoid = recommendations.filter("recommendation = 'AVOID'").orderBy(by_rank).limit(top_n // 2)
    return buys.unionByName(avoid)

"""A country's run from sources to a ranked, exported listing table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from regionscore.landing import land
from regionscore.operators.resolve import resolve_addresses
from regionscore.operators.timeseries import macro_signals
from regionscore.plans.listings import Dimensions, enrich_listings, filter_regions, rank_listings, score_listings
from regionscore.sources.pages import cap_listings, extract_listings, valid_listings


def scored_listings(
    pages: DataFrame,
    features: DataFrame,
    rent_grid: DataFrame | None,
    index: DataFrame | None,
    series: DataFrame | None,
    aliases: DataFrame,
    regions: DataFrame,
    dims: Dimensions,
    country: str = "norway",
    yield_weight: float = 0.40,
    growth_weight: float = 0.30,
    risk_penalty: float = 0.30,
    city_codes: list[str] | None = None,
) -> DataFrame:
    """Detail pages (listing_id, url, html) to scored listings.

    Extraction is the costly part; it runs once, because address resolution lands its input.
    """
    listings = valid_listings(extract_listings(pages, country), country)
    placed = resolve_addresses(listings, aliases, regions, country)
    if city_codes:
        placed = filter_regions(placed, city_codes)
    enriched = enrich_listings(placed, features, rent_grid, index, dims, country)
    macro = macro_row(series, country)
    return rank_listings(score_listings(land(enriched), macro, yield_weight, growth_weight, risk_penalty))


def macro_row(series: DataFrame | None, country: str) -> Mapping[str, float | None]:
    """The seven macro signals of a country as a mapping; empty without series."""
    if series is None:
        return {"nibor_percentile_10y": None, "nibor_trend_6m": None, "m3_acceleration": None}
    row = macro_signals(series.filter(series.country == country)).first()
    return row.asDict() if row else {"m3_acceleration": None}


def detail_pages(links: DataFrame, fetched: DataFrame, max_listings: int | None = None) -> DataFrame:
    """Fetched pages (listing_id, html) of the harvested links, up to `max_listings`."""
    wanted = cap_listings(links, max_listings).select("listing_id", "url")
    return fetched.select("listing_id", "html").join(wanted, "listing_id")

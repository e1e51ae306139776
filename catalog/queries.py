"""Registered queries: each reads the given tables whole and has, where SQL can say it, its equal in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import domain as d
from catalog.oracle import code, full, growth, norm, pct, rm_scored, rnd
from regionscore.functions.clean import name_key, number_no, number_se, pad_code, county_of, current_regions, zone_key
from regionscore.functions.ratios import gross_yield, oversupply, risk_label, rounded
from regionscore.landing import land, landing_path
from regionscore.operators import aggregates as agg
from regionscore.operators import ranking, rent, timeseries
from regionscore.operators.colocate import bucketed
from regionscore.operators.normalize import approximate_median, exact_median, minmax, minmax_unfilled
from regionscore.operators.resolve import gazetteer
from regionscore.plans import listings as L
from regionscore.plans import regions as R
from regionscore.plans.region_features import norway_features, sweden_features
from regionscore.sources import tables as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(sql: str | None = None):
    """Register a function under its own name, with the SQL it must equal."""
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = full(sql)
        return fn
    return add


def fixed(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of additions does not show."""
    return df.select(*[
        rounded(F.col(f.name), digits).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name) for f in df.schema])


def r6(columns: str, digits: int = 6) -> str:
    return ", ".join(f"{rnd(c.strip(), digits)} as {c.strip()}" for c in columns.split(","))


# ---- region features ---------------------------------------------------------------------------


@register(f"select municipality_code, municipality_clean, price_growth_1y, price_growth_3y, {r6('latest_price_sqm', 4)} from price_growth")
def growth_1y_3y(spark, sf):
    out = timeseries.growth(d.price_sqm(spark, sf), "municipality_code", "year", "price_sqm",
                            names=("price_growth_1y", "price_growth_3y", "latest_price_sqm"), keep=("municipality_clean",))
    return out.withColumn("latest_price_sqm", rounded(F.col("latest_price_sqm"), 4))


@register(f"select municipality_clean, wage_growth_1y, wage_growth_3y, {r6('latest_wage', 4)} from wage_growth")
def wage_growth(spark, sf):
    out = timeseries.growth(d.wages(spark, sf), "municipality_clean", "year", "monthly_wage",
                            names=("wage_growth_1y", "wage_growth_3y", "latest_wage"))
    return out.withColumn("latest_wage", rounded(F.col("latest_wage"), 4))


@register(f"select municipality_code, {r6('debt_burden_pct')} from debt")
def debt_burden(spark, sf):
    return fixed(d.debt(spark, sf))


@register("select municipality_code, employment_hhi from hhi")
def hhi_concentration(spark, sf):
    return agg.concentration(d.employment(spark, sf), "municipality_code", "industry_code", "employed").drop("top3_industry_share")


@register("select municipality_code, top3_industry_share from hhi")
def top3_share(spark, sf):
    return agg.concentration(d.employment(spark, sf), "municipality_code", "industry_code", "employed").drop("employment_hhi")


@register(f"select region_code, index_momentum_qoq, volatility_qoq, {r6('latest_index', 4)} from index_signals")
def index_momentum_volatility(spark, sf):
    out = timeseries.index_signals(d.price_index(spark, sf))
    return out.withColumn("latest_index", rounded(F.col("latest_index"), 4))


@register("select * from permit_flows")
def permit_momentum(spark, sf):
    return agg.permit_windows(d.permits(spark, sf), "municipality_clean")


@register("select municipality_clean, permits_per_1000, permit_momentum from supply")
def permits_per_1000(spark, sf):
    return agg.supply_pressure(d.permits(spark, sf), d.population(spark, sf), "municipality_clean")


@register(f"""select municipality_clean, sum(permits) as permits_raw, {rnd('arg_max(m, quarter)', 6)} as permit_momentum
  from (select *, {pct('permits', 'case when p > 0 then p end')} as m from (
    select *, lag(permits) over (partition by municipality_clean order by quarter) as p from permits)) group by 1""")
def last_quarter_momentum(spark, sf):
    return fixed(agg.last_step_momentum(d.permits(spark, sf), "municipality_clean", "quarter", "permits"))


@register("select country, nibor_current, nibor_trend_6m from macro")
def rate_trend_asof(spark, sf):
    return timeseries.macro_signals(d.series(spark, sf)).select("country", "nibor_current", "nibor_trend_6m")


@register("select country, nibor_percentile_10y from macro")
def trailing_percentile(spark, sf):
    return timeseries.macro_signals(d.series(spark, sf)).select("country", "nibor_percentile_10y")


@register("select country, m3_yoy_growth, m3_acceleration from macro")
def money_acceleration(spark, sf):
    return timeseries.macro_signals(d.series(spark, sf)).select("country", "m3_yoy_growth", "m3_acceleration")


@register("select country, bond_yield_10y, yield_curve_spread from macro")
def yield_spread(spark, sf):
    return timeseries.macro_signals(d.series(spark, sf)).select("country", "bond_yield_10y", "yield_curve_spread")


@register("select * from macro")
def macro_signals(spark, sf):
    return timeseries.macro_signals(d.series(spark, sf))


@register(f"""select country, {r6('mortgage_rate_current, mortgage_rate_trend')} from (select country, max(case when rn = 1 then value end) as mortgage_rate_current,
    max(case when rn = 1 then value end) - max(case when rn = 12 then value end) as mortgage_rate_trend
  from (select *, row_number() over (partition by country order by obs_date desc) as rn from series where series_key = 'rate') group by 1)""")
def mortgage_trend(spark, sf):
    rates = d.series(spark, sf).filter("series_key = 'rate'").select("country", "obs_date", "value")
    return fixed(timeseries.rate_trend(rates, "obs_date", "value", by=["country"]))


@register("""select country, series_key, strftime(obs_date, '%Y-%m-%d') as obs_date, value, from_end
  from (select *, row_number() over (partition by country, series_key order by obs_date desc) as from_end from series) where from_end <= 24""")
def last_observations(spark, sf):
    out = timeseries.last_observations(d.series(spark, sf), ["country", "series_key"], "obs_date", 24)
    return out.withColumn("obs_date", F.col("obs_date").cast("string")).withColumn("from_end", F.col("from_end").cast("long"))


@register(f"""select region_code, {rnd('avg(latest_price_sqm)', 4)} as latest_index, {rnd('avg(price_growth_1y) / 4.0', 6)} as index_momentum_qoq,
  {rnd('coalesce(stddev_samp(price_growth_1y), 0.0) / 4.0', 6)} as volatility_qoq
  from price_growth join regions on code = municipality_code group by 1""")
def county_rollup(spark, sf):
    growth_rows = timeseries.growth(d.price_sqm(spark, sf), "municipality_code", "year", "price_sqm",
                                    names=("price_growth_1y", "price_growth_3y", "latest_price_sqm"))
    placed = growth_rows.join(d.regions(spark, sf).select(F.col("code").alias("municipality_code"), "region_code"), "municipality_code")
    out = agg.county_rollup(placed, "region_code", "latest_price_sqm", "price_growth_1y")
    return fixed(out.withColumn("latest_index", rounded(F.col("latest_index"), 4)))


@register("select country, region_code, permits_per_1000_stock, permits_rolling3y from rm_latest")
def latest_per_group(spark, sf):
    rate = d.region_model_tables(spark, sf)["building_rate"]
    return agg.latest_non_null(rate, ["country", "region_code"], "year", ["permits_per_1000_stock", "permits_rolling3y"])


@register(f"select country, region_code, dwelling_type, {r6('volatility_qoq')} from rm_volatility")
def growth_volatility(spark, sf):
    steps = d.region_model_tables(spark, sf)["price_index"]
    return fixed(steps.groupBy("country", "region_code", "dwelling_type").agg(F.stddev_samp("growth_qoq").alias("volatility_qoq")))


@register(f"""select p_brand as rent_zone, s::DOUBLE as sqm, {rnd('base * pow(s / 60.0::DOUBLE, 0.75)', 0)} as monthly_rent
  from (select p_brand, avg(p_retailprice) as base from part group by 1), (select unnest([30, 45, 60, 75, 90, 105]) as s)""")
def synthetic_rent_grid(spark, sf):
    bases = d.table(spark, sf, "part").groupBy(F.col("p_brand").alias("rent_zone")).agg(F.avg("p_retailprice").alias("base_rent"))
    return rent.synthetic_rent_grid(bases)


@register(f"""select coalesce(zone, '7.00') as rent_zone, s::DOUBLE as sqm, {rnd('m * s', 0)} as monthly_rent
  from (select coalesce(z.zone, '7.00') as zone, avg(x) as m
        from (select municipality_code, avg(total_price_calc / nullif(sqm, 0)) as x from listings group by 1) left join zone_direct z using (municipality_code) group by 1),
       (select unnest([30, 45, 60, 75, 90, 105]) as s)""")
def zone_size_expand(spark, sf):
    unit = F.try_divide(F.col("total_price_calc"), F.col("sqm"))
    rents = d.listings(spark, sf).groupBy(F.col("municipality_code").alias("code")).agg(F.avg(unit).alias("rent_per_sqm"))
    zones = d.zone_dims(spark, sf)[0].select(F.col("municipality_code").alias("code"), F.col("zone").alias("rent_zone"))
    return rent.zone_rent_grid(rents, zones)


@register(f"select municipality_code, round_even(sum(employed) * 2, 0)::DOUBLE as population from employment group by 1")
def population_doubled(spark, sf):
    return agg.doubled_population(d.employment(spark, sf), "municipality_code", "employed")


@register("select municipality_clean, quarter, sum(permits) as permits from permits group by 1, 2")
def summed_slices(spark, sf):
    """One slice for each quarter of a year; together they hold every row."""
    from regionscore.sources.cubes import union_slices
    rows = d.permits(spark, sf).select("municipality_clean", "quarter", "permits")
    slices = [rows.filter(F.col("quarter").endswith(k)) for k in ("K1", "K2", "K3", "K4")]
    return agg.sum_by(union_slices(slices), ["municipality_clean", "quarter"], "permits")


@register("""select * from permits where quarter in (select distinct quarter from permits order by quarter desc limit 8)""")
def latest_periods_slice(spark, sf):
    return timeseries.latest_periods(d.permits(spark, sf), "quarter", 8)


FEATURE_DOUBLES = "latest_price_sqm, debt_burden_pct, mortgage_rate_current, mortgage_rate_trend, latest_wage"


@register(f"""select municipality_code, municipality_clean, price_growth_1y, price_growth_3y, population, employment_hhi, top3_industry_share,
  wage_growth_1y, wage_growth_3y, permits_per_1000, permit_momentum, {r6(FEATURE_DOUBLES, 4)} from features""")
def region_features(spark, sf):
    out = norway_features(d.norway_tables(spark, sf))[0]
    for c in FEATURE_DOUBLES.split(", "):
        out = out.withColumn(c, rounded(F.col(c), 4))
    return out


def se_features_sql(fix) -> str:
    """The second country's features in SQL; `fix` rounds an expression to some digits, or leaves it."""
    return f"""select code as municipality_code, name as municipality_name, lower(name) as municipality_clean,
  {fix('price_growth_1y', 4)} as price_growth_1y, {fix('price_growth_3y', 4)} as price_growth_3y, null::DOUBLE as latest_price_sqm,
  population, {fix('hhi', 6)} as employment_hhi, {fix('latest * 1000.0 / 12.0', 4)} as latest_wage, {fix('wage_growth_1y', 4)} as wage_growth_1y,
  {fix('permits_raw / nullif(population, 0) * 1000.0', 4)} as permits_per_1000, {fix('permit_momentum', 4)} as permit_momentum,
  {fix('case when hi > lo then (ded - lo) / (hi - lo) else 0.5 end', 6)} as debt_burden_pct
  from regions left join ({growth('price_sqm', 'municipality_code', 'year', 'price_sqm', 'price_growth_1y', 'price_growth_3y', 'l', 1, None)}) p on p.municipality_code = code
  left join (select municipality_code, round_even(sum(employed) * 2, 0)::DOUBLE as population from employment group by 1) q on q.municipality_code = code
  left join (select municipality_code, sum(employed * employed) / pow(sum(employed), 2) as hhi from employment where employed > 0 group by 1) h on h.municipality_code = code
  left join ({growth("(select lpad(substr(municipality_clean, 8), 4, '0') as municipality_code, year, monthly_wage from wages)", 'municipality_code', 'year', 'monthly_wage', 'wage_growth_1y', 'w3', 'latest', 1, None)}) w on w.municipality_code = code
  left join (select municipality_code, sum(permits) as permits_raw, arg_max(m, quarter) as permit_momentum
     from (select *, {pct('permits', 'case when pv > 0 then pv end')} as m from (
        select *, lag(permits) over (partition by municipality_code order by quarter) as pv from permits)) group by 1) c on c.municipality_code = code
  left join (select *, min(ded) over () as lo, max(ded) over () as hi from (
     select {code('c_nationkey')} as municipality_code, avg(c_acctbal) as ded from customer group by 1)) b on b.municipality_code = code"""


@register(se_features_sql(rnd))
def region_features_from_dimension(spark, sf):
    """The second country's features: the region dimension is the base, growth is not rounded."""
    out = sweden_features(se_tables(spark, sf), d.regions(spark, sf))[0]
    digits = {"employment_hhi": 6, "debt_burden_pct": 6}
    return out.select(*[
        rounded(F.col(f.name), digits.get(f.name, 4)).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name) for f in out.schema])


def se_tables(spark, sf) -> dict[str, DataFrame]:
    wages = d.wages(spark, sf).select(F.substring("municipality_clean", 8, 9).alias("municipality_code"), "year", F.col("monthly_wage").alias("income_tkr"))
    debt = d.table(spark, sf, "customer").select(F.col("c_nationkey").cast("string").alias("municipality_code"), F.col("c_acctbal").alias("deduction_tkr"))
    return {
        "housing_prices": d.price_sqm(spark, sf).withColumnRenamed("price_sqm", "avg_price_tkr"),
        "population": d.employment(spark, sf).withColumnRenamed("employed", "population_half"),
        "employment": d.employment(spark, sf), "wages": wages,
        "construction": d.permits(spark, sf), "debt_burden": debt,
    }


# ---- normalisation and ranks -------------------------------------------------------------------


@register("select o_orderkey, " + rnd("(o_totalprice - lo) / (hi - lo)", 9) + " as price_norm, " + rnd(
    "1.0 - (coalesce(q, md) - ql) / (qh - ql)", 9) + """ as size_norm from
  (select o_orderkey, o_totalprice, sqm as q from orders left join sizes on o_orderkey = l_orderkey),
  (select min(o_totalprice) as lo, max(o_totalprice) as hi from orders),
  (select min(sqm) as ql, max(sqm) as qh, median(sqm) as md from orders join sizes on o_orderkey = l_orderkey)""")
def minmax_global(spark, sf):
    rows = d.listings(spark, sf).select(F.col("listing_id").alias("o_orderkey"), F.col("total_price_calc").alias("price"), F.col("sqm").alias("size"))
    return fixed(minmax(rows, {"price": False, "size": True}).drop("price", "size"), 9)


@register("select listing_id, municipality_code, " + rnd(norm("coalesce(sqm, md)", "lo", "hi", False), 9) + """ as sqm_norm
  from listings join (select municipality_code, min(sqm) as lo, max(sqm) as hi, median(sqm) as md from listings group by 1) using (municipality_code)""")
def minmax_by_group(spark, sf):
    rows = d.listings(spark, sf).select("listing_id", "municipality_code", "sqm")
    return fixed(minmax(rows, {"sqm": False}, by=["municipality_code"]).drop("sqm"), 9)


@register("select c_custkey, " + rnd("(c_acctbal - lo) / (hi - lo)", 9) + " as balance_norm from customer, (select min(c_acctbal) as lo, max(c_acctbal) as hi from customer)")
def minmax_without_fill(spark, sf):
    rows = d.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return fixed(minmax_unfilled(rows, "c_acctbal", "balance_norm").drop("c_acctbal"), 9)


@register(f"""select l_returnflag, {rnd('median(l_extendedprice)', 6)} as l_extendedprice, {rnd('median(l_quantity)', 6)} as l_quantity,
  {rnd('median(l_discount)', 6)} as l_discount from lineitem group by 1""")
def exact_medians(spark, sf):
    rows = d.table(spark, sf, "lineitem")
    return fixed(exact_median(rows, ["l_extendedprice", "l_quantity", "l_discount"], by=["l_returnflag"]))


@register("""select l_returnflag, count(l_extendedprice) as n, true as price_in_bound, true as quantity_in_bound from lineitem group by 1""")
def approximate_medians(spark, sf):
    """Medians off by at most a thousandth of the rows in rank: a value's ranks are counted, and must reach that range."""
    rows = d.table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice", "l_quantity")
    found = approximate_median(rows, ["l_extendedprice", "l_quantity"], by=["l_returnflag"], accuracy=1000)
    met = rows.join(F.broadcast(found.select("l_returnflag", F.col("l_extendedprice").alias("p"), F.col("l_quantity").alias("q"))), "l_returnflag")  # a row per flag

    def near(column: str, at: str) -> Column:
        n, below, upto = F.count(column), F.count_if(F.col(column) < F.col(at)), F.count_if(F.col(column) <= F.col(at))
        return (below <= n / 2 + n / 1000 + 1) & (upto >= n / 2 - n / 1000 - 1)

    return met.groupBy("l_returnflag").agg(F.count("l_extendedprice").alias("n"), near("l_extendedprice", "p").alias("price_in_bound"), near("l_quantity", "q").alias("quantity_in_bound"))


def _percentile_sql(score: str, by: str = "", digits: int = 1) -> str:
    part = f"partition by {by} " if by else ""
    both = f"{by}, {score}" if by else score
    share = f"(rank() over ({part}order by {score}) + (count(*) over (partition by {both}) - 1) / 2.0) / count({score}) over ({part}) * 100.0"
    return f"case when {score} is not null then {rnd(share, digits)} end"


@register(f"""select o_orderkey, {_percentile_sql('s')} as percentile, {_percentile_sql('t', 'o_orderpriority', 4)} as within
  from (select o_orderkey, o_orderpriority, case when o_orderkey % 11 <> 0 then {rnd('o_totalprice / 5000.0', 1)} end as s,
          case when o_orderkey % 3 = 0 then 1.0 when o_orderkey % 13 <> 0 then o_totalprice end as t from orders)""")
def rank_pct_avg_ties(spark, sf):
    """Rounded scores with gaps; and within groups unrounded ones, a third of the rows sharing one score."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    rows = d.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", F.when(key % 11 != 0, rounded(price / 5000.0, 1)).alias("s"), F.when(key % 3 == 0, 1.0).when(key % 13 != 0, price).alias("t"))
    rows = ranking.percentile_rank(rows, "s", "percentile")
    return ranking.percentile_rank(rows, "t", "within", by=["o_orderpriority"], digits=4).select("o_orderkey", "percentile", "within")


@register("select o_orderkey, row_number() over (order by o_totalprice desc, o_orderkey) as rank from orders")
def rank_all(spark, sf):
    rows = d.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return ranking.numbered(rows, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()]).drop("o_totalprice")


# ---- rent, yield, dimensions -------------------------------------------------------------------


@register("select listing_id, zone from zoned")
def zone_resolution(spark, sf):
    rows = d.listings(spark, sf).select("listing_id", "municipality_code", "rent_zone")
    return rent.resolve_zone(rows, "norway", *d.zone_dims(spark, sf)).select("listing_id", F.col("_zone").alias("zone"))


@register(f"select listing_id, {r6('estimated_monthly_rent', 4)} from rented")
def rent_interpolated(spark, sf):
    rows = rent.resolve_zone(d.listings(spark, sf), "norway", *d.zone_dims(spark, sf))
    out = rent.estimate_rent(rows, d.rent_grid(spark, sf), "norway")
    return fixed(out.select("listing_id", "estimated_monthly_rent"), 4)


@register("select listing_id, gross_yield_pct from enriched")
def gross_yields(spark, sf):
    return L.enrich_listings(d.listings(spark, sf), None, d.rent_grid(spark, sf), None, d.dimensions(spark, sf)).select("listing_id", "gross_yield_pct")


@register("select listing_id, index_region_code from enriched")
def index_region_fallback(spark, sf):
    rows = d.listings(spark, sf).select("listing_id", "municipality_clean", "region_code")
    return L.index_region(rows, *d.index_dims(spark, sf)).select("listing_id", "index_region_code")


def enriched(spark, sf) -> DataFrame:
    rows = land(d.listings(spark, sf))  # read twice: for the features and for the listings
    features, grid, index = norway_features(d.norway_tables(spark, sf, rows))
    return L.enrich_listings(rows, features, grid, index, d.dimensions(spark, sf))


@register("select listing_id, municipality_code, population, employment_hhi from listings left join (select municipality_code, population, employment_hhi from features) using (municipality_code)")
def colocated_features(spark, sf):
    """Listings kept in buckets by region, joined with region features without moving the listings again."""
    rows = land(d.listings(spark, sf))
    features = norway_features(d.norway_tables(spark, sf, rows))[0].select("municipality_code", "population", "employment_hhi")
    kept = bucketed(rows.select("listing_id", "municipality_code"), "municipality_code", 32)
    return kept.join(features).select("listing_id", "municipality_code", "population", "employment_hhi")


def macro(spark, sf) -> dict:
    return timeseries.macro_signals(d.series(spark, sf).filter("country = 'O'")).first().asDict()


@register(f"""select listing_id, municipality_code, gross_yield_pct, price_growth_1y, wage_growth_1y, employment_hhi, permits_per_1000,
  index_momentum_qoq, volatility_qoq, {r6('estimated_monthly_rent, latest_price_sqm', 4)} from enriched""")
def enriched_listings(spark, sf):
    out = enriched(spark, sf).select(
        "listing_id", "municipality_code", "gross_yield_pct", "price_growth_1y", "wage_growth_1y", "employment_hhi",
        "permits_per_1000", "index_momentum_qoq", "volatility_qoq", "estimated_monthly_rent", "latest_price_sqm")
    return fixed(out, 4)


# ---- listing scores ----------------------------------------------------------------------------


def scored(spark, sf) -> DataFrame:
    return L.score_listings(enriched(spark, sf), macro(spark, sf))


def ranked(spark, sf) -> DataFrame:
    return L.rank_listings(scored(spark, sf))


@register(f"select listing_id, yield_score, growth_score, {r6('risk_score')}, composite_score, risk_label from ranked")
def listing_scores(spark, sf):
    out = scored(spark, sf).select("listing_id", "yield_score", "growth_score", "risk_score", "composite_score", "risk_label")
    return out.withColumn("risk_score", rounded(F.col("risk_score"), 6))


@register("select listing_id, rank, percentile, recommendation from tiered")
def listing_tiers(spark, sf):
    return ranked(spark, sf).select("listing_id", "rank", "percentile", "recommendation")


@register("select rank, listing_id, municipality_name, composite_score, recommendation from tiered where rank <= 50")
def top_n_listings(spark, sf):
    return L.top_listings(ranked(spark, sf), 50).select("rank", "listing_id", "municipality_name", "composite_score", "recommendation")


@register("select risk_label, recommendation, count(*) as n from tiered group by 1, 2")
def tier_summary(spark, sf):
    return ranked(spark, sf).groupBy("risk_label", "recommendation").agg(F.count(F.lit(1)).alias("n"))


@register("select listing_id from listings where municipality_code in ('0003', '0007')")
def city_filter(spark, sf):
    return L.filter_regions(d.listings(spark, sf), ["0003", "0007"]).select("listing_id")


@register("""select signal, count(*) as n, count(*) filter (v is null) as n_null, count(*) filter (municipality_code = '0024') as unmapped,
  count(*) filter (v is null) / count(*) > 0.2 as warn from (
  select municipality_code, 'gross_yield_pct' as signal, gross_yield_pct as v from enriched union all
  select municipality_code, 'sqm', sqm from enriched union all select municipality_code, 'index_momentum_qoq', index_momentum_qoq from enriched) group by 1""")
def dq_report(spark, sf):
    return agg.quality_report(enriched(spark, sf), ["gross_yield_pct", "sqm", "index_momentum_qoq"], unmapped="0024")


# ---- region model ------------------------------------------------------------------------------


def region_table(spark, sf) -> DataFrame:
    return R.region_feature_table(d.region_model_tables(spark, sf))


RM_KEYS = "country, region_code, dwelling_type"


@register(f"""select {RM_KEYS}, {r6('yield_premium, price_vs_national, supply_tightening, index_gap, volatility_qoq, completion_ratio')} from rm_features""")
def region_feature_rows(spark, sf):
    return fixed(region_table(spark, sf).select(
        *RM_KEYS.split(", "), "yield_premium", "price_vs_national", "supply_tightening", "index_gap", "volatility_qoq", "completion_ratio"))


def _rank_sql(name: str) -> str:
    tied = f"rank() over (partition by country order by {name}_score) + (count(*) over (partition by country, {name}_score) - 1) / 2.0"
    return rnd(f"({tied}) / count(*) over (partition by country) * 100.0", 1) + f" as {name}_pct_rank"


@register(f"""select {RM_KEYS}, yield_score, growth_score, composite_score, {rnd('risk', 6)} as risk_score,
  {_rank_sql('yield')}, {_rank_sql('growth')}, {_rank_sql('composite')} from rm_scores""")
def region_scores(spark, sf):
    out = R.score_regions(region_table(spark, sf)).select(
        *RM_KEYS.split(", "), "yield_score", "growth_score", "composite_score", "risk_score",
        "yield_pct_rank", "growth_pct_rank", "composite_pct_rank")
    return fixed(out)


def _recommend_sql(src: str, score: str, top_n: int, group: str = "") -> str:
    part = f"partition by {group} " if group else ""
    extra = f"{group}, " if group else ""
    return f"""select {extra}{RM_KEYS}, rank, {score},
      case when rank > greatest(n - {top_n // 2}, 1) then 'AVOID' when rank <= {max(1, top_n)} then 'BUY' else 'HOLD' end as recommendation,
      case when risk < 0.33 then 'Low' when risk < 0.66 then 'Medium' else 'High' end as risk_score
      from (select *, row_number() over ({part}order by {score} desc, {RM_KEYS}) as rank, count(*) over ({part}) as n from {src})"""


def _recommended(df: DataFrame, score: str, *group: str) -> DataFrame:
    return df.select(*group, *RM_KEYS.split(", "), F.col("rank").cast("long").alias("rank"), score, "recommendation", "risk_score")


@register(_recommend_sql("rm_scores", "composite_score", 10))
def recommend_balanced(spark, sf):
    return _recommended(R.recommend(R.score_regions(region_table(spark, sf))), "composite_score")


@register(_recommend_sql("(select * from rm_scores where country = '01' and gross_yield_pct >= 3.0 and growth_1Y_ann >= -10.0)", "yield_score", 4))
def recommend_filtered(spark, sf):
    scores = R.score_regions(region_table(spark, sf))
    return _recommended(R.recommend(scores, "yield", 4, country="01", min_yield=3.0, min_growth=-10.0), "yield_score")


_SCENARIO = " union all ".join(
    f"select '{k}' as scenario, {yw}::DOUBLE as scenario_yield_weight, * from ({rm_scored(str(yw), str(gw))})" for k, (yw, gw) in R.SCENARIOS.items())


@register(_recommend_sql(f"({_SCENARIO})", "composite_score", 5, "scenario, scenario_yield_weight"))
def scenario_compare(spark, sf):
    return _recommended(R.scenario(region_table(spark, sf)), "composite_score", "scenario", "scenario_yield_weight")


@register(f"select * from ({_recommend_sql('rm_scores', 'growth_score', 10)}) where recommendation = 'BUY' or (recommendation = 'AVOID' and rank <= (select count(*) from rm_scores))")
def shortlist(spark, sf):
    return _recommended(R.shortlist(R.recommend(R.score_regions(region_table(spark, sf)), "growth", 10)), "growth_score")


_FRONTIER = """select {cols} from {src} a where not exists (select 1 from {src} b where b.yield_score >= a.yield_score and b.growth_score >= a.growth_score
  and (b.yield_score > a.yield_score or b.growth_score > a.growth_score))"""


@register(_FRONTIER.format(cols=f"{RM_KEYS}, yield_score, growth_score, true as pareto_optimal", src="rm_scores"))
def pareto_frontier(spark, sf):
    out = ranking.pareto_frontier(R.score_regions(region_table(spark, sf)))
    return out.select(*RM_KEYS.split(", "), "yield_score", "growth_score", "pareto_optimal")


@register("""select o_orderkey from (select *, max(l) over (order by s desc rows between unbounded preceding and 1 preceding) as above from (
    select *, max(l) over (partition by s) as best from (select o_orderkey, o_totalprice as s, l from orders left join
      (select l_orderkey, max(l_extendedprice) as l from lineitem group by 1) on l_orderkey = o_orderkey)))
  where s is null or l is null or (l = best and (above is null or l > above))""")
def pareto_unrounded(spark, sf):
    """Scores with as many values as rows."""
    best = d.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_extendedprice").alias("growth_score"))
    rows = d.table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("yield_score")).join(best, "o_orderkey", "left")
    return ranking.pareto_frontier(land(rows)).select("o_orderkey")


@register(_FRONTIER.format(cols="listing_id, yield_score, growth_score", src="(select distinct yield_score, growth_score from scored)").replace(
    "select listing_id, yield_score, growth_score from (select distinct yield_score, growth_score from scored) a where",
    "select listing_id, yield_score, growth_score from scored a where"))
def pareto_listings(spark, sf):
    return ranking.pareto_frontier(scored(spark, sf)).select("listing_id", "yield_score", "growth_score")


# ---- text, codes, files ------------------------------------------------------------------------


@register("""select c_custkey, lower(trim(name)) as key from (select c_custkey, c_mktsegment as name, n_name, c_custkey % 4 as kind from customer join nation on c_nationkey = n_nationkey)
  where kind <> 3""")
def name_keys(spark, sf):
    """Suffixes are put onto the names and must go again; historical names are dropped."""
    c, n = d.table(spark, sf, "customer"), d.table(spark, sf, "nation")
    kind = F.col("c_custkey") % 4
    seg = F.col("c_mktsegment")
    name = (F.when(kind == 0, F.concat(seg, F.lit(" - "), F.col("n_name"))).when(kind == 1, F.concat(seg, F.lit(" (old)")))
            .when(kind == 2, F.concat(F.lit("  "), seg)).otherwise(F.concat(seg, F.lit(" (1998-2004)"))))
    rows = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", name.alias("name"))
    return current_regions(rows, "name").select("c_custkey", name_key(F.col("name")).alias("key"))


@register("""select p_partkey, concat(p_size, '.', rpad(cast(p_partkey % 10 as varchar), 2, '0')) as zone, lpad(cast(p_size as varchar), 4, '0') as code,
  substr(lpad(cast(p_size as varchar), 4, '0'), 1, 2) as county from part""")
def code_keys(spark, sf):
    p = d.table(spark, sf, "part")
    code4 = pad_code(F.col("p_size"))
    zone = zone_key(F.concat(F.col("p_size"), F.lit("."), F.col("p_partkey") % 10))
    return p.select("p_partkey", zone.alias("zone"), code4.alias("code"), county_of(code4).alias("county"))


@register(f"select o_orderkey, {rnd('floor(o_totalprice)', 0)} as price_no, {rnd('floor(o_totalprice)', 0)} as price_se, {rnd('o_totalprice', 2)} as decimal_no from orders")
def number_parse(spark, sf):
    """Prices written the local way, with thin or non-breaking spaces and units, read back."""
    whole = F.floor("o_totalprice").cast("string")
    spaced = F.regexp_replace(whole, r"(?<=\d)(?=(\d{3})+$)", "\u00a0")
    decimal = F.replace(F.format_number("o_totalprice", 2), F.lit(","), F.lit(" "))
    return d.table(spark, sf, "orders").select(
        "o_orderkey",
        number_no(F.concat(spaced, F.lit(" kr"))).alias("price_no"),
        number_se(F.concat(F.translate(spaced, "\u00a0", "\u2009"), F.lit(" kr/mån"))).alias("price_se"),
        number_no(F.replace(decimal, F.lit("."), F.lit(","))).alias("decimal_no"),
    )


@register(f"""select o_orderkey, greatest(least(greatest(x, 0.0), 2.0) - 1.0, 0.0) as oversupply,
  case when x / 3 < 0.33 then 'Low' when x / 3 < 0.66 then 'Medium' else 'High' end as label,
  {rnd('100.0 * o_totalprice / nullif(floor(x), 0)', 4)} as yield
  from (select o_orderkey, o_totalprice, {rnd('o_totalprice / 150000.0', 3)} as x from orders)""")
def guarded_ratios(spark, sf):
    x = rounded(F.col("o_totalprice") / 150000.0, 3)
    rows = d.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", x.alias("x"))
    return rows.select("o_orderkey", oversupply(F.col("x")).alias("oversupply"), risk_label(F.col("x") / 3).alias("label"),
                       rounded(gross_yield(F.col("o_totalprice"), F.floor("x")), 4).alias("yield"))


@register("select c_custkey, c_name, c_acctbal, lpad(cast(c_nationkey as varchar), 4, '0') as code from customer")
def records_roundtrip(spark, sf):
    """Written as records and read back with a declared schema: codes keep their zeros."""
    rows = d.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", d.code("c_nationkey").alias("code"))
    path = landing_path(spark)
    T.write_records(rows, path)
    return T.read_records(spark, path, rows.schema)


@register("select o_orderkey, o_orderstatus, o_totalprice from orders")
def csv_export(spark, sf):
    """Listed columns that exist, exported with a header and read back."""
    path = landing_path(spark)
    T.export_csv(d.table(spark, sf, "orders"), path, ["o_orderkey", "no_such_column", "o_orderstatus", "o_totalprice"])
    return spark.read.schema("o_orderkey long, o_orderstatus string, o_totalprice double").csv(path, header=True)


@register("""select c_custkey as id, c_acctbal as balance, null::VARCHAR as name, 'c' as kind from customer
  union all select s_suppkey, null, s_name, 's' from supplier""")
def ragged_union(spark, sf):
    c = d.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.lit("c").alias("kind"))
    s = d.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("s").alias("kind"))
    return T.union_ragged([c, s])


@register("select c_custkey, c_name from customer")
def named_tables(spark, sf):
    """A named table, and one that does not exist and is empty."""
    schema = "c_custkey long, c_name string"
    there, missing = (T.load_table(spark, sf, n, schema).select("c_custkey", "c_name") for n in ("customer", "no_such_table"))
    return there.unionByName(missing)


@register("select code, name, region_code, region_name, case when n_nationkey % 2 = 0 then '99' else rent_zone end as rent_zone from regions join nation on n_name = name")
def regions_from_document(spark, sf):
    """The region dimension written as JSON documents, one for each county, and loaded; even regions lack a zone."""
    zone = F.when(F.substring("rent_zone", 2, 9).cast("int") % 2 == 1, F.col("rent_zone"))
    items = d.regions(spark, sf).withColumn("rent_zone", zone)
    document = items.groupBy("region_code").agg(F.collect_list(F.struct("*")).alias("municipalities"))
    path = landing_path(spark)
    document.select(F.to_json(F.struct("municipalities")).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return T.load_regions(spark, path, "norway")


@register("""select p_partkey, (case p_size % 7 when 0 then 30.0 when 1 then 50.0 when 2 then 70.0 when 3 then 90.0 when 4 then 120.0 when 5 then 140.0 end)::DOUBLE as sqm from part""")
def size_codes(spark, sf):
    """Size codes written as text or as numbers, and one that is unknown, to square metres."""
    written = F.element_at(F.array(*map(F.lit, ("1.030", "2.05", "3.07", "3.090", "4.12", "4.140", "9.999"))), F.col("p_size") % 7 + 1)
    return d.table(spark, sf, "part").select("p_partkey", rent.size_of_code(written, rent.SIZE_CODES_NO).alias("sqm"))


@register(f"""select lower(c_name) as alias, {code('c_nationkey')} as code, true as fuzzy_eligible from customer
  union all select replace(lower(c_name), '#', ''), {code('c_nationkey')}, false from customer where c_custkey % 10 <> 0
  union all select replace(lower(c_name), '#', ''), 'x', false from customer where c_custkey % 10 = 0""")
def alias_derivation(spark, sf):
    """Names give themselves and a cleaned variant; given aliases (of every tenth name) win over the variant."""
    c = d.table(spark, sf, "customer")
    regions = c.select(d.code("c_nationkey").alias("code"), F.col("c_name").alias("name"))
    given = c.filter("c_custkey % 10 = 0").select(
        F.translate(F.lower("c_name"), "#", "").alias("alias"), F.lit("x").alias("code"), F.lit(False).alias("fuzzy_eligible"))
    return gazetteer(regions, given, "norway")


@register("""select c_custkey from (select c_custkey, 59.0 + c_custkey % 997 / 100.0 as lat, 9.0 + c_acctbal / 5000.0 as lon from customer)
  where asin(sqrt(pow(sin(radians(lat - 63.43049) / 2), 2) + cos(radians(lat)) * cos(radians(63.43049)) * pow(sin(radians(lon - 10.39506) / 2), 2))) * 2 * 6371000.0 <= 60000.0""")
def radius_filter(spark, sf):
    """Listings within a distance of a point."""
    c = d.table(spark, sf, "customer")
    placed = c.select("c_custkey", (59.0 + F.col("c_custkey") % 997 / 100.0).alias("lat"), (9.0 + F.col("c_acctbal") / 5000.0).alias("lon"))
    return L.within_radius(placed, 63.43049, 10.39506, 60000.0).select("c_custkey")


@register("""select c_custkey, s_suppkey as centre_id from (select c_custkey, 59.0 + c_custkey % 997 / 100.0 as lat, 9.0 + c_acctbal / 5000.0 as lon from customer),
    (select s_suppkey, 59.0 + s_suppkey % 89 / 10.0 as clat, 9.0 + s_acctbal / 5000.0 as clon, 1000.0 * (5 + s_suppkey % 13 * 8) as metres from supplier)
  where asin(sqrt(pow(sin(radians(lat - clat) / 2), 2) + cos(radians(lat)) * cos(radians(clat)) * pow(sin(radians(lon - clon) / 2), 2))) * 2 * 6371000.0 <= metres""")
def radius_of_many(spark, sf):
    """Listings within a distance of each of many centres, every centre with a radius of its own."""
    c, s = d.table(spark, sf, "customer"), d.table(spark, sf, "supplier")
    placed = d.spread(c.select("c_custkey", (59.0 + F.col("c_custkey") % 997 / 100.0).alias("lat"), (9.0 + F.col("c_acctbal") / 5000.0).alias("lon")))
    centres = s.select(F.col("s_suppkey").alias("centre_id"), (59.0 + F.col("s_suppkey") % 89 / 10.0).alias("lat"), (9.0 + F.col("s_acctbal") / 5000.0).alias("lon"),
                       (1000.0 * (5 + F.col("s_suppkey") % 13 * 8)).alias("metres"))
    return L.near_centres(placed, centres).select("c_custkey", "centre_id")

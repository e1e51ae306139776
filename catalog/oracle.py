"""The registered queries in SQL: shared derivations as named subqueries, then one statement each."""

from __future__ import annotations

import re



def rnd(x: str, digits: int) -> str:
    """Round half to even on the scaled value, as the library does."""
    return f"(round_even((({x})::DOUBLE) * 1e{digits}, 0) / 1e{digits} + 0.0)"


def code(x: str, width: int = 4) -> str:
    return f"lpad(cast({x} as varchar), {width}, '0')"


def quarter(x: str) -> str:
    return f"concat(year({x}), 'K', quarter({x}))"


def pct(now: str, before: str) -> str:
    return f"(({now}) / nullif({before}, 0) - 1.0) * 100.0"


def cagr(now: str, base: str) -> str:
    return f"(pow(({now}) / (case when ({base}) > 0 then ({base}) end), 1.0::DOUBLE / 3) - 1.0) * 100.0"


def growth(src: str, key: str, period: str, value: str, one: str, three: str, latest: str, min_rows=2, digits=2, keep="") -> str:
    w = f"over (partition by {key} order by {period})"
    fix = (lambda x: rnd(x, digits)) if digits is not None else (lambda x: x)
    extra = f"{keep}, " if keep else ""
    return f"""select {key}, {extra}{fix(pct('x0', 'case when x1 > 0 then x1 end'))} as {one},
        {fix(cagr('x0', 'x3'))} as {three}, x0 as {latest}
      from (select {key}, {extra}{value} as x0, lag({value}, 1) {w} as x1, lag({value}, 3) {w} as x3,
              row_number() {w} as rn, lead(1) {w} as nx from {src})
      where nx is null and rn >= {min_rows}"""


SIGNALS = {
    "yield": ("gross_yield_pct", False), "price": ("price_per_sqm / nullif(latest_price_sqm, 0)", True),
    "g1": ("price_growth_1y", False), "g3": ("price_growth_3y", False), "momentum": ("index_momentum_qoq", False),
    "wage": ("wage_growth_1y", False), "hhi": ("employment_hhi", False), "volatility": ("volatility_qoq", False),
    "debt": ("debt_burden_pct", False), "permits": ("permits_per_1000", False),
}


def norm(x: str, low: str, high: str, invert: bool) -> str:
    p = f"(({x}) - {low}) / ({high} - {low})"
    return f"(case when {low} = {high} then 0.5 else coalesce({'1.0 - ' if invert else ''}{p}, 0.5) end)"


REGION_SIGNALS = {
    "gross_yield_pct": False, "yield_premium": False, "permits_per_1000_stock": True, "price_vs_national": True,
    "growth_1Y_ann": False, "growth_3Y_ann": False, "supply_tightening": False, "index_gap": False,
    "volatility_qoq": False, "oversupply": False,
}

CTES: dict[str, str] = {
    "regions": f"""select {code('n_nationkey')} as code, n_name as name, {code('n_regionkey', 2)} as region_code,
        r_name as region_name, concat('g', n_nationkey) as rent_zone from nation join region on n_regionkey = r_regionkey""",
    "zone_direct": f"select {code('n_nationkey')} as municipality_code, concat('Brand#', n_nationkey + 1) as zone from nation where n_nationkey % 3 <> 0",
    "zone_generic": "select concat('g', n_nationkey) as rent_zone, concat('Brand#', n_nationkey + 1) as zone from nation where n_nationkey % 3 = 0 and n_nationkey < 20",
    "index_by_name": f"select lower(n_name) as key, {code('n_regionkey', 3)} as idx from nation where n_nationkey < 5",
    "index_by_region": f"select {code('r_regionkey', 2)} as key, {code('r_regionkey', 3)} as idx from region where r_regionkey between 1 and 3",
    "order_nation": "select orders.*, c_nationkey as nation from orders join customer on o_custkey = c_custkey",
    "sizes": "select l_orderkey, avg(l_quantity) as sqm from lineitem group by 1",
    "listings": f"""select o_orderkey as listing_id, o_totalprice as total_price_calc, sqm,
        {rnd('nullif(o_totalprice, 0) / nullif(sqm, 0)', 0)} as price_per_sqm, cast(year(o_orderdate) as varchar) as year,
        code as municipality_code, name as municipality_name, lower(name) as municipality_clean, region_code, region_name, rent_zone
      from order_nation left join sizes on o_orderkey = l_orderkey join regions on {code('nation')} = code""",
    "price_sqm": """select municipality_code, municipality_clean, year, avg(total_price_calc / nullif(sqm, 0)) as price_sqm
      from listings group by 1, 2, 3""",
    "price_index": f"""select {code('n_regionkey', 3)} as region_code, {quarter('o_orderdate')} as quarter, avg(o_totalprice) as index_value
      from order_nation join nation on nation = n_nationkey group by 1, 2""",
    "population": f"select {code('c_nationkey')} as municipality_code, concat('nation_', c_nationkey) as municipality_clean, count(*)::DOUBLE as population from customer group by 1, 2",
    "employment": f"select {code('c_nationkey')} as municipality_code, c_mktsegment as industry_code, count(*)::DOUBLE as employed from customer group by 1, 2",
    "debt": f"select {code('c_nationkey')} as municipality_code, avg((c_acctbal < 0)::INT::DOUBLE) * 100.0 as debt_burden_pct from customer group by 1",
    "wages": """select concat('nation_', s_nationkey) as municipality_clean, cast(year(l_shipdate) as varchar) as year,
        avg(l_extendedprice) as monthly_wage from lineitem join supplier on l_suppkey = s_suppkey group by 1, 2""",
    "permits": f"""select {code('nation')} as municipality_code, concat('nation_', nation) as municipality_clean,
        {quarter('o_orderdate')} as quarter, count(*)::DOUBLE as permits from order_nation group by 1, 2, 3""",
    "monthly": f"""select l_linestatus as country, cast(date_trunc('month', l_shipdate) as date) as obs_date,
        {rnd('avg(l_discount) * 100.0', 6)} as rate, {rnd('sum(l_extendedprice)', 2)} as money, {rnd('avg(l_tax) * 100.0', 6)} as bond
      from lineitem group by 1, 2""",
    "series": """select country, obs_date, 'rate' as series_key, rate as value from monthly
      union all select country, obs_date, 'money', money from monthly union all select country, obs_date, 'bond', bond from monthly""",
    "tail": """select * from (select *, row_number() over (partition by country, series_key order by obs_date desc) as from_end from series)
      where from_end <= 120""",
    "rent_grid": "select p_brand as zone, p_size::DOUBLE as sqm, avg(p_retailprice) as monthly_rent from part group by 1, 2",
    "price_growth": growth("price_sqm", "municipality_code", "year", "price_sqm", "price_growth_1y", "price_growth_3y", "latest_price_sqm", keep="municipality_clean"),
    "wage_growth": growth("wages", "municipality_clean", "year", "monthly_wage", "wage_growth_1y", "wage_growth_3y", "latest_wage"),
    "hhi": f"""select municipality_code, {rnd('sum(employed * employed) / pow(sum(employed), 2)', 4)} as employment_hhi,
        {rnd('sum(case when rn <= 3 then employed end) / sum(employed) * 100.0', 1)} as top3_industry_share
      from (select *, row_number() over (partition by municipality_code order by employed desc, industry_code) as rn
            from employment where industry_code not in ('00-99', '00', 'ALLE')) group by 1 having sum(employed) > 0""",
    "index_signals": f"""select region_code, {rnd('arg_max(qoq, quarter)', 2)} as index_momentum_qoq,
        {rnd('case when count(qoq) > 1 then stddev_pop(qoq) end', 2)} as volatility_qoq, arg_max(index_value, quarter) as latest_index
      from (select *, (index_value - p) / nullif(p, 0) * 100.0 as qoq
            from (select *, lag(index_value) over (partition by region_code order by quarter) as p from price_index))
      group by 1 having count(*) >= 2""",
    "quarters": "select quarter, row_number() over (order by quarter desc) as age, count(*) over () as qn from (select distinct quarter from permits)",
    "permit_flows": f"""select municipality_clean, total_permits_2y, case when qn >= 8 then recent else total_permits_2y end as recent_permits_1y,
        {rnd('case when qn >= 8 then ' + pct('recent', 'case when prior > 0 then prior end') + ' end', 1)} as permit_momentum
      from (select municipality_clean, max(qn) as qn, sum(permits) as total_permits_2y,
              coalesce(sum(case when age <= 4 then permits end), 0) as recent,
              coalesce(sum(case when age between 5 and 8 then permits end), 0) as prior
            from permits join quarters using (quarter) group by 1)""",
    "supply": f"""select municipality_clean, {rnd('recent_permits_1y / nullif(population / 1000.0, 0)', 2)} as permits_per_1000, permit_momentum
      from permit_flows left join population using (municipality_clean)""",
    "macro": f"""select country, {rnd('r1', 3)} as nibor_current, {rnd('case when r1 is not null then coalesce(r1 - r_past, 0.0) end', 3)} as nibor_trend_6m,
        {rnd('r_pct', 3)} as nibor_percentile_10y, {rnd(pct('m1', 'm13'), 2)} as m3_yoy_growth,
        {rnd('(' + pct('m1', 'm7') + ') - (' + pct('m7', 'm13') + ')', 2)} as m3_acceleration,
        {rnd('b1', 3)} as bond_yield_10y, {rnd('b1 - ' + rnd('r1', 3), 3)} as yield_curve_spread
      from (select country,
          max(value) filter (series_key = 'rate' and from_end = 1) as r1,
          arg_max(value, obs_date) filter (series_key = 'rate' and obs_date <= last_date - 180) as r_past,
          avg((value < cur)::INT::DOUBLE) filter (series_key = 'rate') as r_pct,
          max(value) filter (series_key = 'money' and from_end = 1) as m1,
          max(value) filter (series_key = 'money' and from_end = 7) as m7,
          max(value) filter (series_key = 'money' and from_end = 13) as m13,
          max(value) filter (series_key = 'bond' and from_end = 1) as b1
        from (select *, max(obs_date) over (partition by country, series_key) as last_date,
                max(case when from_end = 1 then value end) over (partition by country, series_key) as cur from tail)
        group by country)""",
    "mortgage": """select max(case when rn = 1 then value end) as mortgage_rate_current,
        max(case when rn = 1 then value end) - max(case when rn = 12 then value end) as mortgage_rate_trend
      from (select value, row_number() over (order by obs_date desc) as rn from series where country = 'O' and series_key = 'rate')""",
    "features": """select g.municipality_code, g.municipality_clean, price_growth_1y, price_growth_3y, latest_price_sqm, population,
        debt_burden_pct, employment_hhi, top3_industry_share, mortgage_rate_current, mortgage_rate_trend,
        wage_growth_1y, wage_growth_3y, latest_wage, permits_per_1000, permit_momentum
      from price_growth g left join population p using (municipality_code) left join debt using (municipality_code)
        left join hhi using (municipality_code) left join (select * from wage_growth where latest_wage > 0) w on g.municipality_clean = w.municipality_clean
        left join supply s on g.municipality_clean = s.municipality_clean, mortgage""",
    "median_grid": "select sqm, median(monthly_rent) as monthly_rent from rent_grid group by 1",
    "zoned": """select l.*, coalesce(d.zone, g.zone, '21.00') as zone, coalesce(sqm, 70.0) as size
      from listings l left join zone_direct d using (municipality_code) left join zone_generic g on l.rent_zone = g.rent_zone""",
    "grid": """select zone, sqm, monthly_rent from rent_grid
      union all select z.zone, m.sqm, m.monthly_rent from (select distinct zone from zoned where zone not in (select zone from rent_grid)) z, median_grid m""",
    "segments": """select zone, sqm as s0, monthly_rent as r0, lead(sqm) over w as s1, lead(monthly_rent) over w as r1,
        row_number() over w = 1 as is_first from grid window w as (partition by zone order by sqm)""",
    "rented": """select z.*, case when z.size <= f.s0 then f.r0 when s.s1 is null or s.s0 = z.size then s.r0
          else s.r0 + (s.r1 - s.r0) / (s.s1 - s.s0) * (z.size - s.s0) end as estimated_monthly_rent
      from zoned z join segments f on f.zone = z.zone and f.is_first
        left join segments s on s.zone = z.zone and z.size >= s.s0 and (z.size < s.s1 or s.s1 is null)""",
    "enriched": f"""select r.*, f.* exclude (municipality_code, municipality_clean), estimated_monthly_rent * 12.0 as estimated_annual_rent,
        {rnd('estimated_monthly_rent * 12.0 / nullif(total_price_calc, 0) * 100.0', 2)} as gross_yield_pct,
        coalesce(n.idx, g.idx, 'TOTAL') as index_region_code, index_momentum_qoq, volatility_qoq, latest_index
      from rented r left join features f on r.municipality_clean = f.municipality_clean
        left join index_by_name n on n.key = r.municipality_clean left join index_by_region g on g.key = r.region_code
        left join index_signals i on i.region_code = coalesce(n.idx, g.idx, 'TOTAL')""",
    "raw_signals": "select *, " + ", ".join(f"{x} as s_{k}" for k, (x, _) in SIGNALS.items()) + " from enriched",
    "limits": "select count(*) as n, " + ", ".join(
        f"min(s_{k}) as lo_{k}, max(s_{k}) as hi_{k}, median(s_{k}) as md_{k}" for k in SIGNALS) + " from raw_signals",
    "normed": "select raw_signals.*, n, " + ", ".join(
        norm(f"coalesce(s_{k}, md_{k})", f"lo_{k}", f"hi_{k}", inv) + f" as z_{k}" for k, (_, inv) in SIGNALS.items()) + " from raw_signals, limits",
    "parts_of_score": """select normed.*, 0.5 * z_yield + 0.25 * z_yield + 0.25 * z_price as ys,
        0.3 * z_g1 + 0.2 * z_g3 + 0.2 * z_momentum + 0.3 * z_wage as gs,
        0.2 * (0.4 * coalesce(nibor_percentile_10y, 0.5) + 0.3 * (case when nibor_trend_6m > 0 then 1.0 else 0.0 end) + 0.3 * z_debt)
          + 0.2 * z_hhi + 0.15 * z_volatility + 0.1 * coalesce(greatest(0.0, least(1.0, (5.0 - m3_acceleration) / 10.0)), 0.5)
          + 0.15 * z_debt + 0.2 * z_permits as risk_score
      from normed, macro where country = 'O'""",
    "scored": f"""select *, {rnd('ys * 100.0', 1)} as yield_score, {rnd('gs * 100.0', 1)} as growth_score,
        {rnd('(0.4::DOUBLE / 0.7::DOUBLE * ys + 0.3::DOUBLE / 0.7::DOUBLE * gs) * (1.0 - 0.3 * risk_score) * 100.0', 1)} as composite_score from parts_of_score""",
    "ranked": f"""select *, row_number() over (order by composite_score desc, listing_id) as rank,
        {rnd('(rank() over (order by composite_score) + (count(*) over (partition by composite_score) - 1) / 2.0) / n * 100.0', 1)} as percentile,
        case when risk_score < 0.33 then 'Low' when risk_score < 0.66 then 'Medium' else 'High' end as risk_label from scored""",
    "tiered": """select *, case when rank > n - greatest(n // 5, 1) then 'AVOID' when rank <= greatest(n // 5, 1) then 'BUY' else 'HOLD' end as recommendation
      from ranked""",
    # region model
    "rm_rows": f"""select {code('n_regionkey', 2)} as country, {code('nation')} as region_code, n_name as region, o_orderstatus as dwelling_type,
        o_totalprice as price, cast(year(o_orderdate) as varchar) as year, {quarter('o_orderdate')} as period
      from order_nation join nation on nation = n_nationkey""",
    "rm_growth": f"""select country, region_code, region, dwelling_type, growth_1Y_ann, growth_3Y_ann, {rnd('l', 6)} as latest_index from ({growth(
        "(select country, region_code, region, dwelling_type, year, avg(price) as price from rm_rows group by all)",
        "country, region_code, region, dwelling_type", "year", "price", "growth_1Y_ann", "growth_3Y_ann", "l", 1, 6)})""",
    "rm_yield": f"""select *, {rnd('avg_monthly_rent * 1200.0 / estimated_price', 6)} as gross_yield_pct from (
        select country, region_code, region, {rnd('avg(price) / 200.0', 6)} as avg_monthly_rent, {rnd('min(price)', 6)} as avg_price_sqm,
          {rnd('max(price)', 6)} as estimated_price from rm_rows group by 1, 2, 3)""",
    "rm_yearly": """select country, region_code, year, count(*)::DOUBLE as n_all, count(*) filter (dwelling_type = 'F')::DOUBLE as done,
        count(*) filter (dwelling_type = 'O')::DOUBLE as started from rm_rows group by 1, 2, 3""",
    "rm_latest": f"""select country, region_code, arg_max(p, year) filter (p is not null) as permits_per_1000_stock,
        arg_max(n_all, year) as permits_rolling3y, arg_max(c, year) filter (c is not null) as completion_ratio
      from (select *, case when year < '2001' then n_all end as p, {rnd('done / nullif(started, 0)', 6)} as c from rm_yearly) group by 1, 2""",
    "rm_momentum": f"""select country, region_code, arg_max(m, period) filter (m is not null) as permit_momentum_yoy from (
        select *, {rnd(pct('n', 'lag(n, 4) over (partition by country, region_code order by period)'), 6)} as m
        from (select country, region_code, period, count(*)::DOUBLE as n from rm_rows group by 1, 2, 3)) group by 1, 2""",
    "rm_steps": f"""select country, region_code, region, dwelling_type, period,
        {rnd(pct('price', 'lag(price) over (partition by country, region_code, region, dwelling_type order by period)'), 6)} as growth_qoq
      from (select country, region_code, region, dwelling_type, period, avg(price) as price from rm_rows group by 1, 2, 3, 4, 5)""",
    "rm_volatility": "select country, region_code, dwelling_type, stddev_samp(growth_qoq) as volatility_qoq from rm_steps group by 1, 2, 3",
    "rm_features": """select g.*, avg_monthly_rent, avg_price_sqm, estimated_price, gross_yield_pct, permits_per_1000_stock, permits_rolling3y,
        completion_ratio, permit_momentum_yoy, volatility_qoq, national_avg_psqm, national_avg_yield,
        gross_yield_pct - national_avg_yield as yield_premium, avg_price_sqm / nullif(national_avg_psqm, 0) as price_vs_national,
        -permit_momentum_yoy as supply_tightening, (select max(latest_index) from rm_growth) - latest_index as index_gap,
        greatest(least(greatest(coalesce(completion_ratio, 1.0), 0.0), 2.0) - 1.0, 0.0) as oversupply
      from rm_growth g left join rm_yield y using (country, region_code, region) left join rm_latest using (country, region_code)
        left join rm_momentum using (country, region_code) left join rm_volatility using (country, region_code, dwelling_type)
        left join (select country, median(avg_price_sqm) as national_avg_psqm, median(gross_yield_pct) as national_avg_yield from rm_yield group by 1) using (country)""",
    "rm_limits": "select country, " + ", ".join(
        f"min({s}) as lo_{s}, max({s}) as hi_{s}, median({s}) as md_{s}" for s in REGION_SIGNALS) + " from rm_features group by 1",
    "rm_norm": "select f.*, " + ", ".join(
        norm(f"coalesce(f.{s}, md_{s})", f"lo_{s}", f"hi_{s}", inv) + f" as z_{s}" for s, inv in REGION_SIGNALS.items())
        + " from rm_features f join rm_limits using (country)",
    "rm_raw": """select *, 0.45 * z_gross_yield_pct + 0.20 * z_yield_premium + 0.20 * z_permits_per_1000_stock + 0.15 * z_price_vs_national as ys,
        0.35 * z_growth_1Y_ann + 0.25 * z_growth_3Y_ann + 0.20 * z_permits_per_1000_stock + 0.10 * z_supply_tightening + 0.10 * z_index_gap as gs,
        0.60 * z_volatility_qoq + 0.40 * z_oversupply as risk from rm_norm""",
}


def rm_scored(yw: str, gw: str) -> str:
    return f"""select *, {rnd('ys * 100.0', 1)} as yield_score, {rnd('gs * 100.0', 1)} as growth_score,
        {rnd(f'({yw}::DOUBLE * ys + {gw}::DOUBLE * gs) * (1.0 - 0.25 * risk) * 100.0', 1)} as composite_score from rm_raw"""


CTES["rm_scores"] = rm_scored("0.5", "0.5")


def full(sql: str, **overrides: str) -> str:
    """The statement with the named subqueries it needs, in order; `overrides` replace some of them."""
    ctes = {**CTES, **overrides}
    need: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name in ctes:
            if name not in need and re.search(rf"(?<![\w.]){name}(?!\w)", text):
                need.add(name)
                todo.append(ctes[name])
    head = ", ".join(f"{n} as materialized ({ctes[n]})" for n in ctes if n in need)
    return f"with {head} {sql}" if need else sql

"""Registered queries over documents: cubes, series, addresses and pages."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import domain as d
from catalog.oracle import code, full, quarter, rnd
from catalog.queries import ORACLE, fixed, register, se_features_sql
from regionscore.fixed import DISTRICTS_GOTHENBURG, DISTRICTS_MALMO, DISTRICTS_STOCKHOLM, PLACES_NO, PLACES_SE, places
from regionscore.landing import drop, land, landing_path
from regionscore.operators import resolve
from regionscore.functions.ratios import rounded
from regionscore.sources import cubes, pages, tables

# ---- statistics documents: one cube per order, (status, measure), filled only for its own status ----

_STATUS = "(case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end)"
_CELLS = f"""select o_orderkey, ['F', 'O', 'P'][i // 2 + 1] as Status_code, concat('Status ', ['F', 'O', 'P'][i // 2 + 1]) as Status,
  ['price', 'customer'][i % 2 + 1] as Measure_code, ['Price', 'customer'][i % 2 + 1] as Measure,
  case when i // 2 = {_STATUS} then case when i % 2 = 0 then o_totalprice else o_custkey::DOUBLE end end as value
  from orders, (select unnest(range(6)) as i)"""


def _cubes(spark, sf) -> tuple[DataFrame, F.Column, F.Column]:
    """Orders, the place of their status, and the document without its values."""
    o = d.spread(d.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey"))
    place = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    head = F.lit(
        '"id":["Status","Measure"],"size":[3,2],"dimension":{'
        '"Status":{"category":{"index":{"P":2,"F":0,"O":1},"label":{"F":"Status F","O":"Status O","P":"Status P"}}},'
        '"Measure":{"category":{"index":["price","customer"],"label":{"price":"Price"}}}},"value":')
    return o, place, head


@register(_CELLS)
def cube_flatten(spark, sf):
    """Dense values in row-major order; one cell more than the cube has must be dropped."""
    o, place, head = _cubes(spark, sf)
    pair = F.array(F.col("o_totalprice"), F.col("o_custkey").cast("double"))
    none = F.array(F.lit(None).cast("double"), F.lit(None).cast("double"))
    value = F.concat(*[F.when(place == i, pair).otherwise(none) for i in range(3)], F.array(F.lit(7.0)))
    docs = o.select("o_orderkey", F.concat(F.lit("{"), head, F.to_json(value), F.lit("}")).alias("doc"))
    return cubes.jsonstat_to_long(docs, ["Status", "Measure"], keep=["o_orderkey"])


@register(f"select * from ({_CELLS.replace('from orders', ', i as place, ' + _STATUS + ' as own from orders')}) where place <= own * 2 + 1"
          .replace("select * from", "select * exclude (place, own) from"))
def cube_flatten_sparse(spark, sf):
    """Two given cells inside a `dataset` envelope; the cells before them become NULL, those after are absent."""
    o, place, head = _cubes(spark, sf)
    cell = lambda i, v: F.concat(F.lit('"'), (place * 2 + i).cast("string"), F.lit('":'), F.col(v).cast("string"))
    value = F.concat(F.lit("{"), cell(1, "o_custkey"), F.lit(","), cell(0, "o_totalprice"), F.lit("}"))
    docs = o.select("o_orderkey", F.concat(F.lit('{"dataset":{'), head, value, F.lit("}}")).alias("doc"))
    return cubes.jsonstat_to_long(docs, ["Status", "Measure"], keep=["o_orderkey"])


@register(f"select {code('c_custkey')} as code, c_acctbal as value from customer where c_acctbal > 0")
def px_flatten(spark, sf):
    """One key/value document per customer; values that are zero, negative or no number are skipped."""
    c = d.table(spark, sf, "customer")
    good = F.struct(F.array(F.col("c_custkey").cast("string")).alias("key"), F.array(F.col("c_acctbal").cast("string")).alias("values"))
    bad = F.struct(F.array(F.concat(F.lit("x"), F.col("c_custkey"))).alias("key"), F.array(F.lit("..")).alias("values"))
    docs = c.select(F.to_json(F.struct(F.array(bad, good).alias("data"))).alias("doc"))
    return cubes.pxjson_to_long(docs).select("code", "value")


@register("select country, series_key, strftime(obs_date, '%Y-%m-%d') as obs_date, value from series where month(obs_date) <> 7")
def series_load(spark, sf):
    """One document of parallel arrays per series; July is written as missing."""
    s = d.series(spark, sf)
    pair = F.struct(F.date_format("obs_date", "yyyy-MM-dd'T'00:00:00").alias("d"), F.when(F.month("obs_date") != 7, F.col("value")).alias("v"))
    lists = s.groupBy("country", "series_key").agg(F.sort_array(F.collect_list(pair)).alias("p"))  # one entry per month
    docs = lists.select("country", "series_key", F.col("p.d").alias("dates"), F.col("p.v").alias("values"))
    out = tables.series_to_long(docs, ["country", "series_key"])
    return out.withColumn("obs_date", F.col("obs_date").cast("string"))


@register(f"""select {code('n_nationkey')} as municipality_code, n_name as municipality, concat(year(o_orderdate), '') as year,
  lower(n_name) as municipality_clean, {rnd('avg(o_totalprice)', 4)} as price_sqm
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey where year(o_orderdate) in (select distinct year(o_orderdate) from orders order by 1 desc limit 5)
  group by all""")
def cube_slice(spark, sf):
    """One cube per nation (year by dwelling type and measure), read through a source table's slice."""
    n = d.table(spark, sf, "nation")
    rows = d.order_nation(spark, sf, "o_totalprice", "o_orderdate")
    yearly = rows.groupBy("nation", F.year("o_orderdate").cast("string").alias("y")).agg(F.avg("o_totalprice").alias("p"))
    per = yearly.groupBy("nation").agg(F.sort_array(F.collect_list(F.struct("y", "p"))).alias("r"))  # one entry per year
    per = per.join(n, per.nation == n.n_nationkey)
    years = F.col("r.y")
    one = lambda codes: F.struct(F.struct(codes.alias("index")).alias("category"))
    name = F.create_map(d.code("n_nationkey"), F.concat(F.col("n_name"), F.lit(" - Alias")))
    region = F.struct(F.struct(F.array(d.code("n_nationkey")).alias("index"), name.alias("label")).alias("category"))
    types = one(F.array(F.lit("02"), F.lit("99")))
    # the second dwelling type is not part of the slice
    value = F.concat(F.col("r.p"), F.transform("r", lambda x: F.lit(-1.0)))
    doc = F.to_json(F.struct(
        F.array(*map(F.lit, ("Region", "Boligtype", "ContentsCode", "Tid"))).alias("id"),
        F.struct(region.alias("Region"), types.alias("Boligtype"), one(F.array(F.lit("KvPris"))).alias("ContentsCode"), one(years).alias("Tid")).alias("dimension"),
        value.alias("value")))
    long = cubes.jsonstat_to_long(per.select(doc.alias("doc")), ["Region", "Boligtype", "ContentsCode", "Tid"])
    out = cubes.read_slice(land(long), cubes.SLICES_NO["price_sqm"])
    return fixed(out.withColumn("municipality", F.regexp_replace("municipality", " - Alias$", "")), 4)


# ---- addresses ---------------------------------------------------------------------------------


def _resolved(spark, sf, rows: DataFrame, country: str = "norway") -> DataFrame:
    dim = d.regions(spark, sf)
    aliases = resolve.gazetteer(dim, d.no_places(spark), country)
    out = resolve.resolve_addresses(rows, aliases, dim, country)
    return out.select("listing_id", "municipality_code", "municipality_name", "region_code", "region_name", "rent_zone", "match_stage")


_PLACED = f"{code('c_nationkey')} as municipality_code, n_name as municipality_name, {code('n_regionkey', 2)} as region_code, r_name as region_name, concat('g', n_nationkey) as rent_zone"
_FROM = "from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"


@register(f"select c_custkey as listing_id, {_PLACED}, 1 as match_stage {_FROM}")
def resolve_exact(spark, sf):
    """The right-most part is a town, after its postal code."""
    return _resolved(spark, sf, d.addresses(spark, sf).select("listing_id", "address"))


@register(f"select c_custkey as listing_id, {_PLACED}, 3 as match_stage {_FROM}")
def resolve_whole_word(spark, sf):
    """The town occurs inside a sentence; `nation_1` must not match within `nation_10`."""
    text = F.concat(F.lit("House no "), F.col("listing_id"), F.lit(" close to ("), F.col("n_name"), F.lit(") by the sea"))
    return _resolved(spark, sf, d.addresses(spark, sf).select("listing_id", text.alias("address")))


@register(f"select c_custkey as listing_id, {_PLACED}, case when n_nationkey % 2 = 0 then 2 else 1 end as match_stage {_FROM}")
def resolve_after_postal(spark, sf):
    """Second country: five-digit postal codes; the town is followed by more words for even nations."""
    postal = F.concat(F.lpad((F.col("listing_id") % 1000).cast("string"), 3, "1"), F.lit(" 35 "))
    tail = F.when(F.col("c_nationkey") % 2 == 0, F.lit(" norra delen")).otherwise(F.lit(""))
    text = F.concat(F.lit("Gatan 5, "), postal, F.col("n_name"), tail)
    return _resolved(spark, sf, d.addresses(spark, sf).select("listing_id", text.alias("address")), "sweden")


def _misspelt() -> F.Column:
    """The region's name without its third letter, followed by a mark on every fifth customer."""
    name = F.lower("r_name")
    shorter = F.concat(F.substring(name, 1, 2), F.substring(name, 4, 50))
    return F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("x"), shorter)).otherwise(shorter)


# Similarity is 2M / T; M adds up the longest common block and those to its left and right.
_FUZZY_SQL = f"""with recursive cust as (
    select c_custkey, concat(case when c_custkey % 5 = 0 then 'x' else '' end, substr(lower(r_name), 1, 2), substr(lower(r_name), 4)) as part {_FROM}),
  parts as (select distinct part from cust), names as (select distinct lower(r_name) as alias, {code('r_regionkey')} as code, r_name from region),
  pairs as (select part, alias from parts, names),
  blocks as (
    select part, alias, alias as a, part as b, 0 as size from pairs
    union all
    select part, alias, unnest([substr(a, 1, i - 1), substr(a, i + k)]) as a, unnest([substr(b, 1, j - 1), substr(b, j + k)]) as b, unnest([k, 0]) as size
    from (select part, alias, a, b, m.k as k, -m.o as i, instr(b, substr(a, -m.o, m.k)) as j
          from (select part, alias, a, b, list_max(list_filter(flatten(list_transform(range(1, len(a) + 1),
                    lambda i: list_transform(range(1, len(a) - i + 2), lambda k: case when contains(b, substr(a, i, k)) then struct_pack(k := k, o := -i) end))),
                    lambda s: s is not null)) as m
                from blocks where a <> '' and b <> '') where m is not null)
  ),
  scores as (select part, alias, 2.0 * sum(size) / (len(part) + len(alias)) as ratio from blocks group by part, alias),
  best as (select part, arg_max(alias, (ratio, alias)) as alias, max(ratio) as ratio from scores where ratio >= 0.7 group by part)
  select c_custkey as listing_id, coalesce(n.code, '0000') as municipality_code, coalesce(n.r_name, 'Ukjent') as municipality_name,
    case when b.alias is null then 0 else 4 end as match_stage
  from cust left join best b using (part) left join names n on n.alias = b.alias"""


def _fuzzy(spark, sf):
    r = d.table(spark, sf, "region")
    c, n = d.table(spark, sf, "customer"), d.table(spark, sf, "nation")
    rows = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    rows = rows.select(F.col("c_custkey").alias("listing_id"), F.concat(F.lit("9, "), _misspelt()).alias("address"))
    dim = r.select(d.code("r_regionkey").alias("code"), F.col("r_name").alias("name"), d.code("r_regionkey", 2).alias("region_code"),
                   F.col("r_name").alias("region_name"), F.lit("99").alias("rent_zone"))
    aliases = resolve.gazetteer(dim, d.no_places(spark), "norway")
    return resolve.resolve_addresses(rows, aliases, dim, "norway").select("listing_id", "municipality_code", "municipality_name", "match_stage")


@register()
def resolve_fuzzy(spark, sf):
    """Misspelt names, found by block similarity of 0.7 or more."""
    return _fuzzy(spark, sf)


ORACLE["resolve_fuzzy"] = _FUZZY_SQL



@register(f"""select c_custkey % 10 as listing_id, concat('Veien ', c_custkey, ', ', n_name) as address, {code('c_nationkey')} as municipality_code, 1 as match_stage {_FROM} where c_custkey % 3 <> 0
  union all select null, concat('Nær ', n_name, ' nr ', c_custkey), {code('c_nationkey')}, 3 {_FROM} where c_custkey % 3 = 0""")
def resolve_repeated_ids(spark, sf):
    """Ten ids for all rows, and none for a third of them: every row keeps its own result."""
    rows = d.addresses(spark, sf)
    key = F.col("listing_id")
    text = F.when(key % 3 != 0, F.concat(F.lit("Veien "), key, F.lit(", "), F.col("n_name"))).otherwise(F.concat(F.lit("Nær "), F.col("n_name"), F.lit(" nr "), key))
    rows = rows.select(F.when(key % 3 != 0, key % 10).alias("listing_id"), text.alias("address"))
    dim = d.regions(spark, sf)
    out = resolve.resolve_addresses(rows, resolve.gazetteer(dim, d.no_places(spark), "norway"), dim, "norway")
    return out.select("listing_id", "address", "municipality_code", "match_stage")


_PLACE_LIST = sorted(PLACES_NO.items())
_DISTRICT_LIST = sorted([(n, "0180") for n in DISTRICTS_STOCKHOLM] + [(n, "1480") for n in DISTRICTS_GOTHENBURG] + [(n, "1280") for n in DISTRICTS_MALMO])


def _inside(district: str) -> str:
    """Code of the longest place inside a district's name, as whole words; none gives 0000."""
    hits = [n for n in PLACES_SE if re.search(rf"(?<!\w){re.escape(n)}(?!\w)", district)]
    return PLACES_SE[min(hits, key=lambda n: (-len(n), n))] if hits else "0000"


def _listed(pairs) -> str:
    return "(select * from (values " + ", ".join(f"({i}, '{n}', '{c}')" for i, (n, c) in enumerate(pairs)) + ") as l(i, place, code))"


@register(f"""select c_custkey as listing_id, case when c_custkey % 2 = 0 or length(place) >= 3 then code else '0000' end as municipality_code,
    case when c_custkey % 2 = 0 then 1 when length(place) >= 3 then 3 else 0 end as match_stage
    from customer join {_listed(_PLACE_LIST)} l on c_custkey % {len(_PLACE_LIST)} = i
  union all select -c_custkey, case when c_custkey % 2 = 0 then l.code else x.code end, case when c_custkey % 2 = 0 then 1 when x.code = '0000' then 0 else 3 end
    from customer join {_listed(_DISTRICT_LIST)} l on c_custkey % {len(_DISTRICT_LIST)} = l.i join {_listed([(n, _inside(n)) for n, _ in _DISTRICT_LIST])} x on x.i = l.i""")
def resolve_places(spark, sf):
    """The fixed places of both countries: as a part of the address, and inside a sentence, where districts and names of two letters don't count."""
    c = d.table(spark, sf, "customer").select("c_custkey")
    key = F.col("c_custkey")

    def listing(pairs, country: str, sign: int, inside) -> DataFrame:
        place = F.element_at(F.array(*[F.lit(n) for n, _ in pairs]), (key % len(pairs)).cast("int") + 1)
        rows = c.select((key * sign).alias("listing_id"), F.when(key % 2 == 0, F.concat(F.lit("9, "), place)).otherwise(inside(place)).alias("address"))
        dim = d.regions(spark, sf)
        out = resolve.resolve_addresses(rows, resolve.gazetteer(dim, places(spark, country), country), dim, country)
        return out.select("listing_id", "municipality_code", "match_stage")

    # Letters that no name has keep the sentence from being similar to one.
    return listing(_PLACE_LIST, "norway", 1, lambda p: F.concat(F.lit("qqqqqqqqqqqqqqqqqqqqqqqq ("), p, F.lit(") 77 qqqqqqqqqqqqqqqqqqqqqqqqq"))).union(
        listing(_DISTRICT_LIST, "sweden", -1, lambda p: F.concat(F.lit("qqqqqqqqqqqqqqqqqqqqqqqqqqqqqqq 7777 qqqqqqqqqqqqqqqqqqqqqqqqqqqq "), p, F.lit(" qqqqqqqqqqqqqqqqqqqqqqqqqqqq"))))


# ---- pages -------------------------------------------------------------------------------------

_TEXT = r"""replace(replace(replace(replace(replace(trim(regexp_replace({x}, '<[^>]*>', '', 'g')), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&')"""


@register("select page_id, " + _TEXT.format(x=r"regexp_extract(html, '(?is)<h1(?:\s[^>]*)?>(.*?)</h1>', 1)") + " as title from pages")
def page_titles(spark, sf):
    return d.table(spark, sf, "pages").select("page_id", pages.page_title(pages.visible(F.col("html"))).alias("title"))


_ANY_LINK = pages.LinkRule(primary=r"^/([^/?#]+)", fallback=r"([^/]+)$", host="https://example.com")
_LINK_SQL = r"""(select page_id as page_no, unnest(h) as href, generate_subscripts(h, 1) - 1 as pos
  from (select page_id, regexp_extract_all(html, '(?is)<a\s(?:[^>]*?\s)?href\s*=\s*["'']([^"'']*)["'']', 1) as h from pages))"""
_LINK_ID = "regexp_extract(href, '^/([^/?#]+)', 1)"


@register(f"select page_no, pos, {_LINK_ID} as listing_id, concat('https://example.com', href) as url from {_LINK_SQL}")
def link_harvest(spark, sf):
    return pages.harvest_links(d.table(spark, sf, "pages"), _ANY_LINK, "page_id").withColumn("pos", F.col("pos").cast("long"))


@register(f"""select listing_id, page_no, pos from (select {_LINK_ID} as listing_id, page_no, pos,
  row_number() over (partition by {_LINK_ID} order by page_no, pos) as rn from {_LINK_SQL}) where rn = 1""")
def links_first_seen(spark, sf):
    links = pages.first_seen(pages.harvest_links(d.table(spark, sf, "pages"), _ANY_LINK, "page_id"))
    return links.select("listing_id", "page_no", F.col("pos").cast("long").alias("pos"))


@register(f"""select listing_id, page_no from (select *, row_number() over (order by page_no, pos, listing_id) as place from (
  select {_LINK_ID} as listing_id, page_no, pos, row_number() over (partition by {_LINK_ID} order by page_no, pos) as rn from {_LINK_SQL}) where rn = 1) where place <= 25""")
def links_capped(spark, sf):
    links = pages.first_seen(pages.harvest_links(d.table(spark, sf, "pages"), _ANY_LINK, "page_id"))
    return pages.cap_listings(links, 25).select("listing_id", "page_no")


def _site_search_pages(spark, sf) -> DataFrame:
    """Search pages written from the orders: ten listings a page, each linked twice."""
    o = d.table(spark, sf, "orders")
    key = F.col("o_orderkey")
    item = F.concat(
        F.lit('<li><a class="x" href="/realestate/homes/ad.html?from=s&amp;finnkode='), key, F.lit('&amp;pos=1">A</a> <a href="/help">?</a><a href="https://www.finn.no/realestate/homes/ad.html?finnkode='),
        key, F.lit('">B</a></li>'))
    page = (key / 10).cast("long")
    return o.groupBy(page.alias("page_no")).agg(
        F.concat_ws("", F.transform(F.sort_array(F.collect_list(F.struct(key, item.alias("h")))), lambda s: s["h"])).alias("html"))


@register("""select o_orderkey // 10 as page_no, cast(o_orderkey as varchar) as listing_id,
  concat('https://www.finn.no/realestate/homes/ad.html?finnkode=', o_orderkey) as url from orders""")
def link_harvest_site(spark, sf):
    links = pages.first_seen(pages.harvest_links(_site_search_pages(spark, sf), pages.LINKS_NO))
    return links.select("page_no", "listing_id", "url")


# detail pages written from orders and customers, then read back

_HEAD = '<html><body><h1> Home <b>no</b> '


def _spaced(col) -> F.Column:
    return F.regexp_replace(col.cast("long").cast("string"), r"(?<=\d)(?=(\d{3})+$)", "&nbsp;")


def detail_pages_no(spark, sf) -> DataFrame:
    """Every order as a page: price in a list (given twice, the last counts), size in a table, address as data or paragraph."""
    rows = d.spread(d.order_nation(spark, sf, "o_orderkey", "o_totalprice", "o_orderdate"))
    n = d.table(spark, sf, "nation")
    key = F.col("o_orderkey")
    dt = lambda label, value: F.concat(F.lit(f"<dt>{label}</dt>\n<dd class='v'><span>"), value, F.lit("</span></dd>"))
    structured = F.concat(
        F.lit('<script type="application/ld+json">[{"@type":"Residence","address":{"streetAddress":"Veien '), key,
        F.lit('","postalCode":"0182","addressLocality":"'), F.col("n_name"), F.lit('"}}]</script>'))
    paragraph = F.concat(F.lit("<p>Welcome</p><p>Veien "), key, F.lit(" 0182 "), F.col("n_name"), F.lit("</p>"))
    html = F.concat(
        F.lit(_HEAD), key, F.lit(" </h1>"), F.when(key % 2 == 0, structured).otherwise(paragraph), F.lit("<dl>"),
        dt("Prisantydning", F.lit("1 kr")), dt("Prisantydning:", F.concat(_spaced(F.floor("o_totalprice")), F.lit(" kr"))),
        dt("Fellesgjeld", F.concat(_spaced(key * 3), F.lit(" kr"))), dt("Bygge&aring;r", F.when(key % 3 == 0, F.lit("1700")).otherwise(F.year("o_orderdate").cast("string"))),
        dt("Boligtype", F.when(key % 7 == 0, F.lit("Garasje/Parkering")).otherwise(F.lit("Leilighet"))),
        dt("Soverom", (key % 4).cast("string")), F.lit("</dl><table><tr><th>Bruksareal</th><td>"), (key % 90 + 10).cast("string"),
        F.lit(" m&sup2;</td></tr><tr><td>Soverom</td><td>99</td></tr><tr><td>alone</td></tr></table></body></html>"))
    return rows.join(n, rows.nation == n.n_nationkey).select(
        key.cast("string").alias("listing_id"), F.concat(F.lit("https://example.com/"), key).alias("url"), html.alias("html"))


_DETAIL_NO = f"""select cast(o_orderkey as varchar) as listing_id, concat('Homeno', o_orderkey) as title, concat('Veien ', o_orderkey, ' 0182 ', n_name) as address,
  floor(o_totalprice)::DOUBLE as asking_price, (o_orderkey * 3)::DOUBLE as fellesgjeld, (o_orderkey % 90 + 10)::DOUBLE as sqm,
  floor(o_totalprice)::DOUBLE + o_orderkey * 3 as total_price_calc,
  {rnd('(floor(o_totalprice) + o_orderkey * 3) / (o_orderkey % 90 + 10)', 0)} as price_per_sqm,
  cast(nullif(o_orderkey % 4, 0) as int) as bedrooms, cast(case when o_orderkey % 3 <> 0 then year(o_orderdate) end as int) as year_built,
  case when o_orderkey % 7 = 0 then 'Garasje/Parkering' else 'Leilighet' end as property_type
  from order_nation join nation on nation = n_nationkey"""
_NO_COLUMNS = ("listing_id", "title", "address", "asking_price", "fellesgjeld", "sqm", "total_price_calc", "price_per_sqm", "bedrooms", "year_built", "property_type")


@register(_DETAIL_NO)
def extract_listing_pages(spark, sf):
    return pages.extract_listings(detail_pages_no(spark, sf), "norway").select(*_NO_COLUMNS)


@register(f"select listing_id, property_type from ({_DETAIL_NO}) where property_type <> 'Garasje/Parkering' and asking_price > 0")
def valid_listings(spark, sf):
    rows = pages.extract_listings(detail_pages_no(spark, sf), "norway")
    return pages.valid_listings(rows, "norway").select("listing_id", "property_type")


def detail_pages_se(spark, sf) -> DataFrame:
    """Every order as a page with an object cache; even orders give the price through a reference."""
    rows = d.spread(d.order_nation(spark, sf, "o_orderkey", "o_totalprice", "o_orderdate"))
    n = d.table(spark, sf, "nation")
    key = F.col("o_orderkey")
    k = key.cast("string")
    price = F.floor("o_totalprice").cast("string")
    by_ref = F.concat(F.lit('{"__ref":"Money:'), k, F.lit('"}'))
    inline = F.concat(F.lit('{"amount":'), price, F.lit("}"))
    listing = F.concat(
        F.lit('"ActivePropertyListing:'), k, F.lit('":{"livingArea":'), (key % 90 + 10).cast("string"), F.lit('.5,"numberOfRooms":3,"constructionYear":'),
        F.when(key % 3 == 0, F.lit("2050")).otherwise(F.year("o_orderdate").cast("string")), F.lit(',"askingPrice":'), F.when(key % 2 == 0, by_ref).otherwise(inline),
        F.lit(',"housingForm":{"__ref":"Form:1"}}'))
    cache = F.concat(F.lit("{"), listing, F.lit(',"Money:'), k, F.lit('":{"amount":'), price, F.lit('},"Form:1":{"name":"Villa"},"Other:9":{"amount":1}}'))
    html = F.concat(
        F.lit("<h1>Villa "), k, F.lit('</h1>\n<p>Gatan '), k, F.lit(", 114 35 "), F.col("n_name"),
        F.lit('</p><script id="__NEXT_DATA__" type="application/json">{"props":{"apolloState":'), cache,
        F.lit('}}</script><dl><dt>Pris</dt><dd>1 kr</dd><dt>Avgift:</dt><dd>'), _spaced(key + 1000), F.lit(" kr/m&aring;n</dd><dt>Avgift</dt><dd>5 kr</dd><dt>Biarea</dt><dd>12,5 m&sup2;</dd></dl>"))
    return rows.join(n, rows.nation == n.n_nationkey).select(k.alias("listing_id"), F.concat(F.lit("https://example.com/"), k).alias("url"), html.alias("html"))


@register(f"""select cast(o_orderkey as varchar) as listing_id, concat('Gatan ', o_orderkey, ', 114 35 ', n_name) as address, floor(o_totalprice)::DOUBLE as asking_price,
  o_orderkey % 90 + 10.5::DOUBLE as sqm, 3 as rooms, cast(case when o_orderkey % 3 <> 0 then year(o_orderdate) end as int) as year_built, 'Villa' as property_type,
  (o_orderkey + 1000)::DOUBLE as monthly_fee, (o_orderkey + 1000)::DOUBLE as common_costs_monthly, 12.5::DOUBLE as sqm_secondary,
  {rnd('floor(o_totalprice) / (o_orderkey % 90 + 10.5)', 0)} as price_per_sqm from order_nation join nation on nation = n_nationkey""")
def extract_cached_pages(spark, sf):
    return pages.extract_listings(detail_pages_se(spark, sf), "sweden").select(
        "listing_id", "address", "asking_price", "sqm", "rooms", "year_built", "property_type", "monthly_fee", "common_costs_monthly", "sqm_secondary", "price_per_sqm")


def _order_pages(spark, sf, *parts) -> DataFrame:
    """Every order as a page made of the parts; `key` stands for its number."""
    o = d.spread(d.table(spark, sf, "orders").select("o_orderkey"))
    key = F.col("o_orderkey").cast("string")
    return o.select(key.alias("listing_id"), F.concat(F.lit("https://example.com/"), key).alias("url"), F.concat(*[key if p is None else F.lit(p) if isinstance(p, str) else p for p in parts]).alias("html"))


@register("""select cast(o_orderkey as varchar) as listing_id, concat('Home ', o_orderkey, ' &lt; ', chr(65533), chr(65533), ' ', chr(10003), ' ''x'' &nosuch;') as title,
  (o_orderkey * 1000)::DOUBLE as asking_price, null::INT as bedrooms, 'Villa' as property_type from orders""")
def odd_pages(spark, sf):
    """Titles in scripts and comments, references out of range or made of others, numbers that are no counts."""
    pages_ = _order_pages(
        spark, sf, '<script>var t="<h1>wrong</h1><dl><dt>Boligtype</dt><dd>wrong</dd></dl>"</script><!-- <h1>no</h1> --><style>h1{}</style><h1>Home ', None,
        " &#38;lt; &#9999999;&#xD83D; &check; &apos;x&#x27; &nosuch;</h1><dl><dt>Soverom</dt><dd>99999999999</dd><dt>Prisantydning</dt><dd>", None,
        "000 kr</dd><dt>Boligtype</dt><dd>Villa</dd></dl><!-- <dl><dt>Prisantydning</dt><dd>1 kr</dd></dl> -->")
    return pages.extract_listings(pages_, "norway").select("listing_id", "title", "asking_price", "bedrooms", "property_type")


@register(f"""select cast(o_orderkey as varchar) as listing_id, case o_orderkey % 4
    when 0 then concat('Gatan ', o_orderkey, ' , 114 35 Solna') when 1 then concat('Gatan ', o_orderkey, ' 114 35 Solna')
    when 2 then concat('Gatan ', o_orderkey, ', 114 35 Solna') else concat('Gatan ', o_orderkey, ' , 114 35 Solna') end as address from orders""")
def address_selectors(spark, sf):
    """The element that holds the address: by test id, by class, after the title; with elements of its own name inside."""
    kind = F.col("o_orderkey") % 4
    opening = F.when(kind == 0, '<div data-testid="property-address"><div>Gatan ').when(kind == 1, '<section><span class="x property-address y"><span>Gatan ').when(
        kind == 2, "</h1>\n<p>Gatan ").otherwise('<DIV class="qa-property-address"><div><b>Gatan ')
    rest = F.when(kind == 0, "</div>, 114 35 Solna</div><div>not this</div>").when(kind == 1, "</span> <i>114 35</i> Solna</span></section><span>not this</span>").when(
        kind == 2, ", 114 35 Solna</p><p>not this</p>").otherwise("</b></div>, 114 35 Solna</DIV> not this")
    pages_ = _order_pages(spark, sf, F.when(kind == 2, "<h1>Home").otherwise("<h1>Home</h1>"), opening, None, rest)
    out = pages.extract_listings(pages_, "sweden").select("listing_id", F.regexp_replace("address", " 114 35 Solna$", " 114 35 Solna").alias("address"))
    return out.withColumn("address", F.regexp_replace("address", r"\s+", " "))


@register("""select cast(o_orderkey as varchar) as listing_id, concat('Named ', o_orderkey) as title, case when o_orderkey % 3 = 0 then null else o_orderkey * 100.0::DOUBLE end as asking_price,
  case when o_orderkey % 2 = 0 then concat('Veien ', o_orderkey, ' 0182 Oslo') else 'Storgata 1, Bergen' end as address from orders""")
def structured_fallbacks(spark, sf):
    """Pages without title and price: both come from structured data, of the block that is a listing."""
    key = F.col("o_orderkey")
    address = F.when(key % 2 == 0, F.concat(F.lit('{"streetAddress":"Veien '), key, F.lit('","postalCode":"0182","addressLocality":"Oslo"}'))).otherwise(F.lit('"Storgata 1, Bergen"'))
    price = F.when(key % 3 == 0, F.lit("0")).otherwise(F.concat(F.lit('"'), key * 100, F.lit('"')))
    block = F.concat(F.lit('{"@type":"Product","name":"Named '), key, F.lit('","address":'), address, F.lit(',"offers":{"price":'), price, F.lit("}}"))
    pages_ = _order_pages(
        spark, sf, '<!-- <script type="application/ld+json">{"@type":"Product","name":"hidden"}</script> --><script type="application/ld+json">{"@type":"Organization","name":"Other","offers":{"price":5}}</script>',
        '<script type="application/ld+json">not json</script><script type="application/ld+json">[', block, "]</script><dl></dl>")
    return pages.extract_listings(pages_, "norway").select("listing_id", "title", "asking_price", "address")


# ---- a whole run: pages to scores --------------------------------------------------------------

_PAGED = f"""select cast(o_orderkey as varchar) as listing_id, floor(o_totalprice)::DOUBLE + o_orderkey * 3 as total_price_calc,
  (o_orderkey % 90 + 10)::DOUBLE as sqm, {rnd('(floor(o_totalprice) + o_orderkey * 3) / (o_orderkey % 90 + 10)', 0)} as price_per_sqm,
  code as municipality_code, name as municipality_name, lower(name) as municipality_clean, region_code, region_name, rent_zone
  from order_nation join regions on {code('nation')} = code where o_orderkey % 7 <> 0 and floor(o_totalprice) > 0"""


@register(None)
def scored_pages(spark, sf):
    """Detail pages to ranked listings: extraction, resolution, features, rent, scores."""
    from regionscore.plans.region_features import norway_features
    from regionscore.plans.runs import scored_listings

    features, grid, index = norway_features(d.norway_tables(spark, sf))
    dim = d.regions(spark, sf)
    series = d.series(spark, sf).filter("country = 'O'").withColumn("country", F.lit("norway"))
    out = scored_listings(
        detail_pages_no(spark, sf), features, grid, index, series, resolve.gazetteer(dim, d.no_places(spark), "norway"), dim, d.dimensions(spark, sf))
    return out.select("listing_id", "municipality_name", "yield_score", "growth_score", "composite_score", "rank", "percentile", "recommendation", "risk_label")


ORACLE["scored_pages"] = full(
    "select listing_id, municipality_name, yield_score, growth_score, composite_score, rank, percentile, recommendation, risk_label from tiered",
    zoned=f"""select l.*, coalesce(d.zone, g.zone, '21.00') as zone, coalesce(sqm, 70.0) as size
      from ({_PAGED}) l left join zone_direct d using (municipality_code) left join zone_generic g on l.rent_zone = g.rent_zone""")


_PAGED_SE = f"""select cast(o_orderkey as varchar) as listing_id, floor(o_totalprice)::DOUBLE as total_price_calc, o_orderkey % 90 + 10.5::DOUBLE as sqm,
  {rnd('floor(o_totalprice) / (o_orderkey % 90 + 10.5)', 0)} as price_per_sqm,
  code as municipality_code, name as municipality_name, lower(name) as municipality_clean, region_code, region_name, rent_zone
  from order_nation join regions on {code('nation')} = code where floor(o_totalprice) > 0"""
_SE_FEATURES = "municipality_code, municipality_clean, price_growth_1y, price_growth_3y, latest_price_sqm, population, employment_hhi, latest_wage, wage_growth_1y, permits_per_1000, permit_momentum, debt_burden_pct"


@register(None)
def scored_pages_sweden(spark, sf):
    """The second country from cache pages to ranked listings: own zones, rents per square metre, counties as index regions."""
    from catalog.queries import se_tables
    from regionscore.operators.rent import sweden_rent_grid
    from regionscore.plans.listings import Dimensions
    from regionscore.plans.region_features import sweden_features
    from regionscore.plans.runs import scored_listings

    dim = land(d.regions(spark, sf))
    features, index = sweden_features(se_tables(spark, sf), dim)
    unit = F.try_divide(F.col("total_price_calc"), F.col("sqm")) / 200.0
    rents = d.listings(spark, sf).groupBy(F.col("municipality_code").alias("code")).agg(F.avg(unit).alias("rent_per_sqm"))
    grid = sweden_rent_grid(land(rents), dim.select("code", "rent_zone"))
    by_name, by_region = d.index_dims(spark, sf)
    dims = Dimensions(None, None, by_name.limit(0), by_region.withColumn("index_region_code", F.lit("00")), grid_zone="grid_zone")
    series = d.series(spark, sf).filter("country = 'O'").withColumn("country", F.lit("sweden"))
    out = scored_listings(detail_pages_se(spark, sf), features, grid, index, series, resolve.gazetteer(dim, d.no_places(spark), "sweden"), dim, dims, "sweden")
    return out.select("listing_id", "municipality_name", "yield_score", "growth_score", "composite_score", "rank", "percentile", "recommendation", "risk_label")


ORACLE["scored_pages_sweden"] = full(
    "select listing_id, municipality_name, yield_score, growth_score, composite_score, rank, percentile, recommendation, risk_label from tiered",
    zoned=f"select *, rent_zone as zone, sqm as size from ({_PAGED_SE})",
    rent_grid=f"""select rent_zone as zone, s::DOUBLE as sqm, {rnd('m * s', 0)} as monthly_rent from (select rent_zone, avg(x) as m
        from (select municipality_code as code, avg(total_price_calc / nullif(sqm, 0) / 200.0) as x from listings group by 1) join regions using (code) group by 1),
      (select unnest([30, 45, 60, 75, 90, 105]) as s)""",
    features=f"select {_SE_FEATURES} from ({se_features_sql(lambda x, digits: x)})",
    index_by_name="select lower(n_name) as key, '00' as idx from nation where false",
    index_by_region=f"select {code('r_regionkey', 2)} as key, '00' as idx from region where r_regionkey between 1 and 3",
    index_signals=f"""select substr(municipality_code, 1, 2) as region_code, avg(price_growth_1y) / 4.0 as index_momentum_qoq,
      coalesce(stddev_samp(price_growth_1y), 0.0) / 4.0 as volatility_qoq, null::DOUBLE as latest_index
      from ({se_features_sql(lambda x, digits: x)}) where price_growth_1y is not null group by 1""")


@register(r"""select page_id, text from (select page_id, text, row_number() over (partition by page_id order by i) as rn
  from (select page_id, i, list_aggregate(list_transform(list_filter(string_split_regex(regexp_extract(concat(part, '<p>'), '(?is)^(.*?)</?(?:p|div|ul|ol|dl|table|section|article|main|h[1-6])[\s>]', 1), '<[^>]*>'),
            lambda x: trim(x) <> ''), lambda x: trim(x)), 'string_agg', '') as text
        from (select page_id, unnest(list_slice(parts, 2, 100000)) as part, generate_subscripts(list_slice(parts, 2, 100000), 1) as i
              from (select page_id, string_split_regex(html, '(?i)<p(?:\s[^>]*)?>') as parts from pages)))
  where regexp_matches(text, '[0-9]{4}\s+\w') and len(text) < 200) where rn = 1""")
def page_postal_blocks(spark, sf):
    """First short paragraph with a postal code, over all pages."""
    block = pages.postal_block(pages.visible(F.col("html")), pages.BLOCK_P, pages.POSTAL_NO)
    return d.table(spark, sf, "pages").select("page_id", block.alias("text")).filter(F.col("text").isNotNull())


# ---- slices of every source table ----------------------------------------------------------------


def _slice_cube(spark, sf, spec: cubes.Slice) -> DataFrame:
    """One cube per customer, its key kept, with all kept codes of the slice, one code that is not kept for each dimension, and six periods.

    The value is the customer's balance times the place of the cell among the cells, so that a wrong cell shows.
    """
    named = [c.removesuffix("_code") for c in spec.columns if c.endswith("_code") and c != f"{spec.period}_code" and c.removesuffix("_code") not in spec.items]
    lists = {dim: [*codes, "zz"] for dim, codes in spec.items.items()}
    dims = [*named, *lists, spec.period]
    periods = [str(p) for p in range(2001, 2007)]
    sizes = [1] * len(named) + [len(x) for x in lists.values()] + [len(periods)]
    total = 1
    for n in sizes:
        total *= n
    one = lambda codes: F.struct(F.struct(codes.alias("index")).alias("category"))
    key = d.code("c_nationkey")
    label = F.struct(F.struct(F.array(key).alias("index"), F.create_map(key, F.concat(F.lit("Name "), key)).alias("label")).alias("category"))
    shape = F.struct(*[label.alias(n) for n in named], *[one(F.array(*map(F.lit, x))).alias(n) for n, x in lists.items()], one(F.array(*map(F.lit, periods))).alias(spec.period))
    values = F.transform(F.sequence(F.lit(1), F.lit(total)), lambda i: F.col("c_acctbal") * i)
    doc = F.to_json(F.struct(F.array(*map(F.lit, dims)).alias("id"), shape.alias("dimension"), values.alias("value")))
    customers = d.spread(d.table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal"))
    return cubes.jsonstat_to_long(customers.select("c_custkey", doc.alias("doc")), dims, keep=["c_custkey"])


def _slice_sql(table: str, spec: cubes.Slice) -> str:
    """The kept cells, worked out from their places."""
    lists = [len(x) + 1 for x in spec.items.values()]
    place, where, strides = [], [], 6
    names = list(spec.items)
    for n, size in zip(reversed(names), reversed(lists)):
        place.append(f"c{names.index(n)} * {strides}")
        strides *= size
    froms = "".join(f", (select unnest(range({size - 1})) as c{i})" for i, size in enumerate(lists))
    latest = min(spec.latest or 6, 6)
    columns = []
    for source, target in spec.columns.items():
        dim = source.removesuffix("_code")
        if dim == spec.period:
            columns.append(f"cast(2001 + t as varchar) as {target}")
        elif dim in spec.items:
            codes = "[" + ", ".join(f"'{c}'" for c in spec.items[dim]) + "]"
            columns.append(f"{codes}[c{names.index(dim)} + 1] as {target}")
        else:
            columns.append((f"{code('c_nationkey')}" if source.endswith("_code") else f"concat('Name ', {code('c_nationkey')})") + f" as {target}")
    if any(t == "municipality" for t in spec.columns.values()):
        columns.append(f"concat('name ', {code('c_nationkey')}) as municipality_clean")
    at = " + ".join([*place, "t", "1"])
    items = "concat_ws(' '" + "".join(f", {list(codes)}[c{i} + 1]" for i, codes in enumerate(spec.items.values())) + ")"
    return f"""select '{table}' as slice, c_custkey, items, {{columns}} from (select c_custkey, {items} as items, {', '.join(columns)}, c_acctbal * ({at}) as {spec.value}
      from customer{froms}, (select unnest(range({6 - latest}, 6)) as t))"""


_SLICE_COLUMNS = ("municipality_code", "municipality", "municipality_clean", "municipality_name", "region_code", "region", "zone_code", "zone", "size_code", "industry_code", "industry", "year", "quarter", "period")


def _slices_sql(slices) -> str:
    out = []
    for name, spec in slices.items():
        have = {*spec.columns.values()} | ({"municipality_clean"} if "municipality" in spec.columns.values() else set())
        columns = ", ".join([*[c if c in have else f"null::VARCHAR as {c}" for c in _SLICE_COLUMNS], f"{rnd(spec.value, 2)} as value"])
        out.append(_slice_sql(name, spec).replace("{columns}", columns))
    return " union all ".join(out)


def _slices(spark, sf, slices) -> DataFrame:
    """Every slice of its cube's stored table; the table goes when its slice is landed, so that the disk holds one cube at a time."""
    out = None
    for name, spec in slices.items():
        long, path = _slice_cube(spark, sf, spec), landing_path(spark)
        cubes.write_cube(long, path, spec.period)
        codes = [f"{dim}_code" for dim in spec.items]
        rows = cubes.stored_slice(spark, path, long.schema, spec, ["c_custkey", *[c for c in codes if c not in spec.columns]])
        items = F.concat_ws(" ", *[spec.columns.get(c, c) for c in codes])
        columns = [F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in _SLICE_COLUMNS]
        rows = land(rows.select(F.lit(name).alias("slice"), "c_custkey", items.alias("items"), *columns, rounded(F.col(spec.value), 2).alias("value")))
        drop(spark, path)
        out = rows if out is None else out.unionByName(rows)
    return out


@register(_slices_sql(cubes.SLICES_NO))
def cube_slices_no(spark, sf):
    """All slices of the first country's source tables, each from a cube that also holds what the slice leaves out."""
    return _slices(spark, sf, cubes.SLICES_NO)


@register(_slices_sql(cubes.SLICES_SE))
def cube_slices_se(spark, sf):
    """All slices of the second country's source tables."""
    return _slices(spark, sf, cubes.SLICES_SE)


@register(f"""select c_custkey as key, {code('c_nationkey')} as code, null::VARCHAR as other, c_nationkey::DOUBLE as value from customer
  union all select -1 - n_nationkey, {code('n_nationkey')}, null, n_nationkey::DOUBLE from nation""")
def cube_without_a_dimension(spark, sf):
    """A dimension that no document has is NULL in every cell; a document for each nation and each customer's."""
    n = d.table(spark, sf, "customer").select(F.col("c_custkey").cast("bigint").alias("key"), F.col("c_nationkey").alias("n_nationkey")).union(
        d.table(spark, sf, "nation").select((-1 - F.col("n_nationkey")).cast("bigint"), "n_nationkey"))
    one = F.struct(F.struct(F.array(d.code("n_nationkey")).alias("index")).alias("category"))
    doc = F.to_json(F.struct(F.array(F.lit("Region")).alias("id"), F.struct(one.alias("Region")).alias("dimension"), F.array(F.col("n_nationkey").cast("double")).alias("value")))
    long = cubes.jsonstat_to_long(n.select("key", doc.alias("doc")), ["Region", "Other"], keep=["key"])
    return long.select("key", F.col("Region_code").alias("code"), F.col("Other").alias("other"), "value")


@register("select country, listing_id, municipality_name, composite_score, rank, gross_yield_pct, bedrooms, rooms, fellesgjeld, monthly_fee from (select 'NO' as country, *, listing_id % 5 as bedrooms, null::BIGINT as rooms, listing_id * 2.0::DOUBLE as fellesgjeld, null::DOUBLE as monthly_fee from tiered union all select 'SE', *, null, listing_id % 5, null, listing_id * 2.0::DOUBLE from tiered)")
def export_listings(spark, sf):
    """Ranked listings exported with the column lists of both countries and read back."""
    from catalog.queries import ranked

    extra = (F.col("listing_id") % 5, F.col("listing_id") * 2.0)
    rows = land(ranked(spark, sf).withColumns({"bedrooms": extra[0], "rooms": extra[0], "fellesgjeld": extra[1], "monthly_fee": extra[1], "not_listed": F.lit(1)}))
    out = None
    for country, columns in (("NO", tables.EXPORT_NO), ("SE", tables.EXPORT_SE)):
        path = landing_path(spark)
        tables.export_csv(rows, path, columns)
        there = [c for c in columns if c in rows.columns]
        schema = ", ".join(f"`{c}` {dict(rows.dtypes)[c]}" for c in there)
        back = spark.read.schema(schema).csv(path, header=True, enforceSchema=False)
        assert "not_listed" not in back.columns
        part = back.withColumn("country", F.lit(country))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out.select("country", "listing_id", "municipality_name", "composite_score", "rank", "gross_yield_pct", "bedrooms", "rooms", "fellesgjeld", "monthly_fee")

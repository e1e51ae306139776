import json
from html.entities import html5

from pyspark.sql import functions as F

from regionscore import schemas
from regionscore.sources import pages


def extract(spark, country, *htmls):
    df = spark.createDataFrame([(str(i), f"u{i}", h) for i, h in enumerate(htmls, 1)], schemas.PAGE)
    return [r.asDict() for r in pages.extract_listings(df, country).orderBy("listing_id").collect()]


def test_output_has_the_declared_columns(spark):
    df = spark.createDataFrame([("1", "u", "")], schemas.PAGE)
    for country, schema in (("norway", schemas.LISTING_NO), ("sweden", schemas.LISTING_SE)):
        out = pages.extract_listings(df, country)
        assert {f.name: f.dataType for f in out.schema} == {f.name: f.dataType for f in schema}
        assert all(v is None for k, v in out.first().asDict().items() if k not in ("listing_id", "url"))


def test_every_named_character_from_a_small_map(spark):
    names = {n: c for n, c in html5.items() if n.endswith(";")}
    df = spark.createDataFrame([(n, f"x&{n}y") for n in names], "name string, text string")
    found = {r["name"]: r["t"] for r in df.select("name", pages.decode_entities(F.col("text")).alias("t")).collect()}
    assert found == {n: f"x{c}y" for n, c in names.items()}
    maps = json.loads(pages.NAMED_CHARACTERS)
    assert isinstance(maps, list) and max(map(len, maps)) <= 16


def test_lists_and_tables_at_their_edges(spark):
    row, = extract(spark, "norway", "<dl><DT>Soverom<dd></dd><dt>Etasje</DT><DD>2.<!-- <b> --> etg<DT>Eieform<dt>Boligtype<dd>A<B>&amp;</b> b</DL><dd>no</dd>"
                   "<table><tr><td>Energimerking:<td>A &lt; B<tr><th>Tomteareal</th></TR></table>")
    assert (row["bedrooms"], row["floor"], row["ownership_type"], row["property_type"], row["energy_rating"]) == (None, "2. etg", "A&b", "A&b", "A < B")


def test_title_and_entities(spark):
    row, = extract(spark, "norway", "<H1 class='a'>\n Fin <b>leilighet &amp;lt; b&#248;d</b>&nbsp;p&#xe5; Gr&uuml;ner &nosuch; </h1><h1>second</h1>")
    assert row["title"] == "Finleilighet &lt; bødpå Grüner &nosuch;"


LD = '<script type="application/ld+json">{}</script>'


def test_structured_address_first_block_with_one(spark):
    empty, full = {"@type": "WebPage"}, [5, {"address": {"streetAddress": "Storgata 1", "postalCode": None, "addressLocality": "Oslo"}}]
    row, text = extract(
        spark, "norway",
        LD.format("{broken") + LD.format(json.dumps(empty)) + LD.format(json.dumps(full)) + "<p data-testid='object-address'>Other</p>",
        LD.format(json.dumps({"address": "Bergen, Norge"})))
    assert row["address"] == "Storgata 1 Oslo" and text["address"] == "Bergen, Norge"


def test_address_selectors_in_order(spark):
    a, b, c, d = extract(
        spark, "norway",
        "<p class='u-t3 x'>Second</p><span id=i data-testid=\"object-address\"> Storgata <b>1</b>,\n0182 Oslo </span>",
        "<p class='big u-t3'>Gate 2</p><p>Vei 9 0182 Oslo</p>",
        "<p>Hei</p><p>" + "x" * 250 + " 0182 Oslo</p><p>Vei <i>3</i>, 0182 Oslo<p>4 0183 Oslo</p>",
        "<p class='u-t33'>no</p>")
    assert [r["address"] for r in (a, b, c, d)] == ["Storgata 1 ,\n0182 Oslo", "Gate 2", "Vei3, 0182 Oslo", None]


def test_swedish_address(spark):
    a, b, c = extract(
        spark, "sweden", "<h1>T</h1>\n<p>Storgatan 1, Solna</p>", "<div class='property-address'>Gatan 2</div><h1>x</h1><p>y</p>",
        "<div><span>Torget 4, 114 35 Stockholm</span></div>")
    assert [r["address"] for r in (a, b, c)] == ["Storgatan 1, Solna", "Gatan 2", "Torget 4, 114 35 Stockholm"]


DL = "<dl>{}</dl>"


def pair(label, value):
    return f"<dt class=l>{label}</dt><dd><b>{value}</b></dd>"


def test_later_label_wins_in_norway_first_in_sweden(spark):
    no, = extract(spark, "norway", DL.format(pair("Prisantydning", "1 kr") + pair("PRISANTYDNING:", "2 kr")))
    se, = extract(spark, "sweden", DL.format(pair("Pris", "1 kr") + pair("Utgångspris", "2 kr")))
    assert (no["asking_price"], se["asking_price"]) == (2.0, 1.0)


def test_fields_and_derived_values_norway(spark):
    html = DL.format(
        pair("Prisantydning", "3 000 000 kr") + pair("Fellesgjeld", "500&nbsp;000 kr") + pair("Primærrom", "0") + pair("Bruksareal", "50 m²")
        + pair("Byggeår", "1799") + pair("Soverom", "2") + pair("Eieform", "Andel") + pair("Boligtype", "Leilighet") + pair("Felleskost/mnd.", "4 100 kr"))
    row, = extract(spark, "norway", html)
    assert row["total_price_calc"] == 3500000.0 and row["sqm"] == 50.0 and row["price_per_sqm"] == 70000.0
    assert row["year_built"] is None and row["bedrooms"] == 2 and row["ownership_type"] == "Andel" and row["common_costs_monthly"] == 4100.0


def test_table_fills_only_missing_fields(spark):
    html = DL.format(pair("Soverom", "ukjent")) + "<table><tr><th>Soverom</th><td>9</td></tr><tr><td>Totalpris</td><td>1 200 kr</td><td>x</td></tr>" \
        "<tr><td>Byggeår</td><td>1700</td></tr><tr><td>Totalpris</td><td>5</td></tr></table>"
    row, = extract(spark, "norway", html)
    assert row["bedrooms"] is None  # the list had the label, unreadable as it was
    assert row["total_price"] == 1200.0 and row["asking_price"] == 1200.0 and row["year_built"] == 1700


def test_structured_price_and_title(spark):
    ld = LD.format(json.dumps({"@type": "Product", "name": "Hus", "offers": {"price": "990000"}}))
    other = LD.format(json.dumps({"@type": "Organization", "name": "Firma", "offers": {"price": "5"}}))
    row, = extract(spark, "norway", other + ld)
    assert (row["title"], row["asking_price"], row["total_price_calc"]) == ("Hus", 990000.0, 990000.0)


def test_value_shared_by_two_labels(spark):
    row, = extract(spark, "norway", "<dl><dt>Totalpris</dt><dt>Prisantydning</dt><dd>70 kr</dd></dl><dl><dt>Soverom</dt></dl><dl><dt>x</dt><dd>4</dd></dl>")
    assert (row["total_price"], row["asking_price"], row["bedrooms"]) == (70.0, 70.0, None)


def cache(objects, extra=""):
    state = {"props": {"apolloState": objects}}
    return f'<script id="__NEXT_DATA__" type="application/json">{json.dumps(state)}</script>{extra}'


def test_object_cache(spark):
    own = {"livingArea": 55.5, "numberOfRooms": 2, "fee": {"amount": 3000}, "askingPrice": {"__ref": "Money:{\"a\":1}"}, "constructionYear": 1800,
           "runningCosts": None, "housingForm": {"__ref": "F:1"}, "tenure": {"name": "Bostadsrätt"}}
    objects = {"ActivePropertyListing:1": own, "Money:{\"a\":1}": {"amount": 2500000}, "F:1": {"name": "Lägenhet"}}
    row, other = extract(spark, "sweden", cache(objects, DL.format(pair("Boarea", "99 m²") + pair("Byggår", "1700") + pair("Driftkostnad", "6 000 kr/år"))),
                         cache(objects, DL.format(pair("Boyta", "40,5 m²"))))
    assert (row["sqm"], row["rooms"], row["monthly_fee"], row["asking_price"]) == (55.5, 2, 3000.0, 2500000.0)
    assert (row["year_built"], row["operating_cost"], row["property_type"], row["ownership_type"]) == (1700, 6000.0, "Lägenhet", "Bostadsrätt")
    assert row["common_costs_monthly"] == 3000.0 and row["price_per_sqm"] == 45045.0
    assert (other["sqm"], other["asking_price"]) == (40.5, None)  # the cache holds another listing


def test_valid_listings(spark, rows):
    data = [("a", 1.0, "Leilighet"), ("b", 0.0, "Leilighet"), ("c", None, None), ("d", 5.0, None), ("e", 5.0, "GARASJE"), ("f", 5.0, "Fritidshus")]
    df = spark.createDataFrame(data, "listing_id string, asking_price double, property_type string")
    assert rows(pages.valid_listings(df, "norway"), "listing_id") == [("a",), ("d",), ("f",)]
    assert rows(pages.valid_listings(df, "sweden"), "listing_id") == [("a",), ("d",), ("e",)]


def test_links(spark, rows):
    first = ('<a href="/realestate/homes/ad.html?finnkode=12&x=1">a</a><A class=b HREF=\'https://www.finn.no/realestate/homes/ad.html?y=2&amp;finnkode=34#top\'>b</A>'
             '<a href="/realestate/other?finnkode=99">c</a>')
    second = '<a href="/realestate/other?finnkode=12">again</a><a href="/realestate/lettings?finnkode=56&z=1">d</a>'
    df = spark.createDataFrame([(1, "u", first), (2, "u", second), (3, "u", "none")], schemas.SEARCH_PAGE)
    links = pages.harvest_links(df, pages.LINKS_NO)
    host = "https://www.finn.no"
    assert rows(links, "page_no", "listing_id", "url") == [
        (1, "12", f"{host}/realestate/homes/ad.html?finnkode=12"), (1, "34", f"{host}/realestate/homes/ad.html?finnkode=34"),
        (2, "12", f"{host}/realestate/other?finnkode=12"), (2, "56", f"{host}/realestate/lettings?finnkode=56&z=1")]
    seen = pages.first_seen(links)
    assert rows(seen, "listing_id", "page_no") == [("12", 1), ("34", 1), ("56", 2)]
    assert rows(pages.cap_listings(seen, 2), "listing_id") == [("12",), ("34",)]
    assert pages.cap_listings(seen, None).count() == 3


def test_links_sweden(spark, rows):
    html = '<a href="/bostad/lagenhet-2rum-solna-123?from=x#y">a</a><a href="/bostad/villa-123/">b</a><a href="/salda/bostad-9">c</a>'
    df = spark.createDataFrame([(1, "u", html)], schemas.SEARCH_PAGE)
    assert rows(pages.first_seen(pages.harvest_links(df, pages.LINKS_SE)), "listing_id", "url") == [
        ("123", "https://www.hemnet.se/bostad/lagenhet-2rum-solna-123")]


def test_a_page_is_split_once_however_many_labels_share_a_value(spark):
    """A label without a value of its own takes the next one's; the page is not taken apart again for it."""
    html = "<dl>" + "".join(f"<dt>a{i}</dt>" + (f"<dd>{i}</dd>" if i % 2 else "") for i in range(6)) + "<dt>last</dt></dl>"
    df = spark.createDataFrame([(html,), ("no list",), (None,)], "html string").select(pages.definition_pairs(F.col("html")).alias("p"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("split(html") == 1
    assert [r.p and [tuple(x) for x in r.p] for r in df.collect()] == [[(f"a{i}", str(i | 1)) for i in range(6)], [], None]

"""Raw pages to listing links and typed listing rows, with built-in text functions only.

Everything happens within the row of a page, so extraction is a projection without a shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from html.entities import html5
from zlib import crc32

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regionscore.functions.clean import number_no, number_se, strip
from regionscore.functions.ratios import rounded, truthy
from regionscore.landing import computed_once

#: Names of characters are looked up in as many small maps, since a map is searched entry by entry.
NAME_MAPS = 1024


def _named_characters() -> str:
    """Names of characters, as the HTML standard lists them with a semicolon: maps by the names' checksum."""
    maps = [{} for _ in range(NAME_MAPS)]
    for name, character in html5.items():
        if name.endswith(";"):
            maps[crc32(name[:-1].encode()) % NAME_MAPS][name[:-1]] = character
    return json.dumps(maps)


NAMED_CHARACTERS = _named_characters()
REFERENCE = r"&(?:#\d+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);"
# What no text pattern may see: comments, scripts and style sheets.
HIDDEN = r"(?is)<(?:!--.*?(?:-->|\z)|(script|style)\b[^>]*>.*?(?:</\1\s*>|\z))"


#: More than an array's length: the length of a slice that goes on to the end, for which the array needn't be made twice.
ALL = 1 << 30


def bound(value: Column, use) -> Column:
    """`use(value)` with the value worked out once, though `use` may refer to it many times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def decode_entities(text: Column) -> Column:
    """Character references to characters, in one pass: what a reference stands for is not read again.

    Numbers that are no character (surrogates, zero, beyond the last code point) give U+FFFD; unknown names stay.
    """
    names = F.from_json(F.lit(NAMED_CHARACTERS), "array<map<string,string>>")

    def number(ref: Column) -> Column:
        hexadecimal = F.lower(F.substring(ref, 3, 1)) == "x"
        digits = F.regexp_replace(F.regexp_replace(ref, "^&#[xX]?0*|;$", ""), "^$", "0")
        point = F.when(hexadecimal, F.conv(F.when(F.length(digits) <= 6, digits), 16, 10)).otherwise(
            F.when(F.length(digits) <= 7, digits)).try_cast("int")
        good = point.between(1, 0xD7FF) | point.between(0xE000, 0x10FFFF)
        code = F.lpad(F.hex(F.when(good, point).otherwise(F.lit(0xFFFD)).cast("long")), 8, "0")
        return F.decode(F.unhex(code), "UTF-32")

    def piece(p: Column) -> Column:
        name = F.substr(p, F.lit(2), F.length(p) - 2)
        near = F.get(names, F.pmod(F.crc32(name.cast("binary")), F.lit(NAME_MAPS)).cast("int"))
        named = F.coalesce(F.try_element_at(near, name), p)
        return F.when(~F.startswith(p, F.lit("&")) | (F.length(p) < 3), p).when(F.startswith(p, F.lit("&#")), number(p)).otherwise(named)

    pieces = F.regexp_extract_all(text, F.lit(rf"(?s){REFERENCE}|[^&]+|&"), F.lit(0))
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(pieces, piece), "")).otherwise(text)


def visible(html: Column) -> Column:
    """The page without comments, scripts and style sheets."""
    return F.regexp_replace(html, HIDDEN, "")


def tag_text(inner: Column, joiner: str = "") -> Column:
    """Text of a fragment: its text nodes, each stripped, joined by `joiner`."""
    return bound(inner, lambda t: node_text(t, joiner))


def node_text(t: Column, joiner: str = "") -> Column:
    """`tag_text` of a value that is at hand: `t` is referred to many times."""
    pieces = F.transform(F.split(t, r"(?s)<!--.*?-->|<[^>]*>"), lambda p: strip(decode_entities(p)))
    joined = F.array_join(F.filter(pieces, lambda p: F.length(p) > 0), joiner)
    plain = ~F.contains(t, F.lit("<")) & ~F.contains(t, F.lit("&"))
    return F.when(plain, strip(t)).otherwise(joined)


def first_match(text: Column, pattern: str, group: int) -> Column:
    """The group of the first match, NULL without one."""
    return bound(F.regexp_extract(text, pattern, group), lambda found: F.when((F.length(found) > 0) | text.rlike(pattern), found))


def page_title(body: Column) -> Column:
    """Text of the first h1; `body` is a page without scripts (`visible`)."""
    return tag_text(first_match(body, r"(?is)<h1(?:\s[^>]*)?>(.*?)</h1>", 1))


# ---- links -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class LinkRule:
    """How a search page names its listings: link patterns with the id as group 1."""

    primary: str
    fallback: str
    host: str
    id_query: str | None = None  # keep the id as this query parameter of the canonical address
    fallback_keeps_query: bool = False


# Link patterns of the two listing sites.
LINKS_NO = LinkRule(
    primary=r"/realestate/homes/ad\.html.*?finnkode=(\d+)",
    fallback=r"^(?=.*realestate).*finnkode=(\d+)",
    host="https://www.finn.no",
    id_query="finnkode",
    fallback_keeps_query=True,
)
LINKS_SE = LinkRule(
    primary=r"/bostad/[^/]+-(\d+)(?:[/?#]|$)",
    fallback=r"/bostad/[^/]+-(\d+)",
    host="https://www.hemnet.se",
)
HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*["']([^"']*)["']"""


def _canonical(href: Column, listing_id: Column, rule: LinkRule, keep_query: bool) -> Column:
    full = F.when(F.startswith(href, F.lit("http")), href).otherwise(F.concat(F.lit(rule.host), href))
    if keep_query:
        return full
    bare = F.substring_index(F.substring_index(full, "?", 1), "#", 1)
    return F.concat(bare, F.lit(f"?{rule.id_query}="), listing_id) if rule.id_query else bare


def harvest_links(pages: DataFrame, rule: LinkRule, page_no: str = "page_no") -> DataFrame:
    """Listing links of every page, in page order: (page_no, pos, listing_id, url).

    The fallback pattern counts only on pages where the first one finds nothing.
    """
    hrefs = F.transform(F.regexp_extract_all("html", F.lit(HREF), F.lit(1)), decode_entities)

    def links(pattern: str, keep_query: bool) -> Column:
        hits = F.filter(hrefs, lambda h: h.rlike(pattern))
        def link(h: Column) -> Column:
            listing_id = F.regexp_extract(h, pattern, 1)
            return F.struct(listing_id.alias("listing_id"), _canonical(h, listing_id, rule, keep_query).alias("url"))
        return F.transform(hits, link)

    both = pages.select(
        F.col(page_no).alias("page_no"),
        links(rule.primary, False).alias("first"),
        links(rule.fallback, rule.fallback_keeps_query).alias("second"),
    )
    chosen = F.when(F.size("first") > 0, F.col("first")).otherwise(F.col("second"))
    return both.select("page_no", F.posexplode(chosen).alias("pos", "l")).select("page_no", "pos", "l.listing_id", "l.url")


def first_seen(links: DataFrame) -> DataFrame:
    """One row per listing, where it was seen first. A partial aggregate: hot ids cost nothing extra."""
    seen = links.groupBy("listing_id").agg(F.min(F.struct("page_no", "pos", "url")).alias("s"))
    return seen.select("listing_id", "s.page_no", "s.pos", "s.url")


def cap_listings(links: DataFrame, max_listings: int | None) -> DataFrame:
    """The first `max_listings` in the order they were found; None keeps all."""
    return links if max_listings is None else links.orderBy("page_no", "pos", "listing_id").limit(max_listings)


# ---- label / value pairs ---------------------------------------------------------------------

# Page labels and the fields they fill.
LABELS_NO = {
    "prisantydning": "asking_price",
    "totalpris": "total_price",
    "fellesgjeld": "fellesgjeld",
    "felleskostnader/mnd.": "common_costs_monthly",
    "felleskost/mnd.": "common_costs_monthly",
    "felleskostnader": "common_costs_monthly",
    "eieform": "ownership_type",
    "boligtype": "property_type",
    "soverom": "bedrooms",
    "primærrom": "sqm_primary",
    "bruksareal": "sqm_usable",
    "bruttoareal": "sqm_gross",
    "byggeår": "year_built",
    "etasje": "floor",
    "tomteareal": "plot_size",
    "energimerking": "energy_rating",
}
LABELS_SE = {
    "utgångspris": "asking_price",
    "pris": "asking_price",
    "boarea": "sqm",
    "boyta": "sqm",
    "biarea": "sqm_secondary",
    "antal rum": "rooms",
    "rum": "rooms",
    "byggnadsår": "year_built",
    "byggår": "year_built",
    "avgift": "monthly_fee",
    "månadsavgift": "monthly_fee",
    "driftkostnad": "operating_cost",
    "tomtarea": "plot_area",
    "tomtstorlek": "plot_area",
    "bostadstyp": "property_type",
    "upplåtelseform": "ownership_type",
    "energiklass": "energy_rating",
    "våningsplan": "floor",
    "etage": "floor",
}
# Property types that are no homes.
NON_RESIDENTIAL_NO = (
    "garasje/parkering", "garasje", "parkering", "parkeringsplass", "næringseiendom", "tomt", "fritidstomt",
)
NON_RESIDENTIAL_SE = ("tomt", "fritidshus", "fritidstomt", "garage", "parkering")
LISTING_TYPES = ("Product", "RealEstateListing", "Residence")

MONEY_AND_AREA_NO = (
    "asking_price", "total_price", "fellesgjeld", "common_costs_monthly",
    "sqm_primary", "sqm_usable", "sqm_gross", "plot_size",
)
COUNTS_NO = ("bedrooms", "year_built")
TEXTS_NO = ("ownership_type", "property_type", "floor", "energy_rating")
MONEY_AND_AREA_SE = ("asking_price", "sqm", "sqm_secondary", "monthly_fee", "operating_cost", "plot_area")
COUNTS_SE = ("rooms", "year_built")
TEXTS_SE = ("ownership_type", "property_type", "floor", "energy_rating")


def _texts(found: Column) -> Column:
    """(label, value) texts of fragments (name, value)."""
    return F.transform(found, lambda f: F.struct(
        F.rtrim(F.lower(node_text(f["name"])), F.lit(":")).alias("label"), node_text(f["value"]).alias("value")))


def definition_pairs(html: Column) -> Column:
    """(label, value) of every `<dt>`, in page order; the value is the next `<dd>` of the list."""
    after = F.split(html, r"(?i)<dt(?:\s[^>]*)?>")
    dd = r"(?is)<dd(?:\s[^>]*)?>(.*?)(?=<(?:/dd>|d[dt][\s>]|/dl>)|\z)"

    def before(text: Column, pattern: str) -> Column:
        return F.regexp_extract(text, rf"(?is)\A(.*?)(?:{pattern}|\z)", 1)  # a split would compile its pattern for every text

    def found(sections: Column) -> Column:
        def pair(section: Column, i: Column) -> Column:
            ends = section.rlike(r"(?i)</dl>")
            own = first_match(F.when(ends, before(section, "</dl>")).otherwise(section), dd, 1)
            shared = F.when(~ends, first_match(F.get(sections, i + 1), dd, 1))
            name = before(section, r"<(?:/dt>|dd[\s>])")
            return F.struct(name.alias("name"), F.coalesce(own, shared).alias("value"))

        return F.filter(F.transform(sections, pair), lambda p: p["value"].isNotNull())

    return _texts(bound(F.slice(after, 2, ALL), found))


def table_pairs(html: Column) -> Column:
    """(label, value) from the first two cells of every table row that has two."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr(?:\s[^>]*)?>(.*?)(?=<(?:/tr>|tr[\s>]|/table>)|\z)"), F.lit(1))

    def cells(row: Column) -> Column:
        return F.regexp_extract_all(row, F.lit(r"(?is)<t[hd](?:\s[^>]*)?>(.*?)(?=<(?:/t[hd]>|t[hd][\s>])|\z)"), F.lit(1))

    full = F.filter(F.transform(rows, cells), lambda c: F.size(c) >= 2)
    return _texts(F.transform(full, lambda c: F.struct(F.get(c, F.lit(0)).alias("name"), F.get(c, F.lit(1)).alias("value"))))


def known_pairs(pairs: Column, labels: Mapping[str, str]) -> Column:
    """The pairs whose label fills a field."""
    return F.filter(pairs, lambda p: p["label"].isin(*labels))


def field_text(pairs: Column, labels: Mapping[str, str], name: str, last: bool) -> Column:
    """Value of the first or last pair whose label fills the field."""
    names = [label for label, target in labels.items() if target == name]
    hits = F.filter(pairs, lambda p: p["label"].isin(*names))
    return F.try_element_at(hits, F.lit(-1 if last else 1))["value"]


def plausible_year(number: Column) -> Column:
    return F.when((number > 1800) & (number < 2030), number)


# ---- structured data -------------------------------------------------------------------------


# What of a structured block is used; an object or list where a text is wanted comes as JSON text.
BLOCK = "`@type` string, name string, address string, offers struct<price:string>"
ADDRESS = "streetAddress string, postalCode string, addressLocality string"


def ld_blocks(html: Column) -> Column:
    """Structured-data scripts, each parsed once; of a list, its first object. Those inside comments or other scripts don't count."""
    kind = r"""[^>]*type\s*=\s*["']application/ld\+json["'][^>]*>"""
    pattern = rf"(?is)<(?:!--.*?-->|script(?!{kind})\b[^>]*>.*?</script\s*>|script{kind}(.*?)</script\s*>)"
    scripts = F.filter(F.transform(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)), lambda s: strip(s)), lambda s: F.length(s) > 0)

    def as_object(text: Column) -> Column:
        items = F.from_json(text, "array<string>")
        first = F.get(F.filter(items, lambda x: F.startswith(F.ltrim(x), F.lit("{"))), F.lit(0))
        return F.when(F.startswith(text, F.lit("[")), first).otherwise(text)

    blocks = F.transform(scripts, lambda s: F.from_json(as_object(s), BLOCK))
    return F.filter(F.when(F.contains(F.lower(html), F.lit("ld+json")), blocks), lambda b: b.isNotNull())


def _non_empty(col: Column) -> Column:
    return F.when(F.length(col) > 0, col)


def block_address(block: Column) -> Column:
    """Street, postal code and locality joined by spaces, or the address text as it is."""
    address = block["address"]
    from_object = bound(F.from_json(address, ADDRESS), lambda parts: F.concat_ws(
        " ", *[_non_empty(parts[k]) for k in ("streetAddress", "postalCode", "addressLocality")]))
    return bound(F.when(F.startswith(address, F.lit("{")), from_object).otherwise(address), _non_empty)


def _first_of(blocks: Column, pick) -> Column:
    return F.get(F.array_compact(F.transform(blocks, pick)), F.lit(0))


def _listing_block(pick):
    return lambda b: F.when(b["@type"].isin(*LISTING_TYPES), pick(b))


def element(html: Column, opening: str) -> Column:
    """Inner HTML of the first element whose opening tag the pattern finds, up to the closing tag that balances it.

    Without one, the rest of the page belongs to the element, as in a browser.
    """
    tag = F.regexp_substr(html, F.lit(opening))
    name = F.regexp_extract(tag, r"<(\w+)", 1)
    after = F.substr(html, F.regexp_instr(html, F.lit(opening)) + F.length(tag))
    pieces = F.split(after, F.concat(F.lit("(?i)(?=</?"), name, F.lit(r"[\s>/])")))

    def inner(found: Column) -> Column:
        step = lambda p: F.when(F.startswith(p, F.lit("</")), -1).when(F.startswith(F.lower(p), F.concat(F.lit("<"), F.lower(name))), 1).otherwise(0)
        # Pieces before the one that closes the element.
        def count(acc: Column, p: Column) -> Column:
            depth = acc["depth"] + step(p)
            return F.when(acc["depth"] == 0, acc).otherwise(F.struct(depth.alias("depth"), (acc["n"] + F.when(depth > 0, 1).otherwise(0)).alias("n")))

        kept = F.aggregate(found, F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n")), count, lambda acc: acc["n"])
        return F.array_join(F.slice(found, F.lit(1), kept), "")

    return F.when(tag.isNotNull(), bound(pieces, inner))


def selected_text(html: Column, selectors: Sequence[str | tuple[str, int]]) -> Column:
    """Text of the first element that a selector finds: a pattern of its opening tag, or one of its inner HTML with the group."""
    found = [element(html, s) if isinstance(s, str) else first_match(html, *s) for s in selectors]
    return tag_text(F.coalesce(*found), " ")


def _by_test_id(value: str) -> str:
    return rf"""(?is)<(\w+)\s(?:[^>]*\s)?data-testid\s*=\s*["']{value}["'][^>]*>"""


def _by_class(name: str) -> str:
    return rf"""(?is)<(\w+)\s(?:[^>]*\s)?class\s*=\s*["'](?:[^"']*\s)?{name}(?:\s[^"']*)?["'][^>]*>"""


# Where the pages show an address, most reliable first.
ADDRESS_NO = (_by_test_id("object-address"), _by_class("u-t3"), _by_class("ads__ad__content__keys"))
ADDRESS_SE = (
    _by_test_id("property-address"), _by_class("property-address"),
    (r"(?is)</h1>\s*<p(?:\s[^>]*)?>(.*?)</p>", 1), _by_class("qa-property-address"),
)
BLOCK_P = r"(?is)<p(?:\s[^>]*)?>(.*?)(?=</?(?:p|div|ul|ol|dl|table|section|article|main|h[1-6])[\s>]|\z)"
BLOCK_ANY = r"(?is)<(?:p|span|div)(?:\s[^>]*)?>(.*?)(?=</?(?:p|span|div|ul|ol|dl|table|section|article|main|h[1-6])[\s>]|\z)"
POSTAL_NO = r"(?U)\d{4}\s+\w+"
POSTAL_SE = r"(?U)\d{3}\s?\d{2}\s+\w+"


def postal_block(html: Column, block: str, postal: str) -> Column:
    """First text block below 200 characters that holds a postal code and a word after it."""
    texts = F.transform(F.regexp_extract_all(html, F.lit(block), F.lit(1)), lambda t: tag_text(t))
    return F.get(F.filter(texts, lambda t: t.rlike(postal) & (F.length(t) < 200)), F.lit(0))


def page_address(body: Column, blocks: Column, country: str) -> Column:
    """Address from structured data, else from an element, else from a text block; `body` is a page without scripts."""
    selectors, block, postal = (
        (ADDRESS_NO, BLOCK_P, POSTAL_NO) if country == "norway" else (ADDRESS_SE, BLOCK_ANY, POSTAL_SE)
    )
    return F.coalesce(
        _first_of(blocks, block_address), selected_text(body, selectors), postal_block(body, block, postal)
    )


# ---- listings --------------------------------------------------------------------------------


def extract_listings(pages: DataFrame, country: str) -> DataFrame:
    """One typed row per detail page (listing_id, url, html)."""
    return _extract_no(pages) if country == "norway" else _extract_se(pages)


def _extract_no(pages: DataFrame) -> DataFrame:
    seen = computed_once(pages, ["listing_id", "url"], {"blocks": ld_blocks(F.col("html")), "body": visible(F.col("html"))})
    base = computed_once(seen, ["listing_id", "url", "body", "blocks"], {
        "dl": known_pairs(definition_pairs(F.col("body")), LABELS_NO), "rows": known_pairs(table_pairs(F.col("body")), LABELS_NO)})

    def texts(name: str) -> tuple[Column, Column]:
        return field_text(F.col("dl"), LABELS_NO, name, last=True), field_text(F.col("rows"), LABELS_NO, name, last=False)

    def either(name: str, of_dl, of_row) -> Column:
        dl, row = texts(name)
        return bound(dl, lambda t: F.when(t.isNotNull(), of_dl(t)).otherwise(of_row(row))).alias(name)

    def count(text: Column) -> Column:
        return bound(number_no(text), truthy).try_cast("int")

    def year(text: Column) -> Column:
        return bound(number_no(text), lambda n: plausible_year(truthy(n))).cast("int")

    columns = [either(n, number_no, number_no) for n in MONEY_AND_AREA_NO]
    columns += [either("bedrooms", count, count), either("year_built", year, count)]
    columns += [either(n, lambda t: t, lambda t: t) for n in TEXTS_NO]
    flags = [
        F.coalesce(*texts("asking_price")).isNotNull().alias("_has_asking"),
        F.coalesce(*texts("total_price")).isNotNull().alias("_has_total"),
    ]
    ld_price = _first_of(F.col("blocks"), _listing_block(
        lambda b: truthy(b["offers"]["price"].try_cast("double"))))
    ld_name = _first_of(F.col("blocks"), _listing_block(lambda b: b["name"]))
    rows = _fields(base, [
        F.coalesce(page_title(F.col("body")), ld_name).alias("title"),
        page_address(F.col("body"), F.col("blocks"), "norway").alias("address"),
        *columns, *flags, ld_price.alias("_ld_price"),
    ])
    asking = F.when(F.col("_has_asking"), F.col("asking_price")).otherwise(
        F.coalesce("_ld_price", F.when(F.col("_has_total"), F.col("total_price")))
    )
    rows = rows.withColumn("asking_price", asking).drop("_has_asking", "_has_total", "_ld_price")
    return derive_no(rows)


def _fields(base: DataFrame, fields: list[Column]) -> DataFrame:
    """The extracted fields next to the page's key, so that later filters do not extract again."""
    made = F.struct(*fields)
    return base.select("listing_id", "url", F.inline(F.array(made)))


def derive_no(rows: DataFrame) -> DataFrame:
    """Best size, total price including shared debt, and price per square metre; zeros count as missing."""
    sqm = F.coalesce(truthy(F.col("sqm_primary")), truthy(F.col("sqm_usable")), truthy(F.col("sqm_gross")))
    debt = F.coalesce("fellesgjeld", F.lit(0.0))
    total = F.coalesce(truthy(F.col("asking_price")) + debt, truthy(F.col("total_price")))
    return _with_unit_price(rows.withColumn("sqm", sqm).withColumn("total_price_calc", total))


def derive_se(rows: DataFrame) -> DataFrame:
    total = truthy(F.col("asking_price"))
    out = rows.withColumn("common_costs_monthly", F.col("monthly_fee")).withColumn("total_price_calc", total)
    return _with_unit_price(out)


def _with_unit_price(rows: DataFrame) -> DataFrame:
    size = F.when(F.col("sqm") > 0, F.col("sqm"))
    return rows.withColumn("price_per_sqm", rounded(truthy(F.col("total_price_calc")) / size, 0))


# What of a listing's object in the page's cache is used; a part may stand there, or be a reference to another entry.
LISTING = "livingArea string, numberOfRooms string, constructionYear string, " + ", ".join(
    f"{part} struct<__ref:string,{leaf}:string>" for part, leaf in (
        ("fee", "amount"), ("askingPrice", "amount"), ("runningCosts", "amount"), ("housingForm", "name"), ("tenure", "name")))


def _extract_se(pages: DataFrame) -> DataFrame:
    script = r"""(?is)<script[^>]*id\s*=\s*["']__NEXT_DATA__["'][^>]*>(.*?)</script>"""
    state = F.get_json_object(strip(first_match(F.col("html"), script, 1)), "$.props.apolloState")
    seen = computed_once(pages, ["listing_id", "url"], {
        "blocks": ld_blocks(F.col("html")), "body": visible(F.col("html")), "cache": F.from_json(state, "map<string,string>")})
    own = F.try_element_at("cache", F.concat(F.lit("ActivePropertyListing:"), F.col("listing_id")))
    base = computed_once(seen, ["listing_id", "url", "body", "blocks", "cache"], {
        "dl": known_pairs(definition_pairs(F.col("body")), LABELS_SE), "own": F.from_json(own, LISTING)})

    def plain(name: str) -> Column:
        return F.col("own")[name]

    def linked(name: str, leaf: str) -> Column:
        """A value of the listing's object, or of the cache entry that the object points to."""
        ref = F.col("own")[name]["__ref"]
        target = F.from_json(F.try_element_at("cache", ref), f"{leaf} string")
        return F.when(ref.isNotNull(), target[leaf]).otherwise(F.col("own")[name][leaf])

    cached = {
        "sqm": plain("livingArea").try_cast("double"),
        "rooms": plain("numberOfRooms").try_cast("double").try_cast("int"),
        "monthly_fee": linked("fee", "amount").try_cast("double"),
        "asking_price": linked("askingPrice", "amount").try_cast("double"),
        "operating_cost": linked("runningCosts", "amount").try_cast("double"),
        "year_built": plausible_year(plain("constructionYear").try_cast("double")).cast("int"),
        "property_type": _non_empty(linked("housingForm", "name")),
        "ownership_type": _non_empty(linked("tenure", "name")),
    }

    def field(name: str) -> Column:
        text = field_text(F.col("dl"), LABELS_SE, name, last=False)
        if name in TEXTS_SE:
            value = text
        elif name in COUNTS_SE:
            value = bound(number_se(text), truthy).try_cast("int")
        else:
            value = number_se(text)
        return (F.coalesce(cached[name], value) if name in cached else value).alias(name)

    rows = _fields(base, [
        page_title(F.col("body")).alias("title"),
        page_address(F.col("body"), F.col("blocks"), "sweden").alias("address"),
        *[field(n) for n in (*MONEY_AND_AREA_SE, *COUNTS_SE, *TEXTS_SE)],
    ])
    return derive_se(rows)


def valid_listings(listings: DataFrame, country: str) -> DataFrame:
    """Listings with a price above zero that are homes; an unknown type counts as a home."""
    excluded = NON_RESIDENTIAL_NO if country == "norway" else NON_RESIDENTIAL_SE
    other_use = F.coalesce(F.lower("property_type").isin(*excluded), F.lit(False))
    return listings.filter((F.col("asking_price") > 0) & ~other_use)

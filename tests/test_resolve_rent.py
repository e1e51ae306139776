import difflib
import random
import re

import numpy as np
import pytest

from regionscore import schemas
from regionscore.operators import rent, resolve

REGIONS_NO = [("0301", "Oslo", "03", "Oslo", "01"), ("4601", "Bergen", "46", "Vestland", "07"), ("5001", "Trondheim", "50", "Trøndelag", "08"),
              ("1144", "Nes", "11", "Rogaland", "99"), ("3301", "Drammen", "33", "Buskerud", "12"), ("1818", "Herøy (Nordland)", "18", "Nordland", "16"),
              ("3222", "Aurskog-Høland", "32", "Akershus", "06"), ("1833", "Rana", "18", "Nordland", "14")]
PLACES_NO = [("mo i rana", "1833", True), ("ski", "3207", True), ("grorud", "0301", True), ("byåsen", "5001", True)]
REGIONS_SE = [("0180", "Stockholm", "01", "Stockholms län", "1.01"), ("1280", "Malmö", "12", "Skåne län", "3.01"), ("0139", "Upplands-Bro", "01", "Stockholms län", "1.04")]
PLACES_SE = [("vasastan", "0180", False), ("kista", "0180", True)]


def dims(spark, country):
    regions, places = (REGIONS_NO, PLACES_NO) if country == "norway" else (REGIONS_SE, PLACES_SE)
    dim = spark.createDataFrame(regions, schemas.REGION_DIM)
    given = spark.createDataFrame(places, "alias string, code string, fuzzy_eligible boolean")
    return dim, resolve.gazetteer(dim, given, country)


def placed(spark, country, addresses):
    dim, aliases = dims(spark, country)
    df = spark.createDataFrame(list(enumerate(addresses)), "listing_id long, address string")
    out = resolve.resolve_addresses(df, aliases, dim, country)
    return [(r.municipality_code, r.match_stage) for r in out.orderBy("listing_id").collect()]


CASES_NO = {
    "Storgata 1, 0182 Oslo": ("0301", 1), "Byåsen, Trondheim": ("5001", 1), "Hus i grorud nær T-bane": ("0301", 3), "Drammenn": ("3301", 4),
    "": ("0000", 0), None: ("0000", 0), "Vei 3,  5003  BERGEN ": ("4601", 1), "Villa ved herøy (nordland) sentrum": ("1818", 3),
    "Ved aurskog-høland kirke": ("3222", 3), "I aurskog-nes her": ("1144", 3), "Nesset 5": ("0000", 0), "xx, Mo i Rana by": ("1833", 3),
    "aurskoghøland": ("3222", 1), "?!, 12": ("0000", 0), "Trondheimm, Ski": ("3207", 1), "åski": ("0000", None), "3301 Ski 0182 ved oslo": ("0301", 3),
}


def test_resolution_norway(spark):
    got = dict(zip(CASES_NO, placed(spark, "norway", list(CASES_NO))))
    for address, (code, stage) in CASES_NO.items():
        if stage is not None:
            assert got[address] == (code, stage), address


def test_resolution_sweden(spark):
    cases = {"Gatan 1, 114 35 Stockholm": ("0180", 1), "Gatan 1, 114 35 Malmö södra": ("1280", 2), "Vasastan, okänd ort": ("0180", 1),
             "nära vasastan idag": ("0000", 0), "vid kista centrum": ("0180", 3), "Malmo": ("1280", 1), "upplands bro": ("0139", 1), "Stokholm": ("0180", 4)}
    assert placed(spark, "sweden", list(cases)) == list(cases.values())


def test_names_and_defaults(spark):
    dim, aliases = dims(spark, "norway")
    df = spark.createDataFrame([(1, "Ski"), (2, "x")], "listing_id long, address string")
    out = {r.listing_id: r for r in resolve.resolve_addresses(df, aliases, dim, "norway").collect()}
    assert (out[1].municipality_name, out[1].region_code, out[1].rent_zone) == ("3207", "00", "99")  # alias of a region not in the dimension
    assert (out[2].municipality_name, out[2].municipality_clean, out[2].region_name) == ("Ukjent", "ukjent", "Ukjent")


def test_repeated_and_missing_ids_keep_their_own_result(spark):
    dim, aliases = dims(spark, "norway")
    df = spark.createDataFrame([(1, "Oslo", "x"), (1, "Bergen", "x"), (None, "Oslo", "y"), (None, "Drammenn", "y"), (1, "Oslo", "x")], "listing_id long, address string, _row string")
    out = resolve.resolve_addresses(df, aliases, dim, "norway")
    assert out.columns[:4] == ["listing_id", "address", "_row", "match_stage"]
    got = sorted((r.listing_id or 0, r.address, r.municipality_code, r.match_stage) for r in out.collect())
    assert got == [(0, "Drammenn", "3301", 4), (0, "Oslo", "0301", 1), (1, "Bergen", "4601", 1), (1, "Oslo", "0301", 1), (1, "Oslo", "0301", 1)]


def test_similarity_equals_block_matching():
    r = random.Random(6)
    for _ in range(3000):
        a, b = ("".join(r.choice("abcå ") for _ in range(r.randint(0, 9))) for _ in range(2))
        assert resolve.similarity(a, b) == difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()


@pytest.mark.parametrize("cutoff", [0.6, 0.7, 0.75, 0.9])
def test_similar_names_lose_no_pair(spark, cutoff):
    r = random.Random(int(cutoff * 100))
    word = lambda: "".join(r.choice("abcdeø") for _ in range(r.randint(1, 12)))
    names = sorted({word() for _ in range(60)})
    parts = sorted({word() for _ in range(120)} | {n[:-1] + "x" for n in names if len(n) > 2})
    got = resolve.similar_names(spark.createDataFrame([(p,) for p in parts], "part string"), spark.createDataFrame([(n,) for n in names], "alias string"), cutoff)
    want = {p: hit[0] for p in parts if (hit := difflib.get_close_matches(p, names, n=1, cutoff=cutoff))}
    assert {x.part: x.alias for x in got.collect()} == want


def _words(r, n, letters, low=2, high=14):
    return sorted({"".join(r.choice(letters) for _ in range(r.randint(low, high))) for _ in range(n)})


@pytest.mark.parametrize("cutoff", [0.68, 0.7, 0.75, 0.85])
def test_index_keeps_every_similar_pair(spark, cutoff):
    r = random.Random(int(cutoff * 1000))
    for letters in ("ab", "abcdeø ", "aaaaabcdefghijklmnoprstuvåæø -"):
        names = _words(r, 50, letters, 1)
        parts = sorted({*_words(r, 80, letters, 1), *(n[1:] + n[:1] for n in names), *(n.replace("a", "") for n in names if n.replace("a", ""))})
        met = resolve.possible_names(spark.createDataFrame([(p,) for p in parts], "part string"), spark.createDataFrame([(n,) for n in names], "alias string"), cutoff)
        got = {tuple(x) for x in met.collect()}
        assert {(p, n) for p in parts for n in names if difflib.SequenceMatcher(None, n, p, autojunk=False).ratio() >= cutoff} <= got


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyzåæø", "eeeeeennnnnaaaaarrrrrtttllliiiooossdkggmvbufhpåøyjæ"])
def test_few_pairs_meet_and_no_key_is_hot(spark, letters):
    r = random.Random(8)
    names, parts = _words(r, 3000, letters, 4, 12), _words(r, 3000, letters, 4, 12)
    frames = spark.createDataFrame([(p,) for p in parts], "part string"), spark.createDataFrame([(n,) for n in names], "alias string")
    met = resolve.possible_names(*frames, 0.7)
    assert met.count() < 0.05 * len(names) * len(parts)
    for df, name in zip(frames, ("part", "alias")):
        grams = resolve._grams(df, name)
        frequency = resolve._grams(frames[1], "alias").groupBy("gram").count().withColumnRenamed("count", "n")
        keys = resolve._postings(grams, frequency, name, 0.7)
        assert keys.groupBy("key").count().agg({"count": "max"}).first()[0] < 0.01 * keys.count()


def test_long_posting_lists_are_dealt_out(spark, monkeypatch):
    r = random.Random(9)
    names = [f"kommune {w}" for w in _words(r, 120, "abcdef", 1, 5)]
    parts = [f"kommune {w}" for w in _words(r, 60, "abcdef", 1, 5)]
    frames = spark.createDataFrame([(p,) for p in parts], "part string"), spark.createDataFrame([(n,) for n in names], "alias string")
    whole = sorted(map(tuple, resolve.possible_names(*frames, 0.75).collect()))
    monkeypatch.setattr(resolve, "POSTINGS", 9)
    assert sorted(map(tuple, resolve.possible_names(*frames, 0.75).collect())) == whole and whole


def test_random_addresses_equal_a_plain_loop(spark):
    """Norwegian rules restated row by row: parts from the right, longest whole word, most similar name."""
    dim, aliases = dims(spark, "norway")
    known = {r.alias: r.code for r in aliases.collect()}
    names = sorted((r.alias for r in aliases.collect() if r.fuzzy_eligible), key=lambda n: (-len(n), n))

    def plain(address):
        parts = [p.strip() for p in address.strip().split(",")][::-1]
        for p in parts:
            key = re.sub(r"\s+", " ", re.sub(r"\d{4}\s*", "", p.lower()).strip())
            if key in known:
                return known[key], 1
        for n in names:
            if len(n) >= 3 and re.search(r"(?<!\w)" + re.escape(n) + r"(?!\w)", address.lower()):
                return known[n], 3
        for p in parts:
            key = re.sub(r"\d{4}\s*", "", p).strip().lower()
            close = difflib.get_close_matches(key, names, n=1, cutoff=0.7) if len(key) >= 2 else []
            if close:
                return known[close[0]], 4
        return "0000", 0

    r = random.Random(5)
    words = [*known, "gate", "0182", "12 34", "bergenn", "oslos", "drm", "trondhjem", "nær", "Å", "-", "(nes)", "RANA", "rana-by", "au"]
    texts = [r.choice([" ", ", ", "-", ",", "  "]).join(r.choice(words) for _ in range(r.randint(1, 5))) for _ in range(300)]
    assert placed(spark, "norway", texts) == [plain(t) for t in texts]


def test_alias_precedence(spark, rows):
    regions = spark.createDataFrame([("1", "Å-Bø"), ("2", "Åbø")], "code string, name string")
    places = spark.createDataFrame([("å-bø", "9", False)], "alias string, code string, fuzzy_eligible boolean")
    got = {a: (c, e) for a, c, e in rows(resolve.gazetteer(regions, places, "norway"), "alias", "code", "fuzzy_eligible")}
    assert got == {"å-bø": ("9", True), "bø": ("1", False), "åbø": ("2", True)} or got == {"å-bø": ("9", True), "åbø": ("2", True)}


GRID = [("A", 30.0, 6000.0), ("A", 50.0, 8000.0), ("A", 70.0, 10000.0), ("B", 30.0, 2000.0), ("B", 70.0, None), (None, 50.0, 1.0)]


def rents(spark, data, grid=GRID, country="norway"):
    df = spark.createDataFrame([(i, z, s) for i, (z, s) in enumerate(data)], "i int, _zone string, sqm double")
    out = rent.estimate_rent(df, spark.createDataFrame(grid, schemas.RENT_GRID), country)
    assert out.columns == ["i", "sqm", "estimated_monthly_rent"]
    return [r.estimated_monthly_rent for r in out.orderBy("i").collect()]


def test_rent_interpolation(spark):
    got = rents(spark, [("A", 40.0), ("A", 20.0), ("A", 99.0), ("A", None), ("A", 50.0), ("A", 70.0), ("A", 30.0), ("B", 55.0)])
    assert got == [7000.0, 6000.0, 10000.0, 10000.0, 8000.0, 10000.0, 6000.0, 2000.0]
    assert rents(spark, [("A", None)], country="sweden") == [9500.0]


def test_zone_without_grid_takes_the_median_grid(spark):
    grid = [(z, s, r) for z, base in (("A", 1000.0), ("B", 2000.0), ("C", 9000.0)) for s, r in ((30.0, base), (70.0, base * 2))]
    assert rents(spark, [("Z", 50.0), (None, 30.0)], grid) == [3000.0, 2000.0]
    assert rents(spark, [("Z", 50.0)], [("A", None, None)]) == [None]


def test_rent_equals_numpy(spark):
    r = random.Random(6)
    xs = sorted(r.uniform(10, 150) for _ in range(9))
    ys = [r.uniform(3000, 20000) for _ in xs]
    sizes = [r.uniform(0, 170) for _ in range(200)]
    got = rents(spark, [("A", s) for s in sizes], [("A", x, y) for x, y in zip(xs, ys)])
    assert got == pytest.approx(list(np.interp(sizes, xs, ys)))


def test_zones(spark, rows):
    df = spark.createDataFrame([("0301", "01"), ("9999", "06"), ("8888", "xx")], "municipality_code string, rent_zone string")
    direct = spark.createDataFrame([("0301", "1.01")], "municipality_code string, zone string")
    generic = spark.createDataFrame([("01", "9.99"), ("06", "2.02")], "rent_zone string, zone string")
    assert rows(rent.resolve_zone(df, "norway", direct, generic), "municipality_code", "_zone") == [("0301", "1.01"), ("8888", "21.00"), ("9999", "2.02")]
    assert rows(rent.resolve_zone(df, "sweden"), "_zone") == [("01",), ("06",), ("xx",)]


def test_grids(spark, rows):
    rents_ = spark.createDataFrame([("0180", 100.0), ("0181", 120.0), ("9999", 50.0)], "code string, rent_per_sqm double")
    zones = spark.createDataFrame([("0180", "1.01"), ("0181", "1.01")], "code string, rent_zone string")
    grid = rows(rent.zone_rent_grid(rents_, zones))
    assert len(grid) == 12 and ("1.01", 30.0, 3300.0) in grid and ("7.00", 105.0, 5250.0) in grid
    bases = spark.createDataFrame(list(rent.BASE_RENTS_SE.items()), "rent_zone string, base_rent int")
    grid = rows(rent.synthetic_rent_grid(bases))
    assert len(grid) == 90 and ("1.01", 60.0, 18000.0) in grid and ("7.00", 30.0, round(5500 * 0.5 ** 0.75, 0)) in grid
    codes = spark.createDataFrame([("1.030",), ("1.03",), ("x",)], "c string")
    assert [r[0] for r in codes.select(rent.size_of_code(codes.c, rent.SIZE_CODES_NO)).collect()] == [30.0, 30.0, None]

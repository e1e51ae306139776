"""Fixed lookup tables of the two countries, and the dimensions made from them.

All tables in this file are fixed values; callers with newer codes pass their own dimensions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from regionscore import schemas
from regionscore.plans.listings import Dimensions

# Place -> municipality.
PLACES_NO = {
    "rørvik": "5059", "kolvereid": "5059", "jessheim": "3209", "ski": "3207", "sandvika": "3201",
    "mjøndalen": "3301", "hønefoss": "3305", "mo i rana": "1833", "harstad": "5503", "sortland": "1870",
    "finnsnes": "5526", "alta": "5601", "hammerfest": "5603", "kirkenes": "5605", "bryne": "1121", "mandal": "4062",
    "porsgrunn": "3901", "skien": "3903", "moss": "3103", "fredrikstad": "3107", "sarpsborg": "3105",
    "halden": "3101", "førde": "4237", "sogndal": "4230", "stord": "4203", "voss": "4208", "odda": "4208",
    "hokksund": "3314", "mysen": "3118", "askim": "3118", "fosnavåg": "1515", "søgne": "4001", "ellingsøy": "1507",
    "fyllingsdalen": "4201", "førresfjorden": "1146", "fosslandsosen": "5054", "flekkerøy": "4001",
    "randesund": "4001", "vågsbygd": "4001", "lund": "4001", "ågotnes": "4631", "straume": "4631", "sotra": "4631",
    "askøy": "4217", "kleppestø": "4217", "arna": "4201", "fana": "4201", "åsane": "4201", "ytrebygda": "4201",
    "laksevåg": "4201", "nesttun": "4201", "råholt": "3209", "kløfta": "3209", "ås": "3215", "drøbak": "3213",
    "langhus": "3207", "kolbotn": "3207", "lørenskog": "3218", "fjellhamar": "3218", "rælingen": "3220",
    "nittedal": "3232", "nesoddtangen": "3212", "vinterbro": "3215", "heimdal": "5001", "byåsen": "5001",
    "tiller": "5001", "ranheim": "5001", "lade": "5001", "saupstad": "5001", "moholt": "5001",
    "lambertseter": "0301", "grorud": "0301", "stovner": "0301", "furuset": "0301", "manglerud": "0301",
    "nordstrand": "0301", "oppsal": "0301", "bøler": "0301", "holmlia": "0301", "mortensrud": "0301",
    "tåsen": "0301", "majorstuen": "0301", "grünerløkka": "0301", "frogner": "0301", "sagene": "0301",
    "ullern": "0301", "hundvåg": "1103", "storhaug": "1103", "hillevåg": "1103", "tasta": "1103", "madla": "1103",
    "hinna": "1103", "tananger": "1124", "sola": "1124", "randaberg": "1127", "kopervik": "1149",
    "haugesund": "1106", "lyngdal": "4225", "farsund": "4206", "vennesla": "4223", "songdalen": "4001",
    "lillesand": "4215", "tvedestrand": "4213", "risør": "4211", "notodden": "3905", "rjukan": "3933", "bø": "3917",
    "horten": "3801", "holmestrand": "3802", "stavern": "3805", "stathelle": "3909", "brevik": "3901",
    "langesund": "3909", "kongsvinger": "3401", "moelv": "3412", "brumunddal": "3412", "otta": "3434",
    "vinstra": "3435", "fagernes": "3449", "leira": "3441", "dombås": "3432", "raufoss": "3415", "gran": "3446",
    "jevnaker": "3340", "lunner": "3342", "flå": "3320", "gol": "3324", "hemsedal": "3338", "ål": "3336",
    "geilo": "3336", "nesbyen": "3322", "sandsli": "4201", "loddefjord": "4201", "rådal": "4201", "tertnes": "4201",
    "olsvik": "4201", "erdal": "4201", "øvre ervik": "4201", "morvik": "4201", "hjellestad": "4201",
    "bønes": "4201", "kokstad": "4201", "haukeland": "4201", "brattholmen": "4631", "knarrevik": "4631",
    "søfteland": "4214", "kråkerøy": "3107", "brekstad": "5056", "hvam": "3224", "heggedal": "3203",
    "mosjøen": "1824", "hvasser": "3811", "nøtterøy": "3811", "tjøme": "3811", "prestfoss": "3332", "rud": "3201",
    "rykkinn": "3201", "bekkestua": "3201", "stabekk": "3201", "høvik": "3201", "billingstad": "3203",
    "holmen": "3203", "nesbru": "3203", "slemmestad": "3203", "spikkestad": "3203", "lier": "3312",
    "tranby": "3312", "sylling": "3312", "åmot": "3422", "rena": "3422", "tynset": "3427", "røros": "5025",
    "oppdal": "5021", "orkanger": "5014", "melhus": "5028", "malvik": "5031", "hommelvik": "5031", "selbu": "5032",
    "klæbu": "5001", "fillan": "5055", "sistranda": "5057", "kristiansand s": "4001", "kristiansand n": "4001",
}
# City districts; they match as address parts, not inside a text and not by similarity.
DISTRICTS_STOCKHOLM = (
    "södermalm", "östermalm", "kungsholmen", "vasastan", "norrmalm", "gamla stan", "djurgården", "hammarby sjöstad",
    "liljeholmen", "skärholmen", "farsta", "enskede", "bromma", "spånga", "hässelby", "vällingby", "blackeberg",
    "rågsved", "bandhagen", "bagarmossen", "skarpnäck", "årsta", "johanneshov", "hammarby", "sundbyberg s",
    "danderyds sjukhus",
)
DISTRICTS_GOTHENBURG = (
    "hisingen", "majorna", "linnéstaden", "avenyn", "linné", "vasastaden", "johanneberg", "guldheden", "örgryte",
    "härlanda", "kortedala", "bergsjön", "angered", "lärjedalen", "tuve", "backa", "biskopsgården", "lundby",
    "kärra", "rödbo", "frölunda", "tynnered", "högsbo", "askim", "älvsborg", "västra frölunda",
)
DISTRICTS_MALMO = (
    "husie", "hyllie", "limhamn", "limhamn-bunkeflo", "bunkeflo", "kirseberg", "centrum", "fosie", "oxie",
    "rosengård", "södra innerstaden", "västra innerstaden", "husietorp",
)
DISTRICTS_NEAR_STOCKHOLM = {"arenastaden": "0184", "hagalund": "0184", "huvudsta": "0183"}

# Place -> municipality.
PLACES_SE = {
    "kista": "0180", "spånga": "0180", "älvsjö": "0180", "skärholmen": "0180", "midsommarkransen": "0180",
    "telefonplan": "0180", "hägersten": "0180", "bredäng": "0180", "sätra": "0180", "vårberg": "0180",
    "fittja": "0127", "alby": "0127", "norsborg": "0127", "hallunda": "0127", "tumba": "0127", "tullinge": "0127",
    "flemingsberg": "0126", "masmo": "0126", "skogås": "0126", "stuvsta": "0126", "trångsund": "0126",
    "jordbro": "0136", "handen": "0136", "brandbergen": "0136", "vendelsö": "0136", "tungelsta": "0136",
    "tyresö": "0138", "boo": "0182", "fisksätra": "0182", "saltsjöbaden": "0182", "gustavsberg": "0120",
    "ingarö": "0120", "djurö": "0120", "täby centrum": "0160", "arninge": "0160", "roslags näsby": "0160",
    "viggbyholm": "0160", "djursholm": "0162", "stocksund": "0162", "enebyberg": "0162", "mörby": "0162",
    "sollentuna": "0163", "häggvik": "0163", "rotebro": "0163", "helenelund": "0163", "tureberg": "0163",
    "barkarby": "0123", "jakobsberg": "0123", "kallhäll": "0123", "bro": "0139", "kungsängen": "0139",
    "upplands väsby": "0114", "väsby": "0114", "märsta": "0191", "arlanda": "0191", "knivsta": "0319",
    "bålsta": "0305", "mölnlycke": "1401", "landvetter": "1401", "sävedalen": "1402", "kållered": "1481",
    "kungsbacka": "1384", "lindome": "1481", "stenungsund": "1415", "ytterby": "1482", "kode": "1482",
    "lerum": "1441", "floda": "1441", "nödinge": "1440", "skepplanda": "1440", "lödöse": "1462", "sjövik": "1462",
    "vellinge": "1233", "höllviken": "1233", "skurup": "1264", "staffanstorp": "1230", "kävlinge": "1261",
    "eslöv": "1285", "höör": "1267", "klippan": "1276", "ängelholm": "1292", "åstorp": "1277", "bjuv": "1260",
    "helsingborg": "1283", "höganäs": "1284", "mölle": "1284", "viken": "1284", "landskrona": "1282",
    "ystad": "1286", "trelleborg": "1287", "tomelilla": "1270", "sjöbo": "1265", "hörby": "1266",
    "linköping": "0580", "norrköping": "0581", "jönköping": "0680", "huskvarna": "0680", "örebro": "1880",
    "västerås": "1980", "eskilstuna": "0484", "karlstad": "1780", "sundsvall": "2281", "timrå": "2262",
    "härnösand": "2280", "gävle": "2180", "sandviken": "2181", "umeå": "2480", "skellefteå": "2482",
    "luleå": "2580", "östersund": "2380", "falun": "2080", "borlänge": "2081", "borås": "1490", "uddevalla": "1485",
    "trollhättan": "1488", "skövde": "1496", "nyköping": "0480", "växjö": "0780", "kalmar": "0880",
    "gotland": "0980", "visby": "0980", "karlskrona": "1080", "kristianstad": "1290", "halmstad": "1380",
    "varberg": "1383",
}

# Municipality -> rent zone, generic zone -> rent zone.
ZONE_OF_CODE_NO = {
    "0301": "1.01", "3201": "2.01", "3203": "2.01", "3205": "2.01", "3207": "2.01", "3209": "2.01", "3211": "2.01",
    "3213": "2.02", "3215": "2.02", "3217": "2.02", "3219": "2.02", "3220": "2.02", "3222": "2.02", "3224": "2.02",
    "3226": "2.02", "3228": "2.02", "3230": "2.02", "3232": "2.02", "3234": "2.02", "3236": "2.02", "4201": "3.01",
    "5001": "4.01", "1103": "5.00", "4001": "6.00", "5501": "7.00",
}
ZONE_OF_GENERIC_NO = {
    "01": "1.01", "02": "1.02", "03": "1.03", "04": "1.04", "05": "2.01", "06": "2.02", "07": "3.01", "08": "4.01",
    "09": "5.00", "10": "6.00", "11": "7.00", "12": "20.00", "13": "20.00", "14": "21.00", "15": "21.00",
    "16": "22.00", "99": "21.00",
}
ZONE_OF_CODE_SE = {
    "0180": "1.01", "0181": "1.01", "0182": "1.01", "0183": "1.02", "0184": "1.02", "0186": "1.02", "0187": "1.02",
    "0188": "1.02", "0191": "1.03", "0192": "1.03", "0127": "1.03", "0128": "1.03", "0126": "1.04", "0136": "1.04",
    "0138": "1.04", "0139": "1.04", "1480": "2.01", "1481": "2.01", "1482": "2.01", "1484": "2.02", "1485": "2.02",
    "1486": "2.02", "1487": "2.02", "1488": "2.03", "1280": "3.01", "1281": "3.01", "1282": "3.01", "1283": "3.02",
    "1285": "3.02", "1286": "3.03", "1287": "3.03", "1290": "3.04", "0380": "4.01", "0381": "4.01", "0382": "4.01",
}

# Municipality name -> price index region, county -> price index region.
INDEX_OF_NAME_NO = {
    "oslo": "001", "bærum": "001", "stavanger": "002", "sandnes": "002", "sola": "002", "randaberg": "002",
    "bergen": "003", "trondheim": "004",
}
INDEX_OF_REGION_NO = {
    "32": "005", "31": "006", "33": "006", "38": "006", "39": "006", "34": "007", "40": "008", "11": "008",
    "15": "009", "42": "009", "50": "010", "18": "011", "55": "011", "56": "011",
}
INDEX_OF_NAME_SE = {
    "stockholm": "01", "solna": "01", "sundbyberg": "01", "nacka": "01", "huddinge": "01", "täby": "01",
    "järfälla": "01", "sollentuna": "01", "haninge": "01", "botkyrka": "01", "södertälje": "01", "göteborg": "14",
    "mölndal": "14", "partille": "14", "kungälv": "14", "härryda": "14", "lerum": "14", "malmö": "12", "lund": "12",
    "vellinge": "12", "staffanstorp": "12", "burlöv": "12", "lomma": "12", "uppsala": "03", "knivsta": "03",
    "håbo": "03",
}
INDEX_OF_REGION_SE = {
    "01": "01", "03": "03", "04": "04", "05": "04", "18": "04", "19": "04", "06": "05", "07": "05", "08": "05",
    "12": "12", "13": "13", "14": "14", "17": "17", "20": "17", "21": "17", "22": "22", "23": "22", "24": "22",
    "25": "22",
}


def _pairs(spark: SparkSession, values: Mapping[str, str], key: str, value: str) -> DataFrame:
    return spark.createDataFrame(list(values.items()), f"{key} string, {value} string")


def places(spark: SparkSession, country: str) -> DataFrame:
    """Places that are no municipality names: (alias, code, fuzzy_eligible)."""
    rows = {}
    if country == "norway":
        rows.update({a: (c, True) for a, c in PLACES_NO.items()})
    else:
        for names, code in ((DISTRICTS_STOCKHOLM, "0180"), (DISTRICTS_GOTHENBURG, "1480"), (DISTRICTS_MALMO, "1280")):
            rows.update({a: (code, False) for a in names})
        rows.update({a: (c, False) for a, c in DISTRICTS_NEAR_STOCKHOLM.items()})
        rows.update({a: (c, True) for a, c in PLACES_SE.items()})
    return spark.createDataFrame([(a, *v) for a, v in rows.items()], schemas.ALIASES)


def dimensions(spark: SparkSession, country: str) -> Dimensions:
    """Zone and index dimensions; the second country's rent zone is that of the region itself."""
    by_name, by_region = (
        (INDEX_OF_NAME_NO, INDEX_OF_REGION_NO) if country == "norway" else (INDEX_OF_NAME_SE, INDEX_OF_REGION_SE)
    )
    index = (_pairs(spark, by_name, "key", "index_region_code"), _pairs(spark, by_region, "key", "index_region_code"))
    if country == "sweden":
        return Dimensions(None, None, *index, grid_zone="grid_zone")
    return Dimensions(
        _pairs(spark, ZONE_OF_CODE_NO, "municipality_code", "zone"),
        _pairs(spark, ZONE_OF_GENERIC_NO, "rent_zone", "zone"), *index, grid_zone="zone_code",
    )


def rent_zones_sweden(spark: SparkSession) -> DataFrame:
    return _pairs(spark, ZONE_OF_CODE_SE, "code", "rent_zone")

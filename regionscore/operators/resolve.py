"""Free-text address to region code, in stages, with the gazetteer as data.

The gazetteer is a dimension (alias, code, fuzzy_eligible) of any size. Every row gets a key of its own; the names
that the stages 1-3 would accept are spread out once, met with the gazetteer in one join (a broadcast only by its
true size), and the first in order of stage and place wins. What is left open is compared with similar names:
distinct parts only, with names that an inverted index on pairs of letter pairs leaves possible.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regionscore.functions.clean import alias_variant_no, alias_variant_se, strip
from regionscore.landing import land, sized


@dataclass(frozen=True)
class AddressRules:
    """Fixed values of one country: postal pattern, similarity cutoff, defaults."""

    postal: str
    cutoff: float
    unknown_name: str
    default_zone: str
    city_after_postal: str | None = None
    unknown_code: str = "0000"
    unknown_region: str = "00"


NORWAY = AddressRules(postal=r"(?U)\d{4}\s*", cutoff=0.70, unknown_name="Ukjent", default_zone="99")
SWEDEN = AddressRules(
    postal=r"(?U)\b\d{3}\s?\d{2}\b",
    cutoff=0.75,
    unknown_name="Okänd",
    default_zone="7.00",
    city_after_postal=r"(?U)\b\d{3}\s?\d{2}\b\s+(\w[\w\s-]*)",
)
RULES = {"norway": NORWAY, "sweden": SWEDEN}


def gazetteer(regions: DataFrame, places: DataFrame, country: str) -> DataFrame:
    """Aliases of all regions and places: (alias, code, fuzzy_eligible).

    Names give themselves and a cleaned variant; `places` (alias, code, fuzzy_eligible) wins over
    them, and of two regions with one alias the later code wins.
    """
    variant = alias_variant_no if country == "norway" else alias_variant_se
    lower = F.lower("name")
    own = F.array(
        F.struct(lower.alias("alias"), F.lit(True).alias("fuzzy_eligible")),
        F.struct(variant(F.col("name")).alias("alias"), F.lit(False).alias("fuzzy_eligible")),
    )
    derived = regions.select("code", F.explode(own).alias("a")).select("a.*", "code", F.lit(0).alias("level"))
    given = places.select("alias", "fuzzy_eligible", "code", F.lit(1).alias("level"))
    return (
        derived.unionByName(given)
        .groupBy("alias")
        .agg(
            F.max_by("code", F.struct("level", "code")).alias("code"),
            F.bool_or("fuzzy_eligible").alias("fuzzy_eligible"),
        )
        .filter(F.length("alias") > 0)
    )


def _parts(address: Column) -> Column:
    """Comma-separated parts, trimmed, right-most first."""
    return F.reverse(F.transform(F.split(address, ","), lambda p: strip(p)))


def _exact_candidates(address: Column, rules: AddressRules) -> Column:
    def clean(part: Column) -> Column:
        text = F.regexp_replace(F.lower(part), rules.postal, "")
        return F.regexp_replace(strip(text), r"(?U)\s+", " ")

    return F.transform(_parts(address), clean)


def _city_candidates(address: Column, rules: AddressRules) -> Column:
    found = F.lower(strip(F.regexp_extract(address, rules.city_after_postal, 1)))
    return F.array(F.substring_index(found, " ", 1))


def _phrase_candidates(address: Column, words: Column) -> Column:
    """Every stretch of 1..`words` whole words as written, separators included."""
    pieces = F.regexp_extract_all(F.lower(address), F.lit(r"(?U)(\w+|\W+)"), F.lit(0))
    first = F.when(F.get(pieces, F.lit(0)).rlike(r"(?U)^\w"), 1).otherwise(2)

    def stretches(n: Column) -> Column:
        width = 2 * n - 1
        last = F.size(pieces) - width + 1
        starts = F.when(last >= first, F.sequence(first, last, F.lit(2))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(pieces, i, width), ""))

    return F.flatten(F.transform(F.sequence(F.lit(1), words), stretches))


def _bare(alias: Column) -> Column:
    """A name from its first letter or digit to its last."""
    return F.regexp_replace(alias, r"(?U)^\W+|\W+$", "")


def _whole_word(alias: Column) -> Column:
    """Pattern of the name with no letter or digit next to it."""
    quoted = F.replace(alias, F.lit("\\E"), F.lit(r"\E\\E\Q"))
    return F.concat(F.lit(r"(?U)(?<!\w)\Q"), quoted, F.lit(r"\E(?!\w)"))


def _named(rows: DataFrame, row: str, address: str, aliases: DataFrame, rules: AddressRules) -> DataFrame:
    """The stages 1-3: `row, alias, code, stage` of rows in whose address a name stands."""
    place = strip(F.coalesce(F.col(address), F.lit("")))
    eligible = aliases.filter(F.col("fuzzy_eligible") & (F.length("alias") >= 3))
    words = F.size(F.regexp_extract_all(_bare(F.col("alias")), F.lit(r"(?U)\w+"), F.lit(0)))
    longest = eligible.agg(F.coalesce(F.max(words), F.lit(0))).first()[0]

    # (stage, place in it, name, is a phrase); a phrase's place is its length, longest first
    def exact(stage: int, candidates: Column) -> Column:
        return F.transform(candidates, lambda c, i: F.struct(F.lit(stage).alias("stage"), i.alias("k"), c.alias("key"), F.lit(False).alias("phrase")))

    wanted = [exact(1, _exact_candidates(place, rules))]
    if rules.city_after_postal:
        wanted.append(exact(2, _city_candidates(place, rules)))
    if longest:
        phrases = F.array_distinct(_phrase_candidates(place, F.lit(longest)))
        wanted.append(F.transform(phrases, lambda c: F.struct(F.lit(3).alias("stage"), F.lit(0).alias("k"), c.alias("key"), F.lit(True).alias("phrase"))))
    spread = rows.select(row, place.alias("_place"), F.inline(F.filter(F.concat(*wanted), lambda w: F.length(w["key"]) > 0)))
    names = aliases.select(F.col("alias").alias("key"), F.lit(False).alias("phrase"), "alias", "code").union(
        eligible.select(_bare(F.col("alias")).alias("key"), F.lit(True), "alias", "code").filter("length(key) > 0"))
    hits = spread.join(sized(names), ["key", "phrase"])
    hits = hits.filter(~F.col("phrase") | (F.col("alias") == F.col("key")) | F.regexp_like(F.lower("_place"), _whole_word(F.col("alias"))))
    order = F.struct("stage", F.when(F.col("phrase"), -F.length("alias")).otherwise(F.col("k")).alias("k"), "alias", "code")
    return hits.groupBy(row).agg(F.min(order).alias("hit")).select(row, "hit.alias", "hit.code", "hit.stage")


def similarity(a: str, b: str) -> float:
    """Twice the letters in common blocks over all letters: the longest common block (first in `a`, then in `b`), and
    so on at both sides of it."""
    common, open_parts = 0, [(0, len(a), 0, len(b))]
    while open_parts:
        a0, a1, b0, b1 = open_parts.pop()
        found = next(((i, j, size) for size in range(min(a1 - a0, b1 - b0), 0, -1) for i in range(a0, a1 - size + 1) if (j := b.find(a[i:i + size], b0, b1)) >= 0), None)
        if found:
            i, j, size = found
            common += size
            open_parts += [(a0, i, b0, j), (i + size, a1, j + size, b1)]
    return 2.0 * common / (len(a) + len(b)) if a or b else 1.0


def _letters(text: Column) -> Column:
    """Letters numbered by occurrence (`e1`, `e2`), those of later occurrences first: what two texts share of these
    is their largest possible number of common letters."""
    chars = F.array_sort(F.filter(F.split(text, ""), lambda c: F.length(c) > 0))

    def numbered(sorted_chars: Column) -> Column:
        return F.transform(sorted_chars, lambda c, i: F.struct((F.array_position(sorted_chars, c).cast("int") - i - 1).alias("k"), c.alias("c")))

    keyed = F.array_sort(F.get(F.transform(F.array(chars), numbered), F.lit(0)))
    return F.transform(keyed, lambda x: F.concat(x["c"], (1 - x["k"]).cast("string")))


#: Names that one posting list holds; longer lists are dealt out by name, and the parts that ask for them go to every deal.
POSTINGS = 10_000


def _least_common(letters: Column, cutoff: float) -> Column:
    """Letters in common blocks that two texts of so many letters together need at least."""
    return F.ceil(letters * (cutoff / 2.0) - 1e-9).cast("int")


def _grams(df: DataFrame, name: str) -> DataFrame:
    """`name, size, at, gram`: pairs of neighbouring letters and their places, a start before and an end after the text."""
    padded = F.concat(F.lit("\x01"), F.col(name), F.lit("\x02"))
    size = F.length(name)
    place = F.explode(F.sequence(F.lit(1), size + 1)).alias("at")
    return df.select(name, size.alias("size"), padded.alias("_padded"), place).select(name, "size", "at", F.substr("_padded", F.col("at"), F.lit(2)).alias("gram"))


def _postings(grams: DataFrame, frequency: DataFrame, name: str, cutoff: float) -> DataFrame:
    """`key, name, size, at, then`: two grams of each text, rarest first, that a similar text has to share with it.

    Texts of n and m letters with M letters in common blocks leave D = n + m - 2M unmatched, so the blocks are D + 1 at most
    and hold M + 1 - D grams or more. The rarest two of those are among the first that remain when all but two of the
    shared ones may come last. Grams that no name has can't be shared and take no place.
    """
    share = cutoff / (2.0 - cutoff)
    other = F.sequence(F.ceil(F.col("size") * share - 1e-9).cast("int"), F.floor(F.col("size") / share + 1e-9).cast("int"))
    needed = F.array_min(F.transform(other, lambda m: 3 * _least_common(F.col("size") + m, cutoff) + 1 - F.col("size") - m))
    lists = grams.join(frequency, "gram").groupBy(name, "size").agg(F.array_sort(F.collect_list(F.struct("n", "gram", "at"))).alias("all"))
    lists = lists.withColumn("first", F.size("all") - needed + 2).filter("first >= 2")
    lists = lists.select(name, "size", F.expr("slice(all, 1, first)").alias("grams"))
    pairs = F.expr("flatten(transform(grams, (x, i) -> transform(slice(grams, i + 2, size(grams)), y -> struct(concat(x.gram, y.gram) as key, x.at as at, y.at as then))))")
    return lists.select(F.col(name), "size", F.inline(pairs))


def possible_names(parts: DataFrame, names: DataFrame, cutoff: float) -> DataFrame:
    """`part, alias`, once or more: at least the pairs whose similarity reaches the cutoff, which must be above two thirds.

    Both sides meet in an inverted index from two grams to texts. A meeting is kept if lengths allow the similarity and the
    places of the two grams leave no more unmatched letters before, between and after them than it does.
    """
    names = names.select("alias").distinct()
    named = _grams(names, "alias")
    frequency = land(named.groupBy("gram").agg(F.count(F.lit(1)).alias("n")))
    index = land(_postings(named, frequency, "alias", cutoff).withColumnsRenamed({"size": "alias_n", "at": "alias_at", "then": "alias_then"}))
    asked = _postings(_grams(parts.select("part").distinct(), "part"), frequency, "part", cutoff)

    hot = land(index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > POSTINGS).select("key", F.expr(f"cast(n div {POSTINGS} as int)").alias("deals")))
    if not hot.isEmpty():
        index = index.join(hot, "key", "left").withColumn("deal", F.coalesce(F.pmod(F.xxhash64("alias"), F.col("deals") + 1).cast("int"), F.lit(0))).drop("deals")
        asked = asked.join(hot, "key", "left").withColumn("deal", F.explode(F.sequence(F.lit(0), F.coalesce("deals", F.lit(0))))).drop("deals")
    met = asked.join(index, [c for c in ("key", "deal") if c in index.columns])

    both = F.col("size") + F.col("alias_n")
    common = _least_common(both, cutoff)
    # The two grams in order of place, in both texts.
    first, last = F.least("at", "then"), F.greatest("at", "then")
    alias_first, alias_last = F.least("alias_at", "alias_then"), F.greatest("alias_at", "alias_then")
    unmatched = F.abs(first - alias_first) + F.abs(last - first - alias_last + alias_first) + F.abs(F.col("size") - last - F.col("alias_n") + alias_last)
    kept = (F.least("size", "alias_n") >= common) & ((F.col("at") < F.col("then")) == (F.col("alias_at") < F.col("alias_then"))) & (unmatched <= both - 2 * common)
    return met.filter(kept).select("part", "alias")


def _by_letters(parts: DataFrame, names: DataFrame, cutoff: float) -> DataFrame:
    """The same for any cutoff: texts that share enough letters share one of their first letters in a common order."""
    share = cutoff / (2.0 - cutoff)

    def measured(df: DataFrame, name: str) -> DataFrame:
        out = df.select(F.col(name), F.length(name).alias(f"{name}_n"), _letters(F.col(name)).alias(f"{name}_letters"))
        shortest = F.ceil(F.col(f"{name}_n") * share - 1e-9)
        least = F.ceil((F.col(f"{name}_n") + shortest) * (cutoff / 2.0) - 1e-9)
        first = F.slice(F.col(f"{name}_letters"), F.lit(1), F.greatest(F.col(f"{name}_n") - least + 1, F.lit(1)).cast("int"))
        return out.select("*", F.explode(first).alias("letter"))

    met = measured(parts, "part").join(measured(names.select("alias"), "alias"), "letter")
    all_letters = F.col("part_n") + F.col("alias_n")
    bound = F.least(F.least("part_n", "alias_n"), F.size(F.array_intersect("part_letters", "alias_letters")))
    return met.filter(2.0 * F.least("part_n", "alias_n") >= all_letters * cutoff - 1e-9).filter(2.0 * bound >= all_letters * cutoff - 1e-9).select("part", "alias")


def similar_names(parts: DataFrame, names: DataFrame, cutoff: float) -> DataFrame:
    """`part, alias` of each distinct `part` with a name at least `cutoff` similar: the most similar, of equal ones the last.

    Above two thirds similar texts share two neighbouring pairs of letters or more, which an inverted index finds; a lower cutoff
    falls back on single letters, which meet far more pairs.
    """
    share = cutoff / (2.0 - cutoff)
    longest = names.agg(F.max(F.length("alias"))).first()[0] or 0
    near = parts.select("part").distinct().filter((F.length("part") > 0) & (F.length("part") * share <= longest + 1e-9))
    names = names.filter(F.length("alias") > 0)
    possible = (possible_names if 3 * cutoff > 2.0 else _by_letters)(near, names, cutoff).distinct()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            values = [similarity(a, p) if 2 * (Counter(a) & Counter(p)).total() >= cutoff * (len(a) + len(p)) - 1e-9 else 0.0 for p, a in pairs]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], ["part", "alias", "score"])

    scored = possible.mapInArrow(score, "part string, alias string, score double").filter(F.col("score") >= cutoff)
    return scored.groupBy("part").agg(F.max(F.struct("score", "alias")).alias("best")).select("part", "best.alias")


def resolve_addresses(
    df: DataFrame,
    aliases: DataFrame,
    regions: DataFrame,
    country: str = "norway",
    address: str = "address",
    cutoff: float | None = None,
) -> DataFrame:
    """Add region code, names, zone and the stage (1-4, 0 = none) that found them.

    1 a comma part is an alias, right-most first; 2 the word after a postal code is one (Sweden);
    3 the longest eligible name occurs as whole words; 4 a part is similar to an eligible name.
    The input is landed once, with a key for each row: rows that repeat an id, or have none, keep their own result.
    Names without a letter or digit are found by stage 1 only.
    """
    rules = RULES[country]
    aliases = land(aliases.select("alias", "code", "fuzzy_eligible"))
    row = "_row"
    while row in df.columns:
        row = f"_{row}"
    rows = land(df.withColumn(row, F.monotonically_increasing_id()))
    found = land(_named(rows.select(row, address), row, address, aliases, rules))

    place = strip(F.coalesce(F.col(address), F.lit("")))
    open_rows = rows.select(row, address).join(found.select(row), row, "left_anti")
    part = lambda p: F.lower(strip(F.regexp_replace(p, rules.postal, "")))
    parts = land(open_rows.select(row, F.posexplode(F.transform(_parts(place), part)).alias("k", "part")).filter("length(part) >= 2"))
    close = land(similar_names(parts, aliases.filter("fuzzy_eligible"), rules.cutoff if cutoff is None else cutoff))
    close = close.join(aliases.select("alias", "code"), "alias")
    fuzzy = parts.join(close, "part").groupBy(row).agg(F.min(F.struct("k", "alias", "code")).alias("hit")).select(row, "hit.alias", "hit.code", F.lit(4).alias("stage"))

    hits = found.union(fuzzy).select(row, F.col("code").alias("municipality_code"), F.col("stage").alias("match_stage"))
    out = rows.join(hits, row, "left").withColumn("match_stage", F.coalesce("match_stage", F.lit(0)))
    return with_region_names(out.select(*df.columns, "match_stage", "municipality_code"), regions, rules)


def with_region_names(df: DataFrame, regions: DataFrame, rules: AddressRules) -> DataFrame:
    """Names, region and rent zone of `municipality_code`, with the country's defaults."""
    dim = sized(regions).select(
        F.col("code").alias("municipality_code"),
        F.col("name").alias("_name"), F.col("region_code").alias("_region"),
        F.col("region_name").alias("_region_name"), F.col("rent_zone").alias("_zone"),
    )
    found = df.withColumn("municipality_code", F.coalesce("municipality_code", F.lit(rules.unknown_code)))
    joined = found.join(dim, "municipality_code", "left")
    unknown = F.col("municipality_code") == rules.unknown_code
    name = F.coalesce("_name", F.when(unknown, rules.unknown_name).otherwise(F.col("municipality_code")))
    own = [c for c in df.columns if c != "municipality_code"]
    return joined.select(
        *own,
        "municipality_code",
        name.alias("municipality_name"),
        F.lower(strip(name)).alias("municipality_clean"),
        F.coalesce("_region", F.lit(rules.unknown_region)).alias("region_code"),
        F.coalesce("_region_name", F.lit(rules.unknown_name)).alias("region_name"),
        F.coalesce("_zone", F.lit(rules.default_zone)).alias("rent_zone"),
    )

"""Filter interaction audit: what every order of a set of filters keeps, removes and would have removed.

Documents become cells first: how many of a part fail exactly which filters (a bit each). A recursive query then
extends prefixes of filters by every letter that is not in them, meets the cells of the part at each level, carries
the bits applied so far and gives that level's counts. Each prefix is worked out once for all orders that start with it.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regionscore.landing import land
from regionscore.llm.common import quoted

#: Letters name filters; every order of so many is listed.
MOST_FILTERS = 7


def mask_of(failures: dict[str, Column]) -> Column:
    """A bit for each filter that a row fails, the first filter's lowest; NULL is no failure."""
    bits = [F.when(fails, F.lit(1 << k)).otherwise(F.lit(0)) for k, fails in enumerate(failures.values())]
    return functools.reduce(operator.add, bits)


def marked(df: DataFrame, id_col: str, labels: DataFrame, good: Column, toxic: Column, label_id: str = "doc_id") -> DataFrame:
    """`df` with `good` and `toxic`: some label row of the id says so. Rows stay rows; a NULL id has no labels."""
    flags = labels.groupBy(F.col(quoted(label_id)).alias("_label_id")).agg(
        F.coalesce(F.bool_or(good), F.lit(False)).alias("_good"), F.coalesce(F.bool_or(toxic), F.lit(False)).alias("_toxic")).filter("_good or _toxic")
    kept = [F.col(quoted(c)) for c in df.columns if c.lower() not in ("good", "toxic")]
    return df.join(flags, F.col(quoted(id_col)) == F.col("_label_id"), "left").select(
        *kept, F.coalesce("_good", F.lit(False)).alias("good"), F.coalesce("_toxic", F.lit(False)).alias("toxic"))


def with_copies(rows: DataFrame, bit: int) -> DataFrame:
    """Cells `part, mask, n, good, toxic` of rows `key, digest, part, mask, good, toxic`, where a row whose digest a smaller key has fails `bit` too.

    Equal digests have equal masks. Rows of a digest are counted by part and labels before they meet, so a text that a third of
    the table shares moves as a few rows. Rows with NULL keys are nobody's copies, and nothing is a copy of them; a key that
    occurs twice is no copy of itself.
    """
    by_key = rows.groupBy("digest", "part", "good", "toxic", "key").agg(F.count("*").alias("n"), F.first("mask").alias("mask"))
    few = by_key.groupBy("digest", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.first("mask").alias("mask"), F.min(F.when(F.col("key").isNotNull(), F.struct("key", "n"))).alias("least"),
        F.coalesce(F.sum(F.when(F.col("key").isNull(), F.col("n"))), F.lit(0)).alias("keyless"))
    seen = few.withColumn("first", F.expr("min(least.key) over (partition by digest)"))
    first = F.col("keyless") + F.when(F.col("least.key") == F.col("first"), F.col("least.n")).otherwise(F.lit(0))
    both = seen.select("part", "good", "toxic", F.inline(F.array(
        F.struct(F.col("mask").alias("mask"), first.alias("n")), F.struct((F.col("mask") + F.lit(bit)).alias("mask"), (F.col("n") - first).alias("n")))))
    return cells(both)


def cells(rows: DataFrame) -> DataFrame:
    """`part, mask, n, good, toxic`: rows by part and mask; `rows` has a count `n` and truth values `good`, `toxic`."""
    return rows.filter("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("good"), F.col("n"))), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.when(F.col("toxic"), F.col("n"))), F.lit(0)).alias("toxic"))


def _sum(where: str, field: str = "n") -> str:
    return f"aggregate(c.cells, 0L, (s, x) -> s + if({where}, x.{field}, 0L))"


def levels(counted: DataFrame, letters: str) -> DataFrame:
    """Every prefix of every order: `part, prefix, step` and the counts of its last filter.

    `counted` are cells. Parts are rows of the recursion's other side, an array of cells each (two to the number of
    filters at most), so a level is one join and the rows of a level are its prefixes times parts.
    """
    if not letters or len(set(letters)) != len(letters) or len(letters) > MOST_FILTERS:
        raise ValueError(f"filters are named by one to {MOST_FILTERS} different letters")
    spark = counted.sparkSession
    parts = land(counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")))
    named = ", ".join(f"('{letter}', {1 << k})" for k, letter in enumerate(letters))
    failing, kept, now = "x.mask & f.bit <> 0", "x.mask & p.applied = 0", "x.mask & (p.applied | f.bit) = 0"
    return spark.sql(f"""
with recursive f(letter, bit) as (values {named}),
p(part, prefix, applied, step, letter, kept, removed, redundant, unique_fails, good_lost, toxic_lost) as (
  select part, '', 0, 0, '', 0L, 0L, 0L, 0L, 0L, 0L from {{parts}}
  union all
  select c.part, p.prefix || f.letter, p.applied | f.bit, p.step + 1, f.letter, {_sum(now)}, {_sum(f'{failing} and {kept}')},
    {_sum(f'{failing} and not ({kept})')}, {_sum('x.mask = f.bit')}, {_sum(f'{failing} and {kept}', 'good')}, {_sum(f'{failing} and {kept}', 'toxic')}
  from p join {{parts}} c on c.part = p.part join f on p.applied & f.bit = 0)
select * from p limit all""", parts=parts).filter("step > 0")


def orders(counted: DataFrame, letters: str) -> DataFrame:
    """A row per part, order of the filters (`filter_order`) and `step`: what stays after the step, what it removes, and so on.

    `kept, removed, redundant` (fail the step's filter, but went before), `unique_fails` (fail this filter only), `good_lost,
    toxic_lost` (removed here), `shapley` (removed by the same filter, added up over all orders). No cells give no rows.
    """
    found = land(levels(counted, letters))
    whole = found.filter(F.col("step") == len(letters)).select("part", F.col("prefix").alias("filter_order"))
    steps = whole.select("part", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
    steps = steps.withColumn("prefix", F.expr("substring(filter_order, 1, step)"))
    return steps.join(found, ["part", "prefix", "step"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
        F.expr("sum(removed) over (partition by part, letter)").alias("shapley"))


def text_failures(text: Column) -> tuple[Column, dict[str, Column]]:
    """The words of a text, and the filters A to D over columns `text` and `words`: short, repetitive, upper case, symbols."""
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    upper = F.length("text") - F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return words, {
        "A": F.size("words") < 200, "B": 100 * F.size(F.array_distinct("words")) < 50 * F.size("words"),
        "C": 100 * upper > 3 * F.length("text"), "D": F.col("text").rlike(r"[#$%&*|]")}


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """All 120 orders of the filters A to E over whole texts, by part (see `orders`); E is a copy of a smaller id's text.

    NULL texts are empty texts, NULL parts the empty part. Texts are told apart by their SHA-256; only key, digest, part and mask
    are shuffled. Documents without labels are neither good nor toxic; several label rows of an id count once. Other columns are
    left out, whatever their names; an empty table gives no rows.
    """
    text = F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit(""))
    words, failures = text_failures(F.col("text"))
    rows = docs.select(F.col(quoted(id_col)).alias("key"), F.coalesce(F.col(quoted(part_col)).cast("string"), F.lit("")).alias("part"), F.inline(F.array(F.struct(text.alias("text")))))
    rows = rows.select("key", "part", "text", F.inline(F.array(F.struct(words.alias("words")))))
    masked = rows.select("key", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask_of(failures).alias("mask"))
    known = marked(masked, "key", labels, F.col("quality") == 1, F.col("toxic") == 1)
    return orders(land(with_copies(known, 1 << len(failures))), "ABCDE")

"""Mixing sources to target weights: hierarchical token budgets and seeded epochs, in DataFrame operations only.

The leaves of a tree (domain, language, source) hold documents. A total budget goes down the tree: children share
their parent's budget by weight; what a child cannot use (its documents times the allowed epochs) goes to its
siblings by weight, and only what all of them together cannot use is missing at the parent, whose siblings then
take it. Each leaf takes its budget as a prefix of its token stream: whole epochs, then part of one more, every
epoch in an order of its own that key and seed determine. Texts are never sorted or shuffled: a leaf's part of an
epoch is stated by the order value of its last document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regionscore.landing import land
from regionscore.llm.common import free_name, quoted

WORD = r"[^\x20\x09-\x0D]+"
#: Documents of a leaf that one group of the order search holds, on average.
GROUP = 1_000
_BIG = "decimal(38,0)"


def word_count(text: Column) -> Column:
    """Words of the text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def word_prefix(text: Column, words: Column) -> Column:
    """The text up to the end of its first `words` words, white space as it is."""
    pieces = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    return F.array_join(F.slice(pieces, F.lit(1), words.cast("int")), "")


def shared(nodes: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Whole tokens of each node: `parent` columns, `name` and `budget`.

    `nodes` has, besides, the capacity `cap`, the weight `w` and the parent's budget `b`, which no parent's children
    exceed together in capacity. Nodes of no weight or capacity get nothing. Tokens left by rounding go to the
    largest remainders, then by name.
    """
    group = [F.col(p) for p in parent] or [F.lit(0)]
    near = Window.partitionBy(*group).orderBy(F.col("cap").cast("double") / F.col("w").cast("double"), name)
    whole = Window.partitionBy(*group)
    some = nodes.filter("w > 0 and cap > 0").select(*parent, name, *[F.col(c).cast(_BIG).alias(c) for c in ("cap", "w", "b")])
    before = F.coalesce(F.sum("cap").over(near.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast(_BIG)
    after = F.sum("w").over(near.rowsBetween(0, Window.unboundedFollowing)).cast(_BIG)
    some = some.withColumn("full", F.col("cap") * after <= (F.col("b") - before) * F.col("w"))
    left = F.col("b") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0)).cast(_BIG)
    some = some.withColumn("left", left.cast(_BIG)).withColumn("open", F.sum(F.when(~F.col("full"), F.col("w"))).over(whole).cast(_BIG))
    some = some.withColumn("product", F.when(~F.col("full"), (F.col("w") * F.col("left")).cast(_BIG)))
    some = some.withColumn("share", F.expr(f"cast(product div open as {_BIG})")).withColumn("rest", F.col("product") - F.col("share") * F.col("open"))
    over = F.col("left") - F.coalesce(F.sum("share").over(whole), F.lit(0))
    place = F.row_number().over(whole.orderBy("full", F.desc("rest"), name))
    some = some.withColumn("more", F.when(place <= over, 1).otherwise(0))
    budget = F.when(F.col("full"), F.col("cap")).otherwise(F.col("share") + F.col("more"))
    return some.select(*parent, name, budget.cast("bigint").alias("budget"))


def leaf_budgets(leaves: DataFrame, levels: Sequence[str], weights: Sequence[Column], part: tuple[int, int], epochs: int) -> DataFrame:
    """`levels`, `tokens`, `docs` and `budget` of every leaf.

    `leaves` has the levels, `tokens` and `docs`. `weights`: of each level, a whole number as an expression of the
    levels down to it. The total budget is the fraction `part` of all tokens; a leaf gives its tokens `epochs` times at most.
    """
    levels = list(levels)
    nodes = leaves
    for k, weight in enumerate(weights):
        nodes = nodes.withColumn(f"w{k}", F.greatest(F.coalesce(weight, F.lit(0)), F.lit(0)).cast(_BIG))
    usable = F.when(F.expr(" and ".join(f"w{k} > 0" for k in range(len(levels)))), F.col("tokens").cast(_BIG) * epochs).otherwise(0)
    nodes = nodes.withColumn("cap", usable.cast(_BIG))
    total = leaves.agg(F.expr(f"cast(coalesce(sum(tokens), 0) * {part[0]} div {part[1]} as {_BIG})").alias("b"))
    budgets = None
    for k, name in enumerate(levels):
        parent = levels[:k]
        level = nodes.groupBy(*parent, name).agg(F.sum("cap").alias("cap"), F.max(f"w{k}").alias("w"))
        if budgets is None:
            top = level.agg(F.sum("cap").alias("c")).select("c")
            level = level.withColumn("b", F.least(total.scalar(), top.scalar()))
        else:
            level = level.join(budgets.withColumnRenamed("budget", "b"), parent)
        budgets = shared(level, parent, name)
    return leaves.join(budgets, levels, "left").withColumn("budget", F.coalesce("budget", F.lit(0)).cast("bigint"))


def order_value(epoch: Column, key: Column, seed: int) -> Column:
    """Place of a row in an epoch: 60 bits of a digest of seed, epoch and key."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def plan(rows: DataFrame, levels: Sequence[str], weights: Sequence[Column], part: tuple[int, int], epochs: int, seed: int) -> DataFrame:
    """One landed row for each leaf: budget, whole epochs (`whole`), and where the epoch after them is cut.

    `rows` has the levels (no NULLs), `doc_id`, `tie` and `n_tokens`, and is read several times. Rows that agree in
    key and tie are one unit of the order; each row of the unit at the cut takes an equal part (`cut_tokens`).
    """
    levels = list(levels)
    leaves = land(rows.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")))
    budgets = leaf_budgets(leaves, levels, weights, part, epochs)
    whole = F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0)
    budgets = land(budgets.withColumn("whole", whole).withColumn("part", F.col("budget") - F.col("whole") * F.col("tokens")))

    # The cut: sums of groups of neighbours in the order, then single rows of the one group that holds the cut.
    partly = budgets.filter("part > 0").select(*levels, "whole", "part", (F.expr(f"docs div {GROUP}") + 1).alias("groups"))
    h = order_value(F.col("whole"), F.col("doc_id"), seed)
    placed = rows.join(partly, levels).withColumn("h", h)
    placed = placed.withColumn("g", F.shiftright(F.shiftright("h", 28) * F.col("groups"), 32))
    sums = placed.groupBy(*levels, "g", "part").agg(F.sum("n_tokens").alias("s"))
    upto = F.sum("s").over(Window.partitionBy(*levels).orderBy("g"))
    at = sums.withColumn("upto", upto).filter((F.col("upto") >= F.col("part")) & (F.col("upto") - F.col("s") < F.col("part")))
    at = at.select(*levels, "g", (F.col("part") - F.col("upto") + F.col("s")).alias("wanted"))
    key = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))
    units = placed.join(at, [*levels, "g"]).groupBy(*levels, "g", "wanted", "h", key.alias("k"), "tie").agg(F.sum("n_tokens").alias("s"), F.count("*").alias("n"))
    upto = F.sum("s").over(Window.partitionBy(*levels, "g").orderBy("h", "k", "tie"))
    cut = units.withColumn("upto", upto).filter((F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("s") < F.col("wanted")))
    taken = F.expr("(wanted - upto + s) div n")
    cut = cut.select(*levels, F.struct("h", "k", "tie").alias("cut"), taken.alias("cut_tokens"))
    return land(budgets.join(cut, levels, "left"))


def select(rows: DataFrame, planned: DataFrame, levels: Sequence[str], seed: int) -> DataFrame:
    """The rows that the plan takes, all columns, once for each `epoch` they are in, with `taken_tokens`.

    `rows` has the columns that `plan` needs; what else it has stays. Leaves are joined with the plan, which is
    broadcast only below Spark's own limit on its true size.
    """
    wanted = planned.filter("budget > 0").select(*levels, "whole", "part", "cut", "cut_tokens")
    joined = rows.join(wanted, list(levels))
    own = F.struct(order_value(F.col("whole"), F.col("doc_id"), seed).alias("h"), F.coalesce(F.col("doc_id"), F.lit(-(2**63))).alias("k"), F.col("tie").alias("tie"))
    last = F.when(F.col("part") <= 0, 0).when(own < F.col("cut"), F.col("n_tokens")).when(
        own == F.col("cut"), F.least("n_tokens", "cut_tokens")).otherwise(F.lit(0))
    in_last = (F.col("part") > 0) & (own <= F.col("cut"))
    whole = F.when(F.col("whole") > 0, F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("whole") - 1), lambda e: F.struct(
        e.alias("epoch"), F.col("n_tokens").alias("taken_tokens")))).otherwise(F.array().cast("array<struct<epoch:bigint,taken_tokens:bigint>>"))
    rest = F.when(in_last, F.array(F.struct(F.col("whole").alias("epoch"), last.cast("bigint").alias("taken_tokens")))).otherwise(
        F.array().cast("array<struct<epoch:bigint,taken_tokens:bigint>>"))
    kept = [c for c in joined.columns if c not in ("whole", "part", "cut", "cut_tokens")]
    return joined.select(*[F.col(quoted(c)) for c in kept], F.inline(F.concat(whole, rest)))


def mix(df: DataFrame, levels: Sequence[str], weights: Sequence[Column], part: tuple[int, int] = (1, 1), epochs: int = 4, seed: int = 0,
        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of `df` mixed to the weights, all columns, with texts cut where the budget ends inside one, and with
    `epoch` and `taken_tokens` (underscores before a name that `df` has already).

    `weights` as in `leaf_budgets`, over the columns named in `levels`. NULL counts as the level's value ''. Tokens are
    words; a NULL text has none, stays NULL, and is taken with what stands around it in its leaf's order; a leaf without tokens
    gives nothing. Repeated rows count each for itself; an empty table gives none.
    """
    made = [f"_level{k}" for k in range(len(levels))]
    text = F.col(quoted(text_col))
    own = df.select(F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("_row"), *[F.coalesce(F.col(quoted(c)).cast("string"), F.lit("")).alias(m) for c, m in zip(levels, made)],
                    F.col(quoted(id_col)).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("tie"), word_count(text).alias("n_tokens"))
    slim = land(own.drop("_row"))
    named = slim.select(*[F.col(m).alias(c) for c, m in zip(levels, made)], "doc_id", "tie", "n_tokens")
    planned = plan(named, levels, weights, part, epochs, seed).select(*[F.col(c).alias(m) for c, m in zip(levels, made)], "budget", "whole", "part", "cut", "cut_tokens")
    taken = select(own, planned, made, seed)
    cut = F.when(F.col("taken_tokens") < F.col("n_tokens"), word_prefix(F.col("_row").getField(text_col), F.col("taken_tokens"))).otherwise(F.col("_row").getField(text_col))
    return taken.select(*[cut.alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in df.columns],
                        F.col("epoch").alias(free_name(df.columns, "epoch")), F.col("taken_tokens").alias(free_name(df.columns, "taken_tokens")))

"""Ranks, average-tie percentiles, tiers and the Pareto frontier without a one-task window over rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regionscore.functions.ratios import rounded
from regionscore.landing import land
from regionscore.operators import cells
from regionscore.operators.cells import sort_by_range


def _numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    rows = sort_by_range(df, order)
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    joined = rows.join(F.broadcast(offsets), "_part")  # one row per range
    return joined.withColumn(name, F.col("_offset") + F.col("_within") + 1).drop("_within", "_offset")


def numbered(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Number all rows 1..n in the given order, which must be total (end it with a unique column).

    Spark sorts by range, so a score shared by a third of all rows is still split by the columns
    after it. The sorted table is landed with its place within each range; the offset of a range is
    the sum of the counts before it, over one row per range.
    """
    return _numbered(df, order, name).drop("_part")


def _percentile(share: Column, digits: int | None) -> Column:
    return share if digits is None else rounded(share, digits)


def percentile_rank(df: DataFrame, score: str, name: str, by: Sequence[str] = (), digits: int | None = 1) -> DataFrame:
    """Percentile with ties sharing their mean rank: (rows below + (ties + 1) / 2) / n * 100.

    Rows without a score have none and don't count; rows without a group are a group of their own. `df` is read twice: rows are
    counted by group and score, the counts are added up, and each row looks its score up (see `cells`).
    """
    return percentile_ranks(df, {score: name}, by, digits)


def percentile_ranks(df: DataFrame, scores: Mapping[str, str], by: Sequence[str] = (), digits: int | None = 1) -> DataFrame:
    """The percentiles of several scores, by the names of their columns, from one pass that counts; several are compared as doubles."""
    by = list(by)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    value = [F.struct(F.lit(s).alias("_signal"), F.col(s).cast(kinds[s] if len(scores) == 1 else "double").alias("_value")) for s in scores]
    counts = df.select(*by, F.inline(F.array(*value))).groupBy(*by, "_signal", "_value").agg(F.count(F.lit(1)).alias("n"))
    counts = land(counts)
    size, total = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
    few = size <= cells.FEW
    placed = cells.running(counts, [*by, "_signal"], ["_value"], few)
    share = (F.col("_below") + (F.col("n") + 1) / 2.0) / F.col("_all") * 100.0
    found = placed.select(*counts.columns, _percentile(share, digits).alias("_share"))
    found = found if few else land(found)
    out = df
    for score, name in scores.items():
        one = found.filter(F.col("_signal") == score).drop("_signal").withColumnsRenamed({"_value": score, "_share": name})
        kept = out.drop(name)
        out = cells.look_up(kept, one, by, score, name, (total or 0) // len(scores), few).select(*kept.columns, name)
    return out


def ranked(df: DataFrame, score: str, id_col: str, digits: int = 1) -> DataFrame:
    """Add `rank` (best score first, then by id), `percentile` (as `percentile_rank`) and the number of rows, `_n`, from one sort.

    Ties have the mean of the first and the last rank of their score, which each score's rows tell.
    """
    rows = _numbered(df, [F.col(score).desc_nulls_last(), F.col(id_col).asc()], "rank").drop("_part")
    ties = land(rows.groupBy(score).agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("_first"), F.max("rank").alias("_last")))
    size, n, known = ties.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col(score).isNotNull(), F.col("n"))), F.lit(0))).first()
    share = (F.lit(known) + 1 - (F.col("_first") + F.col("_last")) / 2.0) / F.lit(float(max(known, 1))) * 100.0
    found = ties.select(score, "n", _percentile(share, digits).alias("percentile"))
    out = cells.look_up(rows.drop("percentile"), found, [], score, "percentile", n, size <= cells.FEW)
    return out.select(*[c for c in df.columns if c not in ("rank", "percentile")], "rank", "percentile", F.lit(n).alias("_n"))


def listing_tier(rank: Column, n: Column) -> Column:
    """First fifth BUY, last fifth AVOID (at least one row each, AVOID wins), the rest HOLD."""
    fifth = F.greatest(F.floor(n / 5), F.lit(1))
    return F.when(rank > n - fifth, "AVOID").when(rank <= fifth, "BUY").otherwise("HOLD")


def region_tier(rank: Column, n: Column, top_n: int) -> Column:
    """First `top_n` rows BUY; the last `top_n // 2` AVOID, but never the first row."""
    keep = F.greatest(n - (top_n // 2), F.lit(1))
    return F.when(rank > keep, "AVOID").when(rank <= max(1, top_n), "BUY").otherwise("HOLD")


def pareto_frontier(scores: DataFrame, x: str = "yield_score", y: str = "growth_score", country: str | None = None) -> DataFrame:
    """Rows that no other row beats on one score while matching it on the other.

    One grouping on `x`, and a running maximum over its distinct values, replace the comparison of all pairs.
    The values are sorted by range: each range has a running maximum of its own, and one over the ranges before it.
    Duplicates of a frontier row stay; rows missing a score are never beaten and stay too.
    """
    rows = scores if country is None else scores.filter(F.col("country") == country)
    best = rows.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(x).agg(F.max(y).alias("_best"))
    best = sort_by_range(best, [F.col(x).desc()])
    ranges = best.groupBy("_part").agg(F.max("_best").alias("_top"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("_part", F.max("_top").over(before).alias("_over"))
    here = Window.partitionBy("_part").orderBy("_within").rowsBetween(Window.unboundedPreceding, -1)
    edge = best.join(F.broadcast(ranges), "_part")  # one row per range
    edge = edge.select(x, "_best", F.greatest("_over", F.max("_best").over(here)).alias("_above"))
    edge = land(edge.filter(F.col("_above").isNull() | (F.col("_best") > F.col("_above"))).select(x, "_best"))
    joined = rows.join(edge, x, "left")
    unknown = F.col(x).isNull() | F.col(y).isNull()
    kept = joined.filter(unknown | (F.col(y) == F.col("_best")))
    return kept.select(*scores.columns, F.lit(True).alias("pareto_optimal"))

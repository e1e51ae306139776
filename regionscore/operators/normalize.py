"""Exact and approximate medians, and min-max scaling, that hold at any size.

`median` and `percentile` in Spark gather every distinct value of a group in one task. The exact median here takes two
passes: a mergeable quantile sketch gives two values around the middle, and an exact pass counts what is below them and
keeps the few values between them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regionscore.landing import land, land_observed
from regionscore.operators import cells

#: The sketch is off by at most n / ACCURACY ranks; the bracket reaches twice as far on both sides of the middle.
ACCURACY = 1000


def _clean(column: str) -> Column:
    """The column as a double, NaN as NULL."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None))


def approximate_median(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), accuracy: int = 10_000) -> DataFrame:
    """A value of each column, per group, whose rank is off the middle by n / `accuracy` at most, from one pass.

    Columns without any value give NULL.
    """
    return df.groupBy(*by).agg(*[F.percentile_approx(_clean(c), F.lit(0.5), F.lit(accuracy)).alias(c) for c in columns])


def exact_median(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), rows: int | None = None) -> DataFrame:
    """Exact median of each column, per group: the mean of the two middle values if n is even.

    Reads `df` twice, so give it a landed or otherwise cheap input (once and at the end if `rows`, how many it has, is small). Groups
    in `by` must not be NULL. Columns without any value give NULL.
    """
    key = [*by, "signal"]
    values = df.select(*by, *[_clean(c).alias(c) for c in columns]).unpivot(list(by), list(columns), "signal", "v").filter("v is not null")
    if rows is not None and rows * len(columns) <= cells.FEW:
        counts = values.groupBy(*key, F.lit(0).alias("zone"), "v").agg(F.count(F.lit(1)).alias("n"))
        middle = _middle(counts, key, True)
    else:
        middle = _bracketed(df, values, columns, by)
    wide = [F.avg(F.when(F.col("signal") == c, F.col("v"))).alias(c) for c in columns]
    return middle.groupBy(*by).agg(*wide)


def _bracketed(df: DataFrame, values: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The middle cells of `values`; of those whose bracket missed them, should there be any, from all distinct values."""
    key = [*by, "signal"]
    around = F.array(F.lit(0.5 - 2 / ACCURACY), F.lit(0.5 + 2 / ACCURACY))
    sketched = df.groupBy(*by).agg(*[F.percentile_approx(_clean(c), around, F.lit(ACCURACY)).alias(c) for c in columns])
    if by:
        brackets = land(sketched.unpivot(list(by), list(columns), "signal", "_ends"))
        values = values.join(brackets, key)
    else:
        ends = {c: e for c, e in sketched.first().asDict().items() if e}
        chosen = F.lit(None).cast("array<double>")
        for c, (low, high) in ends.items():
            chosen = F.when(F.col("signal") == c, F.array(F.lit(float(low)), F.lit(float(high)))).otherwise(chosen)
        values = values.withColumn("_ends", chosen)
    low, high = F.get("_ends", F.lit(0)), F.get("_ends", F.lit(1))
    zone = F.when(F.col("v") < low, -1).when(F.col("v") > high, 1).otherwise(0)
    placed = values.select(*key, zone.alias("zone"), "v").withColumn("v", F.when(F.col("zone") == 0, F.col("v")))
    counts = land(placed.groupBy(*key, "zone", "v").agg(F.count(F.lit(1)).alias("n")))
    middle = land(_middle(counts, key, counts.count() <= cells.FEW))
    missed = middle.filter("zone <> 0").select(*key).distinct()
    if missed.isEmpty():
        return middle
    counts = land(values.join(missed, key, "left_semi").groupBy(*key, F.lit(0).alias("zone"), "v").agg(F.count(F.lit(1)).alias("n")))
    again = _middle(counts, key, counts.count() <= cells.FEW)
    return middle.join(missed, key, "left_anti").unionByName(again)


def _middle(counts: DataFrame, key: list[str], few: bool) -> DataFrame:
    """`key, zone, v, n` of the one or two cells that hold the middle ranks, once for each rank."""
    counts = counts.withColumn("_some", F.lit(True))
    placed = cells.running(counts, key, ["zone", "v", "_some"], few)
    ranks = F.array((F.col("_all") + 1) / 2, F.col("_all") / 2 + 1)
    rank = placed.select("*", F.explode(F.array_distinct(F.transform(ranks, lambda r: F.floor(r)))).alias("_rank"))
    return rank.filter((F.col("_rank") > F.col("_below")) & (F.col("_rank") <= F.col("_below") + F.col("n"))).select(*key, "zone", "v", "n")


def scaled(value: Column, low: Column, high: Column, invert: bool = False) -> Column:
    """Position of `value` between `low` and `high`; a constant or empty signal scores 0.5."""
    position = F.try_divide(value - low, high - low)
    if invert:
        position = 1.0 - position
    return F.when(low == high, F.lit(0.5)).otherwise(F.coalesce(position, F.lit(0.5)))


def _limits(df: DataFrame, signals: Sequence[str]) -> list[Column]:
    out = [F.count(F.lit(1)).alias("n")]
    for s in signals:
        clean = _clean(s)
        out += [F.count_if(clean.isNull()).alias(f"{s}__null"), F.min(clean).alias(f"{s}__min"), F.max(clean).alias(f"{s}__max")]
    return out


def signal_stats(df: DataFrame, signals: Sequence[str]) -> dict[str, float | int | None]:
    """Rows (`n`), and per signal missing values, minimum, maximum and, where values are missing, median.

    Only the signals are landed, and all but the medians comes from the pass that writes them. Filling gaps with the median changes
    neither minimum nor maximum; medians are worked out only for signals that have gaps.
    """
    rows, stats = land_observed(df.select(*signals), _limits(df, signals))
    gaps = [s for s in signals if stats[f"{s}__null"] and stats[f"{s}__min"] is not None]
    medians = exact_median(rows, gaps, rows=stats["n"]).first().asDict() if gaps else {}
    return {**stats, **{f"{s}__median": medians.get(s) for s in signals}}


def group_stats(df: DataFrame, signals: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The same per group, as a landed table with one row per group."""
    stats = land(df.groupBy(*by).agg(*_limits(df, signals)))
    totals = stats.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("_rows"), *[
        F.bool_or((F.col(f"{s}__null") > 0) & F.col(f"{s}__min").isNotNull()).alias(s) for s in signals]).first()
    gaps = [s for s in signals if totals[s]]
    if gaps:
        medians = exact_median(df, gaps, by, totals["_rows"])
        stats = land(stats.join(medians.select(*by, *[F.col(s).alias(f"{s}__median") for s in gaps]), list(by), "left"))
    return stats.select("*", *[F.lit(None).cast("double").alias(f"{s}__median") for s in signals if s not in gaps])


def minmax(df: DataFrame, signals: dict[str, bool], by: Sequence[str] = (), suffix: str = "_norm") -> DataFrame:
    """Add a [0, 1] column per signal (True = inverted), over all rows or within groups.

    Gaps are filled with the median of the rows or group first. `df` is read more than once.
    """
    limits = [f"{s}__{k}" for s in signals for k in ("min", "max", "median")]
    if by:
        joined = df.join(group_stats(df, list(signals), by).select(*by, *limits), list(by), "left")
        limit = {c: F.col(c) for c in limits}
    else:
        stats = signal_stats(df, list(signals))
        joined, limit = df, {c: F.lit(stats[c]).cast("double") for c in limits}

    def norm(s: str, invert: bool) -> Column:
        value = F.coalesce(_clean(s), limit[f"{s}__median"])
        return scaled(value, limit[f"{s}__min"], limit[f"{s}__max"], invert).alias(s + suffix)

    return joined.select(*df.columns, *[norm(s, invert) for s, invert in signals.items()])


def minmax_unfilled(df: DataFrame, value: str, name: str) -> DataFrame:
    """Min-max over all rows without filling gaps; a constant column scores 0.5."""
    row = df.agg(F.min(value).cast("double"), F.max(value).cast("double")).first()
    low, high = (F.lit(x).cast("double") for x in row)
    position = F.when(high > low, F.try_divide(F.col(value) - low, high - low)).otherwise(F.lit(0.5))
    return df.withColumn(name, position)

"""Counts of distinct values (cells), their running sums, and rows that look their cell up, at any size.

Counts merge: every task adds up what it reads, so a value that a third of all rows share moves as one row per task.
Few cells are summed up in a window and broadcast. More are sorted by range, each range adds up its own and starts where
the ranges before it end; rows then meet them by a shuffle in which values of many rows, and missing ones, take no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regionscore.landing import land

#: Cells that one window may add up and one broadcast may hold.
FEW = 100_000
#: A value with more than this share of all rows is looked up by a broadcast of such values, of which there are fewer than 1000.
HOT = 1000
# monotonically_increasing_id keeps the row number of a partition in its lower 33 bits.
ROW_BITS = 33


def sort_by_range(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The table landed in the given order, with the range `_part` a row is in and its place there, `_within` (from 0)."""
    landed = land(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()))
    within = F.col("_place").bitwiseAND(F.lit(2**ROW_BITS - 1))
    return landed.select("*", F.shiftright("_place", ROW_BITS).alias("_part"), within.alias("_within")).drop("_place")


def running(cells: DataFrame, by: Sequence[str], value: Sequence[str], few: bool) -> DataFrame:
    """`cells` (`by`, `value`, `n`) with `_below`, the sum of `n` over smaller values of the group, and `_all`, over all that aren't NULL.

    NULL values come last in their group.
    """
    order, known = [F.col(v).asc_nulls_last() for v in value], F.when(F.col(value[-1]).isNotNull(), F.col("n"))
    if few:
        group = Window.partitionBy(*by)
        before = group.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return cells.select("*", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_below"), F.sum(known).over(group).alias("_all"))
    rows = sort_by_range(cells, [*[F.col(c).asc_nulls_first() for c in by], *order])
    parts = rows.groupBy("_part").agg(F.sum("n").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    here = Window.partitionBy("_part").orderBy("_within").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(F.broadcast(parts), "_part")  # one row per range
    rows = land(rows.select(*cells.columns, (F.col("_start") + F.coalesce(F.sum("n").over(here), F.lit(0))).alias("_before")))
    groups = rows.groupBy(*by).agg(F.min("_before").alias("_first"), F.sum(known).alias("_all"))
    if by:
        rows = join_null_safe(rows, groups, by, ["_first", "_all"])
    else:
        first, total = groups.first()
        rows = rows.select("*", F.lit(first).alias("_first"), F.lit(total).alias("_all"))
    return rows.select(*cells.columns, (F.col("_before") - F.col("_first")).alias("_below"), "_all")


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], add: Sequence[str], *more: Column) -> DataFrame:
    """Left join in which NULL keys meet, with the columns `add` of the right side; `more` conditions on the struct `_other`."""
    other = right.select(F.struct(*keys).alias("_other"), *add)
    agree = list(more)
    for k in keys:
        agree.append(left[k].eqNullSafe(F.col("_other").getField(k)))
    return left.join(other, agree, "left").drop("_other")


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return _hashable(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, (T.MapType, T.VariantType))


def look_up(df: DataFrame, cells: DataFrame, by: Sequence[str], value: str, add: str, total: int, few: bool) -> DataFrame:
    """`df` with the column `add` of the cell that has its group (NULL is a group) and its value; NULL values get NULL.

    `cells` (`by`, `value`, `n`, `add`) has one row for each. `total` is the sum of `n`. Unless there are few, cells of more than
    a thousandth of all rows, fewer than a thousand, are broadcast; the rows that they serve, and those without a value, are dealt
    out evenly, and the rest meets its cells by group and value.
    """
    keys = [*by, value]
    cells = cells.filter(F.col(value).isNotNull())
    if few:
        return join_null_safe(df, F.broadcast(cells), keys, [add])
    hot = cells.filter(F.col("n") * HOT > total).select(*keys, F.col(add).alias("_hot"))
    rows = join_null_safe(df, F.broadcast(hot), keys, ["_hot"])
    done = F.col("_hot").isNotNull() | F.col(value).isNull()
    columns = [F.col(f"`{f.name}`") for f in df.schema.fields if _hashable(f.dataType)]
    rows = rows.withColumn("_deal", F.when(done, 1 + F.pmod(F.xxhash64(*columns), F.lit(1 << 30))).otherwise(F.lit(0)).cast("bigint"))
    rows = join_null_safe(rows, cells.withColumn("_deal", F.lit(0).cast("bigint")), [*keys, "_deal"], [add])
    return rows.select(*df.columns, F.coalesce("_hot", add).alias(add))

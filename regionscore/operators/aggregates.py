"""Region-level aggregates: concentration, supply pressure, roll-ups, latest rows, quality counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regionscore.functions.ratios import pct_change, ratio, rounded
from regionscore.landing import sized

# Industry codes that hold totals.
TOTAL_CODES = ("00-99", "00", "ALLE")


def mean_by(df: DataFrame, keys: Sequence[str], value: str, name: str | None = None) -> DataFrame:
    keyed = df.filter(F.col(keys[0]).isNotNull())
    return keyed.groupBy(*keys).agg(F.avg(value).alias(name or value))


def sum_by(df: DataFrame, keys: Sequence[str], value: str, name: str | None = None) -> DataFrame:
    """Group sum; a group without any value sums to 0."""
    keyed = df.filter(F.col(keys[0]).isNotNull())
    total = F.coalesce(F.sum(value), F.lit(0.0))
    return keyed.groupBy(*keys).agg(total.cast("double").alias(name or value))


def doubled_population(half: DataFrame, key: str, value: str) -> DataFrame:
    """Population from the counts of one sex."""
    total = F.coalesce(F.sum(value), F.lit(0.0)) * 2
    return half.filter(F.col(key).isNotNull()).groupBy(key).agg(rounded(total, 0).alias("population"))


def concentration(
    df: DataFrame,
    key: str,
    part: str,
    value: str,
    exclude: Sequence[str] = TOTAL_CODES,
    digits: int | None = 4,
) -> DataFrame:
    """Herfindahl index and the share of the three largest parts, per key.

    The first grouping is by (key, part), so the second one and the window see one row per part
    of a key. Keys whose parts sum to nothing are dropped.
    """
    rows = df.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
    if exclude:
        rows = rows.filter(~F.coalesce(F.col(part).isin(*exclude), F.lit(False)))
    parts = rows.groupBy(key, part).agg(F.sum(F.col(value).cast("double")).alias("_x"))
    largest = Window.partitionBy(key).orderBy(F.col("_x").desc(), F.col(part))
    ranked = parts.withColumn("_rn", F.row_number().over(largest))
    x = F.col("_x")
    total = F.sum(x)
    hhi = ratio(F.sum(x * x), total * total)
    top3 = ratio(F.sum(F.when(F.col("_rn") <= 3, x)), total) * 100.0
    return (
        ranked.groupBy(key)
        .agg(
            (hhi if digits is None else rounded(hhi, digits)).alias("employment_hhi"),
            rounded(top3, 1).alias("top3_industry_share"),
            total.alias("_total"),
        )
        .filter(F.col("_total") > 0)
        .drop("_total")
    )


def permit_windows(permits: DataFrame, key: str, period: str = "quarter", value: str = "permits") -> DataFrame:
    """Permits of the last four quarters, of all quarters, and the change between the two halves.

    Quarters are counted over the whole table, so every key is compared over the same time. With
    fewer than eight quarters there is no momentum and all permits count as recent.
    """
    by_quarter = sum_by(permits, [key, period], value, "_p")
    quarters = permits.select(period).filter(F.col(period).isNotNull()).distinct()
    newest = quarters.select(
        period,
        F.row_number().over(Window.orderBy(F.col(period).desc())).alias("_age"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("_quarters"),
    )
    full = F.col("_quarters") >= 8
    sums = (
        by_quarter.join(sized(newest), period)  # one row per quarter of the calendar
        .groupBy(key)
        .agg(
            F.max("_quarters").alias("_quarters"),
            F.sum("_p").alias("total_permits_2y"),
            F.coalesce(F.sum(F.when(F.col("_age") <= 4, F.col("_p"))), F.lit(0.0)).alias("_recent"),
            F.coalesce(
                F.sum(F.when((F.col("_age") > 4) & (F.col("_age") <= 8), F.col("_p"))), F.lit(0.0)
            ).alias("_prior"),
        )
    )
    prior = F.when(F.col("_prior") > 0, F.col("_prior"))
    momentum = F.when(full, pct_change(F.col("_recent"), prior))
    return sums.select(
        key,
        "total_permits_2y",
        F.when(full, F.col("_recent")).otherwise(F.col("total_permits_2y")).alias("recent_permits_1y"),
        rounded(momentum, 1).alias("permit_momentum"),
    )


def supply_pressure(
    permits: DataFrame, population: DataFrame, key: str, period: str = "quarter"
) -> DataFrame:
    """Recent permits per 1000 inhabitants and permit momentum. `population` is unique per key."""
    flows = permit_windows(permits, key, period)
    joined = flows.join(population.select(key, "population"), key, "left")
    per_1000 = ratio(F.col("recent_permits_1y"), F.col("population") / 1000.0)
    return joined.select(key, rounded(per_1000, 2).alias("permits_per_1000"), "permit_momentum")


def last_step_momentum(df: DataFrame, key: str, period: str, value: str) -> DataFrame:
    """Total per key and the change from the last but one to the last period, per period sums."""
    sums = sum_by(df.filter(F.col(value).isNotNull()), [key, period], value, "_p")
    w = Window.partitionBy(key).orderBy(period)
    steps = sums.withColumn("_prev", F.lag("_p", 1).over(w))
    latest = F.max_by("_p", period)
    prev = F.max_by(F.struct(F.col("_prev").alias("v")), F.col(period)).getField("v")
    return steps.groupBy(key).agg(
        F.sum("_p").alias("permits_raw"),
        pct_change(latest, F.when(prev > 0, prev)).alias("permit_momentum"),
    )


def latest_non_null(df: DataFrame, keys: Sequence[str], period: str, columns: Sequence[str]) -> DataFrame:
    """Per key the last known value of every column, each taken on its own."""
    known = df
    for k in keys:
        known = known.filter(F.col(k).isNotNull())
    picks = [
        F.max_by(c, F.when(F.col(c).isNotNull(), F.col(period))).alias(c) for c in columns
    ]
    return known.groupBy(*keys).agg(*picks)


def first_by_key(df: DataFrame, key: str, order: str, columns: Sequence[str]) -> DataFrame:
    """One row per key: the row with the smallest `order`. A partial aggregate, so hot keys are cheap."""
    row = F.min_by(F.struct(*columns), F.col(order)).alias("_row")
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(row).select(key, "_row.*")


def county_rollup(df: DataFrame, county: str, level: str, yearly_growth: str) -> DataFrame:
    """Index signals per county from yearly growth: a quarter of its mean and of its deviation."""
    spread = F.coalesce(F.stddev_samp(yearly_growth), F.lit(0.0))
    return df.filter(F.col(county).isNotNull()).groupBy(county).agg(
        F.avg(level).alias("latest_index"),
        (F.avg(yearly_growth) / 4.0).alias("index_momentum_qoq"),
        (spread / 4.0).alias("volatility_qoq"),
    )


def quality_report(df: DataFrame, signals: Sequence[str], unmapped: str = "0000") -> DataFrame:
    """One row per signal: rows, missing values, whether more than a fifth is missing, unmapped rows."""
    present = [s for s in signals if s in df.columns]
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        (F.count_if(F.col("municipality_code") == unmapped) if "municipality_code" in df.columns
         else F.lit(0).cast("long")).alias("unmapped"),
        *[F.count_if(F.col(s).isNull()).alias(f"null_{s}") for s in present],
    )
    rows = F.array(*[F.struct(F.lit(s).alias("signal"), F.col(f"null_{s}").alias("n_null")) for s in present])
    flat = counts.select("n", "unmapped", F.explode(rows).alias("r")).select("r.signal", "n", "r.n_null", "unmapped")
    warn = F.coalesce(F.try_divide(F.col("n_null"), F.col("n")) > 0.2, F.lit(False))
    return flat.select("signal", "n", "n_null", "unmapped", warn.alias("warn"))

"""Growth, momentum, volatility and trends over (key, period) tables.

Every input has one row per key and period, so a window over one key is as long as the calendar,
not as long as the source: aggregate the source to that grain first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regionscore.functions.ratios import annualised_pct, pct_change, ratio, rounded


def latest_periods(df: DataFrame, period: str, n: int) -> DataFrame:
    """Rows of the `n` latest distinct periods."""
    latest = df.select(period).distinct().orderBy(F.col(period).desc()).limit(n)
    return df.filter(F.col(period) >= latest.agg(F.min(period)).scalar())


def _maybe_round(col: Column, digits: int | None) -> Column:
    return col if digits is None else rounded(col, digits)


def growth(
    df: DataFrame,
    key: str | Sequence[str],
    period: str,
    value: str,
    names: Sequence[str] = ("growth_1y", "growth_3y", "latest"),
    min_rows: int = 2,
    lag_long: int = 3,
    digits: int | None = 2,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Latest value per key, its change to the previous row and the annualised long change.

    Steps are positional: "one year back" is the previous row that exists. Keys with fewer than
    `min_rows` rows are dropped; too short a history gives NULL for the long change.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(period)
    v = F.col(value)
    rows = df.dropna(subset=keys).select(
        *keys,
        *keep,
        v.alias("_now"),
        F.lag(v, 1).over(w).alias("_prev"),
        F.lag(v, lag_long).over(w).alias("_base"),
        F.row_number().over(w).alias("_n"),
        F.lead(F.lit(1), 1).over(w).alias("_next"),
    )
    last = rows.filter(F.col("_next").isNull() & (F.col("_n") >= min_rows))
    one, long, latest = names
    prev = F.when(F.col("_prev") > 0, F.col("_prev"))
    return last.select(
        *keys,
        *keep,
        _maybe_round(pct_change(F.col("_now"), prev), digits).alias(one),
        _maybe_round(annualised_pct(F.col("_now"), F.col("_base"), lag_long), digits).alias(long),
        F.col("_now").alias(latest),
    )


def index_signals(
    df: DataFrame, key: str = "region_code", period: str = "quarter", value: str = "index_value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Latest quarterly change, population deviation of the changes (two or more) and last level."""
    w = Window.partitionBy(key).orderBy(period)
    before = F.lag(value, 1).over(w)
    steps = df.select(
        key, period, *keep, F.col(value).alias("_v"),
        (ratio(F.col(value) - before, before) * 100.0).alias("_qoq"),
    )
    return (
        steps.groupBy(key)
        .agg(
            *[F.max_by(c, period).alias(c) for c in keep],
            rounded(F.max_by("_qoq", period), 2).alias("index_momentum_qoq"),
            rounded(F.when(F.count("_qoq") > 1, F.stddev_pop("_qoq")), 2).alias("volatility_qoq"),
            F.max_by("_v", period).alias("latest_index"),
            F.count(F.lit(1)).alias("_n"),
        )
        .filter(F.col("_n") >= 2)
        .drop("_n")
    )


def last_observations(df: DataFrame, key: Sequence[str], period: str, n: int) -> DataFrame:
    """The `n` latest rows of every series, numbered from the end in `from_end` (1 = latest)."""
    w = Window.partitionBy(*key).orderBy(F.col(period).desc())
    return df.withColumn("from_end", F.row_number().over(w)).filter(F.col("from_end") <= n)


def rate_trend(df: DataFrame, period: str, value: str, back: int = 11, by: Sequence[str] = ()) -> DataFrame:
    """One row, or one per group: the latest value and its difference to the row `back` places earlier."""
    group = [F.col(c) for c in by] or [F.lit(0)]
    latest = Window.partitionBy(*group).orderBy(F.col(period).desc())
    numbered = df.withColumn("_rn", F.row_number().over(latest)).filter(F.col("_rn") <= back + 1)
    now = F.max(F.when(F.col("_rn") == 1, F.col(value)))
    then = F.max(F.when(F.col("_rn") == back + 1, F.col(value)))
    return numbered.groupBy(*by).agg(
        now.alias("mortgage_rate_current"), (now - then).alias("mortgage_rate_trend")
    )


def _value_at(series: str, from_end: int) -> Column:
    hit = (F.col("series_key") == series) & (F.col("from_end") == from_end)
    return F.max(F.when(hit, F.col("value")))


def macro_signals(series: DataFrame, history: int = 120) -> DataFrame:
    """Seven macro signals per country from a long table (country, series_key, obs_date, value).

    Series keys are `rate`, `money` and `bond`. The trend compares the latest rate with the last
    one observed at least 180 days earlier (0 when there is none); the percentile is the share of
    the kept history strictly below the latest rate; acceleration is the growth of the last six
    rows less the growth of the six rows before.
    """
    known = series.filter(F.col("value").isNotNull() & F.col("country").isNotNull())
    tail = last_observations(known, ["country", "series_key"], "obs_date", history)
    all_rows = Window.partitionBy("country", "series_key")
    tail = tail.select(
        "*",
        F.max("obs_date").over(all_rows).alias("_last_date"),
        F.max(F.when(F.col("from_end") == 1, F.col("value"))).over(all_rows).alias("_current"),
    )
    is_rate = F.col("series_key") == "rate"
    past = is_rate & (F.col("obs_date") <= F.col("_last_date") - F.expr("INTERVAL 180 DAYS"))
    raw = tail.groupBy("country").agg(
        _value_at("rate", 1).alias("r1"),
        F.max_by("value", F.when(past, F.col("obs_date"))).alias("r_past"),
        F.avg(F.when(is_rate, (F.col("value") < F.col("_current")).cast("double"))).alias("r_pct"),
        _value_at("money", 1).alias("m1"),
        _value_at("money", 7).alias("m7"),
        _value_at("money", 13).alias("m13"),
        _value_at("bond", 1).alias("b1"),
    )
    recent = pct_change(F.col("m1"), F.col("m7"))
    prior = pct_change(F.col("m7"), F.col("m13"))
    rate_now = rounded(F.col("r1"), 3)
    trend = F.when(F.col("r1").isNotNull(), F.coalesce(F.col("r1") - F.col("r_past"), F.lit(0.0)))
    return raw.select(
        "country",
        rate_now.alias("nibor_current"),
        rounded(trend, 3).alias("nibor_trend_6m"),
        rounded(F.col("r_pct"), 3).alias("nibor_percentile_10y"),
        rounded(pct_change(F.col("m1"), F.col("m13")), 2).alias("m3_yoy_growth"),
        rounded(recent - prior, 2).alias("m3_acceleration"),
        rounded(F.col("b1"), 3).alias("bond_yield_10y"),
        rounded(F.col("b1") - rate_now, 3).alias("yield_curve_spread"),
    )

"""Guarded arithmetic: a zero or missing divisor gives NULL, never an error or infinity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(col: Column, digits: int) -> Column:
    """Round half to even on the scaled value; adding 0.0 turns -0.0 into 0.0."""
    scale = float(10**digits)
    return F.rint(col * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def ratio(top: Column, bottom: Column) -> Column:
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def pct_change(now: Column, before: Column) -> Column:
    return (ratio(now, before) - 1.0) * 100.0


def annualised_pct(now: Column, before: Column, years: int) -> Column:
    """Yearly growth over `years`; NULL unless the base is positive."""
    base = F.when(before > 0, before)
    power = F.lit(1.0) / F.lit(float(years))
    return (F.pow(ratio(now, base), power) - 1.0) * 100.0


def gross_yield(annual_rent: Column, price: Column) -> Column:
    return ratio(annual_rent, price) * 100.0


def oversupply(completion: Column) -> Column:
    """Completion ratio clamped to 0..2 (missing = 1), only the part above 1."""
    clamped = F.least(F.greatest(F.coalesce(completion, F.lit(1.0)), F.lit(0.0)), F.lit(2.0))
    return F.greatest(clamped - 1.0, F.lit(0.0))


def risk_label(risk: Column) -> Column:
    """Three risk classes; an unknown risk is labelled like a high one."""
    return F.when(risk < 0.33, "Low").when(risk < 0.66, "Medium").otherwise("High")


def truthy(col: Column) -> Column:
    """Zero counts as missing."""
    return F.nullif(col, F.lit(0))

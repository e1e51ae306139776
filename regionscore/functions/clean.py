"""Text keys, codes and localised numbers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Suffixes that mark regions abolished by a reform.
HISTORICAL_NAME = r"\(-\d{4}\)|\(\d{4}-\d{4}\)"

NBSP = "\u00a0"
THIN_SPACE = "\u2009"
WHITE_SPACE = " \t\n\r\x0b\f\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(col: Column) -> Column:
    """Trim every kind of white space at both ends."""
    return F.btrim(col, F.lit(WHITE_SPACE))


def name_key(col: Column, drop_suffix: bool = True) -> Column:
    """Join key of a region name: lower case, without `(...)` and ` - second name`."""
    if drop_suffix:
        col = F.regexp_replace(col, r"\s*\(.*\)$", "")
        col = F.regexp_replace(col, r"\s*-\s+\S+$", "")
    return F.lower(strip(col))


def is_historical(col: Column) -> Column:
    return F.coalesce(col.rlike(HISTORICAL_NAME), F.lit(False))


def current_regions(df: DataFrame, name: str) -> DataFrame:
    """Keep regions that still exist; rows without a name are kept."""
    return df.filter(~is_historical(F.col(name)))


def pad_code(col: Column, width: int = 4) -> Column:
    """Left-pad a code with zeros; longer codes stay whole."""
    code = col.cast("string")
    return F.when(F.length(code) < width, F.lpad(code, width, "0")).otherwise(code)


def county_of(code: Column) -> Column:
    return F.substring(code, 1, 2)


def zone_key(col: Column) -> Column:
    """`5.0` -> `5.00`; a key without a dot stays as it is."""
    text = col.cast("string")
    whole = F.substring_index(text, ".", 1)
    digits = F.substr(text, F.length(whole) + F.lit(2))
    padded = F.when(F.length(digits) < 2, F.rpad(digits, 2, "0")).otherwise(digits)
    return F.when(F.contains(text, F.lit(".")), F.concat(whole, F.lit("."), padded)).otherwise(text)


def to_number(col: Column) -> Column:
    """Double, or NULL when the value is not a number (NaN counts as none)."""
    return F.nanvl(col.try_cast("double"), F.lit(None))


def _digits(text: Column) -> Column:
    kept = F.regexp_replace(text, r"[^0-9,.\-]", "")
    return to_number(F.replace(kept, F.lit(","), F.lit(".")))


def number_no(text: Column) -> Column:
    """`3 500 000 kr` -> 3500000.0; every digit of the text counts, units included."""
    return _digits(F.translate(text, NBSP + " ", ""))


def number_se(text: Column) -> Column:
    """`12 500 kr/mån` -> 12500.0; the text is cut at `kr`, `/` and `m` first."""
    text = F.translate(text, NBSP + THIN_SPACE + " ", "")
    for stop in ("kr", "/", "m"):
        text = F.substring_index(text, stop, 1)
    return _digits(text)


def alias_variant_no(name: Column) -> Column:
    """Lower name with everything but letters, digits and spaces dropped."""
    return strip(F.regexp_replace(F.lower(name), r"[^a-zæøå0-9 ]", ""))


def alias_variant_se(name: Column) -> Column:
    """Lower name with local letters written in ASCII and hyphens as spaces."""
    return strip(F.translate(F.lower(name), "åäö-", "aao "))

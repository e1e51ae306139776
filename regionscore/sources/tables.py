"""Files in and out: records, series, named tables, region dimensions, exports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException


def write_records(df: DataFrame, path: str) -> None:
    """One JSON record per line."""
    df.write.mode("overwrite").json(path)


def read_records(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Records with a declared schema, so that codes such as `0301` stay text."""
    return spark.read.schema(schema).json(path)


def series_to_long(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Parallel `dates` and `values` arrays to rows (obs_date, value); missing values are dropped."""
    pair = F.explode(F.arrays_zip("dates", "values")).alias("p")
    rows = docs.select(*keep, pair)
    value = F.nanvl(F.col("p.values").cast("double"), F.lit(None)).alias("value")
    return rows.select(*keep, F.to_date("p.dates").alias("obs_date"), value).filter(F.col("value").isNotNull())


def load_table(spark: SparkSession, folder: str, name: str, schema: T.StructType | str) -> DataFrame:
    """The named parquet table of a folder, or an empty frame when there is none."""
    try:
        return spark.read.parquet(f"{folder}/{name}.parquet")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def load_regions(spark: SparkSession, path: str, country: str) -> DataFrame:
    """Region dimension (code, name, region_code, region_name, rent_zone) from its JSON document."""
    item = "code string, name string, region_code string, region_name string, county string, county_name string, rent_zone string"
    docs = spark.read.schema(f"municipalities array<struct<{', '.join(c.replace(' ', ':', 1) for c in item.split(', '))}>>").json(path, multiLine=True)
    rows = docs.select(F.explode("municipalities").alias("m")).select("m.*")
    return region_dimension(rows, country)


def region_dimension(rows: DataFrame, country: str) -> DataFrame:
    """Same columns for both countries; a region without a rent zone gets the country's default."""
    code, name, zone = ("region_code", "region_name", "99") if country == "norway" else ("county", "county_name", "7.00")
    return rows.select(
        "code", "name", F.col(code).alias("region_code"), F.col(name).alias("region_name"),
        F.coalesce("rent_zone", F.lit(zone)).alias("rent_zone"),
    )


def union_ragged(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of frames with different columns; a column that a frame lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_columns_in_order(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of `schema`, in its order; missing ones are NULL."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ])


def select_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])


def export_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """The listed columns that exist, in order, with a header."""
    out = df if columns is None else select_present(df, columns)
    out.write.mode("overwrite").option("header", True).csv(path)


# Columns of the listing exports.
EXPORT_NO = (
    "rank", "recommendation", "composite_score", "yield_score", "growth_score", "risk_score", "risk_label",
    "listing_id", "url", "title", "address", "municipality_name", "region_name",
    "asking_price", "total_price_calc", "sqm", "price_per_sqm",
    "property_type", "ownership_type", "bedrooms", "year_built", "common_costs_monthly", "fellesgjeld",
    "gross_yield_pct", "estimated_monthly_rent", "price_growth_1y", "price_growth_3y",
    "wage_growth_1y", "latest_wage", "permits_per_1000", "permit_momentum",
    "debt_burden_pct", "employment_hhi", "population",
)
EXPORT_SE = (
    "rank", "recommendation", "composite_score", "yield_score", "growth_score", "risk_score", "risk_label",
    "listing_id", "url", "title", "address", "municipality_name", "region_name",
    "asking_price", "total_price_calc", "sqm", "price_per_sqm",
    "property_type", "ownership_type", "rooms", "year_built", "common_costs_monthly", "monthly_fee",
    "gross_yield_pct", "estimated_monthly_rent", "price_growth_1y", "price_growth_3y",
    "wage_growth_1y", "latest_wage", "permits_per_1000", "permit_momentum",
    "employment_hhi", "population",
)

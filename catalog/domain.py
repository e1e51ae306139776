"""The library's input tables, derived from the given star schema.

A nation stands for a municipality, a region for a county, an order for a listing, a part brand for
a rent zone. `oracle.py` holds the same derivations in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regionscore.functions.ratios import ratio, rounded, truthy
from regionscore.operators import timeseries
from regionscore.plans.listings import Dimensions


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all shuffle partitions: for small rows about to become large documents."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def code(col: str, width: int = 4) -> Column:
    return F.lpad(F.col(col).cast("string"), width, "0")


def quarter(col: str) -> Column:
    return F.concat(F.year(col).cast("string"), F.lit("K"), F.quarter(col).cast("string"))


def regions(spark, sf) -> DataFrame:
    """Region dimension: (code, name, region_code, region_name, rent_zone)."""
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        code("n_nationkey").alias("code"), F.col("n_name").alias("name"),
        code("n_regionkey", 2).alias("region_code"), F.col("r_name").alias("region_name"),
        F.concat(F.lit("g"), F.col("n_nationkey")).alias("rent_zone"),
    )


def zone_dims(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Zones known by code (two of three nations) and by generic zone (others, below nation 20)."""
    zone = F.concat(F.lit("Brand#"), F.col("n_nationkey") + 1)
    n = table(spark, sf, "nation")
    direct = n.filter("n_nationkey % 3 != 0").select(code("n_nationkey").alias("municipality_code"), zone.alias("zone"))
    generic = n.filter("n_nationkey % 3 = 0 and n_nationkey < 20").select(
        F.concat(F.lit("g"), F.col("n_nationkey")).alias("rent_zone"), zone.alias("zone"))
    return direct, generic


def index_dims(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Index regions by name (nations 0-4) and by region (regions 1-3); the rest has none."""
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    by_name = n.filter("n_nationkey < 5").select(
        F.lower("n_name").alias("key"), code("n_regionkey", 3).alias("index_region_code"))
    by_region = r.filter("r_regionkey between 1 and 3").select(
        code("r_regionkey", 2).alias("key"), code("r_regionkey", 3).alias("index_region_code"))
    return by_name, by_region


def dimensions(spark, sf) -> Dimensions:
    return Dimensions(*zone_dims(spark, sf), *index_dims(spark, sf))


def order_nation(spark, sf, *columns: str) -> DataFrame:
    """Orders with the nation of their customer."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        *columns, F.col("c_nationkey").alias("nation"))


def listings(spark, sf) -> DataFrame:
    """Listings with their resolved region: an order, its customer's nation, its mean line quantity."""
    sizes = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.avg("l_quantity").alias("sqm"))
    rows = order_nation(spark, sf, "o_orderkey", "o_totalprice", "o_orderdate")
    placed = rows.join(sizes, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    price = truthy(F.col("o_totalprice"))
    named = placed.select(
        F.col("o_orderkey").alias("listing_id"),
        F.col("o_totalprice").alias("total_price_calc"), "sqm",
        rounded(ratio(price, F.col("sqm")), 0).alias("price_per_sqm"),
        F.year("o_orderdate").cast("string").alias("year"), code("nation").alias("municipality_code"),
    )
    dim = regions(spark, sf).select(
        F.col("code").alias("municipality_code"), F.col("name").alias("municipality_name"),
        F.lower("name").alias("municipality_clean"), "region_code", "region_name", "rent_zone")
    return named.join(dim, "municipality_code")


def price_sqm(spark, sf, rows: DataFrame | None = None) -> DataFrame:
    """Mean price per square metre by municipality and year."""
    rows = (listings(spark, sf) if rows is None else rows).select("municipality_code", "municipality_clean", "year", "total_price_calc", "sqm")
    unit = ratio(F.col("total_price_calc"), F.col("sqm"))
    return rows.groupBy("municipality_code", "municipality_clean", "year").agg(F.avg(unit).alias("price_sqm"))


def price_index(spark, sf) -> DataFrame:
    """Mean price by region and quarter."""
    rows = order_nation(spark, sf, "o_totalprice", "o_orderdate")
    n = table(spark, sf, "nation")
    return rows.join(n, rows.nation == n.n_nationkey).groupBy(
        code("n_regionkey", 3).alias("region_code"), quarter("o_orderdate").alias("quarter")
    ).agg(F.avg("o_totalprice").alias("index_value"))


def population(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.groupBy(code("c_nationkey").alias("municipality_code")).agg(
        F.count(F.lit(1)).cast("double").alias("population")
    ).withColumn("municipality_clean", _clean())


def _clean() -> Column:
    return F.concat(F.lit("nation_"), F.col("municipality_code").cast("int"))


def employment(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.groupBy(code("c_nationkey").alias("municipality_code"), F.col("c_mktsegment").alias("industry_code")).agg(
        F.count(F.lit(1)).cast("double").alias("employed"))


def debt(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer")
    share = F.avg((F.col("c_acctbal") < 0).cast("double")) * 100.0
    return c.groupBy(code("c_nationkey").alias("municipality_code")).agg(share.alias("debt_burden_pct"))


def wages(spark, sf) -> DataFrame:
    line, s = table(spark, sf, "lineitem"), table(spark, sf, "supplier")
    joined = line.join(s, line.l_suppkey == s.s_suppkey)
    return joined.groupBy(
        F.concat(F.lit("nation_"), F.col("s_nationkey")).alias("municipality_clean"),
        F.year("l_shipdate").cast("string").alias("year"),
    ).agg(F.avg("l_extendedprice").alias("monthly_wage"))


def permits(spark, sf) -> DataFrame:
    """Orders per nation and quarter."""
    rows = order_nation(spark, sf, "o_orderdate")
    return rows.groupBy(code("nation").alias("municipality_code"), quarter("o_orderdate").alias("quarter")).agg(
        F.count(F.lit(1)).cast("double").alias("permits")).withColumn("municipality_clean", _clean())


def series(spark, sf) -> DataFrame:
    """Monthly macro series per country (line status): rate, money, bond."""
    line = table(spark, sf, "lineitem")
    monthly = line.groupBy(
        F.col("l_linestatus").alias("country"), F.trunc("l_shipdate", "month").alias("obs_date")
    ).agg(
        rounded(F.avg("l_discount") * 100.0, 6).alias("rate"),
        rounded(F.sum("l_extendedprice"), 2).alias("money"),
        rounded(F.avg("l_tax") * 100.0, 6).alias("bond"),
    )
    return monthly.unpivot(["country", "obs_date"], ["rate", "money", "bond"], "series_key", "value")


def rent_grid(spark, sf) -> DataFrame:
    p = table(spark, sf, "part")
    return p.groupBy(F.col("p_brand").alias("zone"), F.col("p_size").cast("double").alias("sqm")).agg(
        F.avg("p_retailprice").alias("monthly_rent"))


def norway_tables(spark, sf, rows: DataFrame | None = None) -> dict[str, DataFrame]:
    mortgage = series(spark, sf).filter("country = 'O' and series_key = 'rate'").select(
        F.col("obs_date").cast("string").alias("period"), F.col("value").alias("mortgage_rate"))
    return {
        "price_sqm": price_sqm(spark, sf, rows), "price_index": price_index(spark, sf).withColumn("region", F.col("region_code")),
        "rent": rent_grid(spark, sf), "population": population(spark, sf), "employment": employment(spark, sf),
        "debt_burden": debt(spark, sf), "wages": wages(spark, sf), "construction": permits(spark, sf),
        "mortgage_rate": mortgage,
    }


def region_model_tables(spark, sf) -> dict[str, DataFrame]:
    """Inputs of the region model: country = region, region = nation, dwelling type = order status."""
    n = table(spark, sf, "nation")
    rows = order_nation(spark, sf, "o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    rows = rows.join(n, rows.nation == n.n_nationkey).select(
        code("n_regionkey", 2).alias("country"), code("nation").alias("region_code"), F.col("n_name").alias("region"),
        F.col("o_orderstatus").alias("dwelling_type"), F.col("o_totalprice").alias("price"),
        F.year("o_orderdate").cast("string").alias("year"), quarter("o_orderdate").alias("period"),
    )
    place = ["country", "region_code"]
    typed = [*place, "region", "dwelling_type"]
    by_year = rows.groupBy(*typed, "year").agg(F.avg("price").alias("price"))
    growth = timeseries.growth(by_year, typed, "year", "price", names=("growth_1Y_ann", "growth_3Y_ann", "latest_index"), min_rows=1, digits=6)
    growth = growth.withColumn("latest_index", rounded(F.col("latest_index"), 6))
    yields = rows.groupBy(*place, "region").agg(
        rounded(F.avg("price") / 200.0, 6).alias("avg_monthly_rent"), rounded(F.min("price"), 6).alias("avg_price_sqm"),
        rounded(F.max("price"), 6).alias("estimated_price"),
    ).withColumn("gross_yield_pct", rounded(F.col("avg_monthly_rent") * 1200.0 / F.col("estimated_price"), 6))
    yearly = rows.groupBy(*place, "year").agg(
        F.count(F.lit(1)).cast("double").alias("all"),
        F.count_if(F.col("dwelling_type") == "F").cast("double").alias("done"),
        F.count_if(F.col("dwelling_type") == "O").cast("double").alias("started"),
    )
    rate = yearly.select(*place, "year", F.when(F.col("year") < "2001", F.col("all")).alias("permits_per_1000_stock"),
                         F.col("all").alias("permits_rolling3y"))
    completion = yearly.select(*place, "year", rounded(ratio(F.col("done"), F.col("started")), 6).alias("completion_ratio"))
    per_quarter = rows.groupBy(*typed, "period").agg(F.avg("price").alias("price"), F.count(F.lit(1)).cast("double").alias("n"))
    from pyspark.sql import Window
    steps = Window.partitionBy(*typed).orderBy("period")
    index = per_quarter.select(
        *typed, "period", rounded((ratio(F.col("price"), F.lag("price", 1).over(steps)) - 1.0) * 100.0, 6).alias("growth_qoq"))
    counts = rows.groupBy(*place, "period").agg(F.count(F.lit(1)).cast("double").alias("n"))
    year_back = Window.partitionBy(*place).orderBy("period")
    momentum = counts.select(
        *place, "period", rounded((ratio(F.col("n"), F.lag("n", 4).over(year_back)) - 1.0) * 100.0, 6).alias("momentum_yoy_pct"))
    return {"growth": growth, "yield": yields, "building_rate": rate, "completion": completion,
            "permit_momentum": momentum, "price_index": index}


def addresses(spark, sf) -> DataFrame:
    """One address per customer, its nation as the town: `Street 12, 0012 NATION_3`."""
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    postal = F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0")
    text = F.concat(F.lit("Street "), F.col("c_custkey"), F.lit(", "), postal, F.lit(" "), F.col("n_name"))
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("listing_id"), text.alias("address"), "n_name", "c_nationkey")


def no_places(spark) -> DataFrame:
    return spark.createDataFrame([], "alias string, code string, fuzzy_eligible boolean")

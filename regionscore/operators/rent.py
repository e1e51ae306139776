"""Rent grids per zone and rent by size, interpolated between the sizes of a grid."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regionscore.functions.ratios import rounded
from regionscore.landing import land, sized

# Sizes of the grids, size codes, and the base rents used where no data exists.
SIZES_SE = (30, 45, 60, 75, 90, 105)
SIZE_CODES_NO = {"1.030": 30, "2.050": 50, "3.070": 70, "3.090": 90, "4.120": 120, "4.140": 140}
BASE_RENTS_SE = {
    "1.01": 18000, "1.02": 14000, "1.03": 12000, "1.04": 10500,
    "2.01": 11000, "2.02": 9500, "2.03": 8500,
    "3.01": 9500, "3.02": 8500, "3.03": 8000, "3.04": 7000,
    "4.01": 9500, "5.00": 8500, "6.00": 7000, "7.00": 5500,
}
# Key of the median grid; no zone is named so.
MEDIAN = "*"
DEFAULT_SQM = {"norway": 70.0, "sweden": 65.0}
DEFAULT_ZONE = {"norway": "21.00", "sweden": "7.00"}


def lookup(values: Mapping) -> Column:
    """A small fixed mapping as a map column."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def size_of_code(code: Column, sizes: Mapping[str, float]) -> Column:
    """Square metres of a size code, whether it was written as text or as a number."""
    by_number = {float(k): float(v) for k, v in sizes.items()}
    return F.try_element_at(lookup(by_number), code.cast("string").try_cast("double"))


def zone_rent_grid(rents: DataFrame, zones: DataFrame, default_zone: str = "7.00", sizes: Sequence[int] = SIZES_SE) -> DataFrame:
    """Mean rent per square metre of each zone, spread over the grid sizes.

    `rents` (code, rent_per_sqm), `zones` (code, rent_zone); codes without a zone share the default.
    """
    zoned = rents.join(zones, "code", "left").withColumn("rent_zone", F.coalesce("rent_zone", F.lit(default_zone)))
    means = zoned.groupBy("rent_zone").agg(F.avg("rent_per_sqm").alias("_mean"))
    return means.select(
        "rent_zone", "_mean", F.explode(F.array(*[F.lit(float(s)) for s in sizes])).alias("sqm")
    ).select("rent_zone", "sqm", rounded(F.col("_mean") * F.col("sqm"), 0).alias("monthly_rent"))


def synthetic_rent_grid(bases: DataFrame, sizes: Sequence[int] = SIZES_SE) -> DataFrame:
    """Grid from one base rent per zone (at 60 square metres), growing with size to the power 0.75."""
    spread = bases.select(
        "rent_zone", "base_rent", F.explode(F.array(*[F.lit(float(s)) for s in sizes])).alias("sqm")
    )
    rent = F.col("base_rent") * F.pow(F.col("sqm") / 60.0, F.lit(0.75))
    return spread.select("rent_zone", "sqm", rounded(rent, 0).alias("monthly_rent"))


def sized_grid(grid: DataFrame, sizes: Mapping[str, float] = SIZE_CODES_NO) -> DataFrame:
    """A grid with size codes gets its sizes in square metres; one that has them stays as it is."""
    return grid if "sqm" in grid.columns else grid.withColumn("sqm", size_of_code(F.col("size_code"), sizes))


def sweden_rent_grid(rents: DataFrame | None, zones: DataFrame) -> DataFrame:
    """Grid (grid_zone, sqm, monthly_rent) from rents per square metre, or from base rents if there are none."""
    spark = zones.sparkSession
    if rents is not None and not rents.isEmpty():
        grid = zone_rent_grid(rents, zones)
    else:
        grid = synthetic_rent_grid(spark.createDataFrame(list(BASE_RENTS_SE.items()), "rent_zone string, base_rent int"))
    return grid.withColumnRenamed("rent_zone", "grid_zone")


def resolve_zone(df: DataFrame, country: str, direct: DataFrame | None = None, generic: DataFrame | None = None) -> DataFrame:
    """Add `_zone`: the zone of the code itself, else that of the region's generic zone, else the default.

    `direct` (municipality_code, zone) and `generic` (rent_zone, zone) are small dimensions; Sweden
    uses the region's own zone.
    """
    default = F.lit(DEFAULT_ZONE[country])
    if direct is None and generic is None:
        return df.withColumn("_zone", F.coalesce("rent_zone", default))
    direct, generic = sized(direct), sized(generic)
    out = df.join(direct.select("municipality_code", F.col("zone").alias("_direct")), "municipality_code", "left")
    out = out.join(generic.select("rent_zone", F.col("zone").alias("_generic")), "rent_zone", "left")
    return out.withColumn("_zone", F.coalesce("_direct", "_generic", default)).select(*df.columns, "_zone")


def rent_segments(grid: DataFrame, zone: str) -> DataFrame:
    """Straight pieces of each zone's rent curve: (_zone, lo, hi, x0, y0, slope), flat beyond both ends.

    A grid has one point per zone and size, so the windows are as long as the size scale. The pieces
    under the zone NULL are those of the median rent per size, for zones without a grid.
    """
    points = grid.filter(F.col("sqm").isNotNull() & F.col("monthly_rent").isNotNull())
    points = points.groupBy(F.col(zone).alias("_zone"), "sqm").agg(F.avg("monthly_rent").alias("y"))
    medians = points.groupBy("sqm").agg(F.median("y").alias("y"))  # one value per zone
    points = points.unionByName(medians.withColumn("_zone", F.lit(None).cast("string")))
    w = Window.partitionBy("_zone").orderBy("sqm")
    x = F.col("sqm").cast("double")
    steps = points.select(
        "_zone", x.alias("x0"), F.col("y").alias("y0"), F.lead(x).over(w).alias("x1"), F.lead("y").over(w).alias("y1"),
        F.lag(x).over(w).alias("before"),
    )
    slope = F.coalesce(F.try_divide(F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0")), F.lit(0.0))
    inner = F.struct(F.col("x0").alias("lo"), F.coalesce("x1", F.lit(math.inf)).alias("hi"), slope.alias("slope"))
    head = F.when(F.col("before").isNull(), F.struct(F.lit(-math.inf).alias("lo"), F.col("x0").alias("hi"), F.lit(0.0).alias("slope")))
    pieces = F.explode(F.array_compact(F.array(head, inner))).alias("p")
    return steps.select("_zone", "x0", "y0", pieces).select("_zone", "p.lo", "p.hi", "x0", "y0", "p.slope")


def estimate_rent(df: DataFrame, grid: DataFrame, country: str, zone: str = "_zone", grid_zone: str = "zone") -> DataFrame:
    """Add `estimated_monthly_rent` from the grid of the row's zone, or from the median grid.

    The join is by zone with the size as a further condition, and exactly one piece of a zone fits:
    every listing stays one row. The landed pieces are broadcast if they are as small as they should be.
    """
    pieces = land(rent_segments(grid, grid_zone))
    zones = pieces.filter(F.col("_zone").isNotNull()).select(F.col("_zone").alias("_known")).distinct()
    zoned = df.withColumnRenamed(zone, "_of") if zone != "_of" else df
    zoned = zoned.join(zones, F.col("_of") == F.col("_known"), "left")
    size = F.coalesce(F.col("sqm").cast("double"), F.lit(DEFAULT_SQM[country]))
    keyed = zoned.select(*[c for c in zoned.columns if c not in ("_of", "_known")],
                         F.coalesce("_known", F.lit(MEDIAN)).alias("_key"), size.alias("_size"))
    pieces = pieces.select(F.coalesce("_zone", F.lit(MEDIAN)).alias("_key2"), "lo", "hi", "x0", "y0", "slope")
    fits = (F.col("_key") == F.col("_key2")) & (F.col("_size") >= F.col("lo")) & (F.col("_size") < F.col("hi"))
    rent = F.col("slope") * (F.col("_size") - F.col("x0")) + F.col("y0")
    joined = keyed.join(pieces, fits, "left").withColumn("estimated_monthly_rent", rent)
    return joined.drop("_key", "_key2", "_size", "lo", "hi", "x0", "y0", "slope")

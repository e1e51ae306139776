"""Write an intermediate table to the shared checkpoint folder and read it back.

A landed table cuts lineage (lost executors re-read files), is read column by column, and gives
the optimizer a true size, so that joins against it are broadcast only below
`spark.sql.autoBroadcastJoinThreshold`.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def landing_folder(spark: SparkSession) -> str:
    """The folder that the session names as its checkpoint folder; one of our own only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="regionscore-"))
        folder = context.getCheckpointDir()
    return f"{folder.rstrip('/')}/regionscore/{spark.sparkContext.applicationId}"


def landing_path(spark: SparkSession) -> str:
    """A new path in the landing folder."""
    return f"{landing_folder(spark)}/{uuid.uuid4().hex}"


def land(df: DataFrame) -> DataFrame:
    """Write `df` as parquet and return a reader of the files, with the same schema."""
    spark = df.sparkSession
    path = landing_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def land_observed(df: DataFrame, metrics: list[Column]) -> tuple[DataFrame, dict]:
    """`land`, and aggregates of the rows from the pass that writes them, by name."""
    seen = Observation()
    return land(df.observe(seen, *metrics)), seen.get


def sized(df: DataFrame) -> DataFrame:
    """A dimension that the optimizer can size: landed, so that its true size decides whether it is broadcast.

    Frames made from Python rows or from aggregates of large tables have no useful estimate, and a
    join with them would shuffle the large side by a skewed key.
    """
    return land(df)


def drop(spark: SparkSession, path: str) -> None:
    """Delete the files at a path in the landing folder; what reads them must be landed or written before."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop_landed(spark: SparkSession) -> None:
    """Delete all that this application has landed; results that still read it must be written before."""
    drop(spark, landing_folder(spark))


def with_constants(df: DataFrame, one_row: DataFrame, columns: list[str]) -> DataFrame:
    """Add the columns of a one-row frame to every row through a scalar subquery."""
    holder = one_row.select(F.struct(*columns).alias("c")).scalar()
    df = df.withColumn("_constants", holder)
    added = [F.col("_constants").getField(c).alias(c) for c in columns]
    kept = [F.col(f"`{c}`") for c in df.columns if c != "_constants" and c not in columns]
    return df.select(*kept, *added)


def computed_once(df: DataFrame, keep: list[str], columns: dict[str, Column]) -> DataFrame:
    """Columns `keep` and the given expressions, evaluated once per row however often they are used.

    Passing them through a generator of one row keeps the optimizer from copying costly
    expressions into every column and filter that refers to them.
    """
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*keep, F.inline(F.array(made)))

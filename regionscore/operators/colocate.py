"""Large tables kept in buckets by a key, so that later joins on the key don't shuffle them again.

A region table below the broadcast limit needs none of this. Above it, every join by region would shuffle all listings; kept in
buckets they stay where they are, and only the other side moves. A key of many rows is dealt over several buckets.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regionscore.landing import land, landing_path
from regionscore.operators.cells import _hashable, join_null_safe

#: The column that deals the rows of a key.
DEAL = "_deal"
#: A deal has at most this part of a bucket's mean: several that meet in one bucket still make no large one.
PART = 10


@dataclass(frozen=True)
class Bucketed:
    """A table in buckets by `key` and the deal of a row; `hot` has the keys that are dealt, and into how many deals."""

    rows: DataFrame
    table: str
    key: str
    hot: DataFrame

    def join(self, other: DataFrame, how: str = "left") -> DataFrame:
        """The rows with the columns of `other`, which has `key` and as many rows for it as it likes; NULL keys meet nothing.

        `how` is `left`, `inner`, `left_semi` or `left_anti`. The rows of a dealt key in `other` go to each of its deals.
        """
        if how not in ("left", "inner", "left_semi", "left_anti"):
            raise ValueError("rows of the other side alone would come once for each deal")
        dealt = other.join(F.broadcast(self.hot), self.key, "left")  # fewer keys than PART times the buckets
        dealt = dealt.withColumn(DEAL, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_deals") - 1, F.lit(0))))).drop("_deals")
        return self.rows.join(dealt, [self.key, DEAL], how).drop(DEAL)

    def drop(self) -> None:
        self.rows.sparkSession.sql(f"drop table if exists {self.table}")


def bucketed(df: DataFrame, key: str, buckets: int) -> Bucketed:
    """`df` written once in `buckets` buckets by `key`. A key of more rows than a tenth of a bucket's mean is dealt by a hash of the row.

    `df` is read twice, to count the keys and to write. There are fewer such keys than ten times the buckets, so the list of them is broadcast.
    Repeated rows and rows with a NULL key stay.
    """
    spark: SparkSession = df.sparkSession
    counts = land(df.groupBy(key).agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    most = max(1, -(-total // (buckets * PART)))
    hot = land(counts.filter(F.col("n") > most).select(key, F.ceil(F.col("n") / most).cast("int").alias("_deals")))
    columns = [F.col(f"`{f.name}`") for f in df.schema.fields if _hashable(f.dataType)]
    rows = join_null_safe(df, F.broadcast(hot), [key], ["_deals"])
    rows = rows.select(*df.columns, F.coalesce(F.pmod(F.xxhash64(*columns), F.col("_deals")), F.lit(0)).cast("int").alias(DEAL))
    table = f"regionscore_{uuid.uuid4().hex}"
    rows.repartition(buckets, key, DEAL).write.bucketBy(buckets, key, DEAL).sortBy(key, DEAL).option("path", landing_path(spark)).saveAsTable(table)
    return Bucketed(spark.table(table), table, key, hot)

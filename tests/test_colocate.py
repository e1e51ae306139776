import random

import pytest
from pyspark.sql import functions as F

from regionscore.operators import colocate


@pytest.fixture
def no_broadcast(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def tables(spark):
    r = random.Random(1)
    codes = [f"{k:04d}" for k in range(40)] + [None, "none"]
    data = [(i, "0007" if i % 3 == 0 else r.choice(codes), float(i)) for i in range(6000)] + [(1, "0007", 1.0)] * 5
    features = [(f"{k:04d}", float(k)) for k in range(40)] + [("0007", 70.0), (None, 9.0), ("other", 1.0)]
    return data, features, spark.createDataFrame(data, "id int, code string, v double").repartition(5), spark.createDataFrame(features, "code string, f double")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sides(plan):
    """Lines of the plan that shuffle, and those that scan the bucketed table."""
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "regionscore_" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    above, at = [], depth(lines[scan])
    for line in reversed(lines[:scan]):
        if depth(line) < at:
            above.append(line)
            at = depth(line)
    return above, lines[scan]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_joins_without_moving_the_large_side(spark, no_broadcast, rows, how):
    data, features, df, other = tables(spark)
    kept = colocate.bucketed(df, "code", 16)
    joined = kept.join(other, how)
    above, scan = sides(plan_of(joined))
    assert "Bucketed: true" in scan and not any("Exchange" in line for line in above)
    assert rows(joined) == rows(df.join(other, "code", how).select(*joined.columns))
    again = kept.join(other.select("code", (F.col("f") * 2).alias("g")), "left")
    assert again.count() >= len(data)
    kept.drop()


def test_a_hot_key_and_missing_ones_are_dealt(spark):
    rows = spark.range(20_000).selectExpr("id", "case when id % 3 = 0 then 'hot' when id % 3 = 1 then null else cast(id as string) end as code")
    kept = colocate.bucketed(rows, "code", 20)
    sizes = [n for _, n in kept.rows.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 2 * 20_000 / 20
    assert sorted((r.code or "", r._deals) for r in kept.hot.collect()) == [("", 67), ("hot", 67)]
    kept.drop()


def test_empty_and_odd(spark):
    kept = colocate.bucketed(spark.createDataFrame([], "code string, v int"), "code", 4)
    assert kept.join(spark.createDataFrame([("a", 1)], "code string, f int")).collect() == []
    with pytest.raises(ValueError):
        kept.join(spark.createDataFrame([("a", 1)], "code string, f int"), "outer")
    kept.drop()

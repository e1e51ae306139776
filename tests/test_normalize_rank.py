import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from regionscore.operators import cells, normalize, ranking


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double")


def norms(spark, values, invert=False):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    return [r[0] for r in normalize.minmax(df, {"v": invert}).orderBy("i").select("v_norm").collect()]


def test_minmax(spark):
    assert norms(spark, [1.0, None, 3.0, 5.0]) == [0.0, 0.5, 0.5, 1.0]
    assert norms(spark, [1.0, None, 3.0, 5.0], invert=True) == [1.0, 0.5, 0.5, 0.0]
    assert norms(spark, [7.0, 7.0]) == [0.5, 0.5]
    assert norms(spark, [None, None]) == [0.5, 0.5]


def test_minmax_by_group(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 2.0), ("a", 9.0), ("b", 4.0), ("c", None)], "g string, v double")
    assert rows(normalize.minmax(df, {"v": False}, by=["g"]), "g", "v_norm") == [
        ("a", 0.0), ("a", 0.125), ("a", 0.125), ("a", 1.0), ("b", 0.5), ("c", 0.5)]


def test_minmax_unfilled(spark, rows):
    assert rows(normalize.minmax_unfilled(frame(spark, [1.0, 2.0, 5.0]), "v", "n"), "n") == [(0.0,), (0.25,), (1.0,)]
    assert rows(normalize.minmax_unfilled(frame(spark, [2.0, 2.0]), "v", "n"), "n") == [(0.5,), (0.5,)]


CASES = {
    "heavy tail": [10.0 ** random.Random(1).uniform(-300, 300) for _ in range(501)],
    "powers of two": [2.0 ** i for i in range(-60, 61)] + [-(2.0 ** i) for i in range(-60, 61)],
    "one value holds a third": [5.0] * 400 + [float(i) for i in range(800)],
    "neighbours of a power of two": [8.0, 7.999999999999999, 8.000000000000002, 4.0, 16.0],
    "negatives and zeros": [-3.5, -1e-9, 0.0, 0.0, 1e-9, 2.25],
    "even": [1.0, 2.0, 4.0, 8.0],
    "single": [42.0],
}


@pytest.mark.parametrize("name", CASES)
def test_exact_median_narrows_to_the_middle(spark, name):
    random.Random(2).shuffle(CASES[name])
    got = normalize.exact_median(frame(spark, [*CASES[name], None]), ["v"]).first()[0]
    assert got == statistics.median(CASES[name])


def test_exact_median_by_group(spark, rows):
    data = [("a", float(i), None) for i in range(11)] + [("b", float(i * i), 1.0 * i) for i in range(6)]
    df = spark.createDataFrame(data, "g string, v double, w double")
    assert rows(normalize.exact_median(df, ["v", "w"], by=["g"])) == [("a", 5.0, None), ("b", 6.5, 2.5)]


@pytest.mark.parametrize("few", [100_000, 3])
def test_medians_of_many_rows_come_from_a_bracket(spark, monkeypatch, few):
    monkeypatch.setattr(cells, "FEW", few)
    r = random.Random(5)
    data = [(r.choice("abc"), r.choice([r.gauss(0, 1), 5.0, float("nan"), None, float("inf"), -float("inf")]), float(r.randint(0, 3))) for _ in range(9000)]
    df = spark.createDataFrame(data, "g string, v double, w double").repartition(5)
    clean = lambda xs: [x for x in xs if x is not None and x == x]
    got = {x.g: (x.v, x.w) for x in normalize.exact_median(df, ["v", "w"], by=["g"]).collect()}
    assert got == {g: tuple(statistics.median(clean([row[k] for row in data if row[0] == g])) for k in (1, 2)) for g in "abc"}
    assert tuple(normalize.exact_median(df, ["v", "w"]).first()) == tuple(statistics.median(clean([row[k] for row in data])) for k in (1, 2))


def test_a_bracket_that_misses_the_middle_is_given_up(spark, monkeypatch):
    data = [(float(i), float(i % 7)) for i in range(2001)]
    df = spark.createDataFrame(data, "v double, w double").repartition(4)
    monkeypatch.setattr(normalize, "ACCURACY", -10)  # both ends at one side: 0.7 and 0.3
    monkeypatch.setattr(normalize.F, "percentile_approx", lambda c, p, a, wrong=normalize.F.percentile_approx: wrong(c, normalize.F.array(normalize.F.lit(0.9), normalize.F.lit(0.95)), normalize.F.lit(1000)))
    assert tuple(normalize.exact_median(df, ["v", "w"]).first()) == (1000.0, 3.0)


def test_approximate_medians_are_within_their_rank_error(spark):
    r = random.Random(6)
    data = [(r.choice("ab"), r.paretovariate(1)) for _ in range(20_000)]
    df = spark.createDataFrame(data, "g string, v double").repartition(7)
    for accuracy in (100, 10_000):
        for g, v in normalize.approximate_median(df, ["v"], by=["g"], accuracy=accuracy).collect():
            values = sorted(x for h, x in data if h == g)
            assert abs(values.index(v) + 1 - len(values) / 2) <= len(values) / accuracy + 1


def test_percentile_shares_ties(spark, rows):
    df = frame(spark, [1.0, 2.0, 2.0, 4.0])
    assert rows(ranking.percentile_rank(df, "v", "p"), "v", "p") == [(1.0, 25.0), (2.0, 62.5), (2.0, 62.5), (4.0, 100.0)]


def test_percentile_by_group(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 2.0), ("a", 4.0), ("b", 7.0), ("b", 7.0), ("b", None), (None, 1.0), (None, None)], "g string, v double")
    assert rows(ranking.percentile_rank(df, "v", "p", by=["g"]), "g", "v", "p") == sorted([
        ("a", 1.0, 25.0), ("a", 2.0, 62.5), ("a", 2.0, 62.5), ("a", 4.0, 100.0), ("b", 7.0, 75.0), ("b", 7.0, 75.0), ("b", None, None), (None, 1.0, 100.0), (None, None, None)], key=repr)


@pytest.mark.parametrize("few", [100_000, 20])
def test_percentile_of_scores_over_many_ranges(spark, monkeypatch, few):
    """A score that a third of the rows share, few cells in a window and many by ranges."""
    monkeypatch.setattr(cells, "FEW", few)
    r = random.Random(8)
    data = [(i, r.choice(["a", "b", None]), r.choice([1.0, None, 5.0, 5.0, round(r.random(), 3)])) for i in range(4000)]
    df = spark.createDataFrame(data, "id int, g string, v double").repartition(16)
    got = {x.id: x for x in ranking.percentile_rank(ranking.percentile_rank(df, "v", "p", digits=None), "v", "q", by=["g"], digits=None).collect()}
    assert len(got) == 4000

    def want(values, v):
        known = [x for x in values if x is not None]
        return None if v is None else (sum(x < v for x in known) + (sum(x == v for x in known) + 1) / 2) / len(known) * 100

    everything = [v for *_, v in data]
    for i, g, v in data[::37]:
        own = [y for _, h, y in data if h == g]
        assert (got[i].p, got[i].q) == (pytest.approx(want(everything, v)) if v is not None else None, pytest.approx(want(own, v)) if v is not None else None)


def test_a_shared_score_and_missing_ones_are_dealt_out(spark, monkeypatch):
    """Broadcasts off but for the bounded list of hot scores: no task gets more than twice the mean."""
    monkeypatch.setattr(cells, "FEW", 20)
    rows = spark.range(60_000).selectExpr("id", "case when id % 3 = 0 then 7.5 when id % 3 = 1 then null else id / 7.0 end as s", "map('a', id) as m")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = ranking.percentile_rank(rows, "s", "p", digits=None)
        sizes = [n for _, n in out.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) >= 8 and max(sizes) <= 2 * sum(sizes) / len(sizes)
        got = out.groupBy("p").count().filter("count > 1").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sorted(x["count"] for x in got) == [20_000, 20_000] and sum(sizes) == 60_000


def test_several_percentiles_from_one_pass(spark, rows):
    df = spark.createDataFrame([(1, "a", 1.0, 5), (2, "a", 2.0, 5), (3, "b", None, 7), (4, None, 2.0, None)], "id int, g string, x double, y int")
    got = ranking.percentile_ranks(df, {"x": "px", "y": "py"}, by=["g"])
    assert got.columns == ["id", "g", "x", "y", "px", "py"]
    assert rows(got, "id", "px", "py") == [(1, 50.0, 75.0), (2, 100.0, 75.0), (3, None, 100.0), (4, 100.0, None)]


@pytest.mark.parametrize("few", [100_000, 2])
def test_ranked_with_few_and_many_scores(spark, monkeypatch, few):
    monkeypatch.setattr(cells, "FEW", few)
    df = spark.createDataFrame([(i, None if i % 5 == 0 else float(i % 7)) for i in range(200)], "id int, s double").repartition(6)
    want = {r.id: r.p for r in ranking.percentile_rank(df, "s", "p").collect()}
    got = ranking.ranked(df, "s", "id").collect()
    assert {r.id: r.percentile for r in got} == want and sorted(r["rank"] for r in got) == list(range(1, 201))


def test_ranked_gives_rank_and_percentile_from_one_sort(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.0), (3, 5.0), (4, None)], "id int, s double")
    assert sorted(tuple(r) for r in ranking.ranked(df, "s", "id").select("id", "rank", "percentile", "_n").collect()) == [(1, 2, 50.0, 4), (2, 1, 100.0, 4), (3, 3, 50.0, 4), (4, 4, None, 4)]


def test_numbered_equals_a_global_window(spark):
    r = random.Random(3)
    data = [(i, float(r.choice([1, 2, 3, 3, 3]))) for i in range(5000)]
    df = spark.createDataFrame(data, "id int, s double").repartition(7)
    got = {x.id: x["rank"] for x in ranking.numbered(df, [F.col("s").desc(), F.col("id").asc()]).collect()}
    want = {i: n for n, (i, _) in enumerate(sorted(data, key=lambda x: (-x[1], x[0])), 1)}
    assert got == want


@pytest.mark.parametrize("n, counts", [(10, (2, 6, 2)), (1, (0, 0, 1)), (4, (1, 2, 1)), (2, (1, 0, 1))])
def test_listing_tiers(spark, n, counts):
    df = spark.range(1, n + 1).select(ranking.listing_tier(F.col("id"), F.lit(n)).alias("t"))
    tiers = [r.t for r in df.collect()]
    assert (tiers.count("BUY"), tiers.count("HOLD"), tiers.count("AVOID")) == counts


@pytest.mark.parametrize("n, counts", [(20, (10, 5, 5)), (3, (1, 0, 2)), (1, (1, 0, 0))])
def test_region_tiers(spark, n, counts):
    df = spark.range(1, n + 1).select(ranking.region_tier(F.col("id"), F.lit(n), 10).alias("t"))
    tiers = [r.t for r in df.collect()]
    assert (tiers.count("BUY"), tiers.count("HOLD"), tiers.count("AVOID")) == counts


def naive_frontier(points):
    def beaten(p):
        return any(q[0] >= p[0] and q[1] >= p[1] and (q[0] > p[0] or q[1] > p[1]) for q in points if None not in q)
    return [p for p in points if None in p or not beaten(p)]


def test_pareto_frontier_equals_all_pairs(spark, rows):
    r = random.Random(4)
    points = [(9.0, 1.0), (5.0, 5.0), (5.0, 6.0), (1.0, 9.0), (1.0, 2.0), (9.0, 1.0), (None, 3.0)]
    points += [(round(r.uniform(0, 8), 1), round(r.uniform(0, 8), 1)) for _ in range(200)]
    df = spark.createDataFrame([("NO", *p) for p in points], "country string, yield_score double, growth_score double")
    assert rows(ranking.pareto_frontier(df), "yield_score", "growth_score") == sorted(naive_frontier(points), key=repr)
    assert ranking.pareto_frontier(df, country="SE").count() == 0

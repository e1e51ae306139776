"""The n-gram Jaccard join against all pairs."""

import re

import corpus
import numpy as np
import pytest
from pyspark.sql import functions as F

from regionscore.llm import jaccard
from regionscore.llm.common import add_up, narrow
from regionscore.llm.queries import QUERIES, table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute(rows):
    """(id, size, smallest id reachable) of each row."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    out = []
    for i, (key, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((key, len(sets[i]), min(ids) if sets[i] and ids else key))
    return sorted(out, key=repr), [find(i) for i in range(len(rows))], sets


def near_copies(seed=0, groups=12):
    """Groups of texts around the threshold, with a passage that all share."""
    r, rows = np.random.default_rng(seed), []
    shared = corpus.sentence(999, 40)
    for g in range(groups):
        words = corpus.sentence(g, int(r.integers(20, 90))).split()
        for c in range(int(r.integers(1, 9))):
            own = list(words)
            for _ in range(int(r.integers(0, 4))):
                own[int(r.integers(0, len(own)))] = f"w{r.integers(1000)}"
            if r.random() < 0.3:
                own = own[:int(r.integers(3, len(own)))]
            rows.append((len(rows) + 100, " ".join(own) + (" " + shared if g % 3 == 0 else "")))
    return rows


@pytest.mark.parametrize("case", ["odd", "near", "passage"])
def test_against_all_pairs(spark, case):
    if case == "odd":
        rows, df = [(r[0], r[1]) for r in corpus.rows()], corpus.frame(spark)
    else:
        rows = near_copies() if case == "near" else [(i, corpus.sentence(i, 12) + " " + corpus.sentence(5000, 25)) for i in range(60)]
        df = spark.createDataFrame(rows, "doc_id bigint, text string")
    join = jaccard.Join(chunk=4, fanout=2) if case != "odd" else jaccard.Join()
    got = [tuple(r) for r in jaccard.groups(df, join=join).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(got, key=repr) == brute(rows)[0]


def test_one_of_each_group_stays(spark):
    rows = [(r[0], r[1]) for r in corpus.rows()]
    _, root, sets = brute(rows)
    kept = jaccard.unique(corpus.frame(spark))
    assert kept.schema == corpus.frame(spark).schema
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    want = []
    for g in sorted(set(root)):
        members = [rows[i] for i in range(len(rows)) if root[i] == g]
        want += members if not sets[g] else [min(members, key=lambda r: 2**63 if r[0] is None else r[0])]
    assert got == sorted(want, key=repr)


def test_empty_tables(spark):
    assert jaccard.groups(corpus.empty(spark)).count() == 0 and jaccard.unique(corpus.empty(spark)).count() == 0
    blank = corpus.frame(spark, [r for r in corpus.rows() if not (r[1] or "").strip()])
    assert jaccard.groups(blank).filter("component_id <=> doc_id and n_shingles = 0").count() == blank.count() == jaccard.unique(blank).count()


def test_tree_loses_no_pair():
    r, join = np.random.default_rng(3), jaccard.Join(fanout=3)
    points = r.poisson(3, (200, 128))
    points[100:] = np.maximum(points[:100] + r.integers(-1, 2, (100, 128)) * (r.random((100, 128)) < 0.1), 0)
    sizes = points.sum(axis=1)
    q, x = jaccard.Tree(points, sizes, join.fanout).near(points, sizes, join)
    want = {(i, j) for i in range(200) for j in range(200)
            if join.sizes_agree(sizes[i], sizes[j]) and np.minimum(points[i], points[j]).sum() >= join.least_overlap(sizes[i], sizes[j])}
    assert set(zip(q.tolist(), x.tolist())) == want and len(want) < 3000


def test_packed_points_come_back():
    """Points of one width in one piece, with empty, full and uneven ones; more of them than are unpacked at once."""
    r = np.random.default_rng(5)
    for groups, rows in ((16, 1), (16, 300), (1 << 16, 40)):
        points = np.minimum(r.poisson(r.choice([0, 0.7, 3, 200], (rows, 1)), (rows, groups)), 255).astype("u1")
        points[0] = 0
        points[-1, -1] = 255
        got = jaccard._points([jaccard.packed(x) for x in points], groups)
        assert (got == points).all()


def test_points_bound_the_overlap():
    r, join = np.random.default_rng(5), jaccard.Join()
    for n, m in ((10, 9), (100, 125), (128, 129), (129, 128), (2000, 1700), (4097, 4096)):
        both = r.integers(0, 2**63, n + m, dtype=np.uint64) * np.uint64(2)
        a, b = np.unique(both[:n]), np.unique(np.concatenate((both[:min(n, m) // 2], both[n:n + m - min(n, m) // 2])))
        p, q = (jaccard.point(x, join.groups(len(x)))[None, :].astype(np.int32) for x in (a, b))
        assert max(p.shape[1], q.shape[1]) <= 2 * min(p.shape[1], q.shape[1]) and p.sum() == len(a)
        w = min(p.shape[1], q.shape[1])
        bound, true = np.minimum(jaccard.folded(p, w), jaccard.folded(q, w)).sum(), len(np.intersect1d(a, b))
        assert true <= bound <= 0.92 * min(len(a), len(b))


def test_crowded_group_meets_all():
    """More than 255 shingles in one group don't fit its byte: the point's bound then leaves nothing out."""
    few = np.arange(40, dtype=np.uint64) << np.uint64(55)
    many = np.concatenate((few, np.arange(1000, 1300, dtype=np.uint64)))
    p, q = jaccard.point(few, 16), jaccard.point(many, 16)
    assert p.dtype == q.dtype == np.uint8 and (q == 255).all() and np.minimum(p, q).sum() == len(few)


def test_counters_of_any_width(spark):
    vectors = [(0, [1, 2, 3]), (0, [300, 0, 0]), (1, [70_000, 1, 2**31]), (1, [0, 0, 2**31])]
    rows = spark.createDataFrame([(k, bytearray(narrow(np.array(v)))) for k, v in vectors], "block int, data binary")
    sums = add_up(rows, 3)
    assert {k: v.tolist() for k, v in sums.items()} == {0: [301, 2, 3], 1: [70_000, 1, 2**32]}


def test_filter_of_wanted_sets_agrees_with_spark(spark):
    ids = [0, 1, -1, 2**63 - 1, -(2**63), 123456789]
    bits = jaccard.wanted_filter(spark.createDataFrame([(i,) for i in ids], "id bigint"))
    assert all(jaccard._passes(bits, i) for i in ids)
    assert sum(jaccard._passes(bits, i) for i in range(1000, 2000)) < 5


def test_sql_at_small_size(spark):
    from catalog.check import connection, difference
    from regionscore.llm.queries import ORACLE

    sf = "/root/testdata/sf0.001"
    assert difference(QUERIES["op7_ngram_jaccard"](spark, sf), connection(sf), ORACLE["op7_ngram_jaccard"]) is None


def test_blocks_larger_than_what_is_held(spark):
    """Many rows of one shingle stream through as one block."""
    rows = spark.range(120_000).select(F.lit(7).cast("bigint").alias("shingle"), (F.col("id") % 60_000).alias("set"), F.lit(10).alias("n"))
    got = jaccard.block_members(rows, jaccard.Join())
    assert got.count() == 59_999 and got.select("block", "first").distinct().collect() == [(7, 0)]


def test_block_that_starts_with_a_batch(spark):
    """A large block right after one that ends at the edge of an Arrow batch (10,000 rows) stays a block of its own."""
    place = {r["id"]: r["p"] for r in spark.range(1, 1000).withColumn("p", F.expr("pmod(hash(id), 8)")).collect()}
    after = next(k for k in range(2, 1000) if place[k] == place[1])
    row = lambda n, shingle, first: spark.range(n).select(F.lit(shingle).cast("bigint").alias("shingle"), (F.col("id") + first).alias("set"), F.lit(10).alias("n"))
    got = jaccard.block_members(row(10_000, 1, 0).union(row(70_000, after, 1_000_000)), jaccard.Join())
    assert sorted(tuple(r) for r in got.groupBy("first", "block").count().select("first", "count").collect()) == [(0, 9_999), (1_000_000, 69_999)]

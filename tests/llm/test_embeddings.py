"""Embedding near-duplicates against all pairs."""

import numpy as np
import pytest

from regionscore.llm import embeddings
from regionscore.llm.queries import QUERIES, table

SCHEMA = "vec_id bigint, embedding array<float>, label int, cls bigint, n int, v string, links string, component bigint"


def clusters(seed=0, groups=30, dim=64, labels=3):
    """Groups of vectors at all cosines around the threshold, with copies."""
    r, out = np.random.default_rng(seed), []
    for g in range(groups):
        center = r.normal(size=dim)
        for c in range(int(r.integers(1, 12))):
            x = center + r.normal(size=dim) * r.choice([0, 0.1, 0.2, 0.26, 0.3, 0.5])
            out.append((len(out) + 10, (x * r.choice([1, 3])).astype("f4").tolist(), int(g % labels)))
    return out


def odd():
    x = np.random.default_rng(1).normal(size=8).astype("f4").tolist()
    nan, inf = float("nan"), float("inf")
    return [(1, x, 1), (2, x, 1), (2, x, 1), (None, x, 1), (3, x, 2), (4, x, None), (5, None, 1), (6, [0.0] * 8, 1), (7, [None, *x[1:]], 1), (8, [nan, *x[1:]], 1),
            (9, [inf, *x[1:]], 1), (10, x[:7], 1), (11, [2 * v for v in x], 1), (12, [-v for v in x], 1), (13, [], 1), (14, [1e38] * 8, 3), (15, [1e-38] * 8, 3), (16, [5.0], 4), (17, [1.0], 4)]


def brute(rows, least):
    good = [v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, label in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            a, b = rows[i], rows[j]
            if good[i] and good[j] and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], float), np.array(b[1], float)
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                    links[i] += 1
                    links[j] += 1
                    p, q = sorted((find(i), find(j)))
                    parent[q] = p
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        first = min(ids) if ids else None
        out.append((r[0], links[i], first, r[0] is None and first is None or r[0] == first))
    return sorted(out, key=repr)


def result(df, hashing=None):
    return sorted((tuple(r) for r in embeddings.near(df, hashing=hashing).collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "v", "l", 3) for r in rows], SCHEMA)


def test_odd_rows(spark):
    want = [(k, n, c, k == c) if k is not None else (k, n, c, False) for k, n, c, _ in brute(odd(), 0.93)]
    got = [(k, n, c, kept if k is not None else False) for k, n, c, kept in result(frame(spark, odd()))]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("seed, block", [(0, 1024), (1, 1024), (2, 3)])
def test_against_all_pairs(spark, seed, block):
    rows = clusters(seed)
    got, want = result(frame(spark, rows), embeddings.Hashing(block=block)), brute(rows, 0.93)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert there > 200 and 0.98 * there <= found <= there
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g == w for g, w in zip(got, want)) >= 0.95 * len(want)


def test_empty_and_whole_table(spark):
    assert embeddings.near(frame(spark, [])).count() == 0
    sf = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table(spark, sf, "embeddings").collect()]
    assert sorted((tuple(r) for r in QUERIES["op9_embedding_near_dedup"](spark, sf).collect()), key=repr) == brute(rows, 0.93)


def test_rotation_keeps_angles():
    x = np.random.default_rng(0).normal(size=(5, 12))
    y = embeddings.rotated(x, 3)
    assert y.shape == (5, 16) and np.allclose(x @ x.T, y @ y.T)

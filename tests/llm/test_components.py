"""Connected components against plain union."""

import random

import pytest

from regionscore.llm.components import components


@pytest.mark.parametrize("case", ["path", "star", "random", "odd", "none"])
def test_components(spark, case):
    r = random.Random(4)
    edges = {"path": [(i + 1, i) for i in range(40)], "star": [(100, i) for i in range(50)], "random": [(r.randint(0, 80), r.randint(0, 80)) for _ in range(60)],
             "odd": [(1, 1), (None, 2), (3, None), (-5, 2**62), (2**62, -5), (2**62, 7)], "none": []}[case]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in parent}

import itertools
import re
from collections import Counter

import corpus
import pytest

from regionscore.llm import audit

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def fails(docs):
    least = {}
    for key, text, *_ in docs:
        if key is not None:
            least[text or ""] = min(key, least.get(text or "", key))
    out = []
    for key, text, part, *_ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        upper = sum("A" <= c <= "Z" for c in text)
        tests = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * upper > 3 * len(text), bool(re.search(r"[#$%&*|]", text)),
                 key is not None and key > least[text]]
        out.append((key, part or "", "".join(f for f, bad in zip("ABCDE", tests) if bad)))
    return out


def brute(docs, labels):
    good, toxic = {d for d, q, _ in labels if q == 1}, {d for d, _, t in labels if t == 1}
    rows = fails(docs)
    out, shapley = [], Counter()
    for part in {p for _, p, _ in rows}:
        of = [(k, bad) for k, p, bad in rows if p == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            here = of
            for step, f in enumerate(order, 1):
                gone, left = [r for r in here if f in r[1]], [r for r in here if f not in r[1]]
                shapley[part, f] += len(gone)
                out.append([part, order, step, len(left), len(gone), sum(f in bad for _, bad in of) - len(gone), sum(bad == f for _, bad in of),
                            sum(k in good and k is not None for k, _ in gone), sum(k in toxic and k is not None for k, _ in gone)])
                here = left
    return [(*r, shapley[r[0], r[1][r[2] - 1]]) for r in out]


def run(spark, docs, labels):
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, good string, part int").repartition(4)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = audit.audit(df, marks)
    assert got.columns == COLUMNS and dict(got.dtypes)["step"] == "int" and set(dict(got.dtypes)[c] for c in COLUMNS[3:]) == {"bigint"}
    return sorted(map(tuple, got.collect()))


def documents():
    long = corpus.sentence(1, 210)
    texts = [long, long, long.upper(), long + " #", "a b " * 150, "A b| " * 150, None, "", "", "x", "X", "x", long, corpus.sentence(2, 199), corpus.sentence(3, 200), "Ünï 漢字 $", " ".join(["w"] * 400)]
    docs = [(k % 11 if k > 12 else 100 - k, t, [None, "", "en", "de"][k % 4], "g", k) for k, t in enumerate(texts)]
    return docs + [(None, long, "en", None, None), (None, "x", "de", None, None), (100, long, "en", "r", 0), (3, None, None, None, None)]


LABELS = [(100, 1, 0), (99, 0, 1), (99, 1, None), (98, None, 1), (5, 1, 1), (5, 1, 1), (None, 1, 1), (3, 1, None), (92, 1, 0), (91, 0, 0), (555, 1, 1)]


def test_equals_brute_force(spark):
    assert run(spark, documents(), LABELS) == sorted(brute(documents(), LABELS))


def test_no_labels_no_documents(spark):
    assert run(spark, documents(), []) == sorted(brute(documents(), []))
    assert run(spark, [], LABELS) == []


def test_more_parts_than_the_row_limit_of_a_recursion(spark):
    limit = spark.conf.get("spark.sql.cteRecursionRowLimit")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "1000")
    try:
        counted = spark.createDataFrame([(f"p{k}", k % 4, k + 1, 1, 0) for k in range(30)], "part string, mask int, n bigint, good bigint, toxic bigint")
        assert audit.orders(counted, "XYZ").count() == 30 * 6 * 3
    finally:
        spark.conf.set("spark.sql.cteRecursionRowLimit", limit)


def test_prefixes_are_worked_out_once(spark):
    counted = spark.createDataFrame([("p", 3, 5, 1, 2), ("p", 0, 2, 0, 0)], "part string, mask int, n bigint, good bigint, toxic bigint")
    found = audit.levels(counted, "AB")
    assert sorted((r.prefix, r.kept, r.removed, r.redundant) for r in found.collect()) == [("A", 2, 5, 0), ("AB", 2, 0, 5), ("B", 2, 5, 0), ("BA", 2, 0, 5)]
    with pytest.raises(ValueError):
        audit.levels(counted, "AA")


def test_a_hot_text_moves_as_few_rows(spark):
    rows = spark.range(20_000).selectExpr("id as key", "cast('same' as binary) as digest", "cast(id % 3 as string) as part", "0 as mask", "id % 2 = 0 as good", "false as toxic").repartition(6)
    got = {(r.part, r.mask): (r.n, r.good) for r in audit.with_copies(rows, 16).collect()}
    assert got[("0", 0)] == (1, 1) and sum(n for n, _ in got.values()) == 20_000 and got[("1", 16)] == (6667, 3333)

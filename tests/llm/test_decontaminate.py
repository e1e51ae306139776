import hashlib
import re

import corpus
import pyarrow as pa
import pytest

from regionscore.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    windows = {}
    for name, text in items:
        ws = words(text)
        size = min(len(ws), window)
        for k in range(len(ws) - size + 1 if ws else 0):
            windows.setdefault(tuple(ws[k:k + size]), set()).add("" if name is None else str(name))
    sizes, out = {len(w) for w in windows}, []
    for key, text in docs:
        ws = words(text)
        hit, found = set(), set()
        for size in sizes:
            for k in range(len(ws) - size + 1):
                if tuple(ws[k:k + size]) in windows:
                    hit.update(range(k, k + size))
                    found |= windows[tuple(ws[k:k + size])]
        out.append((key, len(ws), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


LONG = corpus.sentence(40, 60)
ITEMS = [(2, LONG), (10, corpus.sentence(41, 10)), (9, "Short one here"), (7, "UNIQUE"), (None, corpus.sentence(42, 12)), (3, None), (4, "--- !!"), (5, ""),
         (2, corpus.sentence(43, 15)), (11, " ".join(LONG.split()[20:40])), (11, " ".join(LONG.split()[20:40])), (12, "ünï 漢字 😀 naïve")]


def documents():
    w, more = LONG.split(), corpus.sentence(50, 80).split()
    texts = [
        " ".join(more), LONG, " ".join(more[:30] + w[5:14] + more[30:]), " ".join(more[:30] + w[5:15] + more[30:]), " ".join(w[18:42]),
        LONG.upper().replace(" ", ", \n"), None, "", "unique", "un-ique Unique!", "a short ONE here; short one  here", corpus.sentence(42, 12), corpus.sentence(43, 9),
        "ÜNÏ ünï 漢字/😀--naïve", "ünï 漢字 😀", " ".join(w[:10] * 3), "x" * 300_000, " ".join(more) * 50 + " " + " ".join(w[30:45]),
    ]
    return [(k, t) for k, t in enumerate(texts)] + [(1, LONG), (None, LONG), (None, None)]


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4), spark.createDataFrame(items, "item_id bigint, text string").repartition(3)


@pytest.mark.parametrize("most", [decontaminate.SET_BYTES, 400, 100])
def test_equals_brute_force_in_one_set_and_in_many(spark, most):
    got = decontaminate.report(*frames(spark, documents(), ITEMS), most=most).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(documents(), ITEMS)))


def test_other_window(spark):
    got = decontaminate.report(*frames(spark, documents(), ITEMS), window=4).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(documents(), ITEMS, 4)))


def test_equal_hashes_are_told_apart_by_words(monkeypatch):
    monkeypatch.setattr(decontaminate, "span_hashes", lambda data, starts, ends: (ends - starts).astype("uint64"))
    items = [("a", "one two six"), ("b", "ten fix cow"), ("c", "one two six")]
    windows = decontaminate.WindowSet(items)
    at, size, entry = windows.find(decontaminate.words_of(pa.array(["x ten fix cow one two six", "two one six"])))
    assert sorted(zip(at.tolist(), size.tolist())) in ([(1, 3), (4, 3)], [(1, 3), (4, 3), (4, 3)])
    assert {windows.names[windows.owner[k]] for e in entry for k in range(windows.owner_from[e], windows.owner_from[e + 1])} == {"a", "b", "c"}


def test_awkward_rows_and_clashing_columns(spark):
    items = spark.createDataFrame([(1, corpus.rows()[0][1], "x")], "item_id bigint, text string, doc_id string")
    df = corpus.frame(spark).withColumnRenamed("n", "found")
    docs, state = decontaminate.scan(df, items)
    assert state not in df.columns and docs.drop(state).columns == df.columns and docs.count() == len(corpus.rows())
    want = brute([(r[0], r[1]) for r in corpus.rows()], [(1, corpus.rows()[0][1])])
    assert sorted(map(repr, map(tuple, decontaminate.report(df, items).collect()))) == sorted(map(repr, want))


def test_empty_tables(spark):
    docs, items = frames(spark, documents(), ITEMS)
    none = brute(documents(), [])
    assert sorted(map(repr, map(tuple, decontaminate.report(docs, items.limit(0)).collect()))) == sorted(map(repr, none))
    assert decontaminate.report(docs.limit(0), items).collect() == []


def test_documents_and_spans_go(spark):
    docs, items = frames(spark, documents(), ITEMS)
    report = brute(documents(), ITEMS)
    kept = decontaminate.without_documents(docs, items)
    assert kept.columns == docs.columns
    assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(repr(d) for d, r in zip(documents(), report) if not r[5])
    some = decontaminate.without_documents(docs, items, share=0.2).collect()
    assert sorted(map(repr, map(tuple, some))) == sorted(repr(d) for d, r in zip(documents(), report) if r[2] <= 0.2 * r[1])
    cut = {r["doc_id"]: r["text"] for r in decontaminate.without_spans(docs, items).collect()}
    w, more = LONG.split(), corpus.sentence(50, 80).split()
    assert cut[3] == " ".join(more[:30]) + "  " + " ".join(more[30:])
    assert cut[0] == " ".join(more) and cut[6] is None and cut[7] == "" and cut[9] == "un-ique !" and cut[10] == "a "
    assert cut[13] == "ÜNÏ " and cut[5] == ""
    for key, text in cut.items():
        n = [r for r in report if r[0] == key][0]
        assert len(words(text)) >= n[1] - n[2] if key is not None else True
    assert w

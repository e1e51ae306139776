"""Fingerprints: chunks by the rule, survival of shifts, edits and neighbours against plain code."""

import hashlib

import corpus
import numpy as np
import pyarrow as pa
import pytest

from regionscore.llm import fingerprints as fp


def plain_cuts(data: bytes):
    """Chunk by chunk, as the rule says."""
    h = lambda i: sum(int(fp._GEAR[data[i - k]]) << k for k in range(8) if i - k >= 0) % 2**32
    out, start = [], 0
    while start < len(data):
        end = min(len(data), start + fp.MOST)
        for cut in range(start + fp.LEAST, end):
            bits = fp.HARD_BITS if cut < start + fp.NORMAL else fp.EASY_BITS
            if h(cut - 1) >> (32 - bits) == 0:
                end = cut
                break
        out.append((start, end))
        start = end
    return out


@pytest.mark.parametrize("text", ["", "a", corpus.sentence(1, 300), "x" * 1000, "漢字" * 300, corpus.sentence(2, 50) + "y" * 500 + corpus.sentence(3, 50)])
def test_cuts_follow_the_rule(text):
    data = text.encode()
    start, end = fp.cuts(np.frombuffer(data, np.uint8), np.array([0, len(data)])) if data else ([], [])
    assert list(zip(list(start), list(end))) == plain_cuts(data)


def test_chunks_of_a_text_do_not_depend_on_neighbours():
    texts = [corpus.sentence(i, 80) for i in range(5)] + ["", "short"]
    both = fp.as_text(fp.chunk_keys(pa.array(texts)), len(texts)).to_pylist()
    assert both == [fp.as_text(fp.chunk_keys(pa.array([t])), 1)[0].as_py() for t in texts]


def test_shift_keeps_most_chunks():
    text = corpus.sentence(4, 400)
    keys = fp.chunk_keys(pa.array([text])), fp.chunk_keys(pa.array(["put before " + text]))
    assert fp.contained(*keys, 1)[0] > 0.95


def brute(rows):
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -(2**63)), r[1] or ""))
    out = []
    for (key, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        one = lambda t: fp.chunk_keys(pa.array([t]))
        string = lambda t: fp.as_text(one(t), 1)[0].as_py()
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), string(text), string(edited),
                    round(float(fp.contained(one(text), one(edited), 1)[0]), 9), round(float(fp.contained(one(text), one(after), 1)[0]), 9)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("per_part", [3, 20_000])
def test_edits_of_odd_rows(spark, monkeypatch, per_part):
    monkeypatch.setattr(fp, "next_to_each_other", lambda df, f=fp.next_to_each_other: f(df, per_part))
    got = [tuple(r) for r in fp.edited_fingerprints(corpus.frame(spark)).collect()]
    assert sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in got), key=repr) == brute([(r[0], r[1]) for r in corpus.rows()])


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(5, "alone with itself, and nobody else around")], "doc_id bigint, text string")
    r = fp.edited_fingerprints(one).first()
    assert r["near_next"] == 1.0 and r["n_chars"] == 41
    assert fp.edited_fingerprints(corpus.empty(spark)).count() == 0 and fp.fingerprint(corpus.empty(spark)).count() == 0


def test_fingerprints_and_likeness(spark):
    got = fp.fingerprint(corpus.frame(spark))
    rows = {}
    for r in got.collect():
        rows.setdefault(r["doc_id"], []).append(r["fingerprint"])
    assert rows[1] == rows[2] and rows[5] == rows[6] == [""] and len(rows[11]) == 2
    a, b = got.filter("doc_id = 1").selectExpr("fingerprint as a"), got.filter("doc_id = 4").selectExpr("fingerprint as b")
    x = a.crossJoin(b).select(fp.likeness(a["a"], b["b"]).alias("x")).first()["x"]
    texts = {r[0]: r[1] for r in corpus.rows()}
    one = lambda k: fp.chunk_keys(pa.array([texts[k]]))
    assert abs(x - fp.contained(one(1), one(4), 1)[0]) < 1e-12 and x > 0.8


def test_whole_table(spark):
    from regionscore.llm.queries import QUERIES, table

    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    got = [tuple(r) for r in QUERIES["op4_fingerprints"](spark, sf).collect()]
    assert sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in got), key=repr) == brute(rows)

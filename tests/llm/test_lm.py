"""Language-model scores: exact unigram part, normalised probabilities, better than unigrams on held-out texts."""

import re
import zlib
from collections import Counter
from math import log10

import corpus
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from regionscore.llm import lm
from regionscore.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def unigrams(rows, learns):
    counts = Counter(t for (_, text), use in zip(rows, learns) if use for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for key, text in rows:
        own = tokens(text)
        out.append((key, len(own), sum(counts[t] > 0 for t in own), total, sum(log10((counts[t] + 1) / (total + distinct + 1)) for t in own)))
    return out


def same(got, want):
    assert len(got) == len(want)
    order = lambda r: (r[0] is None, r[0] or 0, round(r[4], 3), r[1])
    for g, w in zip(sorted(got, key=order), sorted(want, key=order)):
        assert g[:4] == w[:4] and abs(g[4] - w[4]) <= 1e-9 * max(1, abs(w[4]))


def test_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k, _ in rows}
    got = QUERIES["op1_lm_score"](spark, SF).collect()
    same([(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got], unigrams(rows, [not held[k] for k, _ in rows]))
    assert all(r["held_out"] == held[r["doc_id"]] for r in got)
    out = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out) + 0.1 * sum(r["n_tokens"] for r in out)


@pytest.mark.parametrize("learns", ["some", "none"])
def test_odd_rows(spark, learns):
    use = F.col("doc_id") % 3 != 0 if learns == "some" else F.lit(False)
    got = lm.score(corpus.frame(spark), use).collect()
    rows = [(r[0], r[1]) for r in corpus.rows()]
    same([tuple(r)[:5] for r in got], unigrams(rows, [learns == "some" and k is not None and k % 3 != 0 for k, _ in rows]))
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_empty_table(spark):
    assert lm.score(corpus.empty(spark), F.lit(True)).count() == 0


def model(spark, texts):
    settings = lm.Settings(words=20, groups=4, frequent=30, width=6)
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    counts = lm.word_counts(df, settings)
    v = lm.vocabulary(counts, len(texts), settings)
    return v, counts, lm.tables(spark, lm.train(df, v, texts))


def test_probabilities_add_up_to_one(spark):
    texts = [corpus.sentence(i, 60) for i in range(30)]
    v, counts, t = model(spark, texts)
    every = np.arange(v.size)
    for one, two in ((v.size, v.size), (0, v.size), (3, 22), (v.end - 1, 5)):
        p = 10 ** t.log10(every, np.full(v.size, one), np.full(v.size, two))
        assert abs(p.sum() - 1) < 1e-4
    # Within a group: its words outside the classes, and one unknown word.
    own = {int(h) for h, c in zip(v.hashes.view(np.int64), v.classes) if c >= 0}
    for g in range(4):
        counted = [r["c"] for r in counts.filter(F.col("grp") == g).collect() if r["word"] not in own]
        assert abs(sum((c + 1) / (v.group_tokens[g] + v.group_words[g] + 1) for c in [*counted, 0]) - 1) < 1e-9


def test_score_is_the_product_of_token_probabilities(spark):
    texts = [corpus.sentence(i % 7, 50) for i in range(20)]
    settings = lm.Settings(words=20, groups=4, frequent=25, width=6)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["score"] for r in lm.score(df, F.lit(True), settings=settings).collect()}
    v, counts, t = model(spark, texts)
    v.settings = settings
    c = {r["word"]: r["c"] for r in counts.collect()}
    h, g, doc = lm.tokenized(pa.array(texts[:1]), 4)
    v2 = lm.vocabulary(counts, len(texts), settings)
    ids, _, one, two = lm.classes_of(v2, h, g, doc, 1)
    total = t.log10(ids, one, two).sum()
    for word, group, cls in zip(h.view(np.int64).tolist(), g.tolist(), ids.tolist()):
        if cls >= settings.words:
            total += log10((c[word] + 1) / (v2.group_tokens[group] + v2.group_words[group] + 1))
    # Two trainings differ in what the averaging adds up first and in the sample's order.
    assert abs(got[0] - total) < 0.05 * abs(total)


def test_context_tells(spark):
    texts = ["left right " * 40 if i % 2 else "up down " * 40 for i in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = lm.score(df, F.lit(True), settings=lm.Settings(words=20, groups=4, frequent=30, width=6, start_epochs=60)).collect()
    assert all(r["score"] > 0.3 * r["base_score"] for r in got)


def test_normaliser_of_contexts_that_disagree(spark):
    """Far apart scores leave no product of exponentials; the sum must hold all the same."""
    r = np.random.default_rng(2)
    m = lm.Model(*(r.normal(0, s, shape).astype("f4") for s, shape in ((30, (9, 4)), (3, (4, 4)), (3, (4, 4)), (30, (8, 4)), (1, (8,)))))
    t = lm.tables(spark, m)
    for one in range(9):
        for two in range(9):
            every = np.arange(8)
            assert abs((10 ** t.log10(every, np.full(8, one), np.full(8, two))).sum() - 1) < 1e-3


def pairs(n, texts):
    """Texts of one pair of words each, over and over; the words of all pairs are equally frequent."""
    words = ["".join(chr(97 + (i // 26**k) % 26) for k in range(3)) + "xy" for i in range(2 * n)]
    return [f"{words[2 * (i % n)]} {words[2 * (i % n) + 1]} " * 30 for i in range(texts)]


def test_context_tells_words_of_a_group(spark):
    """Words without a class are told by their contexts too, and tell them: counts alone give each one in 120."""
    df = spark.createDataFrame(list(enumerate(pairs(60, 960))), "doc_id bigint, text string").coalesce(2)
    got = lm.score(df, F.lit(True), settings=lm.Settings(words=4, groups=2, width=16, batch=256)).collect()
    assert sum(r["score"] for r in got) > 0.75 * sum(r["base_score"] for r in got)


def test_vectors_grow_with_the_words(spark):
    for n in (600, 3000):
        df = spark.createDataFrame([(t,) for t in pairs(n, n)], "text string")
        assert lm.vocabulary(lm.word_counts(df, lm.Settings()), n, lm.Settings()).tree.words == 2 * n - 767


def test_words_of_groups_add_up_to_one(spark):
    texts = [corpus.sentence(i % 9, 60) for i in range(60)]
    settings = lm.Settings(words=20, groups=4, width=6)
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    counts = lm.word_counts(df, settings)
    v = lm.vocabulary(counts, len(texts), settings)
    m = lm.train(df, v, texts)
    t = lm.tables(spark, m)
    assert v.tree.words > 50 and np.abs(m.vectors.nodes).max() > 0.01 and np.abs(m.vectors.own).max() > 0.01
    # Every class, every word with a vector, and what else each group has, after some contexts.
    group = np.zeros(v.tree.words, np.int64)
    by_hash = {r["word"]: r["grp"] for r in counts.collect()}
    for h, w in zip(v.hashes.view(np.int64).tolist(), v.tree.word.tolist()):
        if w < v.tree.words:
            group[w] = by_hash[h]
    ids = np.concatenate((np.arange(20), [v.end], 20 + group, 20 + np.arange(4)))
    word = np.concatenate((np.full(21, v.tree.words), np.arange(v.tree.words), np.full(4, v.tree.words)))
    for one, w1, two, w2 in ((0, v.tree.words, v.size, v.tree.words), (20 + group[3], 3, 5, v.tree.words), (20 + group[9], 9, 20 + group[7], 7)):
        tokens = (ids, *(np.full(len(ids), x) for x in (one, two)), word, *(np.full(len(ids), x) for x in (w1, w2)))
        assert abs((10 ** lm.modelled_log10(v, m, t, tokens)).sum() - 1) < 1e-4


@pytest.mark.parametrize("longer", [1, 30])
def test_normalisers_by_products(spark, longer, monkeypatch):
    """Kept, repeated and single contexts of any pair give the sum over all classes, and a context's exponentials are worked out once."""
    texts = [corpus.sentence(i % 9, 60) for i in range(60)]
    settings = lm.Settings(words=20, groups=4, width=6)
    v = lm.vocabulary(lm.word_counts(spark.createDataFrame([(t,) for t in texts], "text string"), settings), len(texts), settings)
    r, none = np.random.default_rng(4), v.tree.words
    m = lm.fresh(v)
    m.targets *= longer
    m.vectors = lm.Vectors(r.normal(0, 0.3, (len(v.tree.base), 7)).astype("f2"), r.normal(0, 3, (none + 1, 6)).astype("f2"))
    m.vectors.own[-1] = 0
    h, g, doc = lm.tokenized(pa.array(texts), 4)
    ids, found, one, two = lm.classes_of(v, h, g, doc, len(texts))
    word, w1, w2 = lm.words_of(v, found, doc, len(texts))
    a, b = m.inputs(one, two, w1, w2)
    q = np.concatenate((a @ m.near + b @ m.far, np.ones((len(ids), 1), np.float32)), axis=1)
    x = q[:, :-1].astype(float) @ m.targets.T + m.bias
    want = x.max(axis=1) + np.log(np.exp(x - x.max(axis=1)[:, None]).sum(axis=1))
    rows, plain = [], lm._exponentials
    monkeypatch.setattr(lm, "_exponentials", lambda m, q, offsets: rows.append(len(q)) or plain(m, q, offsets))
    for most in (0, 5, none):
        often = lm.kept(v, m, most)
        rows.clear()
        assert np.abs(lm.normalisers(m, q, (one, two, w1, w2), often) - want).max() < 1e-3
        assert sum(rows) < (len(ids) if most == 0 else 1 + 0.7 * len(ids) if most < none else 1)
    # In the families, too, far scores leave no sum of single exponentials.
    m.vectors.nodes *= np.float16(40 if longer > 1 else 1)
    got, at = lm.families(v, m, q, ids, word), np.flatnonzero((ids >= 20) & (ids < v.end))[:200]
    nodes, family, has = v.tree.paths(ids[at] - 20, word[at])
    for i, t in enumerate(at):
        want = 0
        for j in (i, *(len(at) + np.flatnonzero(has == i))):
            of = slice(*v.tree.starts[family[j]:family[j] + 2])
            x = m.vectors.nodes[of].astype(float) @ q[t] + v.tree.base[of]
            want += x[nodes[j] - of.start] - x.max() - np.log(np.exp(x - x.max()).sum())
        assert abs(got[t] - want) < 1e-3 * max(1, abs(want))


def test_places_and_sums():
    """Look-ups that begin at a guess, half floats by their bits and sums of runs are what plain numpy gives."""
    r = np.random.default_rng(5)
    for hashes in (np.sort(r.integers(0, 2**64, 5000, dtype=np.uint64)), np.array([0, 1, 2, 2**64 - 1], np.uint64), np.zeros(0, np.uint64)):
        v = lm.Vocabulary(lm.Settings(), hashes, *[None] * 7)
        asked = np.concatenate((hashes, r.integers(0, 2**64, 5000, dtype=np.uint64), np.array([0, 2**63, 2**64 - 1], np.uint64)))
        places = {h: i for i, h in enumerate(hashes.tolist())}
        assert v.find(asked).tolist() == [places.get(h, -1) for h in asked.tolist()]
    counts = r.integers(1, 50, 900)
    v = lm.Vocabulary(lm.Settings(), *[None] * 8, tree=lm.grown(counts, r.integers(0, 6, 900), counts > 20, np.arange(1.0, 9.0)))
    family = np.sort(r.integers(0, len(v.tree.starts) - 1, 20000))
    draws = r.random(20000)
    plain = np.searchsorted(v.upto, family + draws)
    assert (v.siblings(family, draws) == np.clip(plain, v.tree.starts[family], v.tree.starts[family + 1] - 1)).all()
    half = np.concatenate((r.normal(0, 1, 1000), [0.0, -0.0, 6e-8, 1e-5, -4, 4])).astype("f2")
    assert (lm._single(half) == half.astype("f4")).all()
    for most in (3, 40, 5000):
        by, keys = lm._ordered(r.integers(0, most, 3000))
        values, first = r.normal(0, 1, (3000, 3)), lm._runs(keys)
        want = np.stack([np.bincount(keys, values[:, i])[keys[first]] for i in range(3)], axis=1)
        assert np.abs(lm._sums(values, first) - want).max() < 1e-9

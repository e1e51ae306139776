"""The pipeline, stage by stage, against plain code on a small table."""

import re

import corpus
from test_jaccard import brute as groups

import corpus_pipeline
from regionscore.llm import bpe, langid
from regionscore.llm.common import crc_rest
from regionscore.llm.queries import RANKS, table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    names, columns = [n for n, _ in corpus_pipeline.STAGES], docs.columns
    assert len(names) == 4
    language, distinct, mixture, tokens = (f for _, f in corpus_pipeline.STAGES)

    kept = language(spark, docs, SF).cache()
    model = langid.fit(docs, crc_rest("doc_id", 5) != 0)
    rejected = {r["doc_id"] for r in langid.predict(docs, model).filter("rejected").collect()}
    assert kept.columns == columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - rejected

    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    single = distinct(spark, kept, SF).cache()
    want, _, sets = groups(rows)
    firsts = {c for _, _, c in want}
    assert single.columns == columns and sorted(r["doc_id"] for r in single.collect()) == sorted(firsts) and all(sets)

    mixed = mixture(spark, single, SF).cache()
    assert mixed.columns == columns
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    texts = {r["doc_id"]: r["text"] for r in single.collect()}
    got = mixed.collect()
    assert sum(words(r["text"]) for r in got) == sum(map(words, texts.values()))
    assert all(texts[r["doc_id"]].startswith(r["text"]) and r["n_chars"] == len(r["text"]) for r in got)

    ranks, pattern = bpe.public_vocabulary(RANKS)
    e = bpe.encoder(ranks, pattern)
    assert sorted((r["doc_id"], r["ids"], r["n_tokens"]) for r in tokens(spark, mixed, SF).collect()) == sorted((r["doc_id"], e.encode(r["text"]), len(e.encode(r["text"]))) for r in got)


def test_run_and_odd_rows(spark):
    whole = corpus_pipeline.run(spark, SF)
    assert whole.count() > 0 and {"doc_id", "ids", "n_tokens"} <= set(whole.columns)
    docs = corpus.frame(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == corpus.frame(spark).columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0
    none = corpus.empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, SF)
    assert none.count() == 0

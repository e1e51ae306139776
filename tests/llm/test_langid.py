"""Language identification: held-out accuracy, rejection, rows that say nothing."""

import corpus
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from regionscore.llm import langid
from regionscore.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_no_leak(spark):
    docs = table(spark, SF, "documents").select("doc_id", "lang")
    got = QUERIES["op3_language_id"](spark, SF).join(docs, "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == table(spark, SF, "documents").count()
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert sum(r["rejected"] for r in got) <= 0.01 * len(got)


def test_odd_rows(spark):
    docs = corpus.frame(spark)
    model = langid.fit(docs, F.lit(True))
    assert model.labels == ["de", "en"]
    got = {r["doc_id"]: r for r in langid.predict(docs, model).filter("doc_id is not null").collect()}
    for key in (5, 6, 7, 10):
        assert (got[key]["lang_pred"], got[key]["score"], got[key]["rejected"]) == ("und", 0.0, True)
    assert got[12]["lang_pred"] in ("en", "de")
    assert langid.predict(docs, model).count() == len(corpus.rows())
    kept = langid.accept(docs, model)
    assert kept.schema == docs.schema
    rejected = langid.predict(docs, model).filter("rejected").count()
    assert kept.count() == len(corpus.rows()) - rejected


def test_empty_tables(spark):
    none = corpus.empty(spark)
    model = langid.fit(none, F.lit(True))
    assert langid.predict(none, model).count() == 0 and langid.accept(none, model).count() == 0
    alone = langid.predict(corpus.frame(spark), model).collect()
    assert {(r["lang_pred"], r["rejected"]) for r in alone} == {("und", True)}


def test_prediction_is_mean_embedding_and_softmax():
    model = langid.train(["aaa bbb", "ccc ddd"] * 10, ["x", "y"] * 10)
    buckets, offsets = langid.features(pa.array(["aaa bbb ccc"]))
    values = model.table[buckets].mean(axis=0) + model.bias
    e = np.exp(values / model.temperature - (values / model.temperature).max())
    names, score, _ = langid.classify(pa.array(["aaa bbb ccc"]), np.array([True]), model)
    assert names == [model.labels[values.argmax()]] and abs(score[0] - (e / e.sum()).max()) < 1e-5


def test_features_do_not_depend_on_neighbours():
    alone, _ = langid.features(pa.array(["some text"]))
    both, offsets = langid.features(pa.array(["other", "some text", ""]))
    assert sorted(both[offsets[1]:offsets[2]]) == sorted(alone) and offsets[2] == offsets[3]

"""Language identification: averaged hashed subword embeddings with a linear softmax, and calibrated rejection.

The features of a text are its byte 2-, 3- and 4-grams inside words (a word's borders count as a byte). A hashed
table holds an embedding for each; their mean goes through a linear softmax, trained by stochastic gradient
descent in numpy. Mean and softmax input are linear, so a trained model is applied as one row of class values
for each bucket (embeddings times output weights), added up over the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regionscore.llm.common import as_bytes, blocks, free_name, key_and_text, quoted, text_column

#: Label of texts without a letter.
UNDETERMINED = "und"
BUCKET_BITS = 16
#: Letters in lower case and all bytes of longer code points; everything else is a border.
_LETTER = np.zeros(256, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


@dataclass
class Sample:
    """Bounds of the training sample: so many texts of a language, a window of so many characters of each, and so
    many languages (the commonest). The windows start at hashed places.
    """

    per_language: int = 500
    window: int = 2000
    languages: int = 200


@dataclass
class Model:
    """Values of each class by bucket, offsets of the classes, and the calibration."""

    labels: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords, text by text, and their offsets."""
    framed = pc.binary_join_element_wise(pa.scalar(""), texts.cast(pa.string()), pa.scalar(""), "\n")
    data, offsets = as_bytes(framed)
    m = _LETTER[data].astype(np.uint32)
    inside = m > 0
    n = len(m)
    found, counts = [], []
    for size in (2, 3, 4):
        if n < size:
            continue
        end = n - size + 1
        good = inside[1:1 + end].copy() if size > 2 else inside[:end] & inside[1:1 + end]
        if size == 4:
            good &= inside[2:2 + end]
        h = m[:end].copy()
        for k in range(1, size):
            h |= m[k:k + end] << np.uint32(8 * k)
        at = np.flatnonzero(good)
        h = h[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(size * 0x632BE5AB)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        found.append((h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
        counts.append(np.searchsorted(at, offsets))
    if not found:
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    out_offsets = np.sum(counts, axis=0)
    out = np.empty(out_offsets[-1], np.int64)
    place = out_offsets[:-1].copy()
    for buckets, edges in zip(found, counts):
        size = np.diff(edges)
        out[np.repeat(place - edges[:-1], size) + np.arange(edges[-1])] = buckets
        place += size
    return out, out_offsets


def mean_rows(table: np.ndarray, buckets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean of the table's rows over each text's buckets; zeros for none."""
    size = np.diff(offsets)
    out = np.zeros((len(size), table.shape[1]), table.dtype)
    some = size > 0
    if some.any():
        out[some] = np.add.reduceat(table[buckets], offsets[:-1][some], axis=0) / size[some, None]
    return out


def softmax(values: np.ndarray) -> np.ndarray:
    e = np.exp(values - values.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[str], langs: list[str], width: int = 16, epochs: int = 4, rate: float = 12.0, piece: int = 300, seed: int = 7) -> Model:
    """Fit embeddings and softmax on pieces of the texts; every fifth text only calibrates.

    The temperature minimises the log loss of the calibration pieces. A text is rejected when its calibrated
    confidence is below what all but a thousandth of the rightly labelled calibration pieces reach, at most 0.5.
    """
    labels = sorted(set(langs))
    number = {x: i for i, x in enumerate(labels)}
    cut, own, kept = [], [], []
    for i, (text, lang) in enumerate(zip(texts, langs)):
        for a in range(0, max(len(text), 1), piece):
            cut.append(text[a:a + piece])
            own.append(number[lang])
            kept.append(i % 5 == 4)
    classes, held = np.array(own, np.int64), np.array(kept, bool)
    buckets, offsets = features(pa.array(cut, pa.string()))
    size = np.diff(offsets)
    random = np.random.default_rng(seed)
    table = random.normal(0, 0.1, (1 << BUCKET_BITS, width)).astype(np.float32)
    weights, bias = np.zeros((width, len(labels)), np.float32), np.zeros(len(labels), np.float32)
    fit = np.flatnonzero(~held & (size > 0))
    steps = max(1, epochs * -(-len(fit) // 64))
    step = 0
    for _ in range(epochs):
        order = random.permutation(fit)
        for a in range(0, len(order), 64):
            rows = order[a:a + 64]
            lengths = size[rows]
            starts = np.concatenate(([0], np.cumsum(lengths)))
            f = buckets[np.repeat(offsets[rows] - starts[:-1], lengths) + np.arange(starts[-1])]
            hidden = np.add.reduceat(table[f], starts[:-1], axis=0) / lengths[:, None]
            wrong = softmax(hidden @ weights + bias)
            wrong[np.arange(len(rows)), classes[rows]] -= 1
            wrong /= len(rows)
            lr = rate * (1 - step / steps)
            back = (wrong @ weights.T).astype(np.float32)
            weights -= lr * 0.5 * (hidden.T @ wrong).astype(np.float32)
            bias -= lr * 0.05 * wrong.sum(axis=0).astype(np.float32)
            by = np.argsort(f, kind="stable")
            g = f[by]
            first = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
            share = (back * 64 / lengths[:, None]).astype(np.float32)
            table[g[first]] -= lr * np.add.reduceat(share[np.repeat(np.arange(len(rows)), lengths)[by]], first, axis=0)
            step += 1
    linear = (table @ weights).astype(np.float32)
    test = np.flatnonzero(held & (size > 0))
    temperature, threshold = 1.0, 0.0
    if len(test) and len(labels) > 1:
        values = (mean_rows(linear, buckets, offsets) + bias)[test].astype(np.float64)
        right = classes[test]
        loss = lambda t: -np.log(softmax(values / t)[np.arange(len(test)), right] + 1e-300).mean()
        temperature = min(np.geomspace(0.05, 20, 61), key=loss)
        p = softmax(values / temperature)
        sure = p.max(axis=1)[p.argmax(axis=1) == right]
        threshold = float(min(0.5, np.quantile(sure, 0.001))) if len(sure) else 0.0
    return Model(labels, linear, bias.astype(np.float32), float(temperature), threshold)


def training_sample(df: DataFrame, id_col: str, text_col: str, lang_col: str, learn: Column, sample: Sample) -> list[tuple[str, str]]:
    """At most `sample.languages * sample.per_language` windows of texts with their language, chosen by a hash of key and text."""
    text, lang = F.col(quoted(text_col)), F.col(quoted(lang_col)).cast("string")
    rows = df.filter(learn & text.isNotNull() & lang.isNotNull()).select(lang.alias("lang"), F.xxhash64(F.col(quoted(id_col)), text).alias("h"), text.alias("text"))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(sample.languages).collect()
    if not counts:
        return []
    # A hash lets about twice as many through as are wanted, so that the ranking within a language stays small.
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, 2.0 * sample.per_language / r["n"]))])
    rows = rows.filter((F.shiftrightunsigned("h", 11) / 2.0**53 < F.element_at(share, F.col("lang"))) & F.col("text").rlike(r"\p{L}"))
    start = F.pmod(F.xxhash64("h"), F.greatest(F.length("text") - sample.window, F.lit(0)) + 1) + 1
    rows = rows.select("lang", "h", F.substring("text", start.cast("int"), F.lit(sample.window)).alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    chosen = rows.withColumn("n", rank).filter(F.col("n") <= sample.per_language).select("text", "lang", "n").collect()
    return [(r["text"], r["lang"]) for r in sorted(chosen, key=lambda r: (r["n"], r["lang"], r["text"]))]


PREDICTED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("lang_pred", T.StringType()),
    T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])


def fit(df: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: Sample | None = None) -> Model:
    """A model of the languages in `lang_col`, from the rows where `learn` holds and neither text nor language is NULL."""
    rows = training_sample(df, id_col, text_col, lang_col, learn, sample or Sample())
    return train([t for t, _ in rows], [x for _, x in rows])


def classify(texts: pa.Array, letters: np.ndarray, model: Model) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, calibrated confidence and rejection of each text. `letters`: the text holds a letter."""
    rows = len(texts)
    if not model.labels:
        return [UNDETERMINED] * rows, np.zeros(rows), np.ones(rows, bool)
    values = (mean_rows(model.table, *features(texts)) + model.bias).astype(np.float64)
    p = softmax(values / model.temperature)
    best = p.argmax(axis=1)
    score = np.where(letters, p[np.arange(rows), best], 0.0)
    names = [model.labels[b] if ok else UNDETERMINED for b, ok in zip(best.tolist(), letters.tolist())]
    return names, score, ~letters | (score < model.threshold)


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, lang_pred, score, rejected` of every row, from its whole text only.

    A NULL text, or one without a letter, is `und` with score 0 and rejected; so is every text if the model knows
    no language. Repeated rows and NULL keys stay as they are; other columns are left out.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            letters = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            names, score, rejected = classify(text_column(batch, "text"), letters, shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(rejected)], PREDICTED.names)

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")
    return key_and_text(df, id_col, text_col).select("key", "text", letter).mapInArrow(run, PREDICTED)


def accept(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of `df`, all columns as they are, whose language is not rejected (see `predict`); an empty table stays empty."""
    shared, place = df.sparkSession.sparkContext.broadcast(model), df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            letters = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
            keep = pa.array(~classify(pc.fill_null(batch.column(place).cast(pa.string()), ""), letters, shared.value)[2])
            yield pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1]).filter(keep)

    letter = F.coalesce(F.col(quoted(text_col)).cast("string").rlike(r"\p{L}"), F.lit(False))
    letter = letter.alias(free_name(df.columns, "letters"))
    return df.select(*[F.col(quoted(c)) for c in df.columns], letter).mapInArrow(run, df.schema)

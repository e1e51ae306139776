"""Documents to token ids: stages that each read what the one before has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regionscore.landing import land
from regionscore.llm import bpe, jaccard, langid, mixing
from regionscore.llm.common import crc_rest
from regionscore.llm.queries import MIX_EPOCHS, MIX_LEVELS, MIX_SEED, MIX_WEIGHTS, RANKS, with_domain


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough confidence; texts without letters and NULL texts go."""
    model = langid.fit(docs, learn=crc_rest("doc_id", 5) != 0)
    return langid.accept(docs, model)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with similar sets of five-word shingles, the one with the smallest id."""
    return jaccard.unique(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many words as there are, dealt to domains, languages and sources by weight, each source up to twice.

    A document that a source gives twice is there twice; the one at which a source's budget ends is cut.
    """
    mixed = mixing.mix(with_domain(docs), MIX_LEVELS, [F.expr(w) for w in MIX_WEIGHTS], (1, 1), MIX_EPOCHS, MIX_SEED)
    return mixed.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), "n_chars")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id`, the token `ids` and `n_tokens` of every document that is left."""
    ranks, pattern = bpe.public_vocabulary(RANKS)
    return bpe.encode(docs, ranks, pattern).withColumn("n_tokens", F.size("ids").cast("bigint"))


STAGES = [("language ID", language), ("n-gram Jaccard join", distinct), ("mixing sources to target weights", mixture), ("byte-level BPE", tokens)]
#: The stages train a model and run numpy code; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each on the Parquet files of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

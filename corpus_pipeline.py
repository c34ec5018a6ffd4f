"""The corpus pipeline: documents in, encoded training rows out.

Each stage works on all rows that its predecessor kept. The first four return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskloom.llm import byte_bpe, language_id, mixing, ngram_join, quality_classifier
from maskloom.llm.queries import bpe_digests

SEED = 0
#: a text is kept if its predicted language is this probable
SURE = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling selects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.score(docs, labels, SEED, with_text=True).where("kept").select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; ``lang`` becomes the predicted language."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    names, model = language_id.learn(docs, path)
    told = language_id.identify(docs, names, model, path, with_text=True)
    return told.where((F.col("lang_pred") != "und") & (F.col("score") >= SURE)).withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of the smallest id; of rows with that id the first by text."""
    return ngram_join.representatives(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target proportions, in whole texts."""
    return mixing.repeated(mixing.mix(docs, SEED), docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, with digests of them and of what they decode to."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    kept = [c for c in docs.columns if c not in ("text", "n_chars")]
    return bpe_digests(byte_bpe.round_trip(docs.select(*kept, "text"), path, pattern), *kept, "ids")


STAGES = [
    ("quality classifier", quality),
    ("language id", language),
    ("near duplicates", near_duplicates),
    ("source mixing", mix),
    ("byte bpe", encode),
]
#: importance resampling, language models and byte-pair contraction have no SQL form; tests use brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what a stage returns is written to the shared folder and read again by the next."""
    store = ngram_join.Stored(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = store.put(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs

"""The pipeline over documents: each stage calls one operator on all its predecessor kept.

Rejected by the quality classifier, exact copies, near copies by SimHash and documents
with benchmark passages go, in this order; the last stage encodes what is left and decodes
it again. Every stage but the last returns the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from payscope.llm import decontaminate, exact_dedup, quality, sentencepiece_codec, simhash
from payscope.llm.common import importable, table
from payscope.session import scratch_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), decoded=True)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_copies),
    ("SimHash near-dedup", near_copies),
    ("benchmark decontamination", benchmark_passages),
    ("SentencePiece encoding and decoding", round_trip),
]

#: A learned classifier and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again as the next one's input."""
    importable(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

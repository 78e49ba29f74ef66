"""The corpus pipeline: five of the corpus operators applied to ``documents`` in turn.

Every stage reads what its predecessor wrote below the shared checkpoint
folder, so an executor that is lost costs at most its part of one stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from cauce.llm import decontaminate, line_dedup, near_dedup, quality_rules, sentencepiece_codec
from cauce.llm.common import prepare
from cauce.llm.queries import tokenizer_path
from cauce.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the quality rules or come from a rejected host."""
    prepare(spark)
    return quality_rules.keep(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that an earlier document holds; ``n_chars`` counts what is left.  Keeps every document."""
    prepare(spark)
    return line_dedup.dedup(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each class of near copies."""
    prepare(spark)
    return near_dedup.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    prepare(spark)
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the SentencePiece ids of each text."""
    prepare(spark)
    return sentencepiece_codec.encode_rows(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("minhash_near_dedup", near),
          ("benchmark_decontamination", benchmark), ("sentencepiece_encoding", encoding)]

#: SQL can express neither the sketches and alignments nor the encoding; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    base = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs

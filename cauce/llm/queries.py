"""Queries of the corpus operators over whole tables, with their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cauce.llm import decontaminate, line_dedup, near_dedup, periodic_runs, pii, pivot_search, quality_classifier, quality_rules, secrets, sentencepiece_codec, spelling, token_counts, toxicity
from cauce.llm.common import prepare
from cauce.llm.oracles import ORACLES  # noqa: F401  (re-exported)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir.rstrip("/"))

    QUERIES[fn.__name__] = run
    return run


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_quality_rules(spark, sf_dir):
    return quality_rules.judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_rejected")


@query
def op2_pii(spark, sf_dir):
    return pii.digest(pii.personal_data(documents(spark, sf_dir)))


@query
def op3_toxicity(spark, sf_dir):
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op4_line_dedup(spark, sf_dir):
    return line_dedup.report(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op5_decontamination(spark, sf_dir):
    return decontaminate.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op6_quality_classifier(spark, sf_dir):
    return quality_classifier.quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op7_sentencepiece(spark, sf_dir):
    out = sentencepiece_codec.encode(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "round_trip")


@query
def op8_token_counts(spark, sf_dir):
    return token_counts.token_counts(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


@query
def op9_near_dedup(spark, sf_dir):
    return near_dedup.labelled(documents(spark, sf_dir))


@query
def op10_secrets(spark, sf_dir):
    return secrets.digest(secrets.secrets(documents(spark, sf_dir)))


@query
def op11_periodic_runs(spark, sf_dir):
    return periodic_runs.digest(periodic_runs.periodic_runs(documents(spark, sf_dir), alter=periodic_runs.looped))


@query
def op12_pivot_search(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return pivot_search.nearest(vectors, F.col("vec_id") % 20 == 0).select("query_id", "rank", "vec_id", "score")


@query
def op13_spelling_variants(spark, sf_dir):
    return spelling.variants(documents(spark, sf_dir))

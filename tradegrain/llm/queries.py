"""The registered queries: each operator with its own parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradegrain.llm import (alignment, decontaminate, interpolation, language, licenses, lines,
                            packing, repeats, search, secrets, simhash, toxicity, vectors)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.report(_table(spark, folder, "documents"),
                                _table(spark, folder, "benchmark")).drop("spans", "longest_match")


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = repeats.remove_repeats(_table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed",
                       F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(_table(spark, folder, "documents"))


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), with_ids=False)


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op6_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(_table(spark, folder, "embeddings"))


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(_table(spark, folder, "documents"))


def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(_table(spark, folder, "documents")).drop("spans")


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents"))


def op10_interpolation(spark: SparkSession, folder: str) -> DataFrame:
    return interpolation.score(_table(spark, folder, "documents"))


def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = lines.remove_lines(_table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2("kept_text", 256).alias("kept_sha256"))


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(_table(spark, folder, "documents"))


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q for q in (op1_decontaminate, op2_substring_dedup, op3_secrets, op4_packing,
                            op5_toxicity, op6_vector_dedup, op7_language, op8_licenses,
                            op9_simhash, op10_interpolation, op11_line_dedup, op12_alignment,
                            op13_ranked_search, pipeline)}

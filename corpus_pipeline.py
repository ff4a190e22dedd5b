"""From raw documents to packed training sequences, stage by stage.

Each stage is a function of (spark, docs, sf_dir); what it returns is written as Parquet in the
shared folder and read again as the next stage's documents. All but the last keep the columns of
`documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradegrain.llm import decontaminate, packing, secrets, simhash, toxicity
from tradegrain.session import settle

# The stages learn from labels and end in a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.remove_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, with_ids=False)


STAGES = [
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("decontamination", remove_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs

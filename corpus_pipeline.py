"""From raw documents to packed sequences: five stages, each one operator of ``loomframe.llm``.

Every stage takes all that its predecessor kept. Documents the quality classifier rejects go, then
exact copies, then all but one of each SimHash group; secrets are masked in the text; the rest is
packed. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loomframe.llm import exact_dedup, packing, quality, secret_scan, simhash
from loomframe.llm.queries import WORD_MODEL
from loomframe.session import stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = secret_scan.redact(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, WORD_MODEL)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("secret scans", secrets),
    ("packing", packed),
]

#: A learned model and a tokenizer have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, function) in enumerate(STAGES):
        docs = stage(function(spark, docs, sf_dir), f"stage{number}")
    return docs

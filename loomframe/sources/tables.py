"""Relational tables stored as parquet, and the views built on them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# The tables of the test data.
TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def load_tables(
    spark: SparkSession, folder: str, names: Iterable[str] = TABLE_NAMES
) -> dict[str, DataFrame]:
    return {name: table(spark, folder, name) for name in names}


def register_views(
    spark: SparkSession, folder: str, names: Iterable[str] = TABLE_NAMES
) -> dict[str, DataFrame]:
    """Load the tables and name each one, so SQL text and views can refer to them."""
    tables = load_tables(spark, folder, names)
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return tables

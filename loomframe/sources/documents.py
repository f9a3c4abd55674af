"""JSON document collections, and results kept as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_documents(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.json(path)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Replace the stored collection at ``path`` and return it as stored."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def to_key_values(df: DataFrame, key: str, value: str) -> DataFrame:
    """Key/value rows; a caller who knows the result is small may ``collect()`` them to a dict."""
    return df.select(F.col(key).cast("string").alias("key"), F.col(value).alias("value"))


def url_list(df: DataFrame, url: str, order_by: str, n: int = 10) -> DataFrame:
    """The first ``n`` addresses, each with the number of addresses in the whole table."""
    total = df.select(F.count(url)).scalar()
    first = df.select(url, order_by).orderBy(order_by).limit(n)
    return first.select(F.col(order_by), F.col(url), total.alias("n_urls"))

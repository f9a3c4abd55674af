"""Concatenation and duplicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def concat(dfs: Sequence[DataFrame]) -> DataFrame:
    """All rows of tables with the same columns."""
    return reduce(DataFrame.unionByName, dfs)


def _digest(df: DataFrame) -> Column:
    """256 bits that stand for a whole row, so that long texts do not travel as keys."""
    return F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).cast("binary"), 256)


def dedupe(df: DataFrame, cols: Sequence[str] = ()) -> DataFrame:
    """Distinct rows over all columns, or distinct values of some."""
    return (df.select(*cols) if cols else df).distinct()


def duplicate_count(df: DataFrame, cols: Sequence[str] = ()) -> DataFrame:
    """How many rows repeat an earlier row; only digests of the rows are shuffled."""
    kept = df.select(*cols) if cols else df
    copies = kept.select(_digest(kept).alias("d")).groupBy("d").agg(F.count("*").alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"))


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """First row per key in the given order.

    The rank filter is applied before the shuffle too (WindowGroupLimit), so each task sends at
    most one row per key however hot the key is.
    """
    if not order_by:
        raise ValueError("keeping the first row needs an order: name the order_by columns")
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")

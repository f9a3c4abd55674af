"""Documents with array fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from loomframe.operators.ordering import number_rows


def unwind(df: DataFrame, array: str, name: str | None = None) -> DataFrame:
    """One row per element in place of the array; rows with an empty or NULL array go."""
    name = name or array
    kept = [c for c in df.columns if c != array]
    return df.select(*kept, F.explode(array).alias(name))


def unwind_chain(df: DataFrame, arrays: Sequence[str]) -> DataFrame:
    """Unwind several arrays in turn: each document gives the product of their lengths."""
    for array in arrays:
        df = unwind(df, array)
    return df


def array_pull(df: DataFrame, array: str, value) -> DataFrame:
    """Remove every occurrence of a value from an array."""
    return df.withColumn(array, F.array_remove(array, value))


def fill_empty_array(df: DataFrame, array: str, value) -> DataFrame:
    """Put a single value into empty arrays; NULL stays NULL."""
    filled = F.when(F.size(array) == 0, F.array(F.lit(value))).otherwise(F.col(array))
    return df.withColumn(array, filled)


def push_records(
    df: DataFrame, key: str, fields: Sequence[str], order_by: Sequence[str], chunk: int = 10_000
) -> DataFrame:
    """Collect the records of each key into arrays, in order.

    A key with more than ``chunk`` records gets several rows, numbered by ``part``, so that no
    array outgrows a task.
    """
    numbered = number_rows(df.select(key, *fields), order_by, within=[key], name="__no")
    parts = numbered.withColumn("part", F.floor((F.col("__no") - 1) / chunk).cast("int"))
    records = F.array_sort(F.collect_list(F.struct("__no", *fields)))
    packed = parts.groupBy(key, "part").agg(records.alias("records"))
    return packed.withColumn(
        "records", F.transform("records", lambda r: F.struct(*[r[f].alias(f) for f in fields]))
    )

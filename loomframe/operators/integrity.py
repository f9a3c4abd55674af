"""Reports in place of constraints: each returns the offending keys or rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def check_pk(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, or hold a NULL."""
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    counts = df.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    return counts.where((F.col("n_rows") > 1) | has_null)


def check_fk(
    child: DataFrame, parent: DataFrame, child_keys: Sequence[str], parent_keys: Sequence[str]
) -> DataFrame:
    """Child rows whose key is not in the parent; a NULL key refers to nothing and is fine."""
    known = parent.select(*[F.col(k).alias(f"__{k}") for k in parent_keys]).distinct()
    refs = child.dropna(subset=list(child_keys))
    same = [F.col(c) == F.col(f"__{p}") for c, p in zip(child_keys, parent_keys)]
    return refs.join(known, same, "left_anti")


def check_length(df: DataFrame, column: str, longest: int) -> DataFrame:
    """Rows whose text is longer than allowed."""
    return df.where(F.length(column) > longest)

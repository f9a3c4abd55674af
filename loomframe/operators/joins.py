"""Joins and subqueries.

Sides are joined without hints: Spark broadcasts a side whose size is known to be below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, splitting skewed partitions at
run time. Children are aggregated before they are joined to their parent wherever that keeps
the result, so that one hot parent shrinks to one row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

HOT_ROWS = 1_000_000    # rows of one key that one task may join


def join_agg(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    by: Sequence[str],
    sums: dict[str, Column] | None = None,
    count: str | None = None,
) -> DataFrame:
    """Counts and sums of a fact table grouped by columns of its dimension.

    The fact is first folded to one row per join key, which needs no more than partial
    aggregation on the map side; the join then sees distinct keys only.
    """
    sums = sums or {}
    partial = [F.sum(e).alias(name) for name, e in sums.items()]
    partial.append(F.count("*").alias("__rows"))
    folded = fact.groupBy(F.col(fact_key).alias("__key")).agg(*partial)
    joined = folded.join(dim, F.col("__key") == F.col(dim_key))
    final = [F.sum(name).alias(name) for name in sums]
    if count:
        final.append(F.sum("__rows").alias(count))
    return joined.groupBy(*by).agg(*final)


def left_join_stats(
    parent: DataFrame, child: DataFrame, parent_key: str, child_key: str, value: str,
    mean: str, count: str,
) -> DataFrame:
    """Every parent with the mean and number of its children; 0 and NULL without any."""
    stats = child.groupBy(F.col(child_key).alias("__key")).agg(
        F.sum(value).alias("__sum"), F.count(value).alias("__n")
    )
    joined = parent.join(stats, parent[parent_key] == F.col("__key"), "left")
    n = F.coalesce("__n", F.lit(0))
    return joined.withColumns(
        {mean: F.col("__sum") / F.when(n > 0, n), count: n}
    ).drop("__key", "__sum", "__n")


def join_multi(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    return left.join(right, list(keys), how)


def salted_join(
    rows: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    size: str,
    salt_on: Column,
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    null_safe: bool = False,
) -> DataFrame:
    """Join facts (one row per key) to rows of which one key may hold a large share.

    ``size`` is a column of ``facts`` with the number of rows of each key. A key with more than
    ``hot_rows`` is cut into salted parts, and its fact repeated once per part; other keys join
    as usual. The few hot keys are joined without a hint: Spark broadcasts them while they fit its
    threshold. Aggregations after the join start from the spread as well. ``null_safe`` joins a
    NULL key to the fact of NULL instead of nothing.
    """
    keys = list(keys)
    if null_safe:
        named = [f"__key{i}" for i in range(len(keys))]
        # a struct is never NULL itself, and equal structs may hold equal NULLs
        held = {n: F.struct(F.col(k).isNull().alias("n"), F.coalesce(F.col(k).cast("string"), F.lit("")).alias("v")) for n, k in zip(named, keys)}
        joined = salted_join(
            rows.withColumns(held), facts.withColumns(held).drop(*keys), named, size, salt_on, how, hot_rows
        )
        return joined.drop(*named)
    parts = F.ceil(F.col(size) / hot_rows)
    hot = facts.where(F.col(size) > hot_rows).select(*keys, parts.alias("__parts"))
    n_parts = F.coalesce("__parts", F.lit(1).cast("bigint"))
    marked = rows.join(hot, keys, "left")
    salted = marked.withColumn("__salt", F.pmod(F.xxhash64(salt_on), n_parts)).drop("__parts")
    last = F.greatest(F.coalesce(parts, F.lit(1)), F.lit(1)) - 1
    copies = facts.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    return salted.join(copies, [*keys, "__salt"], how).drop("__salt")


def profit_view(
    parent: DataFrame,
    key: str,
    visits: DataFrame,
    visit_key: str,
    costs: DataFrame,
    cost_key: str,
    cost: Column,
    price: Column,
    rent: Column,
) -> DataFrame:
    """``price * visits - cost - rent`` per parent.

    Each child is aggregated on its own before the join, so the two do not multiply each
    other. A parent without cost rows has no profit (NULL); one without visits has 0 visits.
    """
    n_visits = visits.groupBy(F.col(visit_key).alias("__v")).agg(F.count("*").alias("n_visits"))
    total = costs.groupBy(F.col(cost_key).alias("__c")).agg(F.sum(cost).alias("total_cost"))
    joined = parent.join(n_visits, parent[key] == F.col("__v"), "left")
    joined = joined.join(total, parent[key] == F.col("__c"), "left")
    income = price * F.coalesce("n_visits", F.lit(0))
    return joined.withColumn("profit", income - F.col("total_cost") - rent).drop("__v", "__c")


def count_per_year(df: DataFrame, year: Column, lo: int, hi: int) -> DataFrame:
    """One row for every year from ``lo`` to ``hi``, with 0 where the table has none."""
    years = df.sparkSession.range(lo, hi + 1).select(F.col("id").cast("int").alias("year"))
    counts = (
        df.select(year.cast("int").alias("year"))
        .where(F.col("year").between(lo, hi))
        .groupBy("year")
        .agg(F.count("*").alias("__n"))
    )
    return years.join(counts, "year", "left").select(
        "year", F.coalesce("__n", F.lit(0)).alias("n_rows")
    )


def anti_by_key(df: DataFrame, other: DataFrame, key: str, other_key: str) -> DataFrame:
    """Rows whose key is not in the other table; its keys are made distinct first."""
    keys = other.select(F.col(other_key).alias("__key")).distinct()
    return df.join(keys, df[key] == F.col("__key"), "left_anti")

"""Grouped aggregates. Keys that pandas would drop (NULL) are dropped where it says so."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from loomframe.functions.scalar import round_half_up, row_mean, without_nan


def _known(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def count_rows(df: DataFrame, condition: Column | None = None) -> DataFrame:
    matching = F.count("*") if condition is None else F.count_if(condition)
    return df.agg(matching.alias("n_rows"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def group_count(df: DataFrame, keys: Sequence[str], name: str = "n_rows") -> DataFrame:
    """Rows per known key."""
    return _known(df, keys).groupBy(*keys).agg(F.count("*").alias(name))


def group_sum(df: DataFrame, keys: Sequence[str], amount: Column, name: str) -> DataFrame:
    return _known(df, keys).groupBy(*keys).agg(F.sum(amount).alias(name))


def group_mean(df: DataFrame, keys: Sequence[str], cols: Sequence[str], digits: int = 2) -> DataFrame:
    """Rounded mean of several columns per known key; NaN is missing."""
    means = [round_half_up(F.avg(c), digits).alias(f"mean_{c}") for c in cols]
    return _known(without_nan(df, cols), keys).groupBy(*keys).agg(*means)


def extremes(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min(column).alias(f"min_{column}"), F.max(column).alias(f"max_{column}")
    )


def career_span(df: DataFrame, key: str, year: Column) -> DataFrame:
    """First and last year per key and the years between."""
    spans = df.groupBy(key).agg(F.min(year).alias("first_year"), F.max(year).alias("last_year"))
    return spans.withColumn("span", F.col("last_year") - F.col("first_year"))


def distinct_pairs(df: DataFrame, keys: Sequence[str], member: str) -> DataFrame:
    """One row per key and member: the set of each key in long form, of any size."""
    return df.where(F.col(member).isNotNull()).select(*keys, member).distinct()


def distinct_count(df: DataFrame, keys: Sequence[str], member: str, name: str = "n_distinct") -> DataFrame:
    """Distinct members per key, counted over (key, member) pairs so that a hot key spreads."""
    return distinct_pairs(df, keys, member).groupBy(*keys).agg(F.count("*").alias(name))


def largest_sets(
    df: DataFrame, keys: Sequence[str], member: str, k: int, order_by: Sequence[str] = ()
) -> DataFrame:
    """Members of the ``k`` known keys with most distinct members, one row per member."""
    known = df.dropna(subset=[*keys, member]).select(*keys, member)
    winners = (
        known.distinct()
        .groupBy(*keys)
        .agg(F.count("*").alias("n_distinct"))
        .orderBy(F.desc("n_distinct"), *(order_by or keys))
        .limit(k)
    )
    # k rows
    return known.join(F.broadcast(winners), list(keys)).distinct()


def as_sets(members: DataFrame, keys: Sequence[str], member: str) -> DataFrame:
    """Distinct members as one sorted array per key.

    For members from a small vocabulary; :func:`distinct_pairs` keeps sets of any size in long form.
    """
    return members.groupBy(*keys).agg(F.array_sort(F.collect_set(member)).alias("members"))


def _extreme_groups(df: DataFrame, key: str, pick) -> DataFrame:
    counts = group_count(df, [key])
    best = counts.select(pick("n_rows")).scalar()
    return counts.where(F.col("n_rows") == best)


def argmax_groups(df: DataFrame, key: str) -> DataFrame:
    """All known keys that share the largest number of rows."""
    return _extreme_groups(df, key, F.max)


def argmin_groups(df: DataFrame, key: str) -> DataFrame:
    """All known keys that share the smallest number of rows."""
    return _extreme_groups(df, key, F.min)


def nested_count(df: DataFrame, outer: str, inner: str) -> DataFrame:
    """Rows per pair of keys, in long form."""
    return df.groupBy(outer, inner).agg(F.count("*").alias("n_rows"))


def as_nested_map(counts: DataFrame, outer: str, inner: str) -> DataFrame:
    """Long counts as one map per outer key, for inner keys from a small vocabulary.

    The counts themselves are the form for any number of inner keys.
    """
    entries = F.collect_list(F.struct(inner, "n_rows"))
    return counts.groupBy(outer).agg(F.map_from_entries(entries).alias("counts"))


def pivot_mean(df: DataFrame, index: str, columns: str, values: Sequence, measure: str | Column) -> DataFrame:
    """Mean per cell of a table; cells without rows are 0.

    The column values are given; a row with another one is an error, and NULL counts as known
    to be outside.
    """
    measure = F.col(measure) if isinstance(measure, str) else measure
    value = F.col(columns)
    message = F.concat(F.lit(f"{columns} has a value that is not listed: "), value.cast("string"))
    listed = F.when(value.isNull() | value.isin(list(values)), value).otherwise(
        F.raise_error(message).cast(df.schema[columns].dataType)
    )
    return (
        _known(df, [index])
        .withColumn(columns, listed)
        .groupBy(index)
        .pivot(columns, list(values))
        .agg(F.avg(measure))
        .fillna(0.0, subset=[str(v) for v in values])
    )


def argmax_per_key(df: DataFrame, key: str | Column, score: Column, name: str) -> DataFrame:
    """Best score per key and who has it; equal scores go to the larger name."""
    key = F.col(key) if isinstance(key, str) else key
    best = df.groupBy(key).agg(F.max(F.struct(score.alias("score"), F.col(name).alias("name"))).alias("best"))
    first = best.columns[0]
    return best.select(first, F.col("best.score").alias("score"), F.col("best.name").alias("name"))


def mode_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """Most frequent value per key with its count; ties go to the smaller value.

    Pairs are counted first, so the second aggregation sees one row per distinct pair and
    combines those on the map side.
    """
    counts = df.groupBy(key, value).agg(F.count("*").alias("n_rows"))
    top = F.min(F.struct((-F.col("n_rows")).alias("neg"), F.col(value).alias("value")))
    return counts.groupBy(key).agg(top.alias("top")).select(
        key, F.col("top.value").alias(value), (-F.col("top.neg")).alias("n_rows")
    )


def list_and_sum(df: DataFrame, key: str, member: str, amount: Column) -> DataFrame:
    """Distinct members (from a small vocabulary, such as countries) and total per key."""
    per_member = df.groupBy(key, member).agg(F.sum(amount).alias("__sum"))
    return per_member.groupBy(key).agg(
        F.array_sort(F.collect_set(member)).alias("members"), F.sum("__sum").alias("total")
    )


def top_counts(df: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """The ``k`` most frequent keys, simple or compound; ties go to the smaller key."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    return counts.orderBy(F.desc("n_rows"), *keys).limit(k)


def pairs_min(df: DataFrame, first: str, second: str, least: int, by: str) -> DataFrame:
    """Pairs that occur at least ``least`` times, listed per key ``by`` as rows.

    ``by`` is one of the two columns. The list of a key stays in long form, since a hot key may
    have any number of partners.
    """
    other = second if by == first else first
    often = nested_count(df, first, second).where(F.col("n_rows") >= least)
    return often.select(F.col(by).alias("key"), F.col(other).alias("partner"), "n_rows")


def value_share(df: DataFrame, column: str, digits: int = 1) -> DataFrame:
    """Share of each known value in percent."""
    known = _known(df, [column])
    counts = known.groupBy(column).agg(F.count("*").alias("n_rows"))
    total = known.select(F.count("*")).scalar()
    return counts.withColumn("share", round_half_up(F.col("n_rows") * 100.0 / total, digits))


def distinct_then_count(df: DataFrame, key: str, member: str) -> DataFrame:
    """Distinct members per known key."""
    return distinct_count(_known(df, [key]), [key], member, "n_members")


def mean_of_means(df: DataFrame, key: str, cols: Sequence[str], digits: int = 2) -> DataFrame:
    """Mean over the group means of several columns; NaN is missing, as is a mean without values."""
    means = _known(without_nan(df, cols), [key]).groupBy(key).agg(*[F.avg(c).alias(f"__{c}") for c in cols])
    mean = row_mean(*[f"__{c}" for c in cols])
    return means.select(key, round_half_up(mean, digits).alias("mean_score"))

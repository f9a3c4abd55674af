"""Descriptive statistics, and the numbers behind each chart."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from loomframe.functions.scalar import without_nan
from loomframe.operators.joins import salted_join
from loomframe.operators.quantiles import (
    column_facts,
    column_quantiles,
    exact_columns,
    exact_quantiles,
    fit_row,
)

QUARTILES = (0.25, 0.5, 0.75)


def profile_columns(df: DataFrame) -> DataFrame:
    """Position, name, type and number of known values of every column."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    long = counts.unpivot([], df.columns, "column", "n_known")
    position = F.lit(0)
    kind = F.lit("")
    for i, (name, dtype) in enumerate(df.dtypes):
        position = F.when(F.col("column") == name, F.lit(i)).otherwise(position)
        kind = F.when(F.col("column") == name, F.lit(dtype)).otherwise(kind)
    return long.select(position.alias("position"), "column", kind.alias("type"), "n_known")


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles, one row per column.

    Two scans: the moments come with the sketches of the quartiles. NaN is missing.
    """
    df = without_nan(df, cols)
    moments = [
        F.struct(
            F.avg(c).cast("double").alias("mean"), F.stddev_samp(c).alias("std"),
            F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"),
        ).alias(f"m_{c}")
        for c in cols
    ]
    facts = column_facts(df, cols, QUARTILES, moments)
    quartiles = exact_columns(df, cols, QUARTILES, facts)
    rows = []
    for c in cols:
        m = facts[f"m_{c}"]
        rows.append((c, facts[f"n_{c}"], m["mean"], m["std"], m["min"], *quartiles[c], m["max"]))
    kinds = "".join(f", {name} double" for name in ("mean", "std", "min", "q25", "q50", "q75", "max"))
    return df.sparkSession.createDataFrame(rows, "column string, n_known long" + kinds)


def nunique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct known values per column, counted over distinct (column, value) pairs."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    pairs = texts.unpivot([], list(cols), "column", "value").where("value IS NOT NULL").distinct()
    counts = pairs.groupBy("column").agg(F.count("*").alias("n_distinct"))
    return counts


#: Bits of a distinct sketch; its relative error is about 1.04 / 2 ** (bits / 2).
SKETCH_BITS = 14


def distinct_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), bits: int = SKETCH_BITS) -> DataFrame:
    """``column, sketch`` per group: mergeable HyperLogLog sketches of the known values.

    One pass; a sketch is a few kilobytes. Kept per part of a table, the sketches of new rows are
    merged with the old ones (:func:`merge_sketches`), and no old row is read again.
    """
    texts = df.select(*by, *[F.col(c).cast("string").alias(c) for c in cols if c not in by])
    wide = texts.groupBy(*by).agg(*[F.hll_sketch_agg(c, bits).alias(f"__{c}") for c in cols])
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"__{c}").alias("sketch")) for c in cols]
    return wide.select(*by, F.inline(F.array(*cells)))


def merge_sketches(*sketches: DataFrame) -> DataFrame:
    """``column, sketch`` of all rows behind several tables of :func:`distinct_sketches`."""
    together = reduce(DataFrame.unionByName, [s.select("column", "sketch") for s in sketches])
    return together.groupBy("column").agg(F.hll_union_agg("sketch").alias("sketch"))


def nunique_approx(sketches: DataFrame) -> DataFrame:
    """Estimated distinct values per column, from sketches of any number of parts."""
    return merge_sketches(sketches).select("column", F.hll_sketch_estimate("sketch").alias("n_distinct"))


def missing_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing values per column; NaN is one."""
    df = without_nan(df, cols)
    missing = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return missing.unpivot([], list(cols), "column", "n_missing")


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, in long form, from a single pass.

    NaN is missing; a pair uses the rows where both are known.
    """
    df = without_nan(df, cols)
    pairs = list(combinations(cols, 2))
    one = df.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"r{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)
        for x, y in ((a, b), (b, a))
    ]
    cells += [F.struct(F.lit(c).alias("a"), F.lit(c).alias("b"), F.lit(1.0).alias("corr")) for c in cols]
    return one.select(F.inline(F.array(*cells)))


def high_corr_pairs(df: DataFrame, cols: Sequence[str], threshold: float) -> DataFrame:
    """Pairs of columns at or above a correlation in either direction."""
    matrix = corr_matrix(df, cols)
    return matrix.where((F.col("a") < F.col("b")) & (F.abs("corr") >= threshold))


def drop_correlated(df: DataFrame, cols: Sequence[str], threshold: float) -> DataFrame:
    """Drop the later column of each highly correlated pair; at most one row per pair is read."""
    found = high_corr_pairs(df, cols, threshold).select("a", "b").collect()
    order = {c: i for i, c in enumerate(cols)}
    return df.drop(*{max(row.a, row.b, key=order.get) for row in found})


def histogram(df: DataFrame, column: str, lo: int, hi: int, full_range: bool = False) -> DataFrame:
    """Counts per unit bin ``[b, b + 1)`` for edges ``lo .. hi - 1``.

    The last bin is closed and values above the last edge fall outside, as with edges taken
    from ``range(min, max)``; ``full_range`` bins every value from ``lo`` to ``hi`` instead.
    """
    value = F.col(column)
    last_bin = hi if full_range else hi - 2
    bins = df.sparkSession.range(lo, last_bin + 1).select(F.col("id").cast("int").alias("bin"))
    top = hi if full_range else hi - 1
    inside = df.where(value.between(lo, top) if not full_range else (value >= lo) & (value < hi + 1))
    found = inside.groupBy(
        F.least(F.floor(value), F.lit(last_bin)).cast("int").alias("bin")
    ).agg(F.count("*").alias("n"))
    return bins.join(found, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n_rows"))


def iqr_bounds(df: DataFrame, cols: Sequence[str]) -> Column:
    """``lo_<column>`` and ``hi_<column>`` of the 1.5 IQR rule, as one scalar struct."""
    q = column_quantiles(df, cols, (0.25, 0.75))
    spread = F.col("q_1") - F.col("q_0")
    bounds = q.select(
        "column",
        (F.col("q_0") - 1.5 * spread).alias("lo"),
        (F.col("q_1") + 1.5 * spread).alias("hi"),
    )
    return fit_row(bounds, "column", cols, ("lo", "hi"))


def _outside(bounds: Column, column: str) -> Column:
    x = F.col(column).cast("double")
    return (x < bounds[f"lo_{column}"]) | (x > bounds[f"hi_{column}"])


def iqr_outliers(df: DataFrame, column: str) -> DataFrame:
    """Rows strictly outside 1.5 IQR around the exact quartiles."""
    return df.where(_outside(iqr_bounds(df, [column]), column))


def drop_outliers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows that are no outlier in any column; all bounds come from the full table."""
    bounds = iqr_bounds(df, cols)
    for column in cols:
        df = df.where(~F.coalesce(_outside(bounds, column), F.lit(False)))
    return df


def box_stats(df: DataFrame, by: str, column: str) -> DataFrame:
    """Quartiles, whiskers (extreme points within 1.5 IQR) and number of fliers per group."""
    q = exact_quantiles(df, column, QUARTILES, by=[by])
    spread = F.col("q_2") - F.col("q_0")
    fences = q.withColumns({"__lo": F.col("q_0") - 1.5 * spread, "__hi": F.col("q_2") + 1.5 * spread})
    x = F.col("__x")
    # one row per group meets the raw rows; the sums start in the tasks that read them
    values = df.select(by, F.when(~F.isnan(F.col(column).cast("double")), F.col(column).cast("double")).alias("__x")).dropna()
    sizes = values.groupBy(by).agg(F.count("*").alias("__size"))
    inside = x.between(F.col("__lo"), F.col("__hi"))
    return (
        salted_join(values, fences.join(sizes, by), [by], "__size", x)
        .groupBy(by)
        .agg(
            F.first("q_0").alias("q25"),
            F.first("q_1").alias("q50"),
            F.first("q_2").alias("q75"),
            F.min(F.when(inside, x)).alias("whisker_lo"),
            F.max(F.when(inside, x)).alias("whisker_hi"),
            F.count_if(~inside).alias("n_fliers"),
        )
    )


def count_all_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per value for each of several columns."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    long = texts.unpivot([], list(cols), "column", "value").where("value IS NOT NULL")
    return long.groupBy("column", "value").agg(F.count("*").alias("n_rows"))


def series_points(df: DataFrame, x: str, y: str, unknown: str | None = None, digits: int = 2) -> DataFrame:
    """Mean of ``y`` per numeric ``x``, without the rows of the unknown key."""
    known = df.where(~F.col(x).cast("string").eqNullSafe(F.lit(unknown)))
    means = known.groupBy(F.col(x).cast("double").alias("x")).agg(F.avg(y).alias("mean"))
    return means.select("x", F.round(F.col("mean").cast("decimal(38,10)"), digits).cast("double").alias("y"))

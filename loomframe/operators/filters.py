"""Predicates and filters."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _columns(df: DataFrame, out: Sequence[str]) -> DataFrame:
    return df.select(*out) if out else df


def where_equals(df: DataFrame, column: str, value, out: Sequence[str] = ()) -> DataFrame:
    return _columns(df.where(F.col(column) == F.lit(value)), out)


def where_contains(df: DataFrame, column: str, text: str, out: Sequence[str] = ()) -> DataFrame:
    """Case-sensitive substring."""
    return _columns(df.where(F.contains(F.col(column), F.lit(text))), out)


def where_between(df: DataFrame, column: str | Column, lo, hi) -> DataFrame:
    """Both ends included."""
    column = F.col(column) if isinstance(column, str) else column
    return df.where(column.between(lo, hi))


def where_not(df: DataFrame, column: str, value) -> DataFrame:
    """Rows that differ from ``value``; a missing value differs."""
    return df.where(~F.col(column).eqNullSafe(F.lit(value)))


def where_none(df: DataFrame, values: Mapping[str, object], arrays: Mapping[str, object]) -> DataFrame:
    """No plain column equals its value, and no array holds its value."""
    for column, value in values.items():
        df = where_not(df, column, value)
    for array, value in arrays.items():
        df = df.where(~F.coalesce(F.array_contains(array, value), F.lit(False)))
    return df


def where_known(df: DataFrame, texts: Sequence[str] = (), numbers: Sequence[str] = ()) -> DataFrame:
    """Rows whose texts are not empty and whose numbers are neither 0 nor the sentinel -1."""
    for column in texts:
        df = df.where(F.col(column) != "")
    for column in numbers:
        df = df.where(~F.col(column).isin(0, -1))
    return df


def where_present(df: DataFrame, cols: Sequence[str] = ()) -> DataFrame:
    """Rows without NULL in the given columns, or in any column."""
    return df.dropna(subset=list(cols) or None)


def where_vs_global(
    df: DataFrame,
    column: str,
    compare: Callable[[Column, Column], Column],
    aggregate: Callable[[str], Column],
) -> DataFrame:
    """Compare each row with an aggregate of the whole table.

    The aggregate is a scalar subquery: evaluated once and pushed into the scan.
    """
    whole = df.select(aggregate(column)).scalar()
    return df.where(compare(F.col(column), whole))


def where_last_n(df: DataFrame, column: str | Column, n: int) -> DataFrame:
    """Rows in ``(max - n, max]`` of an integer column or expression."""
    value = F.col(column) if isinstance(column, str) else column
    newest = df.select(F.max(value)).scalar()
    return df.where(value > newest - n)


def exclude_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Drop rows holding one of the literal values; NULL stays."""
    return df.where(~F.coalesce(F.col(column).isin(*values), F.lit(False)))


def having_min(counts: DataFrame, count: str, least: int) -> DataFrame:
    return counts.where(F.col(count) >= least)


def where_has(df: DataFrame, array: str, value) -> DataFrame:
    return df.where(F.array_contains(array, value))


def where_empty(df: DataFrame, array: str) -> DataFrame:
    """Empty arrays; a NULL array is not empty."""
    return df.where(F.col(array).isNotNull() & (F.size(array) == 0))

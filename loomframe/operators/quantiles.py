"""Exact interpolated quantiles without holding an unbounded group in one task.

A first scan sketches, per group and probability, a narrow bracket of values around the quantile.
A second folds everything outside the brackets to a few counts and keeps only the values inside,
counted per value. Cumulative counts over that small rest give the exact order statistics. Should
a bracket miss its quantile, the groups concerned go again with wider ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, functions as F

from loomframe.operators.joins import salted_join
from loomframe.operators.ordering import running_total
from loomframe.session import stage

ACCURACY = 10_000   # of the sketch behind the brackets
SKETCH_K = 8192     # of the sketch of a whole column: a third of the margin at the accuracy above
WIDEST = 20         # below this accuracy a bracket holds everything


def _wanted(probs: Sequence[float], accuracy: int) -> list[float]:
    """Probabilities of the ends of the brackets: ten times the error of the sketch on each side."""
    margin = 10.0 / accuracy
    return [*(max(0.0, p - margin) for p in probs), *(min(1.0, p + margin) for p in probs)]


def _number(value: str | Column) -> Column:
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    return F.when(~F.isnan(x), x)


def _picked(cells: DataFrame, by: list[str], probs: Sequence[float]) -> DataFrame:
    """Quantiles per group from ``cells``, NULL where one lies in no bracket.

    A cell is a value (``__v``, ``__gap`` 0) or everything between two brackets (the end of the one
    below, ``__gap`` 1), with its rows ``__n`` and the rows of the group, ``__total``.
    """
    cumulated = running_total(
        cells, {"__cum": "__n"}, [F.col("__v").asc_nulls_first(), "__gap"], within=by
    )
    known = F.when(F.col("__gap") == 0, F.col("__v"))
    picks = []
    for i, p in enumerate(probs):
        rank = (F.col("__total") - 1) * F.lit(float(p))
        for name, r in ((f"__a{i}", F.floor(rank)), (f"__b{i}", F.ceil(rank))):
            here = (r < F.col("__cum")) & (r >= F.col("__cum") - F.col("__n"))
            picks.append(F.max(F.when(here, known)).alias(name))
        picks.append(F.max(rank - F.floor(rank)).alias(f"__f{i}"))
    picked = cumulated.groupBy(*by).agg(*picks)
    quantiles = [
        (F.col(f"__a{i}") + (F.col(f"__b{i}") - F.col(f"__a{i}")) * F.col(f"__f{i}")).alias(f"q_{i}")
        for i in range(len(probs))
    ]
    return picked.select(*by, *quantiles)


def _missed(probs: Sequence[float]) -> Column:
    return reduce(Column.__or__, [F.col(f"q_{i}").isNull() for i in range(len(probs))])


# -- quantiles per group -----------------------------------------------------------------------


def _brackets(values: DataFrame, by: list[str], probs: Sequence[float], accuracy: int) -> DataFrame:
    """Per group ``__total`` and, per probability, ``__lo`` and ``__hi`` around its quantile.

    Where a margin spans less than a few rows the group is small, and the bracket holds all of it.
    """
    n = len(probs)
    found = values.groupBy(*by).agg(
        F.percentile_approx("__x", _wanted(probs, accuracy), accuracy).alias("__q"), F.count("*").alias("__total")
    )
    whole = (F.col("__total") * (10.0 / accuracy) < 8) | F.lit(accuracy < WIDEST)
    everything = [F.array_repeat(F.lit(sign * float("inf")), n) for sign in (-1, 1)]
    return found.select(
        *by,
        "__total",
        F.when(whole, everything[0]).otherwise(F.slice("__q", 1, n)).alias("__lo"),
        F.when(whole, everything[1]).otherwise(F.slice("__q", n + 1, n)).alias("__hi"),
    )


def _with_brackets(values: DataFrame, by: list[str], brackets: DataFrame) -> DataFrame:
    if by:
        # stored, so that the sketch runs once for all uses of the small table
        return salted_join(values, stage(brackets, "brackets"), by, "__total", F.col("__x"))
    facts = brackets.select(F.struct("*")).scalar()
    return values.withColumn("__b", facts).select("__x", "__b.*")


def group_cells(values: DataFrame, by: list[str], probs: Sequence[float], accuracy: int) -> DataFrame:
    """The cells of :func:`_picked`, folded in the tasks that read the values ``__x``."""
    bracketed = _with_brackets(values, by, _brackets(values, by, probs, accuracy))
    inside, below = F.lit(False), []
    for i in range(len(probs)):
        lo, hi = F.col("__lo")[i], F.col("__hi")[i]
        inside = inside | F.col("__x").between(lo, hi)
        below.append(F.when(hi < F.col("__x"), hi))
    edge = F.greatest(*below) if len(below) > 1 else below[0]
    # values between brackets fold to one row that sorts right after the bracket below them
    return (
        bracketed.select(
            *by,
            "__total",
            F.when(inside, F.col("__x")).otherwise(edge).alias("__v"),
            F.when(inside, 0).otherwise(1).alias("__gap"),
        )
        .groupBy(*by, "__total", "__v", "__gap")
        .agg(F.count("*").alias("__n"))
    )


def exact_quantiles(
    df: DataFrame,
    value: str | Column,
    probs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Linearly interpolated quantiles ``q_0``, ``q_1``, ... per known group, skipping NULLs.

    Without ``by`` there is one row, of NULLs if no value is known.
    """
    by = list(by)
    values = df.select(*by, _number(value).alias("__x")).dropna()
    found = stage(_picked(group_cells(values, by, probs, accuracy), by, probs), "quantiles")
    missed = found.where(_missed(probs))
    if accuracy < WIDEST or missed.isEmpty():
        return found
    if not by:
        return exact_quantiles(values, "__x", probs, by, accuracy // 10)
    again = exact_quantiles(values.join(missed.select(*by), by, "left_semi"), "__x", probs, by, accuracy // 10)
    return found.where(~_missed(probs)).unionByName(again)


# -- quantiles of columns side by side -----------------------------------------------------------


def long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Numeric columns as rows ``(column, value)``."""
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    return doubles.unpivot([], list(cols), "column", "value")


def column_facts(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], also: Sequence[Column] = (), accuracy: int = ACCURACY
) -> Row:
    """The first scan: ``n_<column>``, the brackets ``q_<column>``, and other sums of the same scan."""
    ends = F.array(*[F.lit(p) for p in _wanted(probs, accuracy)])
    sketch = lambda c: F.kll_sketch_agg_double(_number(c), F.lit(SKETCH_K))
    return df.agg(
        *[F.when(F.count(_number(c)) > 0, F.kll_sketch_get_quantile_double(sketch(c), ends)).alias(f"q_{c}") for c in cols],
        *[F.count(_number(c)).alias(f"n_{c}") for c in cols],
        *also,
    ).first()


def _joined(facts: Row, column: str, n: int, accuracy: int) -> list[tuple[float, float]]:
    """The brackets of a column in order, those that overlap as one."""
    if accuracy < WIDEST or facts[f"n_{column}"] * (10.0 / accuracy) < 8:
        return [(-float("inf"), float("inf"))]
    ends = facts[f"q_{column}"]
    out: list[tuple[float, float]] = []
    for low, high in sorted(zip(ends[:n], ends[n:])):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def exact_columns(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], facts: Row, accuracy: int = ACCURACY
) -> dict[str, list[float | None]]:
    """The second scan: the exact quantiles of each column, given its :func:`column_facts`.

    A row is folded in the task that reads it; only values inside a bracket are shuffled, counted.
    """
    out: dict[str, list[float | None]] = {c: [None] * len(probs) for c in cols}
    cols = [c for c in cols if facts[f"n_{c}"]]
    if not cols:
        return out
    brackets = [_joined(facts, c, len(probs), accuracy) for c in cols]
    # one short expression over (column number, value): the ends come from literal arrays
    j, x = F.col("__j"), F.col("__x")
    listed = lambda values: F.get(F.array(*[F.lit(v) for v in values]), j)
    inside, edge = F.lit(False), F.lit(None).cast("double")
    for i in range(max(map(len, brackets))):
        low, high = (listed([b[i][end] if i < len(b) else float("inf") for b in brackets]) for end in (0, 1))
        inside = inside | x.between(low, high)
        edge = F.when(x > high, high).otherwise(edge)
    values = df.select(F.posexplode(F.array(*[_number(c) for c in cols])).alias("__j", "__x")).where("__x IS NOT NULL")
    cells = values.select("__j", F.when(inside, x).otherwise(edge).alias("__v"), F.when(inside, 0).otherwise(1).alias("__gap"))
    counted = cells.groupBy("__j", "__v", "__gap").agg(F.count("*").alias("__n"))
    total = listed([facts[f"n_{c}"] for c in cols])
    found = _picked(counted.withColumn("__total", total), ["__j"], probs).collect()  # one row per column
    for row in found:
        out[cols[row["__j"]]] = [row[f"q_{i}"] for i in range(len(probs))]
    missed = [c for c in cols if None in out[c]]
    if missed and accuracy >= WIDEST:
        wider = accuracy // 10
        out |= exact_columns(df, missed, probs, column_facts(df, missed, probs, (), wider), wider)
    return out


def column_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int = ACCURACY
) -> DataFrame:
    """Exact quantiles ``q_0``, ``q_1``, ... of several columns, one row per ``column``, in two scans."""
    found = exact_columns(df, cols, probs, column_facts(df, cols, probs, (), accuracy), accuracy)
    fields = ", ".join(f"q_{i} double" for i in range(len(probs)))
    return df.sparkSession.createDataFrame([(c, *found[c]) for c in cols], f"column string, {fields}")


def fit_row(stats: DataFrame, key: str, names: Sequence[str], fields: Sequence[str]) -> Column:
    """One-row struct of per-column facts, ``<field>_<column>``, as a scalar subquery."""
    cells = [
        F.max(F.when(F.col(key) == name, F.col(field))).alias(f"{field}_{name}")
        for name in names
        for field in fields
    ]
    return stats.agg(*cells).select(F.struct("*")).scalar()

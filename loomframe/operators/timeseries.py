"""Sliding windows over ordered rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from loomframe.functions.scalar import portion_year
from loomframe.operators.ordering import number_rows

BLOCK_ROWS = 200_000


def create_windows(
    df: DataFrame,
    past: int,
    horizon: int,
    features: Sequence[str],
    target: str,
    order_by: Sequence[str],
    part: str | None = None,
    block_rows: int = BLOCK_ROWS,
    number: str | None = None,
) -> DataFrame:
    """``past`` consecutive rows as input, and the target ``horizon`` rows after them.

    One row per window: ``window_no`` from 0, an array ``x_<feature>`` for each feature, and
    ``y``. Windows stay inside their ``part``. A long series is cut into blocks that run in
    parallel; each block also gets the first rows of the next one, so no window is lost. ``number`` names a
    column that already has the place of a row in its part, from 1; the rows are then not sorted again.
    """
    reach = past + horizon - 1
    if block_rows <= reach:
        raise ValueError("block_rows must exceed past + horizon")
    parts = [part] if part else []
    cols = list(dict.fromkeys([*features, target]))
    if number:
        rows = df.select(*parts, *cols, F.col(number).alias("__no"))
    else:
        rows = number_rows(df.select(*{*parts, *cols, *order_by}), order_by, parts, "__no")
    place = F.col("__no") - 1
    home = F.floor(place / block_rows)
    shared = (place % block_rows < reach) & (home > 0)
    blocks = F.when(shared, F.array(home, home - 1)).otherwise(F.array(home))
    spread = rows.select("*", F.explode(blocks).alias("__block"))
    ahead = W.partitionBy(*parts, "__block").orderBy("__no")
    inputs = F.collect_list(F.struct(*features)).over(ahead.rowsBetween(0, past - 1))
    windows = spread.select(
        *parts,
        place.alias("window_no"),
        (home == F.col("__block")).alias("__own"),
        inputs.alias("__x"),
        F.lead(target, reach).over(ahead).alias("y"),
        F.lead("__no", reach).over(ahead).alias("__last"),
    )
    complete = windows.where(F.col("__own") & F.col("__last").isNotNull())
    return complete.select(
        *parts, "window_no", *[F.col(f"__x.{f}").alias(f"x_{f}") for f in features], "y"
    )


def add_season(df: DataFrame, date: str | Column, name: str = "portion_year") -> DataFrame:
    return df.withColumn(name, portion_year(date))


def lag_columns(windows: DataFrame, past: int, features: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Window arrays as one column per feature and step."""
    names = {f"{f}_{i}": F.col(f"x_{f}")[i] for f in features for i in range(past)}
    return windows.withColumns(names), list(names)


def persistence(windows: DataFrame, past: int, target: str) -> DataFrame:
    """Baseline forecast: the last known value of the target."""
    return windows.withColumn("prediction", F.col(f"x_{target}")[past - 1])

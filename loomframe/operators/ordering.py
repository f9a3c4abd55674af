"""Row numbers and running totals over data of any size.

A window without keys, or with one hot key, sorts everything in one task. Here the rows are
range-partitioned by key and order instead, so that a hot key spreads over many tasks; only
one small record per key and partition is needed to join the pieces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from loomframe.session import stage

_PART = "__part"
_POS = "__pos"
# monotonically_increasing_id() keeps the partition in the upper bits and the row in the lower 33
_POS_MASK = (1 << 33) - 1

Order = Sequence[str | Column]


def _require_order(order_by: Order) -> None:
    if not order_by:
        raise ValueError("this operator depends on row order: name the order_by columns")


def _sorted_slices(df: DataFrame, within: Sequence[str], order_by: Order) -> DataFrame:
    """Stored copy of ``df``, globally sorted, with each row's partition and place in it."""
    ordered = df.orderBy(*within, *order_by)
    return stage(
        ordered.withColumns(
            {
                _PART: F.spark_partition_id(),
                _POS: F.monotonically_increasing_id().bitwiseAND(F.lit(_POS_MASK)),
            }
        ),
        "sorted",
    )


def _join_slices(rows: DataFrame, info: DataFrame, within: Sequence[str]) -> DataFrame:
    """Join per-slice facts to rows on (key, partition): no slice is larger than a partition."""
    r, i = rows.alias("r"), info.alias("i")
    on = F.col(f"r.{_PART}") == F.col(f"i.{_PART}")
    for key in within:
        on = on & F.col(f"r.{key}").eqNullSafe(F.col(f"i.{key}"))
    facts = [c for c in info.columns if c not in (*within, _PART)]
    return r.join(i, on).select("r.*", *[f"i.{c}" for c in facts])


def number_rows(
    df: DataFrame, order_by: Order, within: Sequence[str] = (), name: str = "row_no"
) -> DataFrame:
    """Number the rows from 1 in the given order, over the table or within each key.

    The order should be unique; rows that tie in it get an arbitrary order among themselves.
    """
    _require_order(order_by)
    within = list(within)
    rows = _sorted_slices(df, within, order_by)
    # one row per partition: its size is the number of write tasks
    sizes = rows.groupBy(_PART).agg(F.count("*").alias("__n"))
    before = W.orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(_PART, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    if not within:
        shifts = starts.select(_PART, F.col("__start").alias("__shift"))
        out = rows.join(F.broadcast(shifts), _PART)
    else:
        first = rows.groupBy(*within, _PART).agg(F.min(_POS).alias("__first"))
        first = first.join(F.broadcast(starts), _PART)
        key_start = F.min(F.col("__start") + F.col("__first")).over(W.partitionBy(*within))
        shifts = first.select(*within, _PART, (F.col("__start") - key_start).alias("__shift"))
        out = _join_slices(rows, shifts, within)
    number = F.col(_POS) + F.col("__shift") + 1
    return out.select(*[F.col(c) for c in df.columns], number.cast("bigint").alias(name))


def running_total(
    df: DataFrame, amounts: dict[str, str], order_by: Order, within: Sequence[str] = ()
) -> DataFrame:
    """Cumulative sums up to and including each row; ``amounts`` maps new name to column."""
    _require_order(order_by)
    within = list(within)
    rows = _sorted_slices(df, within, order_by)
    local = W.partitionBy(*within, _PART).orderBy(_POS)
    local = local.rowsBetween(W.unboundedPreceding, W.currentRow)
    sums = rows.groupBy(*within, _PART).agg(
        *[F.sum(c).alias(f"__sum_{name}") for name, c in amounts.items()]
    )
    # per key at most one row per partition
    before = W.partitionBy(*(within or [F.lit(0)])).orderBy(_PART)
    before = before.rowsBetween(W.unboundedPreceding, -1)
    carried = sums.select(
        *within,
        _PART,
        *[
            F.coalesce(F.sum(f"__sum_{name}").over(before), F.lit(0)).alias(f"__carry_{name}")
            for name in amounts
        ],
    )
    summed = rows.withColumns(
        {f"__local_{name}": F.sum(c).over(local) for name, c in amounts.items()}
    )
    out = _join_slices(summed, carried, within)
    return out.select(
        *[F.col(c) for c in df.columns],
        *[(F.col(f"__local_{n}") + F.col(f"__carry_{n}")).alias(n) for n in amounts],
    )


def top_k(df: DataFrame, order_by: Order, k: int) -> DataFrame:
    """The first ``k`` rows of an order; each task keeps ``k`` rows, nothing is fully sorted."""
    _require_order(order_by)
    return df.orderBy(*order_by).limit(k)


def head(df: DataFrame, n: int, order_by: Order) -> DataFrame:
    return top_k(df, order_by, n)


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def latest(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias(column))


def bottom_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` keys with the fewest rows, ranked; ties go to the smaller key."""
    counts = df.groupBy(key).agg(F.count("*").alias("n_rows"))
    least = counts.orderBy("n_rows", key).limit(n)
    # the window sees at most n rows
    return least.withColumn("ranking", F.row_number().over(W.orderBy("n_rows", key)))


def longest_array(df: DataFrame, array: str, order_by: Order) -> DataFrame:
    """The row with the longest array; ties go to the first in ``order_by``."""
    sized = df.withColumn("n_items", F.size(array))
    return sized.orderBy(F.col("n_items").desc_nulls_last(), *order_by).limit(1)


def seeded_hash(key: Sequence[str], seed: int) -> Column:
    """Pseudo-random number of 52 bits that depends only on the seed and the key columns.

    Taken from an MD5 digest, so that any other engine can repeat the draw.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def shuffle(df: DataFrame, key: Sequence[str], seed: int) -> DataFrame:
    """Rows in a seeded random order, given as their place in it."""
    draw = df.withColumn("__draw", seeded_hash(key, seed))
    return number_rows(draw, ["__draw", *key], name="place").drop("__draw")

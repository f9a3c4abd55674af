"""Train/test splits and folds that give the same answer however the data is partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from loomframe.operators.joins import salted_join
from loomframe.operators.ordering import number_rows, seeded_hash


def hash_split(df: DataFrame, frac: float, key: Sequence[str], seed: int) -> DataFrame:
    """Mark about ``frac`` of the rows as test rows, each by its own key; needs no shuffle."""
    buckets = 10_000
    draw = seeded_hash(key, seed) % buckets
    return df.withColumn("is_test", (draw < round(frac * buckets)).cast("int"))


def fold_of(key: Sequence[str], k: int, seed: int) -> Column:
    """Fold 0 .. k-1 of a row by its own key: of about equal sizes, and without a shuffle."""
    return (seeded_hash(key, seed) % k).cast("int")


def stratified_split(
    df: DataFrame, label: str, frac: float, key: Sequence[str], seed: int
) -> DataFrame:
    """Mark exactly ``round(frac * n)`` rows of each label as test rows; NULL is a label, too.

    Labels, keys and draws alone are sorted: the last test row of each label is its cut, and every
    row decides by itself on which side of it it stands. So rows with one key stay on one side.
    """
    # no field of the place is ever NULL, so places compare
    place = F.struct("__draw", *[F.struct(F.col(k).isNotNull(), F.col(k)).alias(f"__k{i}") for i, k in enumerate(key)])
    drawn = df.withColumn("__draw", seeded_hash(key, seed))
    narrow = drawn.select(F.col(label).alias("__label"), place.alias("__at"))
    placed = number_rows(narrow, ["__at"], within=["__label"], name="__place")
    sizes = narrow.groupBy("__label").agg(F.count("*").alias("__n"))
    sized = salted_join(placed, sizes, ["__label"], "__n", F.col("__at"), null_safe=True)
    last = F.max(F.when(F.col("__place") <= F.round(F.col("__n") * F.lit(frac)), F.col("__at")))
    cuts = sized.groupBy("__label").agg(last.alias("__cut"), F.first("__n").alias("__n"))
    cuts = cuts.withColumnRenamed("__label", label)
    joined = salted_join(drawn, cuts, [label], "__n", F.col("__draw"), null_safe=True)
    return joined.withColumn("is_test", F.coalesce(place <= F.col("__cut"), F.lit(False)).cast("int")).select(
        *df.columns, "is_test"
    )


def ordered_split(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """Part ``train`` for the first ``n`` rows of the order, ``test`` for the rest."""
    numbered = number_rows(df, order_by, name="__place")
    part = F.when(F.col("__place") <= n, "train").otherwise("test")
    return numbered.withColumn("part", part).drop("__place")


def tail_split(
    df: DataFrame, order_by: Sequence[str], frac: float, parts: tuple[str, str] = ("train", "validation"),
    number: str | None = None,
) -> DataFrame:
    """The second of ``parts`` for the last ``frac`` of the order, the first before it.

    ``number`` names a further column with the place of a row in its part, from 1.
    """
    numbered = number_rows(df, order_by, name="__place")
    cut = numbered.select(F.floor(F.count("*") * F.lit(1.0 - frac))).scalar()
    if number:
        numbered = numbered.withColumn(number, F.col("__place") - F.when(F.col("__place") <= cut, 0).otherwise(cut))
    part = F.when(F.col("__place") <= cut, parts[0]).otherwise(parts[1])
    return numbered.withColumn("part", part).drop("__place")


def assign_folds(
    df: DataFrame, k: int, key: Sequence[str], seed: int, label: str | None = None
) -> DataFrame:
    """Shuffled folds 0 .. k-1 whose sizes differ by at most one, per label when stratified."""
    drawn = df.withColumn("__draw", seeded_hash(key, seed))
    within = [label] if label else []
    placed = number_rows(drawn, ["__draw", *key], within=within, name="__place")
    fold = ((F.col("__place") - 1) % k).cast("int")
    return placed.withColumn("fold", fold).select(*df.columns, "fold")

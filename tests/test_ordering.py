"""Numbers, running totals, quantiles and windows: equal to brute force, also for hot keys."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from loomframe.operators import ordering, quantiles, splits, statistics, timeseries


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows belong to one key; values repeat."""
    rng = np.random.default_rng(1)
    n = 4000
    key = np.where(rng.random(n) < 0.5, "hot", rng.choice(list("abcdefgh"), n))
    pdf = pd.DataFrame({"id": np.arange(n), "k": key, "v": np.round(rng.normal(size=n) * 50, 1)})
    df = spark.createDataFrame(pdf).repartition(7, "id")
    return df, pdf


def test_number_rows_within_keys(skewed):
    df, pdf = skewed
    got = ordering.number_rows(df, ["v", "id"], within=["k"]).toPandas()
    want = pdf.sort_values(["v", "id"]).assign(row_no=lambda p: p.groupby("k").cumcount() + 1)
    merged = got.merge(want, on="id")
    assert len(got) == len(pdf) and (merged.row_no_x == merged.row_no_y).all()


def test_number_rows_over_the_table_and_null_keys(spark, skewed):
    df, pdf = skewed
    got = ordering.number_rows(df, [F.desc("v"), "id"]).orderBy("row_no").toPandas()
    want = pdf.sort_values(["v", "id"], ascending=[False, True])
    assert list(got.id) == list(want.id) and list(got.row_no) == list(range(1, len(pdf) + 1))
    gaps = spark.createDataFrame([(None, 2), (None, 1), ("a", 3)], "k string, v int")
    numbered = ordering.number_rows(gaps, ["v"], within=["k"])
    assert rows(numbered) == [("a", 3, 1), (None, 1, 1), (None, 2, 2)]


def test_running_total(skewed):
    df, pdf = skewed
    got = ordering.running_total(df.withColumn("one", F.lit(1)), {"n": "one", "s": "id"}, ["v", "id"], ["k"])
    want = pdf.sort_values(["v", "id"])
    want = want.assign(n=want.groupby("k").cumcount() + 1, s=want.groupby("k").id.cumsum())
    merged = got.toPandas().merge(want, on="id")
    assert (merged.n_x == merged.n_y).all() and (merged.s_x == merged.s_y).all()


def test_order_is_required(skewed):
    for call in (ordering.number_rows, ordering.head):
        with pytest.raises((ValueError, TypeError)):
            call(skewed[0], [])


@pytest.mark.parametrize("accuracy", [10_000, 500, 10], ids=["narrow", "wide", "everything"])
def test_quantiles_equal_numpy(skewed, accuracy):
    df, pdf = skewed
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)
    got = quantiles.exact_quantiles(df, "v", probs, by=["k"], accuracy=accuracy).toPandas().set_index("k")
    for key, group in pdf.groupby("k"):
        want = np.quantile(group.v, probs)
        assert np.allclose(got.loc[key].to_numpy(dtype=float), want, atol=1e-9), key
    whole = quantiles.exact_quantiles(df, "v", probs, accuracy=accuracy).first()
    assert np.allclose(list(whole), np.quantile(pdf.v, probs), atol=1e-9)


def test_brackets_with_many_rows_per_group(spark):
    """Wide enough for the gaps between brackets to hold most of the rows."""
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.lognormal(size=60_000), np.full(30_000, 2.0)])
    df = spark.createDataFrame(pd.DataFrame({"v": values})).repartition(6)
    got = quantiles.exact_quantiles(df, "v", (0.25, 0.5, 0.75), accuracy=1000).first()
    assert np.allclose(list(got), np.quantile(values, (0.25, 0.5, 0.75)), atol=1e-12)


@pytest.mark.parametrize("accuracy", [10_000, 500, 10])
def test_column_quantiles_equal_numpy(skewed, accuracy):
    df, pdf = skewed
    both = df.select("v", (F.col("id") % 100).alias("w"))
    got = quantiles.column_quantiles(both, ["v", "w"], (0.25, 0.6), accuracy=accuracy).toPandas().set_index("column")
    assert np.allclose(got.loc["v"].to_numpy(dtype=float), np.quantile(pdf.v, (0.25, 0.6)))
    assert np.allclose(got.loc["w"].to_numpy(dtype=float), np.quantile(pdf.id % 100, (0.25, 0.6)))


def test_quantiles_of_the_empty_and_the_tiny(spark):
    tiny = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 2.0), ("c", None)], "k string, v double")
    got = quantiles.exact_quantiles(tiny, "v", (0.25, 0.75), by=["k"])
    assert rows(got) == [("a", 1.0, 1.0), ("b", 1.25, 1.75)]
    none = tiny.where("k = 'c'")
    assert rows(quantiles.exact_quantiles(none, "v", (0.5,))) == [(None,)]
    assert rows(quantiles.column_quantiles(none, ["v"], (0.5,))) == [("v", None)]


def test_a_bracket_that_misses_is_widened(spark, monkeypatch):
    """Brackets of the wrong place hold none of the quantiles; the next ones are right."""
    df = spark.range(5_000).select((F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("v"))
    right = quantiles._wanted
    monkeypatch.setattr(
        quantiles, "_wanted", lambda probs, accuracy: right([0.9] * len(probs) if accuracy == 10_000 else probs, accuracy)
    )
    assert rows(quantiles.column_quantiles(df, ["v"], (0.25, 0.5))) == [("v", 1249.75, 2499.5)]
    assert rows(quantiles.exact_quantiles(df, "v", (0.5,))) == [(2499.5,)]
    assert sorted(rows(quantiles.exact_quantiles(df, "v", (0.5,), by=["k"]))) == [(0, 2499.0), (1, 2500.0)]


def test_outlier_bounds_come_from_the_full_table(spark):
    pdf = pd.DataFrame({"a": [1.0] * 10 + [2.0] * 10 + [100.0, 1.0], "b": [1.0] * 10 + [2.0] * 10 + [1.0, 90.0]})
    df = spark.createDataFrame(pdf)
    assert statistics.iqr_outliers(df, "a").count() == 1
    assert statistics.drop_outliers(df, ["a", "b"]).count() == 20


def test_histogram_modes(spark):
    ages = spark.createDataFrame([(a,) for a in (19, 20, 20, 21, 22, 23)], "age int")
    # edges 19 .. 22: the last bin holds 21 and 22, and 23 falls outside
    assert rows(statistics.histogram(ages, "age", 19, 23)) == [(19, 1), (20, 2), (21, 2)]
    assert rows(statistics.histogram(ages, "age", 19, 23, full_range=True)) == [
        (19, 1), (20, 2), (21, 1), (22, 1), (23, 1)
    ]


# -- windows ---------------------------------------------------------------------------------

# A published series and its windows
SERIES = [20.7, 17.9, 18.8, 14.6, 15.8, 15.8, 15.8, 17.4, 21.8, 20.0]


def test_worked_windows(spark):
    df = spark.createDataFrame(list(enumerate(SERIES)), "day int, temp double")
    got = timeseries.create_windows(df, 5, 2, ["temp"], "temp", ["day"]).orderBy("window_no")
    assert [(r.window_no, r.x_temp, r.y) for r in got.collect()] == [
        (0, [20.7, 17.9, 18.8, 14.6, 15.8], 15.8),
        (1, [17.9, 18.8, 14.6, 15.8, 15.8], 17.4),
        (2, [18.8, 14.6, 15.8, 15.8, 15.8], 21.8),
        (3, [14.6, 15.8, 15.8, 15.8, 17.4], 20.0),
    ]


@pytest.mark.parametrize("block_rows", [7, 8, 20, 1000])
def test_blocks_lose_no_window(spark, block_rows):
    n, past, horizon = 103, 5, 2
    df = spark.createDataFrame([(i, float(i * i)) for i in range(n)], "t int, v double")
    got = timeseries.create_windows(
        df, past, horizon, ["v", "t"], "v", ["t"], block_rows=block_rows
    ).orderBy("window_no").collect()
    assert [r.window_no for r in got] == list(range(n - past - horizon + 1))
    for r in got:
        i = r.window_no
        assert r.x_t == list(range(i, i + past)) and r.y == float((i + past + horizon - 1) ** 2)


def test_windows_stay_inside_their_part(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(30)], "t int, v double")
    marked = splits.ordered_split(df, ["t"], 20)
    got = timeseries.create_windows(marked, 5, 2, ["v"], "v", ["t"], part="part")
    assert rows(got.groupBy("part").count()) == [("test", 4), ("train", 14)]


# -- splits ----------------------------------------------------------------------------------


def test_folds_partition_the_rows(skewed):
    df, pdf = skewed
    folds = splits.assign_folds(df, 5, ["id"], 3, label="k").toPandas()
    assert sorted(folds.id) == list(range(len(pdf)))
    sizes = folds.groupby(["k", "fold"]).size().unstack(fill_value=0)
    assert (sizes.max(axis=1) - sizes.min(axis=1) <= 1).all()


def test_splits_do_not_depend_on_partitioning(skewed):
    df, _ = skewed
    for make in (
        lambda d: splits.hash_split(d, 0.3, ["id"], 5),
        lambda d: splits.stratified_split(d, "k", 0.3, ["id"], 5),
        lambda d: splits.assign_folds(d, 4, ["id"], 5),
    ):
        assert rows(make(df)) == rows(make(df.repartition(3)))


def test_stratified_share(skewed):
    df, pdf = skewed
    marked = splits.stratified_split(df, "k", 0.25, ["id"], 5).toPandas()
    want = (pdf.groupby("k").size() * 0.25 + 0.5).astype(int)
    assert (marked.groupby("k").is_test.sum() == want).all()


def test_repeated_rows_stay_on_one_side(spark):
    df = spark.createDataFrame([(i // 3, "a" if i < 90 else None, "x") for i in range(120)], "id int, k string, more string")
    sides = splits.stratified_split(df, "k", 0.3, ["id"], 5).groupBy("id").agg(F.countDistinct("is_test").alias("n"))
    assert {r.n for r in sides.collect()} == {1}


def test_windows_on_given_places_equal_sorted_ones(spark):
    from loomframe.operators import timeseries

    df = spark.range(60).select((F.col("id") * 7 % 60).alias("t"), (F.col("id") * 3 % 11).alias("v"))
    marked = splits.tail_split(df, ["t"], 0.3, number="place")
    made = [
        timeseries.create_windows(marked, 4, 2, ["v"], "v", ["t"], part="part", block_rows=9, number=n)
        for n in (None, "place")
    ]
    assert made[0].count() == 60 - 2 * 5 and rows(made[0]) == rows(made[1])


# -- hot keys --------------------------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_a_plain_join(spark, skewed, how):
    from loomframe.operators.joins import salted_join

    df, _ = skewed
    facts = df.groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("top"))
    if how == "left":
        facts = facts.where("k <> 'a'")
    got = salted_join(df, facts, ["k"], "n", F.col("id"), how, hot_rows=100)
    assert rows(got.select("id", "top")) == rows(df.join(facts, "k", how).select("id", "top"))


def test_admission_with_a_hot_key(spark, skewed, monkeypatch):
    from loomframe.operators import changes, joins

    monkeypatch.setattr(joins.salted_join, "__defaults__", ("inner", 50, False))
    df, pdf = skewed
    rooms = df.select("k").distinct().withColumn("places", F.lit(300))
    judged = changes.judge_arrivals(df, rooms, "k", "places", ["id"]).toPandas()
    assert len(judged) == len(pdf)
    want = pdf.groupby("k").size().clip(upper=300)
    assert (judged.groupby("k").accepted.sum() == want).all()

"""Encoders for open vocabularies, and missing values in scaling and assembling."""

from __future__ import annotations

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import rows
from loomframe.models import classifiers as c
from loomframe.operators import aggregates, encoding


def _plan_size(df) -> int:
    return len(df._jdf.queryExecution().optimizedPlan().toString())


def test_a_million_categories_do_not_grow_the_plan(spark):
    def encoded(n):
        df = spark.range(n).select(F.concat(F.lit("v"), "id").alias("k"), "id")
        model = encoding.SparseOneHot(["k"]).fit(df)
        return model, model.transform(df)

    few, few_rows = encoded(10)
    many, many_rows = encoded(1_000_000)
    assert many.sizes == {"k": 1_000_000} and few.sizes == {"k": 10}
    assert _plan_size(many_rows) < _plan_size(few_rows) + 200
    ones = many_rows.select(F.unwrap_udt("k_hot").alias("v")).select(F.col("v.indices")[0].alias("i"), F.col("v.size").alias("n"))
    got = ones.agg(F.countDistinct("i"), F.min("i"), F.max("i"), F.max("n")).first()
    assert tuple(got) == (1_000_000, 0, 999_999, 1_000_000)
    assert many.names().count() == 1_000_000


def test_unknown_missing_and_dropped_values_have_no_one(spark):
    train = spark.createDataFrame([("b", 1), ("a", 2), ("c", 1), (None, 2)], "k string, n int")
    model = encoding.SparseOneHot(["k", "n"], drop={"k": "first", "n": "if_binary"}).fit(train)
    test = spark.createDataFrame([("a", 1), ("b", 2), ("z", 9), (None, None)], "k string, n int")
    got = model.transform(test).select(vector_to_array("k_hot").alias("k"), vector_to_array("n_hot").alias("n"))
    assert [tuple(map(tuple, r)) for r in got.collect()] == [
        ((0.0, 0.0), (0.0,)), ((1.0, 0.0), (1.0,)), ((0.0, 0.0), (0.0,)), ((0.0, 0.0), (0.0,))
    ]
    assert rows(model.names()) == [("k", "b", 0), ("k", "c", 1), ("n", "2", 0)]


def test_given_values_may_repeat(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    got = encoding.SparseOneHot(["k"], given={"k": ["a", "a", "b"]}).fit(df).transform(df)
    assert got.count() == 2


def test_a_category_with_a_third_of_all_rows(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    got = encoding.SparseOneHot(["k"]).fit(df).transform(df)
    assert got.count() == 9000 and got.select("k_hot").distinct().count() == 6001


def test_missing_numbers_are_named_or_kept(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0), (float("nan"), 4.0)], "x double, y double")
    strict = encoding.column_transform(df, scaled_cols=["x"], passthrough=["y"])
    with pytest.raises(Exception, match="x has a missing value"):
        strict.transform(df).collect()
    kept = encoding.column_transform(df, scaled_cols=["x"], passthrough=["y"], handle_invalid="keep")
    got = [r[0] for r in kept.transform(df).select(vector_to_array("features")).collect()]
    assert got[0] == [0.0, 2.0] and all(v[0] != v[0] for v in got[1:]) and [v[1] for v in got[1:]] == [3.0, 4.0]


def test_transformer_is_fitted_inside_the_pipeline(spark):
    train = spark.createDataFrame([(i, f"k{i % 3}", float(i % 7), float(i % 3 == 0)) for i in range(90)], "id int, k string, x double, label double")
    test = spark.createDataFrame([(100, "k0", 3.0), (101, "new", 3.0)], "id int, k string, x double")
    steps = Pipeline(stages=[encoding.ColumnTransformer(one_hot_cols=["k"], scaled_cols=["x"]), c.logreg(90)])
    model = steps.fit(train)
    assert [r.prediction for r in model.transform(test).orderBy("id").collect()][0] == 1.0
    assert model.stages[0].width == 4


def test_names_of_dummies_can_be_addressed(spark):
    df = spark.createDataFrame([("1.5",), ("1_5",), ("a`b",)], "k string")
    wide = encoding.dummies(df, ["k"], drop_first=False)
    assert len(set(wide.columns)) == 3
    assert [wide.select(F.sum(F.col(name))).first()[0] for name in wide.columns] == [1, 1, 1]


def test_nan_is_missing_in_scaling_and_means(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", 1.0), ("a", nan), ("a", 3.0), ("b", nan)], "k string, x double")
    assert rows(encoding.standardize(df, df, ["x"]).select("x")) == [(-1.0,), (1.0,), (None,), (None,)]
    assert rows(encoding.minmax(df, df, ["x"]).select("x")) == [(0.0,), (1.0,), (None,), (None,)]
    assert rows(encoding.robust_scale(df, df, ["x"]).select("x")) == [(-1.0,), (1.0,), (None,), (None,)]
    assert rows(aggregates.group_mean(df, ["k"], ["x"])) == [("a", 2.0), ("b", None)]
    assert rows(aggregates.mean_of_means(df, "k", ["x"])) == [("a", 2.0), ("b", None)]

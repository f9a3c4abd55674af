"""The perceptron against a sequential one, and cascades and sketches in small."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from conftest import rows
from loomframe.models.perceptron import MixedPerceptron
from loomframe.operators import changes, statistics as st


def vectors(spark, x, y):
    pdf = pd.DataFrame(x, columns=["a", "b"]).assign(label=y.astype(float), id=np.arange(len(y)))
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame(pdf))


def sequential(x, y, epochs):
    x, w = np.c_[x, np.ones(len(x))], np.zeros((3, 3))
    total, seen = np.zeros_like(w), 0
    for _ in range(epochs):
        wrong = 0
        for row, own in zip(x, y):
            best = np.argmax(w @ row)
            if best != own:
                w[own], w[best], wrong = w[own] + row, w[best] - row, wrong + 1
            total, seen = total + w, seen + 1
        if not wrong:
            return w
    return total / seen


@pytest.mark.parametrize("spread, epochs", [(2.0, 5), (0.3, 60)])
def test_one_partition_is_the_sequential_perceptron(spark, spread, epochs):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 3, 90)
    x = rng.normal(scale=spread, size=(90, 2)) + np.array([[0, 4], [4, -3], [-4, -3]])[y]
    df = vectors(spark, x, y).coalesce(1).sortWithinPartitions("id")
    model = MixedPerceptron(epochs=epochs).fit(df)
    assert np.allclose(np.c_[model.weights, model.offsets], sequential(x, y, epochs))


def test_separable_rows_on_many_partitions_end_without_mistakes(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 3, 300)
    x = rng.uniform(-1, 1, size=(300, 2)) + np.array([[0, 4], [4, -3], [-4, -3]])[y]
    df = vectors(spark, x, y).repartition(5, "id")
    perceptron = MixedPerceptron(epochs=100)
    scored = perceptron.fit(df).transform(df)
    assert scored.where("prediction <> label").count() == 0
    with pytest.raises(ValueError, match="no rows"):
        MixedPerceptron().fit(df.limit(0))


def test_a_tree_is_deleted_to_the_end_of_every_branch(spark):
    people = [(1, None), (2, 1), (3, 2), (4, 2), (5, 4), (6, None), (7, 6), (8, 9), (9, 8), (None, 3)]
    tables = {
        "p": spark.createDataFrame(people, "id int, boss int"),
        "t": spark.createDataFrame([(1, 5), (2, 7), (3, None), (4, 8)], "task int, owner int"),
    }
    links = [changes.ForeignKey("t", "owner", "p", "id", "set null"), changes.ForeignKey("p", "boss", "p", "id")]
    doomed = spark.createDataFrame([(2,), (8,), (99,)], "id int")
    left = changes.cascade_delete(tables, links, "p", doomed, "id")
    # 8 and 9 lead to each other; a row without a key goes with its boss as well
    assert [r[0] for r in rows(left["p"])] == [1, 6, 7]
    assert rows(left["t"]) == [(1, None), (2, 7), (3, None), (4, None)]
    loose = changes.cascade_delete(tables, [changes.ForeignKey("p", "boss", "p", "id", "set null")], "p", doomed, "id")
    assert rows(loose["p"]) == sorted([(1, None), (3, None), (4, None), (5, 4), (6, None), (7, 6), (9, None), (None, 3)], key=repr)


def test_sketches_of_parts_merge_and_grow(spark):
    df = spark.range(60_000).select((F.col("id") % 20_000).alias("a"), F.when(F.col("id") % 7 > 0, F.col("id") % 5).alias("b"), (F.col("id") % 3).alias("part"))
    parts = st.distinct_sketches(df, ["a", "b"], by=["part"])
    got = {r["column"]: r["n_distinct"] for r in st.nunique_approx(parts).collect()}
    assert abs(got["a"] - 20_000) < 600 and got["b"] == 5
    more = st.distinct_sketches(spark.range(20_000, 30_000).select(F.col("id").alias("a"), F.lit(9).alias("b")), ["a", "b"])
    grown = {r["column"]: r["n_distinct"] for r in st.nunique_approx(st.merge_sketches(parts, more)).collect()}
    assert abs(grown["a"] - 30_000) < 900 and grown["b"] == 6

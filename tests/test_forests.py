"""Trees grown in scans against a plain recursive tree, and beyond MLlib's depth."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from loomframe.models import evaluation as ev, forests


def frame(spark, x, y):
    names = [f"x{i}" for i in range(x.shape[1])]
    pdf = pd.DataFrame(x, columns=names).assign(label=y.astype(float), id=np.arange(len(y)))
    df = VectorAssembler(inputCols=names, outputCol="raw").transform(spark.createDataFrame(pdf))
    return df.select("id", "label", "raw").repartition(4, "id")


def plain_leaf(bins, y, weight, row, kind, k, level=0, depth=None):
    """Class shares at the leaf of ``row``, by a recursive tree over binned rows."""
    counts = np.bincount(y, weight, k)
    best, gain = None, 1e-12
    if depth is None or level < depth:
        for f in range(bins.shape[1]):
            for b in range(bins[:, f].max(initial=0)):
                on = bins[:, f] <= b
                left, right = np.bincount(y[on], weight[on], k), np.bincount(y[~on], weight[~on], k)
                g = forests.impurity(kind, counts) - forests.impurity(kind, left) - forests.impurity(kind, right)
                if left.sum() >= 1 and right.sum() >= 1 and g > gain * (1 + 1e-9):
                    best, gain = (f, b), g
    if best is None or np.count_nonzero(counts) < 2:
        return counts / counts.sum()
    on = bins[:, best[0]] <= best[1]
    side = on if row[best[0]] <= best[1] else ~on
    return plain_leaf(bins[side], y[side], weight[side], row, kind, k, level + 1, depth)


@pytest.mark.parametrize("kind, depth", [("gini", None), ("entropy", 4)])
def test_one_tree_equals_a_plain_one(spark, kind, depth):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 9, size=(250, 3)).astype(float)
    y = ((x[:, 0] + x[:, 1] > 8).astype(int) + (rng.uniform(size=250) < 0.2)) % 3
    model = forests.Forest("id", 1, depth, None, kind, frac=None).fit(frame(spark, x, y))
    bins = np.stack([np.searchsorted(model.cuts[i], x[:, i]) for i in range(3)], axis=1)
    got = model.shares(x)
    for i in range(0, 250, 10):
        assert np.allclose(got[i], plain_leaf(bins, y, np.ones(250), bins[i], kind, 3, 0, depth))


def test_a_chain_deeper_than_mllib_allows(spark):
    # each split can only take one value off the end of the rest
    x = np.repeat(np.arange(120.0), 3)[:, None]
    y = (np.repeat(np.arange(120), 3) % 2).astype(int)
    model = forests.Forest("id", 1, 70, None, frac=None, max_bins=128).fit(frame(spark, x, y))
    whole = forests.Forest("id", 1, None, None, frac=None, max_bins=128).fit(frame(spark, x, y))
    assert whole.depth > 30 and (whole.shares(x).argmax(1) == y).all() and model.depth <= 70


def test_forest_learns_and_is_the_same_on_any_partitioning(spark):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 3, 400)
    x = rng.normal(size=(400, 4)) + 1.5 * np.eye(4)[y]
    df = frame(spark, x, y)
    one = forests.Forest("id", 10, 8, seed=5).fit(df)
    other = forests.Forest("id", 10, 8, seed=5).fit(df.repartition(1))
    assert np.allclose(one.shares(x), other.shares(x))
    scored = one.transform(df)
    assert ev.accuracy(scored, "label", "prediction").first()[0] > 0.75 and scored.count() == 400
    assert scored.select(F.max("prediction")).first()[0] == 2.0
    with pytest.raises(ValueError, match="no rows"):
        forests.Forest("id").fit(df.limit(0))

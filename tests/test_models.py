"""Own estimators against closed forms, and the mechanics of selection."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from conftest import rows
from loomframe.models import classifiers as c, evaluation as ev, regression, selection as sel
from loomframe.operators import aggregates, encoding, neighbors


@pytest.fixture(scope="module")
def blobs(spark):
    """Three overlapping classes in three dimensions."""
    rng = np.random.default_rng(0)
    y = rng.integers(0, 3, 600)
    x = rng.normal(size=(600, 3)) @ np.array([[1, 0.5, 0], [0, 1, 0.2], [0, 0, 1]]) + 1.5 * np.eye(3)[y]
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(id=np.arange(600), label=y.astype(float))
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(
        spark.createDataFrame(pdf)
    ).select("id", "label", "features")
    return df.repartition(4, "id"), x, y


@pytest.fixture(scope="module")
def binary(blobs):
    df, _, _ = blobs
    return df.where("label < 2")


def score(model, df) -> float:
    return ev.accuracy(model.transform(df), "label", "prediction").first()[0]


def test_discriminant_equals_closed_form(blobs):
    df, x, y = blobs
    got = c.LinearDiscriminant().fit(df).transform(df).orderBy("id").toPandas().prediction
    means = np.array([x[y == k].mean(axis=0) for k in range(3)])
    pooled = sum((x[y == k] - means[k]).T @ (x[y == k] - means[k]) for k in range(3)) / (len(x) - 3)
    w = means @ np.linalg.inv(pooled)
    b = np.log(np.bincount(y) / len(y)) - 0.5 * np.sum(w * means, axis=1)
    assert (got.to_numpy() == np.argmax(x @ w.T + b, axis=1)).all()


def test_components_equal_a_decomposition(blobs):
    df, x, _ = blobs
    got = c.CentredPCA(k=2).fit(df).transform(df).orderBy("id").select(
        vector_to_array("components").alias("z")
    )
    z = np.array(got.toPandas().z.tolist())
    _, _, vt = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    assert np.allclose(np.abs(z), np.abs((x - x.mean(axis=0)) @ vt[:2].T))


def test_fourier_features_approximate_the_kernel(blobs):
    df, x, _ = blobs
    mapped = c.RandomFourierFeatures(outputCol="z", gamma=0.3, n_components=4000, seed=1).transform(df)
    z = np.array(mapped.orderBy("id").select(vector_to_array("z").alias("z")).limit(30).toPandas().z.tolist())
    kernel = np.exp(-0.3 * ((x[:30, None] - x[None, :30]) ** 2).sum(axis=2))
    assert np.abs(z @ z.T - kernel).max() < 0.1


@pytest.mark.parametrize(
    "make",
    [
        lambda n: c.logreg(n), lambda n: c.tree(5), lambda n: c.forest(10, 5), lambda n: c.gaussian_nb(),
        lambda n: c.perceptron(20), lambda n: c.mlp([3, 8, 3], max_iter=60),
        lambda n: c.KNNClassifier(key="id", n_features=3, n_classes=3),
    ],
    ids=["logreg", "tree", "forest", "nb", "perceptron", "mlp", "knn"],
)
def test_classifiers_learn(blobs, make):
    df, _, _ = blobs
    assert score(make(600).fit(df), df) > 0.6


@pytest.mark.parametrize(
    "make",
    [lambda n: c.svm_linear(n), lambda n: c.svm_poly(n, coef0=2.0), lambda n: c.svm_rbf(n, gamma=0.3)],
    ids=["linear", "poly", "rbf"],
)
def test_margin_classifiers_learn(binary, make):
    assert score(make(binary.count()).fit(binary), binary) > 0.75


def test_bagging_averages_probabilities(binary):
    model = sel.Bagging(c.logreg(400), "id", n=3, frac=0.7).fit(binary)
    scored = model.transform(binary)
    total = F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, v: a + v)
    assert scored.where(F.abs(total - 1) > 1e-9).count() == 0
    assert score(model, binary) > 0.75 and scored.count() == binary.count()


def test_stacking(binary):
    bases = {"tree": c.tree(3), "knn": c.KNNClassifier(key="id", n_features=3)}
    model = sel.Stacking(bases, c.logreg(400), key="id", folds=3).fit(binary)
    assert score(model, binary) > 0.7


def test_stacking_learns_from_all_rows_of_its_neighbours(binary, monkeypatch):
    """Labelled rows that do not fit in one matrix give the probabilities they give in one."""
    seen, plain = [], sel._meta_features

    def meta(df, names, n_classes):
        seen.append(sorted((r.id, *r["__knn"]) for r in df.select("id", "__knn").collect()))
        return plain(df, names, n_classes)

    monkeypatch.setattr(sel, "_meta_features", meta)
    for most in (neighbors.LABELLED_BYTES, 8 * 3 * 40):
        monkeypatch.setattr(neighbors, "LABELLED_BYTES", most)
        monkeypatch.setattr(neighbors, "SHARD_BYTES", most)
        bases = {"knn": c.KNNClassifier(key="id", n_features=3)}
        sel.Stacking(bases, c.tree(3), key="id", folds=2).fit(binary).transform(binary).count()
    assert len(seen) == 4 and seen[:2] == seen[2:]


def test_folds_are_stored_for_all_cores(spark):
    few = spark.range(4 * sel.FIT_ROWS).selectExpr("id", "double(id % 2) label").coalesce(1)
    stored = sel.fold_rows(few, 3, "id", 1)
    assert len(stored.inputFiles()) == 4 and stored.count() == few.count()
    assert len(sel.fold_rows(few.limit(100), 3, "id", 1).inputFiles()) <= 8  # what sorting left


def test_cross_validation_covers_each_row_once(blobs):
    df, _, _ = blobs
    rows_ = sel.fold_rows(df, 3, "id", 1)
    predictions = sel.cross_val_predict({"LDA": c.LinearDiscriminant()}, rows_, 3, "id")
    assert predictions.count() == 600 == predictions.select("id").distinct().count()
    scores = sel.cross_val({"LDA": c.LinearDiscriminant(), "NB": c.gaussian_nb()}, rows_, 3, "id")
    assert scores.count() == 6 and scores.where("score < 0.5").count() == 0


def test_grid_search_orders_settings(blobs):
    df, _, _ = blobs
    tree = c.tree(1)
    grid = ParamGridBuilder().addGrid(tree.maxDepth, [1, 6]).build()
    best, table = sel.grid_search(tree, grid, sel.fold_rows(df, 3, "id", 1), 3)
    assert best.depth > 1
    assert [r.params for r in table.orderBy("place").collect()] == ["maxDepth=6", "maxDepth=1"]


def test_pca_study_names_every_setting(blobs):
    df, _, _ = blobs
    study = sel.pca_study({"NB": c.gaussian_nb()}, [1, 2], sel.fold_rows(df, 3, "id", 1), 3, "id")
    assert [(r.model, r.components) for r in study.orderBy("components").collect()] == [("NB", 1), ("NB", 2)]


def test_pca_study_decomposes_once_a_fold_and_agrees_with_single_fits(blobs, monkeypatch):
    df, _, _ = blobs
    rows_ = sel.fold_rows(df, 2, "id", 1)
    models = {"LR": c.logreg(600), "PER": c.perceptron(20), "DT": c.tree(2)}
    calls, fit = [], c.CentredPCA._fit
    monkeypatch.setattr(c.CentredPCA, "_fit", lambda self, d: calls.append(self.k) or fit(self, d))
    got = {(r.model, r.components): r.score for r in sel.pca_study(models, [1, 2], rows_, 2, "id").collect()}
    assert calls == [2, 2] and len(got) == 6  # a decomposition per setting and fold before
    pca = [c.CentredPCA(k=2).fit(rows_.where(f"fold != {fold}")) for fold in (0, 1)]
    for name, model in models.items():
        one = model.copy()
        one.set(one.getParam("featuresCol"), "components")
        parts = [[p.transform(rows_.where(f"fold {sign} {f}")) for sign in ("!=", "=")] for f, p in enumerate(pca)]
        want = np.mean([score(one.fit(train), test) for train, test in parts])
        assert abs(got[name, 2] - want) < (0.04 if name == "PER" else 0.01), (name, got, want)


def test_boosting_stops_early(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(size=500)
    pdf = pd.DataFrame({"x": x, "y": 2 * x, "v": np.arange(500) % 5 == 0})
    model = regression.fit_boosted(spark.createDataFrame(pdf), ["x"], "y", "v", max_iter=20)
    assert model.stages[-1].getNumTrees < 20


def test_evaluation_by_hand(spark):
    df = spark.createDataFrame(
        [(1, 1, 0.9), (1, 0, 0.4), (0, 0, 0.4), (0, 1, 0.8), (1, 1, 0.7)], "y int, p int, s double"
    )
    assert ev.accuracy(df, "y", "p").first()[0] == 0.6
    assert rows(ev.confusion(df, "y", "p", [0, 1])) == [(0, 1, 1), (1, 1, 2)]
    report = {r["class"]: r for r in ev.class_report(df, "y", "p").collect()}
    assert report[1].precision == 2 / 3 and report[1].recall == 2 / 3 and report[0].f1 == 0.5
    # pairs won: 0.9 twice, 0.7 once, 0.4 half
    assert ev.auc(df, "y", "s").first()[0] == pytest.approx(3.5 / 6)
    assert [(r.tp, r.fp) for r in ev.roc_points(df, "y", "s").orderBy(F.desc("score")).collect()] == [
        (1, 0), (1, 1), (2, 1), (3, 2)
    ]


def test_a_class_never_predicted_scores_zero(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "y int, p int")
    report = {r["class"]: r for r in ev.class_report(df, "y", "p").collect()}
    assert (report[1].precision, report[1].recall, report[1].f1, report[1].support) == (0, 0, 0, 1)


def test_scaling_uses_training_facts_only(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    test = spark.createDataFrame([(5.0, 6.0)], "a double, b double")
    assert rows(encoding.standardize(train, test, ["a", "b"])) == [(3.0, 1.0)]
    assert rows(encoding.minmax(train, test, ["a", "b"])) == [(2.0, 1.0)]
    assert rows(encoding.robust_scale(train, test, ["a", "b"])) == [(3.0, 1.0)]


def test_unknown_categories_are_all_zero(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    got = encoding.one_hot(df, "k", ["a", "b"])
    assert rows(got) == [(0, 0), (0, 0), (1, 0)]
    model = encoding.column_transform(df, one_hot_cols=["k"], categories_of={"k": ["a", "b"]})
    wide = model.transform(df).select(vector_to_array("features")).collect()
    assert [r[0] for r in wide] == [[1.0, 0.0], [0.0, 0.0], [0.0, 0.0]]


def test_bootstrap_is_free_of_the_partitioning(binary):
    one = sel.bootstrap(binary, "id", 0.7, 3).groupBy("id").count()
    other = sel.bootstrap(binary.repartition(3), "id", 0.7, 3).groupBy("id").count()
    assert rows(one) == rows(other)
    assert 0.6 < sum(n for _, n in rows(one)) / binary.count() < 0.8


@pytest.mark.parametrize("degree, coef0", [(2, 0.0), (2, 2.0), (3, 1.0)])
def test_polynomial_features_give_the_kernel(binary, degree, coef0):
    poly = c.PolynomialFeatures(degree=degree, coef0=coef0)
    got = poly.transform(binary.limit(4)).select("features", "poly").collect()
    for a in got:
        for b in got:
            kernel = (a.features.dot(b.features) + coef0) ** degree
            assert abs(a.poly.dot(b.poly) - kernel) < 1e-9 * max(1, abs(kernel))


def test_scaling_is_fitted_with_the_model(binary):
    raw = binary.withColumnRenamed("features", "raw")
    model = c.scaled(c.logreg(400)).fit(raw.where("id < 100"))
    mean = model.stages[0].mean.toArray()
    part = [r.raw.toArray() for r in raw.where("id < 100").select("raw").collect()]
    assert abs(mean - sum(part) / len(part)).max() < 1e-9


def test_unlisted_classes_are_errors(spark):
    df = spark.createDataFrame([(0, 0), (1, 2)], "y int, p int")
    with pytest.raises(Exception, match="not listed"):
        ev.confusion(df, "y", "p", [0, 1]).collect()
    with pytest.raises(Exception, match="not listed"):
        ev.compare_models({"m": df}, "y", "p", [0, 1]).collect()
    with pytest.raises(Exception, match="not listed"):
        aggregates.pivot_mean(df, "y", "p", [0], "y").collect()

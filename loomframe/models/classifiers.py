"""Classifiers: MLlib estimators with the settings of the usual defaults, and three of our own.

``regParam`` in MLlib multiplies a mean loss, so a penalty stated as ``C`` against a summed loss
becomes ``1 / (n * C)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement
from math import factorial

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasFeaturesCol,
    HasInputCol,
    HasLabelCol,
    HasOutputCol,
    HasPredictionCol,
    HasProbabilityCol,
)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from loomframe.operators.neighbors import knn_votes
from loomframe.session import ship_package

RAW, FEATURES, LABEL = "raw", "features", "label"
# The usual stopping tolerances of logistic regression and of margin classifiers
LOGREG_TOL, MARGIN_TOL = 1e-4, 1e-3


def logreg(n_rows: int, C: float = 1.0, max_iter: int = 100) -> LogisticRegression:
    return LogisticRegression(regParam=1.0 / (n_rows * C), maxIter=max_iter, tol=LOGREG_TOL)


def tree(max_depth: int = 30, seed: int = 0) -> DecisionTreeClassifier:
    """A single tree; MLlib itself refuses a depth above 30."""
    return DecisionTreeClassifier(maxDepth=max_depth, seed=seed)


def forest(
    n_trees: int = 100, max_depth: int = 30, subset: str = "sqrt", impurity: str = "gini", seed: int = 0
) -> RandomForestClassifier:
    return RandomForestClassifier(
        numTrees=n_trees, maxDepth=max_depth, featureSubsetStrategy=subset,
        impurity=impurity, seed=seed,
    )


def gaussian_nb() -> NaiveBayes:
    return NaiveBayes(modelType="gaussian")


def _margin(features: str, n_rows: int, C: float, max_iter: int) -> LinearSVC:
    return LinearSVC(
        featuresCol=features, regParam=1.0 / (n_rows * C), maxIter=max_iter, tol=MARGIN_TOL
    )


def svm_linear(n_rows: int, C: float = 1.0, max_iter: int = 100) -> LinearSVC:
    return _margin("features", n_rows, C, max_iter)


def svm_poly(
    n_rows: int, C: float = 1.0, degree: int = 2, coef0: float = 0.0, max_iter: int = 100
) -> Pipeline:
    """Linear SVM over the exact features of the kernel ``(x.y + coef0) ** degree``."""
    return Pipeline(
        stages=[
            PolynomialFeatures(inputCol=FEATURES, outputCol="__poly", degree=degree, coef0=coef0),
            _margin("__poly", n_rows, C, max_iter),
        ]
    )


def svm_rbf(
    n_rows: int, C: float = 1.0, gamma: float = 0.5, n_components: int = 200, seed: int = 0,
    max_iter: int = 100,
) -> Pipeline:
    """Linear SVM over random Fourier features, which approximate the RBF kernel."""
    return Pipeline(
        stages=[
            RandomFourierFeatures(
                inputCol=FEATURES, outputCol="__fourier", gamma=gamma,
                n_components=n_components, seed=seed,
            ),
            _margin("__fourier", n_rows, C, max_iter),
        ]
    )


def perceptron(max_iter: int = 100) -> OneVsRest:
    """Linear threshold units, one per class, with hinge loss and no penalty."""
    unit = LinearSVC(regParam=0.0, maxIter=max_iter, tol=MARGIN_TOL)
    return OneVsRest(classifier=unit, parallelism=4)


def mlp(layers: Sequence[int], seed: int = 0, max_iter: int = 100) -> MultilayerPerceptronClassifier:
    """Dense network with a softmax output; ``layers`` runs from features to classes."""
    return MultilayerPerceptronClassifier(layers=list(layers), seed=seed, maxIter=max_iter)


class PolynomialFeatures(
    Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Products of features whose inner product is ``(x.y + coef0) ** degree`` exactly.

    Each product carries the root of its multinomial coefficient; with ``coef0`` 0 only those of
    full degree are there. The input needs a size of a few dozen at most.
    """

    degree = Param(Params._dummy(), "degree", "degree of the kernel", TypeConverters.toInt)
    coef0 = Param(Params._dummy(), "coef0", "constant of the kernel", TypeConverters.toFloat)

    @keyword_only
    def __init__(
        self, *, inputCol: str = FEATURES, outputCol: str = "poly", degree: int = 2, coef0: float = 0.0
    ):
        super().__init__()
        self._setDefault(degree=2, coef0=0.0)
        self._set(inputCol=inputCol, outputCol=outputCol, degree=degree, coef0=coef0)

    def _transform(self, df: DataFrame) -> DataFrame:
        degree, coef0 = self.getOrDefault(self.degree), self.getOrDefault(self.coef0)
        first = df.select(vector_to_array(self.getInputCol()).alias("x")).first()
        width = len(first["x"]) if first else 0
        x, products = F.col("__x"), []
        for size in range(degree + 1):
            rest = coef0 ** (degree - size)
            if rest == 0:
                continue
            for chosen in combinations_with_replacement(range(width), size):
                ways = factorial(degree) / factorial(degree - size)
                for i in set(chosen):
                    ways /= factorial(chosen.count(i))
                term = F.lit(float(np.sqrt(ways * rest)))
                for i in chosen:
                    term = term * x[i]
                products.append(term)
        expanded = df.withColumn("__x", vector_to_array(self.getInputCol()))
        return expanded.withColumn(self.getOutputCol(), array_to_vector(F.array(*products))).drop("__x")


class RandomFourierFeatures(
    Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Cosine features whose inner product approximates ``exp(-gamma * |x - y| ** 2)``.

    The random directions depend on the seed and the input size alone, so every task draws the
    same ones.
    """

    gamma = Param(Params._dummy(), "gamma", "width of the kernel", TypeConverters.toFloat)
    n_components = Param(Params._dummy(), "n_components", "number of features", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the directions", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self, *, inputCol: str = FEATURES, outputCol: str = "fourier", gamma: float = 1.0,
        n_components: int = 200, seed: int = 0,
    ):
        super().__init__()
        self._setDefault(gamma=1.0, n_components=200, seed=0)
        self._set(
            inputCol=inputCol, outputCol=outputCol, gamma=gamma, n_components=n_components, seed=seed
        )

    def _transform(self, df: DataFrame) -> DataFrame:
        ship_package(df.sparkSession)
        gamma, m, seed = (self.getOrDefault(p) for p in (self.gamma, self.n_components, self.seed))

        @F.pandas_udf("array<double>")
        def project(vectors: pd.Series) -> pd.Series:
            if vectors.empty:
                return vectors
            x = np.stack(vectors.to_numpy())
            rng = np.random.default_rng(seed)
            directions = rng.normal(scale=np.sqrt(2 * gamma), size=(x.shape[1], m))
            offsets = rng.uniform(0, 2 * np.pi, size=m)
            return pd.Series(list(np.sqrt(2 / m) * np.cos(x @ directions + offsets)))

        arrays = project(vector_to_array(self.getInputCol()))
        return df.withColumn(self.getOutputCol(), array_to_vector(arrays))


def covariance(df: DataFrame, vector: Column) -> tuple[np.ndarray, np.ndarray]:
    """Mean and sample covariance of a vector column: one row per pair of features at most."""
    x = df.select(vector.alias("x"))
    moments = x.select(
        Summarizer.metrics("mean", "std").summary(F.col("x")).alias("m")
    ).first()["m"]
    spread = moments["std"].toArray()
    corr = np.nan_to_num(Correlation.corr(x, "x").first()[0].toArray())
    np.fill_diagonal(corr, 1.0)
    return moments["mean"].toArray(), corr * np.outer(spread, spread)


class CentredPCA(Estimator, HasInputCol, HasOutputCol):
    """Principal components of the centred data.

    The covariance is a distributed aggregate, its decomposition a small local one. The largest
    weight of each component is positive, which fixes the sign.
    """

    @keyword_only
    def __init__(self, *, k: int, inputCol: str = FEATURES, outputCol: str = "components"):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)
        self.k = k

    def _fit(self, df: DataFrame) -> "CentredPCAModel":
        mean, cov = covariance(df, F.col(self.getInputCol()))
        values, vectors = np.linalg.eigh(cov)
        axes = vectors[:, ::-1][:, : self.k].T
        largest = axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)]
        axes = axes * np.sign(largest)[:, None]
        spreads = np.sqrt(np.maximum(values[::-1][: self.k], 0))
        return self._copyValues(CentredPCAModel(axes, axes @ mean, spreads))


class CentredPCAModel(Model, HasInputCol, HasOutputCol):
    def __init__(self, axes: np.ndarray, offsets: np.ndarray, spreads: np.ndarray):
        super().__init__()
        self.axes, self.offsets, self.spreads = axes, offsets, spreads

    def _transform(self, df: DataFrame) -> DataFrame:
        x = vector_to_array(self.getInputCol())
        parts = [_dot(x, axis, -offset) for axis, offset in zip(self.axes, self.offsets)]
        return df.withColumn(self.getOutputCol(), array_to_vector(F.array(*parts)))


def _dot(x: Column, weights: np.ndarray, start: float) -> Column:
    """``start`` plus the inner product of an array column with fixed weights."""
    w = F.array(*[F.lit(float(v)) for v in weights])
    return F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(float(start)), lambda s, v: s + v)


class LinearDiscriminant(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """Linear discriminant analysis with a pooled covariance.

    Class means and the covariance of the class-centred rows are distributed aggregates; the
    driver only solves a system of one equation per feature.
    """

    @keyword_only
    def __init__(self, *, featuresCol: str = FEATURES, labelCol: str = LABEL):
        super().__init__()
        self._setDefault(featuresCol=FEATURES, labelCol=LABEL, predictionCol="prediction")
        self._set(featuresCol=featuresCol, labelCol=labelCol)

    def _fit(self, df: DataFrame) -> "LinearDiscriminantModel":
        x, label = F.col(self.getFeaturesCol()), self.getLabelCol()
        grouped = df.groupBy(F.col(label).cast("double").alias(label)).agg(
            F.count("*").alias("n"), Summarizer.mean(x).alias("mean")
        )
        rows = grouped.orderBy(label).collect()  # one row per class
        classes = [float(r[label]) for r in rows]
        means = np.array([r["mean"].toArray() for r in rows])
        counts = np.array([r["n"] for r in rows], dtype=float)

        # one row per class
        own = grouped.select(F.col(label).alias("__class"), vector_to_array("mean").alias("__mean"))
        joined = df.join(F.broadcast(own), F.col(label) == F.col("__class"))
        shifted = F.zip_with(vector_to_array(x), "__mean", lambda a, b: a - b)
        centred = joined.select(array_to_vector(shifted).alias("c"))
        _, cov = covariance(centred, F.col("c"))
        n = counts.sum()
        pooled = cov * (n - 1) / max(n - len(classes), 1)
        weights = means @ np.linalg.pinv(pooled)
        offsets = np.log(counts / n) - 0.5 * np.sum(weights * means, axis=1)
        model = LinearDiscriminantModel(classes, weights, offsets)
        return self._copyValues(model)


class LinearDiscriminantModel(Model, HasFeaturesCol, HasPredictionCol):
    def __init__(self, classes: list[float], weights: np.ndarray, offsets: np.ndarray):
        super().__init__()
        self._setDefault(featuresCol=FEATURES, predictionCol="prediction")
        self.classes, self.weights, self.offsets = classes, weights, offsets

    def _transform(self, df: DataFrame) -> DataFrame:
        x = vector_to_array(self.getFeaturesCol())
        scores = F.array(*[_dot(x, w, b) for w, b in zip(self.weights, self.offsets)])
        classes = F.array(*[F.lit(c) for c in self.classes])
        best = F.array_position("__scores", F.array_max("__scores")).cast("int")
        scored = df.withColumn("__scores", scores)
        return scored.withColumn(self.getPredictionCol(), F.get(classes, best - 1)).drop("__scores")


class KNNClassifier(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol):
    """k nearest neighbours with uniform votes. ``key`` is a bigint that identifies a row."""

    @keyword_only
    def __init__(
        self, *, key: str, n_features: int, n_classes: int = 2, k: int = 5,
        featuresCol: str = FEATURES, labelCol: str = LABEL,
    ):
        super().__init__()
        self._setDefault(
            featuresCol=FEATURES, labelCol=LABEL, predictionCol="prediction",
            probabilityCol="probability",
        )
        self._set(featuresCol=featuresCol, labelCol=labelCol)
        self.key, self.n_features, self.n_classes, self.k = key, n_features, n_classes, k

    def _fit(self, df: DataFrame) -> "KNNModel":
        return self._copyValues(KNNModel(self, df))


class KNNModel(Model, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol):
    def __init__(self, parent: KNNClassifier, train: DataFrame):
        super().__init__()
        self._setDefault(
            featuresCol=FEATURES, labelCol=LABEL, predictionCol="prediction",
            probabilityCol="probability",
        )
        self.settings, self.train = parent, train

    def _transform(self, df: DataFrame) -> DataFrame:
        s, label = self.settings, self.getLabelCol()
        x = vector_to_array(self.getFeaturesCol())
        votes = knn_votes(self.train, df, s.key, x, s.n_features, label, s.k)
        counts = votes.groupBy(s.key).agg(
            *[
                F.coalesce(F.sum(F.when(F.col("prediction") == c, F.col("votes"))), F.lit(0)).alias(f"__{c}")
                for c in range(s.n_classes)
            ]
        )
        shares = F.array(*[F.col(f"__{c}").cast("double") for c in range(s.n_classes)])
        total = sum((F.col(f"__{c}") for c in range(s.n_classes)), F.lit(0))
        scored = counts.select(
            s.key,
            array_to_vector(F.transform(shares, lambda v: v / total)).alias(self.getProbabilityCol()),
            (F.array_position(shares, F.array_max(shares)) - 1).cast("double").alias(self.getPredictionCol()),
        )
        return df.join(scored, s.key)


def assemble(df: DataFrame, cols: Sequence[str], label: str, key: str) -> DataFrame:
    """``key``, ``label`` and ``raw``, the vector of numeric columns as they are."""
    raw = VectorAssembler(inputCols=list(cols), outputCol=RAW).transform(df)
    return raw.select(key, F.col(label).cast("double").alias(LABEL), RAW)


def scaled(estimator: Estimator) -> Pipeline:
    """The estimator behind a standardisation that is fitted on the same rows, and on no others."""
    scaler = StandardScaler(inputCol=RAW, outputCol=FEATURES, withMean=True)
    return Pipeline(stages=[scaler, estimator])

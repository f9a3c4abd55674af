"""The perceptron rule on many partitions: mistake-driven passes whose weights are mixed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.sql import DataFrame, functions as F

from loomframe.models.classifiers import FEATURES, LABEL, LinearDiscriminantModel
from loomframe.session import ship_package, stage


def pass_over(x: np.ndarray, place: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """One pass in order: weights after it, their sum over all rows, and the number of mistakes.

    ``x`` ends with a constant. A row whose best class is wrong (a tie goes to the first) is added
    to the weights of its own class and taken from those of the best.
    """
    weights, total, mistakes = weights.copy(), np.zeros_like(weights), 0
    for row, own in zip(x, place):
        best = int(np.argmax(weights @ row))
        if best != own:
            weights[own] += row
            weights[best] -= row
            mistakes += 1
        total += weights
    return weights, total, mistakes


class MixedPerceptron(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """Perceptron for any number of classes.

    In every epoch each partition passes over its rows, starting from the common weights; the new
    common weights are the mean of theirs, weighed by rows. Training ends with an epoch without a
    mistake, or after ``epochs``; then the mean of all weights met on the way is the model, unless
    the last epoch was without mistakes. What crosses the network is one weight matrix per
    partition and epoch. On a single partition this is the sequential perceptron.
    """

    @keyword_only
    def __init__(self, *, epochs: int = 100, featuresCol: str = FEATURES, labelCol: str = LABEL):
        super().__init__()
        self._setDefault(featuresCol=FEATURES, labelCol=LABEL, predictionCol="prediction")
        self._set(featuresCol=featuresCol, labelCol=labelCol)
        self.epochs, self.mistakes = epochs, None

    def _fit(self, df: DataFrame) -> LinearDiscriminantModel:
        ship_package(df.sparkSession)
        rows = stage(
            df.select(
                F.col(self.getLabelCol()).cast("double").alias("label"), vector_to_array(self.getFeaturesCol()).alias("x")
            ).dropna(),
            "rows",
        )
        classes = sorted(r["label"] for r in rows.select("label").distinct().collect())
        if not classes:
            raise ValueError("no rows to fit on")
        weights = np.zeros((len(classes), len(rows.first()["x"]) + 1))
        total, seen = np.zeros_like(weights), 0
        for _ in range(self.epochs):
            ends, sums, n, self.mistakes = self._epoch(rows, np.array(classes), weights)
            total, seen, weights = total + sums, seen + n, ends
            if not self.mistakes:
                break
        best = weights if not self.mistakes else total / seen
        return self._copyValues(LinearDiscriminantModel(classes, best[:, :-1], best[:, -1]))

    @staticmethod
    def _epoch(rows: DataFrame, classes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, int, int]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, total, mistakes, n = weights, np.zeros_like(weights), 0, 0
            for batch in batches:
                if batch.num_rows:
                    x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
                    place = np.searchsorted(classes, batch.column(0).to_numpy(zero_copy_only=False))
                    own, sums, wrong = pass_over(x, place, own)
                    total, mistakes, n = total + sums, mistakes + wrong, n + len(x)
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([own.tobytes()], pa.binary()), pa.array([total.tobytes()], pa.binary()),
                     pa.array([mistakes], pa.int64()), pa.array([n], pa.int64())],
                    names=["own", "total", "mistakes", "n"],
                )

        ends, sums, n, mistakes = np.zeros_like(weights), np.zeros_like(weights), 0, 0
        # one matrix per partition
        parts = rows.mapInArrow(run, "own binary, total binary, mistakes long, n long")
        for part in parts.collect():
            own, total = (np.frombuffer(part[c]).reshape(weights.shape) for c in ("own", "total"))
            ends, sums = ends + own * part["n"], sums + total
            n, mistakes = n + part["n"], mistakes + part["mistakes"]
        return ends / n, sums, n, mistakes

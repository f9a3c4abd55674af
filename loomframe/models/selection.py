"""Cross-validation, grids, bagging and stacking."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol, HasProbabilityCol
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession, functions as F

from loomframe.models.classifiers import FEATURES, LABEL, RAW, CentredPCA, CentredPCAModel
from loomframe.models.many import Fit, Projection, fit_many, held_out_accuracy, one_vs_rest, poisson_copies, prepare
from loomframe.operators.splits import assign_folds
from loomframe.session import spread, stage

PARALLELISM = 4
FIT_ROWS = 5_000  # rows worth a task of their own in a fit: it scans them many times


def _in_parallel(work: Callable, items: Sequence) -> list:
    """Run independent Spark jobs side by side; the driver only waits for them."""
    with ThreadPool(min(PARALLELISM, max(len(items), 1))) as pool:
        return pool.map(work, items)


def fold_rows(df: DataFrame, k: int, key: str, seed: int, stratify: bool = True) -> DataFrame:
    """Stored rows with a ``fold``, read again by every fit, in tasks for all cores."""
    folds = assign_folds(df, k, [key], seed, LABEL if stratify else None)
    return stage(spread(folds, FIT_ROWS, df.count()), "folds")


def cross_val_predict(models: Mapping[str, Estimator], rows: DataFrame, k: int, key: str) -> DataFrame:
    """Out-of-fold predictions: ``model, fold, key, label, prediction``."""

    def one(job: tuple[str, int]) -> DataFrame:
        name, fold = job
        fitted = models[name].fit(rows.where(F.col("fold") != fold))
        held_out = fitted.transform(rows.where(F.col("fold") == fold))
        return held_out.select(F.lit(name).alias("model"), "fold", key, LABEL, "prediction")

    jobs = [(name, fold) for name in models for fold in range(k)]
    return reduce(DataFrame.unionByName, _in_parallel(one, jobs))


def cross_val(models: Mapping[str, Estimator], rows: DataFrame, k: int, key: str) -> DataFrame:
    """Accuracy per model and fold."""
    predictions = cross_val_predict(models, rows, k, key)
    hit = (F.col("prediction") == F.col(LABEL)).cast("int")
    return predictions.groupBy("model", "fold").agg(F.avg(hit).alias("score"))


def fold_axes(rows: DataFrame, n: int, folds: Sequence[int]) -> list[CentredPCAModel]:
    """For each fold, at most ``n`` components of the rows outside it, as ``components0``, ...

    The first of them are the same for any larger ``n``, so one covariance and one decomposition
    serve all numbers of components.
    """

    def one(fold: int) -> CentredPCAModel:
        pca = CentredPCA(k=n, inputCol=FEATURES, outputCol=f"components{fold}")
        return pca.fit(rows.where(F.col("fold") != fold))

    return _in_parallel(one, folds)


def fold_components(rows: DataFrame, axes: Sequence[CentredPCAModel]) -> DataFrame:
    """Stored ``fold``, label and the components of every fold, as arrays."""
    projected = reduce(lambda df, model: model.transform(df), axes, rows)
    arrays = [vector_to_array(m.getOutputCol()).alias(m.getOutputCol()) for m in axes]
    return stage(projected.select("fold", LABEL, *arrays), "components")


def _unit(estimator: Estimator) -> LogisticRegression | LinearSVC | None:
    """The linear model whose loss :func:`fit_many` minimises for the estimator, if it is one of those."""
    unit = estimator.getClassifier() if isinstance(estimator, OneVsRest) else estimator
    if type(unit) is not (LinearSVC if isinstance(estimator, OneVsRest) else LogisticRegression):
        return None
    if isinstance(unit, LogisticRegression):
        special = ("weightCol", "thresholds", "lowerBoundsOnCoefficients", "upperBoundsOnCoefficients",
                   "lowerBoundsOnIntercepts", "upperBoundsOnIntercepts")
        usual = unit.getElasticNetParam() == 0 and unit.getFamily() == "auto" and unit.getThreshold() == 0.5
    else:
        special, usual = ("weightCol",), unit.getThreshold() == 0
    plain = usual and unit.getFitIntercept() and unit.getStandardization()
    return unit if plain and not any(unit.isSet(name) for name in special) else None


def _linear_scores(
    units: Mapping[str, LogisticRegression | LinearSVC], components: Sequence[int], rows: DataFrame,
    axes: Sequence[CentredPCAModel],
) -> list[tuple[str, int, int, float]]:
    """Held-out accuracy of linear models on the components of each fold, all fitted in the same scans."""
    sizes = {r["fold"]: r["count"] for r in rows.groupBy("fold").count().collect()}  # one row per fold
    # a handful of labels
    labels = [r[0] for r in rows.select(F.col(LABEL).cast("double")).distinct().collect()]
    if any(v is None or not v >= 0 or v != int(v) for v in labels):
        raise ValueError("labels must be whole numbers from 0")
    classes = [float(i) for i in range(int(max(labels)) + 1)]
    folds = range(len(axes))

    def seen(n: int, fold: int) -> Projection:
        model = axes[fold]
        flat = model.spreads <= 1e-9 * model.spreads.max()
        scaled = model.axes * np.where(flat, 0, 1 / np.where(flat, 1, model.spreads))[:, None]
        return Projection(scaled[:n], model.axes.T @ model.offsets)

    features = {(n, fold): seen(n, fold) for n in components for fold in folds}
    ready = prepare(rows, FEATURES, LABEL, fold=F.col("fold"))
    jobs, models = [], []
    for name, unit in units.items():
        single = isinstance(unit, LogisticRegression)
        loss = "hinge" if not single else "logistic" if len(classes) == 2 else "softmax"
        fits = []
        for (n, fold), z in features.items():
            learned = sum(size for other, size in sizes.items() if other != fold)
            C = 1 / (unit.getRegParam() * learned) if unit.getRegParam() and learned else None
            fit = Fit(f"{name}|{n}", loss, C, fold, features=z, scale=False)
            fits += [fit] if single else [replace(fit, positive=v) for v in classes]
        fitted = fit_many(ready, fits, classes, unit.getMaxIter(), unit.getTol())
        each = 1 if single else len(classes)
        jobs += [(name, n, fold) for n, fold in features]
        models += fitted if single else [one_vs_rest(fitted[i : i + each]) for i in range(0, len(fitted), each)]
    hits = held_out_accuracy(ready, models, classes)
    return [(*job, float(hit)) for job, hit in zip(jobs, hits) if not np.isnan(hit)]


def pca_study(
    models: Mapping[str, Estimator], components: Sequence[int], rows: DataFrame, k: int, key: str
) -> DataFrame:
    """Mean accuracy for every model on every number of components.

    Each model is fitted on the first components of each fold, and judged on the rows held out as
    soon as it is fitted. What reaches the driver is one score per model, number and fold. Logistic
    regressions and linear support vectors per class, which take many short scans, share them
    (:func:`fit_many`, where the corner of the hinge is rounded); others are fitted by themselves.
    """
    axes = fold_axes(rows, max(components), range(k))
    units = {name: unit for name, m in models.items() if (unit := _unit(m)) is not None}
    scores = _linear_scores(units, components, rows, axes) if units else []
    jobs = [(name, n, fold) for fold in range(k) for name in models if name not in units for n in components]
    projected = fold_components(rows, axes) if jobs else None

    def one(job: tuple[str, int, int]) -> tuple[str, int, int, float | None] | None:
        name, n, fold = job
        some = array_to_vector(F.slice(f"components{fold}", 1, n))
        ready = projected.select("fold", LABEL, some.alias("__components"))
        estimator = models[name].copy()
        estimator.set(estimator.getParam("featuresCol"), "__components")
        fitted = estimator.fit(ready.where(F.col("fold") != fold))
        held_out = fitted.transform(ready.where(F.col("fold") == fold))
        hit = (F.col("prediction") == F.col(LABEL)).cast("int")
        judged = held_out.agg(F.count("*").alias("n"), F.avg(hit).alias("score")).first()
        return (*job, judged["score"]) if judged["n"] else None

    scores += [score for score in _in_parallel(one, jobs) if score]
    table = rows.sparkSession.createDataFrame(scores, "model string, components int, fold int, score double")
    return table.groupBy("model", "components").agg(F.avg("score").alias("score"))


def grid_search(
    estimator: Estimator,
    grid: Sequence[dict],
    rows: DataFrame,
    k: int,
    evaluator: Evaluator | None = None,
) -> tuple[Model, DataFrame]:
    """Best model, refitted on all rows, and a row ``params, score, place`` per setting."""
    evaluator = evaluator or MulticlassClassificationEvaluator(metricName="accuracy")
    search = CrossValidator(
        estimator=estimator, estimatorParamMaps=list(grid), evaluator=evaluator,
        numFolds=k, foldCol="fold", parallelism=PARALLELISM,
    )
    fitted = search.fit(rows)
    table = sorted(
        (
            (", ".join(f"{p.name}={v}" for p, v in setting.items()), float(score))
            for setting, score in zip(grid, fitted.avgMetrics)
        ),
        key=lambda row: -row[1],
    )
    spark: SparkSession = rows.sparkSession
    results = spark.createDataFrame(
        [(params, score, i + 1) for i, (params, score) in enumerate(table)],
        "params string, score double, place int",
    )
    return fitted.bestModel, results


def _class_shares(model: Model, df: DataFrame, name: str, n_classes: int) -> DataFrame:
    """Add the model's class probabilities, or its vote where it has none, as an array."""
    before = df.columns
    scored = model.transform(df)
    if "probability" in scored.columns:
        shares = vector_to_array("probability")
    else:
        shares = F.array(*[(F.col("prediction") == c).cast("double") for c in range(n_classes)])
    return scored.select(*before, shares.alias(name))


def bootstrap(df: DataFrame, key: str, frac: float, seed: int) -> DataFrame:
    """Each row as often as its own Poisson draw says, ``frac`` times on average.

    The draw depends on the key and the seed alone, so it is the same on any partitioning.
    """
    counted = df.withColumn("__copies", poisson_copies(key, frac, [seed])[0]).where("__copies > 0")
    return counted.withColumn("__copy", F.explode(F.sequence(F.lit(1), "__copies"))).select(df.columns)


class Bagging(Estimator, HasLabelCol):
    """Average of copies of an estimator, each fitted on a bootstrap sample of the rows."""

    def __init__(
        self, estimator: Estimator, key: str, n: int = 50, frac: float = 0.7, n_classes: int = 2,
        seed: int = 0,
    ):
        super().__init__()
        self.estimator, self.key, self.n, self.frac = estimator, key, n, frac
        self.n_classes, self.seed = n_classes, seed

    def _fit(self, df: DataFrame) -> "BaggingModel":
        def one(i: int) -> Model:
            return self.estimator.fit(bootstrap(df, self.key, self.frac, self.seed + i))

        return BaggingModel(_in_parallel(one, range(self.n)), self.n_classes)


class BaggingModel(Model, HasPredictionCol, HasProbabilityCol):
    def __init__(self, models: list[Model], n_classes: int):
        super().__init__()
        self.models, self.n_classes = models, n_classes

    def _transform(self, df: DataFrame) -> DataFrame:
        kept, scored = df.columns, df
        for i, model in enumerate(self.models):
            scored = _class_shares(model, scored, f"__s{i}", self.n_classes)
        means = F.array(
            *[
                sum((F.col(f"__s{i}")[c] for i in range(len(self.models))), F.lit(0.0)) / len(self.models)
                for c in range(self.n_classes)
            ]
        )
        averaged = scored.select(*kept, means.alias("__mean"))
        best = F.array_position("__mean", F.array_max("__mean")) - 1
        return averaged.withColumns(
            {"probability": array_to_vector("__mean"), "prediction": best.cast("double")}
        ).drop("__mean")


class Stacking(Estimator, HasLabelCol):
    """Meta-model over the out-of-fold class probabilities of base models.

    The bases see every row, the meta-model only probabilities from bases that did not.
    """

    def __init__(
        self, bases: Mapping[str, Estimator], meta: Estimator, key: str, folds: int = 5,
        n_classes: int = 2, seed: int = 0,
    ):
        super().__init__()
        self.bases, self.meta, self.key = dict(bases), meta, key
        self.folds, self.n_classes, self.seed = folds, n_classes, seed

    def _fit(self, df: DataFrame) -> "StackingModel":
        rows = fold_rows(df, self.folds, self.key, self.seed)
        jobs = [(name, fold) for fold in range(self.folds) for name in self.bases]
        fitted = dict(
            zip(
                jobs,
                _in_parallel(
                    lambda job: self.bases[job[0]].fit(rows.where(F.col("fold") != job[1])), jobs
                ),
            )
        )
        held_out = []
        for fold in range(self.folds):
            part = rows.where(F.col("fold") == fold)
            for name in self.bases:
                part = _class_shares(fitted[name, fold], part, f"__{name}", self.n_classes)
            held_out.append(part)
        scores = stage(spread(reduce(DataFrame.unionByName, held_out), FIT_ROWS, rows.count()), "out-of-fold")
        meta = self.meta.fit(_meta_features(scores, list(self.bases), self.n_classes))
        names = list(self.bases)
        full = dict(zip(names, _in_parallel(lambda name: self.bases[name].fit(rows), names)))
        return StackingModel(full, meta, self.n_classes)


def _meta_features(df: DataFrame, names: Sequence[str], n_classes: int) -> DataFrame:
    """Class probabilities of all bases as the features of the meta-model."""
    parts = [F.col(f"__{name}")[c].alias(f"__{name}_{c}") for name in names for c in range(n_classes)]
    kept = [c for c in df.columns if c not in (RAW, FEATURES, *(f"__{n}" for n in names))]
    wide = df.select(*kept, *parts)
    inputs = [f"__{name}_{c}" for name in names for c in range(n_classes)]
    assembled = VectorAssembler(inputCols=inputs, outputCol=FEATURES).transform(wide)
    return assembled.drop(*inputs)


class StackingModel(Model, HasPredictionCol):
    def __init__(self, bases: dict[str, Model], meta: Model, n_classes: int):
        super().__init__()
        self.bases, self.meta, self.n_classes = bases, meta, n_classes

    def _transform(self, df: DataFrame) -> DataFrame:
        for name, model in self.bases.items():
            df = _class_shares(model, df, f"__{name}", self.n_classes)
        return self.meta.transform(_meta_features(df, list(self.bases), self.n_classes))

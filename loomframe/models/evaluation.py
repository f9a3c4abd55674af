"""Evaluation of predictions held in a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from loomframe.functions.scalar import round_half_up
from loomframe.operators.ordering import running_total


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    hit = (F.col(label) == F.col(prediction)).cast("int")
    return df.agg(F.avg(hit).alias("accuracy"))


def _listed(column: str, classes: Sequence) -> Column:
    """The value if it is one of the classes, and an error otherwise: no row may vanish."""
    value = F.col(column)
    message = F.concat(F.lit(f"{column} has a class that is not listed: "), F.coalesce(value.cast("string"), F.lit("NULL")))
    return F.when(value.isin(list(classes)), value).otherwise(F.raise_error(message).cast("string"))


def confusion(df: DataFrame, label: str, prediction: str, classes: Sequence) -> DataFrame:
    """One row per class, true or listed, and one column ``predicted_<class>`` each.

    0 where a pair never occurs; a prediction that is not listed, or NULL, is an error.
    """
    counts = _pair_counts(df.select(label, prediction), label, prediction)
    spark, kind = df.sparkSession, df.schema[label].dataType.simpleString()
    empty = spark.createDataFrame([(c, None, 0) for c in classes], f"t {kind}, p {kind}, n bigint")
    known = counts.withColumn("p", _listed("p", classes).cast(kind)).unionByName(empty)
    cells = [
        F.coalesce(F.sum(F.when(F.col("p") == F.lit(c), F.col("n"))), F.lit(0)).alias(f"predicted_{c}")
        for c in classes
    ]
    return known.groupBy(F.col("t").alias(label)).agg(*cells)


def _pair_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("t"), F.col(prediction).alias("p")).agg(
        F.count("*").alias("n")
    )


def _ratio(a: Column, b: Column) -> Column:
    """0 where the ratio is undefined."""
    return F.coalesce(a / F.when(b != 0, b), F.lit(0.0))


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support of every class, true or predicted."""
    pairs = _pair_counts(df, label, prediction)
    sides = pairs.select(
        F.explode(
            F.when(
                F.col("t") == F.col("p"),
                F.array(F.struct(F.col("t").alias("c"), F.col("n").alias("hit"),
                                 F.col("n").alias("predicted"), F.col("n").alias("support"))),
            ).otherwise(
                F.array(
                    F.struct(F.col("t").alias("c"), F.lit(0).cast("bigint").alias("hit"),
                             F.lit(0).cast("bigint").alias("predicted"), F.col("n").alias("support")),
                    F.struct(F.col("p").alias("c"), F.lit(0).cast("bigint").alias("hit"),
                             F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("support")),
                )
            )
        ).alias("s")
    ).select("s.*")
    sums = sides.groupBy(F.col("c").alias("class")).agg(
        F.sum("hit").alias("hit"), F.sum("predicted").alias("predicted"),
        F.sum("support").alias("support"),
    )
    return sums.select(
        "class",
        _ratio(F.col("hit"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hit"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("hit"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
    )


def _score_steps(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives at and above each distinct score."""
    steps = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return running_total(steps, {"tp": "pos", "fp": "neg"}, [F.desc("score")])


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """True and false positive rate at each distinct threshold."""
    steps = _score_steps(df, label, score)
    whole = df.select(
        F.struct(
            F.count_if(F.col(label) == 1).alias("tp"), F.count_if(F.col(label) == 0).alias("fp")
        )
    ).scalar()
    return steps.select(
        "score", "tp", "fp",
        (F.col("tp") / whole["tp"]).alias("tpr"), (F.col("fp") / whole["fp"]).alias("fpr"),
    )


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve by trapezoids, ties sharing one step; summed in whole numbers."""
    steps = _score_steps(df, label, score)
    twice = F.col("neg").cast("decimal(19,0)") * (2 * F.col("tp") - F.col("pos")).cast("decimal(19,0)")
    area = steps.agg(
        F.sum(twice).cast("double").alias("twice"), F.sum("pos").alias("p"), F.sum("neg").alias("n")
    )
    return area.select((F.col("twice") / 2 / F.col("p") / F.col("n")).alias("auc"))


def log_loss(df: DataFrame, label: str, probability: str | Column) -> DataFrame:
    """Mean negative log of the probability given to the true one of two labels."""
    p = F.col(probability) if isinstance(probability, str) else probability
    return df.agg(F.avg(-F.log(F.when(F.col(label) == 1, p).otherwise(1 - p))).alias("log_loss"))


def train_test_gap(train: DataFrame, test: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy on both parts and their difference."""
    a = accuracy(train, label, prediction).scalar()
    b = test.agg(F.avg((F.col(label) == F.col(prediction)).cast("int")).alias("test_accuracy"))
    return b.withColumn("train_accuracy", a).withColumn(
        "gap", F.col("train_accuracy") - F.col("test_accuracy")
    )


def compare_models(
    scored: Mapping[str, DataFrame], label: str, prediction: str, classes: Sequence
) -> DataFrame:
    """One row per model: accuracy, and precision, recall and F1 of each class.

    A class in the rows that is not listed is an error.
    """
    rows = []
    for name, df in scored.items():
        report = class_report(df, label, prediction)
        report = report.withColumn("class", _listed("class", classes).cast(report.schema["class"].dataType))
        cells = [
            F.coalesce(F.max(F.when(F.col("class") == F.lit(c), F.col(m))), F.lit(0.0)).alias(f"{m}_{c}")
            for c in classes
            for m in ("precision", "recall", "f1")
        ]
        hits = F.sum(F.col("recall") * F.col("support"))
        share = round_half_up(hits / F.sum("support"), 6).alias("accuracy")
        rows.append(report.agg(share, *cells).withColumn("model", F.lit(name)))
    return reduce(DataFrame.unionByName, rows)


def regression_error(df: DataFrame, actual: str | Column, predicted: str | Column) -> DataFrame:
    actual = F.col(actual) if isinstance(actual, str) else actual
    predicted = F.col(predicted) if isinstance(predicted, str) else predicted
    error = actual - predicted
    return df.agg(F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"))

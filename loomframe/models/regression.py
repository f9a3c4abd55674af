"""Regression, and forecasts from lagged values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model, Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, functions as F

from loomframe.operators.timeseries import lag_columns


def fit_linear(df: DataFrame, features: Sequence[str], target: str, l2: float = 0.0) -> Model:
    """Least squares with an optional L2 penalty."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="features"),
            LinearRegression(labelCol=target, regParam=l2, elasticNetParam=0.0, solver="auto"),
        ]
    ).fit(df)


def fit_boosted(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    validation: str,
    max_iter: int = 50,
    tolerance: float = 0.01,
    seed: int = 0,
) -> Model:
    """Boosted trees that stop early once the rows flagged ``validation`` no longer improve."""
    boosted = GBTRegressor(
        labelCol=target, maxIter=max_iter, seed=seed,
        validationIndicatorCol=validation, validationTol=tolerance,
    )
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return Pipeline(stages=[assembler, boosted]).fit(df)


def lag_forecast(
    windows: DataFrame, past: int, features: Sequence[str], part: str = "part"
) -> DataFrame:
    """Forecast ``y`` of the test windows from lags, fitted on the training windows."""
    wide, names = lag_columns(windows, past, features)
    model = fit_linear(wide.where(F.col(part) == "train"), names, "y")
    return model.transform(wide.where(F.col(part) == "test")).select(
        "window_no", "y", "prediction"
    )

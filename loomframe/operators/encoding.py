"""Categories and numeric columns prepared as model features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from loomframe.functions.scalar import equals_flag, without_nan
from loomframe.operators.ordering import number_rows
from loomframe.operators.quantiles import column_quantiles, fit_row
from loomframe.session import stage

# Fixed value: the name of all rare categories together
OTHER = "resto"


def lump_rare(df: DataFrame, column: str, n: int, other: str = OTHER) -> DataFrame:
    """Keep the ``n`` most frequent values and name all others ``other``; NULL is an other.

    Equally frequent values are taken in ascending order.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("__n"))
    kept = counts.orderBy(F.desc("__n"), column).limit(n).select(F.col(column).alias("__kept"))
    # n rows
    joined = df.join(F.broadcast(kept), df[column] == F.col("__kept"), "left")
    return joined.withColumn(column, F.coalesce("__kept", F.lit(other))).drop("__kept")


def categories(df: DataFrame, column: str) -> list:
    """Known values in ascending order. They become columns of a plan: for an open vocabulary,
    which no schema should hold, there is :func:`category_index`."""
    return [row[0] for row in df.select(column).dropna().distinct().orderBy(column).collect()]


def _indicators(column: str, values: Sequence) -> dict[str, Column]:
    """0/1 columns by name; points and backticks, which no name can be addressed with, become _."""
    out: dict[str, Column] = {}
    for v in values:
        name = f"{column}_{v}".replace(".", "_").replace("`", "_")
        while name in out:
            name += "_"
        out[name] = equals_flag(column, v)
    return out


def dummies(
    df: DataFrame, cols: Sequence[str], drop_first: bool = True, values_of: Mapping[str, Sequence] | None = None
) -> DataFrame:
    """0/1 columns ``<column>_<value>`` in place of categories, without the first value each.

    ``values_of`` lists the values of a column, or they are learned.
    """
    for column in cols:
        given = (values_of or {}).get(column)
        values = list(given) if given is not None else categories(df, column)
        df = df.withColumns(_indicators(column, values[1:] if drop_first else values)).drop(column)
    return df


def one_hot(
    df: DataFrame, column: str, values: Sequence | None = None, drop_if_binary: bool = False
) -> DataFrame:
    """0/1 columns for a fixed or learned list of values; unknown values give all zeros."""
    values = list(values) if values is not None else categories(df, column)
    if drop_if_binary and len(values) == 2:
        values = values[1:]
    return df.withColumns(_indicators(column, values)).drop(column)


# -- categories of any number ------------------------------------------------------------------


def category_index(df: DataFrame, column: str) -> DataFrame:
    """``value, position``: all known values of a category in ascending order, from 0.

    A stored table, however many values there are; none of them reaches the driver.
    """
    values = df.select(F.col(column).alias("value")).dropna().distinct()
    return stage(
        number_rows(values, ["value"], name="position").withColumn("position", F.col("position") - 1),
        "categories",
    )


class SparseOneHot(Estimator):
    """One sparse 0/1 vector per category, with a place for every value; built for open vocabularies.

    Values are looked up by a join with their :func:`category_index`, so neither the plan nor the
    driver grows with them. Unknown and missing values give a vector without ones. ``drop`` leaves
    out the ``first`` value, or does so ``if_binary``. ``given`` lists values in place of learning.
    """

    def __init__(
        self, cols: Sequence[str], suffix: str = "_hot", drop: Mapping[str, str] | None = None,
        given: Mapping[str, Sequence] | None = None,
    ):
        super().__init__()
        self.cols, self.suffix, self.drop, self.given = list(cols), suffix, dict(drop or {}), dict(given or {})

    def _index(self, df: DataFrame, column: str) -> DataFrame:
        if column not in self.given:
            return category_index(df, column)
        kind = df.schema[column].dataType.simpleString()
        listed = [(v, i) for i, v in enumerate(dict.fromkeys(self.given[column]))]
        return df.sparkSession.createDataFrame(listed, f"value {kind}, position bigint")

    def _fit(self, df: DataFrame) -> "SparseOneHotModel":
        indexes, sizes, shifts = {}, {}, {}
        for column in self.cols:
            indexes[column] = self._index(df, column)
            n, how = indexes[column].count(), self.drop.get(column)
            shifts[column] = 1 if how == "first" or (how == "if_binary" and n == 2) else 0
            sizes[column] = max(n - shifts[column], 0)
        # the encoder learns nothing but the number of places
        places = df.sparkSession.createDataFrame(
            [tuple(float(max(sizes[c], 1) - 1) for c in self.cols)], [f"__{c}" for c in self.cols]
        )
        encoder = OneHotEncoder(
            inputCols=[f"__{c}" for c in self.cols], outputCols=[f"{c}{self.suffix}" for c in self.cols],
            handleInvalid="keep", dropLast=True,
        ).fit(places)
        return SparseOneHotModel(self.cols, indexes, sizes, shifts, encoder)


class SparseOneHotModel(Model):
    """``indexes`` holds the position of each value, ``sizes`` the length of each vector."""

    def __init__(self, cols, indexes, sizes, shifts, encoder):
        super().__init__()
        self.cols, self.indexes, self.sizes, self.shifts, self.encoder = cols, indexes, sizes, shifts, encoder

    def _transform(self, df: DataFrame) -> DataFrame:
        kept = df.columns
        for column in self.cols:
            size, shift = max(self.sizes[column], 1), self.shifts[column]
            index = self.indexes[column].select(
                F.col("value").alias(f"__v_{column}"), (F.col("position") - shift).alias(f"__p_{column}")
            )
            # an unknown or missing value, and a dropped one, point behind the last place
            place = F.when(F.col(f"__p_{column}") >= 0, F.col(f"__p_{column}"))
            df = df.join(index, df[column] == index[f"__v_{column}"], "left").withColumn(
                f"__{column}", F.coalesce(place, F.lit(size)).cast("double")
            )
        return self.encoder.transform(df).select(*kept, *[f"{c}{self.suffix}" for c in self.cols])

    @property
    def suffix(self) -> str:
        return self.encoder.getOutputCols()[0].removeprefix(self.cols[0])

    def names(self) -> DataFrame:
        """``column, value, place`` of every entry of the vectors; values as text."""
        parts = [
            index.where(F.col("position") >= self.shifts[c]).select(
                F.lit(c).alias("column"), F.col("value").cast("string").alias("value"),
                (F.col("position") - self.shifts[c]).alias("place"),
            )
            for c, index in self.indexes.items()
        ]
        return reduce(DataFrame.unionByName, parts)


class ColumnTransform(Transformer):
    """One vector of encoded, scaled and passed columns; made by :func:`column_transform`."""

    def __init__(
        self, hot: SparseOneHotModel | None, numbers: dict[str, Column], out: str, handle_invalid: str
    ):
        super().__init__()
        self.hot, self.numbers, self.out, self.handle_invalid = hot, numbers, out, handle_invalid

    @property
    def width(self) -> int:
        return (sum(self.hot.sizes.values()) if self.hot else 0) + len(self.numbers)

    def _cell(self, name: str, value: Column) -> Column:
        known = F.when(~F.isnan(value), value)
        if self.handle_invalid == "keep":
            return F.coalesce(known, F.lit(float("nan")))
        return F.coalesce(known, F.raise_error(F.lit(f"{name} has a missing value: impute it")).cast("double"))

    def _transform(self, df: DataFrame) -> DataFrame:
        kept = [c for c in df.columns if c != self.out]
        cells = {f"__n{i}": self._cell(c, x.cast("double")) for i, (c, x) in enumerate(self.numbers.items())}
        df, inputs = df.withColumns(cells) if cells else df, []
        if self.hot:
            df = self.hot.transform(df)
            inputs = [f"{c}{self.hot.suffix}" for c in self.hot.cols if self.hot.sizes[c]]
        assembled = VectorAssembler(inputCols=[*inputs, *cells], outputCol=self.out, handleInvalid="keep")
        return assembled.transform(df.drop(self.out)).select(*kept, self.out)


class ColumnTransformer(Estimator):
    """:func:`column_transform` as an estimator: inside a pipeline it is fitted on training rows only."""

    def __init__(self, **settings):
        super().__init__()
        self.settings = settings

    def _fit(self, df: DataFrame) -> ColumnTransform:
        return column_transform(df, **self.settings)


def column_transform(
    df: DataFrame,
    one_hot_cols: Sequence[str] = (),
    scaled_cols: Sequence[str] = (),
    passthrough: Sequence[str] = (),
    categories_of: dict[str, Sequence] | None = None,
    drop: dict[str, str] | None = None,
    impute: dict[str, str] | None = None,
    remainder: str = "drop",
    out: str = "features",
    handle_invalid: str = "error",
) -> ColumnTransform:
    """Fit one transform per column and assemble the results, in the order they are named.

    Categories are 0/1 values, zeros for unknown ones, sparse where that is shorter;
    ``categories_of`` gives them in advance, and ``drop`` leaves out the ``first`` one, or does so
    ``if_binary``. ``scaled_cols`` are centred and divided by the population deviation. ``impute``
    fills a numeric column with its ``mean`` or ``median`` before that. A number that is still
    missing (NULL or NaN) is an error that names its column, or NaN if ``handle_invalid`` is
    ``keep``. With ``remainder`` ``passthrough`` all other columns follow as they are, otherwise
    they are dropped.
    """
    fills = impute or {}
    named = [*one_hot_cols, *scaled_cols, *passthrough]
    rest = [c for c in df.columns if c not in named] if remainder == "passthrough" else []
    facts = {c: _finite(c) for c in {*scaled_cols, *fills}}
    sums = [
        f(x).alias(f"{k}_{c}")
        for c, x in facts.items()
        for k, f in (("mean", F.avg), ("std", F.stddev_pop))
    ]
    fit = df.agg(*sums).first() if sums else None
    medians = [c for c, how in fills.items() if how == "median"]
    middle = (
        {r["column"]: r["q_0"] for r in column_quantiles(df, medians, (0.5,)).collect()} if medians else {}
    )

    def value(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.coalesce(_finite(c), F.lit(middle.get(c, fit[f"mean_{c}"]))) if c in fills else x

    hot = SparseOneHot(one_hot_cols, drop=drop, given=categories_of).fit(df) if one_hot_cols else None
    numbers: dict[str, Column] = {}
    for c in scaled_cols:
        # filling with the mean or the median moves the moments
        mean, std = fit[f"mean_{c}"], fit[f"std_{c}"]
        if c in fills:
            total = df.agg(
                F.avg(value(c)).alias("m"), F.stddev_pop(value(c)).alias("s")
            ).first()
            mean, std = total["m"], total["s"]
        numbers[c] = (value(c) - F.lit(mean)) / F.lit(std or 1.0)
    for c in [*passthrough, *rest]:
        numbers[c] = value(c)
    return ColumnTransform(hot, numbers, out, handle_invalid)


def _finite(c: str) -> Column:
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


# -- scaling: parameters are scalar subqueries over the training rows; NaN is missing ----------


def _over(num: Column, den: Column) -> Column:
    """``num / den``, and ``num`` itself where the column is constant."""
    return num / F.when(den == 0, F.lit(1.0)).otherwise(den)


def standardize(train: DataFrame, other: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``other`` with columns centred and divided by the population deviation of ``train``."""
    train, other = without_nan(train, cols), without_nan(other, cols)
    facts = [f.alias(f"{k}_{c}") for c in cols for k, f in (("mean", F.avg(c)), ("std", F.stddev_pop(c)))]
    fit = train.agg(*facts).select(F.struct("*")).scalar()
    return other.withColumns({c: _over(F.col(c) - fit[f"mean_{c}"], fit[f"std_{c}"]) for c in cols})


def minmax(train: DataFrame, other: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``other`` with columns mapped so that the range of ``train`` becomes 0 to 1."""
    train, other = without_nan(train, cols), without_nan(other, cols)
    facts = [f.alias(f"{k}_{c}") for c in cols for k, f in (("min", F.min(c)), ("max", F.max(c)))]
    fit = train.agg(*facts).select(F.struct("*")).scalar()
    return other.withColumns(
        {c: _over(F.col(c) - fit[f"min_{c}"], fit[f"max_{c}"] - fit[f"min_{c}"]) for c in cols}
    )


def robust_scale(train: DataFrame, other: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``other`` with columns minus the median of ``train`` over its interquartile range."""
    train, other = without_nan(train, cols), without_nan(other, cols)
    q = column_quantiles(train, cols, (0.25, 0.5, 0.75))
    fit = fit_row(q, "column", cols, ("q_0", "q_1", "q_2"))
    return other.withColumns(
        {
            c: _over(F.col(c) - fit[f"q_1_{c}"], fit[f"q_2_{c}"] - fit[f"q_0_{c}"])
            for c in cols
        }
    )

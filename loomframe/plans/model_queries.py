"""Evaluation with exact checks, and models compared by their results on held-out rows."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from loomframe.functions.scalar import round_half_up
from loomframe.models import classifiers as c, evaluation as ev, regression, selection as sel
from loomframe.models.perceptron import MixedPerceptron
from loomframe.operators import splits, timeseries
from loomframe.plans.feature_queries import _SERIES, PAST, _draw, _r, event_windows
from loomframe.plans.registry import query
from loomframe.session import stage
from loomframe.sources.tables import table

# -- evaluation: the toxic label stands for a prediction of the quality label ----------------


def _labels(spark, d):
    return table(spark, d, "labels")


@query(
    "accuracy",
    f"SELECT {_r('avg(CASE WHEN quality = toxic THEN 1 ELSE 0 END)', 9)} AS accuracy FROM labels",
)
def accuracy(spark, d):
    score = ev.accuracy(_labels(spark, d), "quality", "toxic")
    return score.select(round_half_up("accuracy", 9).alias("accuracy"))


@query(
    "confusion",
    """SELECT quality, CAST(count(*) FILTER (toxic = 0) AS BIGINT) AS predicted_0,
              CAST(count(*) FILTER (toxic = 1) AS BIGINT) AS predicted_1
       FROM labels GROUP BY quality""",
)
def confusion(spark, d):
    return ev.confusion(_labels(spark, d), "quality", "toxic", [0, 1])


@query(
    "confusion_unseen",
    """SELECT c AS toxic, CAST(count(toxic) FILTER (quality + 1 = 1) AS BIGINT) AS predicted_1,
              CAST(count(toxic) FILTER (quality + 1 = 2) AS BIGINT) AS predicted_2,
              CAST(count(toxic) FILTER (quality + 1 = 0) AS BIGINT) AS predicted_0
       FROM (SELECT unnest([0, 1, 2]) AS c) LEFT JOIN labels ON toxic = c GROUP BY c""",
)
def confusion_unseen(spark, d):
    """A class that is predicted but never true has its row, and one never predicted its column."""
    shifted = _labels(spark, d).select("toxic", (F.col("quality") + 1).alias("guess"))
    return ev.confusion(shifted, "toxic", "guess", [0, 1, 2])


_REPORT = """SELECT c AS class, h / NULLIF(p, 0) AS "precision", h / NULLIF(s, 0) AS recall,
    2 * h / NULLIF(p + s, 0) AS f1, CAST(s AS BIGINT) AS support FROM (
      SELECT c, CAST(count(*) FILTER (t = c AND q = c) AS DOUBLE) AS h,
             CAST(count(*) FILTER (q = c) AS DOUBLE) AS p,
             CAST(count(*) FILTER (t = c) AS DOUBLE) AS s
      FROM (SELECT {truth} AS t, {guess} AS q FROM {source}),
           (SELECT unnest([0, 1]) AS c) GROUP BY c)"""


@query("class_report", _REPORT.format(truth="quality", guess="toxic", source="labels"))
def class_report(spark, d):
    return ev.class_report(_labels(spark, d), "quality", "toxic")


def _scored(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "n_chars")
    return _labels(spark, d).join(documents, "doc_id")


_STEPS = """steps AS (SELECT n_chars AS score, sum(quality) AS pos, sum(1 - quality) AS neg
                      FROM labels JOIN documents USING (doc_id) GROUP BY n_chars),
    cum AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp,
            sum(neg) OVER (ORDER BY score DESC) AS fp FROM steps)"""


@query(
    "roc_points",
    f"""WITH {_STEPS} SELECT score, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
        CAST(tp AS DOUBLE) / (SELECT sum(pos) FROM steps) AS tpr,
        CAST(fp AS DOUBLE) / (SELECT sum(neg) FROM steps) AS fpr FROM cum""",
)
def roc_points(spark, d):
    return ev.roc_points(_scored(spark, d), "quality", "n_chars")


@query(
    "auc",
    f"""WITH {_STEPS} SELECT {_r('''CAST(sum(neg * (2 * tp - pos)) AS DOUBLE) / 2
        / CAST(sum(pos) AS DOUBLE) / CAST(sum(neg) AS DOUBLE)''', 9)} AS auc FROM cum""",
)
def auc(spark, d):
    area = ev.auc(_scored(spark, d), "quality", "n_chars")
    return area.select(round_half_up("auc", 9).alias("auc"))


def _kpi(name: str, guess: str) -> str:
    report = _REPORT.format(truth="quality", guess=guess, source="labels")
    cells = ", ".join(
        f"""{_r(f'COALESCE(max("{m}") FILTER (class = {k}), 0)', 6)} AS {m}_{k}"""
        for k in (0, 1)
        for m in ("precision", "recall", "f1")
    )
    share = _r("sum(recall * support) / sum(support)", 6)
    return f"SELECT '{name}' AS model, {share} AS accuracy, {cells} FROM ({report})"


@query(
    "compare_models",
    f"{_kpi('toxic', 'toxic')} UNION ALL {_kpi('always', '1')}",
)
def compare_models(spark, d):
    labels = _labels(spark, d)
    scored = {
        "toxic": labels.select("quality", F.col("toxic").alias("guess")),
        "always": labels.select("quality", F.lit(1).alias("guess")),
    }
    table_ = ev.compare_models(scored, "quality", "guess", [0, 1])
    return table_.withColumns(
        {f"{m}_{k}": round_half_up(f"{m}_{k}", 6) for k in (0, 1) for m in ("precision", "recall", "f1")}
    )


@query(
    "train_test_gap",
    f"""SELECT {_r("avg(CAST(quality = toxic AS INTEGER)) FILTER (lang = 'en')", 6)} AS train_accuracy,
               {_r("avg(CAST(quality = toxic AS INTEGER)) FILTER (lang <> 'en')", 6)} AS test_accuracy
        FROM labels JOIN documents USING (doc_id)""",
)
def train_test_gap(spark, d):
    rows = _labels(spark, d).join(table(spark, d, "documents").select("doc_id", "lang"), "doc_id")
    gap = ev.train_test_gap(rows.where("lang = 'en'"), rows.where("lang <> 'en'"), "quality", "toxic")
    return gap.select(
        round_half_up("train_accuracy", 6).alias("train_accuracy"),
        round_half_up("test_accuracy", 6).alias("test_accuracy"),
    )


@query(
    "regression_error",
    f"""SELECT {_r('avg((o_totalprice - m) * (o_totalprice - m)) / 1000000', 4)} AS mse,
               {_r('avg(abs(o_totalprice - m))', 4)} AS mae
        FROM orders JOIN (SELECT o_custkey, avg(o_totalprice) AS m FROM orders GROUP BY o_custkey)
        USING (o_custkey)""",
)
def regression_error(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_totalprice")
    means = orders.groupBy("o_custkey").agg(F.avg("o_totalprice").alias("mean"))
    errors = ev.regression_error(orders.join(means, "o_custkey"), "o_totalprice", "mean")
    return errors.select(
        round_half_up(F.col("mse") / 1_000_000, 4).alias("mse"), round_half_up("mae", 4).alias("mae")
    )


# -- models ----------------------------------------------------------------------------------

SEED = 11


def vectors(spark, d) -> DataFrame:
    return table(spark, d, "embeddings").select(
        "vec_id",
        F.col("label").cast("double").alias("label"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
    )


def _count(text: str, pattern: str):
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


_TEXT_FEATURES = ["n_chars", "n_words", "n_lines", "n_digits", "n_capitals", "n_marks"]


def documents(spark, d) -> DataFrame:
    """Labelled documents with counts over their whole text: ``doc_id, label, raw``.

    Stored once: models read the features many times, the texts a single time. Nothing is fitted
    here; scaling belongs to the models, which see training rows only.
    """
    rows = table(spark, d, "documents").join(_labels(spark, d), "doc_id").select(
        "doc_id", "quality", "n_chars",
        F.size(F.split("text", r"\s+")).alias("n_words"),
        F.size(F.split("text", "\n")).alias("n_lines"),
        _count("text", r"\d").alias("n_digits"),
        _count("text", r"\p{Lu}").alias("n_capitals"),
        _count("text", r"\p{Punct}").alias("n_marks"),
    )
    return stage(c.assemble(rows, _TEXT_FEATURES, "quality", "doc_id"), "text-features")


_LANGUAGES = ["de", "en", "es", "fr"]
_MARKERS = ["th", "ung", "ci", "eau", "e", "s", "[äöüß]", "[áíóúñ]", "[àèêç]"]


def languages(spark, d) -> DataFrame:
    """All documents with the share of some letters, and the language as the label to learn."""
    text = F.lower("text")
    shares = [
        (F.regexp_count(text, F.lit(pattern)) * 100.0 / F.greatest(F.length("text"), F.lit(1))).alias(f"share{i}")
        for i, pattern in enumerate(_MARKERS)
    ]
    label = F.array_position(F.array(*[F.lit(x) for x in _LANGUAGES]), F.col("lang")) - 1
    rows = table(spark, d, "documents").select("doc_id", label.alias("language"), *shares)
    names = [f"share{i}" for i in range(len(_MARKERS))]
    return stage(c.assemble(rows, names, "language", "doc_id"), "language-features")


def held_out(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame, int]:
    """Training rows, test rows, and the number of training rows."""
    marked = splits.hash_split(rows, 0.3, [key], SEED)
    train, test = (marked.where(f"is_test = {i}").drop("is_test") for i in (0, 1))
    return train, test, train.count()


def predicted(model, test: DataFrame) -> DataFrame:
    """Test rows per true and predicted class."""
    scored = model.transform(test)
    return scored.groupBy("label", "prediction").agg(F.count("*").alias("n_rows"))


def verdicts(scored: DataFrame, truth: DataFrame, key: str, by: str = "model") -> DataFrame:
    """One row per model: its rows, whether each was predicted once as a known class, and whether
    it is right more often than the most frequent class of ``truth`` would be."""
    counts = truth.groupBy("label").agg(F.count("*").alias("n"))
    share = counts.select(F.max("n") / F.sum("n")).scalar()
    classes = counts.select(F.collect_set("label")).scalar()  # a handful of classes
    known = F.array_contains(classes, F.col("prediction"))
    sums = scored.groupBy(by).agg(
        F.count("*").alias("n_rows"),
        F.countDistinct(key).alias("n_keys"),
        F.count_if(known).alias("n_known"),
        F.avg((F.col("prediction") == F.col("label")).cast("int")).alias("accuracy"),
    )
    once = (F.col("n_keys") == F.col("n_rows")) & (F.col("n_known") == F.col("n_rows"))
    return sums.select(by, "n_rows", once.alias("each_once"), (F.col("accuracy") > share).alias("beats_majority"))


def _judged(name: str, estimator, rows: DataFrame) -> DataFrame:
    """Fit on the training rows, judge on the others."""
    train, test, _ = held_out(rows, "doc_id")
    scored = estimator.fit(train).transform(test).withColumn("model", F.lit(name))
    return verdicts(scored, test, "doc_id")


_ALL_TEST = f"{_draw('doc_id', SEED)} % 10000 < 3000"


def _good(name: str, source: str = "documents") -> str:
    """What a sound model does: every test row once, and better than the most frequent class."""
    return f"""SELECT '{name}' AS model, CAST(count(*) AS BIGINT) AS n_rows, TRUE AS each_once,
        TRUE AS beats_majority FROM {source} WHERE {_ALL_TEST}"""


_LABELLED = "documents JOIN labels USING (doc_id)"


def _size(rows: DataFrame) -> int:
    return held_out(rows, "doc_id")[2]


@query("m_logreg", _good("logreg"))
def m_logreg(spark, d):
    rows = languages(spark, d)
    return _judged("logreg", c.scaled(c.logreg(_size(rows))), rows)


@query("m_tree", _good("tree"))
def m_tree(spark, d):
    return _judged("tree", c.scaled(c.tree(seed=SEED)), languages(spark, d))


@query("m_forest", _good("forest"))
def m_forest(spark, d):
    return _judged("forest", c.scaled(c.forest(max_depth=15, seed=SEED)), languages(spark, d))


@query(
    "m_nb",
    f"""WITH s AS (SELECT *, {_draw('vec_id', SEED)} % 10000 < 3000 AS is_test FROM embeddings),
             l AS (SELECT vec_id, label, is_test, generate_subscripts(embedding, 1) AS j,
                   CAST(unnest(embedding) AS DOUBLE) AS x FROM s),
             f AS (SELECT label AS c, j, avg(x) AS m, var_pop(x) AS v, count(*) AS n FROM l
                   WHERE NOT is_test GROUP BY label, j),
             e AS (SELECT max(v) * 1e-9 AS eps FROM (SELECT j, var_pop(x) AS v FROM l
                   WHERE NOT is_test GROUP BY j)),
             p AS (SELECT vec_id, label, c, ln(any_value(n)) - 0.5 * sum(ln(2 * pi() * (v + eps))
                   + (x - m) * (x - m) / (v + eps)) AS score
                   FROM l JOIN f USING (j), e WHERE is_test GROUP BY vec_id, label, c),
             r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, c) AS r
                   FROM p)
        SELECT CAST(label AS DOUBLE) AS label, CAST(c AS DOUBLE) AS prediction,
               CAST(count(*) AS BIGINT) AS n_rows FROM r WHERE r = 1 GROUP BY label, c""",
)
def m_nb(spark, d):
    train, test, _ = held_out(vectors(spark, d), "vec_id")
    return predicted(c.gaussian_nb().fit(train), test)


@query("m_lda", _good("lda"))
def m_lda(spark, d):
    return _judged("lda", c.scaled(c.LinearDiscriminant()), languages(spark, d))


@query(
    "m_lda_counts",
    f"""WITH s AS (SELECT CAST(label AS DOUBLE) AS label, CAST(embedding[1] AS DOUBLE) AS x,
                   CAST(embedding[2] AS DOUBLE) AS y, {_draw('vec_id', SEED)} % 10000 < 3000 AS is_test,
                   vec_id FROM embeddings),
             m AS (SELECT label AS c, avg(x) AS mx, avg(y) AS my, count(*) AS n FROM s
                   WHERE NOT is_test GROUP BY label),
             v AS (SELECT sum((x - mx) * (x - mx)) / any_value(d) AS xx, sum((x - mx) * (y - my)) / any_value(d) AS xy,
                   sum((y - my) * (y - my)) / any_value(d) AS yy FROM s JOIN m ON label = c,
                   (SELECT sum(n) - count(*) AS d FROM m) WHERE NOT is_test),
             w AS (SELECT c, mx, my, ln(n / (SELECT sum(n) FROM m)) AS prior,
                   (mx * yy - my * xy) / (xx * yy - xy * xy) AS wx,
                   (my * xx - mx * xy) / (xx * yy - xy * xy) AS wy FROM m, v),
             p AS (SELECT label, c, row_number() OVER (PARTITION BY vec_id ORDER BY
                   prior - 0.5 * (wx * mx + wy * my) + wx * x + wy * y DESC, c) AS r
                   FROM s, w WHERE is_test)
        SELECT label, c AS prediction, CAST(count(*) AS BIGINT) AS n_rows FROM p WHERE r = 1
        GROUP BY label, c""",
)
def m_lda_counts(spark, d):
    """Linear discriminants of two features, whose equations SQL can solve: rows per pair of classes."""
    train, test, _ = held_out(_first_two(spark, d), "vec_id")
    return predicted(c.LinearDiscriminant().fit(train), test)


_FOLDS = 5


@query(
    "m_cross_val_scores",
    f"""WITH s AS (SELECT vec_id, CAST(label AS DOUBLE) AS label, CAST(embedding[1] AS DOUBLE) AS x,
                   CAST(embedding[2] AS DOUBLE) AS y, (row_number() OVER (PARTITION BY label
                   ORDER BY {_draw('vec_id', SEED)}, vec_id) - 1) % {_FOLDS} AS fold FROM embeddings),
             g AS (SELECT DISTINCT fold AS g FROM s),
             f AS (SELECT g, label AS c, count(*) AS n, avg(x) AS mx, var_pop(x) AS vx, avg(y) AS my,
                   var_pop(y) AS vy FROM s JOIN g ON fold <> g GROUP BY g, label),
             e AS (SELECT g, greatest(var_pop(x), var_pop(y)) * 1e-9 AS eps FROM s JOIN g ON fold <> g GROUP BY g),
             p AS (SELECT fold, label, c, row_number() OVER (PARTITION BY vec_id ORDER BY
                   ln(n) - 0.5 * (ln(vx + eps) + (x - mx) * (x - mx) / (vx + eps)
                                  + ln(vy + eps) + (y - my) * (y - my) / (vy + eps)) DESC, c) AS r
                   FROM s JOIN f ON fold = f.g JOIN e ON fold = e.g)
        SELECT 'nb' AS model, CAST(fold AS INTEGER) AS fold, {_r('avg(CAST(label = c AS INTEGER))', 9)} AS score
        FROM p WHERE r = 1 GROUP BY fold""",
)
def m_cross_val_scores(spark, d):
    """The accuracy of each fold, by a model that SQL can fit as well."""
    rows = sel.fold_rows(_first_two(spark, d), _FOLDS, "vec_id", SEED)
    scores = sel.cross_val({"nb": c.gaussian_nb()}, rows, _FOLDS, "vec_id")
    return scores.select("model", "fold", round_half_up("score", 9).alias("score"))


def _first_two(spark, d) -> DataFrame:
    x = F.col("embedding").cast("array<double>")
    return table(spark, d, "embeddings").select(
        "vec_id", F.col("label").cast("double").alias("label"), array_to_vector(F.slice(x, 1, 2)).alias("features")
    )


@query("m_perceptron", _good("perceptron"))
def m_perceptron(spark, d):
    """The perceptron rule itself, mixed over partitions."""
    return _judged("perceptron", c.scaled(MixedPerceptron(epochs=30)), languages(spark, d))


@query("m_mlp", _good("mlp"))
def m_mlp(spark, d):
    layers = [len(_MARKERS), 16, len(_LANGUAGES)]
    return _judged("mlp", c.scaled(c.mlp(layers, seed=SEED)), languages(spark, d))


def _english(rows: DataFrame) -> DataFrame:
    """Two classes: one language against all others."""
    return rows.withColumn("label", (F.col("label") == _LANGUAGES.index("en")).cast("double"))


@query("m_svm_linear", _good("svm_linear"))
def m_svm_linear(spark, d):
    rows = _english(languages(spark, d))
    return _judged("svm_linear", c.scaled(c.svm_linear(_size(rows), C=0.1)), rows)


@query("m_svm_poly", _good("svm_poly"))
def m_svm_poly(spark, d):
    rows = _english(languages(spark, d))
    return _judged("svm_poly", c.scaled(c.svm_poly(_size(rows), C=0.1, degree=2, coef0=2.0)), rows)


@query("m_svm_rbf", _good("svm_rbf"))
def m_svm_rbf(spark, d):
    rows = _english(languages(spark, d))
    return _judged("svm_rbf", c.scaled(c.svm_rbf(_size(rows), C=2.0, gamma=0.5, seed=SEED)), rows)


@query("m_knn", _good("knn"))
def m_knn(spark, d):
    """Nearest neighbours as an estimator with class probabilities."""
    near = c.KNNClassifier(key="doc_id", n_features=len(_MARKERS), n_classes=len(_LANGUAGES))
    return _judged("knn", c.scaled(near), languages(spark, d))


@query("m_stacking", _good("stacking"))
def m_stacking(spark, d):
    rows = languages(spark, d)
    bases = {
        "forest": c.scaled(c.forest(n_trees=20, max_depth=8, seed=SEED)),
        "logreg": c.scaled(c.logreg(_size(rows))),
        "knn": c.scaled(c.KNNClassifier(key="doc_id", n_features=len(_MARKERS), n_classes=len(_LANGUAGES))),
    }
    meta = c.forest(n_trees=20, max_depth=8, seed=SEED)
    stacked = sel.Stacking(bases, meta, key="doc_id", folds=5, n_classes=len(_LANGUAGES), seed=SEED)
    return _judged("stacking", stacked, rows)


def _four(n: int) -> dict:
    return {
        "LR": c.scaled(c.logreg(n)),
        "DTC": c.scaled(c.tree(max_depth=15, seed=SEED)),
        "PER": c.scaled(c.perceptron()),
        "RFC": c.scaled(c.forest(n_trees=20, max_depth=10, seed=SEED)),
    }


def _all_models(*names: str) -> str:
    """Every document held out once by every model, which beats the most frequent class."""
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS model, (SELECT count(*) FROM documents) AS n_rows, TRUE AS each_once,
                   TRUE AS beats_majority"""
        for name in names
    )


@query("m_cross_val", _all_models("LR", "DTC", "PER", "RFC"))
def m_cross_val(spark, d):
    """Four models, each fitted with its own scaling inside every fold; all rows are held out once."""
    rows = sel.fold_rows(languages(spark, d), 5, "doc_id", SEED)
    predictions = sel.cross_val_predict(_four(rows.count()), rows, 5, "doc_id")
    return verdicts(predictions, rows, "doc_id")


@query("m_cross_val_predict", _all_models("LDA", "NB"))
def m_cross_val_predict(spark, d):
    """Out-of-fold predictions of two more models."""
    rows = sel.fold_rows(languages(spark, d), 5, "doc_id", SEED)
    models = {"LDA": c.scaled(c.LinearDiscriminant()), "NB": c.scaled(c.gaussian_nb())}
    return verdicts(sel.cross_val_predict(models, rows, 5, "doc_id"), rows, "doc_id")


_IMPURITY, _SUBSETS, _TREES = ["gini", "entropy"], ["sqrt", "log2"], [10, 20]


@query(
    "m_grid",
    f"""SELECT i AS impurity, s AS subset, t AS trees, TRUE AS beats_majority
        FROM (SELECT unnest({_IMPURITY}) AS i), (SELECT unnest({_SUBSETS}) AS s),
             (SELECT unnest({_TREES}) AS t)""",
)
def m_grid(spark, d):
    """A forest's grid by cross-validation; scaling is fitted inside each fold."""
    rows = sel.fold_rows(languages(spark, d), 5, "doc_id", SEED)
    forest = c.forest(max_depth=8, seed=SEED)
    grid = (
        ParamGridBuilder()
        .addGrid(forest.impurity, _IMPURITY)
        .addGrid(forest.featureSubsetStrategy, _SUBSETS)
        .addGrid(forest.numTrees, _TREES)
        .build()
    )
    _, results = sel.grid_search(c.scaled(forest), grid, rows, 5)
    counts = rows.groupBy("label").agg(F.count("*").alias("n"))
    share = counts.select(F.max("n") / F.sum("n")).scalar()
    value = lambda name: F.regexp_extract("params", f"{name}=([^,]+)", 1)
    return results.select(
        value("impurity").alias("impurity"), value("featureSubsetStrategy").alias("subset"),
        value("numTrees").cast("int").alias("trees"), (F.col("score") > share).alias("beats_majority"),
    )


@query(
    "m_pca_study",
    """SELECT m AS model, CAST(n AS INTEGER) AS components, TRUE AS in_range
       FROM (SELECT unnest(['LR', 'DTC', 'PER', 'RFC']) AS m), (SELECT unnest([2, 3, 4, 5]) AS n)""",
)
def m_pca_study(spark, d):
    """Four models on four numbers of components: a score between 0.3 and 1 for each."""
    rows = sel.fold_rows(languages(spark, d).withColumnRenamed("raw", "features"), 5, "doc_id", SEED)
    n = rows.count()
    models = {
        "LR": c.logreg(n), "DTC": c.tree(max_depth=8, seed=SEED), "PER": c.perceptron(max_iter=20),
        "RFC": c.forest(n_trees=10, max_depth=8, seed=SEED),
    }
    scores = sel.pca_study(models, [2, 3, 4, 5], rows, 5, "doc_id")
    return scores.select("model", "components", F.col("score").between(0.3, 1.0).alias("in_range"))


@query(
    "m_linear_fit",
    f"""SELECT p_partkey, {_r('''(SELECT regr_intercept(p_retailprice, p_size) FROM part)
        + (SELECT regr_slope(p_retailprice, p_size) FROM part) * p_size''', 4)} AS prediction
        FROM part""",
)
def m_linear_fit(spark, d):
    """Least squares without penalty, which SQL can repeat for one feature."""
    part = table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice")
    model = regression.fit_linear(part, ["p_size"], "p_retailprice")
    return model.transform(part).select("p_partkey", round_half_up("prediction", 4).alias("prediction"))


@query(
    "m_regression",
    f"""SELECT m AS model, CAST(n AS BIGINT) AS n_rows, TRUE AS beats_mean
        FROM (SELECT unnest(['ridge', 'boosted']) AS m),
             (SELECT count(*) AS n FROM lineitem
              WHERE {_draw("l_orderkey || '|' || l_linenumber", SEED)} % 10000 < 2500)""",
)
def m_regression(spark, d):
    """Ridge regression and early-stopped boosting of the net price, by their error on held-out lines."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax",
        F.year("l_shipdate").alias("year"), net.alias("net"),
    )
    features = ["l_extendedprice", "l_discount", "l_tax", "year"]
    marked = splits.hash_split(lines, 0.25, ["l_orderkey", "l_linenumber"], SEED)
    train, test = marked.where("is_test = 0").drop("is_test"), marked.where("is_test = 1")
    ridge = regression.fit_linear(train, features, "net", l2=0.01)
    flagged = splits.hash_split(train, 0.2, ["l_orderkey", "l_linenumber"], SEED + 1)
    flagged = flagged.withColumn("is_validation", F.col("is_test") == 1)
    boosted = regression.fit_boosted(
        flagged, features, "net", "is_validation", max_iter=20, seed=SEED
    )
    spread = test.select(F.var_pop("net")).scalar()
    size = test.select(F.count("*")).scalar()
    errors = [
        ev.regression_error(m.transform(test), "net", "prediction").select(
            F.lit(name).alias("model"), size.alias("n_rows"), (F.col("mse") < spread).alias("beats_mean")
        )
        for name, m in (("ridge", ridge), ("boosted", boosted))
    ]
    return errors[0].unionByName(errors[1])


@query(
    "m_lag_forecast",
    f"""WITH {_SERIES} SELECT m AS model, n_rows, m = 'lags' AS beats_persistence
        FROM (SELECT unnest(['lags', 'persistence']) AS m),
             (SELECT CAST(count(*) AS BIGINT) AS n_rows FROM w WHERE y IS NOT NULL AND part = 'test')""",
)
def m_lag_forecast(spark, d):
    """Forecast two events ahead from five lags and the season, next to persistence."""
    windows = stage(event_windows(spark, d), "windows")
    forecast = regression.lag_forecast(windows, PAST, ["value", "portion_year"])
    baseline = timeseries.persistence(windows.where("part = 'test'"), PAST, "value")
    bar = ev.regression_error(baseline, "y", "prediction").select("mse").scalar()
    errors = [
        ev.regression_error(rows, "y", "prediction").select(
            F.lit(name).alias("model"),
            rows.select(F.count("*")).scalar().alias("n_rows"),
            (F.col("mse") < bar).alias("beats_persistence"),
        )
        for name, rows in (("lags", forecast), ("persistence", baseline))
    ]
    return errors[0].unionByName(errors[1])

"""Feature preparation, splits, neighbours and windows."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F
from pyspark.sql.functions import unwrap_udt

from loomframe.functions.scalar import round_half_up
from loomframe.models.classifiers import CentredPCA
from loomframe.models.evaluation import regression_error
from loomframe.operators import encoding, neighbors, ordering, splits, timeseries
from loomframe.plans.registry import query
from loomframe.sources.tables import table


def _r(expr: str, digits: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def _draw(key: str, seed: int) -> str:
    """The seeded draw of a row, in SQL."""
    return f"CAST('0x' || substr(md5('{seed}|' || {key}), 1, 13) AS BIGINT)"


def _indicator(column: str, value: str) -> str:
    return f"""CASE WHEN {column} = '{value}' THEN 1 ELSE 0 END AS "{column}_{value}\""""


_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(
    "dummies",
    f"SELECT p_partkey, {', '.join(_indicator('p_type', t) for t in _TYPES[1:])} FROM part",
)
def dummies(spark, d):
    return encoding.dummies(table(spark, d, "part").select("p_partkey", "p_type"), ["p_type"])


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM"]


@query(
    "one_hot_known",
    f"""SELECT o_orderkey, {', '.join(_indicator('o_orderpriority', p) for p in _PRIORITIES)}
        FROM orders""",
)
def one_hot_known(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return encoding.one_hot(orders, "o_orderpriority", _PRIORITIES)


@query(
    "one_hot_binary",
    f"SELECT l_orderkey, l_linenumber, {_indicator('l_linestatus', 'O')} FROM lineitem",
)
def one_hot_binary(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus")
    return encoding.one_hot(lines, "l_linestatus", drop_if_binary=True)


@query(
    "column_transform",
    "SELECT p_partkey, "
    + ", ".join(
        f"CAST(CASE WHEN p_type = '{t}' THEN 1 ELSE 0 END AS DOUBLE) AS f{i}"
        for i, t in enumerate(_TYPES)
    )
    + f""", {_r('(p_size - (SELECT avg(p_size) FROM part)) / (SELECT stddev_pop(p_size) FROM part)', 6)}
         AS f6, p_retailprice AS f7 FROM part""",
)
def column_transform(spark, d):
    part = table(spark, d, "part")
    model = encoding.column_transform(
        part, one_hot_cols=["p_type"], scaled_cols=["p_size"], passthrough=["p_retailprice"]
    )
    values = vector_to_array("features")
    cols = [values[i].alias(f"f{i}") for i in range(len(_TYPES) + 2)]
    wide = model.transform(part).select("p_partkey", *cols)
    return wide.withColumn("f6", round_half_up("f6", 6))


_BRANDS = ["Brand#1", "Brand#2", "Brand#99"]
_FILLED = "COALESCE(CAST(nullif(p_size, 7) AS DOUBLE), (SELECT median(nullif(p_size, 7)) FROM part))"


@query(
    "column_transform_full",
    "SELECT p_partkey, "
    + ", ".join(
        f"CAST(CASE WHEN p_type = '{t}' THEN 1 ELSE 0 END AS DOUBLE) AS f{i}" for i, t in enumerate(_TYPES[1:])
    )
    + ", "
    + ", ".join(
        f"CAST(CASE WHEN p_brand = '{b}' THEN 1 ELSE 0 END AS DOUBLE) AS f{i + 5}" for i, b in enumerate(_BRANDS)
    )
    + f""", CAST(CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS DOUBLE) AS f8,
        {_r(f"({_FILLED} - (SELECT avg({_FILLED}) FROM part)) / (SELECT stddev_pop({_FILLED}) FROM part)", 6)} AS f9,
        CAST(p_partkey AS DOUBLE) AS f10, p_retailprice AS f11 FROM part""",
)
def column_transform_full(spark, d):
    """Dropped first and binary categories, given categories, imputing, and all other columns."""
    part = table(spark, d, "part").select(
        "p_partkey", "p_type", "p_brand",
        F.when(F.col("p_size") > 25, "yes").otherwise("no").alias("dear"),
        F.nullif("p_size", F.lit(7)).alias("p_size"), "p_retailprice",
    )
    model = encoding.column_transform(
        part, one_hot_cols=["p_type", "p_brand", "dear"], scaled_cols=["p_size"],
        categories_of={"p_brand": _BRANDS}, drop={"p_type": "first", "dear": "if_binary"},
        impute={"p_size": "median"}, remainder="passthrough",
    )
    values = vector_to_array("features")
    wide = model.transform(part).select("p_partkey", *[values[i].alias(f"f{i}") for i in range(12)])
    return wide.withColumn("f9", round_half_up("f9", 6))


@query(
    "standardize",
    f"""WITH s AS (SELECT *, {_draw('p_partkey', 3)} % 10000 < 3000 AS is_test FROM part),
             f AS (SELECT avg(p_size) AS m1, stddev_pop(p_size) AS s1, avg(p_retailprice) AS m2,
                   stddev_pop(p_retailprice) AS s2 FROM s WHERE NOT is_test)
        SELECT p_partkey, {_r('(p_size - m1) / s1', 6)} AS p_size,
               {_r('(p_retailprice - m2) / s2', 6)} AS p_retailprice FROM s, f WHERE is_test""",
)
def standardize(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice")
    marked = splits.hash_split(part, 0.3, ["p_partkey"], seed=3)
    train, test = marked.where("is_test = 0"), marked.where("is_test = 1")
    scaled = encoding.standardize(train, test, ["p_size", "p_retailprice"]).drop("is_test")
    return scaled.withColumns({c: round_half_up(c, 6) for c in ("p_size", "p_retailprice")})


@query(
    "minmax",
    f"""WITH f AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer)
        SELECT c_custkey, {_r('(c_acctbal - lo) / (hi - lo)', 6)} AS c_acctbal FROM customer, f""",
)
def minmax(spark, d):
    customers = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    scaled = encoding.minmax(customers, customers, ["c_acctbal"])
    return scaled.withColumn("c_acctbal", round_half_up("c_acctbal", 6))


def _robust(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    q = [f"(SELECT quantile_cont({x}, {p}) FROM part)" for p in (0.25, 0.5, 0.75)]
    return f"{_r(f'({x} - {q[1]}) / ({q[2]} - {q[0]})', 6)} AS {c}"


def _with_nan(spark, d):
    """Parts whose size is NaN where 7 divides it."""
    size = F.when(F.col("p_size") % 7 == 0, float("nan")).otherwise(F.col("p_size").cast("double"))
    return table(spark, d, "part").select("p_partkey", size.alias("size"))


_SIZES = "(SELECT p_partkey, CASE WHEN p_size % 7 <> 0 THEN CAST(p_size AS DOUBLE) END AS size FROM part)"


@query(
    "standardize_nan",
    f"""WITH f AS (SELECT avg(size) AS m, stddev_pop(size) AS s FROM {_SIZES})
        SELECT p_partkey, {_r('(size - m) / s', 6)} AS size FROM {_SIZES}, f""",
)
def standardize_nan(spark, d):
    """NaN is missing: it moves no moment and stays missing."""
    part = _with_nan(spark, d)
    return encoding.standardize(part, part, ["size"]).withColumn("size", round_half_up("size", 6))


@query(
    "minmax_nan",
    f"""WITH f AS (SELECT min(size) AS lo, max(size) AS hi FROM {_SIZES})
        SELECT p_partkey, {_r('(size - lo) / (hi - lo)', 6)} AS size FROM {_SIZES}, f""",
)
def minmax_nan(spark, d):
    part = _with_nan(spark, d)
    return encoding.minmax(part, part, ["size"]).withColumn("size", round_half_up("size", 6))


@query(
    "one_hot_open",
    """SELECT p_partkey, CAST(place_name AS INTEGER) AS place_name, n_names,
              CAST(place_brand AS INTEGER) AS place_brand, n_brands
       FROM (SELECT p_partkey, dense_rank() OVER (ORDER BY p_name) - 1 AS place_name,
                    (SELECT count(DISTINCT p_name) FROM part) AS n_names,
                    nullif(dense_rank() OVER (ORDER BY p_brand), 1) - 2 AS place_brand,
                    (SELECT count(DISTINCT p_brand) - 1 FROM part) AS n_brands FROM part)""",
)
def one_hot_open(spark, d):
    """Every part name as a category of its own: the place of the one in each sparse vector."""
    part = table(spark, d, "part").select("p_partkey", "p_name", "p_brand")
    model = encoding.SparseOneHot(["p_name", "p_brand"], drop={"p_brand": "first"}).fit(part)
    hot = model.transform(part)
    place = lambda c: F.get(F.col(f"v_{c}.indices"), F.lit(0))
    shown = hot.select("p_partkey", *[unwrap_udt(f"{c}_hot").alias(f"v_{c}") for c in ("p_name", "p_brand")])
    return shown.select(
        "p_partkey", place("p_name").alias("place_name"), F.col("v_p_name.size").cast("bigint").alias("n_names"),
        place("p_brand").alias("place_brand"), F.col("v_p_brand.size").cast("bigint").alias("n_brands"),
    )


@query(
    "column_transform_keep",
    f"""WITH f AS (SELECT avg(size) AS m, stddev_pop(size) AS s FROM {_SIZES})
        SELECT p_partkey, size IS NULL AS missing, {_r('(size - m) / s', 6)} AS size FROM {_SIZES}, f""",
)
def column_transform_keep(spark, d):
    """A missing number stays missing in the vector, where that is asked for."""
    part = _with_nan(spark, d)
    model = encoding.column_transform(part, scaled_cols=["size"], handle_invalid="keep")
    x = vector_to_array("features")[0]
    known = F.when(~F.isnan(x), x)
    return model.transform(part).select(
        "p_partkey", F.isnan(x).alias("missing"), round_half_up(known, 6).alias("size")
    )


@query(
    "robust_scale",
    f"SELECT p_partkey, {_robust('p_size')}, {_robust('p_retailprice')} FROM part",
)
def robust_scale(spark, d):
    cols = ["p_size", "p_retailprice"]
    part = table(spark, d, "part").select("p_partkey", *cols)
    scaled = encoding.robust_scale(part, part, cols)
    return scaled.withColumns({c: round_half_up(c, 6) for c in cols})


@query("pca")
def pca(spark, d):
    """Embeddings on three principal components."""
    vectors = table(spark, d, "embeddings").select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    model = CentredPCA(k=3).fit(vectors)
    parts = vector_to_array("components")
    return model.transform(vectors).select("vec_id", *[parts[i].alias(f"pc{i}") for i in range(3)])


# -- splits ----------------------------------------------------------------------------------


@query(
    "hash_split",
    f"""SELECT p_partkey, CASE WHEN {_draw('p_partkey', 7)} % 10000 < 2500 THEN 1 ELSE 0 END
        AS is_test FROM part""",
)
def hash_split(spark, d):
    return splits.hash_split(table(spark, d, "part").select("p_partkey"), 0.25, ["p_partkey"], 7)


@query(
    "stratified_split",
    f"""SELECT doc_id, quality, CASE WHEN row_number() OVER (PARTITION BY quality
               ORDER BY {_draw('doc_id', 7)}, doc_id)
               <= round(count(*) OVER (PARTITION BY quality) * 0.2::DOUBLE) THEN 1 ELSE 0 END
               AS is_test FROM labels""",
)
def stratified_split(spark, d):
    labels = table(spark, d, "labels").select("doc_id", "quality")
    return splits.stratified_split(labels, "quality", 0.2, ["doc_id"], 7)


@query(
    "stratified_null",
    f"""SELECT doc_id, nullif(quality, 1) AS quality, CASE WHEN row_number() OVER
               (PARTITION BY quality ORDER BY {_draw('doc_id', 7)}, doc_id)
               <= round(count(*) OVER (PARTITION BY quality) * 0.2::DOUBLE) THEN 1 ELSE 0 END
               AS is_test FROM labels""",
)
def stratified_null(spark, d):
    """Rows without a label are split like those of any label."""
    labels = table(spark, d, "labels").select("doc_id", F.nullif("quality", F.lit(1)).alias("quality"))
    return splits.stratified_split(labels, "quality", 0.2, ["doc_id"], 7)


@query(
    "ordered_split",
    """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey) <= 3000
              THEN 'train' ELSE 'test' END AS part FROM orders""",
)
def ordered_split(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return splits.ordered_split(orders, ["o_orderdate", "o_orderkey"], 3000).drop("o_orderdate")


@query(
    "tail_split",
    """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey)
              <= floor(count(*) OVER () * 0.8::DOUBLE) THEN 'train' ELSE 'validation' END AS part
       FROM orders""",
)
def tail_split(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return splits.tail_split(orders, ["o_orderdate", "o_orderkey"], 0.2).drop("o_orderdate")


@query(
    "assign_folds",
    f"""SELECT doc_id, CAST((row_number() OVER (ORDER BY {_draw('doc_id', 7)}, doc_id) - 1) % 5
               AS INTEGER) AS fold FROM labels""",
)
def assign_folds(spark, d):
    return splits.assign_folds(table(spark, d, "labels").select("doc_id"), 5, ["doc_id"], 7)


@query(
    "assign_folds_stratified",
    f"""SELECT doc_id, quality, CAST((row_number() OVER (PARTITION BY quality
               ORDER BY {_draw('doc_id', 7)}, doc_id) - 1) % 10 AS INTEGER) AS fold FROM labels""",
)
def assign_folds_stratified(spark, d):
    labels = table(spark, d, "labels").select("doc_id", "quality")
    return splits.assign_folds(labels, 10, ["doc_id"], 7, label="quality")


@query(
    "shuffle_rows",
    f"""SELECT o_orderkey, row_number() OVER (ORDER BY {_draw('o_orderkey', 7)}, o_orderkey)
        AS place FROM orders""",
)
def shuffle_rows(spark, d):
    return ordering.shuffle(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], 7)


# -- neighbours ------------------------------------------------------------------------------


@query(
    "knn_classify",
    f"""WITH s AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, label,
                   {_draw('vec_id', 5)} % 10000 < 3000 AS is_test FROM embeddings),
             p AS (SELECT q.vec_id AS vec_id, t.label AS label, row_number() OVER (
                     PARTITION BY q.vec_id ORDER BY list_distance(q.x, t.x), t.vec_id) AS place
                   FROM s q, s t WHERE q.is_test AND NOT t.is_test),
             v AS (SELECT vec_id, label, row_number() OVER (PARTITION BY vec_id
                     ORDER BY count(*) DESC, label) AS r FROM p WHERE place <= 5
                   GROUP BY vec_id, label)
        SELECT vec_id, label AS prediction FROM v WHERE r = 1""",
)
def knn_classify(spark, d):
    marked = splits.hash_split(table(spark, d, "embeddings"), 0.3, ["vec_id"], seed=5)
    train, test = marked.where("is_test = 0"), marked.where("is_test = 1")
    x = F.col("embedding").cast("array<double>")
    return neighbors.knn_classify(train, test, "vec_id", x, 64, "label", k=5)


def _gap_distance(cols: list[str]) -> str:
    known = [f"(q.{c} IS NOT NULL AND t.{c} IS NOT NULL)" for c in cols]
    total = " + ".join(
        f"CASE WHEN {k} THEN (q.{c} - t.{c}) * (q.{c} - t.{c}) ELSE 0 END"
        for c, k in zip(cols, known)
    )
    count = " + ".join(f"CAST({k} AS INTEGER)" for k in known)
    return f"({total}) * (CAST({len(cols)} AS DOUBLE) / ({count}))"


_GAPPY = ["size", "price", "brand", "chars"]


def _impute_check(column: str) -> str:
    return f"""{column}_fill AS (
        SELECT id, avg(value) AS fill FROM (
            SELECT q.id AS id, t.{column} AS value, row_number() OVER (PARTITION BY q.id
                   ORDER BY {_gap_distance(_GAPPY)}, t.id) AS place
            FROM g q, g t WHERE q.{column} IS NULL AND t.{column} IS NOT NULL)
        WHERE place <= 5 GROUP BY id)"""


@query(
    "knn_impute",
    f"""WITH g AS (SELECT p_partkey AS id,
                     CASE WHEN p_type <> 'PROMO' THEN CAST(p_size AS DOUBLE) END AS size,
                     CASE WHEN p_brand <> 'Brand#7' THEN p_retailprice END AS price,
                     CAST(regexp_extract(p_brand, '\\d+') AS DOUBLE) AS brand,
                     CAST(length(p_name) AS DOUBLE) AS chars FROM part),
             {_impute_check('size')}, {_impute_check('price')}
        SELECT g.id, {_r('COALESCE(size, size_fill.fill)', 6)} AS size,
               {_r('COALESCE(price, price_fill.fill)', 6)} AS price
        FROM g LEFT JOIN size_fill ON g.id = size_fill.id
               LEFT JOIN price_fill ON g.id = price_fill.id""",
)
def knn_impute(spark, d):
    """Sizes of one type and prices of one brand are gaps; some parts lack both."""
    gaps = table(spark, d, "part").select(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_type") != "PROMO", F.col("p_size").cast("double")).alias("size"),
        F.when(F.col("p_brand") != "Brand#7", F.col("p_retailprice")).alias("price"),
        F.regexp_extract("p_brand", r"\d+", 0).cast("double").alias("brand"),
        F.length("p_name").cast("double").alias("chars"),
    )
    filled = neighbors.knn_impute(gaps, "id", _GAPPY, k=5)
    return filled.select(
        "id", round_half_up("size", 6).alias("size"), round_half_up("price", 6).alias("price")
    )


# -- windows ---------------------------------------------------------------------------------

PAST, HORIZON, TEST_SHARE = 5, 2, 0.18


def event_windows(spark, d):
    """Windows over the values of all events in time order, split by position first."""
    events = table(spark, d, "events").select("ts", "event_id", "value")
    events = timeseries.add_season(events, "ts")
    order = ["ts", "event_id"]
    marked = splits.tail_split(events, order, TEST_SHARE, ("train", "test"), number="place")
    return timeseries.create_windows(
        marked, PAST, HORIZON, ["value", "portion_year"], "value", order, part="part", number="place"
    )


_SERIES = f"""e AS (SELECT ts, event_id, value, CAST(dayofyear(ts) AS DOUBLE) / 365.0::DOUBLE AS season,
                    CASE WHEN row_number() OVER (ORDER BY ts, event_id)
                              <= floor(count(*) OVER () * {1.0 - TEST_SHARE}::DOUBLE)
                    THEN 'train' ELSE 'test' END AS part FROM events),
    w AS (SELECT part, row_number() OVER o - 1 AS window_no,
          {', '.join(f"lead(value, {i}) OVER o AS x_value_{i}" for i in range(PAST))},
          {', '.join(f"lead(season, {i}) OVER o AS x_season_{i}" for i in range(PAST))},
          lead(value, {PAST + HORIZON - 1}) OVER o AS y
          FROM e WINDOW o AS (PARTITION BY part ORDER BY ts, event_id))"""


@query(
    "create_windows",
    f"""WITH {_SERIES} SELECT part, window_no,
        {', '.join(f'x_value_{i}' for i in range(PAST))}, y FROM w WHERE y IS NOT NULL""",
)
def create_windows(spark, d):
    windows = event_windows(spark, d)
    cols = [F.col("x_value")[i].alias(f"x_value_{i}") for i in range(PAST)]
    return windows.select("part", "window_no", *cols, "y")


@query(
    "windows_multivariate",
    f"""WITH {_SERIES} SELECT part, window_no,
        {', '.join(f'x_value_{i}, x_season_{i}' for i in range(PAST))}, y
        FROM w WHERE y IS NOT NULL""",
)
def windows_multivariate(spark, d):
    windows = event_windows(spark, d)
    cols = [
        F.col(f"x_{name}")[i].alias(f"x_{out}_{i}")
        for i in range(PAST)
        for name, out in (("value", "value"), ("portion_year", "season"))
    ]
    return windows.select("part", "window_no", *cols, "y")


@query(
    "windows_daily",
    """WITH e AS (SELECT CAST(ts AS DATE) AS day, avg(value) AS v FROM events GROUP BY 1)
       SELECT window_no, y FROM (
         SELECT row_number() OVER (ORDER BY day) - 1 AS window_no,
                CAST(round(CAST(lead(v, 6) OVER (ORDER BY day) AS DECIMAL(38,10)), 4) AS DOUBLE) AS y
         FROM e) WHERE y IS NOT NULL""",
)
def windows_daily(spark, d):
    daily = table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(
        F.avg("value").alias("v")
    )
    windows = timeseries.create_windows(daily, PAST, HORIZON, ["v"], "v", ["day"])
    return windows.select("window_no", round_half_up("y", 4).alias("y"))


@query(
    "persistence_mse",
    f"""WITH {_SERIES} SELECT {_r(f'avg((y - x_value_{PAST - 1}) * (y - x_value_{PAST - 1}))', 4)} AS mse,
        {_r(f'avg(abs(y - x_value_{PAST - 1}))', 4)} AS mae
        FROM w WHERE y IS NOT NULL AND part = 'test'""",
)
def persistence_mse(spark, d):
    test = event_windows(spark, d).where("part = 'test'")
    errors = regression_error(timeseries.persistence(test, PAST, "value"), "y", "prediction")
    return errors.select(*[round_half_up(c, 4).alias(c) for c in ("mse", "mae")])

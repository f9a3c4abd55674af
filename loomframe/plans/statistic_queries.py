"""Descriptive statistics and the numbers behind charts."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe.functions.scalar import round_half_up
from loomframe.operators import gram, statistics as st
from loomframe.plans.registry import query
from loomframe.sources.tables import table


def _rounded(df, digits: int, *cols: str):
    return df.withColumns({c: round_half_up(c, digits) for c in cols})


def _r(expr: str, digits: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def _describe_one(source: str, c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return f"""SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS n_known,
        {_r(f'avg({x})', 4)} AS mean, {_r(f'stddev_samp({x})', 4)} AS std, min({x}) AS min,
        {_r(f'quantile_cont({x}, 0.25)', 6)} AS q25, {_r(f'quantile_cont({x}, 0.5)', 6)} AS q50,
        {_r(f'quantile_cont({x}, 0.75)', 6)} AS q75, max({x}) AS max FROM {source}"""


_MEASURES = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax",
]


@query("describe", " UNION ALL ".join(_describe_one("lineitem", c) for c in _MEASURES))
def describe(spark, d):
    stats = st.describe(table(spark, d, "lineitem"), _MEASURES)
    return _rounded(_rounded(stats, 4, "mean", "std"), 6, "q25", "q50", "q75")


@query(
    "describe_nan",
    _describe_one("(SELECT nullif(l_quantity, 1) AS l_quantity FROM lineitem)", "l_quantity"),
)
def describe_nan(spark, d):
    """NaN counts as missing in every figure."""
    x = F.when(F.col("l_quantity") == 1, float("nan")).otherwise(F.col("l_quantity"))
    stats = st.describe(table(spark, d, "lineitem").select(x.alias("l_quantity")), ["l_quantity"])
    return _rounded(_rounded(stats, 4, "mean", "std"), 6, "q25", "q50", "q75")


_ORDER_COLS = [
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
]


@query(
    "nunique",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct FROM orders"""
        for c in _ORDER_COLS
    ),
)
def nunique(spark, d):
    return st.nunique(table(spark, d, "orders"), _ORDER_COLS)


_EXACT = ("o_orderstatus", "o_orderpriority")  # few values: the sketch still holds each of them


@query(
    "nunique_approx",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", TRUE AS near,
            {f"(SELECT count(DISTINCT {c}) FROM orders)" if c in _EXACT else "CAST(NULL AS BIGINT)"} AS n_few"""
        for c in _ORDER_COLS
    ),
)
def nunique_approx(spark, d):
    """Sketches of two parts of the orders, merged: within three per cent of the exact numbers."""
    orders = table(spark, d, "orders")
    half = F.col("o_orderkey") % 2 == 0
    sketches = [st.distinct_sketches(orders.where(part), _ORDER_COLS) for part in (half, ~half)]
    found = st.nunique_approx(st.merge_sketches(*sketches))
    exact = st.nunique(orders, _ORDER_COLS).withColumnRenamed("n_distinct", "n_exact")
    off = F.abs(F.col("n_distinct") - F.col("n_exact"))
    few = F.when(F.col("column").isin(*_EXACT), F.col("n_distinct"))
    return found.join(exact, "column").select("column", (off <= 0.03 * F.col("n_exact")).alias("near"), few.alias("n_few"))


@query(
    "missing_counts",
    """SELECT unnest(['doc_id', 'text', 'lang', 'source', 'n_chars']) AS "column",
              unnest([count(*) - count(doc_id), count(*) - count(text), count(*) - count(nullif(lang, 'en')),
                      count(*) - count(source), count(*) - count(n_chars)]) AS n_missing
       FROM documents""",
)
def missing_counts(spark, d):
    gaps = table(spark, d, "documents").withColumn("lang", F.nullif("lang", F.lit("en")))
    return st.missing_counts(gaps, gaps.columns)


@query(
    "missing_nan",
    """SELECT 'l_quantity' AS "column", CAST(count(*) FILTER (l_quantity = 1) AS BIGINT) AS n_missing
       FROM lineitem UNION ALL SELECT 'l_tax', count(*) FILTER (l_tax = 0) FROM lineitem
       UNION ALL SELECT 'l_linenumber', 0""",
)
def missing_nan(spark, d):
    """NaN and NULL are both missing."""
    gaps = table(spark, d, "lineitem").select(
        F.when(F.col("l_quantity") == 1, float("nan")).otherwise(F.col("l_quantity")).alias("l_quantity"),
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
        "l_linenumber",
    )
    return st.missing_counts(gaps, ["l_quantity", "l_tax", "l_linenumber"])


_WIDE = 8  # further columns made of each of the first ones


def _widened(c: str, i: int) -> str:
    return f"CASE WHEN l_orderkey % {i + 7} <> {i} THEN {c} * (1 + (l_orderkey * {i + 3} + l_linenumber) % {2 * i + 5}) END"


@query(
    "corr_wide",
    "WITH w AS (SELECT "
    + ", ".join(f"{_widened(c, i)} AS {c[2:5]}{i}" for c in ("l_quantity", "l_discount") for i in range(_WIDE))
    + " FROM lineitem) "
    + " UNION ALL ".join(
        f"""SELECT '{a}' AS a, '{b}' AS b, CAST(round(CAST(corr({a}, {b}) AS DECIMAL(38,10)), 6) AS DOUBLE) AS corr,
            CAST(count(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN 1 END) AS BIGINT) AS n FROM w"""
        for a in [f"{c}{i}" for c in ("qua", "dis") for i in range(_WIDE)]
        for b in [f"{c}{i}" for c in ("qua", "dis") for i in range(_WIDE)]
        if a < b
    ),
)
def corr_wide(spark, d):
    """Correlations of many columns with gaps, from one matrix of sums."""
    lines = table(spark, d, "lineitem")
    wide = lines.select(
        *[F.expr(_widened(c, i)).alias(f"{c[2:5]}{i}") for c in ("l_quantity", "l_discount") for i in range(_WIDE)]
    )
    found = gram.corr_pairs(wide, wide.columns).where("a < b")
    return found.select("a", "b", round_half_up("corr", 6).alias("corr"), "n")


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _corr_cell(a: str, b: str) -> str:
    if a == b:
        return f"SELECT '{a}' AS a, '{b}' AS b, CAST(1 AS DOUBLE) AS corr"
    return f"SELECT '{a}' AS a, '{b}' AS b, {_r(f'corr({a}, {b})', 6)} AS corr FROM lineitem"


@query("corr_matrix", " UNION ALL ".join(_corr_cell(a, b) for a in _CORR for b in _CORR))
def corr_matrix(spark, d):
    return _rounded(st.corr_matrix(table(spark, d, "lineitem"), _CORR), 6, "corr")


def _with_volume(spark, d):
    """A column that depends strongly on another one."""
    lines = table(spark, d, "lineitem").select("l_quantity", "l_extendedprice", "l_tax")
    return lines.withColumn("volume", F.col("l_quantity") * 2 + F.col("l_tax"))


@query(
    "high_corr_pairs",
    f"""WITH x AS (SELECT *, l_quantity * 2 + l_tax AS volume FROM lineitem)
        SELECT 'l_quantity' AS a, 'volume' AS b, {_r('corr(l_quantity, volume)', 6)} AS corr
        FROM x""",
)
def high_corr_pairs(spark, d):
    cols = ["l_quantity", "l_extendedprice", "l_tax", "volume"]
    return _rounded(st.high_corr_pairs(_with_volume(spark, d), cols, 0.9), 6, "corr")


@query(
    "drop_correlated",
    "SELECT l_quantity, l_extendedprice, l_tax FROM lineitem",
)
def drop_correlated(spark, d):
    cols = ["l_quantity", "l_extendedprice", "l_tax", "volume"]
    return st.drop_correlated(_with_volume(spark, d), cols, 0.9)


@query(
    "histogram",
    """SELECT CAST(b AS INTEGER) AS bin, CAST(count(p_partkey) AS BIGINT) AS n_rows
       FROM range(1, 49) t(b) LEFT JOIN part
            ON (p_size = b OR (b = 48 AND p_size = 49)) GROUP BY b""",
)
def histogram(spark, d):
    return st.histogram(table(spark, d, "part"), "p_size", 1, 50)


@query(
    "histogram_full",
    """SELECT CAST(b AS INTEGER) AS bin, CAST(count(p_partkey) AS BIGINT) AS n_rows
       FROM range(1, 51) t(b) LEFT JOIN part ON p_size = b GROUP BY b""",
)
def histogram_full(spark, d):
    return st.histogram(table(spark, d, "part"), "p_size", 1, 50, full_range=True)


@query(
    "box_stats",
    """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q25,
                  quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.75) AS q75
                  FROM events GROUP BY event_type),
            x AS (SELECT *, value BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25) AS ok
                  FROM events JOIN q USING (event_type))
       SELECT event_type, CAST(round(CAST(any_value(q25) AS DECIMAL(38,10)), 6) AS DOUBLE) AS q25,
              CAST(round(CAST(any_value(q50) AS DECIMAL(38,10)), 6) AS DOUBLE) AS q50,
              CAST(round(CAST(any_value(q75) AS DECIMAL(38,10)), 6) AS DOUBLE) AS q75,
              min(value) FILTER (ok) AS whisker_lo, max(value) FILTER (ok) AS whisker_hi,
              CAST(count(*) FILTER (NOT ok) AS BIGINT) AS n_fliers FROM x GROUP BY event_type""",
)
def box_stats(spark, d):
    boxes = st.box_stats(table(spark, d, "events"), "event_type", "value")
    return _rounded(boxes, 6, "q25", "q50", "q75")


@query(
    "count_all_columns",
    """SELECT 'l_returnflag' AS "column", l_returnflag AS value, CAST(count(*) AS BIGINT) AS n_rows
       FROM lineitem GROUP BY l_returnflag UNION ALL
       SELECT 'l_linestatus', l_linestatus, count(*) FROM lineitem GROUP BY l_linestatus UNION ALL
       SELECT 'l_linenumber', CAST(l_linenumber AS VARCHAR), count(*) FROM lineitem
       GROUP BY l_linenumber""",
)
def count_all_columns(spark, d):
    return st.count_all_columns(
        table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"]
    )


@query(
    "scatter_points",
    f"""SELECT CAST(p_size AS DOUBLE) AS x, {_r('avg(p_retailprice)', 2)} AS y FROM part
        WHERE p_size <> 7 GROUP BY p_size""",
)
def scatter_points(spark, d):
    return st.series_points(table(spark, d, "part"), "p_size", "p_retailprice", unknown="7")

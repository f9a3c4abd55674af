"""Filters and predicates."""

from __future__ import annotations

import operator

from pyspark.sql import functions as F

from loomframe.operators import aggregates, filters
from loomframe.operators.statistics import drop_outliers, iqr_outliers
from loomframe.plans.registry import query
from loomframe.sources.tables import table

_WORDS = "string_split(p_name, ' ')"


def part_words(spark, d):
    return table(spark, d, "part").select("p_partkey", "p_type", F.split("p_name", " ").alias("words"))


@query("where_equals", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'")
def where_equals(spark, d):
    return filters.where_equals(
        table(spark, d, "orders"), "o_orderpriority", "1-URGENT", ["o_orderkey", "o_totalprice"]
    )


@query(
    "where_contains",
    """SELECT p_name, TRY_CAST(regexp_extract(p_brand, '\\d+') AS BIGINT) AS brand_no
       FROM part WHERE contains(p_name, 'ring')""",
)
def where_contains(spark, d):
    number = F.regexp_extract("p_brand", r"\d+", 0).try_cast("bigint").alias("brand_no")
    return filters.where_contains(table(spark, d, "part"), "p_name", "ring").select("p_name", number)


@query(
    "count_in_range",
    """SELECT CAST(count(*) AS BIGINT) AS n_rows FROM orders
       WHERE year(o_orderdate) BETWEEN 1996 AND 1998""",
)
def count_in_range(spark, d):
    return aggregates.count_rows(
        filters.where_between(table(spark, d, "orders"), F.year("o_orderdate"), 1996, 1998)
    )


@query(
    "where_not",
    "SELECT event_id FROM events WHERE NULLIF(event_type, 'click') IS DISTINCT FROM 'view'",
)
def where_not(spark, d):
    gaps = table(spark, d, "events").select(
        "event_id", F.nullif("event_type", F.lit("click")).alias("event_type")
    )
    return filters.where_not(gaps, "event_type", "view").select("event_id")


@query(
    "where_none",
    f"""SELECT p_partkey FROM part
        WHERE NULLIF(p_type, 'PROMO') IS DISTINCT FROM 'SMALL'
          AND NOT list_contains({_WORDS}, 'red')""",
)
def where_none(spark, d):
    parts = part_words(spark, d).withColumn("p_type", F.nullif("p_type", F.lit("PROMO")))
    return filters.where_none(parts, {"p_type": "SMALL"}, {"words": "red"}).select("p_partkey")


@query(
    "where_known",
    """SELECT c_custkey FROM customer WHERE c_name <> '' AND c_mktsegment <> ''
       AND c_nationkey NOT IN (0, -1) AND c_acctbal NOT IN (0, -1)""",
)
def where_known(spark, d):
    return filters.where_known(
        table(spark, d, "customer"), ["c_name", "c_mktsegment"], ["c_nationkey", "c_acctbal"]
    ).select("c_custkey")


@query("where_present", "SELECT doc_id FROM documents WHERE NULLIF(lang, 'fr') IS NOT NULL")
def where_present(spark, d):
    gaps = table(spark, d, "documents").select("doc_id", F.nullif("lang", F.lit("fr")).alias("lang"))
    return filters.where_present(gaps, ["lang"]).select("doc_id")


@query(
    "above_average",
    """SELECT p_partkey, p_retailprice FROM part
       WHERE p_retailprice >= (SELECT avg(p_retailprice) FROM part)""",
)
def above_average(spark, d):
    return filters.where_vs_global(
        table(spark, d, "part").select("p_partkey", "p_retailprice"),
        "p_retailprice", operator.ge, F.avg,
    )


@query(
    "exclude_values",
    """SELECT p_partkey, p_size, (SELECT CAST(count(*) AS BIGINT) FROM part
              WHERE p_size IN (1, 50)) AS n_excluded FROM part WHERE p_size NOT IN (1, 50)""",
)
def exclude_values(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_size")
    excluded = part.select(F.count_if(F.col("p_size").isin(1, 50))).scalar()
    return filters.exclude_values(part, "p_size", [1, 50]).withColumn("n_excluded", excluded)


@query(
    "having_min",
    """SELECT o_custkey, CAST(count(*) AS BIGINT) AS n_rows FROM orders
       GROUP BY o_custkey HAVING count(*) >= 12""",
)
def having_min(spark, d):
    counts = aggregates.group_count(table(spark, d, "orders"), ["o_custkey"])
    return filters.having_min(counts, "n_rows", 12)


@query(
    "where_has",
    f"SELECT CAST(count(*) AS BIGINT) AS n_rows FROM part WHERE list_contains({_WORDS}, 'bolt')",
)
def where_has(spark, d):
    return aggregates.count_rows(filters.where_has(part_words(spark, d), "words", "bolt"))


@query(
    "where_empty",
    """SELECT p_partkey FROM part WHERE p_type <> 'PROMO' AND
       regexp_full_match(p_name, '(red|ring)( (red|ring))*')""",
)
def where_empty(spark, d):
    """Words are NULL for one type of part: those are not empty."""
    left = F.filter("words", lambda w: ~w.isin("red", "ring"))
    words = part_words(spark, d).withColumn(
        "words", F.when(F.col("p_type") != "PROMO", left)
    )
    return filters.where_empty(words, "words").select("p_partkey")


@query(
    "last_n_years",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
       WHERE year(o_orderdate) > (SELECT max(year(o_orderdate)) FROM orders) - 3""",
)
def last_n_years(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    return filters.where_last_n(orders, "year", 3)


def _bounds(column: str) -> str:
    q1, q3 = (f"quantile_cont({column}, {p})" for p in (0.25, 0.75))
    return f"{q1} - 1.5 * ({q3} - {q1}) AS lo, {q3} + 1.5 * ({q3} - {q1}) AS hi"


@query(
    "iqr_outliers",
    f"""WITH skewed AS (SELECT l_orderkey, l_linenumber,
                        l_extendedprice * l_quantity AS amount FROM lineitem),
             b AS (SELECT {_bounds('amount')} FROM skewed)
        SELECT l_orderkey, l_linenumber, amount FROM skewed, b WHERE amount < lo OR amount > hi""",
)
def outliers(spark, d):
    amount = (F.col("l_extendedprice") * F.col("l_quantity")).alias("amount")
    return iqr_outliers(
        table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", amount), "amount"
    )


@query(
    "drop_outliers",
    f"""WITH skewed AS (SELECT l_orderkey, l_linenumber, l_extendedprice * l_quantity AS amount,
                        l_quantity * l_quantity * l_quantity AS cube FROM lineitem),
             a AS (SELECT {_bounds('amount')} FROM skewed),
             c AS (SELECT {_bounds('cube')} FROM skewed)
        SELECT l_orderkey, l_linenumber, amount, "cube" FROM skewed, a, c
        WHERE amount BETWEEN a.lo AND a.hi AND "cube" BETWEEN c.lo AND c.hi""".replace(
        "AS cube", 'AS "cube"'
    ).replace("(cube,", '("cube",'),
)
def no_outliers(spark, d):
    q = F.col("l_quantity")
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") * q).alias("amount"),
        (q * q * q).alias("cube"),
    )
    return drop_outliers(rows, ["amount", "cube"])

"""Whole chains of operators: from raw rows to a report in one go."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from loomframe.functions.scalar import arrange_types, cents, clean_text, from_cents, parse_number
from loomframe.operators import aggregates, arrays, changes, encoding, filters, joins, sets, statistics
from loomframe.plans.registry import query
from loomframe.session import new_path
from loomframe.sources import delimited, documents
from loomframe.sources.tables import register_views, table

_URGENT = "o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"


@query(
    "profit_view_sql",
    f"""SELECT c_custkey, 100 * (SELECT count(*) FROM orders WHERE o_custkey = c_custkey)
               - CAST((SELECT sum(CAST(o_totalprice AS DECIMAL(10,2))) FROM orders
                  WHERE o_custkey = c_custkey AND {_URGENT}) AS DOUBLE) AS profit FROM customer""",
)
def profit_view_sql(spark, d):
    """Correlated subqueries in SQL text over the named tables."""
    register_views(spark, d)
    return spark.sql(
        f"""SELECT c_custkey, 100 * (SELECT count(*) FROM orders WHERE o_custkey = c_custkey)
                   - CAST((SELECT sum(CAST(o_totalprice AS DECIMAL(10,2))) FROM orders
                      WHERE o_custkey = c_custkey AND {_URGENT}) AS DOUBLE) AS profit
            FROM customer"""
    )


@query(
    "group_by_alias",
    """SELECT upper(c_mktsegment) AS segment, CAST(count(*) AS BIGINT) AS n_rows FROM customer
       GROUP BY segment ORDER BY n_rows DESC, segment""",
)
def group_by_alias(spark, d):
    register_views(spark, d, ["customer"])
    return spark.sql(
        """SELECT upper(c_mktsegment) AS segment, count(*) AS n_rows FROM customer
           GROUP BY segment ORDER BY n_rows DESC, segment"""
    )


@query(
    "lifecycle_profit",
    """WITH cost AS (SELECT o_orderkey, o_custkey,
                     COALESCE(sum(CAST(l_extendedprice AS DECIMAL(10,2))), 0) AS cost
                     FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R')
                     ON l_orderkey = o_orderkey GROUP BY ALL)
       SELECT c_custkey, CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN 60 ELSE 50 END
              * (SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
              - (SELECT sum(cost) FROM cost WHERE o_custkey = c_custkey)
              - CAST(c_acctbal AS DECIMAL(10,2)) AS DOUBLE) AS profit FROM customer""",
)
def lifecycle_profit(spark, d):
    """Costs derived per order, prices updated for one segment, then profit per customer."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    returned = table(spark, d, "lineitem").where("l_returnflag = 'R'")
    costs = changes.refresh_rollup(
        orders, returned, "o_orderkey", "l_orderkey", cents("l_extendedprice"), "cost"
    )
    customers = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    priced = changes.update_where(
        customers.withColumn("price", F.lit(50_00)), F.col("c_mktsegment") == "BUILDING",
        "price", F.lit(60_00),
    )
    view = joins.profit_view(
        priced, "c_custkey", orders.where("o_orderstatus = 'P'"), "o_custkey", costs, "o_custkey",
        cost=F.col("cost"), price=F.col("price"), rent=cents("c_acctbal"),
    )
    return view.select("c_custkey", from_cents("profit").alias("profit"))


@query(
    "lifecycle_documents",
    """WITH w AS (SELECT p_partkey, p_type, unnest(CASE WHEN p_name = 'red ring' THEN ['Undefined']
                  ELSE list_filter(string_split(p_name, ' '), lambda w: w NOT IN ('red', 'ring'))
                  END) AS word FROM part),
            s AS (SELECT word, count(DISTINCT p_type) AS n_distinct FROM w
                  WHERE word <> 'Undefined' GROUP BY word ORDER BY n_distinct DESC, word LIMIT 5)
       SELECT DISTINCT word, p_type, CAST(n_distinct AS BIGINT) AS n_distinct
       FROM w JOIN s USING (word)""",
)
def lifecycle_documents(spark, d):
    """Values pulled from arrays, empty arrays filled, unwound, stored, and ranked by variety."""
    parts = table(spark, d, "part").select("p_partkey", "p_type", F.split("p_name", " ").alias("word"))
    pulled = arrays.array_pull(arrays.array_pull(parts, "word", "red"), "word", "ring")
    filled = arrays.fill_empty_array(pulled, "word", "Undefined")
    stored = documents.materialize(arrays.unwind(filled, "word"), new_path(spark, "words"))
    known = filters.where_not(stored, "word", "Undefined")
    return aggregates.largest_sets(known, ["word"], "p_type", 5)


_LINE = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("year", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in ("language", "country")]
    + [T.StructField("budget", T.LongType())]
)


@query(
    "lifecycle_csv_rollup",
    """WITH k AS (SELECT o_orderpriority AS language, o_orderstatus AS country,
                  floor(o_totalprice) AS budget, row_number() OVER (
                    PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderkey) AS r FROM orders)
       SELECT language, string_agg(DISTINCT country, ',' ORDER BY country) AS members,
              CAST(sum(budget) AS BIGINT) AS total FROM k
       WHERE r = 1 AND budget <> 0 AND country <> 'P' GROUP BY language""",
)
def lifecycle_csv_rollup(spark, d):
    """CSV text, typed records, first record per key, delimited lines, then a keyed rollup."""
    orders = table(spark, d, "orders")
    raw = orders.select(
        F.col("o_orderkey").cast("string").alias("line"),
        F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" ")).alias("name"),
        F.year("o_orderdate").cast("string").alias("year"), F.col("o_orderpriority").alias("language"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("country"),
        F.floor("o_totalprice").cast("string").alias("budget"),
    )
    path = new_path(spark, "records")
    delimited.write_csv(raw, path)
    records = arrange_types(
        delimited.read_csv_raw(spark, path, raw.columns),
        {
            "line": parse_number("line"), "name": clean_text("name"), "year": parse_number("year"),
            "language": F.col("language"), "country": F.col("country"),
            "budget": parse_number("budget"),
        },
    )
    first = sets.keep_first(records, ["name", "year"], ["line"])
    lines = new_path(spark, "lines")
    delimited.write_delimited(first, lines, _LINE.names)
    good, _ = delimited.parse_lines(delimited.read_lines(spark, lines), "|", _LINE)
    known = filters.where_known(good, ["language", "country"], ["year", "budget"])
    listed = aggregates.list_and_sum(known, "language", "country", F.col("budget"))
    return listed.withColumn("members", F.concat_ws(",", "members"))


@query(
    "lifecycle_features",
    """WITH r AS (SELECT DISTINCT l_partkey, l_quantity, l_returnflag,
                  l_extendedprice * l_quantity AS amount FROM lineitem WHERE l_quantity <> 1),
            b AS (SELECT quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.75) AS q3 FROM r)
       SELECT l_partkey, l_quantity, amount,
              CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS "l_returnflag_N",
              CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS "l_returnflag_R"
       FROM r, b WHERE amount BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""",
)
def lifecycle_features(spark, d):
    """Duplicates, bad values and outliers out, then categories as indicators."""
    amount = (F.col("l_extendedprice") * F.col("l_quantity")).alias("amount")
    lines = table(spark, d, "lineitem").select("l_partkey", "l_quantity", "l_returnflag", amount)
    good = filters.exclude_values(lines, "l_quantity", [1.0])
    inside = statistics.drop_outliers(sets.dedupe(good), ["amount"])
    return encoding.dummies(inside, ["l_returnflag"])

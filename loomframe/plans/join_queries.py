"""Joins and subqueries."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe.functions.scalar import cents, coalesce_zero, from_cents, pct
from loomframe.operators import joins
from loomframe.operators.ordering import top_k
from loomframe.plans.registry import query
from loomframe.sources.tables import table


@query(
    "join_count_by_key",
    """SELECT n_name, CAST(count(*) AS BIGINT) AS n_customers FROM customer
       JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def join_count_by_key(spark, d):
    return joins.join_agg(
        table(spark, d, "customer"), table(spark, d, "nation"), "c_nationkey", "n_nationkey",
        ["n_name"], count="n_customers",
    )


@query(
    "join_sum_by_key",
    """SELECT c_name, CAST(sum(CAST(o_totalprice AS DECIMAL(10,2))) AS DOUBLE) AS earned
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_name""",
)
def join_sum_by_key(spark, d):
    sums = joins.join_agg(
        table(spark, d, "orders"), table(spark, d, "customer"), "o_custkey", "c_custkey",
        ["c_name"], sums={"earned": cents("o_totalprice")},
    )
    return sums.withColumn("earned", from_cents("earned"))


def _orders_of_nation(spark, d):
    """Customers of each nation joined to their order counts."""
    orders = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    customers = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    per_nation = (
        customers.join(orders, F.col("c_custkey") == F.col("o_custkey"))
        .groupBy("c_nationkey")
        .agg(F.sum("n").alias("n_orders"))
    )
    nations = table(spark, d, "nation")
    return per_nation.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(
        "n_name"
    ).agg(F.sum("n_orders").alias("n_orders"))


@query(
    "top3_by_children",
    """SELECT n_name, CAST(count(*) AS BIGINT) AS n_orders FROM nation
       JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey
       GROUP BY n_name ORDER BY n_orders DESC, n_name LIMIT 3""",
)
def top3_by_children(spark, d):
    return top_k(_orders_of_nation(spark, d), [F.desc("n_orders"), "n_name"], 3)


@query(
    "cost_by_parent",
    """SELECT c_mktsegment, c_name, CAST(sum(CAST(l_extendedprice AS DECIMAL(10,2))) AS DOUBLE)
              AS total_cost
       FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
       GROUP BY c_mktsegment, c_name ORDER BY total_cost DESC, c_name""",
)
def cost_by_parent(spark, d):
    """Amounts are folded per order, then per customer, so each join sees distinct keys."""
    per_order = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.sum(cents("l_extendedprice")).alias("amount")
    )
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    per_customer = (
        orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_custkey")
        .agg(F.sum("amount").alias("amount"))
    )
    customers = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    joined = customers.join(per_customer, F.col("c_custkey") == F.col("o_custkey"))
    totals = joined.groupBy("c_mktsegment", "c_name").agg(
        from_cents(F.sum("amount")).alias("total_cost")
    )
    return totals.orderBy(F.desc("total_cost"), "c_name")


@query(
    "occupancy_pct",
    """SELECT s_suppkey, p_size,
              CAST(round(CAST(count(*) * 100.0::DOUBLE / p_size AS DECIMAL(38,10)), 2) AS DOUBLE)
              AS occupancy
       FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       GROUP BY s_suppkey, p_size""",
)
def occupancy_pct(spark, d):
    lines = table(spark, d, "lineitem").groupBy("l_partkey", "l_suppkey").agg(
        F.count("*").alias("n")
    )
    part = table(spark, d, "part").select("p_partkey", "p_size")
    supplier = table(spark, d, "supplier").select("s_suppkey")
    sizes = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
    taken = (
        sizes.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_suppkey", "p_size")
        .agg(F.sum("n").alias("n"))
    )
    return taken.select("s_suppkey", "p_size", pct("n", "p_size").alias("occupancy"))


@query(
    "left_join_stats",
    """SELECT c_custkey, CAST(round(CAST(avg(o_totalprice) AS DECIMAL(38,10)), 4) AS DOUBLE)
              AS mean_price, CAST(count(o_orderkey) AS BIGINT) AS n_orders
       FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'
                                AND o_orderstatus = 'F') ON o_custkey = c_custkey
       GROUP BY c_custkey""",
)
def left_join_stats(spark, d):
    urgent = table(spark, d, "orders").where(
        (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    )
    stats = joins.left_join_stats(
        table(spark, d, "customer").select("c_custkey"), urgent, "c_custkey", "o_custkey",
        "o_totalprice", "mean_price", "n_orders",
    )
    mean = F.round(F.col("mean_price").cast("decimal(38,10)"), 4).cast("double")
    return stats.withColumn("mean_price", mean)


@query(
    "composite_join",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, n_lines FROM lineitem
       JOIN (SELECT l_partkey, l_suppkey, CAST(count(*) AS BIGINT) AS n_lines FROM lineitem
             GROUP BY l_partkey, l_suppkey) USING (l_partkey, l_suppkey)""",
)
def composite_join(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    pairs = lines.groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n_lines"))
    return joins.join_multi(lines, pairs, ["l_partkey", "l_suppkey"])


@query(
    "profit_view",
    """SELECT c_custkey, CAST(CAST(100 AS DECIMAL(10,2)) *
              (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) -
              (SELECT sum(CAST(o_totalprice AS DECIMAL(10,2))) FROM orders
               WHERE o_custkey = c_custkey AND o_orderstatus = 'F'
                 AND o_orderpriority = '1-URGENT')
              - CAST(c_acctbal AS DECIMAL(10,2)) AS DOUBLE) AS profit
       FROM customer""",
)
def profit_view(spark, d):
    """Orders stand for visits; urgent finished orders for activities with a cost."""
    orders = table(spark, d, "orders")
    costly = orders.where((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))
    view = joins.profit_view(
        table(spark, d, "customer").select("c_custkey", "c_acctbal"), "c_custkey",
        orders, "o_custkey", costly, "o_custkey",
        cost=cents("o_totalprice"), price=F.lit(100_00), rent=cents("c_acctbal"),
    )
    return view.select("c_custkey", from_cents("profit").alias("profit"))


@query(
    "dense_year_counts",
    """SELECT CAST(y AS INTEGER) AS year, CAST(count(o_orderkey) AS BIGINT) AS n_rows
       FROM range(1990, 2006) t(y) LEFT JOIN orders ON year(o_orderdate) = y GROUP BY y""",
)
def dense_year_counts(spark, d):
    return joins.count_per_year(table(spark, d, "orders"), F.year("o_orderdate"), 1990, 2005)


@query(
    "anti_by_key",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN
       (SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'O')""",
)
def anti_by_key(spark, d):
    low = table(spark, d, "orders").where(
        (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "O")
    )
    customers = table(spark, d, "customer").select("c_custkey", "c_name")
    return joins.anti_by_key(customers, low, "c_custkey", "o_custkey")


@query(
    "coalesce_zero",
    """SELECT c_custkey, COALESCE(n, 0) AS n_open FROM customer LEFT JOIN
       (SELECT o_custkey, CAST(count(*) AS BIGINT) AS n FROM orders WHERE o_orderstatus = 'O'
        AND o_orderpriority = '2-HIGH' GROUP BY o_custkey) ON o_custkey = c_custkey""",
)
def zero_for_missing(spark, d):
    high = table(spark, d, "orders").where(
        (F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "2-HIGH")
    )
    counts = high.groupBy("o_custkey").agg(F.count("*").alias("n"))
    customers = table(spark, d, "customer").select("c_custkey")
    joined = customers.join(counts, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("c_custkey", coalesce_zero("n").alias("n_open"))

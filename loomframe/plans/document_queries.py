"""Arrays and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe.operators import arrays, ordering
from loomframe.operators.aggregates import as_sets
from loomframe.plans.filter_queries import part_words
from loomframe.plans.registry import query
from loomframe.session import new_path
from loomframe.sources.documents import materialize
from loomframe.sources.tables import table


@query("unwind", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def unwind(spark, d):
    words = part_words(spark, d).select("p_partkey", "words")
    return arrays.unwind(words, "words", "word")


def _customer_documents(spark, d):
    """One document per customer: order priorities and order years seen, as arrays."""
    orders = table(spark, d, "orders").select(
        F.col("o_custkey").alias("custkey"), F.col("o_orderpriority").alias("priority"),
        F.year("o_orderdate").alias("year"),
    )
    priorities = as_sets(orders, ["custkey"], "priority").withColumnRenamed("members", "priority")
    years = as_sets(orders, ["custkey"], "year").withColumnRenamed("members", "year")
    return priorities.join(years, "custkey")


@query(
    "unwind_chain",
    """SELECT custkey, priority, CAST(year AS INTEGER) AS year
       FROM (SELECT DISTINCT o_custkey AS custkey, o_orderpriority AS priority FROM orders)
       JOIN (SELECT DISTINCT o_custkey AS custkey, year(o_orderdate) AS year FROM orders)
       USING (custkey)""",
)
def unwind_chain(spark, d):
    return arrays.unwind_chain(_customer_documents(spark, d), ["priority", "year"])


@query(
    "unwind_chain_stored",
    """SELECT priority, CAST(count(*) AS BIGINT) AS n_rows
       FROM (SELECT DISTINCT o_custkey AS custkey, o_orderpriority AS priority FROM orders)
       JOIN (SELECT DISTINCT o_custkey AS custkey, year(o_orderdate) AS year FROM orders)
       USING (custkey) GROUP BY priority""",
)
def unwind_chain_stored(spark, d):
    """Each step stored as its own collection, and the last one grouped."""
    first = arrays.unwind(_customer_documents(spark, d), "priority")
    first = materialize(first, new_path(spark, "first"))
    second = materialize(arrays.unwind(first, "year"), new_path(spark, "second"))
    return second.groupBy("priority").agg(F.count("*").alias("n_rows"))


@query(
    "array_pull",
    """SELECT p_partkey, array_to_string(list_filter(string_split(p_name, ' '),
              lambda w: w <> 'red'), ' ') AS words FROM part""",
)
def array_pull(spark, d):
    pulled = arrays.array_pull(part_words(spark, d), "words", "red")
    return pulled.select("p_partkey", F.concat_ws(" ", "words").alias("words"))


@query(
    "fill_empty_array",
    """SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN NULL
              WHEN regexp_full_match(p_name, '(red|ring)( (red|ring))*') THEN 'Undefined'
              ELSE array_to_string(list_filter(string_split(p_name, ' '),
                   lambda w: w NOT IN ('red', 'ring')), ' ') END AS words FROM part""",
)
def fill_empty_array(spark, d):
    """NULL arrays (one type of part) stay NULL."""
    words = part_words(spark, d)
    words = arrays.array_pull(arrays.array_pull(words, "words", "red"), "words", "ring")
    words = words.withColumn("words", F.when(F.col("p_type") != "PROMO", F.col("words")))
    filled = arrays.fill_empty_array(words, "words", "Undefined")
    joined = F.when(F.col("words").isNotNull(), F.concat_ws(" ", "words")).alias("words")
    return filled.select("p_partkey", joined)


@query(
    "push_records",
    """SELECT o_custkey, o_orderkey, o_orderpriority,
              CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INTEGER)
              AS place FROM orders""",
)
def push_records(spark, d):
    """Orders collected per customer, then unwound with their place in the array."""
    chunk = 10
    pushed = arrays.push_records(
        table(spark, d, "orders"), "o_custkey", ["o_orderkey", "o_orderpriority"],
        ["o_orderkey"], chunk=chunk,
    )
    flat = pushed.select("o_custkey", "part", F.posexplode("records").alias("pos", "r"))
    place = (F.col("part") * chunk + F.col("pos")).cast("int").alias("place")
    return flat.select("o_custkey", "r.o_orderkey", "r.o_orderpriority", place)


@query(
    "longest_array",
    """SELECT o_custkey AS custkey, CAST(count(*) AS INTEGER) AS n_items FROM
       (SELECT DISTINCT o_custkey, o_orderpriority, year(o_orderdate) AS y FROM orders)
       GROUP BY o_custkey ORDER BY n_items DESC, custkey LIMIT 1""",
)
def longest_array(spark, d):
    orders = table(spark, d, "orders")
    item = F.concat_ws("/", "o_orderpriority", F.year("o_orderdate").cast("string"))
    items = orders.select(F.col("o_custkey").alias("custkey"), item.alias("item"))
    documents = as_sets(items, ["custkey"], "item")
    return ordering.longest_array(documents, "members", ["custkey"]).select("custkey", "n_items")

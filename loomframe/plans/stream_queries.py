"""Streams over staged parts of the tables, against SQL over the whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe.plans.registry import query
from loomframe.session import new_path
from loomframe.sources.tables import table
from loomframe.streaming import triggers

_PARTS = 3


def _in_batches(orders, run) -> None:
    """Write ``orders`` part by part in the order of their keys, and run the stream after each."""
    source = new_path(orders.sparkSession, "source")
    last = orders.agg(F.max("o_orderkey")).first()[0] or 0
    step = last // _PARTS + 1
    for part in range(_PARTS):
        new = orders.where(F.col("o_orderkey").between(part * step, (part + 1) * step - 1))
        new.write.mode("append").parquet(source)
        run(orders.sparkSession.readStream.schema(orders.schema).parquet(source)).awaitTermination()


@query(
    "stream_rollup",
    """SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total
       FROM orders GROUP BY o_custkey""",
)
def stream_rollup(spark, d):
    """Totals per customer after three batches of orders, from Spark's state."""
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(12,2)").alias("price")
    )
    root, checkpoint = new_path(spark, "rollup"), new_path(spark, "checkpoint")
    _in_batches(orders, lambda s: triggers.rollup_batches(s, "o_custkey", F.col("price"), root, checkpoint))
    kind = orders.schema["o_custkey"].dataType.simpleString()
    found = triggers.totals(spark, root, "o_custkey", kind)
    return found.select("o_custkey", F.col("total").cast("double").alias("total"))


@query(
    "stream_admission",
    """SELECT o_orderkey, o_custkey, CAST(most IS NULL OR row_number() OVER
              (PARTITION BY o_custkey ORDER BY o_orderkey) <= most AS INTEGER) AS accepted
       FROM orders LEFT JOIN (SELECT c_custkey, nullif(c_custkey % 6, 5) AS most FROM customer WHERE c_custkey % 11 > 0)
       ON o_custkey = c_custkey""",
)
def stream_admission(spark, d):
    """Orders admitted in three batches, up to a limit per customer that counts earlier batches."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    capacity = table(spark, d, "customer").where("c_custkey % 11 > 0").select(
        F.col("c_custkey").alias("o_custkey"), F.expr("nullif(c_custkey % 6, 5)").alias("most")
    )
    root, checkpoint = new_path(spark, "admitted"), new_path(spark, "checkpoint")
    _in_batches(
        orders,
        lambda s: triggers.admission_batches(s, capacity, "o_custkey", "most", ["o_orderkey"], root, checkpoint),
    )
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in orders.schema)
    return triggers.stored(spark, root, f"{kinds}, accepted int").drop("batch")

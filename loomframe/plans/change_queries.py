"""Data changes and integrity reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from loomframe.functions.scalar import cents, from_cents, with_default
from loomframe.operators import changes, integrity
from loomframe.operators.changes import ForeignKey
from loomframe.plans.registry import query
from loomframe.sources.tables import table


@query(
    "append_rows",
    """SELECT c_custkey, c_name FROM customer UNION ALL
       SELECT (SELECT max(c_custkey) FROM customer)
              + row_number() OVER (ORDER BY s_suppkey), s_name FROM supplier""",
)
def append_rows(spark, d):
    """Suppliers become customers and get the next keys."""
    customers = table(spark, d, "customer").select("c_custkey", "c_name")
    suppliers = table(spark, d, "supplier").select(F.col("s_name").alias("c_name"))
    return changes.append_rows(customers, suppliers, "c_custkey", ["c_name"])


@query(
    "update_where",
    """SELECT s_suppkey, s_name, s_nationkey, CASE WHEN s_acctbal < 0 THEN 0 ELSE s_acctbal END
              AS s_acctbal FROM supplier""",
)
def update_where(spark, d):
    return changes.update_where(
        table(spark, d, "supplier"), F.col("s_acctbal") < 0, "s_acctbal", F.lit(0.0)
    )


@query(
    "delete_one",
    """SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey <>
       (SELECT min(o_orderkey) FROM orders WHERE o_orderstatus = 'P')""",
)
def delete_one(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return changes.delete_one(orders, F.col("o_orderstatus") == "P", ["o_orderkey"])


@query(
    "delete_where",
    "SELECT event_id FROM events WHERE NULLIF(event_type, 'view') IS DISTINCT FROM 'error'",
)
def delete_where(spark, d):
    events = table(spark, d, "events").select(
        "event_id", F.nullif("event_type", F.lit("view")).alias("event_type")
    )
    return changes.delete_where(events, F.col("event_type") == "error").select("event_id")


_ROLLUP = """SELECT p_partkey, CAST(COALESCE(sum(CAST(l_extendedprice AS DECIMAL(10,2))), 0) AS DOUBLE)
       AS cost FROM part LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R'
       AND l_quantity > 40) ON l_partkey = p_partkey GROUP BY p_partkey"""


def _costly_lines(spark, d):
    return table(spark, d, "lineitem").where("l_returnflag = 'R' AND l_quantity > 40")


def _as_double(df: DataFrame) -> DataFrame:
    return df.withColumn("cost", from_cents("cost"))


@query("refresh_rollup", _ROLLUP)
def refresh_rollup(spark, d):
    parts = table(spark, d, "part").select("p_partkey")
    return _as_double(
        changes.refresh_rollup(
            parts, _costly_lines(spark, d), "p_partkey", "l_partkey", cents("l_extendedprice"), "cost"
        )
    )


@query("refresh_rollup_changed", _ROLLUP)
def refresh_rollup_changed(spark, d):
    """Lines with status O arrive after the first totals; only their parts are recomputed."""
    parts, lines = table(spark, d, "part").select("p_partkey"), _costly_lines(spark, d)
    old, new = lines.where("l_linestatus <> 'O'"), lines.where("l_linestatus = 'O'")
    amount = cents("l_extendedprice")
    first = changes.refresh_rollup(parts, old, "p_partkey", "l_partkey", amount, "cost")
    return _as_double(
        changes.refresh_rollup(
            first, lines, "p_partkey", "l_partkey", amount, "cost", new.select("l_partkey")
        )
    )


@query(
    "admit_until_full",
    """WITH a AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id
                  ORDER BY ts, event_id) AS arrival_no FROM events),
            r AS (SELECT user_id, max(value) AS best FROM events GROUP BY user_id)
       SELECT event_id, user_id, arrival_no, CASE WHEN best >= 300 OR arrival_no <= 50
              THEN 1 ELSE 0 END AS accepted FROM a JOIN r USING (user_id)""",
)
def admit_until_full(spark, d):
    """Every user has room for 50 events; users with a high value have no limit."""
    events = table(spark, d, "events").select("event_id", "user_id", "ts")
    limit = F.when(F.max("value") < 300, F.lit(50)).alias("capacity")
    rooms = table(spark, d, "events").groupBy("user_id").agg(limit)
    judged = changes.judge_arrivals(events, rooms, "user_id", "capacity", ["ts", "event_id"])
    return judged.drop("ts")


@query(
    "admit_with_taken",
    """WITH a AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id
                  ORDER BY ts, event_id) AS n FROM events WHERE event_type <> 'signup'),
            t AS (SELECT user_id, count(*) AS taken FROM events WHERE event_type = 'signup'
                  GROUP BY user_id)
       SELECT event_id, user_id FROM a LEFT JOIN t USING (user_id)
       WHERE n <= 40 - COALESCE(taken, 0)""",
)
def admit_with_taken(spark, d):
    """Signups hold their places before any other event arrives."""
    events = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    rooms = events.select("user_id").distinct().withColumn("capacity", F.lit(40))
    taken = changes.taken_places(events.where("event_type = 'signup'"), "user_id")
    arrivals = events.where("event_type <> 'signup'")
    result = changes.admit_until_full(
        arrivals, rooms, "user_id", "capacity", ["ts", "event_id"], taken
    )
    return result.accepted.select("event_id", "user_id")


_LINKS = [
    ForeignKey("orders", "o_custkey", "customer", "c_custkey"),
    ForeignKey("lineitem", "l_orderkey", "orders", "o_orderkey"),
]


@query(
    "cascade_delete",
    """SELECT 'customer' AS name, CAST(count(*) AS BIGINT) AS n_rows FROM customer
       WHERE c_mktsegment <> 'BUILDING'
       UNION ALL SELECT 'orders', count(*) FROM orders JOIN customer ON o_custkey = c_custkey
       WHERE c_mktsegment <> 'BUILDING'
       UNION ALL SELECT 'lineitem', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment <> 'BUILDING'""",
)
def cascade_delete(spark, d):
    tables = {n: table(spark, d, n) for n in ("customer", "orders", "lineitem")}
    doomed = tables["customer"].where("c_mktsegment = 'BUILDING'").select("c_custkey")
    left = changes.cascade_delete(tables, _LINKS, "customer", doomed, "c_custkey")
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("name"), "n_rows")
        for name, df in left.items()
    ]
    return reduce(DataFrame.unionByName, counts)


_TREE = """WITH RECURSIVE c AS (SELECT *, nullif(c_custkey // 3, 0) AS boss FROM customer),
    gone AS (SELECT c_custkey FROM c WHERE c_custkey IN (2, 31)
             UNION SELECT c.c_custkey FROM c JOIN gone ON c.boss = gone.c_custkey)"""


@query(
    "cascade_delete_tree",
    f"""{_TREE} SELECT 'customer' AS name, count(*) AS n_rows, sum(c_custkey)::BIGINT AS total FROM c
        WHERE c_custkey NOT IN (SELECT c_custkey FROM gone)
        UNION ALL SELECT 'orders', count(*), sum(o_orderkey)::BIGINT FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM gone)""",
)
def cascade_delete_tree(spark, d):
    """Customers below a deleted one go, on every level, and the orders of all of them."""
    boss = F.expr("nullif(c_custkey div 3, 0)").cast("bigint")
    tables = {"customer": table(spark, d, "customer").withColumn("boss", boss), "orders": table(spark, d, "orders")}
    links = [
        changes.ForeignKey("customer", "boss", "customer", "c_custkey"),
        changes.ForeignKey("orders", "o_custkey", "customer", "c_custkey"),
    ]
    doomed = tables["customer"].where("c_custkey IN (2, 31)").select("c_custkey")
    left = changes.cascade_delete(tables, links, "customer", doomed, "c_custkey")
    counts = [
        left[name].agg(F.count("*").alias("n_rows"), F.sum(key).cast("bigint").alias("total")).select(
            F.lit(name).alias("name"), "n_rows", "total"
        )
        for name, key in (("customer", "c_custkey"), ("orders", "o_orderkey"))
    ]
    return reduce(DataFrame.unionByName, counts)


@query(
    "set_null_delete",
    """SELECT c_custkey, CASE WHEN n_regionkey <> 1 THEN c_nationkey END AS c_nationkey
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def set_null_delete(spark, d):
    tables = {n: table(spark, d, n) for n in ("nation", "customer")}
    link = ForeignKey("customer", "c_nationkey", "nation", "n_nationkey", "set null")
    doomed = tables["nation"].where("n_regionkey = 1").select("n_nationkey")
    left = changes.cascade_delete(tables, [link], "nation", doomed, "n_nationkey")
    return left["customer"].select("c_custkey", "c_nationkey")


_TWO_PATHS = [
    ForeignKey("supplier", "s_nationkey", "nation", "n_nationkey"),
    ForeignKey("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ForeignKey("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ForeignKey("orders", "o_custkey", "customer", "c_custkey"),
    ForeignKey("customer", "c_nationkey", "nation", "n_nationkey"),
]


@query(
    "cascade_two_paths",
    """SELECT l_orderkey, l_linenumber, l_suppkey, CAST(count(*) AS BIGINT) AS n_rows FROM lineitem
       JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey
       WHERE s_nationkey <> 3 AND c_nationkey <> 3 GROUP BY ALL""",
)
def cascade_two_paths(spark, d):
    """Lines hang on a nation through their supplier and through their customer."""
    tables = {n: table(spark, d, n) for n in ("nation", "supplier", "customer", "orders", "lineitem")}
    doomed = tables["nation"].where("n_nationkey = 3").select("n_nationkey")
    left = changes.cascade_delete(tables, _TWO_PATHS, "nation", doomed, "n_nationkey")["lineitem"]
    return left.groupBy("l_orderkey", "l_linenumber", "l_suppkey").agg(F.count("*").alias("n_rows"))


@query(
    "cascade_composite",
    """SELECT e.event_id, CASE WHEN u.event_type IS NULL THEN e.user_id END AS user_id,
              CASE WHEN u.event_type IS NULL THEN e.event_type END AS event_type
       FROM events e LEFT JOIN (SELECT DISTINCT user_id, event_type FROM events WHERE user_id % 10 = 3) u
       ON e.user_id = u.user_id AND e.event_type = u.event_type""",
)
def cascade_composite(spark, d):
    """A key of two columns; rows that refer to a deleted one lose both."""
    events = table(spark, d, "events").select("event_id", "user_id", "event_type")
    tables = {"pair": events.select("user_id", "event_type").distinct(), "event": events}
    both = ["user_id", "event_type"]
    doomed = tables["pair"].where("user_id % 10 = 3")
    link = ForeignKey("event", both, "pair", both, "set null")
    return changes.cascade_delete(tables, [link], "pair", doomed, both)["event"]


@query(
    "cascade_update",
    """SELECT o_orderkey, c_custkey + CASE WHEN c_nationkey = 4 THEN 1000000 ELSE 0 END AS o_custkey,
              l.n AS n_lines
       FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN (SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1) l
       ON l_orderkey = o_orderkey""",
)
def cascade_update(spark, d):
    """New keys for the customers of one nation reach their orders, and lines by (customer, order)."""
    lines = table(spark, d, "lineitem").join(
        table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("l_custkey")),
        "l_orderkey",
    )
    tables = {
        "customer": table(spark, d, "customer").select("c_custkey", "c_nationkey"),
        "orders": table(spark, d, "orders").select("o_orderkey", "o_custkey"),
        "lineitem": lines.select("l_orderkey", "l_custkey"),
    }
    links = [
        ForeignKey("orders", "o_custkey", "customer", "c_custkey"),
        ForeignKey("lineitem", ["l_custkey", "l_orderkey"], "orders", ["o_custkey", "o_orderkey"]),
    ]
    moved = tables["customer"].where("c_nationkey = 4").select(
        "c_custkey", (F.col("c_custkey") + 1_000_000).alias("new")
    )
    out = changes.cascade_update(tables, links, "customer", moved, "c_custkey")
    counts = out["lineitem"].groupBy("l_custkey", "l_orderkey").agg(F.count("*").alias("n_lines"))
    same = [F.col("o_custkey") == F.col("l_custkey"), F.col("o_orderkey") == F.col("l_orderkey")]
    return out["orders"].join(counts, same).select("o_orderkey", "o_custkey", "n_lines")


@query(
    "check_pk",
    """SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n_rows FROM lineitem
       GROUP BY ALL HAVING count(*) > 1""",
)
def check_pk(spark, d):
    return integrity.check_pk(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "check_fk",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN
       (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')""",
)
def check_fk(spark, d):
    parents = table(spark, d, "customer").where("c_mktsegment <> 'BUILDING'")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return integrity.check_fk(orders, parents, ["o_custkey"], ["c_custkey"])


@query(
    "check_fk_composite",
    """SELECT CAST(count(*) AS BIGINT) AS n_rows FROM lineitem l WHERE l_returnflag <> 'R'
       AND NOT EXISTS (SELECT 1 FROM lineitem p WHERE p.l_returnflag = 'R'
       AND p.l_partkey = l.l_partkey AND p.l_suppkey = l.l_suppkey)""",
)
def check_fk_composite(spark, d):
    lines = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag")
    orphans = integrity.check_fk(
        lines.where("l_returnflag <> 'R'"), lines.where("l_returnflag = 'R'"),
        ["l_partkey", "l_suppkey"], ["l_partkey", "l_suppkey"],
    )
    return orphans.agg(F.count("*").alias("n_rows"))


@query("check_length", "SELECT p_partkey, p_name FROM part WHERE length(p_name) > 10")
def check_length(spark, d):
    return integrity.check_length(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", 10)


@query(
    "with_default",
    """SELECT l_orderkey, l_linenumber, COALESCE(NULLIF(l_tax, 0.05), 0) AS l_tax FROM lineitem""",
)
def default_value(spark, d):
    tax = with_default(F.nullif("l_tax", F.lit(0.05)), 0.0).alias("l_tax")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", tax)

"""Aggregates, order and duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe.functions.scalar import cents, decade, from_cents
from loomframe.operators import aggregates as agg, filters, ordering, sets
from loomframe.plans.registry import query
from loomframe.plans.scalar_queries import _SCORE, line_score
from loomframe.sources.tables import table


@query(
    "count_rows",
    "SELECT CAST(count(*) AS BIGINT) AS n_rows FROM events WHERE event_type = 'purchase'",
)
def count_rows(spark, d):
    return agg.count_rows(table(spark, d, "events"), F.col("event_type") == "purchase")


@query("distinct_values", "SELECT DISTINCT l_returnflag FROM lineitem")
def distinct_values(spark, d):
    return agg.distinct_values(table(spark, d, "lineitem"), "l_returnflag")


@query(
    "group_count",
    """SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n_rows FROM orders
       WHERE o_orderpriority <> '5-LOW' GROUP BY o_orderpriority""",
)
def group_count(spark, d):
    """The NULL key is dropped."""
    priority = F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority")
    counts = agg.group_count(table(spark, d, "orders").select(priority), ["o_orderpriority"])
    return counts.orderBy(F.desc("n_rows"), "o_orderpriority")


@query(
    "group_sum",
    """SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(10,2))) AS DOUBLE) AS total
       FROM lineitem GROUP BY l_suppkey""",
)
def group_sum(spark, d):
    sums = agg.group_sum(table(spark, d, "lineitem"), ["l_suppkey"], cents("l_extendedprice"), "total")
    return sums.withColumn("total", from_cents("total"))


@query(
    "group_mean",
    """SELECT l_returnflag, l_linestatus,
              CAST(round(CAST(avg(l_quantity) AS DECIMAL(38,10)), 2) AS DOUBLE) AS mean_l_quantity,
              CAST(round(CAST(avg(l_discount) AS DECIMAL(38,10)), 2) AS DOUBLE) AS mean_l_discount
       FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def group_mean(spark, d):
    means = agg.group_mean(
        table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], ["l_quantity", "l_discount"]
    )
    return means.orderBy(F.desc("mean_l_quantity"), F.desc("mean_l_discount"))


@query(
    "group_mean_nan",
    """SELECT l_returnflag, CAST(round(CAST(avg(nullif(l_quantity, 1)) AS DECIMAL(38,10)), 2) AS DOUBLE)
              AS mean_l_quantity, CAST(round(CAST((avg(nullif(l_quantity, 1)) + avg(l_tax)) / 2
              AS DECIMAL(38,10)), 2) AS DOUBLE) AS mean_score
       FROM lineitem GROUP BY l_returnflag""",
)
def group_mean_nan(spark, d):
    """NaN counts as missing in means, and in means of means."""
    x = F.when(F.col("l_quantity") == 1, float("nan")).otherwise(F.col("l_quantity"))
    lines = table(spark, d, "lineitem").select("l_returnflag", x.alias("l_quantity"), "l_tax")
    means = agg.group_mean(lines, ["l_returnflag"], ["l_quantity"])
    return means.join(agg.mean_of_means(lines, "l_returnflag", ["l_quantity", "l_tax"]), "l_returnflag")


@query(
    "group_extremes",
    """SELECT event_type, min(value) AS min_value, max(value) AS max_value FROM events
       GROUP BY event_type""",
)
def group_extremes(spark, d):
    return agg.extremes(table(spark, d, "events"), ["event_type"], "value")


@query(
    "span_top5",
    """SELECT o_custkey, CAST(min(year(o_orderdate)) AS INTEGER) AS first_year,
              CAST(max(year(o_orderdate)) AS INTEGER) AS last_year,
              CAST(max(year(o_orderdate)) - min(year(o_orderdate)) AS INTEGER) AS span
       FROM orders GROUP BY o_custkey ORDER BY span DESC, o_custkey LIMIT 5""",
)
def span_top5(spark, d):
    spans = agg.career_span(table(spark, d, "orders"), "o_custkey", F.year("o_orderdate"))
    return ordering.top_k(spans, [F.desc("span"), "o_custkey"], 5)


@query(
    "distinct_top5",
    """SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year,
              CAST(count(DISTINCT l_partkey) AS BIGINT) AS n_distinct
       FROM lineitem GROUP BY ALL ORDER BY n_distinct DESC, l_suppkey, year LIMIT 5""",
)
def distinct_top5(spark, d):
    lines = table(spark, d, "lineitem").withColumn("year", F.year("l_shipdate"))
    counts = agg.distinct_count(lines, ["l_suppkey", "year"], "l_partkey")
    return ordering.top_k(counts, [F.desc("n_distinct"), "l_suppkey", "year"], 5)


@query(
    "set_top5",
    """SELECT user_id, CAST(count(DISTINCT event_type) AS BIGINT) AS n_distinct,
              string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS members
       FROM events WHERE event_type <> 'error' GROUP BY user_id
       ORDER BY n_distinct DESC, user_id LIMIT 5""",
)
def set_top5(spark, d):
    events = filters.where_not(table(spark, d, "events"), "event_type", "error")
    top = agg.largest_sets(events, ["user_id"], "event_type", 5)
    top = agg.as_sets(top, ["user_id", "n_distinct"], "event_type")
    return top.withColumn("members", F.concat_ws(",", "members"))


@query(
    "set_top5_compound",
    """SELECT DISTINCT o_custkey, year, n_distinct, o_orderpriority FROM (
         SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year,
                CAST(count(DISTINCT o_orderpriority) AS BIGINT) AS n_distinct
         FROM orders GROUP BY ALL ORDER BY n_distinct DESC, o_custkey, year LIMIT 5)
       JOIN (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority
             FROM orders) USING (o_custkey, year)""",
)
def set_top5_compound(spark, d):
    orders = table(spark, d, "orders").withColumn("year", F.year("o_orderdate"))
    return agg.largest_sets(orders, ["o_custkey", "year"], "o_orderpriority", 5)


def _extreme_check(key: str, name: str, source: str, pick: str) -> str:
    return f"""WITH c AS (SELECT {key} AS {name}, CAST(count(*) AS BIGINT) AS n_rows FROM {source}
                          GROUP BY 1)
               SELECT {name}, n_rows FROM c WHERE n_rows = (SELECT {pick}(n_rows) FROM c)"""


@query("argmax_groups", _extreme_check("o_custkey", "o_custkey", "orders", "max"))
def argmax_groups(spark, d):
    return agg.argmax_groups(table(spark, d, "orders"), "o_custkey")


@query(
    "argmin_groups",
    _extreme_check("strftime(o_orderdate, '%Y-%m-%d')", "day", "orders", "min"),
)
def argmin_groups(spark, d):
    days = table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return agg.argmin_groups(days, "day")


@query(
    "nested_count",
    """SELECT c_mktsegment, c_nationkey, CAST(count(*) AS BIGINT) AS n_rows FROM customer
       GROUP BY ALL""",
)
def nested_count(spark, d):
    return agg.nested_count(table(spark, d, "customer"), "c_mktsegment", "c_nationkey")


@query(
    "nested_map",
    """SELECT c_mktsegment, CAST(count(DISTINCT c_nationkey) AS INTEGER) AS n_inner,
              CAST(count(*) AS BIGINT) AS n_rows FROM customer GROUP BY c_mktsegment""",
)
def nested_map(spark, d):
    """Counts held as a map per segment, read back through the map."""
    counts = agg.nested_count(table(spark, d, "customer"), "c_mktsegment", "c_nationkey")
    maps = agg.as_nested_map(counts, "c_mktsegment", "c_nationkey")
    total = F.aggregate(F.map_values("counts"), F.lit(0).cast("bigint"), lambda a, n: a + n)
    return maps.select("c_mktsegment", F.size("counts").alias("n_inner"), total.alias("n_rows"))


_STATUSES = ["F", "O", "P"]


@query(
    "pivot_mean",
    "SELECT o_orderpriority, "
    + ", ".join(
        f"""COALESCE(CAST(round(CAST(avg(o_totalprice) FILTER (o_orderstatus = '{s}')
            AS DECIMAL(38,10)), 4) AS DOUBLE), 0) AS {s}"""
        for s in [*_STATUSES, "X"]
    )
    + " FROM orders GROUP BY o_orderpriority",
)
def pivot_mean(spark, d):
    """``X`` never occurs: its cells are 0."""
    values = [*_STATUSES, "X"]
    orders = table(spark, d, "orders")
    pivot = agg.pivot_mean(orders, "o_orderpriority", "o_orderstatus", values, "o_totalprice")
    rounded = {v: F.round(F.col(v).cast("decimal(38,10)"), 4).cast("double") for v in values}
    return pivot.withColumns(rounded)


@query(
    "best_per_key",
    f"""SELECT CAST(year(l_shipdate) AS INTEGER) AS year, max({_SCORE}) AS score,
               max((({_SCORE}), l_orderkey))[2] AS name
        FROM lineitem GROUP BY 1""",
)
def best_per_key(spark, d):
    year = F.year("l_shipdate").alias("year")
    return agg.argmax_per_key(table(spark, d, "lineitem"), year, line_score(), "l_orderkey")


@query(
    "mode_per_key",
    """SELECT user_id, event_type, n_rows FROM (
         SELECT user_id, event_type, CAST(count(*) AS BIGINT) AS n_rows,
                row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS r
         FROM events GROUP BY user_id, event_type) WHERE r = 1""",
)
def mode_per_key(spark, d):
    return agg.mode_per_key(table(spark, d, "events"), "user_id", "event_type")


@query(
    "mode_per_decade",
    """SELECT decade, o_orderpriority, n_rows FROM (
         SELECT CAST(year(o_orderdate) - year(o_orderdate) % 10 AS INTEGER) AS decade,
                o_orderpriority, CAST(count(*) AS BIGINT) AS n_rows,
                row_number() OVER (PARTITION BY decade ORDER BY count(*) DESC, o_orderpriority) AS r
         FROM orders GROUP BY 1, 2) WHERE r = 1""",
)
def mode_per_decade(spark, d):
    orders = table(spark, d, "orders").withColumn("decade", decade(F.year("o_orderdate")))
    return agg.mode_per_key(orders, "decade", "o_orderpriority").orderBy("decade")


@query(
    "list_and_sum",
    """SELECT c_mktsegment, string_agg(DISTINCT n_name, ',' ORDER BY n_name) AS members,
              CAST(sum(CAST(c_acctbal AS DECIMAL(10,2))) AS DOUBLE) AS total
       FROM customer JOIN nation ON c_nationkey = n_nationkey
       WHERE c_acctbal NOT IN (0, -1) AND c_nationkey NOT IN (0, -1) GROUP BY c_mktsegment""",
)
def list_and_sum(spark, d):
    known = filters.where_known(
        table(spark, d, "customer"), ["c_mktsegment"], ["c_acctbal", "c_nationkey"]
    )
    named = known.join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    listed = agg.list_and_sum(named, "c_mktsegment", "n_name", cents("c_acctbal"))
    return listed.select(
        "c_mktsegment", F.concat_ws(",", "members").alias("members"),
        from_cents("total").alias("total"),
    )


@query(
    "compound_top5",
    """SELECT l_orderkey, l_returnflag, CAST(count(*) AS BIGINT) AS n_rows FROM lineitem
       GROUP BY ALL ORDER BY n_rows DESC, l_orderkey, l_returnflag LIMIT 5""",
)
def compound_top5(spark, d):
    return agg.top_counts(table(spark, d, "lineitem"), ["l_orderkey", "l_returnflag"], 5)


@query(
    "top_frequent",
    """SELECT user_id, CAST(count(*) AS BIGINT) AS n_rows FROM events
       WHERE event_type <> 'error' GROUP BY user_id ORDER BY n_rows DESC, user_id LIMIT 5""",
)
def top_frequent(spark, d):
    events = filters.where_not(table(spark, d, "events"), "event_type", "error")
    return agg.top_counts(events, ["user_id"], 5)


@query(
    "pairs_min",
    """SELECT c_mktsegment AS key, c_nationkey AS partner, CAST(count(*) AS BIGINT) AS n_rows
       FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY ALL HAVING count(*) >= 120""",
)
def pairs_min(spark, d):
    joined = table(spark, d, "orders").join(
        table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    return agg.pairs_min(joined, "c_nationkey", "c_mktsegment", 120, by="c_mktsegment")


@query(
    "value_share",
    """SELECT p_type, CAST(count(*) AS BIGINT) AS n_rows,
              CAST(round(CAST(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM part)
              AS DECIMAL(38,10)), 1) AS DOUBLE) AS share FROM part GROUP BY p_type""",
)
def value_share(spark, d):
    return agg.value_share(table(spark, d, "part"), "p_type")


@query(
    "distinct_then_count",
    """SELECT s_nationkey, CAST(count(DISTINCT l_suppkey) AS BIGINT) AS n_members
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey""",
)
def distinct_then_count(spark, d):
    suppliers = table(spark, d, "lineitem").select("l_suppkey").distinct()
    joined = suppliers.join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return agg.distinct_then_count(joined, "s_nationkey", "l_suppkey")


@query(
    "mean_of_means",
    """SELECT l_returnflag, CAST(round(CAST((avg(l_quantity) + avg(l_discount) + avg(l_tax)) / 3
              AS DECIMAL(38,10)), 2) AS DOUBLE) AS mean_score FROM lineitem GROUP BY l_returnflag""",
)
def mean_of_means(spark, d):
    means = agg.mean_of_means(
        table(spark, d, "lineitem"), "l_returnflag", ["l_quantity", "l_discount", "l_tax"]
    )
    return means.orderBy(F.desc("mean_score"), "l_returnflag")


# -- order -----------------------------------------------------------------------------------


@query(
    "bottom_n_groups",
    """SELECT user_id, n_rows, CAST(ranking AS INTEGER) AS ranking FROM (
         SELECT user_id, CAST(count(*) AS BIGINT) AS n_rows,
                row_number() OVER (ORDER BY count(*), user_id) AS ranking
         FROM events GROUP BY user_id) WHERE ranking <= 2""",
)
def bottom_n_groups(spark, d):
    return ordering.bottom_n(table(spark, d, "events"), "user_id", 2)


@query(
    "number_rows",
    """SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS row_no,
              row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS type_no
       FROM events""",
)
def number_rows(spark, d):
    events = table(spark, d, "events").select("event_id", "ts", "event_type")
    overall = ordering.number_rows(events, ["ts", "event_id"])
    both = ordering.number_rows(overall, ["row_no"], within=["event_type"], name="type_no")
    return both.select("event_id", "row_no", "type_no")


@query(
    "top_k",
    """SELECT p_partkey, p_retailprice FROM part
       ORDER BY p_retailprice DESC, p_partkey LIMIT 5""",
)
def top_k(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_retailprice")
    return ordering.top_k(part, [F.desc("p_retailprice"), "p_partkey"], 5)


@query("latest_year", "SELECT CAST(max(year(o_orderdate)) AS INTEGER) AS year FROM orders")
def latest_year(spark, d):
    return ordering.latest(table(spark, d, "orders").select(F.year("o_orderdate").alias("year")), "year")


@query(
    "head_rows",
    "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 5",
)
def head_rows(spark, d):
    return ordering.head(table(spark, d, "orders").select("o_orderkey", "o_custkey"), 5, ["o_orderkey"])


@query("shape", "SELECT CAST(count(*) AS BIGINT) AS n_rows, 5 AS n_cols FROM customer")
def shape(spark, d):
    return ordering.shape(table(spark, d, "customer"))


# -- sets ------------------------------------------------------------------------------------


@query(
    "union_all",
    """SELECT c_name AS name, c_acctbal AS balance FROM customer
       UNION ALL SELECT s_name, s_acctbal FROM supplier""",
)
def union_all(spark, d):
    customers = table(spark, d, "customer").selectExpr("c_name AS name", "c_acctbal AS balance")
    suppliers = table(spark, d, "supplier").selectExpr("s_acctbal AS balance", "s_name AS name")
    return sets.concat([customers, suppliers])


@query("dedupe_rows", "SELECT DISTINCT lang, source, text FROM documents")
def dedupe_rows(spark, d):
    return sets.dedupe(table(spark, d, "documents"), ["lang", "source", "text"])


@query(
    "duplicate_count",
    "SELECT CAST(count(*) - count(DISTINCT text) AS BIGINT) AS n_duplicates FROM documents",
)
def duplicate_count(spark, d):
    return sets.duplicate_count(table(spark, d, "documents"), ["text"])


@query(
    "keep_first",
    """SELECT * EXCLUDE (r) REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate) FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                   ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                            l_returnflag, l_linestatus, l_shipdate) AS r FROM lineitem)
       WHERE r = 1""",
)
def keep_first(spark, d):
    lines = table(spark, d, "lineitem")
    rest = [c for c in lines.columns if c not in ("l_orderkey", "l_linenumber")]
    first = sets.keep_first(lines, ["l_orderkey", "l_linenumber"], rest)
    return first.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))

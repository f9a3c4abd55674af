"""Readers and writers, each as a round trip through a file."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from loomframe.functions import html as h
from loomframe.functions.scalar import cents, from_cents, money
from loomframe.operators import arrays
from loomframe.plans.registry import query
from loomframe.session import new_path
from loomframe.sources import delimited, documents
from loomframe.sources.tables import register_views, table


def _customers_as_text(spark, d):
    return table(spark, d, "customer").withColumn("c_acctbal", money("c_acctbal"))


@query(
    "scan_csv_roundtrip",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
              CAST(c_nationkey AS VARCHAR) AS c_nationkey,
              CAST(CAST(c_acctbal AS DECIMAL(10,2)) AS VARCHAR) AS c_acctbal, c_mktsegment
       FROM customer""",
)
def scan_csv_roundtrip(spark, d):
    df, path = _customers_as_text(spark, d), new_path(spark, "csv")
    delimited.write_csv(df, path)
    return delimited.read_csv_raw(spark, path, df.columns)


@query(
    "scan_csv_quoted",
    "SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role, text"
    " FROM conversations",
)
def scan_csv_quoted(spark, d):
    """Text with separators, quotes and line breaks inside its fields."""
    df, path = table(spark, d, "conversations"), new_path(spark, "csv")
    delimited.write_csv(df, path)
    return delimited.read_csv_raw(spark, path, df.columns, multiline=True)


@query("scan_csv_fields", "SELECT c_name, c_mktsegment FROM customer")
def scan_csv_fields(spark, d):
    df, path = _customers_as_text(spark, d), new_path(spark, "csv")
    delimited.write_csv(df, path)
    return delimited.read_csv_fields(spark, path, df.columns, ["c_name", "c_mktsegment"])


@query(
    "scan_csv_semicolon",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
              CAST(o_orderdate AS DATE) AS o_orderdate FROM orders""",
)
def scan_csv_semicolon(spark, d):
    df = table(spark, d, "orders").drop("o_orderpriority")
    df = df.withColumn("o_orderdate", F.to_date("o_orderdate"))
    path = new_path(spark, "csv")
    delimited.write_csv(df, path, sep=";")
    return delimited.read_csv_typed(spark, path, df.schema, sep=";")


@query(
    "scan_csv_several_files",
    """SELECT c_custkey AS k, c_acctbal AS balance FROM customer
       UNION ALL SELECT s_suppkey, s_acctbal FROM supplier""",
)
def scan_csv_several_files(spark, d):
    """Two files with the same columns, read as one table."""
    paths = []
    for name, key, balance in (
        ("customer", "c_custkey", "c_acctbal"), ("supplier", "s_suppkey", "s_acctbal"),
    ):
        rows = table(spark, d, name).select(F.col(key).alias("k"), F.col(balance).alias("balance"))
        paths.append(new_path(spark, "csv"))
        delimited.write_csv(rows, paths[-1], sep=";")
    return delimited.read_csv_typed(spark, paths, "k bigint, balance double", sep=";")


@query(
    "scan_csv_bad_rows",
    """SELECT c_custkey AS k, c_acctbal AS balance, NULL AS line FROM customer WHERE c_custkey % 7 <> 0
       UNION ALL SELECT NULL, NULL, c_custkey || ';oops' FROM customer WHERE c_custkey % 14 = 0
       UNION ALL SELECT NULL, NULL, c_custkey || ';1.5;more' FROM customer WHERE c_custkey % 14 = 7""",
)
def scan_csv_bad_rows(spark, d):
    """Lines with a wrong type or too many fields are set aside, none is lost."""
    key = F.col("c_custkey").cast("string")
    line = (
        F.when(F.col("c_custkey") % 14 == 0, F.concat(key, F.lit(";oops")))
        .when(F.col("c_custkey") % 14 == 7, F.concat(key, F.lit(";1.5;more")))
        .otherwise(F.concat(key, F.lit(";"), F.col("c_acctbal").cast("string")))
    )
    path = new_path(spark, "csv")
    customers = table(spark, d, "customer").select(line.alias("k;balance"))
    customers.write.option("header", True).option("quote", "").option("sep", "|").csv(path)
    schema = T.StructType().add("k", T.LongType()).add("balance", T.DoubleType())
    good, bad = delimited.read_csv_checked(spark, path, schema, sep=";")
    return good.withColumn("line", F.lit(None).cast("string")).unionByName(
        bad.select(
            F.lit(None).cast("bigint").alias("k"), F.lit(None).cast("double").alias("balance"),
            F.col(delimited.QUARANTINE).alias("line"),
        )
    )


_PART_FIELDS = T.StructType(
    [
        T.StructField("p_partkey", T.LongType()),
        T.StructField("p_name", T.StringType()),
        T.StructField("p_brand", T.StringType()),
        T.StructField("p_size", T.IntegerType()),
        T.StructField("p_retailprice", T.DoubleType()),
    ]
)


@query(
    "parse_delimited_lines",
    "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part",
)
def parse_delimited_lines(spark, d):
    lines = table(spark, d, "part").select(F.concat_ws("|", *_PART_FIELDS.names))
    good, _ = delimited.parse_lines(lines, "|", _PART_FIELDS)
    return good


@query(
    "parse_quarantine",
    """SELECT concat_ws('|', p_partkey, p_name, p_brand, p_type) AS bad_line FROM part
       WHERE p_type = 'STANDARD'""",
)
def parse_quarantine(spark, d):
    """Lines with a field too few, or with text for a number, are set aside."""
    part = table(spark, d, "part")
    short = F.concat_ws("|", "p_partkey", "p_name", "p_brand", "p_type")
    full = F.concat_ws("|", *_PART_FIELDS.names)
    lines = part.select(F.when(F.col("p_type") == "STANDARD", short).otherwise(full).alias("value"))
    _, bad = delimited.parse_lines(lines, "|", _PART_FIELDS)
    return bad


@query(
    "sink_delimited",
    """SELECT concat_ws('|', c_name, c_nationkey, c_mktsegment,
                        CAST(c_acctbal AS DECIMAL(10,2))) AS value FROM customer""",
)
def sink_delimited(spark, d):
    path = new_path(spark, "lines")
    fields = ["c_name", "c_nationkey", "c_mktsegment", "c_acctbal"]
    delimited.write_delimited(_customers_as_text(spark, d), path, fields)
    return delimited.read_lines(spark, path)


@query(
    "sink_lines",
    """SELECT unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) AS value
       FROM pages""",
)
def sink_lines(spark, d):
    links = h.explode_items(
        table(spark, d, "pages"), "page_id", h.all_attributes("html", "a", "href"), "link"
    )
    path = new_path(spark, "lines")
    delimited.write_lines(links, "link", path)
    return delimited.read_lines(spark, path)


@query("scan_json", "SELECT conv_id, turn, role, text FROM conversations")
def scan_json(spark, d):
    df, path = table(spark, d, "conversations"), new_path(spark, "json")
    documents.write_json(df, path)
    return documents.read_documents(spark, path, df.schema)


@query(
    "scan_table",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
              CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders""",
)
def scan_table(spark, d):
    orders = table(spark, d, "orders")
    return orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


@query(
    "register_views",
    """SELECT n_name, CAST(count(*) AS BIGINT) AS n_customers FROM customer
       JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def views(spark, d):
    register_views(spark, d)
    return spark.sql(
        """SELECT n_name, count(*) AS n_customers FROM customer
           JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"""
    )


@query(
    "materialize_exploded",
    """SELECT word, CAST(count(*) AS BIGINT) AS n_rows FROM
       (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY word""",
)
def materialize_exploded(spark, d):
    words = table(spark, d, "part").select("p_partkey", F.split("p_name", " ").alias("word"))
    stored = documents.materialize(arrays.unwind(words, "word"), new_path(spark, "words"))
    return stored.groupBy("word").agg(F.count("*").alias("n_rows"))


@query(
    "sink_json",
    """SELECT c_mktsegment, CAST(sum(CAST(c_acctbal AS DECIMAL(10,2))) AS DOUBLE) AS total
       FROM customer GROUP BY c_mktsegment""",
)
def sink_json(spark, d):
    totals = table(spark, d, "customer").groupBy("c_mktsegment").agg(
        from_cents(F.sum(cents("c_acctbal"))).alias("total")
    )
    path = new_path(spark, "json")
    documents.write_json(totals, path)
    return documents.read_documents(spark, path, totals.schema)


@query(
    "result_map",
    "SELECT c_mktsegment AS key, CAST(count(*) AS BIGINT) AS value FROM customer GROUP BY 1",
)
def result_map(spark, d):
    counts = table(spark, d, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("n"))
    return documents.to_key_values(counts, "c_mktsegment", "n")


@query(
    "first_ten_urls",
    """SELECT page_id, url, (SELECT count(url) FROM pages) AS n_urls
       FROM pages ORDER BY page_id LIMIT 10""",
)
def first_ten_urls(spark, d):
    return documents.url_list(table(spark, d, "pages"), "url", "page_id")

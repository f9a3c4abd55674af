"""Projections and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe.functions import html as h, scalar as s
from loomframe.operators import encoding
from loomframe.operators.statistics import profile_columns
from loomframe.plans.registry import query
from loomframe.sources.tables import table


def _plain(markup: str) -> str:
    """Text of markup in SQL: without tags and comments, with the usual entities read."""
    text = f"regexp_replace({markup}, '(?s)<!--.*?-->|<[^>]*>', '', 'g')"
    for entity, sign in h.ENTITIES.items():
        sign = "chr(160)" if sign == "\u00a0" else "'" + sign.replace("'", "''") + "'"
        text = f"replace({text}, '{entity}', {sign})"
    return f"trim({text})"


@query("project_fields", "SELECT p_partkey, p_brand, p_size FROM part")
def project_fields(spark, d):
    return s.project(table(spark, d, "part"), include=[0, "p_brand", 4])


@query("project_exclude", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def project_exclude(spark, d):
    return s.project(table(spark, d, "supplier"), exclude=["s_acctbal"])


@query(
    "profile_columns",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", count({c}) AS n_known FROM lineitem"
        for i, c in enumerate(
            ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
             "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
             "l_shipdate"]
        )
    ),
)
def profile(spark, d):
    return profile_columns(table(spark, d, "lineitem")).drop("type")


@query(
    "parse_number",
    """SELECT event_id,
              COALESCE(TRY_CAST(regexp_extract(props, '\\d+') AS BIGINT), -1) AS k,
              CAST(-1 AS BIGINT) AS no_number, value AS as_double
       FROM events""",
)
def parse_number(spark, d):
    return table(spark, d, "events").select(
        "event_id",
        s.parse_number(F.regexp_extract("props", r"\d+", 0)).alias("k"),
        s.parse_number("event_type").alias("no_number"),
        s.parse_number(F.col("value").cast("string"), "double").alias("as_double"),
    )


@query("clean_text", "SELECT p_partkey, p_name FROM part")
def clean_text(spark, d):
    padded = F.concat(F.lit(" \u00a0\t"), "p_name", F.lit("\u00a0 "))
    return table(spark, d, "part").select("p_partkey", s.clean_text(padded).alias("p_name"))


@query("cut_url", "SELECT page_id, split_part(trim(url), '?page', 1) AS url FROM pages")
def cut_url(spark, d):
    return table(spark, d, "pages").select("page_id", s.cut_at("url", "?page").alias("url"))


@query(
    "typed_record",
    f"""SELECT page_id, split_part(trim(url), '?page', 1) AS link,
              trim(replace({_plain("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")}, chr(160), '')) AS title,
              COALESCE(TRY_CAST(regexp_extract(url, 'page=(\\d+)', 1) AS BIGINT), -1) AS page_no
       FROM pages""",
)
def typed_record(spark, d):
    raw = table(spark, d, "pages").withColumn("page_id", F.col("page_id").cast("string"))
    return s.arrange_types(
        raw,
        {
            "page_id": s.parse_number("page_id"),
            "link": s.cut_at("url", "?page"),
            "title": s.clean_text(h.tag_text("html", "title")),
            "page_no": s.parse_number(F.regexp_extract("url", r"page=(\d+)", 1)),
        },
    )


@query(
    "derived_arith",
    """SELECT l_orderkey, l_linenumber,
              CAST(round(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(38,10)), 4) AS DOUBLE)
              AS net_price FROM lineitem""",
)
def derived_arith(spark, d):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", s.round_half_up(net, 4).alias("net_price")
    )


@query(
    "decade_bucket",
    """SELECT CAST(year(o_orderdate) - year(o_orderdate) % 10 AS INTEGER) AS decade,
              CAST(count(*) AS BIGINT) AS n_rows FROM orders GROUP BY 1""",
)
def decade_bucket(spark, d):
    decade = s.decade(F.year("o_orderdate")).alias("decade")
    return table(spark, d, "orders").groupBy(decade).agg(F.count("*").alias("n_rows"))


_SCORE = """CAST(round(CAST((l_quantity * 0.5::DOUBLE + l_discount * 0.3::DOUBLE
              + l_tax * 0.2::DOUBLE) * (1 + 0.1::DOUBLE * l_linenumber) AS DECIMAL(38,10)), 3)
              AS DOUBLE)"""


def line_score():
    return s.weighted_score(
        ["l_quantity", "l_discount", "l_tax"], [0.5, 0.3, 0.2], "l_linenumber"
    )


@query(
    "weighted_score",
    f"SELECT l_orderkey, l_linenumber, {_SCORE} AS score FROM lineitem",
)
def weighted_score(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", line_score().alias("score")
    )


@query(
    "round_avg",
    """SELECT o_orderpriority,
              CAST(round(CAST(avg(o_totalprice) AS DECIMAL(38,10)), 2) AS DOUBLE) AS mean_price
       FROM orders GROUP BY o_orderpriority""",
)
def round_avg(spark, d):
    mean = s.round_half_up(F.avg("o_totalprice"), 2).alias("mean_price")
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(mean)


@query("rename_cols", "SELECT n_nationkey AS id, n_name AS nation, n_regionkey FROM nation")
def rename_cols(spark, d):
    return s.rename(table(spark, d, "nation"), {"n_nationkey": "id", "n_name": "nation"})


@query(
    "recast",
    """SELECT p_partkey, CAST(p_size AS VARCHAR) AS p_size, CAST(NULL AS INTEGER) AS p_brand
       FROM part""",
)
def recast(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_size", "p_brand")
    return s.recast(part, {"p_size": "string", "p_brand": "int"})


@query(
    "replace_where",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'Pending' ELSE o_orderstatus END
              AS o_orderstatus FROM orders""",
)
def replace_where(spark, d):
    status = s.replace_where(F.col("o_orderstatus") == "P", "o_orderstatus", "Pending")
    return table(spark, d, "orders").select("o_orderkey", status.alias("o_orderstatus"))


@query(
    "fill_missing",
    """SELECT c_custkey, COALESCE(NULLIF(c_mktsegment, 'BUILDING'), 'unknown') AS c_mktsegment
       FROM customer""",
)
def fill_missing(spark, d):
    gaps = table(spark, d, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment")
    )
    return s.fill_missing(gaps, "unknown", ["c_mktsegment"])


@query(
    "map_binary",
    """SELECT l_orderkey, l_linenumber, CASE l_linestatus WHEN 'O' THEN 1 WHEN 'F' THEN 0 END
              AS is_open FROM lineitem""",
)
def map_binary(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", s.map_binary("l_linestatus", {"O": 1, "F": 0}).alias("is_open")
    )


@query(
    "contains_flag",
    """SELECT p_partkey, CASE WHEN contains(lower(NULLIF(p_name, 'red ring')), 'ring') THEN 1
              ELSE 0 END AS has_ring FROM part""",
)
def contains_flag(spark, d):
    name = F.nullif("p_name", F.lit("red ring"))
    return table(spark, d, "part").select("p_partkey", s.contains_flag(name, "RING").alias("has_ring"))


@query(
    "extract_number",
    """SELECT p_partkey, CAST(regexp_extract(p_brand, '\\d+(\\.\\d+)?') AS DOUBLE) AS brand_no,
              CAST(NULL AS DOUBLE) AS none FROM part""",
)
def extract_number(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", s.extract_number("p_brand").alias("brand_no"),
        s.extract_number("p_type").alias("none"),
    )


@query("strip_units", "SELECT p_partkey, CAST(floor(p_retailprice) AS BIGINT) AS price FROM part")
def strip_units(spark, d):
    shown = F.concat(F.format_number(F.floor("p_retailprice"), 0), F.lit(" km"))
    return table(spark, d, "part").select("p_partkey", s.strip_units(shown, " km").alias("price"))


@query(
    "present_flag",
    "SELECT doc_id, CASE WHEN NULLIF(lang, 'en') IS NULL THEN 0 ELSE 1 END AS has_lang FROM documents",
)
def present_flag(spark, d):
    lang = F.nullif("lang", F.lit("en"))
    return table(spark, d, "documents").select("doc_id", s.present_flag(lang).alias("has_lang"))


@query(
    "equals_flag",
    "SELECT event_id, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS is_click FROM events",
)
def equals_flag(spark, d):
    return table(spark, d, "events").select("event_id", s.equals_flag("event_type", "click").alias("is_click"))


@query("drop_cols", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def drop_cols(spark, d):
    return s.project(table(spark, d, "customer"), exclude=["c_nationkey", "c_mktsegment"])


@query(
    "lump_rare",
    """WITH top AS (SELECT p_brand FROM part GROUP BY p_brand
                    ORDER BY count(*) DESC, p_brand LIMIT 6)
       SELECT p_partkey, CASE WHEN p_brand IN (SELECT p_brand FROM top) THEN p_brand
              ELSE 'resto' END AS p_brand FROM part""",
)
def lump_rare(spark, d):
    return encoding.lump_rare(table(spark, d, "part").select("p_partkey", "p_brand"), "p_brand", 6)


@query(
    "row_mean",
    """SELECT l_orderkey, l_linenumber,
              CAST(round(CAST((COALESCE(l_quantity, 0) + COALESCE(NULLIF(l_discount, 0), 0)
              + COALESCE(NULLIF(l_tax, 0), 0)) / (1 + CASE WHEN l_discount = 0 THEN 0 ELSE 1 END
              + CASE WHEN l_tax = 0 THEN 0 ELSE 1 END) AS DECIMAL(38,10)), 6) AS DOUBLE) AS mean
       FROM lineitem""",
)
def row_mean(spark, d):
    mean = s.row_mean(
        "l_quantity", F.nullif("l_discount", F.lit(0.0)), F.nullif("l_tax", F.lit(0.0))
    )
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", s.round_half_up(mean, 6).alias("mean")
    )


@query(
    "portion_year",
    """SELECT o_orderkey, CAST(dayofyear(o_orderdate) AS DOUBLE) / 365.0::DOUBLE AS portion_year
       FROM orders""",
)
def portion_year(spark, d):
    return table(spark, d, "orders").select("o_orderkey", s.portion_year("o_orderdate").alias("portion_year"))


@query(
    "array_size",
    "SELECT p_partkey, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS n_words FROM part",
)
def array_size(spark, d):
    return table(spark, d, "part").select("p_partkey", F.size(F.split("p_name", " ")).alias("n_words"))


@query(
    "nan_to_null",
    "SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value FROM events",
)
def nan_to_null(spark, d):
    value = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return s.nan_to_null(table(spark, d, "events").select("event_id", value.alias("value")))


@query(
    "html_title",
    f"""SELECT page_id, NULLIF({_plain("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")}, '') AS title,
              NULLIF(regexp_extract(html, '<meta[^>]*name="description"[^>]*content="([^"]*)"', 1), '')
              AS description,
              regexp_extract_all(html, '(?s)<li(?:\\s[^>]*)?>(.*?)</li>', 1)[3] AS third_item
       FROM pages""",
)
def html_title(spark, d):
    return h.extract_html(
        table(spark, d, "pages").select("page_id", "html"),
        "html",
        {
            "title": h.tag_text("html", "title"),
            "description": h.meta_content("html", "description"),
            "third_item": h.nth(h.all_texts("html", "li"), 2),
        },
    )


@query(
    "html_meta",
    "SELECT page_id, url AS description, 'page ' || page_id || ' & more' AS heading FROM pages",
)
def html_meta(spark, d):
    """Attributes in any order and quotes, and an element with markup and entities inside."""
    page = F.concat(
        F.lit("<META charset=x><meta content='"), "url", F.lit("' name='description'><h1 class=a>page <b>"),
        F.col("page_id").cast("string"), F.lit("</b> &amp;<!-- x > y --> more </h1>"), "html",
    )
    return h.extract_html(
        table(spark, d, "pages").select("page_id", page.alias("html")),
        "html",
        {"description": h.meta_content("html", "description"), "heading": h.tag_text("html", "h1")},
    )


@query(
    "html_links_exploded",
    """SELECT page_id, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) AS link
       FROM pages""",
)
def html_links_exploded(spark, d):
    return h.explode_items(
        table(spark, d, "pages"), "page_id", h.all_attributes("html", "a", "href"), "link"
    )


@query(
    "html_link_texts",
    """SELECT page_id, unnest(regexp_extract_all(html, '(?s)<a(?:\\s[^>]*)?>(.*?)</a>', 1)) AS item
       FROM pages""",
)
def html_link_texts(spark, d):
    return h.explode_items(table(spark, d, "pages"), "page_id", h.all_texts("html", "a"), "item")


@query(
    "html_by_attribute",
    """SELECT page_id,
              unnest(regexp_extract_all(html, '(?s)<div\\s[^>]*class="ad"[^>]*>(.*?)</div>', 1))
              AS item FROM pages""",
)
def html_by_attribute(spark, d):
    return h.explode_items(
        table(spark, d, "pages"), "page_id", h.all_texts("html", "div", "class", "ad"), "item"
    )

"""CSV records, delimited lines and map-reduce style rollups."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from conftest import rows
from loomframe.functions import html as h, scalar as s
from loomframe.operators import aggregates, encoding, filters, joins, sets
from loomframe.session import new_path
from loomframe.sources import delimited

NBSP = "\u00a0"
FIELDS = ["color", "director", "title", "link", "language", "country", "budget", "year", "score"]


@pytest.fixture(scope="module")
def films(spark):
    data = [
        ("Color", "Ann", f"One, two{NBSP}", "http://a/?ref_=x", "English", "USA", "12215500000", "2001", "7.5"),
        ("Color", "Ann", f"One, two{NBSP}", "http://b/", "English", "USA", "5", "2001", "6.0"),
        (None, "Bob", " Say \"hi\" ", "http://c/?ref_=y", "Spanish", "Spain", "", "", ""),
        (None, "", "Three", "http://d/", "English", "UK", "12.7", "2001", "x"),
        (None, "Bob", "Four", "http://e/", "", "USA", "100", "1999", "5"),
    ]
    raw = spark.createDataFrame([(i, *r) for i, r in enumerate(data)],
                                T.StructType([T.StructField("line", T.IntegerType())]
                                             + [T.StructField(f, T.StringType()) for f in FIELDS]))
    return raw


def _typed(df):
    return s.arrange_types(
        df,
        {
            "line": F.col("line"), "title": s.clean_text("title"), "link": s.cut_at("link", "?ref"),
            "director": F.col("director"), "language": F.col("language"), "country": F.col("country"),
            "year": s.parse_number("year"), "budget": s.parse_number("budget"),
            "score": s.parse_number("score", "double"),
        },
    )


def test_csv_round_trip_with_quotes_and_separators(spark, films):
    path = new_path(spark, "films")
    delimited.write_csv(films.drop("line"), path)
    back = delimited.read_csv_raw(spark, path, FIELDS)
    assert back.where("title = 'One, two '").count() == 2
    assert back.where("contains(title, '\"hi\"')").count() == 1
    few = delimited.read_csv_fields(spark, path, FIELDS, ["director", "year"])
    assert few.columns == ["director", "year"] and few.count() == 5


def test_typed_records_with_sentinels(films):
    got = {r.line: r for r in _typed(films).collect()}
    assert got[0].title == "One, two" and got[0].budget == 12215500000 and got[0].link == "http://a/"
    assert (got[2].year, got[2].budget, got[2].score, got[2].title) == (-1, -1, -1.0, 'Say "hi"')
    assert (got[3].budget, got[3].score) == (-1, -1.0)


def test_first_record_per_key_wins(films):
    kept = sets.keep_first(_typed(films), ["title", "year"], ["line"])
    assert sorted(r.line for r in kept.collect()) == [0, 2, 3, 4]
    with pytest.raises(ValueError):
        sets.keep_first(films, ["title"], [])


def test_busiest_director_skips_the_unknown(films):
    known = films.withColumn("director", F.nullif("director", F.lit("")))
    assert rows(aggregates.argmax_groups(known, "director")) == [("Ann", 2), ("Bob", 2)]


def test_films_per_year_has_no_holes(films):
    dense = joins.count_per_year(_typed(films), F.col("year"), 1998, 2002)
    assert rows(dense) == [(1998, 0), (1999, 1), (2000, 0), (2001, 3), (2002, 0)]


def test_budget_per_language_over_known_rows(spark, films):
    typed = sets.keep_first(_typed(films), ["title", "year"], ["line"])
    path = new_path(spark, "lines")
    delimited.write_delimited(typed, path, ["title", "year", "language", "country", "budget"])
    schema = T.StructType(
        [T.StructField("title", T.StringType()), T.StructField("year", T.LongType()),
         T.StructField("language", T.StringType()), T.StructField("country", T.StringType()),
         T.StructField("budget", T.LongType())]
    )
    good, bad = delimited.parse_lines(delimited.read_lines(spark, path), "|", schema)
    assert bad.count() == 0
    known = filters.where_known(good, ["language", "country"], ["year", "budget"])
    listed = aggregates.list_and_sum(known, "language", "country", F.col("budget"))
    assert rows(listed) == [("English", ["USA"], 12215500000)]


def test_wrong_arity_and_bad_values_are_set_aside(spark):
    lines = spark.createDataFrame([("a|1",), ("b",), ("c|x",), ("d|",), ("e|1|2",)], "value string")
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.IntegerType())])
    good, bad = delimited.parse_lines(lines, "|", schema)
    assert rows(good) == [("a", 1), ("d", None)]
    assert rows(bad) == [("b",), ("c|x",), ("e|1|2",)]


def test_best_player_per_season_ties_to_the_larger_name(spark):
    lines = spark.createDataFrame(
        [("Al,2001,T,10,10,10,0",), ("Zoe,2001,T,10,10,10,0",), ("Bo,2002,T,20,0,0,-5",),
         ("Cy,2002,T,2,0,0,20",)],
        "value string",
    )
    schema = T.StructType(
        [T.StructField(n, T.StringType()) for n in ("player", "season", "team")]
        + [T.StructField(n, T.DoubleType()) for n in ("pts", "reb", "ast", "net")]
    )
    players, _ = delimited.parse_lines(lines, ",", schema)
    score = s.weighted_score(["pts", "reb", "ast"], [0.5, 0.3, 0.2], "net")
    best = aggregates.argmax_per_key(players, "season", score, "player")
    assert rows(best) == [("2001", 10.0, "Zoe"), ("2002", 5.0, "Bo")]


def test_pairs_are_listed_by_either_side(spark):
    df = spark.createDataFrame([("a", "d")] * 3 + [("a", "e")] + [("b", "d")] * 2, "actor string, director string")
    by_director = aggregates.pairs_min(df, "actor", "director", 2, by="director")
    assert rows(by_director) == [("d", "a", 3), ("d", "b", 2)]
    by_actor = aggregates.pairs_min(df, "actor", "director", 2, by="actor")
    assert rows(by_actor) == [("a", "d", 3), ("b", "d", 2)]


def test_used_car_cleaning(spark):
    cars = spark.createDataFrame(
        [("Yes", "2.0 Turbo", "186,005 km", "-", "Automatic"), ("No", "3", "0 km", "781", "Tiptronic")],
        "leather string, engine string, mileage string, levy string, gear string",
    )
    levy = s.replace_where(F.col("levy") == "-", "levy", "0").cast("int")
    got = cars.select(
        s.map_binary("leather", {"Yes": 1, "No": 0}), s.contains_flag("engine", "turbo"),
        s.extract_number("engine"), s.strip_units("mileage", " km"), levy,
        s.map_binary("gear", {"Automatic": 1}, strict=False),
    )
    assert rows(got) == [(0, 0, 3.0, 0, 781, None), (1, 1, 2.0, 186005, 0, 1)]


def test_unmapped_category_fails(spark):
    odd = spark.createDataFrame([("Maybe",)], "c string")
    with pytest.raises(PySparkException, match="Maybe"):
        odd.select(s.map_binary("c", {"Yes": 1, "No": 0})).collect()


def test_row_mean_and_missing_values(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None)], "a double, b double, c double")
    assert rows(df.select(s.row_mean("a", "b", "c"))) == [(2.0,), (None,)]
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert s.nan_to_null(nan).agg(F.avg("x")).first()[0] == 1.0


def test_rounding_is_half_away_from_zero(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (2.675,)], "x double")
    assert rows(df.select(s.round_half_up("x", 2))) == [(-0.13,), (0.13,), (2.68,)]


def test_rare_categories_are_lumped(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("c",)] * 2 + [("b",)] * 2 + [("d",)], "c string")
    lumped = encoding.lump_rare(df, "c", 2)
    assert rows(aggregates.group_count(lumped, ["c"])) == [("a", 3), ("b", 2), ("resto", 3)]


def test_html_fields(spark):
    page = """<html><title>T &amp; x</title><meta name="description" content="Plot.">
    <a data-testid="actor" href="/1">Ann</a><a href="/2">no</a><a class="b" data-testid="actor">Bob</a>
    <span class="item">one</span><span class="item">two</span><span class="item">$3</span></html>"""
    df = spark.createDataFrame([(1, page), (2, "<html></html>")], "id int, html string")
    got = h.extract_html(
        df, "html",
        {
            "title": h.tag_text("html", "title"), "about": h.meta_content("html", "description"),
            "actors": h.all_texts("html", "a", "data-testid", "actor"),
            "third": h.nth(h.all_texts("html", "span", "class", "item"), 2),
        },
    )
    assert rows(got) == [
        (1, "T & x", "Plot.", ["Ann", "Bob"], "$3"), (2, None, None, [], None)
    ]


def test_portion_of_a_leap_year_exceeds_one(spark):
    df = spark.sql("SELECT DATE'2004-12-31' AS d")
    assert df.select(s.portion_year("d")).first()[0] == 366 / 365.0

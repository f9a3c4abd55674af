"""Film documents: cleaning of arrays, derived collections, rankings."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from loomframe.functions.scalar import decade
from loomframe.operators import aggregates, arrays, filters, ordering
from loomframe.session import new_path
from loomframe.sources.documents import materialize, read_documents, write_json

SCHEMA = "title string, year int, cast array<string>, genres array<string>"


@pytest.fixture(scope="module")
def films(spark):
    return spark.createDataFrame(
        [
            ("A", 1999, ["x", "and", "y"], ["Drama"]),
            ("B", 1999, ["and"], ["Drama", "Comedy"]),
            ("C", 2001, [], []),
            ("D", 2001, ["x", "x"], ["Comedy"]),
            ("A", 2005, ["z", "x"], ["Drama", "War"]),
            ("E", None, None, None),
        ],
        SCHEMA,
    )


@pytest.fixture(scope="module")
def clean(films):
    """The order matters: removing a value makes arrays empty."""
    pulled = arrays.array_pull(films, "cast", "and")
    return arrays.fill_empty_array(
        arrays.fill_empty_array(pulled, "cast", "Undefined"), "genres", "Undefined"
    )


def test_pull_before_filling(films, clean):
    assert filters.where_has(films, "cast", "and").count() == 2
    assert filters.where_empty(films, "cast").count() == 1
    casts = {(r.title, r.year): r.cast for r in clean.collect()}
    assert casts["A", 1999] == ["x", "y"] and casts["B", 1999] == ["Undefined"]
    assert casts["C", 2001] == ["Undefined"] and casts["E", None] is None


def test_unwind_drops_empty_and_null(films):
    assert arrays.unwind(films, "cast").count() == 8
    assert arrays.unwind_chain(films, ["cast", "genres"]).count() == 3 + 2 + 2 + 4


def test_stored_collection_equals_the_lazy_one(spark, clean):
    actors = arrays.unwind(clean, "cast")
    stored = materialize(actors, new_path(spark, "actors"))
    assert rows(stored) == rows(actors)


def test_json_round_trip_keeps_nulls_and_empty_arrays(spark, films):
    path = new_path(spark, "films")
    write_json(films, path)
    assert rows(read_documents(spark, path, SCHEMA)) == rows(films)


def test_most_and_fewest_films_per_year_with_ties(films):
    assert rows(aggregates.argmax_groups(films, "year")) == [(1999, 2), (2001, 2)]
    assert rows(aggregates.argmin_groups(films, "year")) == [(2005, 1)]


def test_actor_rankings(clean):
    actors = arrays.unwind(clean, "cast")
    known = filters.where_not(actors, "cast", "Undefined")
    top = aggregates.top_counts(known, ["cast"], 5).collect()
    assert [tuple(r) for r in top] == [("x", 4), ("y", 1), ("z", 1)]
    spans = aggregates.career_span(known, "cast", F.col("year"))
    assert rows(ordering.top_k(spans, [F.desc("span"), "cast"], 1)) == [("x", 1999, 2005, 6)]


def test_genre_sets(clean):
    both = arrays.unwind_chain(clean, ["cast", "genres"])
    known = filters.where_none(both, {"cast": "Undefined"}, {})
    long = aggregates.largest_sets(known, ["cast"], "genres", 1)
    assert rows(aggregates.as_sets(long, ["cast"], "genres")) == [("x", ["Comedy", "Drama", "War"])]
    titles = aggregates.distinct_count(both, ["year", "genres"], "title")
    assert ("Drama", 2) in [(r.genres, r.n_distinct) for r in titles.where("year = 1999").collect()]


def test_top_actor_per_genre_and_top_genre_per_decade(clean):
    both = arrays.unwind_chain(clean, ["cast", "genres"])
    known = filters.where_none(both, {"genres": "Undefined", "cast": "Undefined"}, {})
    assert rows(aggregates.mode_per_key(known, "genres", "cast")) == [
        ("Comedy", "x", 2), ("Drama", "x", 2), ("War", "x", 1)
    ]
    decades = known.withColumn("decade", decade("year"))
    assert rows(aggregates.mode_per_key(decades, "decade", "genres")) == [
        (1990, "Drama", 2), (2000, "Comedy", 2)
    ]


def test_last_years_and_longest_cast(films):
    recent = filters.where_last_n(films, "year", 5)
    assert rows(recent.select("title", "year")) == [("A", 2005), ("C", 2001), ("D", 2001)]
    longest = ordering.longest_array(films, "cast", ["title", "year"]).first()
    assert (longest.title, longest.year, longest.n_items) == ("A", 1999, 3)


def test_push_records_splits_long_arrays(spark):
    df = spark.createDataFrame([("k", i) for i in range(25)] + [("l", 0)], "k string, v int")
    packed = arrays.push_records(df, "k", ["v"], ["v"], chunk=10).collect()
    sizes = sorted((r.k, r.part, [x.v for x in r.records]) for r in packed)
    assert sizes == [
        ("k", 0, list(range(10))), ("k", 1, list(range(10, 20))), ("k", 2, list(range(20, 25))),
        ("l", 0, [0]),
    ]

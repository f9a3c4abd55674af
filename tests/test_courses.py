"""A small school: worked results of views, queries and change jobs on its rows."""

from __future__ import annotations

from decimal import Decimal as D

import operator

import pytest
from pyspark.sql import functions as F

from conftest import rows
from loomframe.functions.scalar import cents, pct, round_half_up
from loomframe.operators import aggregates, changes, filters, integrity, joins, ordering, splits


@pytest.fixture(scope="module")
def db(spark):
    make = spark.createDataFrame
    return {
        "hall": make(
            [(10, "Lund", 40, D("900")), (20, "Oslo", 900, D("4200.50")), (30, "Turku", 7000, D("15500")),
             (40, "Oslo", 2, D("120")), (50, "Lund", None, D("300"))],
            "hall int, city string, seats int, rent decimal(10,2)",
        ),
        "course": make(
            [(1, 10, D("20")), (2, 20, D("15.50")), (3, 30, D("60")), (4, 40, D("45")), (5, 50, D("30"))],
            "course int, hall int, price decimal(10,2)",
        ),
        "lesson": make([(101, 1), (102, 2), (103, 2), (104, 3), (105, 4)], "lesson int, course int"),
        "teaching": make(
            [(1, 101, D("300.25")), (2, 101, D("99.75")), (2, 103, D("410.10")), (3, 104, D("2200")),
             (4, 104, D("55.55")), (1, 105, D("80"))],
            "teacher int, lesson int, pay decimal(10,2)",
        ),
        "visit": make(
            [("p", 1, 6), ("q", 1, 9), ("p", 3, 10), ("r", 3, 7), ("t", 3, 4), ("q", 4, 8)],
            "person string, course int, mark int",
        ),
    }


@pytest.fixture(scope="module")
def lesson(db):
    return changes.refresh_rollup(db["lesson"], db["teaching"], "lesson", "lesson", F.col("pay"), "cost")


def test_cost_is_kept_per_lesson(lesson):
    assert rows(lesson.select("lesson", "cost")) == [
        (101, D("400.00")), (102, D("0.00")), (103, D("410.10")), (104, D("2255.55")), (105, D("80.00"))
    ]


def test_cost_follows_a_deleted_share(spark, db, lesson):
    left = db["teaching"].where("NOT (teacher = 3 AND lesson = 104)")
    fresh = changes.refresh_rollup(
        lesson, left, "lesson", "lesson", F.col("pay"), "cost", spark.createDataFrame([(104,)], "lesson int")
    )
    costs = dict(rows(fresh.select("lesson", "cost")))
    assert costs[104] == D("55.55") and costs[101] == D("400.00")


def test_marks_keep_courses_without_visits(db):
    view = joins.left_join_stats(db["course"], db["visit"], "course", "course", "mark", "mean", "visits")
    assert rows(view.select("course", "mean", "visits")) == [
        (1, 7.5, 2), (2, None, 0), (3, 7.0, 3), (4, 8.0, 1), (5, None, 0)
    ]


def _profit(db, lesson, course):
    view = joins.profit_view(
        course.join(db["hall"], "hall"), "course", db["visit"], "course", lesson, "course",
        F.col("cost"), F.col("price"), F.col("rent"),
    )
    return dict(rows(view.select("course", F.col("profit").cast("double"))))


def test_profit_before_and_after_a_new_price(db, lesson):
    raised = changes.update_where(
        db["course"], F.col("course") == 4, "price", F.lit("52.50").cast("decimal(10,2)")
    )
    before, after = _profit(db, lesson, db["course"]), _profit(db, lesson, raised)
    assert before == {1: -1260.0, 2: -4610.6, 3: -17575.55, 4: -155.0, 5: None}
    assert after == before | {4: -147.5}


def test_courses_per_city(db):
    counts = joins.join_agg(db["course"], db["hall"], "hall", "hall", ["city"], count="n")
    assert rows(counts) == [("Lund", 2), ("Oslo", 2), ("Turku", 1)]


def test_lessons_at_or_above_the_mean_cost(lesson):
    assert rows(filters.where_vs_global(lesson, "cost", operator.ge, F.avg).select("lesson")) == [(104,)]


def test_earnings(db):
    earned = aggregates.group_sum(db["teaching"], ["teacher"], F.col("pay"), "earned")
    assert [tuple(r) for r in earned.orderBy(F.desc("earned")).collect()] == [
        (3, D("2200.00")), (2, D("509.85")), (1, D("380.25")), (4, D("55.55"))
    ]


def test_rankings(db):
    assert rows(ordering.bottom_n(db["visit"], "course", 2)) == [(1, 2, 2), (4, 1, 1)]
    top = aggregates.top_counts(db["lesson"], ["course"], 3)
    assert [tuple(r) for r in top.collect()] == [(2, 2), (1, 1), (3, 1)]
    means = db["visit"].groupBy("person").agg(round_half_up(F.avg("mark"), 2).alias("m"))
    assert rows(means) == [("p", 8.0), ("q", 8.5), ("r", 7.0), ("t", 4.0)]


def test_cost_per_course(lesson):
    total = aggregates.group_sum(lesson, ["course"], F.col("cost"), "cost")
    assert [tuple(r) for r in total.orderBy(F.desc("cost")).collect()] == [
        (3, D("2255.55")), (2, D("410.10")), (1, D("400.00")), (4, D("80.00"))
    ]


def test_occupancy(db):
    taken = db["visit"].groupBy("course").agg(F.count("*").alias("n"))
    full = taken.join(db["course"], "course").join(db["hall"], "hall")
    assert rows(full.select("course", pct("n", "seats"))) == [(1, 5.0), (3, 0.04), (4, 50.0)]


def test_admission_up_to_the_seats(spark, db):
    arrivals = spark.createDataFrame(
        [("u", 4, 1), ("v", 4, 2), ("u", 1, 3), ("u", 9, 4), *(("w", 5, i) for i in range(5, 10))],
        "person string, course int, at int",
    )
    seats = db["course"].join(db["hall"], "hall").select("course", "seats")
    taken = changes.taken_places(db["visit"], "course")
    result = changes.admit_until_full(arrivals, seats, "course", "seats", ["at"], taken)
    # one seat is left in course 4; nothing limits a hall without a number, or a course without a hall
    assert rows(result.accepted.select("course")) == [(1,), (4,), (5,), (5,), (5,), (5,), (5,), (9,)]
    assert rows(result.rejected.select("person", "course")) == [("v", 4)]


def test_cascade_and_set_null(db):
    links = [
        changes.ForeignKey("teaching", "lesson", "lesson", "lesson"),
        changes.ForeignKey("lesson", "course", "course", "course"),
        changes.ForeignKey("visit", "course", "course", "course", "set null"),
    ]
    doomed = db["course"].where("course = 3").select("course")
    left = changes.cascade_delete(db, links, "course", doomed, "course")
    assert left["course"].count() == 4
    assert rows(left["lesson"].select("lesson")) == [(101,), (102,), (103,), (105,)]
    assert rows(left["teaching"].select("teacher", "lesson")) == [(1, 101), (1, 105), (2, 101), (2, 103)]
    assert left["visit"].count() == 6 and left["visit"].where("course IS NULL").count() == 3


def test_cascade_over_a_diamond(spark):
    make = lambda pairs, names: spark.createDataFrame(pairs, names)
    tables = {
        "a": make([(1,), (2,)], "a int"), "b": make([(10, 1), (20, 2)], "b int, a int"),
        "c": make([(11, 1), (21, 2)], "c int, a int"),
        "d": make([(100, 10, 21), (200, 20, 11), (300, 20, 21), (400, None, None)], "d int, b int, c int"),
        "e": make([(1000, 100), (2000, 200), (3000, 300)], "e int, d int"),
    }
    links = [changes.ForeignKey(*k) for k in (("e", "d", "d", "d"), ("d", "c", "c", "c"), ("d", "b", "b", "b"), ("b", "a", "a", "a"), ("c", "a", "a", "a"))]
    left = changes.cascade_delete(tables, links, "a", make([(1,)], "a int"), "a")
    assert rows(left["d"].select("d")) == [(300,), (400,)] and rows(left["e"].select("e")) == [(3000,)]
    with pytest.raises(ValueError, match="circle"):
        changes.cascade_delete(tables, [*links, changes.ForeignKey("a", "a", "e", "e")], "a", make([(1,)], "a int"), "a")


def test_new_keys_reach_all_children(spark):
    tables = {
        "p": spark.createDataFrame([("x", 1), ("y", 2)], "k string, n int"),
        "c": spark.createDataFrame([("x", 1, 5), ("y", 2, 6), (None, None, 7)], "k string, n int, c int"),
        "g": spark.createDataFrame([("x", 5), ("y", 6)], "k string, c int"),
    }
    links = [changes.ForeignKey("c", ["k", "n"], "p", ["k", "n"]), changes.ForeignKey("g", ["k", "c"], "c", ["k", "c"])]
    changed = spark.createDataFrame([("x", 1, "z", 9)], "a string, b int, c string, d int")
    out = changes.cascade_update(tables, links, "p", changed, ["k", "n"])
    assert rows(out["p"]) == [("y", 2), ("z", 9)]
    assert rows(out["c"]) == [("y", 2, 6), ("z", 9, 5), (None, None, 7)]
    assert rows(out["g"]) == [("y", 6), ("z", 5)]


def test_integrity_reports(spark, db):
    assert integrity.check_pk(db["visit"], ["person", "course"]).count() == 0
    assert rows(integrity.check_pk(db["visit"], ["person"])) == [("p", 2), ("q", 2)]
    assert integrity.check_pk(spark.createDataFrame([(None,), (1,)], "k int"), ["k"]).count() == 1
    few = db["course"].where("course < 2")
    assert integrity.check_fk(db["visit"], few, ["course"], ["course"]).count() == 4
    assert integrity.check_length(db["hall"], "city", 4).count() == 1


def test_append_takes_the_next_keys(spark, db):
    new = spark.createDataFrame([(20, D("5")), (10, D("6"))], "hall int, price decimal(10,2)")
    grown = changes.append_rows(db["course"], new, "course", ["price"])
    assert rows(grown.where("course > 5").select("course", "hall")) == [(6, 20), (7, 10)]


def test_delete_one_of_several(db):
    left = changes.delete_one(db["visit"], F.col("person") == "p", ["person", "course"])
    assert rows(left.where("person = 'p'").select("course")) == [(3,)]


def test_rows_without_a_label_are_split_too(spark):
    df = spark.createDataFrame([(i, None if i % 4 else "a") for i in range(20)], "id int, label string")
    marked = splits.stratified_split(df, "label", 0.2, ["id"], 3)
    assert rows(marked.groupBy("label").agg(F.count("*"), F.sum("is_test"))) == [("a", 5, 1), (None, 15, 3)]


def test_hundredths_round_half_up(spark):
    df = spark.createDataFrame([(0.125,), (0.135,), (-0.125,), (12.0,), (None,)], "x double")
    assert sorted((r[0] for r in df.select(cents("x")).collect()), key=repr) == sorted([13, 14, -13, 1200, None], key=repr)

"""Nearest neighbours against brute force, with gaps, ties, many blocks and crowded cells."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from loomframe.operators import neighbors


def brute(queries: np.ndarray, donors: np.ndarray, k: int) -> list[list[tuple[int, float]]]:
    out = []
    for q in queries:
        known = ~np.isnan(q) & ~np.isnan(donors)
        shared = known.sum(axis=1)
        square = np.where(known, (q - donors) ** 2, 0.0).sum(axis=1)
        pairs = [
            (square[i] * donors.shape[1] / shared[i], i) for i in range(len(donors)) if shared[i]
        ]
        out.append([(i, d) for d, i in sorted(pairs)[:k]])
    return out


def frame(spark, name: str, values: np.ndarray):
    data = [
        (i, [None if np.isnan(v) else float(v) for v in row]) for i, row in enumerate(values)
    ]
    return spark.createDataFrame(data, f"{name} bigint, x array<double>").repartition(4)


def check(spark, queries, donors, k):
    asked = frame(spark, "query", queries).withColumn("target", F.lit(neighbors.ANY))
    got = neighbors.nearest(
        asked, frame(spark, "donor", donors), queries.shape[1], k
    ).toPandas()
    want = brute(queries, donors, k)
    assert len(got) == sum(map(len, want))
    for i, pairs in enumerate(want):
        mine = got[got["query"] == i].sort_values("place")
        assert list(mine.donor) == [p[0] for p in pairs]
        assert np.allclose(mine.distance, [p[1] for p in pairs])


@pytest.fixture(autouse=True, params=[0, 10_000], ids=["two rounds", "one round"])
def small_blocks(monkeypatch, request):
    monkeypatch.setattr(neighbors, "FEW_BLOCKS", request.param)
    monkeypatch.setattr(neighbors, "BLOCK_ROWS", 20)
    monkeypatch.setattr(neighbors, "QUERY_ROWS", 15)


def test_plain_points(spark):
    rng = np.random.default_rng(0)
    check(spark, rng.normal(size=(60, 2)), rng.normal(size=(500, 2)), 5)


def test_gaps_on_both_sides(spark):
    rng = np.random.default_rng(1)
    queries, donors = rng.normal(size=(50, 4)), rng.normal(size=(300, 4))
    queries[rng.random(queries.shape) < 0.3] = np.nan
    donors[rng.random(donors.shape) < 0.3] = np.nan
    check(spark, queries, donors, 4)


def test_rare_patterns_of_gaps_share_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "MAX_PATTERNS", 2)
    rng = np.random.default_rng(2)
    queries, donors = rng.normal(size=(40, 4)), rng.normal(size=(300, 4))
    queries[rng.random(queries.shape) < 0.3] = np.nan
    donors[rng.random(donors.shape) < 0.3] = np.nan
    check(spark, queries, donors, 4)


def test_a_third_of_the_donors_are_copies(spark):
    rng = np.random.default_rng(3)
    donors = rng.integers(0, 4, size=(300, 3)).astype(float)
    donors[:100] = 1.0
    check(spark, donors[::7], donors, 6)


def test_large_blocks_are_met_in_parts(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "DONOR_ROWS", 6)
    rng = np.random.default_rng(7)
    check(spark, rng.normal(size=(40, 2)), rng.normal(size=(300, 2)), 5)


def test_fewer_donors_than_neighbours(spark):
    rng = np.random.default_rng(4)
    check(spark, rng.normal(size=(5, 2)), rng.normal(size=(3, 2)), 5)
    check(spark, rng.normal(size=(3, 2)), np.empty((0, 2)), 5)


def test_blocks_are_skipped(spark):
    """Far blocks never meet a query."""
    rng = np.random.default_rng(5)
    donors = frame(spark, "donor", rng.uniform(0, 100, size=(2000, 2)))
    blocks = neighbors._blocks(donors, 2, 2000)
    boxes = neighbors._Boxes(blocks, 2)
    assert len(boxes.names) > 50
    assert len(boxes.candidates(np.array([50.0, 50.0]), 5)) < len(boxes.names) / 4


def test_imputation_without_any_shared_feature(spark):
    df = spark.createDataFrame(
        [(1, None, None), (2, 4.0, 1.0), (3, 8.0, None)], "id bigint, a double, b double"
    )
    got = {r.id: (r.a, r.b) for r in neighbors.knn_impute(df, "id", ["a", "b"], k=1).collect()}
    assert got == {1: (6.0, 1.0), 2: (4.0, 1.0), 3: (8.0, 1.0)}


def test_imputation_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 3))
    x[rng.random(x.shape) < 0.25] = np.nan
    df = spark.createDataFrame(
        [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)],
        "id bigint, a double, b double, c double",
    )
    got = neighbors.knn_impute(df, "id", ["a", "b", "c"], k=3).orderBy("id").toPandas()
    for c, name in enumerate("abc"):
        donors = np.flatnonzero(~np.isnan(x[:, c]))
        for i in np.flatnonzero(np.isnan(x[:, c])):
            pairs = brute(x[i : i + 1], x[donors], 3)[0]
            want = x[donors[[p[0] for p in pairs]], c].mean() if pairs else np.nanmean(x[:, c])
            assert got[name][i] == pytest.approx(want)


def test_votes_tie_to_the_smaller_label(spark):
    train = spark.createDataFrame([(1, 0.0, 2), (2, 1.0, 1), (3, 9.0, 3)], "id bigint, v double, y int")
    test = spark.createDataFrame([(7, 0.4)], "id bigint, v double")
    got = neighbors.knn_classify(train, test, "id", F.array("v"), 1, "y", k=2).first()
    assert (got.id, got.prediction) == (7, 1)


def test_leaves_find_what_brute_force_finds():
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(4000, 5)) * [5, 1, 1, 0, 1], np.repeat(rng.normal(size=(3, 5)), 400, axis=0)])
    q = np.concatenate([rng.normal(size=(300, 5)), x[::37]])
    leaves = neighbors._Leaves(x)
    assert leaves.whole and len(leaves.rows) > 10
    assert (leaves.nearest(q, 5) == neighbors._nearest_rows(q, x, 5)).all()
    q[7, 2] = np.nan  # a gap meets all rows
    assert (leaves.nearest(q, 5) == neighbors._nearest_rows(q, x, 5)).all()
    assert leaves.nearest(q[:9], 10_000).shape == (9, len(x))


def test_a_query_of_a_classifier_meets_few_labelled_rows(monkeypatch):
    rng = np.random.default_rng(9)
    x, met, plain = rng.normal(size=(20_000, 4)), [], neighbors._nearest_rows
    monkeypatch.setattr(neighbors, "_nearest_rows", lambda q, rows, k: met.append(len(q) * len(rows)) or plain(q, rows, k))
    neighbors._Leaves(x).nearest(rng.normal(size=(500, 4)), 5)
    assert sum(met) < 500 * len(x) / 4


def test_votes_of_one_file_are_counted_in_several_tasks(spark, tmp_path):
    spark.range(6 * neighbors.VOTER_ROWS).selectExpr("id", "double(id) v", "int(id % 2) y").coalesce(1).write.parquet(str(tmp_path / "t"))
    one = spark.read.parquet(str(tmp_path / "t"))
    votes = neighbors.knn_votes(one, one, "id", F.array("v"), 1, "y", k=1)
    assert votes.where("votes = 1 AND prediction = id % 2").count() == one.count() == votes.count()
    assert votes.rdd.getNumPartitions() == 6


def all_votes(train, test, k):
    """Votes per test row and label by plain search among all labelled rows, which are in the order of their keys."""
    out = {}
    for i, near in enumerate(brute(test[:, :-1], train[:, :-1], k)):
        for donor, _ in near:
            out[i, int(train[donor, -1])] = out.get((i, int(train[donor, -1])), 0) + 1
    return out


def labelled(spark, values):
    data = [(i, [None if np.isnan(v) else float(v) for v in row[:-1]], int(row[-1])) for i, row in enumerate(values)]
    return spark.createDataFrame(data, "id bigint, x array<double>, y int").repartition(3)


def test_labelled_rows_beyond_one_matrix_all_vote(spark, monkeypatch):
    """Shards of at most 60 rows, with copies, ties and gaps; the votes are those of a search among all rows."""
    monkeypatch.setattr(neighbors, "DONOR_ROWS", 60)
    rng = np.random.default_rng(10)
    train = np.column_stack([rng.normal(size=(700, 4)).round(1), rng.integers(0, 3, 700)])
    train[100:350, :4] = train[100, :4]
    test = np.concatenate([train[::20], np.column_stack([rng.normal(size=(40, 4)) * 2, np.zeros(40)])])
    for gaps in (False, True):
        if gaps:
            train[5:60:4, 1], test[::5, 2], train[90:600:50, :4] = np.nan, np.nan, np.nan
        votes = neighbors.knn_votes(labelled(spark, train), labelled(spark, test), "id", F.col("x"), 4, "y", max_rows=200)
        got = {(r.id, r.prediction): r.votes for r in votes.collect()}
        assert got == all_votes(train, test, 5)


def test_shards_give_what_one_matrix_gives(spark, monkeypatch):
    """Repeated keys, missing keys and labels, and fewer rows than neighbours, with few and with all rows in one matrix."""
    monkeypatch.setattr(neighbors, "DONOR_ROWS", 4)
    train = [(i % 7, float(i * i % 11), None if i % 7 == 4 else float(i % 7 % 2)) for i in range(30)] + [(None, 2.5, 1.0)]
    train = spark.createDataFrame(train, "id bigint, v double, y double")
    test = spark.createDataFrame([(1, 0.2), (1, 7.3), (None, 3.0), (2, 50.0), (3, None)], "id bigint, v double")
    for k in (5, 40):
        both = []
        for most in (2, 1000):
            votes = neighbors.knn_votes(train, test, "id", F.array("v"), 1, "y", k=k, max_rows=most)
            assert votes.dtypes == [("id", "bigint"), ("prediction", "double"), ("votes", "bigint")]
            both.append(votes.groupBy("id", "prediction").agg(F.sum("votes").alias("n")))
        assert rows(both[0]) == rows(both[1]) != []
    none = neighbors.knn_votes(train, test.limit(0), "id", F.array("v"), 1, "y", max_rows=2)
    assert none.count() == 0


def test_a_query_meets_few_shards(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "DONOR_ROWS", 50)
    rng = np.random.default_rng(11)
    train = labelled(spark, np.column_stack([rng.uniform(0, 100, size=(2000, 2)), np.zeros(2000)]))
    blocks, boxes = neighbors._shards(train.select(F.col("id").alias("donor"), "x", F.lit("a").alias("prediction")), 2, 3)
    assert len(boxes.names) > 50 and boxes.counts.max() <= 100 and boxes.counts.sum() == 2000 == blocks.count()
    apart = neighbors._apart(rng.uniform(0, 100, size=(100, 2)), boxes.low, boxes.high)
    assert (apart < 4.0).sum(1).mean() < 5

"""Micro-batches give what one batch gives."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import rows
from loomframe.operators.changes import admit_until_full
from loomframe.session import new_path
from loomframe.streaming import triggers

SCHEMA = "person string, event int, at int, fee decimal(10,2)"


def feed(spark, source: str, data) -> None:
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(source)


def people(first: int, n: int):
    from decimal import Decimal

    return [(f"p{i}", i % 3, i, Decimal(i)) for i in range(first, first + n)]


def test_admission_counts_earlier_batches(spark):
    source, root, checkpoint = (new_path(spark, n) for n in ("source", "admitted", "checkpoint"))
    capacity = spark.createDataFrame([(0, 3), (1, 0), (2, None)], "event int, capacity int")
    for first in (0, 10, 20):
        feed(spark, source, people(first, 10))
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        triggers.admission_batches(
            stream, capacity, "event", "capacity", ["at"], root, checkpoint
        ).awaitTermination(120)
    whole = admit_until_full(
        spark.createDataFrame(people(0, 30), SCHEMA), capacity, "event", "capacity", ["at"]
    )
    got = triggers.stored(spark, root, f"{SCHEMA}, accepted int")
    for name, part in (("accepted", 1), ("rejected", 0)):
        assert rows(got.where(f"accepted = {part}").select("person")) == rows(getattr(whole, name).select("person"))


def test_admission_judges_the_keys_of_a_group_together(spark):
    source, root, checkpoint = (new_path(spark, n) for n in ("source", "admitted", "checkpoint"))
    n_keys, schema = 3 * triggers.GROUPS, "k double, at int"
    capacity = spark.range(1, n_keys).selectExpr("double(id) k", "nullif(id % 3, 2) most")
    for start in (0, 1):  # a key's second arrival comes in the next batch
        data = spark.range(n_keys).selectExpr("double(id) k", f"int({start} * 10 + id) at")
        odd = spark.sql(f"SELECT {'-0.0D' if start else '0.0D'} k, {start} at UNION ALL SELECT null, {start}")
        data.union(odd).write.mode("append").parquet(source)
        query = triggers.admission_batches(
            spark.readStream.schema(schema).parquet(source), capacity, "k", "most", ["at"], root, checkpoint
        )
        query.awaitTermination(120)
    updated = max(p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress)
    assert 0 < updated <= triggers.GROUPS < n_keys  # states grow with the groups, not with the keys
    got = {r.k: r.n for r in triggers.stored(spark, root, f"{schema}, accepted int").groupBy("k").agg(F.sum("accepted").alias("n")).collect()}
    want = {float(i): {0: 0, 1: 1, 2: 2}[i % 3] for i in range(1, n_keys)}
    assert got == want | {0.0: 4, None: 2}  # no row in capacity admits always


def test_a_batch_touches_the_state_of_its_own_keys_only(spark):
    source, root, checkpoint = (new_path(spark, n) for n in ("source", "rollup", "checkpoint"))
    updated = []
    for data in (people(0, 12), [("late", 1, 99, None)]):
        feed(spark, source, data)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        query = triggers.rollup_batches(stream, "event", F.col("fee"), root, checkpoint)
        query.awaitTermination(120)
        updated.append([p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress if p["numInputRows"]])
    assert updated == [[3], [1]]


def test_rollup_adds_up(spark):
    source, root, checkpoint = (new_path(spark, n) for n in ("source", "rollup", "checkpoint"))
    for first in (0, 7):
        feed(spark, source, people(first, 7))
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        triggers.rollup_batches(stream, "event", F.col("fee"), root, checkpoint).awaitTermination(120)
    got = triggers.totals(spark, root, "event", "int")
    want = spark.createDataFrame(people(0, 14), SCHEMA).groupBy("event").agg(F.sum("fee"))
    assert rows(got) == rows(want)

"""The stages one after the other, each against a plain version of its step."""

from __future__ import annotations

import re

import pytest

import corpus_pipeline
from conftest import SF_DIR
from loomframe.llm import queries, secret_scan, simhash
from loomframe.session import stage

FOLDER = SF_DIR.replace("sf0.001", "sf0.01")


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for _, function in corpus_pipeline.STAGES:
        out.append(stage(function(spark, out[-1], FOLDER), "step"))
    return out


def test_columns_stay(steps):
    assert all(s.columns == steps[0].columns for s in steps[:-1])


def test_quality_keeps_good_documents(spark, steps):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    good = labels.where("quality = 1")
    kept = steps[1].join(good, "doc_id").count()
    assert kept >= 0.98 * good.count()
    assert steps[1].join(labels.where("quality = 0"), "doc_id").count() <= 0.1 * labels.where("quality = 0").count()


def test_dedup_stages(steps):
    before, exact, near = (s.toPandas() for s in steps[1:4])
    plain = before.sort_values("doc_id").assign(key=[re.sub("[ \t-\r]+", " ", t) for t in before.sort_values("doc_id").text])
    assert sorted(exact.doc_id) == sorted(plain.drop_duplicates("key").doc_id)
    fps = [simhash.fingerprint(t) for t in exact.text]
    gone = set(exact.doc_id) - set(near.doc_id)
    for doc_id, fp in zip(exact.doc_id, fps):
        if doc_id in gone:
            assert any((fp ^ other).bit_count() <= 3 for i, other in zip(exact.doc_id, fps) if i != doc_id)
    kept = [fp for i, fp in zip(exact.doc_id, fps) if i not in gone]
    assert all((a ^ b).bit_count() > 3 for n, a in enumerate(kept) for b in kept[:n])


def test_secrets_are_gone(steps):
    masked = steps[4].toPandas()
    assert len(masked) == steps[3].count()
    assert not any(secret_scan.find_secrets(t) for t in masked.text)
    assert (masked.n_chars == masked.text.str.len()).all()


def test_all_documents_are_packed(steps):
    packed = steps[5].toPandas()
    assert set(packed.doc_id) == {r.doc_id for r in steps[4].select("doc_id").collect()}
    assert (packed.groupby("doc_id").length.sum() == packed.groupby("doc_id").doc_tokens.first()).all()


def test_each_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "SimHash near-dedup", "secret scans", "packing"
    ]


def test_columns_of_any_name_and_ties_survive_the_dedup_stages(spark):
    schema = "doc_id long, text string, _key string, _fp string, key int, row string, digest int"
    data = [
        (1, "one two three four", "k1", "f1", 5, "r", 1), (2, "one  two three four", "k2", "f2", 6, "r", 2),
        (3, None, "k3", None, 7, "r", 3), (3, None, "k3", None, 7, "r", 3), (4, "", "k4", "f4", None, None, 4),
        (None, "five six seven eight", "k5", "f5", 8, "r", 5), (6, "a b\tc", "x", "f", 1, "r", 6), (6, "a b c", "y", "f", 1, "r", 6),
    ]
    df = spark.createDataFrame(data, schema)
    one, other = (corpus_pipeline.exact(spark, df.repartition(n), "") for n in (1, 5))
    assert one.columns == df.columns and sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, other.collect()), key=repr)
    got = {r.doc_id: r for r in one.collect()}
    assert set(got) == {1, 3, None, 6} and got[1]._key == "k1" and got[1]._fp == "f1" and got[3].key == 7 and got[None].digest == 5
    near = corpus_pipeline.near(spark, df, "")
    kept = {r.doc_id: r for r in near.collect()}
    assert near.columns == df.columns and kept[1]._fp == "f1" and kept[3]._key == "k3" and len(kept) == near.count()


def test_stages_on_empty_and_null_tables(spark, tmp_path):
    labels = "doc_id long, quality int, toxic int"
    spark.createDataFrame([], labels).write.parquet(f"{tmp_path}/labels.parquet")
    schema = "doc_id long, text string, lang string, source string, n_chars long, _key int, _fp int"
    for data in ([], [(None,) * 7] * 3, [(1, "x y z", None, None, 5, 1, 2)]):
        docs = spark.createDataFrame(data, schema)
        for _, function in corpus_pipeline.STAGES:
            docs = stage(function(spark, docs, str(tmp_path)), "step")
        assert docs.count() == (1 if data else 0)

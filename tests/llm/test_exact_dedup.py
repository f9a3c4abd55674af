from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest

from loomframe.llm import exact_dedup as ed

SCHEMA = "doc_id long, text string, digest int, copies int"


def expected(rows):
    """Brute force over (doc_id, text): the contract's columns, sorted."""
    groups = defaultdict(list)
    for i, (doc_id, text) in enumerate(rows):
        plain = re.sub("[ \t-\r]+", " ", text or "")
        groups[hashlib.sha256(plain.encode()).hexdigest()].append((doc_id is None, doc_id or 0, i))
    out = []
    for digest, members in groups.items():
        members.sort()
        ids = [None if null else doc_id for null, doc_id, _ in members]
        for place, doc_id in enumerate(ids):
            out.append((doc_id, ids[0], len(ids), place == 0, digest))
    return sorted(out, key=repr)


def test_groups_match_brute_force(spark):
    rows = [
        (5, "a  b"), (1, "a\tb"), (9, "a b"), (9, "a b"), (2, "A b"), (3, None), (4, ""), (6, " "),
        (7, "long " * 20_000), (8, "long\n" * 20_000), (None, "a b"), (None, "only null id"), (10, "é x"), (11, "é x"),
    ] + [(100 + i, f"t{i % 40}") for i in range(200)]
    docs = spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA)
    got = ed.dedup_table(docs).collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows)


def test_batches_against_snapshots(spark):
    old = spark.createDataFrame([(1, "x", 0, 0), (2, "y", 0, 0)], SCHEMA)
    older = spark.createDataFrame([(3, "z", 0, 0)], SCHEMA)
    new = spark.createDataFrame([(4, "x", 0, 0), (5, "w", 0, 0), (6, "w", 0, 0), (0, "z", 0, 0)], SCHEMA)
    got = {r.doc_id: (r.keep_id, r.group_size) for r in ed.exact_dedup(new, [ed.freeze(old), ed.freeze(older)]).collect()}
    assert got == {1: (1, 2), 2: (2, 1), 3: (0, 2), 4: (1, 2), 5: (5, 2), 6: (5, 2), 0: (0, 2)}
    assert ed.exact_dedup(new, []).where("kept").count() == 3


def test_empty_table(spark):
    assert ed.dedup_table(spark.createDataFrame([], SCHEMA)).count() == 0


def test_keep_first_keeps_whole_rows(spark):
    docs = spark.createDataFrame(
        [(2, "a b", 1, 2), (1, "a  b", 3, 4), (3, None, 5, 6), (3, None, 5, 6), (None, "q", 7, 8)], SCHEMA
    )
    got = sorted((tuple(r) for r in ed.keep_first(docs).collect()), key=repr)
    assert got == sorted([(1, "a  b", 3, 4), (3, None, 5, 6), (None, "q", 7, 8)], key=repr)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 50_000])
def test_filters_hold_all_their_keys(n):
    draw = np.random.default_rng(n)
    keys = draw.integers(0, 1 << 63, n).astype(np.uint64)
    blob = ed.build_filter(keys)
    assert ed.in_filter(blob, keys).all()
    others = draw.integers(0, 1 << 63, 20_000).astype(np.uint64)
    assert ed.in_filter(blob, others).mean() < 0.001

"""Near duplicates, repeats, neighbours and components against brute force."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from loomframe.llm import components as cc, neighbour_tree as nt, repeats, simhash


def joined(n, pairs):
    """Smallest member of each node's component."""
    label = list(range(n))
    while True:
        before = list(label)
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            return label


# --- SimHash -------------------------------------------------------------------------------------

def slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for text in ["", " \n", "One", "a B", "a b c", "a b c d É e f", "x " * 500, "q w e r t y " * 20 + "z"]:
        assert simhash.fingerprint(text) == slow_fingerprint(text)


@pytest.mark.parametrize("blocks", [1, 2])
def test_no_link_is_lost(blocks):
    draw = np.random.default_rng(blocks)
    fps = [int(x) for x in draw.integers(0, 1 << 63, 250)]
    for x in fps[:200]:
        flips = draw.choice(64, draw.integers(1, 5), replace=False)
        fps.append(x ^ sum(1 << int(b) for b in flips))
    fps = np.unique(np.array(fps, np.uint64))
    rows, anchor, home = (np.concatenate(p) for p in zip(*simhash.anchors_of(fps, blocks, 3)))
    assert (np.bincount(rows[home], minlength=len(fps)) == 1).all()
    label = np.arange(len(fps))
    order = np.argsort(anchor, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(anchor[order])) + 1):
        u, v = simhash._close(fps[rows[group]], home[group], 3)
        label = simhash._join(label, np.searchsorted(fps, u), np.searchsorted(fps, v))
    near = np.argwhere(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3)
    assert label.tolist() == joined(len(fps), near.tolist())


def test_near_duplicates_of_a_table(spark):
    draw = np.random.default_rng(4)
    base = [" ".join(draw.choice(["red", "blue", "cat", "dog", "sun", "sea", "tea"], 400)) for _ in range(30)]
    texts = base + [b.replace("red", "RED", 3) + tail for b in base for tail in ("", " end")] + [None, "", " ", "one", "two words"]
    rows = [(200 - i, t, "x") for i, t in enumerate(texts)] + [(None, base[0], "x"), (200, base[0], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").repartition(3)
    got = sorted((tuple(r) for r in simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id").collect()), key=repr)
    fps = [slow_fingerprint(t or "") for _, t, _ in rows]
    pairs = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3]
    label = joined(len(fps), pairs)
    least = {}
    for (i, *_), n in zip(rows, label):
        if i is not None:
            least[n] = min(i, least.get(n, i))
    want = sorted(((i, f"{f:016x}", least.get(n)) for (i, *_), f, n in zip(rows, fps, label)), key=repr)
    assert got == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(label))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_components(spark):
    draw = np.random.default_rng(5)
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 101 + i) for i in range(60)]
    loose = [tuple(map(int, p)) for p in draw.integers(200, 300, (60, 2))]
    pairs = [*chain, *star, *loose, (7, 7), (5, 4)]
    links = spark.createDataFrame(pairs, "u long, v long").union(spark.sql("select cast(null as bigint), 3L"))
    got = dict(cc.components(links).collect())
    label = joined(300, pairs)
    assert got == {i: n for i, n in enumerate(label) if i != n}
    assert cc.components(links.limit(0)).count() == 0


# --- repeats ---------------------------------------------------------------------------------------

def slow_repeats(texts):
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[p : p + 200] for b in bodies for p in range(len(b) - 199))
    out = []
    for b in bodies:
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - 199):
            if seen[b[p : p + 200]] > 1:
                gone[p : p + 200] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [repeats.HOT, 4, 0])
def test_repeats_match_brute_force(spark, hot):
    draw = np.random.default_rng(6)
    letters = lambda n, k=26: bytes(draw.integers(97, 97 + k, n).astype(np.uint8)).decode()
    base = letters(1500)
    texts = ["a" * 600, "ab" * 300, "x" * 199, "y" * 200, "y" * 200, None, "", "é" * 150 + "z" + "é" * 150, letters(400, 2)]
    for _ in range(40):
        at, n = draw.integers(0, 1200), draw.integers(150, 300)
        texts.append(letters(draw.integers(0, 300)) + base[at : at + n] + letters(draw.integers(0, 300)))
    rows = [*enumerate(texts), (None, base), (7, base[:700]), (7, base[:700])]
    want = Counter((i, *b) for (i, _), b in zip(rows, slow_repeats([t for _, t in rows])))
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, kept string").repartition(4)
    assert Counter(map(tuple, repeats.repeat_report(docs, hot).collect())) == want


def test_repeats_of_an_empty_table(spark):
    assert repeats.repeat_report(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# --- neighbours ------------------------------------------------------------------------------------

def slow_search(rows, is_query, nearest=5):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v) and len(v) == 8:
            good[i] = np.array(v, np.float32).astype(float)
    out = []
    for i, q in good.items():
        if is_query(i):
            score = {j: float((q * x).sum() / (np.sqrt((q * q).sum()) * np.sqrt((x * x).sum()))) for j, x in good.items() if j != i}
            out += [(i, r, j) for r, j in enumerate(sorted(score, key=lambda j: (-score[j], j))[:nearest], 1)]
    return out


def test_neighbours_with_full_recall(spark):
    draw = np.random.default_rng(7)
    rows = [(i, draw.normal(size=8).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(300)] + [(2000, None), (2001, [0.0] * 8), (2002, [float("nan")] * 8)]
    rows += [(2003, [1.0, None] * 4), (2004, [1.0] * 5), (None, rows[1][1]), rows[50], (2005, [float("inf")] * 8)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = nt.search(df, F.col("vec_id") % 50 == 0, recall=1.0).collect()
    truth = slow_search(rows, lambda i: i % 50 == 0)
    assert len(got) == len(truth)
    assert len({(r.query_id, r.rank, r.vec_id) for r in got} & set(truth)) >= 0.98 * len(truth)
    ties = [(r.rank, r.vec_id) for r in sorted(got, key=lambda r: r.rank) if r.query_id == 1000]
    assert ties == [(1, 3), (2, 1001), (3, 1002), (4, 1003), (5, 1004)]


def test_recall_on_a_table(spark):
    draw = np.random.default_rng(8)
    centres = draw.normal(size=(30, 8))
    rows = [(i, (centres[i % 30] + 0.3 * draw.normal(size=8)).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = nt.search(df, F.col("vec_id") % 50 == 0).collect()
    truth = {(i, j) for i, _, j in slow_search(rows, lambda i: i % 50 == 0)}
    assert len({(r.query_id, r.vec_id) for r in got} & truth) >= 0.9 * len(truth)


@pytest.mark.parametrize("n", [0, 1, 2, 4])
def test_few_vectors(spark, n):
    df = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(n)], "vec_id long, embedding array<float>")
    assert nt.search(df, F.col("vec_id") % 50 == 0).count() == max(0, n - 1)
